"""Exact removal of repeated byte strings by a common-prefix-aware distributed
merge sort of suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier
(smaller id, or earlier in the same document). To sort all suffixes of a large corpus is
not needed: every window of LENGTH bytes names one of its positions as its anchor,
by content alone (the leftmost of the smallest GRAM-byte hashes), so equal
windows have equal anchors at equal offsets, and only suffixes at anchors are sorted.

1. ``_count``: every task lists its anchors' hashes by hash bucket; buckets
   find the hashes that occur twice. A hash collision costs time, never a wrong answer.
2. ``_runs``: the surviving anchors' suffixes (bytes from the anchor on as far as its
   windows reach, then the bytes before it backwards) are sorted in each task.
   Suffixes equal to an earlier one of the task are settled there; the others
   leave as front-coded runs (shared prefix length and the rest), dealt
   by the hash of their first GRAM bytes.
3. ``_merge``: runs are merged by a loser tree whose players carry the length
   of the prefix that they are known to share with the last winner: a longer known prefix wins without
   looking at bytes, and bytes are compared only behind a known prefix. The merged
   order's common prefixes give, for every offset of a window to its anchor, the classes of equal windows;
   all but a class's first window are repeats.
4. ``_cut``: each document's removed runs.

Scale: nothing is dealt by document group or passage. Equal suffixes leave a
task once, so copies cost a row per task. Anchor grams that hold a large
share of a bucket (a line that a third of the documents share, in ever new
surroundings) are known after step 1, at most four per bucket; their windows are
exchanged one by one, as 128-bit digests with the earliest place per task, spread by digest.
Texts pass through tasks in blocks of bounded size.

Rules: a NULL text is empty; texts shorter than LENGTH lose nothing; rows that
share an id (or have none; NULL ids come first) are ordered by a hash of their
text, and rows equal in both are one document reported once per row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, materialize, ordered, pack, partitions, released, split, unpack

LENGTH = 100
GRAM = 40
SPREAD = LENGTH - GRAM  # largest offset of a window's anchor
WIDTH = LENGTH + SPREAD
BLOCK = 1 << 20
HELD = 500_000
HOT = 4096
_BASE = 0x9E3779B97F4A7C15
_BLOB = "part int, kind int, data binary"


# -- blobs ---------------------------------------------------------------------

def _blobs(rows):
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["part", "kind", "data"])


def _deal(keys: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a document; ``_dealt`` is the same in SQL."""
    return np.mod(np.mod(keys, 1000003) * 7919, 1000003) % parts


def _dealt(key: str, parts: int):
    return F.expr(f"cast(pmod(pmod({key}, 1000003) * 7919, 1000003) % {parts} as int)")


# -- anchors -------------------------------------------------------------------

def _fragments(keys, texts):
    """Blocks of (keys, bases, buffer, ends): whole texts, or parts of a very
    long one that overlap by LENGTH - 1 bytes."""
    held, size = [], 0

    def block():
        ends = np.cumsum([len(t) for _, _, t in held])
        return (np.array([k for k, _, _ in held], np.int64), np.array([b for _, b, _ in held], np.int64),
                np.frombuffer(b"".join(t for _, _, t in held), np.uint8), ends)

    for key, text in zip(keys, texts):
        if len(text) < LENGTH:
            continue
        for base in range(0, len(text) - LENGTH + 1, BLOCK):
            part = text[base:base + BLOCK + LENGTH - 1]
            held.append((key, base, part))
            size += len(part)
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if held:
        yield block()


class _Powers:
    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            one = np.full(n, _BASE, np.uint64)
            one[0] = 1
            self.up = np.cumprod(one)
            one[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.cumprod(one)
        return self.up[:n], self.down[:n]


def anchors(buf: np.ndarray, ends: np.ndarray, powers: _Powers):
    """Anchors of all windows: position in ``buf``, first and last window start,
    gram hash."""
    n = len(buf)
    up, down = powers.get(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    h = (total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # The smallest upper half, leftmost of equals: the position is the lower half.
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= SPREAD + 1:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = SPREAD + 1 - step
    m = np.minimum(m[:len(m) - rest], m[rest:]) if rest else m
    mark = np.zeros(n + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    some = ends - starts >= LENGTH
    mark[starts[some]] += 1
    mark[ends[some] - LENGTH + 1] -= 1
    at = np.flatnonzero(np.cumsum(mark[:len(m)]))
    who = (m[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(who, prepend=-1))
    last = np.append(new[1:], len(at)) - 1 if len(new) else new
    pos = who[new]
    return pos, at[new], at[last], h[pos]


def _read(batch):
    return batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("text").to_pylist()


# -- 1: which grams occur twice --------------------------------------------------

def _count(parts: int):
    def flush(held):
        h, key, pos = (np.concatenate(x) for x in zip(*held))
        o = np.lexsort((pos, key, h))
        h, key, pos = h[o], key[o], pos[o]
        first = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)) != 0) if len(h) else np.zeros(0, int)
        size = np.diff(np.append(first, len(h)))
        single = np.repeat(size == 1, size)
        bucket = (h % np.uint64(parts)).astype(np.int64)
        # By document and place within a bucket, for compression.
        s = np.flatnonzero(single)
        s = s[np.lexsort((pos[s], key[s]))]
        rows = [(p, 0, pack(a, np.diff(b, prepend=0), c)) for p, (a, b, c) in split(bucket[s], h[s], key[s], pos[s].astype(np.uint32))]
        many = first[size > 1]
        rows += [(p, 1, pack(a, c)) for p, (a, c) in split(bucket[many], h[many], size[size > 1].astype(np.uint32))]
        # Occurring twice in one task settles it: these are candidates already.
        d = np.flatnonzero(~single)
        rows += [(p, 2, pack(b, c)) for p, (b, c) in split(_deal(key[d], parts), key[d], pos[d].astype(np.uint32))]
        return _blobs(rows)

    @released

    def run(batches):
        powers, held, n = _Powers(), [], 0
        for b in batches:
            for keys, bases, buf, ends in _fragments(*_read(b)):
                pos, _, _, h = anchors(buf, ends, powers)
                doc = np.searchsorted(ends, pos, side="right")
                held.append((h, keys[doc], pos - np.concatenate([[0], ends[:-1]])[doc] + bases[doc]))
                n += len(pos)
                if n >= HELD:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return run


def _repeated(parts: int, hot: int):
    @released
    def run(batches):
        single, many, out = [], [], []
        for b in batches:
            for kind, data in zip(b.column("kind").to_pylist(), b.column("data").to_pylist()):
                if kind == 0:
                    h, key, pos = unpack(data)
                    single.append((h, np.cumsum(key), pos))
                elif kind == 1:
                    many.append(unpack(data))
                else:
                    key, pos = unpack(data)
                    out += [(p, 0, pack(*x)) for p, x in split(_deal(key, parts), key, pos)]
                    if len(out) > 256:
                        yield _blobs(out)
                        out = []
        yield _blobs(out)
        empty = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32)]
        h, key, pos = (np.concatenate(x) for x in zip(*single)) if single else empty
        mh, mn = (np.concatenate(x) for x in zip(*many)) if many else (empty[0], empty[2])
        alls, count = np.concatenate([h, mh]), np.concatenate([np.ones(len(h), np.int64), mn.astype(np.int64)])
        if not len(alls):
            return
        u, back = np.unique(alls, return_inverse=True)
        total = np.bincount(back, count, minlength=len(u)).astype(np.int64)
        twice = np.flatnonzero(total[back[:len(h)]] > 1)
        yield _blobs((p, 0, pack(*x)) for p, x in split(_deal(key[twice], parts), key[twice], pos[twice]))
        large = u[total >= max(hot, total.sum() / 4)]  # four at most
        if len(large):
            yield _blobs([(0, 1, pack(large))])

    return run


# -- 2: sorted runs --------------------------------------------------------------

def _matrix(buf, pos, lo, hi):
    """Rows: the bytes from the anchor on, then those before it backwards, each
    as far as the anchor's windows reach, padded with zeros."""
    right, left = hi + LENGTH - pos, pos - lo
    k = np.arange(WIDTH)
    at = np.where(k < LENGTH, pos[:, None] + k, pos[:, None] - 1 - (k - LENGTH))
    ok = np.where(k < LENGTH, k < right[:, None], k - LENGTH < left[:, None])
    return np.where(ok, buf[np.clip(at, 0, len(buf) - 1)], 0).astype(np.uint8), right.astype(np.uint8), left.astype(np.uint8)


def _own(shared, right, left):
    """Which bytes of a front-coded row are its own: behind the shared prefix, not padding."""
    k = np.arange(WIDTH)
    real = np.where(k < LENGTH, k < right[:, None], k - LENGTH < left[:, None])
    return (k >= shared[:, None]) & real


def _shared(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before."""
    out = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        diff = rows[1:] != rows[:-1]
        out[1:] = np.where(diff.any(axis=1), diff.argmax(axis=1), WIDTH)
    return out


def front_code(rows, right, left) -> tuple[np.ndarray, np.ndarray]:
    shared = _shared(rows)
    return shared, rows[_own(shared, right, left)]


def front_decode(shared, right, left, own) -> np.ndarray:
    rows = np.zeros((len(shared), WIDTH), np.uint8)
    rows[_own(shared, right, left)] = own
    out = np.empty_like(rows)
    carry = np.zeros(WIDTH, np.uint8)
    for lo in range(0, len(rows), 4096):  # each column's last row that is not shared
        s = shared[lo:lo + 4096]
        at = np.where(np.arange(WIDTH) >= s[:, None], np.arange(1, len(s) + 1)[:, None], 0)
        at = np.maximum.accumulate(at, axis=0)
        part = np.concatenate([carry[None], rows[lo:lo + 4096]])
        out[lo:lo + 4096] = np.take_along_axis(part, at, axis=0)
        carry = out[lo + len(s) - 1]
    return out


def _runs(parts: int, hot: np.ndarray):
    def spans(key, lo, hi):
        return [(p, 2, pack(*x)) for p, x in split(_deal(key, parts), key, lo.astype(np.uint32), hi.astype(np.uint32))]

    def flush(held):
        rows, right, left, key, pos, h = (np.concatenate(x) for x in zip(*held))
        o = np.lexsort((pos, key, left, right, rows.view(f"S{WIDTH}")[:, 0]))
        rows, right, left, key, pos, h = rows[o], right[o], left[o], key[o], pos[o], h[o]
        same = (_shared(rows) == WIDTH) & (np.diff(right, prepend=0) == 0) & (np.diff(left, prepend=0) == 0)
        if len(same):
            same[0] = False
        first = np.flatnonzero(~same)
        lead = np.repeat(first, np.diff(np.append(first, len(same))))
        again = same & ((key != key[lead]) | (pos != pos[lead]))  # a repeated row is no earlier place
        yield _blobs(spans(key[again], pos[again] - left[again], pos[again] + right[again]))
        part = (h[first] % np.uint64(parts)).astype(np.int64)
        for p, (r, a, b, k, x) in split(part, rows[first], right[first], left[first], key[first], pos[first]):
            shared, own = front_code(r, a, b)
            yield _blobs([(p, 0, pack(shared, a, b, k, x.astype(np.uint32), own))])

    def windows(buf, text_at, key, pos, lo, hi):
        """Each window of the hot anchors by its digest."""
        n = hi - lo + 1
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        raw = buf.tobytes()
        digest = np.array([hashlib.blake2b(raw[i:i + LENGTH], digest_size=16).digest() for i in at], "S16")
        return digest.view("<u8").reshape(-1, 2), np.repeat(key, n), at - np.repeat(text_at, n)

    def flush_hot(held):
        d, key, pos = (np.concatenate(x) for x in zip(*held))
        o = np.lexsort((pos, key, d[:, 1], d[:, 0]))
        d, key, pos = d[o], key[o], pos[o]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]).any(axis=1)
        lead = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(d))))
        again = (key != key[lead]) | (pos != pos[lead])
        yield _blobs(spans(key[again], pos[again], pos[again] + LENGTH))
        f = np.flatnonzero(new)
        yield _blobs((p, 1, pack(*x)) for p, x in split((d[f, 0] % np.uint64(parts)).astype(np.int64), d[f, 0], d[f, 1], key[f], pos[f]))

    @released

    def run(batches):
        powers, ck, cp, cands, held, warm, n, m = _Powers(), [], [], None, [], [], 0, 0
        for b in batches:
            kinds = b.column("kind").to_numpy(zero_copy_only=False)
            for data in b.column("text").filter(pa.array(kinds == 0)).to_pylist():
                key, pos = unpack(data)
                ck.append(key)
                cp.append(pos)
            b = b.filter(pa.array(kinds == 1))
            if not b.num_rows:
                continue
            if cands is None:
                key, pos = (np.concatenate(ck).astype(np.int64), np.concatenate(cp).astype(np.int64)) if ck else (np.zeros(0, np.int64),) * 2
                docs = np.unique(key)
                cands = np.sort(np.searchsorted(docs, key) << 32 | pos)
                ck = cp = []
            keys, texts = _read(b)
            some = np.flatnonzero(np.isin(keys, docs))
            for fk, fb, buf, ends in _fragments(keys[some], [texts[i] for i in some]):
                pos, lo, hi, h = anchors(buf, ends, powers)
                doc = np.searchsorted(ends, pos, side="right")
                key, at = fk[doc], np.concatenate([[0], ends[:-1]])[doc] - fb[doc]
                own = np.searchsorted(docs, key) << 32 | (pos - at)
                pick = np.flatnonzero(cands[np.clip(np.searchsorted(cands, own), 0, len(cands) - 1)] == own)
                isin = np.isin(h[pick], hot)
                for chosen in (pick[isin][k:k + 4096] for k in range(0, isin.sum(), 4096)):
                    warm.append(windows(buf, at[chosen], key[chosen], pos[chosen], lo[chosen], hi[chosen]))
                    m += len(warm[-1][1])
                pick = pick[~isin]
                rows, right, left = _matrix(buf, pos[pick], lo[pick], hi[pick])
                held.append((rows, right, left, key[pick], (pos - at)[pick], h[pick]))
                n += len(pick)
                if n >= HELD // 5:
                    yield from flush(held)
                    held, n = [], 0
                if m >= HELD:
                    yield from flush_hot(warm)
                    warm, m = [], 0
        if n:
            yield from flush(held)
        if m:
            yield from flush_hot(warm)

    return run


# -- 3: loser tree ---------------------------------------------------------------

def loser_tree(runs: list[tuple[list, list]]):
    """Merge of sorted runs of equally long byte strings: yields (run, index,
    length of the prefix shared with the string before).

    ``runs``: (strings, prefix lengths shared with the run's string before).
    Each inner node holds the loser of its match and the prefix it shares with the
    winner. All players on the winner's way up therefore know what they share with the last
    output: the longer known prefix is the smaller string, and only equally long
    ones are compared, behind it."""
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    shares = [r[1] for r in runs] + [[]] * (k - len(runs))
    sizes = [len(s) for s in strings]
    at = [0] * k
    head = [s[0] if s else None for s in strings]
    width = next((len(s[0]) for s in strings if s), 0)
    number = int.from_bytes
    loser, known = [0] * k, [0] * k

    def match(a, ha, b, hb):
        """(winner, its known prefix, loser, the prefix the loser shares with the winner)."""
        x, y = head[a], head[b]
        if y is None:
            return a, ha, b, 0
        if x is None:
            return b, hb, a, 0
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        u, v = number(x[ha:], "big"), number(y[ha:], "big")
        if u == v:
            return (a, ha, b, width) if a < b else (b, hb, a, width)
        h = width - ((u ^ v).bit_length() + 7) // 8
        return (a, ha, b, h) if u < v else (b, hb, a, h)

    def play(node):
        if node >= k:
            return node - k, 0
        a, ha = play(2 * node)
        b, hb = play(2 * node + 1)
        w, hw, loser[node], known[node] = match(a, ha, b, hb)
        return w, hw

    w, h = play(1) if k > 1 else (0, 0)
    while head[w] is not None:
        i = at[w]
        yield w, i, h
        i += 1
        at[w] = i
        if i < sizes[w]:
            head[w], h = strings[w][i], shares[w][i]
        else:
            head[w], h = None, 0
        node = (w + k) // 2
        while node:
            b, hb = loser[node], known[node]
            # The common case in line: different known prefixes.
            if h > hb and head[w] is not None or head[b] is None:
                pass
            else:
                w, h, loser[node], known[node] = match(w, h, b, hb)
            node //= 2


def _classes(shared, right, left, back, order):
    """First and last offset at which an item's window repeats an earlier one
    (SPREAD + 1 and -1: none).

    ``shared``: prefix lengths along the merged order; ``back``: the reversed
    left sides; ``order``: rank of the place (smaller: earlier)."""
    n = len(shared)
    low, high = np.full(n, SPREAD + 1), np.full(n, -1)
    by = np.argsort(back.view(f"S{SPREAD}")[:, 0], kind="stable")
    b = back[by]
    common = np.zeros(n, np.int64)
    if n > 1:
        diff = b[1:] != b[:-1]
        common[1:] = np.where(diff.any(axis=1), diff.argmax(axis=1), SPREAD)
    lc = np.empty(n, np.int64)
    for o in range(SPREAD + 1):
        at = np.flatnonzero((left >= o) & (right >= LENGTH - o))
        if len(at) < 2:
            continue
        lc[by] = np.cumsum(common < o)
        c = np.cumsum(shared < LENGTH - o)[at] * (n + 1) + lc[at]
        s = np.lexsort((order[at], c))
        c, rank = c[s], order[at][s]
        first = np.flatnonzero(np.diff(c, prepend=-1))
        lead = np.repeat(rank[first], np.diff(np.append(first, len(c))))
        again = at[s[rank > lead]]
        low[again] = np.minimum(low[again], o)
        high[again] = o
    return low, high


def _merge(parts: int):
    @released
    def run(batches):
        runs, hot, out = [], [], []
        for b in batches:
            for kind, data in zip(b.column("kind").to_pylist(), b.column("data").to_pylist()):
                if kind == 0:
                    runs.append(unpack(data))
                elif kind == 1:
                    hot.append(unpack(data))
                else:
                    key, lo, hi = unpack(data)
                    out += [(p, 0, pack(*x)) for p, x in split(_deal(key, parts), key, lo, hi)]
        found = []
        if runs:
            rows = [front_decode(s, a, b, own) for s, a, b, _, _, own in runs]
            players = [([r.tobytes() for r in m], x[0].tolist()) for m, x in zip(rows, runs)]
            base = np.cumsum([0] + [len(m) for m in rows])
            at, shared = [], []
            for r, i, h in loser_tree(players):
                at.append(base[r] + i)
                shared.append(h)
            del players
            at, shared = np.array(at), np.array(shared)
            right, left, key, pos = (np.concatenate([x[i] for x in runs])[at] for i in (1, 2, 3, 4))
            back = np.concatenate([m[:, LENGTH:] for m in rows])[at]
            del rows
            # Only items that share a gram with a neighbour can have an equal window.
            near = np.maximum(shared, np.append(shared[1:], 0)) >= GRAM
            pick = np.flatnonzero(near)
            if len(pick):
                # What two picked neighbours share is the least of the steps between them.
                shared = np.minimum.reduceat(shared[:pick[-1] + 1], np.concatenate([[0], pick[:-1] + 1]))
                k, p, r, q = key[pick], *(x[pick].astype(np.int64) for x in (pos, right, left))
                o = np.lexsort((p, k))
                place = np.zeros(len(pick), np.int64)
                place[o] = np.cumsum((np.diff(k[o], prepend=k[o[0]]) != 0) | (np.diff(p[o], prepend=p[o[0]]) != 0))
                low, high = _classes(shared, r, q, np.ascontiguousarray(back[pick]), place)
                d = high >= 0
                found.append((k[d], p[d] - high[d], p[d] - low[d] + LENGTH))
        if hot:
            d0, d1, key, pos = (np.concatenate(x) for x in zip(*hot))
            o = np.lexsort((pos, key, d1, d0))
            d0, d1, key, pos = d0[o], d1[o], key[o], pos[o].astype(np.int64)
            new = np.ones(len(o), bool)
            new[1:] = (d0[1:] != d0[:-1]) | (d1[1:] != d1[:-1])
            lead = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(o))))
            d = (key != key[lead]) | (pos != pos[lead])
            found.append((key[d], pos[d], pos[d] + LENGTH))
        for key, lo, hi in found:
            out += [(p, 0, pack(*x)) for p, x in split(_deal(key, parts), key, lo.astype(np.uint32), hi.astype(np.uint32))]
        yield _blobs(out)

    return run


# -- 4: removal ------------------------------------------------------------------

def _union(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the intervals' union."""
    o = np.argsort(lo, kind="stable")
    lo, hi = lo[o].astype(np.int64), np.maximum.accumulate(hi[o].astype(np.int64))
    first = np.ones(len(lo), bool)
    first[1:] = lo[1:] > hi[:-1]
    f = np.flatnonzero(first)
    return list(zip(lo[f].tolist(), hi[np.append(f[1:], len(lo)) - 1].tolist()))


def _cut(n: int):
    @released
    def run(batches):
        held, cuts = [], None
        for b in batches:
            kinds = b.column("kind").to_numpy(zero_copy_only=False)
            held += [unpack(x) for x in b.column("text").filter(pa.array(kinds == 0)).to_pylist()]
            b = b.filter(pa.array(kinds == 1))
            if not b.num_rows:
                continue
            if cuts is None:
                key, lo, hi = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64),) * 3
                o = np.argsort(key, kind="stable")
                cuts, held = (key[o], lo[o], hi[o]), []
            keys = b.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
            left, right = np.searchsorted(cuts[0], keys), np.searchsorted(cuts[0], keys, side="right")
            kept, spans = [], []
            for i, t in enumerate(b.column("text")):
                t = t.as_py()
                runs = _union(cuts[1][left[i]:right[i]], cuts[2][left[i]:right[i]]) if right[i] > left[i] else []
                spans.append([{"s": s, "e": e} for s, e in runs])
                if runs:
                    edge = [0, *(x for r in runs for x in r), len(t)]
                    t = b"".join(t[edge[k]:edge[k + 1]] for k in range(0, len(edge), 2))
                kept.append(t)
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(b.column(f"c{i}") for i in range(n)), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                                             names=[*(f"c{i}" for i in range(n)), "kept", "spans"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                   parts: int | None = None, hot: int = HOT) -> DataFrame:
    """The ``carry`` columns (default: all), ``kept`` (the bytes that stay) and
    ``spans`` array<struct<s, e>> (removed runs, byte offsets), a row per document.

    ``parts`` (default: the shuffle partitions) deals all exchanges; a gram is
    hot from ``hot`` occurrences on if it also makes a quarter of its bucket."""
    carry = docs.columns if carry is None else carry
    inner = [f"c{i}" for i in range(len(carry))]
    p = parts or partitions(docs)
    rows, _ = ordered(docs, id_col, text_col, carry, inner)
    texts = rows.select("key", "text")

    buckets = texts.mapInArrow(_count(p), _BLOB).repartitionById(p, "part")
    cands = materialize(buckets.mapInArrow(_repeated(p, hot), _BLOB), "grams")
    large = [np.frombuffer(b"", np.uint64)] + [unpack(bytes(r["data"]))[0] for r in cands.where("kind = 1").select("data").collect()]
    large = np.concatenate(large)  # at most four a bucket

    def beside(blobs: DataFrame, full: DataFrame) -> DataFrame:
        """Blobs first, then the texts, by the documents' partition."""
        nulls = [F.lit(None).cast(full.schema[c].dataType).alias(c) for c in full.columns if c not in ("key", "text")]
        a = blobs.select("part", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("key"), F.col("data").alias("text"), *nulls)
        b = full.select(_dealt("key", p).alias("part"), F.lit(1).alias("kind"), *full.columns)
        return a.unionByName(b).repartitionById(p, "part").sortWithinPartitions("kind")

    runs = beside(cands.where("kind = 0"), texts).mapInArrow(_runs(p, large), _BLOB)
    spans = runs.repartitionById(p, "part").mapInArrow(_merge(p), _BLOB)
    schema = ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in inner),
                        "kept binary", "spans array<struct<s:bigint,e:bigint>>"])
    out = beside(spans, rows).mapInArrow(_cut(len(inner)), schema)
    return out.toDF(*carry, "kept", "spans")


def _decoded(n: int):
    @released
    def run(batches):
        for b in batches:
            out = []
            for t, spans in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
                edge, gone = [0], 0
                for x in spans:  # where the pieces meet
                    edge.append(x["s"] - gone)
                    gone += x["e"] - x["s"]
                edge.append(len(t))
                out.append("".join(t[a:z].decode("utf-8", "ignore") for a, z in zip(edge, edge[1:])))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(n)), pa.array(out, pa.string())],
                                             names=[*(f"c{i}" for i in range(n)), "text"])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated strings cut out of the text (NULL becomes empty);
    a character that a cut runs through goes with it."""
    rest = [c for c in docs.columns if c != text_col]
    found = remove_repeats(docs, id_col, text_col, rest, **options)
    rows = found.toDF(*(f"c{i}" for i in range(len(rest))), "kept", "spans")
    schema = ", ".join([*(f"c{i} {rows.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(rest))), "text string"])
    return rows.mapInArrow(_decoded(len(rest)), schema).toDF(*rest, text_col).select(*[col(c) for c in docs.columns])
