"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of two-word shingles (A-Z lower-cased). Two collections of
``SIDE`` sub-keys, each of two minhashes, are drawn once; a table is a pair of
sub-keys, one of each collection, so 4 * SIDE minhashes serve SIDE * SIDE
tables of four-minhash keys. Two documents of similarity s miss each other in all tables
with probability 2 (1 - s^2)^SIDE or less: 1e-5 at s = 0.8.

Candidates are verified on full sets, without ever listing the pairs of a group:

1. Documents with equal sets are one text from here on.
2. Tables give groups of texts. A text's standing is the summed size of its groups;
   each group sends its members to its member of highest standing, the centre
   (in a family of edited copies, the original). A centre's members are
   compared with it exactly, those whose sketches are far apart excepted.
3. Members that are not linked to their centre are compared exactly with all other
   members of that centre, in blocks: a block of such members is an inverted
   index, the centre's members stream past it. What is known about the centre
   prunes exactly (the symmetric difference is a metric). Only links that join
   different texts of a block's own components leave the task.
4. Links are joined to connected components by min-label stars.

Scale: table keys leave a task as packed blobs, a hot centre's members are dealt by
salt, and nothing of a group is collected in one place but one block.

Rules: a NULL or wordless text has the empty set, links with nothing and is its own
component; one word is a set of one; rows that share an id are ordered by
their text's hash; rows without id come first and their component has a NULL id if
it holds one of them; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, components, materialize, ordered, pack, partitions, released, split, unpack, with_keys

SIDE = 12  # sub-keys of a collection
HASHES = 4 * SIDE
NEAR = 14  # of HASHES sketch values must agree: similarity 0.5 falls short with probability 2e-3, 0.8 with 1e-13
BLOCK = 1 << 20
INDEX, INDEX_SETS = 2048, 1 << 20  # texts of a block's inverted index, and their shingles
SALT = 128  # members per block that are compared with a centre
PEERS = 2048  # members per block that are compared with an index
_MIX = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    ink = np.ones(256, bool)
    ink[[32, 9, 10, 11, 12, 13]] = False
    return lower, ink


def shingle_sets(texts: list[bytes], words: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other,
    and each text's number of them."""
    out, sizes = [], []
    for lo, hi in _chunks(texts):
        h, n = _sets(texts[lo:hi], words)
        out.append(h)
        sizes.append(n)
    return (np.concatenate(out), np.concatenate(sizes)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _chunks(texts):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def shingle_sequence(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts by position, and the text of each."""
    lower, ink_of = _tables()
    # A separator behind each text keeps words apart.
    buf = lower[np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    ink = ink_of[buf]
    begin = np.flatnonzero(ink & ~np.concatenate([[False], ink[:-1]]))
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(ink)
    first = np.searchsorted(at, begin)
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    power = np.cumprod(np.full(int(within.max()) + 1, _MIX, np.uint64))
    word = _mix(np.add.reduceat((buf[at].astype(np.uint64) + np.uint64(1)) * power[within], first))
    doc = np.searchsorted(ends, begin, side="right")
    n = np.bincount(doc, minlength=len(texts))
    # Shingles of k words; a text of fewer is one shingle of all its words.
    size = np.minimum(k, n)[doc]
    rank = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
    start = np.flatnonzero(rank + size <= n[doc])
    h = np.zeros(len(start), np.uint64)
    for j in range(k):
        use = size[start] > j
        h[use] = _mix(h[use] * np.uint64(3) + word[start[use] + j] + np.uint64(j + 1))
    return h, doc[start]


def _sets(texts, k):
    h, owner = shingle_sequence(texts, k)
    o = np.lexsort((h, owner))
    h, owner = h[o], owner[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(texts))


def _coefficients() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Minhashes (texts x HASHES) of sets that are not empty."""
    at = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), HASHES), np.uint32)
    for i, a in enumerate(_coefficients()):
        v = h * a
        v ^= v >> np.uint64(32)
        out[:, i] = np.minimum.reduceat((v * np.uint64(_MIX) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _sketch(words: int):
    @released
    def run(batches):
        for b in batches:
            # Chunk by chunk: what is worked on at a time stays small beside the batch.
            text, lo = b.column("text"), 0
            while lo < b.num_rows:
                texts, size = [], 0
                while lo + len(texts) < b.num_rows and size < BLOCK:
                    texts.append(text[lo + len(texts)].as_py())
                    size += len(texts[-1])
                part = b.slice(lo, len(texts))
                lo += len(texts)
                h, n = _sets(texts, words)
                some = np.flatnonzero(n)
                at = (np.cumsum(n) - n)[some]
                h1, h2, raw = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), [None] * len(n)
                if len(some):  # the set's own name: two sums of mixed members
                    h1[some] = np.add.reduceat(_mix(h + np.uint64(1)), at)
                    h2[some] = np.add.reduceat(_mix(h ^ np.uint64(_MIX)), at)
                    for i, row in zip(some.tolist(), sketches(h, n[some])):
                        raw[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                     pa.array(raw, pa.binary())], names=["key", "n", "h1", "h2", "sketch"])

    return run


def table_keys(mh: np.ndarray) -> np.ndarray:
    """Keys (texts x SIDE * SIDE): each sub-key of one collection with each of the other."""
    pair = mh.astype(np.uint64).reshape(len(mh), 2, SIDE, 2)
    sub = _mix((pair[..., 0] << np.uint64(32) | pair[..., 1]) + np.arange(1, 2 * SIDE + 1, dtype=np.uint64).reshape(2, SIDE))
    return _mix(sub[:, 0, :, None] * np.uint64(5) + sub[:, 1, None, :]).reshape(len(mh), SIDE * SIDE)


def _emit(parts: int):
    def flush(keys, raws):
        key = np.array(keys, np.int64)
        t = table_keys(np.frombuffer(b"".join(raws), np.uint32).reshape(-1, HASHES)).ravel()
        row = np.repeat(np.arange(len(key), dtype=np.uint32), SIDE * SIDE)
        rows = [(p, pack(h, r, key)) for p, (h, r) in split((t % np.uint64(parts)).astype(np.int64), t, row)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                          names=["part", "data"])

    @released

    def run(batches):
        keys, raws = [], []
        for b in batches:
            keys += b.column("key").to_pylist()
            raws += b.column("sketch").to_pylist()
            while len(keys) >= 8192:
                yield flush(keys[:8192], raws[:8192])
                keys, raws = keys[8192:], raws[8192:]
        if keys:
            yield flush(keys, raws)

    return run


@released
def _groups(batches):
    """(table key, text, size) of every key that two texts share."""
    hs, ks = [], []
    for b in batches:
        for data in b.column("data").to_pylist():
            h, row, key = unpack(data)
            hs.append(h)
            ks.append(key[row])
    if hs:
        h, k = np.concatenate(hs), np.concatenate(ks)
        o = np.argsort(h, kind="stable")
        h, k = h[o], k[o]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.repeat(np.diff(np.append(first, len(h))), np.diff(np.append(first, len(h))))
        at = np.flatnonzero(size > 1)
        for lo in range(0, len(at), 100_000):
            s = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(h[s].view(np.int64)), pa.array(k[s]), pa.array(size[s].astype(np.int64))],
                                             names=["g", "x", "size"])


@released
def _agreeing(batches):
    for b in batches:
        a = np.frombuffer(b"".join(b.column("sa").to_pylist()), np.uint32).reshape(-1, HASHES)
        c = np.frombuffer(b"".join(b.column("sb").to_pylist()), np.uint32).reshape(-1, HASHES)
        keep = pa.array((a == c).sum(axis=1) >= NEAR)
        yield pa.RecordBatch.from_arrays([b.column("x").filter(keep), b.column("centre").filter(keep)], names=["x", "centre"])


def _linked(inter, a, b, percent):
    return 100 * inter >= percent * (a + b - inter)


def _compare(percent: int, words: int, every: bool):
    """Streams of (block, role, key, far, text), by block and role: role 0 are the
    index's texts, role 1 those compared with it. ``far``: size of the symmetric
    difference to the centre. Gives every comparison, or links alone."""
    def index(rows):
        h, n = shingle_sets([r[3] for r in rows], words)
        token, at = np.unique(h, return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), n)
        o = np.argsort(at, kind="stable")
        start = np.searchsorted(at[o], np.arange(len(token) + 1))
        return [r[1] for r in rows], n, np.array([r[2] for r in rows]), token, owner[o], start

    @released

    def run(batches):
        block, held, idx, root, out = None, [], None, None, []

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def compare(rows):
            keys, n, far, token, owner, start = idx
            h, m = shingle_sets([r[3] for r in rows], words)
            at = np.cumsum(m) - m
            for (_, y, fy, _), lo, k in zip(rows, at, m):
                own = h[lo:lo + k]
                near = np.ones(len(n), bool) if every else np.abs(far - fy) * (100 + percent) <= (100 - percent) * (n + k)
                if not near.any():
                    continue
                p = np.searchsorted(token, own)
                p = p[token[np.minimum(p, len(token) - 1)] == own]
                size = start[p + 1] - start[p]
                post = owner[np.repeat(start[p] - (np.cumsum(size) - size), size) + np.arange(size.sum())] if len(p) else p
                inter = np.bincount(post, minlength=len(n))
                if every:
                    out.extend((y, keys[i], int(inter[i]), int(k), int(n[i])) for i in range(len(n)))
                    continue
                met = None
                for i in np.flatnonzero(near & _linked(inter, n, k, percent)).tolist():
                    if keys[i] == y:
                        continue
                    if met is None:
                        met = i
                    elif find(i) == find(met):
                        continue  # y joins a component of the index that it has joined
                    root[find(i)] = find(met)
                    out.append((y, keys[i], int(inter[i]), int(k), int(n[i])))

        def done():
            rows = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                              names=["x", "y", "inter", "nx", "ny"])
            out.clear()
            return rows

        for b in batches:
            late, size = [], 0
            for r in zip(*(b.column(c).to_pylist() for c in ("block", "role", "key", "far", "text"))):
                if r[0] != block:
                    if late:
                        compare(late)
                        late, size = [], 0
                    block, held, idx = r[0], [], None
                if r[1] == 0:
                    held.append(r[1:])
                    continue
                if not held:
                    continue
                if idx is None:
                    idx, root = index(held), list(range(len(held)))
                late.append(r[1:])
                size += len(r[4])
                if size >= BLOCK:
                    compare(late)
                    late, size = [], 0
            if late:
                compare(late)
            if len(out) >= 1000:
                yield done()
        yield done()

    return run


_LINKS = "x bigint, y bigint, inter bigint, nx bigint, ny bigint"


def _streamed(index: DataFrame, members: DataFrame, texts: DataFrame, percent: int, words: int, every: bool, parts: int) -> DataFrame:
    """``index`` and ``members``: (block, key, far)."""
    both = index.withColumn("role", F.lit(0)).unionByName(members.withColumn("role", F.lit(1)))
    rows = both.join(texts, "key").select("block", "role", "key", "far", "text")
    return (rows.repartition(parts, "block").sortWithinPartitions("block", "role", "key")
            .mapInArrow(_compare(percent, words, every), _LINKS))


def _salt(key: str, salts: str):
    return F.pmod(F.xxhash64(key), F.col(salts))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                    percent: int = 80, words: int = 2) -> DataFrame:
    """The ``carry`` columns (default: all), ``n_shingles``, ``component`` (the id of the
    component's first document) and ``kept`` (whether the row is that document; one of
    repeated rows is as good as the other and all are kept)."""
    carry = docs.columns if carry is None else carry
    inner = [f"c{i}" for i in range(len(carry) + 1)]
    p = partitions(docs)
    rows, plain = ordered(docs, id_col, text_col, [*carry, id_col], inner)
    made = rows.select("key", "text").mapInArrow(_sketch(words), "key bigint, n bigint, h1 bigint, h2 bigint, sketch binary")
    made = materialize(made if plain else made.dropDuplicates(["key"]), "sketches")

    sets = materialize(made.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("x"), F.first("sketch").alias("sketch")), "sets")
    keyed = sets.select(F.col("x").alias("key"), "sketch")
    blobs = keyed.mapInArrow(_emit(p), "part int, data binary").repartitionById(p, "part")
    entries = materialize(blobs.mapInArrow(_groups, "g bigint, x bigint, size bigint"), "tables")

    standing = entries.groupBy("x").agg(F.sum("size").alias("s"))
    ranked = entries.select("g", "x").join(standing, "x")
    centre = ranked.groupBy("g").agg(F.max(F.struct("s", -F.col("x"))).alias("m")).select("g", (-F.col("m")["col2"]).alias("centre"))
    pairs = entries.select("g", "x").join(centre, "g").where("x <> centre").select("x", "centre").distinct()
    sk = sets.select("x", "sketch")
    near = (pairs.join(sk.withColumnRenamed("sketch", "sa"), "x")
            .join(sk.select(F.col("x").alias("centre"), F.col("sketch").alias("sb")), "centre")
            .select("x", "centre", "sa", "sb").mapInArrow(_agreeing, "x bigint, centre bigint"))
    near = materialize(near, "near")

    need = near.select(F.col("x").alias("key")).unionByName(near.select(F.col("centre").alias("key"))).distinct()
    need = materialize(need, "need")
    texts = materialize(with_keys(rows.select("key", "text"), need).dropDuplicates(["key"]), "texts")

    far0 = F.lit(0).cast("bigint").alias("far")
    # Small tables of counts are written, so that these joins can be split by AQE.
    count = materialize(near.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / SALT).alias("salts")), "salts")
    salted = near.join(count, "centre").withColumn("block", F.concat_ws("/", "centre", _salt("x", "salts")))
    first = _streamed(salted.select("block", F.col("centre").alias("key"), far0).distinct(),
                      salted.select("block", F.col("x").alias("key"), far0), texts, percent, words, True, p)
    first = materialize(first, "first").withColumn("ok", F.expr(f"100 * inter >= {percent} * (nx + ny - inter)"))
    links = first.where("ok").select(F.col("x").alias("a"), F.col("y").alias("b"))

    # Members that are in another component than their centre, against its other members (within
    # a component there is nothing left to join, and of two members of different components one is
    # not in the centre's). Their distance from the centre (size of the symmetric difference) puts
    # them in bands, and a member goes only to the bands that the triangle inequality leaves it.
    comp = components(links)
    root_of = lambda node, root: comp.select(F.col("node").alias(node), F.col("root").alias(root))
    far = first.select(F.col("y").alias("centre"), F.col("x").alias("key"), (F.col("nx") + F.col("ny") - 2 * F.col("inter")).alias("far"), "nx", "ok")
    far = far.withColumn("band", F.least(F.lit(64).cast("bigint"), F.floor(16 * F.col("far") / F.col("nx"))))
    reach = F.col("nx") * (100 - percent) / percent  # of linked sets: far differs by no more
    apart = materialize(far.where("NOT ok").join(root_of("key", "rk"), "key", "left").join(root_of("centre", "rc"), "centre", "left")
                        .where("coalesce(rk, key) <> coalesce(rc, centre)").select(*far.columns), "apart")
    # a group whose index fits one block is one band: each of its texts is read once
    whole = apart.groupBy("centre").agg((F.count(F.lit(1)) <= INDEX).alias("few"), (F.sum("nx") <= INDEX_SETS).alias("short"))
    apart = materialize(apart.join(whole, "centre").withColumn("band", F.when(F.col("few") & F.col("short"), 0).otherwise(F.col("band"))), "banded")
    bands = apart.groupBy("centre", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / INDEX), F.ceil(F.sum("nx") / INDEX_SETS)).alias("blocks"),
        F.min(F.col("far") - reach).alias("lo"), F.max(F.col("far") + reach).alias("hi"))
    bands = materialize(bands, "bands")
    root = F.coalesce("root", "x")
    named = sets.select("h1", "h2", "x").join(comp, F.col("x") == F.col("node"), "left").select("h1", "h2", root.alias("root"))
    if bands.limit(1).collect():
        peers = near.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / PEERS).alias("salts"))
        peers = materialize(peers.join(bands.select("centre").distinct(), "centre", "left_semi"), "salts")
        loose = apart.select("centre", "band", "key", "far").join(bands, ["centre", "band"]).join(peers, "centre")
        block = F.concat_ws("/", "centre", "band", _salt("key", "blocks"))
        index = loose.withColumn("s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))).select(
            F.concat_ws("/", block, "s").alias("block"), "key", "far")
        per = materialize(bands.groupBy("centre").agg(F.collect_list(F.struct("band", "blocks", "lo", "hi")).alias("bands")), "bands")  # 65 at most
        others = far.drop("band").join(per, "centre").join(peers, "centre")
        others = others.withColumn("w", F.explode(F.expr("filter(bands, w -> far BETWEEN w.lo AND w.hi)")))
        others = others.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("w.blocks") - 1)))
        others = others.select(F.concat_ws("/", "centre", "w.band", "k", _salt("key", "salts")).alias("block"), "key", "far")
        index = index.join(others.select("block").distinct(), "block", "left_semi")
        second = _streamed(index, others, texts, percent, words, False, p).select(F.col("x").alias("a"), F.col("y").alias("b"))
        # links between the components so far; the least node of a component is its name
        joined = (second.join(root_of("a", "ra"), "a", "left").join(root_of("b", "rb"), "b", "left")
                  .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct())
        wider = components(materialize(joined, "second")).withColumnsRenamed({"node": "part", "root": "whole"})
        named = named.join(wider, F.col("root") == F.col("part"), "left").select("h1", "h2", F.coalesce("whole", "root").alias("root"))

    verdict = made.select(F.col("key").alias("k"), "n", "h1", "h2").join(
        named.withColumnsRenamed({"h1": "g1", "h2": "g2"}), (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n") > 0), "left")
    verdict = materialize(verdict.select("k", "n", F.coalesce("root", "k").alias("root")), "verdict")
    out = rows.select(*inner, "key").join(verdict, F.col("key") == F.col("k"))
    ident = F.col("root")
    if not plain:
        names = rows.select(F.col("key").alias("named"), F.col(inner[-1]).cast("bigint").alias("root_id")).distinct()
        out, ident = out.join(names, F.col("root") == F.col("named")), F.col("root_id")
    return out.select(*inner[:-1], F.col("n").alias("n_shingles"), ident.alias("component"), (F.col("root") == F.col("key")).alias("kept")).toDF(
        *carry, "n_shingles", "component", "kept")

