"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into three machines: the normaliser N (dummy prefix,
spaces to the meta symbol), the piece lexicon P (a transducer from characters to
piece ids, with byte fallback for characters that no piece has) and the bigram
acceptor B, which gives an adjacent pair of pieces weight 0 or infinity. An
input is composed with N and P to a lattice, and with B by keeping as state the piece that
was read last; the encoding is the shortest path in the tropical semiring
(min, +).

For a BPE model a segmentation is the merge procedure's own exactly if each
adjacent pair is what the procedure makes of that pair's text, and each prefix
has one such segmentation. So B's weights follow from the merges of two pieces, are
worked out on first use and kept, and the state space is one piece per position:
the path is found in one left-to-right pass, linear in the text.

For a unigram model B is empty and a piece costs its negative log probability.

Pieces never run over the start of a word, so a text is cut there and the paths
of words are kept. Supported are identity normalisers; a model with a character map or
user-defined symbols is refused.

Rules: a NULL text has NULL ids; an empty text has none; decoding turns ill-formed bytes
into U+FFFD; repeated rows give equal rows.
"""

from __future__ import annotations

import re
import struct
import sys
import types
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, released

META = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
INF = float("inf")
ROWS = 512
HELD = 150_000  # words in each of two generations of the cache


def _cache() -> dict:
    """One dict per Python worker (tasks unpickle their code anew)."""
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__


def _fields(buf: bytes):
    """(number, value) of a serialised protocol message."""
    pos = 0

    def varint():
        nonlocal pos
        v = shift = 0
        while True:
            b = buf[pos]
            pos += 1
            v |= (b & 127) << shift
            shift += 7
            if b < 128:
                return v

    while pos < len(buf):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            n = varint()
            yield tag >> 3, buf[pos:pos + n]
            pos += n
        elif tag & 7 in (1, 5):
            n = 8 if tag & 7 == 1 else 4
            yield tag >> 3, buf[pos:pos + n]
            pos += n
        else:
            raise ValueError("not a SentencePiece model")


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, raw: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        self.bpe, self.prefix, self.squeeze, escape = False, True, True, True
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode("utf-8"))
                self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.kinds.append(f.get(3, NORMAL))
            elif number == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2):
                    raise ValueError("character maps are not supported")
                self.prefix, self.squeeze, escape = (bool(f.get(k, 1)) for k in (3, 4, 5))
        if not escape or USER_DEFINED in self.kinds:
            raise ValueError("user-defined symbols and unescaped spaces are not supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.unk = self.kinds.index(UNKNOWN)
        # A character that no piece has costs more than any piece.
        self.alone = 10.0 - min(self.scores, default=0.0)
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        if any(META in p.lstrip(META) for p in self.ids):
            self.cut, self.by_word = re.compile("(?s).+"), False
        else:  # no piece runs over the start of a word, nor over a character that only stands alone
            alone = "".join(c for c in "\n\t\r" if c not in inside)
            self.by_word = True
            self.cut = re.compile(f"[{alone}]|{META}+[^{META}{alone}]*|[^{META}{alone}]+" if alone else f"{META}+[^{META}]*|[^{META}]+")
        self.out = []
        for p, k in zip(self.pieces, self.kinds):
            self.out.append(bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                            " ⁇ ".encode() if k == UNKNOWN else p.replace(META, " ").encode())
        self.is_byte = [k == BYTE for k in self.kinds]
        self.size = [len(p) for p in self.pieces]
        self.pairs: dict = {}
        self.prefixes: dict = {}
        self.words: dict = {}
        self.older: dict = {}
        self.outputs = np.array([*self.out, b""], object)[:-1]

    @cached_property
    def trie(self) -> dict:
        """The lexicon by reversed pieces, built for encoding only."""
        out: dict = {}
        for p, i in self.ids.items():
            node = out
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = i
        return out

    # N
    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = text.replace(" ", META)
        return META + text if self.prefix else text

    # B
    def merged(self, text: str) -> list[str]:
        """The merge procedure on a short text: best-scoring pair first, leftmost of equals."""
        s = list(text)
        get, scores = self.ids.get, self.scores
        value = [-INF if (k := get(a + b)) is None else scores[k] for a, b in zip(s, s[1:])]
        while value:
            best = max(value)
            if best == -INF:
                break
            at = value.index(best)
            s[at:at + 2] = [s[at] + s[at + 1]]
            del value[at]
            for i in (at - 1, at):
                if 0 <= i < len(value):
                    k = get(s[i] + s[i + 1])
                    value[i] = -INF if k is None else scores[k]
        return s

    def allowed(self, left: int, right: int) -> bool:
        """Whether weight is 0 (not infinite) for ``right`` after ``left`` (-1: at a word's start)."""
        if len(self.pairs) > 250_000:
            self.pairs.clear()
        want = [self.name(left), self.name(right)] if left != -1 else [self.name(right)]
        got = self.pairs[left << 21 | right] = self.merged("".join(want)) == want
        return got

    def name(self, state: int) -> str:
        """A state is a piece's id, or behind those a character that no piece has."""
        return self.pieces[state] if state < len(self.pieces) else chr(state - len(self.pieces))

    # shortest path
    def ending(self, word: str, end: int) -> list:
        """(start, state) of the arcs that end at ``end``, shortest first: pieces by the
        lexicon's reversed trie, and the character alone."""
        node, i, found = self.trie, end, []
        while i:
            i -= 1
            node = node.get(word[i])
            if node is None:
                break
            k = node.get("")
            if k is not None:
                found.append((i, k))
        if not found or found[0][0] != end - 1:
            found.insert(0, (end - 1, len(self.pieces) + ord(word[end - 1])))
        return found

    def last(self, word: str, end: int, memo: dict) -> int:
        """Last state of the only path of weight 0 over ``word[:end]``; only
        the prefixes that it asks for are looked at."""
        short = end <= 8
        got = self.prefixes.get(word[:end]) if short else memo.get(end)
        if got is not None:
            return got
        for i, k in reversed(self.ending(word, end)):  # at most one arc has weight 0
            left = self.last(word, i, memo) if i else -1
            ok = self.pairs.get(left << 21 | k)
            if self.allowed(left, k) if ok is None else ok:
                if short:
                    self.prefixes[word[:end]] = k
                else:
                    memo[end] = k
                return k
        raise AssertionError("a prefix without a path")

    def path(self, word: str) -> list[int]:
        """States of the shortest path."""
        n, size, out = len(word), self.size, []
        if self.bpe and n <= 100:
            memo: dict = {}
            while n:
                k = self.last(word, n, memo)
                out.append(k)
                n -= size[k] if k < len(size) else 1
            return out[::-1]
        back, cost = [(0, -1)] * (n + 1), [0.0] * (n + 1)
        for end in range(1, n + 1):
            cost[end] = INF
            for i, k in self.ending(word, end):
                if self.bpe:
                    ok = self.pairs.get(back[i][1] << 21 | k)
                    c = 0.0 if (self.allowed(back[i][1], k) if ok is None else ok) else INF
                else:
                    c = cost[i] + (self.alone if k >= len(size) else -self.scores[k])
                if c < cost[end]:
                    cost[end], back[end] = c, (i, k)
        while n:
            n, k = back[n]
            out.append(k)
        return out[::-1]

    def word_ids(self, word: str) -> bytes:
        out = []
        for k in self.path(word):
            if k < len(self.pieces):
                out.append(k)
            elif self.byte:
                out += [self.byte[b] for b in self.name(k).encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unk)
        return np.array(out, "<u4").tobytes()

    def unit(self, word: str) -> bytes:
        """Ids of what the cut makes of a word that a space precedes."""
        return b"".join([self.word_ids(w) for w in self.cut.findall(META + word)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.prefixes) > 120_000:
            self.prefixes.clear()
        if not (self.prefix and self.by_word) or META in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            # behind a META of their own in the cache, which the words below never hold
            words, unit = [META + w for w in self.cut.findall(self.normalise(text))], lambda w: self.word_ids(w[1:])
        else:  # one space before every word: the words' paths join to the text's
            words, unit = text.split(" ") if text else [], self.unit
        out = list(map(self.words.get, words))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    w = words[i]
                    got = out[i] = self.words.get(w) or self.older.get(w) or unit(w)
                    if len(w) <= 40:
                        self.words[w] = got
            if len(self.words) > HELD:  # of two generations the older goes
                self.older, self.words = self.words, {}
        return b"".join(out)

    def decode(self, ids) -> str:
        """Inverse projection of the path (an array of ids); the dummy prefix goes."""
        s = b"".join(self.outputs[ids].tolist()).decode("utf-8", "replace")
        return s[1:] if self.prefix and s.startswith(" ") else s


def compiled(path: str) -> Transducer:
    got = _cache().get(path)
    if got is None:
        with open(path, "rb") as f:
            got = _cache()[path] = Transducer(f.read())
    return got


def _converted(path: str, kind: pa.DataType, one):
    """The last column put through ``one(transducer, value)``, some rows at a time."""
    @released
    def run(batches):
        t = compiled(path)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                s = b.slice(lo, ROWS)
                new = [None if x is None else one(t, x) for x in s.column(s.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*s.columns[:-1], pa.array(new, kind)], names=s.schema.names)

    return run


def _mapped(df: DataFrame, source: str, out: str, kind: str, run) -> DataFrame:
    inner = [f"_c{i}" for i in range(len(df.columns))]
    rows = df.select(*[col(c).alias(n) for c, n in zip(df.columns, inner)], col(source).alias("_x"))
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner)
    return rows.mapInArrow(run, f"{schema}, _x {kind}").toDF(*df.columns, out)


def encode(df: DataFrame, model_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``: piece ids as little-endian unsigned 32-bit integers."""
    return _mapped(df, text_col, out, "binary", _converted(model_path, pa.binary(), lambda t, x: t.encode(x)))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the text of ``ids_col``."""
    return _mapped(df, ids_col, out, "string", _converted(model_path, pa.string(), lambda t, x: t.decode(np.frombuffer(x, "<u4"))))


def token_count(ids: str):
    return (F.octet_length(col(ids)) / 4).cast("bigint")
