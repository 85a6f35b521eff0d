"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, whole text). Every
passage is encoded from surface statistics by a learned tanh layer; a gated
attention a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))) weighs the passages, and the
weighted representation is scored by a logistic unit. All weights are learned
together from document labels only.

Training uses a bounded sample (``max_train`` labelled documents, chosen by a hash of
their id among those that are not held out); scoring is one pass over all
documents without a shuffle. Labels, language, source and ids are no inputs of a score.

Rules: a NULL or empty text is one empty passage; a document with several
labels takes the largest, NULL labels and labels without document are not
used; without two classes to learn from every score is the labels' mean (0.5
without labels); repeated rows give equal rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, released

PASSAGE = 64
BLOCK = 4 << 20
# Byte classes: 0 white space, 1 lower case, 2 upper case, 3 digit, 4 punctuation, 5 symbol, 6 other bytes.
CLASSES = 7
DENSE = 12
WIDTH = DENSE + CLASSES * CLASSES


def _class_table() -> np.ndarray:
    t = np.full(256, 6, np.uint8)
    t[33:127] = 4
    for lo, hi, c in (("a", "z", 1), ("A", "Z", 2), ("0", "9", 3)):
        t[ord(lo):ord(hi) + 1] = c
    for c in "#*$%&|<>=+@^~_{}[]/\\":
        t[ord(c)] = 5
    t[[32, 9, 10, 11, 12, 13]] = 0
    return t


def features(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (rows x WIDTH) of the texts that end at ``ends`` in
    ``buf`` (UTF-8 bytes), and the number of passages of each text."""
    starts = np.concatenate([[0], ends[:-1]])
    cls = _class_table()[buf]
    ink = cls > 0
    first = np.zeros(len(buf) + 1, bool)
    if len(buf):
        first[0] = True
    first[starts[starts < len(buf)]] = True
    begin = np.flatnonzero(ink & (first[:-1] | ~np.concatenate([[False], ink[:-1]])))
    stop = np.concatenate([first[1:-1], [True]]) if len(buf) else np.zeros(0, bool)
    end = np.flatnonzero(ink & (stop | ~np.concatenate([ink[1:], [False]]))) + 1
    doc = np.searchsorted(ends, begin, side="right")
    n_words = np.bincount(doc, minlength=len(ends))
    bags = np.maximum(1, -(-n_words // PASSAGE))
    base = np.cumsum(bags) - bags
    rank = np.arange(len(begin)) - (np.cumsum(n_words) - n_words)[doc]
    passage = base[doc] + rank // PASSAGE
    n = int(bags.sum())
    x = np.zeros((n, WIDTH), np.float32)
    if not len(begin):
        return x, bags
    words = np.bincount(passage, minlength=n)
    some = np.maximum(words, 1)
    size = end - begin

    # Words by a polynomial hash, for repetition within a passage.
    power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
    at = np.flatnonzero(ink)
    word = np.searchsorted(begin, at, side="right") - 1
    h = np.add.reduceat((buf[at].astype(np.uint64) + np.uint64(1)) * power[at - begin[word]], np.searchsorted(at, begin))
    o = np.lexsort((h, passage))
    new = np.ones(len(o), bool)
    new[1:] = (h[o][1:] != h[o][:-1]) | (passage[o][1:] != passage[o][:-1])
    run = np.diff(np.append(np.flatnonzero(new), len(o)))
    np.maximum.at(x[:, 0], passage[o][new], run.astype(np.float32))
    x[:, 0] /= some
    x[:, 1] = np.bincount(passage[o][new], minlength=n) / some
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    x[:, 2] = np.bincount(passage, same, minlength=n) / some
    x[:, 3] = np.bincount(passage, size, minlength=n) / some / 10
    x[:, 4] = np.sqrt(np.maximum(0, np.bincount(passage, size.astype(float) ** 2, minlength=n) / some - (10 * x[:, 3].astype(float)) ** 2)) / 10
    x[:, 5] = np.bincount(passage, cls[begin] == 2, minlength=n) / some
    x[:, 6] = np.bincount(passage, cls[end - 1] == 5, minlength=n) / some
    x[:, 7] = np.bincount(passage, cls[end - 1] == 4, minlength=n) / some
    x[:, 8] = np.bincount(passage, size == 1, minlength=n) / some
    x[:, 9] = np.log1p(words) / 5
    # Each byte belongs to the passage of the word that it is in or follows.
    last = np.clip(np.searchsorted(begin, np.arange(len(buf)), side="right") - 1, 0, None)
    owner = passage[last]
    lines = buf == 10
    x[:, 10] = np.bincount(owner, lines, minlength=n) / some
    x[:, 11] = 1.0
    pair = owner[1:] * (CLASSES * CLASSES) + cls[:-1].astype(np.int64) * CLASSES + cls[1:]
    grams = np.bincount(pair[~first[1:-1]], minlength=n * CLASSES * CLASSES).reshape(n, -1).astype(np.float32)
    x[:, DENSE:] = np.sqrt(grams / np.maximum(1, grams.sum(axis=1, keepdims=True)))
    return x, bags


def _blocks(column):
    """(buffer, ends) over runs of texts of about BLOCK bytes; a longer text is a run of its own."""
    buf, ends, at = [], [], 0
    for t in column:
        b = (t.as_py() or "").encode("utf-8", "surrogatepass")
        buf.append(b)
        at += len(b)
        ends.append(at)
        if at >= BLOCK:
            yield np.frombuffer(b"".join(buf), np.uint8), np.array(ends)
            buf, ends, at = [], [], 0
    if ends:
        yield np.frombuffer(b"".join(buf), np.uint8), np.array(ends)


class GatedAttention:
    """tanh encoder, gated attention pooling, logistic output."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 12, seed: int = 0):
        r = np.random.default_rng(seed)
        draw = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {"W": draw(width, hidden), "V": draw(hidden, gate), "U": draw(hidden, gate),
                  "w": draw(gate, 1)[:, 0], "c": draw(hidden, 1)[:, 0], "b": np.zeros(1)}
        self.mean, self.sd = np.zeros(width), np.ones(width)

    def _forward(self, x, bags):
        p = self.p
        at = np.cumsum(bags) - bags
        h = np.tanh(((x - self.mean) / self.sd) @ p["W"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -40, 40)))
        e = (v * u) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), bags))
        a = e / np.repeat(np.add.reduceat(e, at), bags)
        z = np.add.reduceat(a[:, None] * h, at)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -40, 40)))
        return at, h, v, u, a, z, y

    def scores(self, x, bags) -> np.ndarray:
        return self._forward(x, bags)[-1]

    def fit(self, x, bags, labels, epochs: int = 60, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 0):
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 0.05
        r = np.random.default_rng(seed)
        at = np.cumsum(bags) - bags
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(bags))
            for k in range(0, len(order), batch):
                pick = order[k:k + batch]
                nb = bags[pick]
                rows = np.repeat(at[pick] - (np.cumsum(nb) - nb), nb) + np.arange(nb.sum())
                g = self._gradient(x[rows].astype(np.float64), nb, labels[pick])
                step += 1
                for q, v in self.p.items():
                    d = g[q] + decay * v
                    m[q] = 0.9 * m[q] + 0.1 * d
                    s[q] = 0.999 * s[q] + 0.001 * d * d
                    v -= rate * (m[q] / (1 - 0.9**step)) / (np.sqrt(s[q] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x, bags, labels):
        p = self.p
        _, h, v, u, a, z, y = self._forward(x, bags)
        dy = (y - labels) / len(labels)
        dz = dy[:, None] * p["c"]
        dzr = np.repeat(dz, bags, axis=0)
        da = (dzr * h).sum(axis=1)
        mean = np.add.reduceat(a * da, np.cumsum(bags) - bags)
        de = a * (da - np.repeat(mean, bags))
        dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
        dh = a[:, None] * dzr + dv @ p["V"].T + du @ p["U"].T
        return {"W": ((x - self.mean) / self.sd).T @ (dh * (1 - h * h)), "V": h.T @ dv, "U": h.T @ du,
                "w": (v * u).T @ de, "c": z.T @ dy, "b": np.array([dy.sum()])}


def held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves 1 by division by 3 (a NULL id is not held out)."""
    return F.coalesce(F.crc32(F.encode(col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


@released
def _encoded(batches):
    for b in batches:
        ids = b.column(0)
        at = 0
        for buf, ends in _blocks(b.column(b.num_columns - 1)):
            x, bags = features(buf, ends)
            cut = np.cumsum(bags)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(ends)), b.column(1).slice(at, len(ends)), pa.array(bags, pa.int32()),
                 pa.array([x[e - n:e].tobytes() for e, n in zip(cut, bags)], pa.binary())],
                names=["id", "label", "bags", "x"])
            at += len(ends)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "quality", max_train: int = 3000, seed: int = 0) -> GatedAttention | float:
    """A model, or the labels' mean if there is but one class."""
    known = (labels.where(~held_out(label_id)).select(col(label_id).cast("bigint").alias("id"), col(label_col).cast("double").alias("label"))
             .where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")))
    some = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text"))
    # At most max_train ids: a bounded broadcast.
    sample = rows.join(F.broadcast(some), "id").select("id", "label", "text")
    got = sample.mapInArrow(_encoded, "id bigint, label double, bags int, x binary").collect()
    got = sorted({r["id"]: r for r in sorted(got, key=lambda r: r["x"])}.values(), key=lambda r: r["id"])
    y = np.array([r["label"] for r in got])
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = np.frombuffer(b"".join(r["x"] for r in got), np.float32).reshape(-1, WIDTH)
    return GatedAttention(WIDTH, seed=seed).fit(x, np.array([r["bags"] for r in got]), y, seed=seed)


def _score(model):
    @released
    def run(batches):
        for b in batches:
            out = []
            for buf, ends in _blocks(b.column(b.num_columns - 1)):
                if isinstance(model, float):
                    out.append(np.full(len(ends), model))
                else:
                    out.append(model.scores(*features(buf, ends)))
            s = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())], names=[*b.schema.names[:-1], "_s"])

    return run


def score(docs: DataFrame, model: GatedAttention | float, text_col: str = "text", carry: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """The ``carry`` columns (default: all) and ``out``, 0 to 1, of each document."""
    carry = docs.columns if carry is None else carry
    inner = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[col(c).alias(n) for c, n in zip(carry, inner)], col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner)
    return rows.mapInArrow(_score(model), f"{schema}{', ' * bool(inner)}_s double").toDF(*carry, out)
