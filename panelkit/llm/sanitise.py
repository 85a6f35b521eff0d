"""Information-theoretic sanitisation of personal data.

1. Patterns find the personal data itself (e-mail, IP, card, phone): the protected
   entities.
2. The corpus says which terms give an entity away. For a term t found anywhere in a
   document that names entity e, the pointwise mutual information
   PMI(t;e) = log2(p(t,e) / (p(t) p(e))) is compared with the entity's information
   content IC(e) = -log2 p(e); probabilities are document frequencies over all documents.
   A term discloses e if PMI(t;e) >= IC(e) - ``generalise_bits`` and the pair is
   found in at least ``support`` different texts (copies count once there, so that
   a page copied often discloses nothing by itself).
3. Disclosing terms are generalised to their class wherever they stand, also in documents that do not
   name the entity; those with PMI(t;e) >= IC(e) - ``remove_bits`` are removed.

Scale: pairs exist only in documents that name an entity found in ``support`` texts, and are counted by partially aggregated
group-bys. Document frequencies and places are asked only for terms that are a candidate:
tasks look them up in a bitmap of fixed size (2^23 bits), whose false
positives fall out in a join.

Rules: a NULL text is empty and has no spans; base spans are never dropped or
moved; repeated rows give equal rows; offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import BITS, bitmap, col, materialize, released

KINDS = ("email", "ip", "card", "phone", "term")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive digits after a non-digit: a run of digits is tried once, from its start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EDGES = ".,;:!?()[]{}<>\"'|*#$%&"
_DIGITS = re.compile("[0-9]")
SPAN = "array<struct<s:int,e:int,k:int,entity:string>>"
HITS = "array<struct<term:string,s:int,e:int>>"


def _luhn(d: str) -> bool:
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v - 9 * (v > 9)
    return t % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, entity): leftmost non-overlapping matches of each
    kind that pass its check, by start, then kind. Linear in the text."""
    out = []
    at, free = text.find("@"), 0  # free: where the next e-mail may begin
    while at >= 0:
        b = at
        while b > free and text[b - 1] in _LOCAL:
            b -= 1
        if b < at and (m := _DOMAIN.match(text, at)):
            out.append((b, m.end(), 0, "email:" + text[b:m.end()].lower()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
                out.append((m.start(), m.end(), 1, "ip:" + m[0]))
        for m in _CARD.finditer(text):
            d = re.sub("[ -]", "", m[0])
            if 12 <= len(d) <= 19 and _luhn(d):
                out.append((m.start(), m.end(), 2, "card:" + d))
        if "+" in text:
            for m in _PHONE.finditer(text):
                d = re.sub("[^0-9]", "", m[0])
                if 9 <= len(d) <= 15:
                    out.append((m.start(), m.end(), 3, "phone:" + d))
    return sorted(out)


def terms(text: str, spans, wanted=None):
    """(term, start, end) of the words that touch no span; with ``wanted`` those it says yes to."""
    out, starts = [], np.array([x[0] for x in spans])
    ends = np.maximum.accumulate(np.array([x[1] for x in spans])) if len(spans) else starts
    for m in WORD.finditer(text):
        word = m[0].strip(_EDGES)
        term = word.lower()
        if len(word) < 3 or wanted and not wanted(term) or not any(c.isalpha() for c in word):
            continue
        i = int(np.searchsorted(starts, m.end())) - 1 if len(spans) else -1  # spans that begin before the word ends
        if i < 0 or ends[i] <= m.start():
            at = m.start() + m[0].index(word)
            out.append((term, at, at + len(word)))
    return out


def _core(word: str) -> str:
    return word.strip(_EDGES).lower()


def _set(bits: bytes, text: str) -> int:
    h = crc32(text.encode("utf-8", "surrogatepass")) % BITS
    return bits[h >> 3] >> (h & 7) & 1


def _scan(names: list[str], bits: bytes | None):
    """Adds the spans and the places of terms whose bit is set; ``names`` are the columns kept. The text is the last column."""
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32()), ("entity", pa.string())]))
    places = pa.list_(pa.struct([("term", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))

    @released

    def run(batches):
        seen: dict[str, int] = {}

        def wanted(term):
            got = seen.get(term)
            if got is None:
                if len(seen) > 500_000:
                    seen.clear()
                got = seen[term] = _set(bits, term)
            return got

        for b in batches:
            spans, hits = [], []
            for x in b.column(b.num_columns - 1):
                text = x.as_py() or ""
                got = base_spans(text)
                spans.append([{"s": s, "e": e, "k": k, "entity": v} for s, e, k, v in got])
                hits.append([dict(zip(("term", "s", "e"), r)) for r in terms(text, got, wanted)] if bits else [])
            kept = [b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, span), pa.array(hits, places)],
                                             names=[*names, "_spans", "_hits"])

    return run


def _entities(batches):
    """(entity, hash of the text) of every document."""
    for b in batches:
        rows = [(v, h) for h, x in zip(b.column(0).to_pylist(), b.column(1)) for v in {s[3] for s in base_spans(x.as_py() or "")}]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["entity", "_h"])


def _pairs(bits: bytes):
    """(entity, term, hash of the text) of the documents that name an entity whose bit is set."""
    @released
    def run(batches):
        for b in batches:
            out = []
            for h, x in zip(b.column(0).to_pylist(), b.column(1)):
                text = x.as_py() or ""
                got = base_spans(text)
                named = {s[3] for s in got}
                named = [v for v in named if _set(bits, v)]
                if named:
                    out += [(v, t, h) for t in {r[0] for r in terms(text, got)} for v in named]
                if len(out) > 50_000:
                    yield _table(out)
                    out = []
            if out:
                yield _table(out)

    def _table(out):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()),
                                           pa.array([r[2] for r in out], pa.int64())], names=["entity", "term", "_h"])

    return run


def _frequencies(bits: bytes):
    """Document frequencies of the terms whose bit is set, by task."""
    @released
    def run(batches):
        count: Counter = Counter()
        seen: dict[str, str] = {}

        def rows():
            return pa.RecordBatch.from_pydict({"term": pa.array(list(count), pa.string()),
                                               "n": pa.array(list(count.values()), pa.int64())})

        for b in batches:
            for x in b.column(0):
                hits = set()
                for w in set(WORD.findall(x.as_py() or "")):
                    t = seen.get(w)
                    if t is None:
                        if len(seen) > 500_000:
                            seen.clear()
                        t = _core(w)
                        h = crc32(t.encode("utf-8", "surrogatepass")) % BITS
                        t = seen[w] = t if bits[h >> 3] >> (h & 7) & 1 else ""
                    if t:
                        hits.add(t)
                count.update(hits)
                if len(count) > 200_000:
                    yield rows()
                    count.clear()
        if count:
            yield rows()

    return run


def find_spans(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, with_text: bool = False,
               support: int = 3, generalise_bits: float = 1.0,
               remove_bits: float = 0.15) -> DataFrame:
    """The ``carry`` columns (default: all), ``spans`` array<struct<s, e, k,
    removed>> (k: index in ``KINDS``; sorted by start, then kind) and, with
    ``with_text``, the text as ``_text``. One row per input row."""
    carry = docs.columns if carry is None else carry
    inner = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[col(c).alias(n) for c, n in zip(carry, inner)], F.monotonically_increasing_id().alias("_row"),
                       F.xxhash64(col(text_col).cast("string")).alias("_h"), col(text_col).cast("string").alias("_text"))
    texts = rows.select("_h", "_text")
    often = (texts.mapInArrow(released(_entities), "entity string, _h bigint").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("texts"))
             .where(F.col("texts") >= support))
    bits, tell = bitmap(materialize(often, "entities"), F.expr(f"crc32(encode(entity, 'UTF-8')) % {BITS}")), None
    if any(bits):
        pairs = (texts.mapInArrow(_pairs(bits), "entity string, term string, _h bigint").groupBy("entity", "term", "_h").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.count(F.lit(1)).alias("texts"))
                 .where(F.col("texts") >= support).select("entity", "term", "n_pair"))
        pairs = materialize(pairs, "pairs")
        bits = bitmap(pairs, F.expr(f"crc32(encode(term, 'UTF-8')) % {BITS}"))
        freq = (docs.select(col(text_col).cast("string").alias("t")).mapInArrow(_frequencies(bits), "term string, n bigint")
                .groupBy("term").agg(F.sum("n").alias("n_term")))
        # PMI(t;e) - IC(e) = log2 p(e|t): corpus size and entity frequency cancel.
        told_by = F.log2(F.col("n_pair") / F.col("n_term"))
        tell = (pairs.join(freq, "term").withColumn("bits", told_by).where(F.col("bits") >= -generalise_bits)
                .groupBy("term").agg((F.max("bits") >= -remove_bits).alias("removed")))
        tell = materialize(tell, "tell")
        bits = bitmap(tell, F.expr(f"crc32(encode(term, 'UTF-8')) % {BITS}"))
    bits = bits if tell is not None and any(bits) else None
    names = [*inner, "_row", *["_text"] * with_text]
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    wide = rows.select(*inner, "_row", *["_text"] * with_text, F.col("_text").alias("_read"))
    stored = materialize(wide.mapInArrow(_scan(names, bits), f"{schema}, _spans {SPAN}, _hits {HITS}"), "spans")
    base = stored.withColumn("_base", F.expr("transform(_spans, x -> struct(x.s, x.e, x.k, true AS removed))"))
    kept = [*inner, *["_text"] * with_text]
    if bits is None:
        out = base.select(*kept, F.col("_base").alias("_all"))
    else:
        occ = stored.where("size(_hits) > 0").select("_row", F.explode("_hits").alias("x")).select("_row", "x.term", "x.s", "x.e")
        term = F.struct("s", "e", F.lit(KINDS.index("term")).alias("k"), "removed")
        added = occ.join(tell, "term").groupBy("_row").agg(F.collect_list(term).alias("_terms"))
        told = base.where("size(_hits) > 0").join(added, "_row", "left")
        alls = F.expr("array_sort(concat(_base, coalesce(_terms, array())))")
        out = told.select(*kept, alls.alias("_all")).unionByName(
            base.where("size(_hits) = 0").select(*kept, F.col("_base").alias("_all")))
    by_kind = F.expr("""array_sort(_all, (a, b) -> CASE WHEN a.s <> b.s THEN a.s - b.s WHEN a.k <> b.k THEN a.k - b.k
                        ELSE a.e - b.e END)""")
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, carry)], *["_text"] * with_text, by_kind.alias("spans"))


def digest(spans: str, base_only: bool = False) -> str:
    """SQL: ``kind:start:end`` of the spans, comma-joined."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    rows = f"filter({spans}, x -> x.k < {KINDS.index('term')})" if base_only else spans
    return f"array_join(transform({rows}, x -> concat_ws(':', array({kinds})[x.k], x.s, x.e)), ',')"


def _rewrite(text: str, spans) -> str:
    out, at = [], 0
    for x in spans:
        s, e = x["s"], x["e"]
        if e <= at:
            continue
        s = max(s, at)
        out.append(text[at:s])
        if x["k"] < KINDS.index("term"):
            out.append(f"[{KINDS[x['k']].upper()}]")
        elif not x["removed"]:
            w = text[s:e]
            out.append("[NUMBER]" if any(c.isdigit() for c in w) else "[NAME]" if w[:1].isupper() else "[TERM]")
        at = e
    return "".join(out) + text[at:]


def _apply(n: int):
    @released
    def run(batches):
        for b in batches:
            text, spans = b.column(n).to_pylist(), b.column(n + 1).to_pylist()
            new = [t if not x else _rewrite(t or "", x) for t, x in zip(text, spans)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(n)), pa.array(new, pa.string())],
                                             names=[*b.schema.names[:n], "_text"])

    return run


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced by its kind and disclosing terms
    generalised or removed; all other columns as they were."""
    rest = [c for c in docs.columns if c != text_col]
    found = find_spans(docs, text_col, rest, with_text=True, **options)
    inner = [f"_c{i}" for i in range(len(rest))]
    rows = found.toDF(*inner, "_text", "_spans")
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in [*inner, "_text"])
    new = rows.mapInArrow(_apply(len(rest)), schema).toDF(*rest, text_col) if rest else rows.mapInArrow(_apply(0), schema).toDF(text_col)
    return new.select(*[col(c) for c in docs.columns])
