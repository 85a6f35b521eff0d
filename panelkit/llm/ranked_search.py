"""Ranked lexical search by pipelined term partitioning.

A document's score for an item is a sum over the item's terms, so the terms can be
dealt to owners, and an item's bundle can pass from owner to owner with what it has
summed so far.

1. One pass over the documents, in groups of bounded size, gives inverted lists for the
   items' terms alone: a row per (term, group) with packed document numbers, counts and
   document lengths. Other words are left out by a bitmap of fixed size; numbers of a
   group follow document ids, so ties need no ids later.
2. Document frequencies, weights and owners: terms are dealt by document frequency, the
   rarest to the first owner (``shares``: shares of the documents that part the owners).
3. A stage per owner: bundles (up to ``bundle`` items x one group of documents) meet the
   owner's lists by cogroup, every list adds its integer contributions to the sparse
   accumulators of the items that have the term, and the bundles move on. A document is
   left behind only when even the full weight of all terms to come cannot bring it to
   the 10th best sum that its group already holds: exact, no accumulator is capped.
4. After the last owner each bundle gives its best ``k`` per item; a window over those
   few rows picks the final ones.

Common terms meet the bundles last, so the accumulators carried between stages are
those of rarer terms. A very common term is one list per group, never one task.

Defined results: a NULL or wordless text has no terms (neither as document nor as item);
repeated document rows are documents of their own; equal (item, text) rows are one item;
an item id with several texts is ranked for each; NULL document ids come last among
equals; other columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.llm.common import BITS, bitmap, col, materialize, pack, released, unpack

SCALE, FULL, K1_8, B_PERCENT = 1000, 1_000_000_000, 8, 90  # the score's integer constants
#: Every byte of a term as itself (A-Z lower-cased), all others as a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
GROUP_DOCS, GROUP_TERMS, SLICE = 8192, 1 << 22, 1 << 20
SHARES = (0.001, 0.01, 0.05)
_NO_ID = np.iinfo(np.int64).max


def _slices(text: bytes):
    """Terms of a text, a slice of about 1 MB at a time: a very long text is never one list of words."""
    text, lo = text.translate(TERM_BYTES), 0
    while lo < len(text):
        hi = text.find(b" ", lo + SLICE)
        hi = len(text) if hi < 0 else hi
        yield text[lo:hi].split()
        lo = hi


def _code(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, 42) & (BITS - 1)


class _Places(dict):
    """term -> its column in this group, -1 for words that no item has."""

    def __init__(self, bits: bytes):
        self.bits, self.names = bits, []

    def __missing__(self, term: bytes) -> int:
        c = _code(term)
        at = -1
        if term and self.bits[c >> 3] >> (c & 7) & 1:
            at = len(self.names)
            self.names.append(term)
        if len(self) < 1 << 20:  # a bounded memory of the words met
            self[term] = at
        elif at >= 0:  # a term keeps its column within the group
            self[term] = at
        return at


INDEX = "grp long, term string, size long, total long, docs binary"


def _lists(bits: bytes):
    """Documents (id, text) -> lists of each group: numbers, counts and lengths of the documents with a term, packed.
    The list of the empty term holds the group's ids in order (for NULL the largest), lengths and which are NULL; its
    ``size`` is the number of documents with terms, its ``total`` that of their terms."""

    def close(grp, places, ids, owns, lens, nulls):
        n = len(ids)
        ids, lens, nulls = np.array(ids, np.int64), np.array(lens, np.int64), np.array(nulls, np.uint8)
        order = np.lexsort((nulls, ids))  # by id, NULLs (the largest number) last
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        held = np.array([len(x) for x in owns], np.int64)
        pair, count = np.unique(np.concatenate(owns).astype(np.int64) * n + np.repeat(rank, held), return_counts=True)
        column, doc = pair // n, pair % n
        length = lens[order]
        out = [("", int((lens > 0).sum()), int(lens.sum()), pack(np.diff(ids[order], prepend=0), length, nulls[order]))]
        cuts = np.flatnonzero(np.diff(column, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            d = doc[lo:hi]
            out.append((places.names[column[lo]].decode(), hi - lo, 0,
                        pack(np.diff(d, prepend=0).astype(np.int32), count[lo:hi].astype(np.int32), length[d].astype(np.int32))))
        terms, sizes, totals, blobs = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array([grp] * len(out), pa.int64()), pa.array(terms, pa.string()), pa.array(sizes, pa.int64()),
                                           pa.array(totals, pa.int64()), pa.array(blobs, pa.binary())], ["grp", "term", "size", "total", "docs"])

    def run(batches):
        grp = TaskContext.get().partitionId() << 32
        ids, owns, lens, nulls, places, total = [], [], [], [], _Places(bits), 0
        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                own, n = [], 0
                for words in _slices(text or b""):
                    at = np.fromiter(map(places.__getitem__, words), np.int32, len(words))
                    own.append(at[at >= 0])
                    n += len(words)
                ids.append(_NO_ID if i is None else i)
                nulls.append(i is None)
                owns.append(np.concatenate(own) if own else np.zeros(0, np.int32))
                lens.append(n)
                total += n
                if len(ids) == GROUP_DOCS or total >= GROUP_TERMS:
                    yield close(grp, places, ids, owns, lens, nulls)
                    ids, owns, lens, nulls, places, total = [], [], [], [], _Places(bits), 0
                    grp += 1
        if ids:
            yield close(grp, places, ids, owns, lens, nulls)

    return run


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item: a number, item_id, term): the distinct terms of each distinct (id, text)."""
    rows = materialize(items.select(col(item_col).alias("item_id"), col(text_col).cast("string").alias("text"))
                       .where("text IS NOT NULL").distinct(), "items")
    # the bytes of a term are those of the documents' side: ASCII letters lower-cased, ASCII signs are cuts
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), 0)
    return rows.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", F.explode(F.array_distinct(words)).alias("term"))


BUNDLE = "grp long, bundle int, item long, held long, docs binary, sums binary"


def _stage(n_docs: int, n_terms: int, k: int, last: bool):
    """Bundles of a group and one owner's lists -> the bundles moved on, or their best documents."""

    def run(bundles: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        if not len(lists):  # nothing to add
            return bundles
        head = lists[lists["term"] == ""]
        ids, _, null = (unpack(head["docs"].iloc[0]) if len(head) else (None, None, None))
        sums, rest = {}, {}
        for item, docs, own in zip(bundles["item"], bundles["docs"], bundles["sums"]):
            d, s = unpack(docs)[0], unpack(own)[0]
            sums[item] = (np.cumsum(d, dtype=np.int64), s)
        parts = {}
        for term, blob, w, items, after in zip(lists["term"], lists["docs"], lists["weight"], lists["items"], lists["after"]):
            if not term:
                continue
            d, tf, n = (x.astype(np.int64) for x in unpack(blob))
            m = 100 - B_PERCENT + (B_PERCENT * n * n_docs) // n_terms
            gain = w * ((FULL * tf) // (SCALE * tf + K1_8 * m))
            d = np.cumsum(d)
            for item, more in zip(items, after):
                parts.setdefault(item, []).append((d, gain))
                rest[item] = more
        out = []
        grp, bundle = lists["grp"].iloc[0], lists["bundle"].iloc[0]
        for item in sorted(sums.keys() | parts.keys()):
            own = parts.get(item, [])
            old = sums.get(item)
            top = max([d[-1] for d, _ in own] + ([old[0][-1]] if old else [])) + 1
            acc = np.zeros(top, np.int64)
            if old:
                acc[old[0]] = old[1]
            for d, gain in own:
                acc[d] += gain
            d = np.flatnonzero(acc)
            s = acc[d]
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                # what is still to come is less than its weight at full saturation
                reach = 0 if last else rest[item] * (FULL // SCALE) if item in rest else None
                if reach is not None:
                    stay = s + reach >= least
                    d, s = d[stay], s[stay]
            if last:
                best = np.lexsort((d, -s))[:k]  # numbers follow ids
                real = np.cumsum(ids)
                out += [(grp, bundle, item, None if null[x] else int(real[x]), int(v)) for x, v in zip(d[best], s[best])]
            elif len(d):
                out.append((grp, bundle, item, len(d), pack(np.diff(d, prepend=0).astype(np.int32)), pack(s)))
        return pd.DataFrame(out, columns=["grp", "bundle", "item", "doc_id", "score"] if last else ["grp", "bundle", "item", "held", "docs", "sums"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", shares: tuple[float, ...] = SHARES, bundle: int = 256) -> DataFrame:
    """The ``k`` best documents of every item: (item, item_id, rank, doc_id, score)."""
    terms = materialize(item_terms(items, item_col, item_text_col), "item-terms")
    code = F.xxhash64(F.encode("term", "UTF-8")).bitwiseAND(F.lit(BITS - 1))
    bits = bitmap(terms.select(code.alias("code")).distinct(), F.col("code"))
    rows = docs.select(col(doc_col).cast("bigint").alias("id"), F.encode(col(text_col).cast("string"), "UTF-8").alias("text"))
    index = materialize(rows.mapInArrow(released(_lists(bits)), INDEX), "index")

    n, total = index.where("term = ''").agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    if not n:
        return terms.sparkSession.createDataFrame([], f"item long, item_id {terms.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    df = index.where("term <> ''").groupBy("term").agg(F.sum("size").alias("df"))
    owner = sum(((F.col("df") > share * n).cast("int") for share in shares), F.lit(0))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint")
    known = materialize(df.select("term", owner.alias("owner"), weight.alias("weight")), "terms")
    # what an item's later owners can still add: a running sum over its owners, not over its terms
    wanted = terms.join(known, "term").withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(_bundles(terms, bundle))).cast("int"))
    later = Window.partitionBy("item").orderBy(F.desc("owner")).rowsBetween(Window.unboundedPreceding, -1)
    after = (wanted.groupBy("item", "owner").agg(F.sum("weight").alias("own"))
             .select("item", "owner", F.coalesce(F.sum("own").over(later), F.lit(0)).alias("after")))
    asked = (wanted.join(after, ["item", "owner"]).groupBy("bundle", "term", "owner", "weight")
             .agg(F.sort_array(F.collect_list(F.struct("item", "after"))).alias("x"))
             .select("bundle", "term", "owner", "weight", F.col("x.item").alias("items"), F.col("x.after").alias("after")))
    # each bundle ends with the groups' ids
    ends = asked.select("bundle").distinct().select(
        "bundle", F.lit("").alias("term"), F.lit(len(shares)).alias("owner"), F.lit(0).cast("bigint").alias("weight"),
        F.array().cast("array<bigint>").alias("items"), F.array().cast("array<bigint>").alias("after"))
    lists = materialize(index.select("grp", "term", "docs").join(asked.unionByName(ends), "term"), "lists")

    carried = terms.sparkSession.createDataFrame([], BUNDLE)
    for stage in range(len(shares) + 1):
        last = stage == len(shares)
        own = lists.where(F.col("owner") == stage)
        carried = (carried.groupBy("grp", "bundle").cogroup(own.groupBy("grp", "bundle"))
                   .applyInPandas(_stage(n, total, k, last), "grp long, bundle int, item long, doc_id long, score long" if last else BUNDLE))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "grp"))
    best = carried.where("score > 0").withColumn("rank", rank).where(F.col("rank") <= k)
    names = terms.select("item", "item_id").distinct()
    return best.join(names, "item").select("item", "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _bundles(terms: DataFrame, size: int) -> int:
    return max(1, math.ceil(terms.select("item").distinct().count() / size))
