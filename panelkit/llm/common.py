"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import materialize, scratch_path, shuffle_partitions

__all__ = ["col", "table", "partitions", "materialize", "scratch_path", "ordered", "components", "pack", "unpack", "split", "BITS", "bitmap", "with_keys", "without_keys", "maybe_keys", "without_any_key", "drop", "bounded_batches", "released"]

BITS = 1 << 23


def col(name: str) -> Column:
    """A column by its literal name (dots and back-quotes included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def released(run):
    """``run`` of a mapInArrow, giving freed memory back to the system when its task ends:
    Python workers outlive their tasks."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def bounded_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Smaller Arrow batches between Spark and Python, so that the memory of a task
    stays small beside its executor's whatever the texts' lengths; a session that sets
    them itself keeps its own values."""
    for name, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key, None) is None:  # not set by the session
            spark.conf.set(key, str(value))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    return shuffle_partitions(df.sparkSession)


def ordered(docs: DataFrame, id_col: str, text_col: str, carry: list[str], inner: list[str]) -> tuple[DataFrame, bool]:
    """(``carry`` as ``inner``, key bigint, text as UTF-8 bytes): the key orders the documents;
    and whether the key is the id.

    It is the id itself where ids are unique; else a number by (id, hash of the
    text), NULL ids first, which rows equal in both share."""
    text = F.encode(F.coalesce(col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(*[col(c).alias(n) for c, n in zip(carry, inner)], col(id_col).cast("bigint").alias("key"), text.alias("text"))
    odd = rows.groupBy("key").count().where("key IS NULL OR count > 1").limit(1).collect()
    if not odd:
        return rows, True
    rows = rows.withColumn("h", F.xxhash64("text"))
    places = (rows.select("key", "h").distinct().orderBy(F.asc_nulls_first("key"), "h").rdd.zipWithIndex()
              .map(lambda r: (r[0]["key"], r[0]["h"], r[1])).toDF("k bigint, g bigint, place bigint"))
    places = materialize(places, "order")
    return (rows.join(places, rows["key"].eqNullSafe(places["k"]) & (rows["h"] == places["g"]))
            .withColumn("key", F.col("place")).drop("k", "g", "place", "h")), False


def pack(*arrays) -> bytes:
    """Arrays as one blob: byte planes, compressed."""
    c, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = c.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
        out += [a.dtype.str.encode().ljust(4), len(a).to_bytes(8, "little"), len(raw).to_bytes(8, "little"), raw]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    d, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(blob):
        kind = np.dtype(blob[at:at + 4].decode().strip())
        n, size = (int.from_bytes(blob[at + k:at + k + 8], "little") for k in (4, 12))
        raw = d.decompress(blob[at + 20:at + 20 + size], max_output_size=max(1, n * kind.itemsize)) if n else b""
        out.append(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T.copy().reshape(-1).view(kind))
        at += 20 + size
    return out


def split(part: np.ndarray, *arrays):
    """(part, arrays of its rows in their order) for each part that has rows."""
    o = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[o], prepend=-1, append=-1)) if len(o) else []
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield int(part[o[lo]]), [a[o[lo:hi]] for a in arrays]


def bitmap(df: DataFrame, position: Column) -> bytes:
    """One bit per ``position`` (0 to BITS - 1): at most 256 rows of 4 KB reach the driver."""
    rows = (df.select((position + 1).alias("v")).groupBy(F.expr("bitmap_bucket_number(v)").alias("b"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(v))").alias("m")).collect())
    out = bytearray(BITS // 8)
    for r in rows:
        lo = (r["b"] - 1) * 4096
        out[lo:lo + len(r["m"])] = r["m"]
    return bytes(out)


def _having(bits: bytes, wanted: bool):
    def run(batches):
        table = np.frombuffer(bits, np.uint8)
        for b in batches:
            k = b.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
            at = (k ^ (k >> 23)) & (BITS - 1)
            yield b.filter(pa.array((table[at >> 3] >> (at & 7) & 1).astype(bool) == wanted))

    return run


def _position(name: str) -> Column:
    return F.expr(f"({name} ^ shiftright({name}, 23)) & {BITS - 1}")


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


def maybe_keys(rows: DataFrame, keys: DataFrame, then=None, schema: str | None = None) -> DataFrame:
    """``then`` (a function for mapInArrow; default: nothing) over the rows of ``rows`` whose ``key`` a bitmap of fixed size of
    ``keys (key)`` knows: all that have one of the keys, and some others. Nothing is shuffled."""
    keep = _having(bitmap(keys, _position("key")), True)
    return rows.mapInArrow(lambda batches: then(keep(batches)), schema) if then else rows.mapInArrow(keep, _schema(rows))


def without_any_key(rows: DataFrame, keys: DataFrame, then, schema: str) -> DataFrame:
    """``then`` over the rows that ``maybe_keys`` leaves out."""
    free = _having(bitmap(keys, _position("key")), False)
    return rows.mapInArrow(lambda batches: then(free(batches)), schema)


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is among the distinct ``keys (key)``.

    Tasks first drop rows by a bitmap of fixed size, so of a large table only the
    rows asked for (and false positives) are shuffled to the join."""
    return maybe_keys(rows, keys).join(keys, "key")


def without_keys(rows: DataFrame, keys: DataFrame, then, schema: str) -> DataFrame:
    """``then`` (a function for mapInArrow) over the other rows. Those that the bitmap knows
    nothing of are not shuffled, and filtered in the process that goes on with them."""
    bits = bitmap(keys, _position("key"))
    maybe = rows.mapInArrow(_having(bits, True), _schema(rows)).join(keys, "key", "left_anti")
    free = _having(bits, False)
    return rows.mapInArrow(lambda batches: then(free(batches)), schema).unionByName(maybe.mapInArrow(then, schema))


def drop(*tables: DataFrame) -> None:
    """Delete stored tables (of ``materialize``) that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links (a, b)``: a stored table ``(node, root)``,
    root the smallest node of the component, one row per linked node.

    Alternating large-star and small-star steps: every node is hung on the
    smallest node it sees, until a round changes nothing. Stars are kept as
    (child, parent) edges; the neighbours of a node are never gathered, only
    their minimum (a partially aggregated ``min``, written as a table so that the join
    that hands it back to the edges is one that AQE can split where a node has many). Each
    round's edges are a written table, so lineage stays short."""
    def least(df, *also):
        return materialize(df.groupBy("u").agg(F.least(F.min("v"), *also).alias("m")) if also else
                           df.groupBy("u").agg(F.min("v").alias("m")), name + "-least")

    e = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), name)
    before = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = least(both, F.col("u"))
        # large star: larger neighbours of a node move to the smallest node it sees
        big = (both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(m.where("m < u").select("u", F.col("m").alias("v"))).distinct())
        big = materialize(big, name)
        # small star: smaller neighbours (and the node itself) move to the smallest of them
        low = least(big)
        small = (big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, name)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now[0] == 0 or now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
