"""Indicator payloads (S3): ``[meta, [row, ...]]`` JSON envelopes -> tidy rows.

The reference downloads one envelope per indicator and keeps element 1. Here
a landing folder of such payloads is parsed as one distributed job: the text
source, ``from_json`` into elements and element 1 into rows of text cells,
``inline`` to explode them, and typed cells that are told from unreadable ones. A null, empty or missing element 1
yields no rows. Field names are those of the public World Bank API.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import decoded_path
from panelkit.functions.scalar import let
from panelkit.sources.files import RECORD, bound_csv, tag_source
from panelkit.spec import REFERENCE_PAGE_SIZE

_IDV = T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])

PAYLOAD_ROW = T.StructType([
    T.StructField("indicator", _IDV),
    T.StructField("country", _IDV),
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("obs_status", T.StringType()),
    T.StructField("decimal", T.LongType()),
])

FLAT_COLUMNS = ["indicator_id", "indicator_name", "country_id", "country", "iso3", "year", "value"]

# A row's cells as text: whatever a cell holds arrives, and what does not parse can be told from NULL.
_CELLS = ["indicator", "country", "countryiso3code", "date", "value"]
_WIRE = "struct<" + ",".join(f"{c}:string" for c in _CELLS) + ">"


def _elements(column: str) -> Column:
    """The payload's elements as texts, NULL if it is not a whole JSON array."""
    return F.from_json(F.col(column), "array<string>")


def _has_rows(p: Column) -> Column:
    return (F.size(p) > 1) & F.coalesce(F.startswith(F.ltrim(F.try_element_at(p, F.lit(2))), F.lit("[")), F.lit(False))


def payload_status(column: str = "value") -> Column:
    """'rows', 'empty' (the API's answer without rows) or 'broken' (not a JSON
    array: a truncated download, an error page)."""
    return let(_elements(column), lambda p: F.when(p.isNull(), "broken").when(~_has_rows(p), "empty").otherwise(
        let(F.from_json(p[1], "array<string>"), lambda r: F.when(r.isNull(), "broken").when(F.size(r) == 0, "empty").otherwise("rows"))))


def payload_rejects(text: DataFrame, column: str = "value") -> DataFrame:
    """Number of payloads by status: what could not be read is counted, not lost."""
    return text.groupBy(payload_status(column).alias("status")).agg(
        F.count(F.lit(1)).cast("bigint").alias("payloads"))


def _tidy(rows: DataFrame, cell, keep: list[str]) -> DataFrame:
    """Rows of text cells -> FLAT_COLUMNS, ``keep``, ``reason``: the first cell that does not parse, and ``_pk_at``.

    ``_pk_at`` is no fixed function of the row: a filter that names it (:func:`_settled`) stays above the
    parsed cells, where the optimiser would otherwise parse every cell once for the filter and again for the row."""
    ind, ctry = cell("indicator"), cell("country")
    year, value = F.expr("try_cast(date AS bigint)"), F.expr("try_cast(value AS double)")
    out = rows.withColumns({"_i": ind, "_c": ctry, "_y": year, "_v": value, "_pk_at": F.spark_partition_id()})
    unread = lambda c: F.col(c).isNotNull() & F.col(f"_{c[0]}._pk_bad").isNotNull()
    reason = F.coalesce("reason", F.when(unread("indicator"), "indicator").when(unread("country"), "country")
                        .when(F.col("date").isNotNull() & F.col("_y").isNull(), "date")
                        .when(F.col("value").isNotNull() & F.col("_v").isNull(), "value"))
    return out.select(
        F.col("_i.id").alias("indicator_id"), F.col("_i.value").alias("indicator_name"),
        F.col("_c.id").alias("country_id"), F.col("_c.value").alias("country"),
        F.col("countryiso3code").alias("iso3"), F.col("_y").alias("year"), F.col("_v").alias("value"),
        *keep, reason.alias("reason"), "_pk_at")


def _pair(text: Column, options: dict) -> Column:
    """A dict cell; its text in ``_pk_bad`` where it is no dict."""
    return F.from_json(text, "id string, value string, _pk_bad string", {"columnNameOfCorruptRecord": "_pk_bad", **options})


def _settled(marked: DataFrame, on_broken: str, keep: list[str]) -> DataFrame:
    """Rows with a ``reason``: an error, left out, or handed on (``mark``)."""
    if on_broken == "mark":
        return marked.drop("_pk_at")
    if on_broken == "skip":
        return marked.where("reason IS NULL AND _pk_at >= 0").select(*FLAT_COLUMNS, *keep)
    if on_broken != "fail":
        raise ValueError("on_broken: fail, skip or mark")
    said = F.concat(F.lit("broken "), F.col("reason"), F.lit(": "), F.substring(F.coalesce("record", F.lit("NULL")), 1, 200))
    return (marked.where(F.when(F.col("reason").isNotNull(), F.raise_error(said).cast("boolean")).otherwise(F.col("_pk_at") >= 0))
            .select(*FLAT_COLUMNS, *keep))


def parse_envelopes(text: DataFrame, column: str = "value", on_broken: str = "fail", keep: list[str] | None = None) -> DataFrame:
    """Envelope text column -> one flat row per payload row, with the columns ``keep`` of its payload
    (streaming-safe: no aggregation, so the same function runs on a readStream). Each payload is
    parsed once into its elements and its rows once into cells.

    A broken payload and a cell that does not parse ("n/a" for a value) are errors; ``on_broken="skip"``
    leaves them out, ``"mark"`` returns them too, with the ``record`` and a ``reason`` (NULL for good rows)."""
    keep = list(keep or [])
    row = lambda reason, record, x: F.struct(reason.cast("string").alias("reason"), record.alias("record"), x.alias("x"))
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast(_WIRE)
    broken = F.array(row(F.lit("payload"), F.col(column), nothing))
    rows = let(_elements(column), lambda p: F.when(p.isNull(), broken).when(_has_rows(p), let(
        F.from_json(p[1], f"array<{_WIRE}>"), lambda r: F.when(r.isNull(), broken).otherwise(
            F.transform(r, lambda x: row(F.when(x.isNull(), "row"), none, x))))))
    cells = text.select(*keep, F.inline(rows)).select(*keep, "reason", "record", "x.*")
    kept = ["record", *keep]
    marked = _tidy(cells, lambda c: _pair(F.col(c), {}), kept)
    marked = marked.withColumn("record", F.when(F.col("reason") == "payload", F.col("record")).when(
        F.col("reason").isNotNull(), F.to_json(F.struct(*FLAT_COLUMNS))))
    return _settled(marked, on_broken, keep)


# The indicator CSV files a pandas collector writes: the API rows, one column
# per field, dict-valued cells in Python repr ({'id': 'X', 'value': 'Y'}).
RAW_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in _CELLS])


def read_indicator_csv(spark: SparkSession, pattern: str, tag: str = "source",
                       tag_regex: str | None = None, on_broken: str = "fail") -> DataFrame:
    """S2 + S3 for already-downloaded indicator CSV files (``worldbank_*.csv``):
    one scan of every matching file, columns bound by header names, the dict cells parsed with
    ``from_json`` (single quotes allowed), the same tidy columns as
    :func:`parse_envelopes`, plus the ``raw_<file stem>`` table name (or
    ``raw_<group 1 of tag_regex>`` on the path). Records and cells that do not parse: as there;
    ``"mark"`` adds ``file``, ``record`` and ``reason`` (both NULL for good rows)."""
    raw = tag_source(bound_csv(spark, pattern, RAW_CSV_SCHEMA), tag, tag_regex)
    raw = raw.select(*_CELLS, tag, decoded_path("_metadata.file_path").alias("file"),
                     F.when(F.col(RECORD).isNotNull(), "record").alias("reason"), RECORD, F.struct(*_CELLS).alias("_pk_cells"))
    # Python writes None where JSON has null.
    cell = lambda c: _pair(F.regexp_replace(c, r":\s*None\s*([,}])", ": null$1"), {"allowSingleQuotes": "true"})
    marked = _tidy(raw, cell, [tag, "file", RECORD, "_pk_cells"])
    # written as text for rejected rows only
    record = F.when(F.col("reason").isNotNull(), F.coalesce(RECORD, F.to_csv("_pk_cells")))
    marked = marked.withColumn("record", record).select(*FLAT_COLUMNS, tag, "file", "record", "reason", "_pk_at")
    return _settled(marked, on_broken, [tag])


def read_indicator_payloads(spark: SparkSession, path: str, wholetext: bool = True,
                            on_broken: str = "fail") -> DataFrame:
    """S3 over a landing folder (or a list of files): one payload per file (``wholetext``, as the
    API returns it; a page holds at most a few thousand rows) or one payload per line."""
    return parse_envelopes(spark.read.text(path, wholetext=wholetext), on_broken=on_broken)


def name_indicators(flat: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Friendly indicator names from a code -> name map (a literal map
    expression: no join, no broadcast)."""
    m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return flat.withColumn("indicator", F.coalesce(m[F.col("indicator_id")], F.col("indicator_id")))


def encode_envelopes(rows: DataFrame, page_key: str,
                     page_size: int = REFERENCE_PAGE_SIZE) -> DataFrame:
    """Inverse of :func:`parse_envelopes`, used to build landing data from a
    table: envelopes per ``page_key`` value, at most about ``page_size`` rows
    each (the API pages by 5000). A key with more rows is split over
    ceil(rows / page_size) pages by a hash of the row - deterministic, so a
    retried task builds the same pages - and no group is ever collected
    whole. ``rows`` has the columns of :data:`PAYLOAD_ROW`."""
    row = F.struct(*[F.col(f.name) for f in PAYLOAD_ROW.fields])
    counts = rows.groupBy(F.col(page_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    pages = F.ceil(F.col("_n") / F.lit(float(page_size)))
    paged = rows.join(counts, F.col(page_key).eqNullSafe(F.col("_k"))).withColumn(
        "_page", F.pmod(F.xxhash64(*[F.col(f.name) for f in PAYLOAD_ROW.fields]), pages))
    per_page = paged.groupBy(page_key, "_page").agg(
        F.first(pages).alias("_pages"), F.count(F.lit(1)).alias("_total"),
        F.collect_list(row).alias("_rows"))
    meta = F.struct((F.col("_page") + 1).alias("page"), F.col("_pages").alias("pages"),
                    F.lit(page_size).alias("per_page"), F.col("_total").alias("total"))
    return per_page.select(F.concat(F.lit("["), F.to_json(meta), F.lit(","),
                                    F.to_json("_rows"), F.lit("]")).alias("value"))
