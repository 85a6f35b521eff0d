"""File catalog of a landing folder (S12) and its totals.

One distributed text scan: file names, sizes and times from ``_metadata``, records and
header width from the lines. No file is read by the driver, and a large file is counted
by as many tasks as it has splits, with quoted newlines in their place: a line ends a
record if the number of quotes so far in the file is even, and that parity is a prefix
sum over the splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions import bytes_to_mb, decoded_path, round_half_up
from panelkit.session import materialize

_SPLIT = ["path", "block"]
_FILE = ["name", "length", "mtime"]  # the same in every split: keys, so that what is aggregated are numbers and needs no sort


def _commas(line: Column, quoted: int) -> Column:
    """Commas outside quotes of a line that begins inside (1) or outside (0) of them."""
    parts = F.split(line, '"')
    outside = F.filter(parts, lambda x, i: i % 2 == quoted)
    text = F.array_join(outside, "")
    return F.length(text) - F.length(F.translate(text, ",", ""))


def _lines(spark: SparkSession, folder: str, opts: dict) -> DataFrame:
    """(path, block, at: number of the line, rising within a block; odd: an odd number of quotes; blank; commas0, commas1)."""
    meta, line = F.col("_metadata"), F.col("value")
    quotes = F.length(line) - F.length(F.translate(line, '"', ""))
    any_quote = F.instr(line, '"') > 0
    plain = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(","), F.lit("")))  # of every line: translate() looks up each character
    return spark.read.options(**opts).text(folder).select(
        meta.file_path.alias("path"), meta.file_block_start.alias("block"), meta.file_name.alias("name"), meta.file_size.alias("length"),
        meta.file_modification_time.alias("mtime"), F.monotonically_increasing_id().alias("at"),
        (any_quote & (quotes % 2 == 1)).alias("odd"), (F.length(line) == 0).alias("blank"),
        # only a file's first split can hold its header
        F.when(meta.file_block_start == 0, F.when(any_quote, _commas(line, 0)).otherwise(plain)).alias("commas0"),
        F.when(meta.file_block_start == 0, F.when(any_quote, _commas(line, 1)).otherwise(0)).alias("commas1"))


def data_catalog(spark: SparkSession, folder: str, pattern: str = "*.csv",
                 recursive: bool = True) -> DataFrame:
    """(filename, rows, columns, size_mb, downloaded, path) per file.

    rows = CSV records after the header; blank lines between records do not count (as in pandas), those
    inside quotes belong to their record. columns = fields of the header record, which may span lines.
    Quotes inside quoted fields are doubled (RFC 4180). Files without a line have no row. A file
    that cannot be read to its end is an error that names it.

    1. Per split: lines, blank lines, and whether its quotes are odd in number (one partial aggregation).
    2. Lines with an odd number of quotes and blank lines, the only ones whose parity matters one by
       one, are numbered within their split; line numbers are consecutive there, so the lines between
       two of them are a difference. A file without such lines adds nothing to this step.
    3. The parity before each split: a running sum over the splits of a file (a row each).

    The text is read once; a second time only if a file's header goes on over several lines."""
    opts = {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower()}
    lines = _lines(spark, folder, opts)
    # one row for a split's ordinary lines, one for each odd or blank line
    rows = lines.groupBy(*_SPLIT, *_FILE, F.when(F.col("odd") | F.col("blank"), F.col("at")).alias("mark")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n"),
        F.max("odd").alias("odd"), F.max("blank").alias("blank"), F.min_by("commas0", "at").alias("commas"), F.min_by("odd", "at").alias("open"))
    # odd lines o1 < o2 < ...: the parity after a line is odd from o1 to the line before o2, from o3 on, ...
    rows = rows.withColumn("k", F.sum(F.col("odd").cast("long")).over(Window.partitionBy(*_SPLIT).orderBy(F.asc_nulls_first("mark"))))
    k, at = F.col("k"), F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    held = rows.groupBy(*_SPLIT, *_FILE).agg(
        F.min("first").alias("first"), F.sum("n").alias("n"),
        F.count_if("odd").alias("odds"), F.min_by("commas", "first").alias("commas"), F.min_by("open", "first").alias("open"),
        F.sum(F.when(F.col("odd"), F.when(k % 2 == 0, at).otherwise(-at)).otherwise(0)).alias("odd_lines"),
        F.count_if(F.col("blank") & (k % 2 == 0)).alias("blank_even"), F.count_if(F.col("blank") & (k % 2 == 1)).alias("blank_odd"),
        F.min(F.when(F.col("odd") & (k == 2), F.col("mark"))).alias("second"))
    end = F.col("first").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("n")
    odd_after = F.col("odd_lines") + F.when(F.col("odds") % 2 == 1, end).otherwise(0)

    before = F.coalesce(F.sum("odds").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = F.when(before % 2 == 0, F.col("n") - odd_after - F.col("blank_even")).otherwise(odd_after - F.col("blank_odd"))
    files = (held.select(*_SPLIT, "name", "length", "mtime", "odds", ends.alias("ends"), "commas", "open", "first", "second")
             .groupBy("path").agg(
                 F.first("name").alias("name"), F.first("length").alias("length"), F.first("mtime").alias("mtime"),
                 # a record that the file's end cuts off counts
                 F.greatest(F.sum("ends") + F.sum("odds") % 2 - 1, F.lit(0)).cast("bigint").alias("rows"),
                 *[F.min_by(c, "block").alias(c) for c in ("commas", "open", "first", "second")]))
    files = materialize(files, "catalog")  # a row a file
    columns = F.col("commas") + 1
    if not files.where("open").limit(1).collect():
        return _finish(files.withColumn("columns", columns.cast("bigint")))
    # a header over several lines: those after its first begin inside quotes
    long = files.where("open").select(F.col("path").alias("p"), "first", "second")
    rest = (lines.where("block = 0").join(long, (F.col("path") == F.col("p")) & (F.col("at") > F.col("first"))
                                          & ((F.col("at") <= F.col("second")) | F.col("second").isNull()))
            .groupBy("p").agg(F.sum("commas1").alias("more")))
    files = files.join(rest, files["path"] == rest["p"], "left")
    return _finish(files.withColumn("columns", (columns + F.coalesce("more", F.lit(0))).cast("bigint")))


def _finish(files: DataFrame) -> DataFrame:
    return (files
            .select(decoded_path("name").alias("filename"),
                    F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                    "columns",
                    bytes_to_mb("length").alias("size_mb"),
                    F.date_format("mtime", "yyyy-MM-dd HH:mm:ss").alias("downloaded"),
                    decoded_path("path").alias("path")))


def dataset_catalog(catalog: DataFrame) -> DataFrame:
    """(dataset, files, rows, columns, size_mb): the part files of one table are one
    dataset, named by its folder (``indicator=x`` by x); any other file is its own, named by its stem.
    Datasets are told apart by their folders, so two
    files of one name in two folders are two; such names carry their folder (``s1/data``)."""
    parts = F.split("path", "/")
    is_part = F.col("filename").startswith("part-")
    own = F.when(is_part, F.regexp_replace(F.element_at(parts, -2), "^[^=/]+=", "")).otherwise(
        F.regexp_replace("filename", r"\.[^.]+$", ""))
    home = F.array_join(F.slice(parts, 1, F.size(parts) - F.when(is_part, 2).otherwise(1)), "/")
    sets = catalog.groupBy(home.alias("home"), own.alias("name")).agg(
        F.count(F.lit(1)).cast("bigint").alias("files"), F.sum("rows").cast("bigint").alias("rows"), F.max("columns").alias("columns"),
        round_half_up(F.sum("size_mb"), 2).alias("size_mb"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("name")) > 1
    dataset = F.when(shared, F.concat(F.element_at(F.split("home", "/"), -1), F.lit("/"), F.col("name"))).otherwise(F.col("name"))
    return sets.select(dataset.alias("dataset"), "files", "rows", "columns", "size_mb")


def catalog_totals(catalog: DataFrame) -> DataFrame:
    """Number of datasets and total MB (sum of the rounded sizes, as the
    reference does), plus total rows."""
    return catalog.agg(
        F.count(F.lit(1)).cast("bigint").alias("datasets_collected"),
        round_half_up(F.sum("size_mb"), 2).alias("total_size_mb"),
        F.sum("rows").cast("bigint").alias("total_rows"))


def collection_report(catalog: DataFrame, folder: str) -> DataFrame:
    """The collection report object: run date, datasets, total MB, folder."""
    return catalog_totals(catalog).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("run_date"),
        "datasets_collected", "total_size_mb", F.lit(folder).alias("data_directory"))
