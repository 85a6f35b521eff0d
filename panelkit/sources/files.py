"""File sources: CSV panel scan (S1), tagged multi-file scan (S2), JSON
object (S4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import decoded_path, file_stem
from panelkit.functions.scalar import colref
from panelkit.spec import PanelSpec


def panel_schema(spec: PanelSpec, entity_type: T.DataType = T.StringType()) -> T.StructType:
    """Explicit schema of a panel file: entity, period BIGINT, scores DOUBLE."""
    return T.StructType(
        [T.StructField(spec.entity, entity_type), T.StructField(spec.period, T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in (spec.score, *spec.components)])


def _int_to_bigint(df: DataFrame) -> DataFrame:
    """Inferred INT columns become BIGINT (DuckDB and pandas give 64-bit)."""
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
                       else F.col(f.name) for f in df.schema.fields])


#: Quotes are doubled inside quoted cells (RFC 4180), as DuckDB and pandas write and read them.
CSV_OPTIONS = {"header": "true", "escape": '"'}
RECORD = "_pk_record"


def bound_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns bound by their header names, plus ``_pk_record``: the text of a record
    with a cell that does not parse or with too few or too many cells, else NULL. A
    missing column and a file whose header differs from the first one's are errors.

    Spark fills that column from the cells it parses, so whoever drops cells from the
    plan also drops their errors: use :func:`checked` or :func:`split_rejects`."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns  # reads one header line
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in its header {names}")
    known = {f.name: f.dataType for f in schema}
    given = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names]
                         + [T.StructField(RECORD, T.StringType())])
    return (spark.read.options(**CSV_OPTIONS).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", RECORD).schema(given).csv(path))


def _all_cells(df: DataFrame) -> Column:
    """A text of all cells: naming it keeps every column in the scan."""
    return F.concat_ws(",", *[colref(c).cast("string") for c in df.columns if c != RECORD])


def checked(df: DataFrame) -> DataFrame:
    """Rows of :func:`bound_csv`; a record that cannot be read is an error that names the
    file, whichever columns and rows the query goes on with: all cells are parsed, and a
    filter that is no fixed function keeps later filters from passing below the check."""
    said = F.concat(F.lit("unreadable record "), F.col(RECORD), F.lit(" in "), F.col("_metadata.file_path"),
                    F.lit(", read as "), _all_cells(df))
    return df.where(F.when(F.col(RECORD).isNotNull(), F.raise_error(said).cast("boolean")).otherwise(F.spark_partition_id() >= 0))


def split_rejects(df: DataFrame, path: str, reason: Column, columns: Sequence[str],
                  by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One pass over ``df`` into one table at ``path``: (rows without a ``reason``, rows with one).

    ``columns`` and ``by`` are kept; ``by`` also partitions the table. No shuffle: each task writes
    the rows of its files, so a rejected row costs no second read of the input."""
    kept = df.select(*columns, *by, reason.alias("reason")).withColumn("rejected", F.col("reason").isNotNull())
    kept.write.mode("overwrite").partitionBy("rejected", *by).parquet(path)
    table = df.sparkSession.read.schema(kept.schema).parquet(path)
    return (table.where(~F.col("rejected")).select(*columns, *by),
            table.where("rejected").select(*columns, *by, "reason"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. With a schema (the scale path) columns bind by
    their header names, every cell of every record is checked (:func:`checked`) and no
    pass over the data is made; without one, types are inferred (one extra scan) and
    integers widened to BIGINT."""
    if schema is not None:
        return checked(bound_csv(spark, path, schema)).select(*schema.fieldNames())
    return _int_to_bigint(spark.read.options(**CSV_OPTIONS).option("inferSchema", True).csv(path))


def read_csv_tagged(spark: SparkSession, pattern: str, schema: T.StructType,
                    tag: str = "source", tag_regex: str | None = None,
                    prefix: str = "raw_") -> DataFrame:
    """Every file matching ``pattern`` in ONE scan, each row tagged with
    the table name its file gives (``raw_<file stem>``, or ``raw_<group 1 of
    tag_regex>`` on the path). One DataFrame instead of a table per file, so
    later operators treat the tag as an ordinary key."""
    df = tag_source(checked(bound_csv(spark, pattern, schema)), tag, tag_regex, prefix)
    return df.select(*schema.fieldNames(), tag)


def tag_source(df: DataFrame, tag: str = "source", tag_regex: str | None = None,
               prefix: str = "raw_") -> DataFrame:
    """Add the table name of each row's file (from ``_metadata``)."""
    path = decoded_path("_metadata.file_path")
    name = F.regexp_extract(path, tag_regex, 1) if tag_regex else file_stem(path)
    return df.withColumn(tag, F.concat(F.lit(prefix), name))


def read_json_object(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document (possibly spanning lines) as one row per object."""
    return spark.read.option("multiLine", True).json(path)
