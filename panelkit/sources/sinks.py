"""Sinks (S6-S10) and the gold bundle.

Tables are written as folders of part files, in parallel by every task.
Sorting is done within partitions only (``sortWithinPartitions``), never
with a global sort; ``single_file`` (``coalesce(1)``) is for small results
(top-k, one-row reports) only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.files import CSV_OPTIONS
from panelkit.spec import PanelSpec

METADATA_SCHEMA = ("pipeline_run string, tables_created array<string>, "
                   "record_counts map<string, bigint>")


def _prep(df: DataFrame, sort_within: Sequence[str] | None, single_file: bool) -> DataFrame:
    if single_file:
        df = df.coalesce(1)
    if sort_within:
        df = df.sortWithinPartitions(*[F.asc_nulls_last(c) for c in sort_within])
    return df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  sort_within: Sequence[str] | None = None, single_file: bool = False) -> str:
    """``COPY t TO f (FORMAT PARQUET)``; ``partition_by`` (e.g. the
    period) enables partition pruning for period filters later."""
    if partition_by and not single_file:
        # By range of (partition columns, sort keys): a partition's rows lie in few
        # tasks, so files number about partitions + tasks, and a large one is split.
        keys = [*partition_by, *[c for c in sort_within or () if c not in partition_by]]
        df = df.repartitionByRange(*[F.asc_nulls_last(c) for c in keys])
        # The writer orders by the partition columns: sort by them first, or it sorts again.
        sort_within = keys
    w = _prep(df, sort_within, single_file).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sort_within: Sequence[str] | None = None,
              single_file: bool = False) -> str:
    """``COPY t TO f (FORMAT CSV, HEADER)``: quotes inside quoted cells are doubled."""
    _prep(df, sort_within, single_file).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def write_json(df: DataFrame, path: str, single_file: bool = True) -> str:
    """A (small) report object as JSON."""
    _prep(df, None, single_file).write.mode("overwrite").json(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by :func:`write_parquet`. With the written schema,
    partition columns keep their types (discovery would make a BIGINT period an
    INT) and their position."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE t AS SELECT``: write, then read back the
    written table (cuts the lineage; later readers prune and push down)."""
    write_parquet(df, path, partition_by)
    return read_parquet(df.sparkSession, path, df.schema)


def publish_gold(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
                 formats: Sequence[str] = ("parquet", "csv"),
                 partition_by: Mapping[str, Sequence[str]] | None = None,
                 sort_within: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Every table to Parquet (and CSV), then ``pipeline_metadata``:
    run time, tables created and record counts *of what was written* (read
    back from the Parquet footers). Returns the metadata row."""
    partition_by = partition_by or {}
    sort_within = sort_within or {}
    counts = []
    for name, df in tables.items():
        pq = f"{out_dir}/{name}.parquet"
        write_parquet(df, pq, partition_by.get(name), sort_within.get(name))
        written = read_parquet(spark, pq, df.schema)
        if "csv" in formats:
            write_csv(written, f"{out_dir}/{name}.csv", sort_within.get(name))
        counts.append(written.agg(F.count(F.lit(1)).cast("bigint").alias("c"))
                      .select(F.lit(name).alias("k"), "c"))
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    meta = allc.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("pipeline_run"),
        F.array(*[F.lit(n) for n in tables]).alias("tables_created"),
        F.map_from_entries(F.collect_list(F.struct("k", "c"))).alias("record_counts"))
    write_json(meta, f"{out_dir}/pipeline_metadata.json")
    return spark.read.schema(METADATA_SCHEMA).json(f"{out_dir}/pipeline_metadata.json")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """``CREATE OR REPLACE VIEW``: each frame becomes a temporary view of
    the session, so the published tables and views can be queried with
    ``spark.sql`` as in the reference's database."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def publish_catalog(spark: SparkSession, tables: Mapping[str, DataFrame], views: Mapping[str, str], database: str,
                    location: str) -> None:
    """S6 + S7 as the reference's database has them: tables and views by name in the session's catalog
    (shared and lasting where the session has a metastore), not paths and temporary views.

    ``tables`` are written below ``location`` and replaced as a whole; ``views`` are SQL texts
    over them, stored by name, so their plans prune and push down in whatever query uses them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, df in tables.items():
        df.write.mode("overwrite").format("parquet").option("path", f"{location}/{name}").saveAsTable(f"`{database}`.`{name}`")
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text}")


def top_performers_sql(spec: PanelSpec, database: str, n: int = 10) -> str:
    """The reference's view over ``clean_infrastructure`` and ``country_summary``, ties by the entity."""
    clean, e = f"`{database}`.clean_infrastructure", f"`{spec.entity}`"
    latest = (f"SELECT {e}, `{spec.score}` AS latest_score, `{spec.rank}` AS latest_rank FROM {clean} "
              f"WHERE `{spec.period}` = (SELECT MAX(`{spec.period}`) FROM {clean})")
    return (f"SELECT {e}, avg_score, score_improvement, latest_score, latest_rank FROM ({latest}) "
            f"JOIN `{database}`.country_summary USING ({e}) ORDER BY latest_score DESC NULLS LAST, {e} LIMIT {n}")


def load_gold(spark: SparkSession, out_dir: str,
              names: Sequence[str] = ("clean_infrastructure", "country_summary",
                                      "yearly_trends", "top_performers"),
              schemas: Mapping[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The published tables as a named bundle. A missing table is an
    error (no silent fallback to demo data). ``schemas`` (the published
    schemas) keep partition columns typed."""
    schemas = schemas or {}
    out = {n: read_parquet(spark, f"{out_dir}/{n}.parquet", schemas.get(n)) for n in names}
    out["metadata"] = spark.read.schema(METADATA_SCHEMA).json(f"{out_dir}/pipeline_metadata.json")
    return out
