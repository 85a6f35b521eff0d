"""Data-quality checks.

Each check is a one-row DataFrame (check, passed, details, observed). They are
computed on the DataFrame *before* anything is published (SURVEY C4).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHECK_COLS = ["check", "passed", "details", "observed"]


def null_check(df: DataFrame, column: str, name: str = "null_values") -> DataFrame:
    """A10: number of NULLs in ``column`` (one partial+final aggregation)."""
    n = F.count_if(F.col(column).isNull()).cast("bigint")
    return df.agg(n.alias("observed")).select(
        F.lit(name).alias("check"),
        (F.col("observed") == 0).alias("passed"),
        F.format_string("Found %d null values", F.col("observed")).alias("details"),
        "observed")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1))


def duplicate_check(df: DataFrame, keys: Sequence[str], name: str = "duplicates") -> DataFrame:
    """Number of duplicated *keys* (as the reference reports; SURVEY C3),
    plus ``excess_rows`` (rows beyond the first per key). Two-level
    aggregation: the key groupBy shuffles once, the count is global."""
    d = duplicate_groups(df, keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("observed"),
        F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))
    return d.select(
        F.lit(name).alias("check"),
        (F.col("observed") == 0).alias("passed"),
        F.format_string("Found %d duplicate records", F.col("observed")).alias("details"),
        "observed", "excess_rows")


def quality_checks(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    """X3 + A18: the reference's two checks as rows, with ``all_passed``
    (bool_and over the few check rows)."""
    checks = [null_check(df, score).select(*CHECK_COLS),
              duplicate_check(df, keys).select(*CHECK_COLS)]
    rows = reduce(DataFrame.unionByName, checks)
    return rows.withColumn("all_passed", F.bool_and("passed").over(Window.partitionBy()))


def quality_report(checks: DataFrame) -> DataFrame:
    """The JSON report object: one row (timestamp, checks array<struct>,
    all_passed). ``checks`` holds a handful of rows."""
    return checks.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.collect_list(F.struct("check", "passed", "details")).alias("checks"),
        F.bool_and("passed").alias("all_passed"))


def require(checks: DataFrame, on_fail: str = "warn") -> bool:
    """Evaluate the checks (a few rows to the driver); ``on_fail='raise'``
    stops the pipeline before publishing."""
    rows = checks.select("check", "passed", "details").collect()
    ok = all(r["passed"] for r in rows)
    if not ok and on_fail == "raise":
        failed = "; ".join(f"{r['check']}: {r['details']}" for r in rows if not r["passed"])
        raise ValueError(f"quality checks failed: {failed}")
    return ok
