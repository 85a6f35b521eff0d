"""Table profiling: shape, types, NULLs, describe, correlation, domains (A3,
A6, A8, A9, A12-A14, A21, A22, W4, X12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import colref, safe_corr
from panelkit.operators.leaders import latest_slice, top_n
from panelkit.operators.ordinal import column_summary, value_positions
from panelkit.operators.panel import net_change
from panelkit.spec import PanelSpec

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _stack(row_df: DataFrame, names: Sequence[str], fields: Sequence[str], key: str) -> DataFrame:
    """Turn a one-row frame with ``_s{i}_{j}`` columns (name i, field j) into
    one row per name (a small Expand, no shuffle). Positional aliases keep any
    column name (dots, spaces, backticks) out of column references."""
    structs = [F.struct(F.lit(n).alias(key),
                        *[F.col(f"_s{i}_{j}").alias(f) for j, f in enumerate(fields)])
               for i, n in enumerate(names)]
    return row_df.select(F.inline(F.array(*structs)))


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A3 + A9: (table_name, record_count) for several tables in one result."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))
             .select(F.lit(name).alias("table_name"), "record_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 only_missing: bool = True) -> DataFrame:
    """A12 + P13: NULL count per column in ONE pass, then long form
    (column_name, null_count); only columns with NULLs by default."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(colref(c).isNull()).cast("bigint").alias(f"_s{i}_0")
                    for i, c in enumerate(cols)])
    out = _stack(wide, cols, ["null_count"], "column_name")
    return out.where(F.col("null_count") > 0) if only_missing else out


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row - total NULL cells and whether none is missing
    (``missing.sum() == 0``), from the same single pass as the NULL profile."""
    total = F.coalesce(F.sum("null_count"), F.lit(0)).cast("bigint")
    return (null_profile(df, columns, only_missing=False)
            .agg(total.alias("missing"), (total == F.lit(0)).alias("no_missing")))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     approx: bool = False) -> DataFrame:
    """Pandas ``describe()`` per numeric column, long form: count, mean,
    std (sample), min, 25/50/75 % (exact, linear interpolation), max. NULL and NaN do not count.

    All columns together: one scan for sketches when the frame is defined (a row of numbers
    reaches the driver), one in the returned plan for the rest (``ordinal.column_summary``).
    ``approx=True``: quartiles from sketches that :func:`approximate_summary` takes, a single scan."""
    cols = list(columns or numeric_columns(df))
    qs, names = (0.25, 0.5, 0.75), ("p25", "p50", "p75")
    found = approximate_summary(df, cols, qs, names) if approx else column_summary(df, cols, qs, names)
    return found.select("column_name", "count", "mean", "std", "min", *names, "max")


def approximate_summary(df: DataFrame, columns: Sequence[str], qs: Sequence[float], names: Sequence[str],
                        accuracy: int = 10000) -> DataFrame:
    """As ``ordinal.column_summary`` in one scan: quantiles within a rank error of 1 / accuracy."""
    aggs, fields = [], ["count", "mean", "std", "min", "max", "q"]
    for i, c in enumerate(columns):
        x = F.when(~F.isnan(colref(c).cast("double")), colref(c).cast("double"))
        for f, agg in zip(fields, (F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x), F.percentile_approx(x, list(qs), accuracy))):
            aggs.append(agg.alias(f"_s{i}_{fields.index(f)}"))
    rows = _stack(df.agg(*aggs), list(columns), fields, "column_name")
    return rows.select("column_name", *fields[:5], *[F.col("q")[j].alias(n) for j, n in enumerate(names)])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix, long form (var_x, var_y, corr). All k(k+1)/2
    pairs in ONE aggregation, mirrored; pairwise NULL handling; a constant
    column gives NULL instead of an error."""
    cols = list(columns)
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    wide = df.agg(*[safe_corr(colref(a), colref(b)).alias(f"_p{k}")
                    for k, (a, b) in enumerate(pairs)])
    structs = []
    for k, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                                F.col(f"_p{k}").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("var_x"), F.lit(a).alias("var_y"),
                                    F.col(f"_p{k}").alias("corr")))
    return wide.select(F.inline(F.array(*structs)))


def correlation_tiles(df: DataFrame, columns: Sequence[str], tile: int = 64) -> DataFrame:
    """A14 for hundreds of columns: the same long form as :func:`correlation_matrix`, whose k(k+1)/2 aggregates
    one stage cannot hold.

    Tasks add up the co-moments of their rows (pairwise NULLs and NaN left out) as matrix products over
    Arrow batches, shifted by the columns' means against cancellation, and give one row per pair of column
    tiles; the tiles are summed cell by cell. A task holds six k x k matrices, the shuffle k * k / 2 cells a task."""
    cols = list(columns)
    number = [F.when(~F.isnan(colref(c).cast("double")), colref(c).cast("double")) for c in cols]
    half = max(1, min(200, len(cols)))
    centre: list = []
    for lo in range(0, len(cols), half):
        centre += list(df.agg(*[F.avg(x) for x in number[lo:lo + half]]).first())
    shift = [c or 0.0 for c in centre]
    k, names = len(cols), ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def moments(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64) if b.num_rows else np.zeros((0, k))
            m = ~np.isnan(x)
            x = np.where(m, x - shift, 0.0)
            m = m.astype(np.float64)
            sx, sxx = x.T @ m, (x * x).T @ m
            own = [m.T @ m, sx, sx.T, sxx, sxx.T, x.T @ x]
            total = own if total is None else [a + o for a, o in zip(total, own)]
        if total is None:
            return
        for i in range(0, k, tile):
            for j in range(i, k, tile):
                cells = [t[i:i + tile, j:j + tile].reshape(1, -1) for t in total]
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([j]), *[pa.array(list(c), pa.list_(pa.float64())) for c in cells]],
                                                 ["i", "j", *names])

    parts = df.select(*[x.alias(f"x{i}") for i, x in enumerate(number)]).mapInArrow(
        moments, "i long, j long, " + ", ".join(f"{c} array<double>" for c in names))
    cells = parts.select("i", "j", F.posexplode(F.arrays_zip(*names)).alias("at", "c")).groupBy("i", "j", "at").agg(
        *[F.sum(f"c.{c}").alias(c) for c in names])
    wide = F.least(F.lit(tile), F.lit(k) - F.col("j"))
    x, y = (F.col("i") + F.floor(F.col("at") / wide)).cast("int"), (F.col("j") + F.col("at") % wide).cast("int")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    # a constant column's spread is rounding of its shift alone
    flat = (vx <= F.col("n") * F.pow(F.col("ax") * 1e-13, 2)) | (vy <= F.col("n") * F.pow(F.col("ay") * 1e-13, 2))
    label = F.array(*[F.lit(c) for c in cols])
    size = F.array(*[F.lit(abs(c)) for c in shift])
    pairs = (cells.where("n > 1").withColumns({"x": x, "y": y}).withColumns({"ax": size[F.col("x")], "ay": size[F.col("y")]})
             .withColumn("corr", F.when(~flat, cov / F.sqrt(vx * vy))))
    grid = df.sparkSession.range(k * k).select((F.col("id") / k).cast("int").alias("gx"), (F.col("id") % k).cast("int").alias("gy"))
    found = grid.join(pairs.select("x", "y", "corr"), (F.col("x") == F.least("gx", "gy")) & (F.col("y") == F.greatest("gx", "gy")), "left")
    return found.select(label[F.col("gx")].alias("var_x"), label[F.col("gy")].alias("var_y"), "corr")


def table_schema(df: DataFrame, table_name: str) -> DataFrame:
    """Shape and column types as rows (table_name, column_name, position,
    data_type, num_rows, num_columns). The types come from the schema
    (metadata, literal structs); the row count is one partial+final count over
    the table. All JVM-side: no local rows shipped from Python."""
    fields = df.schema.fields
    rows = F.array(*[F.struct(F.lit(table_name).alias("table_name"),
                              F.lit(f.name).alias("column_name"),
                              F.lit(i + 1).cast("bigint").alias("position"),
                              F.lit(f.dataType.simpleString()).alias("data_type"))
                     for i, f in enumerate(fields)])
    count = df.agg(F.count(F.lit(1)).cast("bigint").alias("num_rows"))
    return (count.select(F.inline(rows), "num_rows")
            .withColumn("num_columns", F.lit(len(fields)).cast("bigint")))


def filter_domain(df: DataFrame, column: str) -> DataFrame:
    """A22 + T9: distinct non-NULL values, sorted."""
    return _domain(df, column).orderBy(colref(column))


def _domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(colref(column).alias(column)).where(colref(column).isNotNull()).distinct()


def period_bounds(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """First and last period."""
    return df.agg(F.min(spec.period).alias("first_period"),
                  F.max(spec.period).alias("last_period"))


def domain_stride(df: DataFrame, column: str, step: int = 2) -> DataFrame:
    """Every ``step``-th value of the sorted distinct domain (slider
    marks), with its mark number. The position of each distinct value comes
    from the bucketed ordinal helper, so even a huge domain is numbered in
    parallel (no global ``row_number`` window in one task)."""
    pos = value_positions(_domain(df, column), [], column)
    return (pos.where(F.col("_start") % step == 0)
            .select(column, (F.col("_start") / step).cast("bigint").alias("mark")))


def exploration_summary(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row - period range, entity and record counts, top performer
    of the latest period, most improved entity (last - first). The two
    top-1 results are scalar subqueries: no join."""
    top = top_n(latest_slice(panel, spec), spec.score, spec.entity, 1).select(spec.entity)
    imp = top_n(net_change(panel, spec), "net_change", spec.entity, 1).select(spec.entity)
    return panel.agg(
        F.min(spec.period).alias("first_period"),
        F.max(spec.period).alias("last_period"),
        F.count_distinct(spec.entity).cast("bigint").alias("num_entities"),
        F.count(F.lit(1)).cast("bigint").alias("total_records"),
    ).select("*", top.scalar().alias("top_performer"), imp.scalar().alias("most_improved"))
