"""Parameterised read-side queries behind the reference's dashboard.

Each returns a small DataFrame by construction (filtered, top-k or
aggregated). A selection of entities is either a Python list (``isin``) or a
DataFrame of keys (semi join; broadcast when it is a top-k result).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import fixed_text, thousands_text
from panelkit.functions.scalar import colref
from panelkit.operators.leaders import top_in_period, top_n
from panelkit.operators.ordinal import column_summary, exact_quantiles
from panelkit.spec import PanelSpec

Selection = Sequence[str] | DataFrame


def select_entities(df: DataFrame, spec: PanelSpec, selection: Selection,
                    bounded: bool = False) -> DataFrame:
    """Membership filter; an empty list gives an empty result. A DataFrame
    selection is a left-semi join; it is broadcast explicitly only when the
    caller vouches for its size (``bounded``, e.g. a top-k result), otherwise
    Catalyst/AQE choose from measured sizes."""
    if isinstance(selection, DataFrame):
        keys = selection.select(spec.entity)
        return df.join(F.broadcast(keys) if bounded else keys, spec.entity, "left_semi")
    return df.where(F.col(spec.entity).isin(list(selection)))


def kpis(clean: DataFrame, top: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """Entities analysed, mean score (and its ``:.1f`` text), the first top
    performer, data points (and its ``:,`` text) - one row. ``approx`` counts
    entities with a HyperLogLog++ sketch."""
    distinct = (F.approx_count_distinct(spec.entity) if approx
                else F.count_distinct(spec.entity))
    stats = clean.agg(
        distinct.cast("bigint").alias("countries_analyzed"),
        F.avg(spec.score).alias("avg_score"),
        F.count(F.lit(1)).cast("bigint").alias("data_points"))
    best = top_n(top, "latest_score", spec.entity, 1).select(spec.entity)  # scalar subquery
    return stats.select("*", best.scalar().alias("top_performer"),
                        fixed_text("avg_score", 1).alias("avg_score_text"),
                        thousands_text("data_points").alias("data_points_text"))


def view_time_series(clean: DataFrame, spec: PanelSpec, selection: Selection,
                     first, last, bounded: bool = False) -> DataFrame:
    """X7 = P7 + P8 + P14: score over time for selected entities and periods."""
    rows = clean.where(F.col(spec.period).between(F.lit(first), F.lit(last)))
    return (select_entities(rows, spec, selection, bounded)
            .select(spec.entity, spec.period, spec.score))


def view_ranking(clean: DataFrame, spec: PanelSpec, period, n: int = 10) -> DataFrame:
    """N best entities of one period (``nlargest``)."""
    return top_in_period(clean, spec, period, n).select(spec.entity, spec.period, spec.score)


def view_heatmap(clean: DataFrame, spec: PanelSpec, selection: Selection,
                 bounded: bool = False) -> DataFrame:
    """X9 + A16: mean of each component per selected entity (the pivot table
    has only an index, so this is a plain grouped aggregation)."""
    return (select_entities(clean, spec, selection, bounded).groupBy(spec.entity)
            .agg(*[F.avg(c).alias(c) for c in spec.components]))


def view_improvement(summary: DataFrame, spec: PanelSpec, selection: Selection,
                     bounded: bool = False) -> DataFrame:
    """Score improvement of the selected entities, ascending."""
    return (select_entities(summary, spec, selection, bounded)
            .select(spec.entity, "score_improvement")
            .orderBy(F.asc_nulls_last("score_improvement"), F.asc_nulls_last(spec.entity)))


def box_summary(long: DataFrame, group: str = "variable", value: str = "value",
                approx: bool = False, few_groups: bool = False) -> DataFrame:
    """Per group min, quartiles (exact, linear), max, IQR fences = the most
    extreme values within 1.5 IQR of the box, and the outlier count.
    Quartiles use the skew-proof ordinal machinery; the fences are a second,
    conditional aggregation against the per-group quartiles (one row per
    group; broadcast only with ``few_groups``, e.g. one group per component)."""
    q = exact_quantiles(long, [group], value, (0.25, 0.5, 0.75), ("q1", "median", "q3"),
                        approx=approx)
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    qb = F.broadcast(q) if few_groups else q
    stats = long.where(v.isNotNull()).join(qb, group).groupBy(group).agg(
        F.count(v).cast("bigint").alias("n"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(inside, v)).alias("lower_fence"),
        F.max(F.when(inside, v)).alias("upper_fence"),
        F.count_if(~inside).cast("bigint").alias("outliers"))
    return stats.join(q.drop("_lo", "_hi"), group).select(
        group, "n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence", "outliers")


def box_columns(df: DataFrame, columns: Sequence[str], group: str = "variable") -> DataFrame:
    """A17 for columns of one table: :func:`box_summary` of each column, without the long form. Three
    scans of all columns together: sketches, exact quartiles (a row per column reaches the driver),
    and the returned plan, whose fences and outliers are one partial aggregation."""
    names = ("q1", "median", "q3")
    found = [r for r in column_summary(df, columns, (0.25, 0.5, 0.75), names).collect() if r["count"]]
    schema = f"{group} string, n bigint, min double, q1 double, median double, q3 double, max double, lower_fence double, upper_fence double, outliers bigint"
    if not found:
        return df.sparkSession.createDataFrame([], schema)
    aggs, rows = [], []
    for i, r in enumerate(found):
        x, reach = colref(r["column_name"]).cast("double"), 1.5 * (r["q3"] - r["q1"])
        value = F.when(~F.isnan(x), x)
        inside = (value >= r["q1"] - reach) & (value <= r["q3"] + reach)
        aggs += [F.min(F.when(inside, value)).alias(f"l{i}"), F.max(F.when(inside, value)).alias(f"u{i}"),
                 F.count_if(~inside).cast("bigint").alias(f"o{i}")]
        fixed = [F.lit(r[c]).alias(c) for c in ("min", *names, "max")]
        rows.append(F.struct(F.lit(r["column_name"]).alias(group), F.lit(r["count"]).cast("bigint").alias("n"), *fixed,
                             F.col(f"l{i}").alias("lower_fence"), F.col(f"u{i}").alias("upper_fence"), F.col(f"o{i}").alias("outliers")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def view_distribution(clean: DataFrame, spec: PanelSpec, period) -> DataFrame:
    """X11: box summary of every component in one period."""
    return box_columns(clean.where(F.col(spec.period) == F.lit(period)), spec.components)
