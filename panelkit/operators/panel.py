"""Derivations on an entity x period panel: the clean panel and its summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import round_half_up, row_mean
from panelkit.operators.ordinal import competition_rank
from panelkit.session import materialize, shuffle_partitions
from panelkit.spec import PanelSpec


def select_panel(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """P1 + P6: the panel columns, rows from ``spec.start`` on (NULL period dropped)."""
    out = panel.select(*spec.columns)
    if spec.start is not None:
        out = out.where(F.col(spec.period) >= F.lit(spec.start))
    return out


def with_component_mean(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Row mean of the components, NULL if any component is NULL."""
    return df.withColumn(spec.component_mean, row_mean(spec.components))


def with_rank(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Competition rank of the score within each period, best first,
    NULL scores last. Skew-proof (see ``ordinal``): a period is never one task."""
    return competition_rank(df, [spec.period], spec.score, spec.rank, descending=True)


def _place(df: DataFrame, keys: list[str]) -> Column:
    """The sort key of a row as one comparable value, NULLs last in each part."""
    return F.struct(*[x for c in keys for x in (F.col(c).isNull(), F.col(c))])


def with_change(df: DataFrame, spec: PanelSpec, partitions: int | None = None) -> DataFrame:
    """W1 + W2: score minus the previous row's score of the same entity
    (row offset: a gap year still uses the previous row).

    No entity is one task: rows are range-partitioned by (entity, period, score) and written once with their
    partition's number, the change is taken within (partition, entity), and the first row of each
    partition gets the last score of its entity from the partition before it that has rows: a table of
    one row per partition. Boundaries change the balance, never the answer."""
    order = [spec.entity, spec.period, spec.score]
    keys = [F.asc_nulls_last(c) for c in order]
    parts = partitions or shuffle_partitions(df.sparkSession)
    rows = materialize(df.repartitionByRange(parts, *keys).withColumn("_pk_part", F.spark_partition_id()), "ordered")

    place = _place(rows, order)
    ends = rows.groupBy("_pk_part").agg(F.min(place)[spec.entity].alias("_pk_first"), F.max(place).alias("_pk_last"))
    before = Window.orderBy("_pk_part")  # as many rows as partitions
    carry = ends.select(
        F.col("_pk_part").alias("_pk_to"), "_pk_first", F.lag(F.col("_pk_last")[spec.entity]).over(before).alias("_pk_entity"),
        F.lag(F.col("_pk_last")[spec.score]).over(before).alias("_pk_carried"), F.row_number().over(before).alias("_pk_nth"))
    # carried only into a partition that goes on with the same entity
    carry = carry.where((F.col("_pk_nth") > 1) & F.col("_pk_first").eqNullSafe(F.col("_pk_entity")))

    own = Window.partitionBy("_pk_part", spec.entity).orderBy(*keys[1:])
    rows = rows.withColumns({"_pk_prev": F.lag(spec.score, 1).over(own), "_pk_row": F.row_number().over(own)})
    goes_on = (F.col("_pk_row") == 1) & (F.col("_pk_part") == F.col("_pk_to")) & F.col(spec.entity).eqNullSafe(F.col("_pk_first"))
    rows = rows.join(F.broadcast(carry), F.col("_pk_part") == F.col("_pk_to"), "left")
    prev = F.when(goes_on, F.col("_pk_carried")).otherwise(F.col("_pk_prev"))
    return rows.select(*df.columns, (F.col(spec.score) - prev).alias(spec.change))


def clean_panel(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """``clean_infrastructure`` - panel + component mean + change + rank.

    Neither the rank nor the change puts a period or an entity into one task.
    No global sort: order only at export (``sinks``)."""
    base = with_component_mean(select_panel(panel, spec), spec)
    out = with_change(with_rank(base, spec), spec)
    return out.select(*spec.columns, spec.component_mean, spec.change, spec.rank)


def _keys(df: DataFrame, key: str, drop_null_keys: bool) -> DataFrame:
    """SQL GROUP BY keeps a NULL key as a group; pandas ``groupby`` drops it
    (A4/A5). The default is the SQL behaviour."""
    return df.where(F.col(key).isNotNull()) if drop_null_keys else df


def entity_summary(clean: DataFrame, spec: PanelSpec, drop_null_keys: bool = False) -> DataFrame:
    """A1 (and its pandas subset A4): ``country_summary`` - one row per
    entity (partial + final hash agg)."""
    s = F.col(spec.score)
    return _keys(clean, spec.entity, drop_null_keys).groupBy(spec.entity).agg(
        F.min(spec.period).alias("first_year"),
        F.max(spec.period).alias("last_year"),
        F.count(F.lit(1)).cast("bigint").alias("num_years"),
        F.avg(s).alias("avg_score"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        (F.max(s) - F.min(s)).alias("score_improvement"),
        F.avg(spec.change).alias("avg_yearly_change"),
    )


def period_trends(clean: DataFrame, spec: PanelSpec, approx: bool = False,
                  drop_null_keys: bool = False) -> DataFrame:
    """A2 (and its pandas subset A5): ``yearly_trends`` - per period mean,
    sample std, min, max and the
    number of distinct entities (two-phase distinct aggregation; ``approx``
    uses a HyperLogLog++ sketch instead: one partial aggregation, ~1% error)."""
    s = F.col(spec.score)
    distinct = (F.approx_count_distinct(spec.entity) if approx
                else F.count_distinct(spec.entity))
    return _keys(clean, spec.period, drop_null_keys).groupBy(spec.period).agg(
        F.avg(s).alias("global_avg_score"),
        F.stddev_samp(s).alias("score_std_dev"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        distinct.cast("bigint").alias("num_countries"),
    )


def net_change(panel: DataFrame, spec: PanelSpec, out: str = "net_change") -> DataFrame:
    """Last minus first score of each entity, by period (not file order)."""
    return panel.groupBy(spec.entity).agg(
        (F.max_by(spec.score, spec.period) - F.min_by(spec.score, spec.period)).alias(out))


def exact_mean(c: str) -> Column:
    """Mean from an exact DECIMAL sum: the same value whatever the partitioning
    or summation order (a double sum is not), so rounding it is reproducible.
    The sum has 12 decimals; values below that or beyond 10^26, NaN and infinity
    take the double mean."""
    x = F.col(c).cast("double")
    d = x.try_cast("decimal(38,12)")
    fits = F.count_if(x.isNotNull() & (d.isNull() | ((d == 0) & (x != 0)))) == 0
    return F.when(fits, F.try_sum(d).cast("double") / F.count(c)).otherwise(F.avg(x))


def entity_profile(panel: DataFrame, spec: PanelSpec, digits: int = 2) -> DataFrame:
    """Score mean/std/min/max and the mean of each component per entity,
    rounded (half up) to ``digits``. Means use :func:`exact_mean`, so a mean
    sitting on a rounding half point always rounds the same way."""
    s = spec.score
    aggs = [
        round_half_up(exact_mean(s), digits).alias(f"{s}_mean"),
        round_half_up(F.stddev_samp(s), digits).alias(f"{s}_std"),
        round_half_up(F.min(s), digits).alias(f"{s}_min"),
        round_half_up(F.max(s), digits).alias(f"{s}_max"),
    ]
    aggs += [round_half_up(exact_mean(c), digits).alias(f"{c}_mean") for c in spec.components]
    return panel.groupBy(spec.entity).agg(*aggs)
