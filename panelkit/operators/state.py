"""Summaries that grow by merging stored states (A1, A4, A20, A6) instead of reading all periods again.

A state is a table of one row per entity: counts, exact sums, moments, extremes and the first and
last score. States of consecutive stretches of time merge into the state of both; the summary and the
profile are projections of a state. When a period arrives, only that period and the state are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import round_half_up
from panelkit.operators.panel import with_change
from panelkit.session import materialize
from panelkit.sources.sinks import read_parquet, write_parquet
from panelkit.spec import PanelSpec

_EXACT = "decimal(38,12)"


def _exact_sum(c: str) -> Column:
    """Exact and free of order; NULL where a value has no such decimal (``_mean`` then takes the moments)."""
    d = F.col(c).cast("double").try_cast(_EXACT)
    return F.when(F.count_if(F.col(c).isNotNull() & d.isNull()) == 0, F.coalesce(F.try_sum(d), F.lit(0)).cast(_EXACT))


def entity_state(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """State of ``rows`` (raw panel rows of some periods): one row per entity."""
    s, p = spec.score, spec.period
    changes = with_change(rows.select(*spec.columns), spec)
    aggs = [F.min(p).alias("first_period"), F.max(p).alias("last_period"), F.count(F.lit(1)).alias("num_rows"),
            F.min(s).alias("lo"), F.max(s).alias("hi"), F.min_by(s, p).alias("first_score"), F.max_by(s, p).alias("last_score"),
            F.avg(s).alias("centre"), F.coalesce(F.var_pop(s) * F.count(s), F.lit(0.0)).alias("spread"),
            F.count(spec.change).alias("num_changes"), _exact_sum(spec.change).alias("change_total"), F.sum(spec.change).alias("change_sum")]
    for i, c in enumerate((s, *spec.components)):
        aggs += [F.count(c).alias(f"n{i}"), _exact_sum(c).alias(f"total{i}"), F.sum(F.col(c).cast("double")).alias(f"sum{i}")]
    return changes.groupBy(spec.entity).agg(*aggs)


def merge_states(old: DataFrame, new: DataFrame, spec: PanelSpec) -> DataFrame:
    """State of both; all periods of ``new`` lie after those of ``old`` (per entity), else it is an error.
    The join is on the entity, one row a side; the change between the two stretches is added here."""
    o, n = old.alias("o"), new.alias("n")
    a, b = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    zero = lambda x: F.coalesce(x, F.lit(0))
    plus = lambda c: (zero(a(c)) + zero(b(c))).alias(c)
    both = a("num_rows").isNotNull() & b("num_rows").isNotNull()
    step = F.when(both, b("first_score") - a("last_score"))
    exact = lambda c, *more: F.when((a("num_rows").isNull() | a(c).isNotNull()) & (b("num_rows").isNull() | b(c).isNotNull()), (
        sum((zero(x) for x in (a(c), b(c), *more)), F.lit(0).cast(_EXACT))).cast(_EXACT)).alias(c)
    na, nb = zero(a("n0")), zero(b("n0"))
    gap = b("centre") - a("centre")
    late = F.when(both & (b("first_period") <= a("last_period")), F.raise_error(F.concat(
        F.lit("period "), b("first_period").cast("string"), F.lit(" is not after the state's "), a("last_period").cast("string"))).cast("bigint"))
    cols = [
        F.coalesce(a(spec.entity), b(spec.entity)).alias(spec.entity),
        F.coalesce(late, F.least(a("first_period"), b("first_period"))).alias("first_period"),
        F.greatest(a("last_period"), b("last_period")).alias("last_period"), plus("num_rows"),
        F.least(a("lo"), b("lo")).alias("lo"), F.greatest(a("hi"), b("hi")).alias("hi"),
        F.when(a("num_rows").isNotNull(), a("first_score")).otherwise(b("first_score")).alias("first_score"),
        F.when(b("num_rows").isNotNull(), b("last_score")).otherwise(a("last_score")).alias("last_score"),
        F.when(na == 0, b("centre")).when(nb == 0, a("centre")).otherwise(a("centre") + gap * nb / (na + nb)).alias("centre"),
        (zero(a("spread")) + zero(b("spread")) + F.when((na > 0) & (nb > 0), gap * gap * na * nb / (na + nb)).otherwise(0.0)).alias("spread"),
        (zero(a("num_changes")) + zero(b("num_changes")) + step.isNotNull().cast("long")).alias("num_changes"),
        exact("change_total", step.try_cast(_EXACT)),
        (zero(a("change_sum")) + zero(b("change_sum")) + zero(step)).alias("change_sum")]
    for i in range(len(spec.components) + 1):
        cols += [plus(f"n{i}"), exact(f"total{i}"), plus(f"sum{i}")]
    return o.join(n, a(spec.entity).eqNullSafe(b(spec.entity)), "full_outer").select(*cols)


def _mean(total: str, plain: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.coalesce(F.col(total).cast("double"), F.col(plain)) / F.col(n))


def summary_of(state: DataFrame, spec: PanelSpec) -> DataFrame:
    """A1 from a state: the columns of ``panel.entity_summary``."""
    return state.select(
        spec.entity, F.col("first_period").alias("first_year"), F.col("last_period").alias("last_year"),
        F.col("num_rows").cast("bigint").alias("num_years"), _mean("total0", "sum0", "n0").alias("avg_score"),
        F.col("lo").alias("min_score"), F.col("hi").alias("max_score"), (F.col("hi") - F.col("lo")).alias("score_improvement"),
        _mean("change_total", "change_sum", "num_changes").alias("avg_yearly_change"))


def profile_of(state: DataFrame, spec: PanelSpec, digits: int = 2) -> DataFrame:
    """A20 from a state: the columns of ``panel.entity_profile``."""
    s, r = spec.score, lambda x: round_half_up(x, digits)
    std = F.when(F.col("n0") > 1, F.sqrt(F.col("spread") / (F.col("n0") - 1)))
    return state.select(spec.entity, r(_mean("total0", "sum0", "n0")).alias(f"{s}_mean"), r(std).alias(f"{s}_std"), r("lo").alias(f"{s}_min"),
                        r("hi").alias(f"{s}_max"), *[r(_mean(f"total{i}", f"sum{i}", f"n{i}")).alias(f"{c}_mean")
                                                     for i, c in enumerate(spec.components, 1)])


def add_period(spark: SparkSession, panel: DataFrame, state_dir: str, spec: PanelSpec, period) -> DataFrame:
    """Merge one period of a panel stored by period into the stored state ``state_dir`` (made if there is
    none). Reads that period's folder and the state alone. The new state is written aside and then put in
    place, so a run that dies leaves the old one and can be repeated. Returns the new state."""
    from pyspark.errors import AnalysisException

    new = entity_state(panel.where(F.col(spec.period) == F.lit(period)), spec)
    try:
        old = spark.read.parquet(state_dir)
        new = merge_states(old, new, spec)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    kept = materialize(new, "state")
    write_parquet(kept, state_dir)
    return read_parquet(spark, state_dir, kept.schema)


def distinct_sketches(df: DataFrame, by: list[str], column: str, lg_size: int = 12) -> DataFrame:
    """A6 to be stored: per ``by`` (for example the period) a HyperLogLog sketch of ``column`` of at most
    2^lg_size bytes and the number of rows; sketches of new partitions are simply added."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, lg_size).alias("sketch"), F.count(F.lit(1)).cast("bigint").alias("rows"))


def distinct_of(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct values in the union of stored sketches, overall or per ``by``, without the rows. The
    relative standard error is 1.04 / sqrt(2^lg_size): 1.6 % for the default size."""
    return sketches.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias("distinct_estimate"),
                                             F.sum("rows").cast("bigint").alias("rows"))
