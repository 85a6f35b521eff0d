"""Deterministic panel spine (S5): entities x periods with derived scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.spec import (REFERENCE_BASE, REFERENCE_COUNTRIES, REFERENCE_ENTITY_STEP,
                           REFERENCE_FIRST_YEAR, REFERENCE_LAST_YEAR, REFERENCE_OFFSETS,
                           REFERENCE_PERIOD_STEP, REFERENCE_SPEC, PanelSpec)


def panel_grid(entities: DataFrame, spec: PanelSpec, first: int, last: int,
               index: str = "idx", base: float = REFERENCE_BASE,
               entity_step: float = REFERENCE_ENTITY_STEP,
               period_step: float = REFERENCE_PERIOD_STEP,
               offsets: Mapping[str, float] = REFERENCE_OFFSETS) -> DataFrame:
    """Every entity (with its position ``index``) x every period first..last:
    score = base + entity_step*index + period_step*(period - first); each
    component = score + its offset.

    The periods are generated per entity row (``explode(sequence)``), so the
    grid is a narrow, partition-local expansion of the entity table - no join
    and no shuffle, however many entities there are."""
    span = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))
    rows = entities.select(spec.entity, index, F.explode(span).alias(spec.period))
    s = (F.lit(base) + F.lit(entity_step) * F.col(index)
         + F.lit(period_step) * (F.col(spec.period) - F.lit(first)))
    return rows.select(spec.entity, spec.period, s.alias(spec.score),
                       *[(s + F.lit(offsets[c])).alias(c) for c in spec.components])


def reference_panel(spark: SparkSession, countries: Sequence[str] = REFERENCE_COUNTRIES,
                    first: int = REFERENCE_FIRST_YEAR, last: int = REFERENCE_LAST_YEAR) -> DataFrame:
    """The reference's 15 x 14 scorecard (the golden fixture)."""
    ents = spark.createDataFrame([(c, i) for i, c in enumerate(countries)],
                                 f"{REFERENCE_SPEC.entity} string, idx bigint")
    return panel_grid(ents, REFERENCE_SPEC, first, last)
