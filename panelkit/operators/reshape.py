"""Wide <-> long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import materialize, shuffle_partitions
from panelkit.spec import PanelSpec


def unpivot_components(df: DataFrame, spec: PanelSpec, ids: Sequence[str] | None = None,
                       with_labels: bool = True) -> DataFrame:
    """R1 + R3: (ids..., variable, value[, label]). Display labels are bound
    by column name through a literal map (never by position, SURVEY C2)."""
    ids = list(ids if ids is not None else spec.key)
    long = df.unpivot(ids, list(spec.components), "variable", "value")
    if with_labels and spec.labels:
        lm = F.create_map(*[x for k, v in spec.labels.items() for x in (F.lit(k), F.lit(v))])
        long = long.withColumn("label", lm[F.col("variable")])
    return long


def component_matrix(df: DataFrame, spec: PanelSpec,
                     entities: Sequence[str] | None = None) -> DataFrame:
    """R2: component x entity matrix (the transpose of entity x component).

    Long form (variable, entity, value) is the scalable default. With an
    explicit entity list the matrix is pivoted wide - the list bounds the
    number of columns and spares Spark the extra distinct-values job."""
    long = unpivot_components(df, spec, [spec.entity], with_labels=False)
    if entities is None:
        return long
    return (long.groupBy("variable").pivot(spec.entity, list(entities))
            .agg(F.first("value")))


def component_blocks(panel: DataFrame, spec: PanelSpec, width: int = 100) -> tuple[DataFrame, DataFrame]:
    """R2 in wide form over any number of entities: ``(blocks, index)``.

    ``blocks``: one row per component and block of ``width`` entities (in their order), with their names and
    values as arrays, a missing cell NULL. ``index``: (block, first, last, entities). Entities are numbered by
    the range-partitioned ordinals, so neither their list nor their order passes through the driver or one
    task, and a row never holds more than ``width`` cells. :func:`block_table` gives a block as a table."""
    names = panel.where(F.col(spec.entity).isNotNull()).select(spec.entity).distinct()
    places = entity_places(names, spec.entity)
    blocks = (F.col("_place") / width).cast("bigint")
    held = unpivot_components(panel, spec, [spec.entity], with_labels=False).join(places, spec.entity).select(
        blocks.alias("block"), "variable", "_place", spec.entity, "value")
    cells = held.groupBy("block", "variable").agg(F.sort_array(F.collect_list(F.struct("_place", spec.entity, "value"))).alias("x"))
    wide = cells.select("block", "variable", F.col(f"x.{spec.entity}").alias("names"), F.col("x.value").alias("values"))
    index = places.groupBy(blocks.alias("block")).agg(
        F.min_by(spec.entity, "_place").alias("first"), F.max_by(spec.entity, "_place").alias("last"), F.count(F.lit(1)).cast("bigint").alias("entities"))
    return wide, index


def entity_places(names: DataFrame, entity: str) -> DataFrame:
    """(entity, _place): each distinct name's 0-based place in the order of names, by ranges of names."""
    spread = materialize(names.repartitionByRange(shuffle_partitions(names.sparkSession), entity)
                         .withColumn("_part", F.spark_partition_id()), "names")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    starts = spread.groupBy("_part").count().select(F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(entity)) - 1
    return (spread.withColumn("_nth", nth).join(F.broadcast(starts), F.col("_part") == F.col("_p"))
            .select(entity, (F.col("_start") + F.col("_nth")).alias("_place")))


def block_table(blocks: DataFrame, index: DataFrame, block: int) -> DataFrame:
    """One block as a table: ``variable`` and a column per entity (its at most ``width`` names reach the driver)."""
    own = blocks.where(F.col("block") == block)
    names = own.select(F.explode("names").alias("n")).distinct().orderBy("n").collect()
    cell = F.map_from_arrays("names", "values")
    return own.withColumn("_cells", cell).select("variable", *[F.col("_cells")[F.lit(r["n"])].alias(str(r["n"])) for r in names])
