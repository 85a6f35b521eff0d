"""Panels derived from the driver's TPC-H-like tables.

Two bindings (SURVEY 7.2):

* part panel - entity ``l_partkey``, period ``year(l_shipdate)``: the scale
  binding, one aggregation over ``lineitem``;
* nation panel - entity ``n_name``, period ``year(o_orderdate)``: the
  reference's shape (a few dozen entities), lineitem -> orders -> customer ->
  nation.

The measures are money amounts and quantities with at most 4 decimals. They
are summed as DECIMAL(18,4) and the exact sum becomes a double at the end: the
panel is the same whatever the partitioning, summation order or size, in Spark
and in any other engine. (A sum of doubles is faster but exact only up to about
1e11.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import sized_partitions
from panelkit.spec import PanelSpec

COMPONENT_LABELS = {
    "quantity": "Quantity",
    "discount": "Discount",
    "tax": "Tax",
    "line_count": "Lines",
}
COMPONENTS = ("quantity", "discount", "tax", "line_count")

PART_SPEC = PanelSpec(entity="l_partkey", period="ship_year", score="revenue",
                      components=COMPONENTS, start=1996, labels=COMPONENT_LABELS)
NATION_SPEC = PanelSpec(entity="n_name", period="order_year", score="revenue",
                        components=COMPONENTS, start=1996, labels=COMPONENT_LABELS)



def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _sum4(c) -> Column:
    return F.sum(F.col(c).cast("decimal(18,4)"))


def _measures(prefix: str = "", d=_sum4) -> list:
    return [
        d("l_extendedprice").alias(prefix + "revenue"),
        d("l_quantity").alias(prefix + "quantity"),
        d("l_discount").alias(prefix + "discount"),
        d("l_tax").alias(prefix + "tax"),
        F.count(F.lit(1)).alias(prefix + "line_count"),
    ]


def _to_double(cols: list[str]) -> list:
    return [F.col(c).cast("double").alias(c) for c in cols]


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_partkey, ship_year) -> revenue, quantity, discount, tax, line_count.

    Rows are dealt by the keys before they are summed, to as many tasks as ``lineitem`` has shares of 8 MB: the
    lines of a part lie all over the table, so sums within a scan task hold nearly a group a line, the
    more the larger its split."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate").cast("bigint"))
    n = sized_partitions(spark, _path(sf_dir, "lineitem"))
    agg = li.repartition(n, "l_partkey", "ship_year").groupBy("l_partkey", "ship_year").agg(*_measures())
    return agg.select("l_partkey", "ship_year",
                      *_to_double(["revenue", *COMPONENTS]))


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_name, order_year) -> the same measures.

    Lines are summed per order *before* the join (eager aggregation): the
    join needs lineitem hash-partitioned by order key anyway, so the
    pre-aggregation costs no extra shuffle and shrinks the joined rows ~4x.
    Lines are dealt before they are summed, to a task per 8 MB of ``lineitem``, and the
    join with orders goes on in the same tasks: their memory does not grow with the table.
    ``nation`` is left to Catalyst/AQE, which broadcast it from its measured
    size (25 rows)."""
    li = read_table(spark, sf_dir, "lineitem")
    n = sized_partitions(spark, _path(sf_dir, "lineitem"))
    per_order = li.repartition(n, "l_orderkey").groupBy("l_orderkey").agg(*_measures("o_"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.year("o_orderdate").cast("bigint").alias("order_year"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    agg = j.groupBy("n_name", "order_year").agg(
        F.sum("o_revenue").alias("revenue"),
        F.sum("o_quantity").alias("quantity"),
        F.sum("o_discount").alias("discount"),
        F.sum("o_tax").alias("tax"),
        F.sum("o_line_count").alias("line_count"),
    )
    return agg.select("n_name", "order_year", *_to_double(["revenue", *COMPONENTS]))
