"""What a step may cost, by its plan and its stored rows: findings of round 3."""

import re

from pyspark.sql import functions as F

from panelkit.plans.bindings import nation_panel, part_panel
from panelkit.plans.pipeline import extract_indicators
from panelkit.sources.catalog import data_catalog
from panelkit.sources.indicator import parse_envelopes


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_parsed_once_where_broken_ones_are_errors(spark):
    df = spark.createDataFrame([('[{}, [{"indicator": {"id": "I", "value": "i"}, "country": {"id": "C", "value": "c"}, "date": "2000", "value": 1.5}]]',)], "value string")
    for mode in ("fail", "skip"):
        got = parse_envelopes(df, on_broken=mode)
        assert [tuple(r) for r in got.collect()] == [("I", "i", "C", "c", None, 2000, 1.5)]
        assert len(re.findall(r"from_json\(StructField\(id", _plan(got))) == 2  # indicator and country


def test_catalog_reads_the_text_once(spark, tmp_dir):
    spark.createDataFrame([("a", "1,2"), ("b", "3")], "x string, y string").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/plain")
    got = data_catalog(spark, f"{tmp_dir}/plain")
    assert [(r.rows, r.columns) for r in got.collect()] == [(2, 2)]
    assert "FileScan text" not in _plan(got)
    with open(f"{tmp_dir}/long.csv", "w") as f:  # a header over two lines
        f.write('x,"y\nz,",w\n1,2,3\n')
    got = {r.filename: (r.rows, r.columns) for r in data_catalog(spark, tmp_dir).collect()}
    assert got["long.csv"] == (1, 3) and len(got) == 2


def test_records_are_kept_for_rejected_rows_only(spark, tmp_dir):
    with open(f"{tmp_dir}/worldbank_x.csv", "w") as f:
        f.write("indicator,country,countryiso3code,date,value\n"
                + "".join(f"\"{{'id': 'I', 'value': 'i'}}\",\"{{'id': 'C', 'value': 'c'}}\",CCC,{y},{v}\n" for y, v in ((2000, 1.5), (2001, "n/a"))))
    rows, rejects, report = extract_indicators(spark, f"{tmp_dir}/worldbank_*.csv", f"{tmp_dir}/out")
    assert [(r.year, r.value) for r in rows.collect()] == [(2000, 1.5)]
    assert [(r.reason, "n/a" in r.record) for r in rejects.collect()] == [("value", True)]
    assert [(r.rows, r.rejected) for r in report.collect()] == [(1, 1)]
    stored = spark.read.parquet(f"{tmp_dir}/out/raw_indicators.parquet")
    assert stored.where(~F.col("rejected") & F.col("record").isNotNull()).count() == 0


def _tables(spark, d):
    spark.range(40).selectExpr("id % 8 AS l_orderkey", "id % 5 AS l_partkey", "1.25D AS l_extendedprice", "2D AS l_quantity", "0.1D AS l_discount",
                               "0.2D AS l_tax", "timestamp'1997-05-01' AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(8).selectExpr("id AS o_orderkey", "id % 2 AS o_custkey", "date'1997-01-01' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(2).selectExpr("id AS c_custkey", "id AS c_nationkey").write.parquet(f"{d}/customer.parquet")
    spark.range(2).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{d}/nation.parquet")


def test_part_panel_deals_lines_before_it_sums(spark, tmp_dir):
    _tables(spark, tmp_dir)
    got = part_panel(spark, tmp_dir)
    assert sorted((r.l_partkey, r.ship_year, r.revenue, r.line_count) for r in got.collect()) == [(k, 1997, 10.0, 8.0) for k in range(5)]
    plan = _plan(part_panel(spark, tmp_dir))
    assert plan.rindex("HashAggregate") < plan.index("Exchange")  # no sums in the scan's tasks, whose share grows with the table


def test_nation_panel_deals_lines_before_it_sums(spark, tmp_dir):
    _tables(spark, tmp_dir)
    got = nation_panel(spark, tmp_dir)
    assert sorted((r.n_name, r.revenue, r.line_count) for r in got.collect()) == [("N0", 25.0, 20.0), ("N1", 25.0, 20.0)]
    plan = _plan(nation_panel(spark, tmp_dir))
    below = plan[plan.rindex("HashAggregate(keys=[l_orderkey"):].splitlines()[1:]
    assert "Exchange" in "".join(below[:2])
