"""Scale properties of the physical plans, pinned so that they cannot regress
silently: column pruning, pushdown, partition pruning, no hot-group window,
map-side top-k, eager aggregation before a join."""

import contextlib
import io
import os
import re

import pytest

from panelkit.operators.leaders import latest_slice, top_per_period
from panelkit.operators.panel import clean_panel, select_panel, with_rank
from panelkit.operators.views import view_ranking
from panelkit.plans.bindings import PART_SPEC, nation_panel, part_panel, read_table
from panelkit.sources.sinks import read_parquet, write_parquet

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("gold"))
    panel = part_panel(spark, SF)
    clean = clean_panel(panel, PART_SPEC)
    write_parquet(clean, f"{d}/clean", partition_by=["ship_year"])
    return read_parquet(spark, f"{d}/clean", clean.schema)


def test_panel_scan_reads_only_needed_columns(spark):
    text = plan(part_panel(spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_shipdate"}


def test_filter_pushed_to_parquet(spark):
    from pyspark.sql import functions as F
    df = read_table(spark, SF, "lineitem").where(F.col("l_shipdate") >= "1998-01-01")
    assert "GreaterThanOrEqual(l_shipdate" in plan(df.select("l_partkey"))


def test_latest_slice_prunes_partitions_without_shuffle(gold):
    text = plan(latest_slice(gold, PART_SPEC))
    assert re.search(r"PartitionFilters: \[[^\]]*ship_year#\d+L? = Subquery", text)
    assert "Exchange" not in text.split("\n\n")[0]


def test_one_period_view_prunes_partitions(gold):
    assert re.search(r"PartitionFilters: \[[^\]]*\(ship_year#\d+L? = 1998\)",
                     plan(view_ranking(gold, PART_SPEC, 1998)))


def test_top_per_period_limits_before_shuffle(gold):
    tree = plan(top_per_period(gold, PART_SPEC, 10)).split("\n\n")[0]
    limit_lines = [i for i, line in enumerate(tree.splitlines()) if "WindowGroupLimit" in line]
    exchange_lines = [i for i, line in enumerate(tree.splitlines()) if "Exchange" in line]
    assert len(limit_lines) == 2 and min(exchange_lines) < max(limit_lines)  # one below the exchange


def test_rank_window_never_partitions_by_period_alone(spark):
    """The running count over the values is windowed by (period, bucket); only
    the tiny bucket-totals table (#periods x B rows) is windowed by period."""
    panel = part_panel(spark, SF)
    text = plan(with_rank(select_panel(panel, PART_SPEC), PART_SPEC))
    windows = re.findall(r"\(\d+\) Window\nInput \[\d+\]: \[([^\]]*)\]\n"
                         r"Arguments: \[.*?\], \[([^\]]*)\]", text)
    over_values = [keys for inputs, keys in windows if "revenue" in inputs and "_cnt" in inputs]
    assert over_values
    for keys in over_values:
        assert {k.split("#")[0].strip() for k in keys.split(",")} == {"ship_year", "_bucket"}


def test_nation_panel_aggregates_lines_before_joining(spark):
    tree = plan(nation_panel(spark, SF)).split("\n\n")[0].splitlines()
    first_join = max(i for i, line in enumerate(tree) if "Join" in line)  # deepest join
    below = tree[first_join:]
    assert any("HashAggregate" in line for line in below)


def test_no_registered_plan_has_nested_loop_or_cartesian_joins(spark):
    import __spark_entry__ as E
    bad = {}
    for key, build in E.queries().items():
        text = plan(build(spark, SF))
        found = [w for w in ("BroadcastNestedLoopJoin", "CartesianProduct") if w in text]
        if found:
            bad[key] = found
    assert not bad
