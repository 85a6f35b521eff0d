"""Work that grows by what is new: landing runs, stored states and sketches; and forms for very wide or hot data."""

import json
import os
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators.ordinal import column_summary
from panelkit.operators.panel import entity_profile, entity_summary, with_change
from panelkit.operators.profile import correlation_matrix, correlation_tiles, describe_numeric
from panelkit.operators.reshape import block_table, component_blocks
from panelkit.operators.state import add_period, distinct_of, distinct_sketches, entity_state, merge_states, profile_of, summary_of
from panelkit.operators.views import box_columns, box_summary
from panelkit.plans.pipeline import ingest_indicators
from panelkit.sources.grid import reference_panel
from panelkit.sources.sinks import publish_catalog, read_parquet, top_performers_sql, write_parquet
from panelkit.spec import REFERENCE_SPEC as S
from tests.test_adversarial_panel import ROWS, SCHEMA
from tests.test_plans import plan


def _land(folder, name, rows, broken=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps([{"page": 1}, rows]) + broken if not broken else broken)


def _r(code, year, value, country="AU"):
    return {"indicator": {"id": code, "value": code}, "country": {"id": country, "value": country}, "countryiso3code": country, "date": str(year), "value": value}


def test_ingest_takes_in_only_what_is_new(spark, tmp_dir):
    land, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    table = lambda: {(r.indicator, r.country_id, r.year): r.value for r in spark.read.parquet(f"{out}/indicators.parquet").collect()}
    _land(land, "a.json", [_r("A", y, 1.0) for y in (2010, 2011)])
    _land(land, "b.json", [_r("B", 2010, 5.0), _r("B", 2010, 6.0)])
    ingest_indicators(spark, land, out, {"A": "alpha"})
    assert table() == {("alpha", "AU", 2010): 1.0, ("alpha", "AU", 2011): 1.0, ("B", "AU", 2010): 6.0}
    kept = {f: os.path.getmtime(f) for f in _files(f"{out}/indicators.parquet/indicator=B")}
    time.sleep(1.1)
    _land(land, "a2.json", [_r("A", 2011, 2.0), _r("A", 2012, None)])          # a correction and a new year
    ingest_indicators(spark, land, out, {"A": "alpha"})
    assert table() == {("alpha", "AU", 2010): 1.0, ("alpha", "AU", 2011): 2.0, ("alpha", "AU", 2012): None, ("B", "AU", 2010): 6.0}
    assert kept == {f: os.path.getmtime(f) for f in _files(f"{out}/indicators.parquet/indicator=B")}  # untouched
    os.remove(f"{land}/b.json")                                                # nothing old is read again
    before = table()
    ingest_indicators(spark, land, out, {"A": "alpha"})
    assert table() == before
    assert spark.read.parquet(f"{out}/manifest.parquet").count() == 3
    _land(land, "a.json", [_r("A", 2010, 9.0)])                                # the same name, downloaded again
    ingest_indicators(spark, land, out, {"A": "alpha"})
    assert table()["alpha", "AU", 2010] == 9.0 and len(table()) == 4


def test_ingest_sets_broken_payloads_aside(spark, tmp_dir):
    land, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    _land(land, "a.json", [_r("A", 2010, 1.0), _r("A", 2011, "n/a")])
    _land(land, "b.json", None, broken="<html>502</html>")
    with pytest.raises(Exception, match="broken"):
        ingest_indicators(spark, land, out)
    assert not os.path.exists(f"{out}/manifest.parquet")                       # the next run tries again
    ingest_indicators(spark, land, out, on_broken="skip")
    rejects = {(r.file.rsplit("/", 1)[1], r.reason) for r in spark.read.parquet(f"{out}/rejects.parquet").collect()}
    assert rejects == {("a.json", "value"), ("b.json", "payload")}
    assert spark.read.parquet(f"{out}/indicators.parquet").count() == 1


def _files(folder):
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]


@pytest.mark.parametrize("parts", [1, 2, 5, 16])
def test_change_is_carried_over_partition_boundaries(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["A"] * 6 + ["B", "C", None, f"E{rng.randint(0, 40)}"]), rng.choice([None, *range(2000, 2400)]),
             rng.choice([None, *map(float, range(50))])) for _ in range(600)]
    got = with_change(spark.createDataFrame(rows, "country string, year bigint, infrastructure_score double"), S, parts).collect()
    want = []
    for e in {r[0] for r in rows}:
        last = None
        for k, r in enumerate(sorted((r for r in rows if r[0] == e), key=lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or 0))):
            want.append((*r, None if k == 0 or r[2] is None or last is None else r[2] - last))
            last = r[2]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_a_hot_entity_is_spread_over_tasks(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("country"),
                                     F.col("id").alias("year"), F.col("id").cast("double").alias("infrastructure_score"))
    out = with_change(rows, S, 12)
    window = [line for line in plan(out).splitlines() if line.startswith("Arguments: [lag(")]
    assert window and all("_pk_part" in line.split("], [")[1] for line in window)
    source = [f for f in out.inputFiles()]
    hot = [spark.read.parquet(f).where("country = 'hot'").count() for f in source]
    assert sum(n > 0 for n in hot) >= 3 and max(hot) <= 30000 / 12 * 2 and sum(hot) == 10000


def test_column_summary_is_exact_through_sketches(spark):
    rng = np.random.default_rng(1)
    for n, k, most in ((0, 64, 10), (1, 64, 10), (3000, 64, 10**6), (30000, 64, 100)):
        p = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.where(rng.random(n) < .3, np.nan, rng.random(n)),
                          "d.e": np.where(rng.random(n) < .5, 5.0, 6.0)})
        got = {r["column_name"]: r for r in column_summary(spark.createDataFrame(p, "a double, b double, c double, `d.e` double").repartition(5),
                                                           list(p.columns), (.25, .5, .99), ("x", "y", "z"), k, most).collect()}
        for c in p.columns:
            v, r = p[c].dropna(), got[c]
            assert r["count"] == len(v)
            if len(v):
                assert np.allclose([r["x"], r["y"], r["z"]], np.quantile(v, [.25, .5, .99]), rtol=1e-12)
                assert np.isclose(r["mean"], v.mean(), rtol=1e-11) and (r["min"], r["max"]) == (v.min(), v.max())
                assert r["std"] is None if len(v) == 1 else np.isclose(r["std"], v.std(), rtol=1e-10)


def test_describe_scans_once_and_leaves_nan_out(spark, tmp_dir):
    spark.createDataFrame([(1.0, 2), (float("nan"), None), (3.0, 4)], "x double, y int").write.parquet(f"{tmp_dir}/t")
    out = describe_numeric(spark.read.parquet(f"{tmp_dir}/t"))
    assert plan(out).split("\n\n")[0].count("Scan parquet") == 1
    r = {x["column_name"]: x for x in out.collect()}
    assert (r["x"]["count"], r["x"]["mean"], r["x"]["p50"], r["y"]["count"]) == (2, 2.0, 2.0, 2)


def test_box_columns_equal_the_long_form(spark):
    p = reference_panel(spark).withColumn("extra", F.when(F.col("year") == 2010, 1e6).otherwise(F.col("infrastructure_score")))
    cols = ["infrastructure_score", "extra"]
    long = p.unpivot(["country"], cols, "variable", "value")
    assert sorted(map(tuple, box_columns(p, cols).collect())) == sorted(map(tuple, box_summary(long).collect()))
    assert box_columns(p.limit(0), cols).count() == 0


def _same(a, b):
    a, b = ({r[0]: r for r in x.collect()} for x in (a, b))
    assert a.keys() == b.keys()
    for k in a:
        assert [x if isinstance(x, (int, type(None))) else pytest.approx(x, rel=1e-9, abs=1e-9) for x in a[k][1:]] == list(b[k][1:])


@pytest.mark.parametrize("rows", ["golden", "adversarial"])
def test_states_merge_into_the_full_summary(spark, tmp_dir, rows):
    panel = reference_panel(spark) if rows == "golden" else spark.createDataFrame(ROWS, SCHEMA).where("year IS NOT NULL").dropDuplicates(["country", "year"])
    panel = panel.select(*S.columns)
    write_parquet(panel, f"{tmp_dir}/p", partition_by=["year"])
    stored = read_parquet(spark, f"{tmp_dir}/p", panel.schema)
    for year in sorted(r[0] for r in panel.select("year").distinct().collect()):
        state = add_period(spark, stored, f"{tmp_dir}/state", S, year)
    _same(summary_of(state, S), entity_summary(with_change(panel, S), S))
    _same(profile_of(state, S), entity_profile(panel, S))
    with pytest.raises(Exception, match="is not after"):
        merge_states(state, entity_state(stored, S), S).collect()


def test_adding_a_period_reads_only_that_period(spark, tmp_dir):
    panel = reference_panel(spark)
    write_parquet(panel, f"{tmp_dir}/p", partition_by=["year"])
    stored = read_parquet(spark, f"{tmp_dir}/p", panel.schema)
    assert "PartitionFilters: [isnotnull(year" in plan(stored.where(F.col("year") == F.lit(2023)))
    assert len(stored.where(F.col("year") == 2023).select("country").inputFiles()) >= 1
    a = add_period(spark, stored, f"{tmp_dir}/state", S, 2023)
    assert a.count() == 15 and a.first()["num_rows"] == 1


def test_stored_sketches_unite(spark):
    rows = spark.range(20000).select((F.col("id") % 4).alias("year"), (F.col("id") % 7000).alias("k"))
    sketches = distinct_sketches(rows, ["year"], "k")
    r = distinct_of(sketches).first()
    assert r["rows"] == 20000 and abs(r["distinct_estimate"] - 7000) <= 3 * 1.04 / 64 * 7000
    assert distinct_of(sketches, ["year"]).count() == 4


def test_correlation_tiles_equal_the_matrix(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 9))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3], x[:, 4], x[:, 5] = 7.1, x[:, 0] * 2 + 1e6, np.nan
    cols = [f"c.{i}" for i in range(9)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(3)
    got = {(r.var_x, r.var_y): r["corr"] for r in correlation_tiles(df, cols, tile=4).collect()}
    want = pd.DataFrame(x, columns=cols).corr()
    assert len(got) == 81
    for (a, b), v in got.items():
        assert v is None if np.isnan(want[a][b]) else v == pytest.approx(want[a][b], abs=1e-9)
    dense = df.select("`c.0`", "`c.1`").toDF("a", "b").where("NOT isnan(a) AND NOT isnan(b)")
    assert {(r.var_x, r.var_y): pytest.approx(r["corr"]) for r in correlation_matrix(dense, ["a", "b"]).collect()} == {
        (r.var_x, r.var_y): r["corr"] for r in correlation_tiles(dense, ["a", "b"]).collect()}


def test_component_blocks_hold_every_cell_once(spark):
    panel = reference_panel(spark).where("year = 2023")
    blocks, index = component_blocks(panel, S, 4)
    assert sorted((r["block"], r["entities"]) for r in index.collect()) == [(0, 4), (1, 4), (2, 4), (3, 3)]
    t = block_table(blocks, index, 0).orderBy("variable")
    names = sorted(r["country"] for r in panel.collect())[:4]
    assert t.columns == ["variable", *names]
    want = {r["country"]: r for r in panel.collect()}
    for r in t.collect():
        assert [r[n] for n in names] == [want[n][r["variable"]] for n in names]


def test_published_views_by_name(spark, tmp_dir):
    from panelkit.operators.leaders import top_performers
    from panelkit.operators.panel import clean_panel

    clean = clean_panel(reference_panel(spark), S)
    publish_catalog(spark, {"clean_infrastructure": clean, "country_summary": entity_summary(clean, S)},
                    {"top_performers": top_performers_sql(S, "gold_test", 3)}, "gold_test", f"{tmp_dir}/w")
    got = spark.sql("SELECT * FROM gold_test.top_performers")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, top_performers(clean, S, 3).select(*got.columns).collect()))
    publish_catalog(spark, {"country_summary": entity_summary(clean, S).limit(0)}, {}, "gold_test", f"{tmp_dir}/w")   # replaced as a whole
    assert spark.sql("SELECT * FROM gold_test.top_performers").count() == 0
