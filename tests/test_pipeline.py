import json
import os
import time

import pytest

from panelkit.plans.pipeline import ingest_indicators, run_pipeline
from panelkit.sources.grid import reference_panel
from panelkit.sources.sinks import load_gold, write_csv
from panelkit.streaming.landing import stream_indicators
from tests.test_adversarial_panel import ROWS, SCHEMA


def test_run_pipeline_golden(spark, tmp_dir):
    write_csv(reference_panel(spark), f"{tmp_dir}/raw", single_file=True)
    res = run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/final")
    assert res["success"] and res["all_passed"]
    assert res["record_counts"] == {"clean_infrastructure": 210, "country_summary": 15,
                                    "yearly_trends": 14}
    gold = load_gold(spark, f"{tmp_dir}/final")
    top = gold["top_performers"].orderBy("latest_rank").collect()
    assert [r.country for r in top][:3] == ["Indonesia", "Mexico", "Australia"]
    q = spark.read.json(f"{tmp_dir}/final/quality_report.json").first()
    assert q.all_passed and len(q.checks) == 2
    # The gold tables and the view are queryable with SQL.
    assert spark.sql("SELECT country FROM top_performers ORDER BY latest_rank LIMIT 1").first()[0] \
        == "Indonesia"
    assert spark.sql("SELECT COUNT(*) FROM clean_infrastructure").first()[0] == 210


def test_run_pipeline_checks_before_publish(spark, tmp_dir):
    write_csv(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_dir}/raw", single_file=True)
    with pytest.raises(ValueError):
        run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/final", on_fail="raise")
    assert not os.path.exists(f"{tmp_dir}/final/country_summary.parquet")
    res = run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/final2", on_fail="warn")
    assert res["success"] and not res["all_passed"]


def test_missing_input_is_an_error(spark, tmp_dir):
    with pytest.raises(Exception):
        run_pipeline(spark, f"{tmp_dir}/nothing-here", f"{tmp_dir}/final")


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps([{"page": 1}, rows]))


def _r(code, year, value):
    return {"indicator": {"id": code, "value": code}, "country": {"id": "AU", "value": "Australia"},
            "countryiso3code": "AUS", "date": str(year), "value": value}


def test_ingest_indicators(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _land(land, "gdp.json", [_r("NY.GDP.PCAP.CD", y, 1.0 * y) for y in range(2010, 2024)])
    _land(land, "pop.json", [_r("SP.POP.TOTL", y, 2.0) for y in range(2010, 2012)])
    _land(land, "none.json", None)
    cat = ingest_indicators(spark, land, f"{tmp_dir}/out")   # the reference's code -> name map
    assert sum(r.rows for r in cat.collect()) == 16
    names = {r.indicator for r in spark.read.parquet(f"{tmp_dir}/out/indicators.parquet").collect()}
    assert names == {"gdp_per_capita", "population_total"}
    rep = spark.read.json(f"{tmp_dir}/out/collection_report.json").first()
    assert rep.datasets_collected == cat.count()


def test_stream_indicators_incremental(spark, tmp_dir):
    land, out, ck = f"{tmp_dir}/landing", f"{tmp_dir}/tidy", f"{tmp_dir}/ckpt"
    _land(land, "a.json", [_r("X", 2010, 1.0), _r("X", 2011, 2.0)])
    q = stream_indicators(spark, land, out, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _land(land, "b.json", [_r("X", 2012, 3.0)])
    _land(land, "c.json", None)
    q = stream_indicators(spark, land, out, ck)   # restart from the checkpoint
    q.awaitTermination(120)
    assert sorted(r.year for r in spark.read.parquet(out).collect()) == [2010, 2011, 2012]


def test_cli_pipeline(spark, tmp_dir):
    from panelkit.__main__ import main
    write_csv(reference_panel(spark), f"{tmp_dir}/raw", single_file=True)
    assert main(["pipeline", f"{tmp_dir}/raw", f"{tmp_dir}/out"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out/country_summary.parquet").count() == 15


def test_cli_ingest_and_catalog(spark, tmp_dir, capsys):
    from panelkit.__main__ import main
    land = f"{tmp_dir}/landing"
    _land(land, "pop.jsonl", [_r("SP.POP.TOTL", 2010, 1.0)])
    with open(f"{land}/pop.jsonl", "a") as f:       # a second payload on its own line
        f.write("\n" + json.dumps([{"page": 2}, [_r("SP.POP.TOTL", 2011, 2.0)]]))
    assert main(["ingest", land, f"{tmp_dir}/out", "--lines"]) == 0
    tidy = spark.read.parquet(f"{tmp_dir}/out/indicators.parquet")
    assert sorted(r.year for r in tidy.collect()) == [2010, 2011]
    assert {r.indicator for r in tidy.collect()} == {"population_total"}
    assert main(["catalog", f"{tmp_dir}/out/raw"]) == 0
    assert "datasets_collected" in capsys.readouterr().out
