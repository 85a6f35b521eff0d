"""What readers cannot read is an error or is set aside by name, never lost; the catalog counts large quoted files by splits."""

import csv
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from panelkit.plans.pipeline import extract_indicators, run_pipeline
from panelkit.sources.catalog import data_catalog, dataset_catalog
from panelkit.sources.files import read_csv
from panelkit.sources.grid import reference_panel
from panelkit.sources.indicator import parse_envelopes, payload_status, read_indicator_csv
from panelkit.sources.sinks import write_csv
from panelkit.spec import REFERENCE_SPEC

XY = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.DoubleType())])
HEAD = "indicator,country,countryiso3code,date,value,unit,obs_status,decimal\n"
CELL = "\"{'id': 'I', 'value': 'i'}\",\"{'id': 'C', 'value': 'Land, of'}\",CCC,"


def _file(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("use", [lambda d: d.select("x").collect(), lambda d: d.count(), lambda d: d.where("x = 2").collect()])
def test_a_bad_cell_fails_whatever_is_read(spark, tmp_dir, use):
    path = _file(f"{tmp_dir}/a.csv", "x,y,z\n1,n/a,k\n2,3,k\n")
    with pytest.raises(Exception, match="unreadable record 1,n/a,k in .*a.csv"):
        use(read_csv(spark, path, XY))


def test_quotes_are_doubled_and_short_records_fail(spark, tmp_dir):
    df = spark.createDataFrame([('say "a, b"\\', 1.0), ("plain", 2.0)], "s string, y double")
    write_csv(df, f"{tmp_dir}/q", single_file=True)
    part = next(f for f in os.listdir(f"{tmp_dir}/q") if f.endswith(".csv"))
    assert list(pd.read_csv(f"{tmp_dir}/q/{part}")["s"]) == ['say "a, b"\\', "plain"]
    assert sorted(read_csv(spark, f"{tmp_dir}/q", df.schema).collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="unreadable record"):
        read_csv(spark, _file(f"{tmp_dir}/s/a.csv", "x,y\n1,2\n3\n"), XY).count()


def test_indicator_columns_bind_by_header(spark, tmp_dir):
    _file(f"{tmp_dir}/worldbank_a.csv", "country,indicator,date,countryiso3code,value\n\"{'id': 'C', 'value': 'c'}\",\"{'id': 'I', 'value': None}\",2010,CCC,1.5\n")
    r = read_indicator_csv(spark, f"{tmp_dir}/worldbank_*.csv").first()
    assert (r.indicator_id, r.country_id, r.iso3, r.year, r.value, r.source) == ("I", "C", "CCC", 2010, 1.5, "raw_worldbank_a")


def test_indicator_rejects_name_file_record_and_reason(spark, tmp_dir):
    _file(f"{tmp_dir}/raw/worldbank_a.csv", HEAD + CELL + "2010,1.5,,,0\n" + CELL + "2011,n/a,,,0\n" + CELL + "x,2,,,0\n")
    _file(f"{tmp_dir}/raw/worldbank_b.csv", HEAD + "{bad}," + CELL.split('",', 1)[1] + "2010,1,,,0\n" + CELL + "2010,,,,0\n" + CELL + "2012\n")
    with pytest.raises(Exception, match="broken"):
        read_indicator_csv(spark, f"{tmp_dir}/raw/worldbank_*.csv").collect()
    rows, rejects, report = extract_indicators(spark, f"{tmp_dir}/raw/worldbank_*.csv", f"{tmp_dir}/out")
    assert {(r.source, r.year, r.value) for r in rows.collect()} == {("raw_worldbank_a", 2010, 1.5), ("raw_worldbank_b", 2010, None)}
    assert sorted((r.file.rsplit("/", 1)[1], r.reason) for r in rejects.collect()) == [
        ("worldbank_a.csv", "date"), ("worldbank_a.csv", "value"), ("worldbank_b.csv", "indicator"), ("worldbank_b.csv", "record")]
    assert any("n/a" in r.record for r in rejects.collect())
    assert {r.source: (r.files, r.rows, r.rejected) for r in report.collect()} == {"raw_worldbank_a": (1, 1, 2), "raw_worldbank_b": (1, 1, 2)}
    assert extract_indicators(spark, f"{tmp_dir}/raw/nothing_*.csv", f"{tmp_dir}/out2") is None


def test_pipeline_loads_the_indicators_beside_the_panel(spark, tmp_dir):
    write_csv(reference_panel(spark), f"{tmp_dir}/panel", single_file=True)
    _file(f"{tmp_dir}/raw/worldbank_a.csv", HEAD + CELL + "2010,1.5,,,0\n" + CELL + "2011,n/a,,,0\n")
    got = run_pipeline(spark, f"{tmp_dir}/panel", f"{tmp_dir}/final", indicators=f"{tmp_dir}/raw/worldbank_*.csv")
    assert got["indicators"] == {"files": 1, "rows": 1, "rejected": 1}
    assert spark.sql("SELECT count(*) FROM raw_indicators").first()[0] == 1
    assert run_pipeline(spark, f"{tmp_dir}/panel", f"{tmp_dir}/final", indicators=f"{tmp_dir}/none/worldbank_*.csv")["success"]


def test_payload_cells_and_status(spark):
    row = {"indicator": {"id": "I", "value": "i"}, "country": {"id": "C", "value": "c"}, "countryiso3code": "CCC", "date": "2010", "value": 1.5}
    wrap = lambda *rows: json.dumps([{"page": 1}, list(rows)])
    texts = [wrap(row, {**row, "value": "n/a"}, {**row, "country": "c"}, None), '[{"p":1,"p":2},[]]', wrap(row)[:-5], None, '[{"a":1}]']
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, k int")
    assert [r[0] for r in df.orderBy("k").select(payload_status()).collect()] == ["rows", "empty", "broken", "broken", "empty"]
    got = parse_envelopes(df, on_broken="mark", keep=["k"]).collect()
    assert sorted((r.k, r.reason or "") for r in got) == [(0, ""), (0, "country"), (0, "row"), (0, "value"), (2, "payload"), (3, "payload")]
    assert parse_envelopes(df, on_broken="skip").count() == 1
    with pytest.raises(Exception, match="broken"):
        parse_envelopes(df).collect()


@pytest.mark.parametrize("split", ["128m", "64", "700"])
def test_catalog_counts_quoted_files_by_splits(spark, tmp_dir, split):
    rng, want = random.Random(2), {}
    for k in range(8):
        width = rng.randint(1, 5)
        path = f"{tmp_dir}/s{k % 2}/f{k}.csv"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n", quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            out.writerow([rng.choice(["h%d", "h\n%d", '"h,%d"', "a\n\nb %d"]) % i for i in range(width)])
            for i in range(rng.randint(0, 200)):
                out.writerow([rng.choice(["a", "b,c", 'x "q" y', "two\nlines", "\n\n", 'three\n\n\nlines,"', str(i)]) for _ in range(width)])
                f.write("\n" if rng.random() < 0.1 else "")
        got = pd.read_csv(path, dtype=str, keep_default_na=False)
        want[f"f{k}.csv"] = got.shape
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert {r.filename: (r.rows, r.columns) for r in data_catalog(spark, tmp_dir).collect()} == want
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_datasets_of_one_name_in_two_folders(spark, tmp_dir):
    _file(f"{tmp_dir}/s1/data.csv", '"a\nb",c,d\n1,2,3\n')
    _file(f"{tmp_dir}/s2/data.csv", "a\n1\n2\n")
    _file(f"{tmp_dir}/s2/other.csv", "a\n")
    got = {r.dataset: (r.rows, r.columns) for r in dataset_catalog(data_catalog(spark, tmp_dir)).collect()}
    assert got == {"s1/data": (1, 3), "s2/data": (2, 1), "other": (0, 1)}


def test_pipeline_panel_with_a_bad_cell_fails_before_publishing(spark, tmp_dir):
    write_csv(reference_panel(spark), f"{tmp_dir}/panel")
    _file(f"{tmp_dir}/panel/more.csv", ",".join(REFERENCE_SPEC.columns) + "\nX,2010,1,2,bad,4,5\n")
    with pytest.raises(Exception, match="unreadable record"):
        run_pipeline(spark, f"{tmp_dir}/panel", f"{tmp_dir}/final")
    assert not os.path.exists(f"{tmp_dir}/final/country_summary.parquet")
