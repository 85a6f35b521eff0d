import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.catalog import catalog_totals, data_catalog
from panelkit.sources.files import panel_schema, read_csv, read_csv_tagged, read_json_object
from panelkit.sources.grid import reference_panel
from panelkit.sources.indicator import FLAT_COLUMNS, name_indicators, read_indicator_payloads
from panelkit.sources.sinks import publish_gold, write_csv, write_parquet
from panelkit.spec import REFERENCE_SPEC as S


def _payload(rows):
    return json.dumps([{"page": 1, "pages": 1, "per_page": 5000, "total": len(rows)}, rows])


def _row(code, cid, name, year, value):
    return {"indicator": {"id": code, "value": code.lower()}, "country": {"id": cid, "value": name},
            "countryiso3code": cid + "X", "date": str(year), "value": value, "unit": "",
            "obs_status": "", "decimal": 1}


def test_indicator_payload_cases(spark, tmp_dir):
    files = {
        "normal.json": _payload([_row("SP.POP.TOTL", "AU", "Australia", 2020, 25.5),
                                 _row("SP.POP.TOTL", "AU", "Australia", 2021, None)]),
        "null_rows.json": json.dumps([{"page": 0}, None]),
        "empty_rows.json": json.dumps([{"page": 0}, []]),
        "one_element.json": json.dumps([{"message": [{"id": "120", "value": "Invalid"}]}]),
    }
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    flat = read_indicator_payloads(spark, tmp_dir)
    assert flat.columns == FLAT_COLUMNS
    rows = sorted(flat.collect(), key=lambda r: r.year)
    assert [(r.country, r.iso3, r.year, r.value) for r in rows] == [
        ("Australia", "AUX", 2020, 25.5), ("Australia", "AUX", 2021, None)]
    assert dict(flat.dtypes)["year"] == "bigint"
    named = name_indicators(flat, {"SP.POP.TOTL": "population_total"})
    assert {r.indicator for r in named.collect()} == {"population_total"}


def test_csv_roundtrip_and_inference(spark, tmp_dir):
    panel = reference_panel(spark)
    write_csv(panel, f"{tmp_dir}/p", sort_within=["country", "year"])
    typed = read_csv(spark, f"{tmp_dir}/p", panel_schema(S))
    assert typed.exceptAll(panel).count() == 0 and typed.count() == 210
    inferred = read_csv(spark, f"{tmp_dir}/p")
    assert dict(inferred.dtypes)["year"] == "bigint"


def test_glob_tagged(spark, tmp_dir):
    panel = reference_panel(spark)
    for name in ("worldbank_gdp", "worldbank_population"):
        write_csv(panel.where(F.col("year") == 2010), f"{tmp_dir}/{name}", single_file=True)
    df = read_csv_tagged(spark, f"{tmp_dir}/worldbank_*/*.csv", panel_schema(S),
                         tag_regex=r"/(worldbank_[^/]+)/")
    got = {r.source: r["count"] for r in df.groupBy("source").count().collect()}
    assert got == {"raw_worldbank_gdp": 15, "raw_worldbank_population": 15}


def test_parquet_partitioned_roundtrip(spark, tmp_dir):
    panel = reference_panel(spark)
    write_parquet(panel, f"{tmp_dir}/pq", partition_by=["year"], sort_within=["country"])
    back = spark.read.parquet(f"{tmp_dir}/pq").select(*panel.columns)
    assert back.exceptAll(panel).count() == 0
    from tests.test_plans import plan
    assert "(year#" in plan(back.where("year = 2023")).split("PartitionFilters: ")[1].split("\n")[0]


def test_catalog_on_written_files(spark, tmp_dir):
    panel = reference_panel(spark)
    write_csv(panel, f"{tmp_dir}/raw/scores", single_file=True)
    with open(f"{tmp_dir}/raw/quoted.csv", "w") as f:
        f.write('a,b,c\n1,"{\'id\': \'X\', \'value\': \'Y\'}",3\n2,"multi\nline",4\n')
    cat = {r.filename.split("-")[0] if r.filename.startswith("part") else r.filename: r
           for r in data_catalog(spark, f"{tmp_dir}/raw").collect()}
    assert cat["part"].rows == 210 and cat["part"].columns == 7
    assert cat["quoted.csv"].rows == 2 and cat["quoted.csv"].columns == 3
    assert cat["quoted.csv"].size_mb == 0.0
    assert len(cat["part"].downloaded) == 19


def test_catalog_totals_reference_values(spark):
    # FIXTURES F3: the reference's catalog (fixed values) -> 5 datasets, 2.18 MB.
    rows = [("worldbank_renewable_energy_consumption.csv", 3724, 8, 0.59, "2025-08-30 19:45:06"),
            ("worldbank_co2_emissions_per_capita.csv", 3724, 8, 0.67, "2025-08-30 19:45:02"),
            ("worldbank_gdp_per_capita.csv", 3724, 8, 0.49, "2025-08-30 19:45:03"),
            ("infrastructure_resilience_scores.csv", 210, 7, 0.01, "2025-08-30 19:45:07"),
            ("worldbank_population_total.csv", 3724, 8, 0.42, "2025-08-30 19:45:05")]
    cat = spark.createDataFrame(
        rows, "filename string, rows bigint, columns bigint, size_mb double, downloaded string")
    t = catalog_totals(cat).first()
    assert (t.datasets_collected, t.total_size_mb, t.total_rows) == (5, 2.18, 15106)


def test_publish_gold_metadata(spark, tmp_dir):
    panel = reference_panel(spark)
    meta = publish_gold(spark, {"a": panel, "b": panel.limit(3)}, tmp_dir).first()
    assert meta.tables_created == ["a", "b"]
    assert meta.record_counts == {"a": 210, "b": 3}
    assert os.path.isdir(f"{tmp_dir}/a.csv")
    obj = read_json_object(spark, f"{tmp_dir}/pipeline_metadata.json").first()
    assert obj.record_counts.a == 210


def test_schema_types():
    s = panel_schema(S)
    assert [f.dataType for f in s.fields][:2] == [T.StringType(), T.LongType()]
    assert len(s.fields) == 7


def test_catalog_odd_file_names(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw dir")
    with open(f"{tmp_dir}/raw dir/my file+1.csv", "w") as f:
        f.write("a,b\n1,2\n3,4\n")
    open(f"{tmp_dir}/raw dir/empty.csv", "w").close()   # unreadable: skipped
    rows = {r.filename: (r.rows, r.columns) for r in data_catalog(spark, f"{tmp_dir}/raw dir").collect()}
    assert rows == {"my file+1.csv": (2, 2)}


def test_glob_tag_decodes_file_names(spark, tmp_dir):
    with open(f"{tmp_dir}/gdp per capita.csv", "w") as f:
        f.write("country,year,infrastructure_score,transport_resilience,energy_resilience,"
                "water_resilience,digital_resilience\nA,2010,1,1,1,1,1\n")
    df = read_csv_tagged(spark, f"{tmp_dir}/*.csv", panel_schema(S))
    assert [r.source for r in df.collect()] == ["raw_gdp per capita"]


def test_indicator_csv_written_by_pandas(spark, tmp_dir):
    import pandas as pd
    from panelkit.sources.indicator import read_indicator_csv
    rows = [{"indicator": {"id": "SP.POP.TOTL", "value": "Population, total"},
             "country": {"id": "CI", "value": "Cote d'Ivoire"}, "countryiso3code": "CIV",
             "date": "2020", "value": 26378275.0, "unit": "", "obs_status": "", "decimal": 0},
            {"indicator": {"id": "SP.POP.TOTL", "value": "Population, total"},
             "country": {"id": "AU", "value": "Australia"}, "countryiso3code": "AUS",
             "date": "2021", "value": None, "unit": "", "obs_status": "", "decimal": 0}]
    pd.DataFrame(rows).to_csv(f"{tmp_dir}/worldbank_population_total.csv", index=False)
    got = sorted(read_indicator_csv(spark, f"{tmp_dir}/worldbank_*.csv").collect(),
                 key=lambda r: r.year)
    assert [(r.indicator_name, r.country, r.year, r.value, r.source) for r in got] == [
        ("Population, total", "Cote d'Ivoire", 2020, 26378275.0, "raw_worldbank_population_total"),
        ("Population, total", "Australia", 2021, None, "raw_worldbank_population_total")]


def test_catalog_leaves_blank_lines_out(spark, tmp_dir):
    write_csv(reference_panel(spark), f"{tmp_dir}/raw/scores", single_file=True)
    with open(f"{tmp_dir}/raw/blank_lines.csv", "w") as f:
        f.write("a,b\n1,2\n\n3,4\n")
    got = {r.filename: (r.rows, r.columns) for r in data_catalog(spark, f"{tmp_dir}/raw").collect()}
    assert got["blank_lines.csv"] == (2, 2) and (210, 7) in got.values()
