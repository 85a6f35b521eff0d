"""Readers and catalog report what they cannot read; sums and leaders are exact."""

import gzip

import pytest
from pyspark.sql import functions as F

from panelkit.operators.leaders import top_performers
from panelkit.operators.panel import clean_panel, exact_mean
from panelkit.plans.bindings import _sum4
from panelkit.sources.catalog import data_catalog, dataset_catalog
from panelkit.sources.files import panel_schema, read_csv
from panelkit.sources.indicator import payload_rejects, read_indicator_csv, read_indicator_payloads
from panelkit.sources.sinks import write_parquet
from panelkit.spec import REFERENCE_SPEC as S

HEAD = "country,year,infrastructure_score,transport_resilience,energy_resilience,water_resilience,digital_resilience"


def _file(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_columns_bind_by_header(spark, tmp_dir):
    names = HEAD.split(",")[::-1]
    path = _file(f"{tmp_dir}/r.csv", ",".join(names) + "\n" + "7,6,5,4,3,2010,A\n")
    r = read_csv(spark, path, panel_schema(S)).first()
    assert (r.country, r.year, r.infrastructure_score, r.digital_resilience) == ("A", 2010, 3.0, 7.0)
    with pytest.raises(ValueError, match="digital_resilience"):
        read_csv(spark, _file(f"{tmp_dir}/m.csv", HEAD.rsplit(",", 1)[0] + "\nA,2010,1,2,3,4\n"), panel_schema(S))


def test_bad_cell_and_differing_headers_fail(spark, tmp_dir):
    with pytest.raises(Exception, match="MALFORMED|n/a"):
        read_csv(spark, _file(f"{tmp_dir}/b.csv", HEAD + "\nA,2010,n/a,1,1,1,1\n"), panel_schema(S)).collect()
    import os
    os.mkdir(f"{tmp_dir}/two")
    _file(f"{tmp_dir}/two/a.csv", HEAD + "\nA,2010,1,2,3,4,5\n")
    _file(f"{tmp_dir}/two/b.csv", ",".join(HEAD.split(",")[::-1]) + "\n5,4,3,2,1,2010,A\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{tmp_dir}/two", panel_schema(S)).collect()


def test_broken_payloads_fail_or_are_counted(spark, tmp_dir):
    import os
    os.mkdir(f"{tmp_dir}/land")
    good = '[{"page":1},[{"indicator":{"id":"I","value":"i"},"country":{"id":"C","value":"c"},"date":"2010","value":1.5}]]'
    _file(f"{tmp_dir}/land/a.json", good)
    _file(f"{tmp_dir}/land/b.json", '[{"page":1},\nnull]')
    assert read_indicator_payloads(spark, f"{tmp_dir}/land").count() == 1
    _file(f"{tmp_dir}/land/c.json", good[:60])
    _file(f"{tmp_dir}/land/d.json", "<html>error</html>")
    with pytest.raises(Exception, match="broken payload"):
        read_indicator_payloads(spark, f"{tmp_dir}/land").collect()
    assert read_indicator_payloads(spark, f"{tmp_dir}/land", on_broken="skip").count() == 1
    text = spark.read.text(f"{tmp_dir}/land", wholetext=True)
    assert {r.status: r.payloads for r in payload_rejects(text).collect()} == {"rows": 1, "empty": 1, "broken": 2}


def test_none_in_a_dict_cell(spark, tmp_dir):
    _file(f"{tmp_dir}/worldbank_x.csv", "indicator,country,countryiso3code,date,value,unit,obs_status,decimal\n"
          "\"{'id': 'I', 'value': None}\",\"{'id': 'C', 'value': 'None of it'}\",CCC,2010,1,,,0\n")
    r = read_indicator_csv(spark, f"{tmp_dir}/worldbank_*.csv").first()
    assert (r.indicator_id, r.indicator_name, r.country) == ("I", None, "None of it")


def test_catalog_names_unreadable_files_and_counts_datasets(spark, tmp_dir):
    import os
    os.mkdir(f"{tmp_dir}/ok")
    _file(f"{tmp_dir}/ok/ragged.csv", "k,v\n1,2,3,4\n5,6\n")
    spark.range(100).repartition(4).write.option("header", True).csv(f"{tmp_dir}/ok/many")
    got = {r.dataset: (r.rows, r.columns) for r in dataset_catalog(data_catalog(spark, f"{tmp_dir}/ok")).collect()}
    assert got == {"ragged": (2, 2), "many": (100, 1)}
    os.mkdir(f"{tmp_dir}/cut")
    whole = gzip.compress(b"k,v\n" + b"".join(b"%d,%d\n" % (i, i * 7919) for i in range(50000)))
    with open(f"{tmp_dir}/cut/half.csv.gz", "wb") as f:
        f.write(whole[:len(whole) // 2])
    with pytest.raises(Exception, match="half.csv.gz"):
        data_catalog(spark, f"{tmp_dir}/cut", "*.csv.gz").collect()


def test_leaders_without_entity_take_no_place(spark):
    rows = [(None, 2020, 99.0, *[1.0] * 4), ("A", 2020, 5.0, *[1.0] * 4), ("B", 2020, 4.0, *[1.0] * 4), ("C", 2020, 3.0, *[1.0] * 4)]
    schema = ", ".join(f"{c} {'string' if i == 0 else 'bigint' if i == 1 else 'double'}" for i, c in enumerate(HEAD.split(",")))
    clean = clean_panel(spark.createDataFrame(rows, schema), S)
    assert sorted(r.country for r in top_performers(clean, S, 2).collect()) == ["A", "B"]


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.range(20000).select((F.col("id") % 7 * 12345678901.1234).cast("double").alias("x"))
    sums = {str(df.repartition(n).agg(_sum4("x").alias("s")).first().s) for n in (1, 8, 64)}
    assert len(sums) == 1 and float(sums.pop()) > 1e14


def test_exact_mean_of_small_and_huge_values(spark):
    df = spark.createDataFrame([(2e-7, 1e33), (4e-7, 3e33)], "s double, h double")
    r = df.agg(exact_mean("s").alias("s"), exact_mean("h").alias("h")).first()
    assert r.s == pytest.approx(3e-7, rel=1e-9) and r.h == pytest.approx(2e33)


def test_partitioned_files_are_few_and_sorted(spark, tmp_dir):
    df = spark.range(3000).select((F.col("id") % 3).alias("year"), (F.col("id") * 7919 % 3000).alias("k")).repartition(8)
    write_parquet(df, f"{tmp_dir}/t", partition_by=["year"], sort_within=["k"])
    files = spark.read.parquet(f"{tmp_dir}/t").inputFiles()
    assert len(files) <= 3 + 8
    for f in files:
        k = [r.k for r in spark.read.parquet(f).collect()]
        assert k == sorted(k)
