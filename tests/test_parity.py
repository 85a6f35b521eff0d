"""Every registered query against its DuckDB oracle on the driver tables
(sf0.001 here; the driver checks sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from panelkit.plans import registry
from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF, list(registry.QUERIES), con=duck(SF), verbose=False)


def test_every_key_has_a_builder_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_oracle_parity(report):
    bad = {k: v for k, v in report.items() if v.get("oracle_rows") is not None and not v["exact"]}
    assert not bad


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["n_name", "avg_score", "score_improvement", "latest_score", "latest_rank"]
    assert 0 < df.count() <= 10
