"""FIXTURES F6: ties, gaps, falls, NULLs, duplicates, single rows, constant
columns and empty selections - none of which the golden panel has."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators.leaders import latest_slice
from panelkit.operators.panel import clean_panel, entity_summary, net_change
from panelkit.operators.profile import correlation_matrix
from panelkit.operators.quality import duplicate_check, null_check, quality_checks, require
from panelkit.operators.views import view_heatmap, view_time_series
from panelkit.spec import REFERENCE_SPEC as S

ROWS = [
    # tie in 2011: A and B both 90 -> rank 1, 1, then C 3
    ("A", 2010, 80.0, 1.0, 1.0, 1.0, 1.0),
    ("A", 2011, 90.0, 1.0, 2.0, 3.0, 4.0),
    ("B", 2010, 70.0, 1.0, 1.0, 1.0, 1.0),
    ("B", 2011, 90.0, 2.0, 2.0, 2.0, 2.0),
    ("C", 2010, 60.0, 1.0, 1.0, 1.0, 1.0),
    ("C", 2011, 85.0, 3.0, 2.0, 1.0, 0.0),
    # D: missing 2011, falling series, NULL score in 2013
    ("D", 2010, 50.0, 1.0, 1.0, 1.0, 1.0),
    ("D", 2012, 40.0, 1.0, 1.0, 1.0, 1.0),
    ("D", 2013, None, 1.0, 1.0, 1.0, 1.0),
    ("D", 2014, 45.0, 1.0, 1.0, 1.0, 1.0),
    # E: NULL component, a year before the start, a repeated key
    ("E", 2010, 55.0, None, 1.0, 1.0, 1.0),
    ("E", 2009, 99.0, 1.0, 1.0, 1.0, 1.0),
    ("E", 2012, 56.0, 1.0, 1.0, 1.0, 1.0),
    ("E", 2012, 57.0, 1.0, 1.0, 1.0, 1.0),
    # F: one row only
    ("F", 2014, 10.0, 1.0, 1.0, 1.0, 1.0),
]
SCHEMA = ("country string, year bigint, infrastructure_score double, transport_resilience double,"
          " energy_resilience double, water_resilience double, digital_resilience double")


@pytest.fixture(scope="module")
def clean(spark):
    return clean_panel(spark.createDataFrame(ROWS, SCHEMA), S).cache()


def _by_key(df):
    return {(r.country, r.year, r.infrastructure_score): r for r in df.collect()}


def test_start_filter(clean):
    assert clean.where("year < 2010").count() == 0
    assert clean.count() == len(ROWS) - 1


def test_tied_rank(clean):
    r = _by_key(clean.where("year = 2011"))
    assert sorted(x.yearly_rank for x in r.values()) == [1, 1, 3]
    assert r[("C", 2011, 85.0)].yearly_rank == 3


def test_null_score_ranks_last_and_breaks_changes(clean):
    r = _by_key(clean.where("country = 'D'"))
    assert r[("D", 2013, None)].yearly_rank == 1  # only row of 2013
    assert r[("D", 2012, 40.0)].score_change == -10.0  # gap year: previous row
    assert r[("D", 2013, None)].score_change is None
    assert r[("D", 2014, 45.0)].score_change is None
    y2014 = {x.country: x.yearly_rank for x in clean.where("year = 2014").collect()}
    assert y2014 == {"D": 1, "F": 2}


def test_null_rank_after_non_null(spark):
    rows = [("X", 2020, None, 1.0, 1.0, 1.0, 1.0), ("Y", 2020, 5.0, 1.0, 1.0, 1.0, 1.0),
            ("Z", 2020, None, 1.0, 1.0, 1.0, 1.0)]
    c = clean_panel(spark.createDataFrame(rows, SCHEMA), S)
    assert {r.country: r.yearly_rank for r in c.collect()} == {"X": 2, "Y": 1, "Z": 2}


def test_component_mean_null(clean):
    r = _by_key(clean.where("country = 'E' AND year = 2010"))
    assert r[("E", 2010, 55.0)].avg_resilience is None


def test_summary_falling_series(clean):
    s = {r.country: r for r in entity_summary(clean, S).collect()}
    d = s["D"]
    assert d.score_improvement == 10.0  # max - min
    n = {r.country: r.net_change for r in net_change(clean.where("infrastructure_score IS NOT NULL"),
                                                     S).collect()}
    assert n["D"] == -5.0  # last - first (45 - 50): differs from max - min
    assert s["F"].num_years == 1 and s["F"].avg_yearly_change is None


def test_quality_fails(clean):
    assert null_check(clean, S.score).first().observed == 1
    dup = duplicate_check(clean, S.key).first()
    assert (dup.observed, dup.excess_rows, dup.passed) == (1, 1, False)
    checks = quality_checks(clean, S.score, S.key)
    assert not checks.first().all_passed
    assert require(checks, "warn") is False
    with pytest.raises(ValueError):
        require(checks, "raise")


def test_constant_component_corr_is_null(clean):
    latest = latest_slice(clean, S)  # 2014: D and F, transport constant 1.0
    rows = {(r.var_x, r.var_y): r.corr for r in correlation_matrix(latest, S.components).collect()}
    assert rows[("transport_resilience", "energy_resilience")] is None


def test_empty_selection(clean):
    assert view_time_series(clean, S, [], 2010, 2020).count() == 0
    assert view_heatmap(clean, S, []).count() == 0
    assert view_time_series(clean, S, ["A"], 2010, 2010).count() == 1


def test_null_keys_sql_vs_pandas(spark):
    rows = ROWS + [(None, 2011, 1.0, 1.0, 1.0, 1.0, 1.0)]
    c = clean_panel(spark.createDataFrame(rows, SCHEMA), S)
    keys = {r.country for r in entity_summary(c, S).collect()}
    assert None in keys                                       # SQL keeps the NULL group
    assert None not in {r.country for r in entity_summary(c, S, drop_null_keys=True).collect()}


def test_completeness(spark, clean):
    from panelkit.operators.profile import completeness
    r = completeness(clean).first()
    assert r.missing > 0 and r.no_missing is False


def test_top_per_period_keeps_ties(clean):
    from panelkit.operators.leaders import top_per_period
    rows = top_per_period(clean, S, 1).where("year = 2011").collect()
    assert sorted(r.country for r in rows) == ["A", "B"] and {r.period_rank for r in rows} == {1}


def test_profiles_accept_awkward_column_names(spark):
    from panelkit.operators.profile import correlation_matrix, null_profile
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.5, 1.0), (3.0, 5.0, 2.0)],
                               "`a.b` double, `c d` double, `e|f` double")
    assert {r.column_name: r.null_count for r in null_profile(df).collect()} == {"e|f": 1}
    corr = {(r.var_x, r.var_y): r.corr for r in correlation_matrix(df, ["a.b", "c d"]).collect()}
    assert corr[("a.b", "a.b")] == pytest.approx(1.0) and len(corr) == 4
