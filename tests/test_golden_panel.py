"""The reference scorecard (15 countries x 2010-2023): every expected value is
derived by hand from the generator's formula (SURVEY section 5)."""

import math

import pytest
from pyspark.sql import functions as F

from panelkit.operators.leaders import latest_slice, most_improved, top_performers
from panelkit.operators.panel import (clean_panel, entity_profile, entity_summary, net_change,
                                     period_trends)
from panelkit.operators.profile import (correlation_matrix, describe_numeric,
                                        exploration_summary, null_profile)
from panelkit.operators.quality import quality_checks
from panelkit.operators.views import kpis
from panelkit.sources.grid import reference_panel
from panelkit.spec import REFERENCE_COUNTRIES, REFERENCE_SPEC as S

# The expected top 10 of 2023.
TOP10 = [("Indonesia", 84.5), ("Mexico", 82.5), ("Australia", 80.5), ("Spain", 78.5),
         ("South Korea", 76.5), ("Canada", 74.5), ("Brazil", 72.5), ("Italy", 70.5),
         ("France", 68.5), ("United Kingdom", 66.5)]


@pytest.fixture(scope="module")
def panel(spark):
    return reference_panel(spark).cache()


@pytest.fixture(scope="module")
def clean(panel):
    return clean_panel(panel, S).cache()


def test_shape(panel):
    assert panel.count() == 210
    assert panel.select("country").distinct().count() == 15
    assert panel.agg(F.min("year"), F.max("year")).first() == (2010, 2023)
    assert dict(panel.dtypes)["year"] == "bigint"


def test_clean_panel(clean):
    rows = clean.collect()
    assert len(rows) == 210
    assert all(r.avg_resilience - r.infrastructure_score == 3.0 for r in rows)
    nulls = [r for r in rows if r.score_change is None]
    assert len(nulls) == 15 and all(r.year == 2010 for r in nulls)
    assert all(r.score_change == 0.5 for r in rows if r.year > 2010)
    order = list(reversed(REFERENCE_COUNTRIES))  # Indonesia best ... United States
    for r in rows:
        assert r.yearly_rank == order.index(r.country) + 1
    assert dict(clean.dtypes)["yearly_rank"] == "bigint"


def test_country_summary(clean):
    s = {r.country: r for r in entity_summary(clean, S).collect()}
    a = s["Australia"]
    assert (a.first_year, a.last_year, a.num_years) == (2010, 2023, 14)
    assert (a.avg_score, a.min_score, a.max_score) == (77.25, 74.0, 80.5)
    assert a.score_improvement == 6.5 and a.avg_yearly_change == 0.5


def test_yearly_trends(clean):
    for r in period_trends(clean, S).collect():
        k = r.year - 2010
        assert r.global_avg_score == pytest.approx(64 + 0.5 * k)
        assert r.score_std_dev == pytest.approx(8.944272, abs=1e-6)
        assert (r.min_score, r.max_score) == (50 + 0.5 * k, 78 + 0.5 * k)
        assert r.num_countries == 15


def test_top_performers(clean):
    top = top_performers(clean, S, 10).orderBy(F.desc("latest_score")).collect()
    assert [(r.country, r.latest_score) for r in top] == TOP10
    assert [r.latest_rank for r in top] == list(range(1, 11))
    assert all(r.score_improvement == 6.5 for r in top)


def test_latest_slice(clean):
    assert latest_slice(clean, S).select("year").distinct().collect()[0][0] == 2023


def test_entity_profile_matches_golden_file(panel):
    prof = {r.country: r for r in entity_profile(panel, S).collect()}
    assert len(prof) == 15
    for i, c in enumerate(REFERENCE_COUNTRIES):
        base = 50 + 2 * i
        r = prof[c]
        assert r.infrastructure_score_mean == base + 3.25
        assert r.infrastructure_score_std == 2.09
        assert (r.infrastructure_score_min, r.infrastructure_score_max) == (base, base + 6.5)
        assert r.transport_resilience_mean == base + 8.25
        assert r.energy_resilience_mean == base - 1.75
        assert r.water_resilience_mean == base + 5.25
        assert r.digital_resilience_mean == base + 13.25


def test_describe_score(panel):
    d = {r.column_name: r for r in describe_numeric(panel, ["infrastructure_score", "year"]).collect()}
    s = d["infrastructure_score"]
    assert s["count"] == 210 and s["mean"] == pytest.approx(67.25)
    assert s["std"] == pytest.approx(8.8941, abs=1e-4)
    assert (s.p25, s.p50, s.p75) == (60.0, 67.25, 74.5)
    assert (s["min"], s["max"]) == (50.0, 84.5)
    assert d["year"].p50 == 2016.5


def test_correlation_latest_year(clean):
    latest = latest_slice(clean, S)
    rows = correlation_matrix(latest, S.components).collect()
    assert len(rows) == 16
    assert all(math.isclose(r.corr, 1.0, rel_tol=1e-12) for r in rows)


def test_net_change_and_most_improved(clean):
    assert {r.net_change for r in net_change(clean, S).collect()} == {6.5}
    five = [r.country for r in most_improved(clean, S, 5).collect()]
    assert five == sorted(REFERENCE_COUNTRIES)[:5]  # 15-way tie -> by name


def test_quality_passes(clean):
    rows = quality_checks(clean, S.score, S.key).collect()
    assert {r.check: (r.passed, r.details) for r in rows} == {
        "null_values": (True, "Found 0 null values"),
        "duplicates": (True, "Found 0 duplicate records")}
    assert all(r.all_passed for r in rows)


def test_null_profile_golden(panel):
    assert null_profile(panel).count() == 0
    assert null_profile(panel, only_missing=False).count() == 7


def test_kpis(clean):
    top = top_performers(clean, S)
    k = kpis(clean, top, S).first()
    assert k.countries_analyzed == 15
    assert k.avg_score_text == "67.2"   # Python f"{67.25:.1f}"
    assert k.top_performer == "Indonesia"
    assert k.data_points_text == "210"


def test_exploration_summary(clean):
    r = exploration_summary(clean, S).first()
    assert (r.first_period, r.last_period, r.num_entities, r.total_records) == (2010, 2023, 15, 210)
    assert r.top_performer == "Indonesia"
    assert r.most_improved == "Australia"


def test_completeness_golden(panel):
    from panelkit.operators.profile import completeness
    r = completeness(panel).first()
    assert (r.missing, r.no_missing) == (0, True)
