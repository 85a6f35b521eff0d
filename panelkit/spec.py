"""Column names as data.

A panel is a table keyed by (entity, period) with one headline score and a
few component scores. Every operator takes a :class:`PanelSpec`, so the same
code runs on the reference's 15-country scorecard and on a billion-row panel
derived from order lines.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "country"
    period: str = "year"
    score: str = "infrastructure_score"
    components: tuple[str, ...] = (
        "transport_resilience",
        "energy_resilience",
        "water_resilience",
        "digital_resilience",
    )
    # Rows with period < start are dropped before any window is computed
    # (``WHERE year >= 2010``). None keeps every row.
    start: int | None = 2010
    # Names of the derived columns of the clean panel.
    component_mean: str = "avg_resilience"
    change: str = "score_change"
    rank: str = "yearly_rank"
    # Display names of the components, bound by column name (never by
    # position, see SURVEY C2).
    labels: dict = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        return [self.entity, self.period]

    @property
    def columns(self) -> list[str]:
        return [self.entity, self.period, self.score, *self.components]

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)


# Fixed values of the reference scorecard (must equal the reference for the
# golden tests): entity list in its original order, first and last year,
# base score 50, +2 per entity position, +0.5 per year, and the component
# offsets transport +5, energy -5, water +2, digital +10.
REFERENCE_COUNTRIES = (
    "United States", "China", "Japan", "Germany", "India",
    "United Kingdom", "France", "Italy", "Brazil", "Canada",
    "South Korea", "Spain", "Australia", "Mexico", "Indonesia",
)
REFERENCE_FIRST_YEAR = 2010
REFERENCE_LAST_YEAR = 2023
REFERENCE_BASE = 50.0
REFERENCE_ENTITY_STEP = 2.0
REFERENCE_PERIOD_STEP = 0.5
REFERENCE_OFFSETS = {
    "transport_resilience": 5.0,
    "energy_resilience": -5.0,
    "water_resilience": 2.0,
    "digital_resilience": 10.0,
}
REFERENCE_LABELS = {
    "transport_resilience": "Transport",
    "energy_resilience": "Energy",
    "water_resilience": "Water",
    "digital_resilience": "Digital",
}

# The indicators the reference collects (API code -> friendly
# name, in its order) and the API page size.
REFERENCE_INDICATORS = {
    "EN.GHG.CO2.PC.CE.AR5": "co2_emissions_per_capita",
    "NY.GDP.PCAP.CD": "gdp_per_capita",
    "SP.POP.TOTL": "population_total",
    "EG.FEC.RNEW.ZS": "renewable_energy_consumption",
}
REFERENCE_PAGE_SIZE = 5000

REFERENCE_SPEC = PanelSpec(labels=REFERENCE_LABELS)
