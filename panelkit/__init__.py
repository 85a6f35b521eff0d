"""panelkit - entity x period score panels on Spark DataFrames.

Everything takes and returns DataFrames; column names come from a
:class:`PanelSpec`, so the same operators run on 210 rows or on billions.
"""

from panelkit.operators.leaders import (default_selection, latest_period, latest_slice,  # noqa: F401
                                        most_improved, top_in_period, top_n, top_per_period,
                                        top_performers)
from panelkit.operators.ordinal import (competition_rank, exact_quantiles,  # noqa: F401
                                        value_positions)
from panelkit.operators.panel import (clean_panel, entity_profile, entity_summary,  # noqa: F401
                                      net_change, period_trends, select_panel, with_change,
                                      with_component_mean, with_rank)
from panelkit.operators.profile import (completeness, correlation_matrix, describe_numeric,  # noqa: F401
                                        domain_stride, exploration_summary, filter_domain,
                                        null_profile, period_bounds, record_counts,
                                        table_schema)
from panelkit.operators.quality import (duplicate_check, null_check, quality_checks,  # noqa: F401
                                        quality_report, require)
from panelkit.operators.reshape import component_matrix, unpivot_components  # noqa: F401
from panelkit.operators.views import (box_summary, kpis, select_entities,  # noqa: F401
                                      view_distribution, view_heatmap, view_improvement,
                                      view_ranking, view_time_series)
from panelkit.session import get_spark, materialize, stage_table  # noqa: F401
from panelkit.spec import REFERENCE_SPEC, PanelSpec  # noqa: F401
