"""Registered queries: one Spark DataFrame builder per operator key of the
inventory, each paired (where SQL can say it) with DuckDB oracle SQL.

Every builder reads the driver tables under ``sf_dir`` (or data Spark derives
from them), whole: no row caps, id subsets or samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import bytes_to_mb, file_stem, fixed_text, round_half_up
from panelkit.functions.scalar import position_in, timestamp_text
from panelkit.operators.leaders import (default_selection, latest_slice, most_improved,
                                       top_per_period, top_performers)
from panelkit.operators.panel import (clean_panel, entity_profile, entity_summary, net_change,
                                     period_trends, select_panel)
from panelkit.operators.profile import (completeness, correlation_matrix, correlation_tiles, describe_numeric,
                                        exploration_summary, filter_domain, domain_stride,
                                        null_profile, period_bounds, record_counts,
                                        table_schema)
from panelkit.operators.quality import duplicate_check, null_check, quality_checks
from panelkit.operators.reshape import component_blocks, component_matrix, unpivot_components
from panelkit.operators.state import add_period, distinct_of, distinct_sketches, entity_state, summary_of
from panelkit.operators.views import (kpis, view_distribution, view_heatmap, view_improvement,
                                      view_ranking, view_time_series)
from panelkit.plans.bindings import (NATION_SPEC, PART_SPEC, nation_panel, part_panel,
                                     read_table)
from panelkit.plans.oracle import NATION_PANEL, PART_PANEL, nation_with, part_with, r2, r6, summary_cte
from panelkit.session import materialize, scratch_path, stage_table
from panelkit.sources.catalog import catalog_totals, data_catalog, dataset_catalog
from panelkit.sources.files import panel_schema, read_csv, read_csv_tagged, read_json_object
from panelkit.sources.grid import panel_grid
from panelkit.plans.pipeline import ingest_indicators, run_pipeline
from panelkit.sources.indicator import (FLAT_COLUMNS, encode_envelopes, payload_rejects, read_indicator_csv,
                                        read_indicator_payloads)
from panelkit.sources.sinks import (publish_catalog, publish_gold, read_parquet, top_performers_sql, write_csv,
                                     write_parquet)
from panelkit.spec import REFERENCE_SPEC

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: round_half_up(c, 6) for c in cols})


def _inputs(sf: str, *tables: str) -> list[str]:
    return [f"{sf.rstrip('/')}/{t}.parquet" for t in tables]


def part_raw(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, f"part_panel:{sf}", lambda: part_panel(spark, sf),
                       _inputs(sf, "lineitem"))


def part_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Raw panel and clean panel are stage tables (the reference materialises
    both): each is computed once and read by every consumer downstream."""
    raw = part_raw(spark, sf)
    return stage_table(spark, f"part_clean:{sf}", lambda: clean_panel(raw, PART_SPEC),
                       _inputs(sf, "lineitem"))


def nation_raw(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, f"nation_panel:{sf}", lambda: nation_panel(spark, sf),
                       _inputs(sf, "lineitem", "orders", "customer", "nation"))


def nation_clean(spark: SparkSession, sf: str) -> DataFrame:
    raw = nation_raw(spark, sf)
    return stage_table(spark, f"nation_clean:{sf}", lambda: clean_panel(raw, NATION_SPEC),
                       _inputs(sf, "lineitem", "orders", "customer", "nation"))


# --------------------------------------------------------------------------
# X1 clean panel, A1 entity summary, A2 period trends, X2 top performers

@register("clean_panel", part_with() + "\nSELECT * FROM clean")
def q_clean_panel(spark, sf):
    return part_clean(spark, sf)


@register("country_summary", part_with(summary_cte("l_partkey", "ship_year")) + f"""
SELECT l_partkey, first_year, last_year, num_years, {r6('avg_score')} AS avg_score,
  min_score, max_score, score_improvement, {r6('avg_yearly_change')} AS avg_yearly_change
FROM summary""")
def q_country_summary(spark, sf):
    return _r6(entity_summary(part_clean(spark, sf), PART_SPEC), "avg_score", "avg_yearly_change")


@register("yearly_trends", part_with() + f"""
SELECT ship_year, {r6('AVG(revenue)')} AS global_avg_score,
  {r6('STDDEV_SAMP(revenue)')} AS score_std_dev,
  MIN(revenue) AS min_score, MAX(revenue) AS max_score,
  COUNT(DISTINCT l_partkey) AS num_countries
FROM clean GROUP BY ship_year""")
def q_yearly_trends(spark, sf):
    return _r6(period_trends(part_clean(spark, sf), PART_SPEC), "global_avg_score", "score_std_dev")


_BEST_SQL = """,
best AS (SELECT {e}, revenue AS latest_score, yearly_rank AS latest_rank
         FROM (SELECT *, dense_rank() OVER (ORDER BY {p} DESC) AS age FROM clean) WHERE age = 1
         ORDER BY latest_score DESC NULLS LAST, {e} LIMIT 10)"""
_TOP_SELECT = """
SELECT {e}, {avg} AS avg_score, score_improvement, latest_score, latest_rank FROM best JOIN summary USING ({e})"""
_TOP_SQL = _BEST_SQL + _TOP_SELECT


@register("top_performers", part_with(summary_cte("l_partkey", "ship_year"))
          + _TOP_SQL.format(e="l_partkey", p="ship_year", avg=r6("avg_score")))
def q_top_performers(spark, sf):
    return _r6(top_performers(part_clean(spark, sf), PART_SPEC), "avg_score")


@register("top_performers_nation",
          nation_with(summary_cte("n_name", "order_year"))
          + _TOP_SQL.format(e="n_name", p="order_year", avg=r6("avg_score")))
def q_top_performers_nation(spark, sf):
    return _r6(top_performers(nation_clean(spark, sf), NATION_SPEC), "avg_score")


# --------------------------------------------------------------------------
# Windows and slices: W1-W3, P11, A15, T6/T8, A20

@register("lag_change", part_with() + """
SELECT l_partkey, ship_year, revenue, score_change FROM clean""")
def q_lag_change(spark, sf):
    return part_clean(spark, sf).select("l_partkey", "ship_year", "revenue", "score_change")


@register("yearly_rank", part_with() + """
SELECT ship_year, l_partkey, revenue, yearly_rank FROM clean""")
def q_yearly_rank(spark, sf):
    return part_clean(spark, sf).select("ship_year", "l_partkey", "revenue", "yearly_rank")


@register("latest_slice", part_with() + """
SELECT * FROM clean WHERE ship_year = (SELECT MAX(ship_year) FROM clean)""")
def q_latest_slice(spark, sf):
    return latest_slice(part_clean(spark, sf), PART_SPEC)


_NET_SQL = """
net AS (
  SELECT l_partkey, arg_max(revenue, ship_year) - arg_min(revenue, ship_year) AS net_change
  FROM clean GROUP BY l_partkey
)"""


@register("net_change", part_with(_NET_SQL) + "\nSELECT * FROM net")
def q_net_change(spark, sf):
    return net_change(part_clean(spark, sf), PART_SPEC)


@register("most_improved", part_with(_NET_SQL) + """
SELECT * FROM net ORDER BY net_change DESC NULLS LAST, l_partkey LIMIT 5""")
def q_most_improved(spark, sf):
    return most_improved(part_clean(spark, sf), PART_SPEC)


@register("entity_profile", part_with() + f"""
SELECT l_partkey,
  {r2('CAST(SUM(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE) / COUNT(revenue)')} AS revenue_mean, {r2('STDDEV_SAMP(revenue)')} AS revenue_std,
  {r2('MIN(revenue)')} AS revenue_min, {r2('MAX(revenue)')} AS revenue_max,
  {r2('CAST(SUM(CAST(quantity AS DECIMAL(38,6))) AS DOUBLE) / COUNT(quantity)')} AS quantity_mean, {r2('CAST(SUM(CAST(discount AS DECIMAL(38,6))) AS DOUBLE) / COUNT(discount)')} AS discount_mean,
  {r2('CAST(SUM(CAST(tax AS DECIMAL(38,6))) AS DOUBLE) / COUNT(tax)')} AS tax_mean, {r2('CAST(SUM(CAST(line_count AS DECIMAL(38,6))) AS DOUBLE) / COUNT(line_count)')} AS line_count_mean
FROM clean GROUP BY l_partkey""")
def q_entity_profile(spark, sf):
    return entity_profile(part_clean(spark, sf), PART_SPEC)


# --------------------------------------------------------------------------
# Quality: A10, A11, A18, X3; counts A3/A9

@register("quality_nulls", part_with() + """
SELECT 'null_values' AS "check", COUNT(*) = 0 AS passed,
  'Found ' || COUNT(*) || ' null values' AS details, COUNT(*) AS observed
FROM clean WHERE revenue IS NULL""")
def q_quality_nulls(spark, sf):
    return null_check(part_clean(spark, sf), "revenue")


@register("quality_duplicates", """
SELECT 'duplicates' AS "check", COUNT(*) = 0 AS passed,
  'Found ' || COUNT(*) || ' duplicate records' AS details, COUNT(*) AS observed,
  CAST(COALESCE(SUM(cnt - 1), 0) AS BIGINT) AS excess_rows
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""")
def q_quality_duplicates(spark, sf):
    return duplicate_check(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("quality_checks", part_with("""
checks AS (
  SELECT 'null_values' AS "check", COUNT(*) = 0 AS passed,
    'Found ' || COUNT(*) || ' null values' AS details, COUNT(*) AS observed
  FROM clean WHERE revenue IS NULL
  UNION ALL
  SELECT 'duplicates', COUNT(*) = 0, 'Found ' || COUNT(*) || ' duplicate records', COUNT(*)
  FROM (SELECT l_partkey, ship_year FROM clean GROUP BY 1, 2 HAVING COUNT(*) > 1)
)""") + """
SELECT *, bool_and(passed) OVER () AS all_passed FROM checks""")
def q_quality_checks(spark, sf):
    return quality_checks(part_clean(spark, sf), PART_SPEC.score, PART_SPEC.key)


@register("record_counts", part_with() + """
SELECT 'clean_infrastructure' AS table_name, COUNT(*) AS record_count FROM clean
UNION ALL SELECT 'country_summary', COUNT(DISTINCT l_partkey) FROM clean
UNION ALL SELECT 'yearly_trends', COUNT(DISTINCT ship_year) FROM clean""")
def q_record_counts(spark, sf):
    clean = part_clean(spark, sf)
    return record_counts({
        "clean_infrastructure": clean,
        "country_summary": entity_summary(clean, PART_SPEC),
        "yearly_trends": period_trends(clean, PART_SPEC),
    })


# --------------------------------------------------------------------------
# Profile: A12/P13, A13, A14, A21, A22/T9, A8, W4, X12

@register("null_profile", part_with() + """
SELECT column_name, null_count FROM (
  SELECT 'l_partkey' AS column_name, COUNT(*) - COUNT(l_partkey) AS null_count FROM clean
  UNION ALL SELECT 'ship_year', COUNT(*) - COUNT(ship_year) FROM clean
  UNION ALL SELECT 'revenue', COUNT(*) - COUNT(revenue) FROM clean
  UNION ALL SELECT 'quantity', COUNT(*) - COUNT(quantity) FROM clean
  UNION ALL SELECT 'discount', COUNT(*) - COUNT(discount) FROM clean
  UNION ALL SELECT 'tax', COUNT(*) - COUNT(tax) FROM clean
  UNION ALL SELECT 'line_count', COUNT(*) - COUNT(line_count) FROM clean
  UNION ALL SELECT 'avg_resilience', COUNT(*) - COUNT(avg_resilience) FROM clean
  UNION ALL SELECT 'score_change', COUNT(*) - COUNT(score_change) FROM clean
  UNION ALL SELECT 'yearly_rank', COUNT(*) - COUNT(yearly_rank) FROM clean
) WHERE null_count > 0""")
def q_null_profile(spark, sf):
    return null_profile(part_clean(spark, sf))


_LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {r6(f'CAST(SUM(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / COUNT({c})')} AS mean, "
            f"{r6(f'STDDEV_SAMP({x})')} AS std, MIN({x}) AS min, "
            f"{r6(f'quantile_cont({x}, 0.25)')} AS p25, {r6(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{r6(f'quantile_cont({x}, 0.75)')} AS p75, MAX({x}) AS max FROM lineitem")
    return "\nUNION ALL ".join(parts)


@register("describe_numeric", _describe_sql(_LINEITEM_NUMERIC))
def q_describe_numeric(spark, sf):
    d = describe_numeric(read_table(spark, sf, "lineitem"), _LINEITEM_NUMERIC)
    return _r6(d, "mean", "std", "p25", "p50", "p75")


def _corr_sql(cols, src) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(
                f"SELECT '{a}' AS var_x, '{b}' AS var_y, "
                f"{r6(f'COVAR_SAMP({a}, {b}) / NULLIF(STDDEV_SAMP({a}) * STDDEV_SAMP({b}), 0)')}"
                f" AS corr FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return "\nUNION ALL ".join(parts)


@register("correlation_matrix", part_with(
    "latest AS (SELECT * FROM clean WHERE ship_year = (SELECT MAX(ship_year) FROM clean))")
    + "\n" + _corr_sql(PART_SPEC.components, "latest"))
def q_correlation_matrix(spark, sf):
    latest = latest_slice(part_clean(spark, sf), PART_SPEC)
    return _r6(correlation_matrix(latest, PART_SPEC.components), "corr")


@register("table_schema", """
SELECT 'lineitem' AS table_name, column_name, CAST(ordinal_position AS BIGINT) AS position,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type,
  (SELECT COUNT(*) FROM lineitem) AS num_rows,
  (SELECT COUNT(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS num_columns
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def q_table_schema(spark, sf):
    return table_schema(read_table(spark, sf, "lineitem"), "lineitem")


@register("filter_domain", part_with() + """
SELECT DISTINCT l_partkey FROM clean WHERE l_partkey IS NOT NULL""")
def q_filter_domain(spark, sf):
    return filter_domain(part_clean(spark, sf), "l_partkey")


@register("period_bounds", part_with() + """
SELECT MIN(ship_year) AS first_period, MAX(ship_year) AS last_period FROM clean""")
def q_period_bounds(spark, sf):
    return period_bounds(part_clean(spark, sf), PART_SPEC)


@register("domain_stride", part_with() + """
SELECT ship_year, CAST((i - 1) / 2 AS BIGINT) AS mark FROM (
  SELECT ship_year, ROW_NUMBER() OVER (ORDER BY ship_year) AS i
  FROM (SELECT DISTINCT ship_year FROM clean WHERE ship_year IS NOT NULL))
WHERE (i - 1) % 2 = 0""")
def q_domain_stride(spark, sf):
    return domain_stride(part_clean(spark, sf), "ship_year", 2)


@register("exploration_summary", part_with(_NET_SQL) + """
SELECT MIN(ship_year) AS first_period, MAX(ship_year) AS last_period,
  COUNT(DISTINCT l_partkey) AS num_entities, COUNT(*) AS total_records,
  (SELECT l_partkey FROM clean WHERE ship_year = (SELECT MAX(ship_year) FROM clean)
   ORDER BY revenue DESC NULLS LAST, l_partkey LIMIT 1) AS top_performer,
  (SELECT l_partkey FROM net ORDER BY net_change DESC NULLS LAST, l_partkey LIMIT 1)
    AS most_improved
FROM clean""")
def q_exploration_summary(spark, sf):
    return exploration_summary(part_clean(spark, sf), PART_SPEC)


# --------------------------------------------------------------------------
# Dashboard views X6-X11, T10, reshape R1-R3

_TOP5_SQL = summary_cte("l_partkey", "ship_year") + _BEST_SQL.format(e="l_partkey", p="ship_year") + """,
top AS (""" + _TOP_SELECT.format(e="l_partkey", p="ship_year", avg="avg_score") + """),
sel AS (SELECT l_partkey FROM top ORDER BY latest_score DESC NULLS LAST, l_partkey LIMIT 5)"""


def _part_top(spark, sf):
    clean = part_clean(spark, sf)
    return clean, top_performers(clean, PART_SPEC)


@register("default_selection", part_with(_TOP5_SQL.replace(
    "sel AS (SELECT l_partkey FROM top",
    "sel AS (SELECT l_partkey, CAST(ROW_NUMBER() OVER (ORDER BY latest_score DESC NULLS LAST,"
    " l_partkey) AS BIGINT) AS position FROM top")) + "\nSELECT * FROM sel")
def q_default_selection(spark, sf):
    return default_selection(_part_top(spark, sf)[1], PART_SPEC)


@register("kpis", part_with(_TOP5_SQL) + """
SELECT COUNT(DISTINCT l_partkey) AS countries_analyzed,
  """ + r6("AVG(revenue)") + """ AS avg_score, COUNT(*) AS data_points,
  (SELECT l_partkey FROM top ORDER BY latest_score DESC NULLS LAST, l_partkey LIMIT 1)
    AS top_performer,
  format('{:.1f}', AVG(revenue)) AS avg_score_text, format('{:,}', COUNT(*)) AS data_points_text
FROM clean""")
def q_kpis(spark, sf):
    clean, top = _part_top(spark, sf)
    return _r6(kpis(clean, top, PART_SPEC), "avg_score")


@register("view_time_series", part_with(_TOP5_SQL) + """
SELECT l_partkey, ship_year, revenue FROM clean
WHERE l_partkey IN (SELECT l_partkey FROM sel) AND ship_year BETWEEN 1997 AND 2000""")
def q_view_time_series(spark, sf):
    clean, top = _part_top(spark, sf)
    # The selection is a top-5 result: a proven bound, broadcast.
    return view_time_series(clean, PART_SPEC, default_selection(top, PART_SPEC), 1997, 2000,
                            bounded=True)


@register("view_ranking", part_with() + """
SELECT l_partkey, ship_year, revenue FROM clean WHERE ship_year = 1998
ORDER BY revenue DESC NULLS LAST, l_partkey LIMIT 10""")
def q_view_ranking(spark, sf):
    return view_ranking(part_clean(spark, sf), PART_SPEC, 1998, 10)


@register("view_heatmap", part_with(_TOP5_SQL) + f"""
SELECT l_partkey, {r6('AVG(quantity)')} AS quantity, {r6('AVG(discount)')} AS discount,
  {r6('AVG(tax)')} AS tax, {r6('AVG(line_count)')} AS line_count
FROM clean WHERE l_partkey IN (SELECT l_partkey FROM sel) GROUP BY l_partkey""")
def q_view_heatmap(spark, sf):
    clean, top = _part_top(spark, sf)
    h = view_heatmap(clean, PART_SPEC, default_selection(top, PART_SPEC), bounded=True)
    return _r6(h, *PART_SPEC.components)


@register("view_improvement", part_with(_TOP5_SQL) + """
SELECT l_partkey, score_improvement FROM summary
WHERE l_partkey IN (SELECT l_partkey FROM sel)""")
def q_view_improvement(spark, sf):
    clean, top = _part_top(spark, sf)
    return view_improvement(entity_summary(clean, PART_SPEC), PART_SPEC,
                            default_selection(top, PART_SPEC), bounded=True)


def _box_sql(cols, period) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS variable, COUNT(v) AS n, MIN(v) AS min, {r6('q1')} AS q1, {r6('med')} AS median,
  {r6('q3')} AS q3, MAX(v) AS max,
  MIN(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)) AS lower_fence,
  MAX(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)) AS upper_fence,
  COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT {c} AS v FROM clean WHERE ship_year = {period} AND {c} IS NOT NULL),
  (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
          quantile_cont({c}, 0.75) AS q3 FROM clean WHERE ship_year = {period})
GROUP BY q1, med, q3""")
    return "\nUNION ALL ".join(parts)


@register("view_distribution", part_with() + _box_sql(PART_SPEC.components, 1998))
def q_view_distribution(spark, sf):
    return _r6(view_distribution(part_clean(spark, sf), PART_SPEC, 1998), "q1", "median", "q3")


@register("unpivot_components", part_with() + """
SELECT l_partkey, ship_year, variable, value,
  CASE variable WHEN 'quantity' THEN 'Quantity' WHEN 'discount' THEN 'Discount'
    WHEN 'tax' THEN 'Tax' WHEN 'line_count' THEN 'Lines' END AS label
FROM (UNPIVOT (SELECT l_partkey, ship_year, quantity, discount, tax, line_count FROM clean)
      ON quantity, discount, tax, line_count INTO NAME variable VALUE value)""")
def q_unpivot_components(spark, sf):
    return unpivot_components(part_clean(spark, sf), PART_SPEC)


@register("component_matrix", nation_with(
    "latest AS (SELECT * FROM clean WHERE order_year = (SELECT MAX(order_year) FROM clean))") + """
SELECT variable, n_name, value FROM (UNPIVOT (SELECT n_name, quantity, discount, tax, line_count FROM latest)
  ON quantity, discount, tax, line_count INTO NAME variable VALUE value)""")
def q_component_matrix(spark, sf):
    """The cells (component, nation); the wide form takes an explicit list of names."""
    return component_matrix(latest_slice(nation_clean(spark, sf), NATION_SPEC), NATION_SPEC).select(
        "variable", "n_name", "value")


# --------------------------------------------------------------------------
# Sources and sinks: S1-S3, S5, S6-S12, X4, A19. Each writes data derived
# from the driver tables to a fresh folder under the shared checkpoint folder
# and reads it back.

_PART_PANEL_SELECT = """
SELECT l_partkey, ship_year, revenue, quantity, discount, tax, line_count FROM panel"""


@register("scan_csv_roundtrip", "WITH " + PART_PANEL + _PART_PANEL_SELECT)
def q_scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "panel-csv")
    write_csv(part_raw(spark, sf), path)
    return read_csv(spark, path, panel_schema(PART_SPEC, T.LongType()))


@register("scan_glob_tagged", "WITH " + NATION_PANEL + """
SELECT 'raw_' || variable AS source, n_name, order_year, value
FROM (UNPIVOT (SELECT n_name, order_year, quantity, discount, tax, line_count FROM panel)
      ON quantity, discount, tax, line_count INTO NAME variable VALUE value)""")
def q_scan_glob_tagged(spark, sf):
    base = scratch_path(spark, "landing")
    long = nation_raw(spark, sf).unpivot(["n_name", "order_year"], list(NATION_SPEC.components),
                                           "indicator", "value")
    long.write.mode("overwrite").partitionBy("indicator").option("header", True).csv(base)
    schema = T.StructType([T.StructField("n_name", T.StringType()),
                           T.StructField("order_year", T.LongType()),
                           T.StructField("value", T.DoubleType())])
    df = read_csv_tagged(spark, f"{base}/indicator=*/*.csv", schema,
                         tag_regex=r"indicator=([^/]+)/")
    return df.select("source", "n_name", "order_year", "value")


def _payload_rows(spark, sf, value=None):
    p = part_raw(spark, sf)
    idv = lambda i, v: F.struct(i.alias("id"), v.alias("value"))
    return p.select(
        F.col("l_partkey"),
        idv(F.lit("REVENUE"), F.lit("revenue")).alias("indicator"),
        idv(F.col("l_partkey").cast("string"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("country"),
        F.format_string("P%07d", F.col("l_partkey")).alias("countryiso3code"),
        F.col("ship_year").cast("string").alias("date"),
        (F.col("revenue") if value is None else value).alias("value"),
        F.lit("").alias("unit"), F.lit("").alias("obs_status"), F.lit(0).cast("bigint").alias("decimal"))


def part_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """The part panel as API payload pages, one or more a part, a stage table."""
    return stage_table(spark, f"part_envelopes:{sf}",
                       lambda: encode_envelopes(_payload_rows(spark, sf), "l_partkey"),
                       _inputs(sf, "lineitem"))


def _landed_pages(spark, sf, path: str, rows: DataFrame | None = None, mode: str = "overwrite") -> str:
    """The part panel as the API answers: the indicator's rows in pages of about 5000, a file a page."""
    rows = _payload_rows(spark, sf) if rows is None else rows
    pages = encode_envelopes(rows.withColumn("_key", F.col("indicator.id")), "_key")
    pages.write.mode(mode).option("maxRecordsPerFile", 1).text(path)
    return path


@register("indicator_flatten", "WITH " + PART_PANEL + """
SELECT 'REVENUE' AS indicator_id, 'revenue' AS indicator_name,
  CAST(l_partkey AS VARCHAR) AS country_id, 'part ' || CAST(l_partkey AS VARCHAR) AS country,
  'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS iso3, ship_year AS year, revenue AS value
FROM panel""")
def q_indicator_flatten(spark, sf):
    """Whole files, a page each, and the API's empty answers: element 1 null, empty or absent give no rows."""
    path = _landed_pages(spark, sf, scratch_path(spark, "payloads"))
    edge = spark.range(1).select(F.explode(F.array(
        F.lit('[{"page":0}, null]'), F.lit('[{"page":0}, []]'),
        F.lit('[{"message":"invalid"}]'))).alias("value"))
    edge.write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return read_indicator_payloads(spark, path)


_GRID_SPEC = REFERENCE_SPEC.with_(entity="p_partkey")


@register("panel_grid", """
SELECT p_partkey, CAST(y AS BIGINT) AS year,
  s AS infrastructure_score, s + CAST(5 AS DOUBLE) AS transport_resilience,
  s + CAST(-5 AS DOUBLE) AS energy_resilience, s + CAST(2 AS DOUBLE) AS water_resilience,
  s + CAST(10 AS DOUBLE) AS digital_resilience
FROM (SELECT p_partkey, y, CAST(50 AS DOUBLE) + CAST(2 AS DOUBLE) * (p_partkey - 1)
             + CAST(0.5 AS DOUBLE) * (y - 2010) AS s
      FROM part CROSS JOIN range(2010, 2024) t(y))""")
def q_panel_grid(spark, sf):
    ents = read_table(spark, sf, "part").select(
        "p_partkey", (F.col("p_partkey") - 1).alias("idx"))
    return panel_grid(ents, _GRID_SPEC, 2010, 2023)


@register("sink_parquet_roundtrip", part_with() + "\nSELECT * FROM clean")
def q_sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "clean-parquet")
    clean = part_clean(spark, sf)
    write_parquet(clean, path, partition_by=["ship_year"], sort_within=["l_partkey"])
    return read_parquet(spark, path, clean.schema)


@register("sink_csv_roundtrip", part_with(summary_cte("l_partkey", "ship_year")) + f"""
SELECT l_partkey, first_year, last_year, num_years, {r6('avg_score')} AS avg_score,
  min_score, max_score, score_improvement, {r6('avg_yearly_change')} AS avg_yearly_change
FROM summary""")
def q_sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "summary-csv")
    summary = q_country_summary(spark, sf)
    write_csv(summary, path, sort_within=["l_partkey"])
    return read_csv(spark, path, summary.schema)


@register("run_metadata", part_with() + """
SELECT t.*, record_count AS csv_rows, TRUE AS created, TRUE AS run_time_ok
FROM (SELECT 'clean_infrastructure' AS table_name, COUNT(*) AS record_count FROM clean
  UNION ALL SELECT 'country_summary', COUNT(DISTINCT l_partkey) FROM clean
  UNION ALL SELECT 'yearly_trends', COUNT(DISTINCT ship_year) FROM clean) t""")
def q_run_metadata(spark, sf):
    """Gold tables published as Parquet and CSV; the metadata read back as the JSON object it is."""
    out = scratch_path(spark, "gold")
    clean = part_clean(spark, sf)
    tables = {
        "clean_infrastructure": clean,
        "country_summary": entity_summary(clean, PART_SPEC),
        "yearly_trends": period_trends(clean, PART_SPEC),
    }
    publish_gold(spark, tables, out)
    csv = record_counts({n: read_csv(spark, f"{out}/{n}.csv", t.schema) for n, t in tables.items()})
    meta = read_json_object(spark, f"{out}/pipeline_metadata.json")
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("pipeline_run"))
    counts = F.from_json(F.to_json("record_counts"), "map<string, bigint>")
    rows = meta.select(F.explode(counts).alias("table_name", "record_count"), "tables_created", age.between(0, 3600).alias("run_time_ok"))
    return rows.join(csv.withColumnRenamed("record_count", "csv_rows"), "table_name").select(
        "table_name", "record_count", "csv_rows", F.array_contains("tables_created", F.col("table_name")).alias("created"), "run_time_ok")


def _landing_catalog(spark, sf):
    """A landing folder shaped like the reference's raw folder: one CSV
    dataset per indicator plus the panel, written from the driver tables."""
    base = scratch_path(spark, "raw")
    exact = lambda c: F.col(c).cast("decimal(18,4)").alias(c)
    panel = nation_raw(spark, sf).select("n_name", "order_year", *[exact(c) for c in ("revenue", *NATION_SPEC.components)])
    # The nation panel is bounded (nations x years): one file per dataset.
    write_csv(panel, f"{base}/infrastructure_scores", single_file=True)
    long = panel.unpivot(["n_name", "order_year"], list(NATION_SPEC.components),
                         "indicator", "value")
    (long.repartition("indicator").write.mode("overwrite").partitionBy("indicator")
     .option("header", True).csv(f"{base}/indicators"))
    return data_catalog(spark, base, "*.csv")


_SETS_SQL = """
texts AS (SELECT n_name, order_year, """ + ", ".join(
    f"CAST(CAST({c} AS DECIMAL(18,4)) AS VARCHAR) AS {c}" for c in ("revenue", "quantity", "discount", "tax", "line_count")) + """ FROM panel),
files AS (SELECT 'infrastructure_scores' AS dataset, 7 AS w, length('n_name,order_year,revenue,quantity,discount,tax,line_count') AS head,
    length(concat_ws(',', n_name, order_year, revenue, quantity, discount, tax, line_count)) AS body FROM texts
  UNION ALL SELECT v, 3, length('n_name,order_year,value'), length(concat_ws(',', n_name, order_year, x))
    FROM (UNPIVOT (SELECT n_name, order_year, quantity, discount, tax, line_count FROM texts)
          ON quantity, discount, tax, line_count INTO NAME v VALUE x)),
sets AS (SELECT dataset, CAST(1 AS BIGINT) AS files, COUNT(*) AS rows, CAST(any_value(w) AS BIGINT) AS "columns",
    """ + r2("(any_value(head) + 1 + SUM(body + 1)) / 1048576.0") + """ AS size_mb FROM files GROUP BY dataset)"""


@register("data_catalog", "WITH " + NATION_PANEL + "," + _SETS_SQL + "\nSELECT * FROM sets")
def q_data_catalog(spark, sf):
    return dataset_catalog(_landing_catalog(spark, sf))


@register("catalog_totals", "WITH " + NATION_PANEL + "," + _SETS_SQL + """
SELECT COUNT(*) AS datasets_collected, """ + r2("SUM(size_mb)") + """ AS total_size_mb, CAST(SUM(rows) AS BIGINT) AS total_rows FROM sets""")
def q_catalog_totals(spark, sf):
    return catalog_totals(dataset_catalog(_landing_catalog(spark, sf)))


@register("catalog_files", "WITH " + NATION_PANEL + """
SELECT name, CAST(COUNT(*) * IF(name = 'many', 1, 2) AS BIGINT) AS rows, CAST(IF(name = 'many', 3, 2) AS BIGINT) AS "columns", TRUE AS timed
FROM panel, (VALUES ('many'), ('quoted')) t(name) GROUP BY name""")
def q_catalog_files(spark, sf):
    """File-level facts: quoted newlines inside cells and in the header, several files, times as text."""
    base = scratch_path(spark, "raw")
    panel = nation_raw(spark, sf)
    write_csv(panel.select("n_name", "order_year", "revenue"), f"{base}/many")
    said = panel.select(F.concat(F.lit("of "), "n_name", F.lit(',\n"'), F.col("order_year").cast("string"), F.lit('"\n\n')).alias("a\nb"), "revenue")
    write_csv(said.unionByName(said), f"{base}/quoted", single_file=True)
    files = data_catalog(spark, base).withColumn("name", F.element_at(F.split("path", "/"), -2))
    fresh = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("downloaded"))
    return files.groupBy("name").agg(F.sum("rows").cast("bigint").alias("rows"), F.max("columns").alias("columns"),
                                     F.bool_and(fresh.between(-60, 3600) & (F.col("size_mb") >= 0)).alias("timed"))


@register("scan_csv_reordered", "WITH " + PART_PANEL + _PART_PANEL_SELECT)
def q_scan_csv_reordered(spark, sf):
    """A CSV whose columns stand in another order, with one more: bound by name."""
    path = scratch_path(spark, "reordered-csv")
    raw = part_raw(spark, sf)
    write_csv(raw.select(F.lit("x").alias("note"), *reversed(raw.columns)), path)
    return read_csv(spark, path, panel_schema(PART_SPEC, T.LongType()))


@register("payload_rejects", "WITH " + PART_PANEL + """
SELECT 'rows' AS status, COUNT(DISTINCT l_partkey) AS payloads FROM panel
UNION ALL SELECT 'empty', 2 UNION ALL SELECT 'broken', 2 + COUNT(DISTINCT l_partkey) FROM panel""")
def q_payload_rejects(spark, sf):
    """Payloads by status: every page again cut in half, error pages, empty answers."""
    env = part_envelopes(spark, sf)
    odd = spark.createDataFrame([("<html>502</html>",), ('{"message": 1}',), ('[{"page":0}, null]',), ('[{"page":0}, []]',)], "value string")
    return payload_rejects(env.unionByName(env.select(F.expr("left(value, length(value) div 2)").alias("value"))).unionByName(odd))


# --------------------------------------------------------------------------
# Composite jobs end to end: X5 (pipeline) and X13 (landing ingest)

@register("pipeline_run",
          nation_with(summary_cte("n_name", "order_year"))
          + _TOP_SQL.format(e="n_name", p="order_year", avg=r6("avg_score")))
def q_pipeline_run(spark, sf):
    """The whole ETL on the nation panel written as the raw CSV: extract,
    transform, checks before publish, gold Parquet + CSV, metadata, view."""
    base = scratch_path(spark, "pipeline")
    write_csv(nation_raw(spark, sf), f"{base}/raw", single_file=True)
    run_pipeline(spark, f"{base}/raw", f"{base}/final", NATION_SPEC)
    return _r6(spark.read.parquet(f"{base}/final/top_performers.parquet"), "avg_score")


@register("landing_ingest", "WITH " + PART_PANEL + """
SELECT 'REVENUE' AS indicator_id, 'revenue' AS indicator_name,
  CAST(l_partkey AS VARCHAR) AS country_id, 'part ' || CAST(l_partkey AS VARCHAR) AS country,
  'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS iso3, ship_year AS year, revenue AS value,
  'revenue_total' AS indicator
FROM panel""")
def q_landing_ingest(spark, sf):
    """Payloads landed as files -> tidy table partitioned by indicator (named
    through the code -> name map), raw CSVs, catalog and collection report."""
    land, out = scratch_path(spark, "landing"), scratch_path(spark, "ingest")
    _landed_pages(spark, sf, land)
    ingest_indicators(spark, land, out, {"REVENUE": "revenue_total"})
    return spark.read.parquet(f"{out}/indicators.parquet").select(*FLAT_COLUMNS, "indicator")


@register("landing_ingest_incremental", "WITH " + PART_PANEL + """
SELECT 'REVENUE' AS indicator_id, 'revenue' AS indicator_name,
  CAST(l_partkey AS VARCHAR) AS country_id, 'part ' || CAST(l_partkey AS VARCHAR) AS country,
  'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS iso3, ship_year AS year,
  CASE WHEN ship_year >= 1998 THEN revenue + quantity ELSE revenue END AS value,
  'revenue_total' AS indicator, CASE WHEN ship_year >= 1998 THEN 2 ELSE 1 END AS landing
FROM panel""")
def q_landing_ingest_incremental(spark, sf):
    """Two landings, the second with corrected values of the years from 1998 on, and a third run that finds nothing new:
    every key once, with its latest value."""
    land, out, names = scratch_path(spark, "landing"), scratch_path(spark, "ingest"), {"REVENUE": "revenue_total"}
    _landed_pages(spark, sf, f"{land}/first")
    ingest_indicators(spark, land, out, names)
    late = _payload_rows(spark, sf, F.col("revenue") + F.col("quantity")).where(F.col("date") >= "1998")
    _landed_pages(spark, sf, f"{land}/second", late)
    for _ in range(2):
        ingest_indicators(spark, land, out, names)
    landing = F.when(F.col("file").contains("/second/"), 2).otherwise(1)
    return spark.read.parquet(f"{out}/indicators.parquet").select(*FLAT_COLUMNS, "indicator", landing.alias("landing"))


@register("top_per_period", part_with() + """
SELECT * FROM (
  SELECT l_partkey, ship_year, revenue,
    CAST(RANK() OVER (PARTITION BY ship_year ORDER BY revenue DESC NULLS LAST) AS BIGINT)
      AS period_rank
  FROM clean) WHERE period_rank <= 10""")
def q_top_per_period(spark, sf):
    return top_per_period(part_clean(spark, sf), PART_SPEC, 10)


def _dict_cell(i, v):
    """A dict cell as a pandas collector writes it: Python repr."""
    return F.concat(F.lit("{'id': '"), i, F.lit("', 'value': '"), v, F.lit("'}"))


@register("scan_indicator_csv", "WITH " + PART_PANEL + """
SELECT 'REVENUE' AS indicator_id, 'revenue' AS indicator_name,
  CAST(l_partkey AS VARCHAR) AS country_id, 'part ' || CAST(l_partkey AS VARCHAR) AS country,
  'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS iso3, ship_year AS year, revenue AS value,
  'raw_worldbank_revenue' AS source
FROM panel""")
def q_scan_indicator_csv(spark, sf):
    """Downloaded indicator CSVs (dict cells in Python repr) -> tidy rows."""
    return read_indicator_csv(spark, f"{_indicator_files(spark, sf)}/worldbank_*/*.csv",
                              tag_regex=r"/(worldbank_[^/]+)/")


def _indicator_files(spark, sf, spoil: bool = False) -> str:
    """Indicator CSVs as a pandas collector leaves them, one folder a table. ``spoil``: a second table whose
    value cell reads "n/a" for parts with a single line in the year and whose country cell is no dict in 1996."""
    base = scratch_path(spark, "raw-indicators")
    rows = _payload_rows(spark, sf).withColumn("lines", F.lit(2))
    if spoil:
        rows = part_raw(spark, sf).select("l_partkey", "ship_year", "line_count").join(
            rows.drop("lines").withColumn("ship_year", F.col("date").cast("bigint")), ["l_partkey", "ship_year"]).withColumnRenamed("line_count", "lines")

    def write(name, value, country):
        cells = rows.select(
            _dict_cell(F.col("indicator.id"), F.col("indicator.value")).alias("indicator"), country.alias("country"),
            "countryiso3code", "date", value.alias("value"), "unit", "obs_status", F.col("decimal").cast("string").alias("decimal"))
        write_csv(cells, f"{base}/{name}")

    value, country = F.col("value").cast("string"), _dict_cell(F.col("country.id"), F.col("country.value"))
    write("worldbank_revenue", value, country)
    if spoil:
        write("worldbank_spoiled", F.when(F.col("lines") == 1, "n/a").otherwise(value),
              F.when(F.col("date") == "1996", "{broken}").otherwise(country))
    return base


@register("pipeline_extract", "WITH " + PART_PANEL + """
SELECT source, CASE WHEN source LIKE '%spoiled' THEN COUNT(*) FILTER (NOT bad) ELSE COUNT(*) END AS rows,
  CASE WHEN source LIKE '%spoiled' THEN COUNT(*) FILTER (bad) ELSE 0 END AS rejected
FROM (SELECT *, line_count = 1 OR ship_year = 1996 AS bad FROM panel), (VALUES ('raw_worldbank_revenue'), ('raw_worldbank_spoiled')) t(source)
GROUP BY source""")
def q_pipeline_extract(spark, sf):
    """The pipeline with every indicator file beside the panel: rows and rejected records of each."""
    base, out = scratch_path(spark, "pipeline"), scratch_path(spark, "final")
    write_csv(nation_raw(spark, sf), f"{base}/raw", single_file=True)
    run_pipeline(spark, f"{base}/raw", out, NATION_SPEC, indicators=f"{_indicator_files(spark, sf, True)}/worldbank_*/*.csv",
                 indicator_tag=r"/(worldbank_[^/]+)/")
    return spark.read.parquet(f"{out}/extract_report.parquet").select("source", "rows", "rejected")


# --------------------------------------------------------------------------
# Stored states, sketches, catalogued tables, wide tables

@register("summary_incremental", part_with(summary_cte("l_partkey", "ship_year")) + f"""
SELECT l_partkey, first_year, last_year, num_years, {r6('avg_score')} AS avg_score,
  min_score, max_score, score_improvement, {r6('avg_yearly_change')} AS avg_yearly_change
FROM summary""")
def q_summary_incremental(spark, sf):
    """The entity summary of a state that took in the last two years one by one, each read alone."""
    base = scratch_path(spark, "by-period")
    raw = select_panel(part_raw(spark, sf), PART_SPEC)
    write_parquet(raw, f"{base}/panel", partition_by=["ship_year"])
    panel = read_parquet(spark, f"{base}/panel", raw.schema)
    last = panel.agg(F.max("ship_year")).first()[0]
    write_parquet(entity_state(panel.where(F.col("ship_year") <= last - 2), PART_SPEC), f"{base}/state")
    for year in (last - 1, last):
        state = add_period(spark, panel, f"{base}/state", PART_SPEC, year)
    return _r6(summary_of(state, PART_SPEC), "avg_score", "avg_yearly_change")


@register("distinct_sketches", part_with() + """
SELECT COUNT(DISTINCT l_partkey) AS exact, TRUE AS within_bound, COUNT(*) AS rows FROM clean""")
def q_distinct_sketches(spark, sf):
    """Distinct parts from one stored sketch a year, held against the exact count: within three standard errors."""
    clean = part_clean(spark, sf)
    path = scratch_path(spark, "sketches")
    write_parquet(distinct_sketches(clean, ["ship_year"], "l_partkey"), path)
    exact = clean.agg(F.count_distinct("l_partkey").cast("bigint").alias("exact"))
    off = F.abs(F.col("distinct_estimate") - F.col("exact"))
    return distinct_of(spark.read.parquet(path)).withColumn("exact", exact.scalar()).select(
        "exact", (off <= 3 * 1.04 / 64 * F.col("exact")).alias("within_bound"), "rows")


@register("sql_top_performers", part_with(summary_cte("l_partkey", "ship_year"))
          + _TOP_SQL.format(e="l_partkey", p="ship_year", avg=r6("avg_score")))
def q_sql_top_performers(spark, sf):
    """The published view by its name in the session's catalog."""
    clean, path = part_clean(spark, sf), scratch_path(spark, "warehouse")
    db = "gold_" + path.rsplit("-", 1)[1]
    publish_catalog(spark, {"clean_infrastructure": clean, "country_summary": entity_summary(clean, PART_SPEC)},
                    {"top_performers": top_performers_sql(PART_SPEC, db)}, db, path)
    return _r6(spark.sql(f"SELECT * FROM `{db}`.top_performers"), "avg_score")


_WIDE = 300
_WIDE_COLUMNS = [f"c{i}" for i in range(_WIDE)]


def _wide_sql() -> str:
    """A column per remainder of the supplier: lines of a part and year by supplier group."""
    return ", ".join(f"SUM(CASE WHEN l_suppkey % {_WIDE} = {i} THEN l_quantity END) AS c{i}" for i in range(_WIDE))


@register("correlation_wide", f"""
WITH wide AS (SELECT {_wide_sql()} FROM lineitem GROUP BY l_partkey % 97, year(l_shipdate)),
long AS (SELECT row_number() OVER () AS r, * FROM wide),
cells AS (SELECT r, CAST(substr(name, 2) AS INTEGER) AS c, v FROM (UNPIVOT long ON COLUMNS(* EXCLUDE r) INTO NAME name VALUE v)),
pairs AS (SELECT a.c AS x, b.c AS y, COUNT(*) AS n, AVG(a.v) AS ma, AVG(b.v) AS mb, COVAR_SAMP(a.v, b.v) AS cov,
    STDDEV_SAMP(a.v) AS sa, STDDEV_SAMP(b.v) AS sb FROM cells a JOIN cells b USING (r) GROUP BY 1, 2)
SELECT 'c' || i AS var_x, 'c' || j AS var_y, CASE WHEN n > 1 THEN {r6('cov / NULLIF(sa * sb, 0)')} END AS corr
FROM range({_WIDE}) p(i) CROSS JOIN range({_WIDE}) q(j) LEFT JOIN pairs ON x = i AND y = j""")
def q_correlation_wide(spark, sf):
    """All pairs of 300 columns: a part group's yearly quantities by supplier group, with many missing cells."""
    rows = read_table(spark, sf, "lineitem").withColumn("s", F.col("l_suppkey") % _WIDE)
    wide = (rows.groupBy((F.col("l_partkey") % 97).alias("g"), F.year("l_shipdate").alias("y"))
            .pivot("s", list(range(_WIDE))).agg(F.sum("l_quantity")).drop("g", "y").toDF(*_WIDE_COLUMNS))
    wide = materialize(wide, "wide")  # read twice: for the means and for the co-moments
    return _r6(correlation_tiles(wide, _WIDE_COLUMNS), "corr")


@register("component_blocks", part_with("""
latest AS (SELECT * FROM clean WHERE ship_year = (SELECT MAX(ship_year) FROM clean)),
places AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS place FROM (SELECT DISTINCT l_partkey FROM latest))""") + """
SELECT CAST(place // 100 AS BIGINT) AS block, variable, l_partkey, value,
  MIN(l_partkey) OVER (PARTITION BY place // 100) AS first, MAX(l_partkey) OVER (PARTITION BY place // 100) AS last
FROM (UNPIVOT (SELECT l_partkey, quantity, discount, tax, line_count FROM latest)
      ON quantity, discount, tax, line_count INTO NAME variable VALUE value) JOIN places USING (l_partkey)""")
def q_component_blocks(spark, sf):
    """The component x part matrix of the latest year in blocks of 100 columns, as cells with their block's bounds."""
    blocks, index = component_blocks(latest_slice(part_clean(spark, sf), PART_SPEC), PART_SPEC, 100)
    cells = blocks.select("block", "variable", F.explode(F.arrays_zip(F.col("names").alias("l_partkey"), F.col("values").alias("value"))).alias("c"))
    return cells.select("block", "variable", "c.*").join(index.select("block", "first", "last"), "block")


# --------------------------------------------------------------------------
# pandas key rules (A4, A5), emptiness (A23), order (T1, T2), text forms

def _holed(spark, sf) -> DataFrame:
    """The clean panel with entity and period missing where a part had a single line in the year."""
    missing = F.col("line_count") == 1
    return part_clean(spark, sf).withColumns({c: F.when(~missing, F.col(c)) for c in ("l_partkey", "ship_year")})


_HOLED_SQL = "holed AS (SELECT * REPLACE (CASE WHEN line_count <> 1 THEN l_partkey END AS l_partkey, CASE WHEN line_count <> 1 THEN ship_year END AS ship_year) FROM clean)"


@register("entity_summary_null_keys", part_with(_HOLED_SQL) + f"""
SELECT 'sql' AS rule, l_partkey, COUNT(*) AS num_years, {r6('AVG(revenue)')} AS avg_score, MIN(ship_year) AS first_year FROM holed GROUP BY l_partkey
UNION ALL SELECT 'pandas', l_partkey, COUNT(*), {r6('AVG(revenue)')}, MIN(ship_year) FROM holed WHERE l_partkey IS NOT NULL GROUP BY l_partkey""")
def q_entity_summary_null_keys(spark, sf):
    parts = [entity_summary(_holed(spark, sf), PART_SPEC, drop_null_keys=drop).select(F.lit(rule).alias("rule"), "l_partkey", "num_years", "avg_score", "first_year")
             for rule, drop in (("sql", False), ("pandas", True))]
    return _r6(parts[0].unionByName(parts[1]), "avg_score")


@register("period_trends_null_keys", part_with(_HOLED_SQL) + f"""
SELECT 'sql' AS rule, ship_year, {r6('AVG(revenue)')} AS global_avg_score, {r6('STDDEV_SAMP(revenue)')} AS score_std_dev, COUNT(DISTINCT l_partkey) AS num_countries
FROM holed GROUP BY ship_year
UNION ALL SELECT 'pandas', ship_year, {r6('AVG(revenue)')}, {r6('STDDEV_SAMP(revenue)')}, COUNT(DISTINCT l_partkey) FROM holed WHERE ship_year IS NOT NULL GROUP BY ship_year""")
def q_period_trends_null_keys(spark, sf):
    parts = [period_trends(_holed(spark, sf), PART_SPEC, drop_null_keys=drop).select(
        F.lit(rule).alias("rule"), "ship_year", "global_avg_score", "score_std_dev", "num_countries") for rule, drop in (("sql", False), ("pandas", True))]
    return _r6(parts[0].unionByName(parts[1]), "global_avg_score", "score_std_dev")


@register("completeness", part_with(_HOLED_SQL) + """
SELECT 'holed' AS of, CAST(2 * COUNT(*) FILTER (line_count = 1) + COUNT(*) FILTER (score_change IS NULL) AS BIGINT) AS missing, FALSE AS no_missing FROM holed
UNION ALL SELECT 'scores', 0, TRUE""")
def q_completeness(spark, sf):
    parts = [completeness(df, cols).select(F.lit(of).alias("of"), "missing", "no_missing")
             for of, df, cols in (("holed", _holed(spark, sf), None), ("scores", part_clean(spark, sf), [PART_SPEC.score]))]
    return parts[0].unionByName(parts[1])


@register("export_order", part_with() + """
SELECT 'clean_infrastructure' AS exported, COUNT(*) AS rows, TRUE AS in_order FROM clean
UNION ALL SELECT 'yearly_trends', COUNT(DISTINCT ship_year), TRUE FROM clean""")
def q_export_order(spark, sf):
    """Exported rows stand in order within every file, and the files in order of their numbers."""
    clean, parts = part_clean(spark, sf), []
    for name, df, order in (("clean_infrastructure", clean, ["l_partkey", "ship_year"]), ("yearly_trends", period_trends(clean, PART_SPEC), ["ship_year"])):
        path = scratch_path(spark, name)
        write_parquet(df.repartitionByRange(*[F.asc_nulls_last(c) for c in order]), path, sort_within=order)
        meta = F.col("_metadata")
        rows = spark.read.parquet(path).select(meta.file_name.alias("file"), meta.row_index.alias("at"), F.struct(*order).alias("key"))
        before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
        rows = rows.withColumn("ok", F.coalesce(before <= F.col("key"), F.lit(True)))
        files = rows.groupBy("file").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.bool_and("ok").alias("ok"), F.count(F.lit(1)).alias("n"))
        behind = F.coalesce(F.lag("hi").over(Window.orderBy("file")) <= F.col("lo"), F.lit(True))  # a row per file
        parts.append(files.withColumn("behind", behind).agg(
            F.sum("n").cast("bigint").alias("rows"), F.bool_and(F.col("ok") & F.col("behind")).alias("in_order")).select(F.lit(name).alias("exported"), "rows", "in_order"))
    return parts[0].unionByName(parts[1])


@register("text_forms", r"""
SELECT o_orderkey, regexp_extract('/raw/worldbank_' || o_orderkey || '.x.csv', '([^/]+?)(\.[^./]*)?$', 1) AS stem,
  FLOOR((o_orderkey * 4096) / 1048576.0 * 100 + 0.5) / 100 AS size_mb, format('{:.1f}', o_totalprice) AS fixed,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, CAST(list_position(['F', 'O'], o_orderstatus) - 1 AS BIGINT) AS place
FROM orders""")
def q_text_forms(spark, sf):
    """F4 fixed-point text, F7 times as text, F9 table name of a path, F10 bytes as MB, F11 place in a list, over all orders."""
    rows = read_table(spark, sf, "orders")
    path = F.concat(F.lit("/raw/worldbank_"), F.col("o_orderkey").cast("string"), F.lit(".x.csv"))
    return rows.select("o_orderkey", file_stem(path).alias("stem"), bytes_to_mb(F.col("o_orderkey") * 4096).alias("size_mb"),
                       fixed_text("o_totalprice", 1).alias("fixed"), timestamp_text("o_orderdate").alias("at"),
                       position_in("o_orderstatus", ["F", "O"]).cast("bigint").alias("place"))
