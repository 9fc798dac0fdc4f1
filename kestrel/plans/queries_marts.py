"""Registered queries: quality gates, product marts, activation and growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.core import zscore
from kestrel.operators import growth, metrics, quality
from kestrel.plans import oracle_marts as M
from kestrel.plans.queries_core import MONEY, rollup_sql, sql
from kestrel.plans.registry import register

PERF_R6 = ("session_booking_conversion", "no_result_rate", "alternatives_exposure_rate", "avg_search_latency_ms")
GROWTH_R2 = MONEY + ("recent_4w_successful_value", "recent_4w_platform_revenue",
                     "prior_4w_successful_value", "prior_4w_platform_revenue")
GROWTH_R6 = PERF_R6 + ("recent_4w_conversion", "prior_4w_conversion", "conversion_change_pp",
                       "successful_value_growth_rate")


# ---------------------------------------------------------------- quality gates

def _dup_checks(c):
    v = c.views
    return quality.check_table(
        quality.duplicate_keys(v.partners, "partner_id", "duplicate_partner_ids"),
        quality.duplicate_keys(v.sessions, "session_id", "duplicate_session_ids"),
        quality.duplicate_keys(v.searches, "search_id", "duplicate_search_ids"),
        quality.duplicate_keys(v.bookings, "booking_id", "duplicate_booking_ids"))


DUP_SQL = """SELECT 'duplicate_partner_ids' AS "check", count(*) - count(DISTINCT partner_id) AS violations FROM v_partners
UNION ALL SELECT 'duplicate_session_ids', count(*) - count(DISTINCT session_id) FROM v_sessions
UNION ALL SELECT 'duplicate_search_ids', count(*) - count(DISTINCT search_id) FROM v_searches
UNION ALL SELECT 'duplicate_booking_ids', count(*) - count(DISTINCT booking_id) FROM v_bookings"""


def _orphan_checks(c):
    v = c.views
    return quality.check_table(
        quality.orphans(v.sessions, v.partners, "partner_id", "partner_id", "orphan_session_partner"),
        quality.orphans(v.searches, v.sessions, "session_id", "session_id", "orphan_search_session"),
        quality.orphans(v.bookings, v.searches, "search_id", "search_id", "orphan_booking_search"))


ORPHAN_SQL = """SELECT 'orphan_session_partner' AS "check", count(*) AS violations FROM v_sessions s
  WHERE NOT EXISTS (SELECT 1 FROM v_partners p WHERE p.partner_id = s.partner_id)
UNION ALL SELECT 'orphan_search_session', count(*) FROM v_searches s
  WHERE NOT EXISTS (SELECT 1 FROM v_sessions p WHERE p.session_id = s.session_id)
UNION ALL SELECT 'orphan_booking_search', count(*) FROM v_bookings s
  WHERE NOT EXISTS (SELECT 1 FROM v_searches p WHERE p.search_id = s.search_id)"""


def _rule_checks(c):
    s = c.views.searches
    return quality.rule_violations(s, {
        "zero_result_selected": (F.col("no_result_flag") == 1) & (F.col("selected_flag") == 1)})


RULE_SQL = """SELECT 'zero_result_selected' AS "check",
  CAST(count(*) FILTER (WHERE no_result_flag = 1 AND selected_flag = 1) AS BIGINT) AS violations FROM v_searches"""


def _temporal_checks(c):
    v = c.views
    return quality.check_table(
        quality.temporal_violations(v.sessions, v.partners, "partner_id", "session_ts", "launch_date",
                                    "sessions_before_partner_launch"))


TEMPORAL_SQL = """SELECT 'sessions_before_partner_launch' AS "check",
  CAST(count(*) FILTER (WHERE s.session_ts < p.launch_date) AS BIGINT) AS violations
  FROM v_sessions s LEFT JOIN v_partners p ON s.partner_id = p.partner_id"""


def _outcome_checks(c):
    v = c.views
    return quality.outcome_parent_violations(v.searches, v.bookings, "search_id", {
        "booking_without_selection": F.col("selected_flag") != 1,
        "booking_from_zero_result": F.col("no_result_flag") == 1})


OUTCOME_SQL = """SELECT 'booking_without_selection' AS "check",
  CAST(count(*) FILTER (WHERE selected_flag <> 1) AS BIGINT) AS violations
  FROM v_searches WHERE search_id IN (SELECT search_id FROM v_bookings)
UNION ALL SELECT 'booking_from_zero_result', CAST(count(*) FILTER (WHERE no_result_flag = 1) AS BIGINT)
  FROM v_searches WHERE search_id IN (SELECT search_id FROM v_bookings)"""

register("in06_duplicate_keys", ids=("IN-06",), sql=sql(DUP_SQL))(_dup_checks)
register("in07_orphan_keys", ids=("IN-07",), sql=sql(ORPHAN_SQL))(_orphan_checks)
register("in08_cross_column_rule", ids=("IN-08",), sql=sql(RULE_SQL))(_rule_checks)
register("in09_temporal_rule", ids=("IN-09",), sql=sql(TEMPORAL_SQL))(_temporal_checks)
register("in10_outcome_parent_rules", ids=("IN-10",), sql=sql(OUTCOME_SQL))(_outcome_checks)


@register("in11_check_table", ids=("IN-11",), sql=sql(
    "\nUNION ALL ".join([DUP_SQL, ORPHAN_SQL, RULE_SQL, TEMPORAL_SQL, OUTCOME_SQL])))
def q_check_table(c):
    return quality.check_table(_dup_checks(c), _orphan_checks(c), _rule_checks(c), _temporal_checks(c),
                               _outcome_checks(c))


@register("in12_fact_grain", ids=("IN-12",), sql=sql("""
SELECT 'fct_session_journey' AS table_name, count(*) AS rows, count(DISTINCT session_id) AS distinct_keys,
       count(*) - count(DISTINCT session_id) AS duplicates FROM fct_session
UNION ALL SELECT 'fct_search_journey', count(*), count(DISTINCT search_id), count(*) - count(DISTINCT search_id)
FROM fct_search"""))
def q_grain(c):
    return quality.grain_check(c.session_fact, ["session_id"], "fct_session_journey").unionByName(
        quality.grain_check(c.search_fact, ["search_id"], "fct_search_journey"))


DAILY = "o_daily AS (" + rollup_sql("session_date", "metric_date") + ")"


@register("in13_daily_contract", ids=("IN-13",), sql=sql("""
SELECT 'mart_daily_product_metrics' AS mart, count(*) AS rows,
       coalesce(bool_and((session_booking_conversion BETWEEN 0 AND 1) AND (search_to_book_conversion BETWEEN 0 AND 1)
                         AND (no_result_rate BETWEEN 0 AND 1) AND (result_selection_rate BETWEEN 0 AND 1)
                         AND (cancellation_rate BETWEEN 0 AND 1) AND (refund_rate BETWEEN 0 AND 1)), true)
         AS rates_in_unit_interval
FROM o_daily""", DAILY))
def q_daily_contract(c):
    return quality.contract(metrics.daily_metrics(c.session_fact), "mart_daily_product_metrics",
                            rate_cols=["session_booking_conversion", "search_to_book_conversion", "no_result_rate",
                                       "result_selection_rate", "cancellation_rate", "refund_rate"])


@register("in13_opportunity_contract", ids=("IN-13",), sql=sql("""
SELECT 'mart_stage3_partner_opportunities' AS mart, count(*) AS rows,
       count(priority_rank) = count(DISTINCT priority_rank) AS ranks_unique,
       coalesce(bool_and(opportunity_score IS NOT NULL AND isfinite(opportunity_score)), true) AS scores_finite
FROM o_opps""", M.PERFORMANCE, M.WEEKLY, M.GROWTH, M.OPPORTUNITIES))
def q_opp_contract(c):
    return quality.contract(c.opportunities, "mart_stage3_partner_opportunities", rank_col="priority_rank",
                            finite_cols=["opportunity_score"])


@register("in13_funnel_monotonic", ids=("IN-13",), sql=sql("""
SELECT coalesce(bool_and(prev IS NULL OR count <= prev), true) AS monotonic_non_increasing
FROM (SELECT count, lag(count) OVER (ORDER BY stage_order) AS prev FROM o_funnel) AS f""", M.FUNNEL))
def q_funnel_monotonic(c):
    return quality.monotonic_non_increasing(metrics.funnel(c.search_fact), "stage_order", "count")


@register("in14_table_counts", ids=("IN-14",), sql=sql("""
SELECT 'stg_partners' AS table_name, count(*) AS rows, true AS present FROM v_partners
UNION ALL SELECT 'stg_stations', count(*), true FROM v_stations
UNION ALL SELECT 'stg_sessions', count(*), true FROM v_sessions
UNION ALL SELECT 'stg_searches', count(*), true FROM v_searches
UNION ALL SELECT 'stg_bookings', count(*), true FROM v_bookings
UNION ALL SELECT 'stg_partner_events', count(*), true FROM v_partner_events
UNION ALL SELECT 'fct_session_journey', count(*), true FROM fct_session
UNION ALL SELECT 'fct_search_journey', count(*), true FROM fct_search
UNION ALL SELECT 'mart_model_registry', CAST(NULL AS BIGINT), false"""))
def q_table_counts(c):
    v = c.views
    tables = {"stg_partners": v.partners, "stg_stations": v.stations, "stg_sessions": v.sessions,
              "stg_searches": v.searches, "stg_bookings": v.bookings, "stg_partner_events": v.partner_events,
              "fct_session_journey": c.session_fact, "fct_search_journey": c.search_fact}
    return quality.table_counts(tables, [*tables, "mart_model_registry"])


@register("in16_quality_snapshot", ids=("IN-16",), r6=("booked_session_share", "no_result_rate", "bookings_per_search"),
          sql=sql("""
SELECT a.experiment_variant, a.sessions, a.booked_session_share, g.distinct_searches, g.no_result_rate,
       b.distinct_bookings, u.active_partners, CAST(b.distinct_bookings AS DOUBLE) / g.distinct_searches AS bookings_per_search
FROM (SELECT s.experiment_variant, count(*) AS sessions,
             avg(CASE WHEN k.session_id IS NULL THEN 0.0 ELSE 1.0 END) AS booked_session_share
      FROM v_sessions s LEFT JOIN (SELECT DISTINCT session_id FROM v_bookings) k ON s.session_id = k.session_id
      GROUP BY s.experiment_variant) a
CROSS JOIN (SELECT count(DISTINCT search_id) AS distinct_searches,
                   avg(CAST(no_result_flag AS DOUBLE)) AS no_result_rate FROM v_searches) g
CROSS JOIN (SELECT count(DISTINCT booking_id) AS distinct_bookings FROM v_bookings) b
CROSS JOIN (SELECT count(DISTINCT partner_id) AS active_partners FROM v_sessions) u"""))
def q_quality_snapshot(c):
    v = c.views
    return quality.quality_snapshot(v.sessions, v.searches, v.bookings)


# ---------------------------------------------------------------- product marts

KPI_NAMES = ["sessions", "active_partners", "searches", "bookings", "session_booking_conversion",
             "search_to_book_conversion", "no_result_rate", "result_selection_rate", "booking_value",
             "successful_booking_value", "platform_revenue", "successful_booking_value_per_active_partner",
             "integration_completion_rate", "activation_30d_rate"]
KPI_CTE = f"""o_kf AS (
  SELECT CAST(count(*) AS DOUBLE) AS sessions, CAST(count(DISTINCT partner_id) AS DOUBLE) AS active_partners,
         CAST(sum(search_count) AS DOUBLE) AS searches, CAST(sum(booking_count) AS DOUBLE) AS bookings,
         CAST(sum(booked_flag) AS DOUBLE) AS booking_sessions, CAST(sum(zero_result_searches) AS DOUBLE) AS zero_results,
         CAST(sum(selected_searches) AS DOUBLE) AS selected, round(sum(booking_value), 2) AS booking_value,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue
  FROM fct_session),
o_ka AS (
  SELECT avg(CAST(integration_completed_flag AS DOUBLE)) AS integration_completion_rate,
         coalesce(avg(CASE WHEN activation_eligible_30d_flag = 1 THEN CAST(activated_30d_flag AS DOUBLE) END), 0)
           AS activation_30d_rate
  FROM o_activation),
o_kpi_row AS (
  SELECT sessions, active_partners, searches, bookings,
         {M.sd('booking_sessions', 'sessions')} AS session_booking_conversion,
         {M.sd('bookings', 'searches')} AS search_to_book_conversion,
         {M.sd('zero_results', 'searches')} AS no_result_rate,
         {M.sd('selected', 'searches')} AS result_selection_rate,
         booking_value, successful_booking_value, platform_revenue,
         {M.sd('successful_booking_value', 'active_partners')} AS successful_booking_value_per_active_partner,
         integration_completion_rate, activation_30d_rate
  FROM o_kf CROSS JOIN o_ka)"""
KPI_FINAL = "\nUNION ALL ".join(
    f"SELECT '{n}' AS metric, CAST({n} AS DOUBLE) AS value, CAST({i + 1} AS BIGINT) AS metric_order FROM o_kpi_row"
    for i, n in enumerate(KPI_NAMES))


@register("pm04_kpi_summary", ids=("PM-04",), r6=("value",),
          sql=sql(KPI_FINAL, M.MILESTONES, M.PIVOT, M.ACTIVATION, KPI_CTE))
def q_kpis(c):
    return metrics.kpi_summary(c.session_fact, c.activation)


@register("pm05_overview", ids=("PM-05",), r2=("successful_booking_value", "platform_revenue"),
          r6=("session_booking_conversion",), sql=sql("""
SELECT count(*) AS sessions, CAST(sum(search_count) AS BIGINT) AS searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
       avg(CAST(booked_flag AS DOUBLE)) AS session_booking_conversion,
       round(sum(successful_booking_value), 2) AS successful_booking_value,
       round(sum(platform_revenue), 2) AS platform_revenue, count(DISTINCT partner_id) AS active_partners
FROM fct_session"""))
def q_overview(c):
    return metrics.overview(c.session_fact)


@register("pm06_partner_performance", ids=("PM-06",), r2=MONEY, r6=PERF_R6,
          sql=sql("SELECT * FROM o_perf", M.PERFORMANCE))
def q_perf(c):
    return c.performance


@register("pm07_partner_weekly", ids=("PM-07",), r2=("successful_booking_value", "platform_revenue"),
          r6=("session_booking_conversion",), sql=sql("SELECT * FROM o_weekly", M.WEEKLY))
def q_weekly_partner(c):
    return c.weekly


@register("pm08_retention", ids=("PM-08",), r6=("retention_rate",), sql=sql("SELECT * FROM o_retention", M.RETENTION))
def q_retention(c):
    return c.retention


@register("pm09_route_performance", ids=("PM-09",), r2=MONEY,
          r6=("avg_search_latency_ms", "search_to_book_conversion", "no_result_rate"), sql=sql(f"""
SELECT origin_station_id, destination_station_id, count(search_id) AS searches,
       CAST(sum(booked_flag) AS BIGINT) AS booked_searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
       CAST(sum(no_result_flag) AS BIGINT) AS zero_result_searches, avg(search_latency_ms) AS avg_search_latency_ms,
       round(sum(booking_value), 2) AS booking_value, round(sum(successful_booking_value), 2) AS successful_booking_value,
       round(sum(platform_revenue), 2) AS platform_revenue,
       {M.sd('sum(booked_flag)', 'count(search_id)')} AS search_to_book_conversion,
       {M.sd('sum(no_result_flag)', 'count(search_id)')} AS no_result_rate
FROM fct_search GROUP BY origin_station_id, destination_station_id"""))
def q_routes(c):
    return c.routes


@register("pm10_funnel", ids=("PM-10",), r6=("conversion_from_previous", "conversion_from_search", "dropoff_from_previous"),
          sql=sql("SELECT * FROM o_funnel", M.FUNNEL))
def q_funnel(c):
    return metrics.funnel(c.search_fact)


SEG_R6 = ("session_booking_conversion", "search_to_book_conversion", "no_result_rate", "result_selection_rate")


@register("pm11_product_segments", ids=("PM-11",), r2=("successful_booking_value", "platform_revenue"), r6=SEG_R6,
          sql=sql("SELECT * FROM o_segments", M.SEGMENTS))
def q_segments(c):
    return metrics.product_segments(c.session_fact)


RET_R6 = ("month_0_retention", "month_1_retention", "month_2_retention", "month_3_retention")


@register("pm12_retention_summary", ids=("PM-12",), r6=RET_R6,
          sql=sql("SELECT * FROM o_ret_summary", M.RETENTION, M.RETENTION_SUMMARY))
def q_retention_summary(c):
    return metrics.retention_summary(c.retention)


@register("pm13_retention_long", ids=("PM-13",), r6=("retention_rate",), sql=sql("""
SELECT cohort_month, retention_month, retention_rate FROM (
  SELECT cohort_month, 'month_0_retention' AS retention_month, month_0_retention AS retention_rate FROM o_ret_summary
  UNION ALL SELECT cohort_month, 'month_1_retention', month_1_retention FROM o_ret_summary
  UNION ALL SELECT cohort_month, 'month_2_retention', month_2_retention FROM o_ret_summary
  UNION ALL SELECT cohort_month, 'month_3_retention', month_3_retention FROM o_ret_summary) AS u
WHERE retention_rate IS NOT NULL""", M.RETENTION, M.RETENTION_SUMMARY))
def q_retention_long(c):
    return metrics.retention_long(metrics.retention_summary(c.retention))


# ---------------------------------------------------------------- activation and growth

@register("pg01_milestones", ids=("PG-01",), sql=sql("SELECT * FROM o_milestones", M.MILESTONES))
def q_milestones(c):
    return c.milestones


@register("pg02_milestone_pivot", ids=("PG-02",), sql=sql("SELECT * FROM o_pivot", M.MILESTONES, M.PIVOT))
def q_pivot(c):
    return growth.pivot_milestones(c.milestones)


@register("pg04_partner_activation", ids=("PG-03", "PG-04"),
          sql=sql("SELECT * FROM o_activation", M.MILESTONES, M.PIVOT, M.ACTIVATION))
def q_activation(c):
    return c.activation


@register("pg05_activation_segments", ids=("PG-05",),
          r6=("integration_completion_rate", "first_search_rate", "first_booking_rate", "activation_30d_rate",
              "median_days_to_first_booking"),
          sql=sql("SELECT * FROM o_act_segments", M.MILESTONES, M.PIVOT, M.ACTIVATION, M.ACT_SEGMENTS))
def q_activation_segments(c):
    return growth.activation_segments(c.activation)


@register("pg06_partner_growth", ids=("PG-06",), r2=GROWTH_R2, r6=GROWTH_R6,
          sql=sql("SELECT * FROM o_growth", M.PERFORMANCE, M.WEEKLY, M.GROWTH))
def q_growth(c):
    return c.growth


@register("pg07_zscore", ids=("PG-07",), r6=("z_searches", "z_successful_booking_value"), sql=sql("""
SELECT partner_id, searches, successful_booking_value, z0 AS z_searches, z1 AS z_successful_booking_value
FROM o_pz_z""", M.PERFORMANCE, M.zscores("o_perf", ["searches", "successful_booking_value"], "o_pz")),
          r2=("successful_booking_value",))
def q_zscore(c):
    return zscore(c.performance.select("partner_id", "searches", "successful_booking_value"),
                  ["searches", "successful_booking_value"])


@register("pg10_partner_opportunities", ids=("PG-08", "PG-09", "PG-10"), r2=GROWTH_R2,
          r6=GROWTH_R6 + ("opportunity_score",),
          sql=sql("SELECT * FROM o_opps", M.PERFORMANCE, M.WEEKLY, M.GROWTH, M.OPPORTUNITIES))
def q_opportunities(c):
    return c.opportunities


@register("pg11_stage3_findings", ids=("PG-11",),
          r6=("largest_drop_rate", "weakest_activation_rate", "weakest_product_conversion", "best_month1_retention"),
          sql=sql("""
SELECT d.stage AS largest_drop_stage, d.dropoff_from_previous AS largest_drop_rate,
       a.segment_value AS weakest_activation_segment, a.activation_30d_rate AS weakest_activation_rate,
       a.partners AS weakest_activation_partners, s.dimension AS weakest_product_dimension,
       s.segment_value AS weakest_product_segment, s.session_booking_conversion AS weakest_product_conversion,
       o.partner_id AS top_partner_id, o.opportunity_type AS top_partner_opportunity_type,
       r.cohort_month AS best_month1_cohort, r.month_1_retention AS best_month1_retention
FROM (SELECT * FROM o_funnel WHERE stage_order > 1 ORDER BY dropoff_from_previous DESC, stage_order LIMIT 1) d
CROSS JOIN (SELECT * FROM o_act_segments WHERE dimension = 'integration_type'
            ORDER BY activation_30d_rate, segment_value LIMIT 1) a
CROSS JOIN (SELECT * FROM o_segments
            WHERE sessions >= (SELECT greatest(25, CAST(floor(quantile_cont(sessions, 0.5)) AS BIGINT)) FROM o_segments)
            ORDER BY session_booking_conversion, dimension, segment_value LIMIT 1) s
CROSS JOIN (SELECT * FROM o_opps WHERE priority_rank = 1) o
CROSS JOIN (SELECT * FROM o_ret_summary WHERE month_1_retention IS NOT NULL
            ORDER BY month_1_retention DESC, cohort_month LIMIT 1) r""",
              M.FUNNEL, M.MILESTONES, M.PIVOT, M.ACTIVATION, M.ACT_SEGMENTS, M.SEGMENTS, M.PERFORMANCE,
              M.WEEKLY, M.GROWTH, M.OPPORTUNITIES, M.RETENTION, M.RETENTION_SUMMARY))
def q_findings(c):
    return growth.stage3_findings(metrics.funnel(c.search_fact), growth.activation_segments(c.activation),
                                  metrics.product_segments(c.session_fact), c.opportunities,
                                  metrics.retention_summary(c.retention))
