"""DuckDB CTEs for the marts (activation, performance, weekly, retention, growth)."""


def sd(n: str, d: str) -> str:
    """Oracle form of safe_div: 0 when the denominator is 0 or NULL."""
    return f"coalesce(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0), 0)"


MILESTONES = """o_milestones AS (
  SELECT partner_id, event_ts, event_type FROM v_partner_events
  UNION ALL SELECT partner_id, min(search_ts), 'first_search' FROM v_searches GROUP BY partner_id
  UNION ALL SELECT partner_id, min(booking_ts), 'first_booking' FROM v_bookings GROUP BY partner_id)"""

PIVOT = """o_pivot AS (
  SELECT partner_id,
         min(CASE WHEN event_type = 'contract_signed' THEN event_ts END) AS contract_signed,
         min(CASE WHEN event_type = 'api_key_created' THEN event_ts END) AS api_key_created_ts,
         min(CASE WHEN event_type = 'integration_test' THEN event_ts END) AS integration_test_ts,
         min(CASE WHEN event_type = 'webhook_configured' THEN event_ts END) AS webhook_configured_ts,
         min(CASE WHEN event_type = 'first_search' THEN event_ts END) AS first_search_ts,
         min(CASE WHEN event_type = 'first_booking' THEN event_ts END) AS first_booking_ts
  FROM o_milestones GROUP BY partner_id)"""

ACTIVATION = """o_act0 AS (
  SELECT p.*, e.contract_signed, e.api_key_created_ts, e.integration_test_ts, e.webhook_configured_ts,
         e.first_search_ts, e.first_booking_ts,
         CAST(e.integration_test_ts IS NOT NULL AS BIGINT) AS integration_completed_flag,
         CAST(e.first_search_ts IS NOT NULL AS BIGINT) AS first_search_flag,
         CAST(e.first_booking_ts IS NOT NULL AS BIGINT) AS first_booking_flag,
         CAST(date_diff('day', CAST(p.launch_date AS DATE), CAST(e.first_booking_ts AS DATE)) AS BIGINT)
           AS days_to_first_booking,
         CAST(coalesce(p.launch_date <= TIMESTAMP '2001-08-01 23:59:59' - INTERVAL 30 DAY, false) AS BIGINT)
           AS activation_eligible_30d_flag
  FROM v_partners p LEFT JOIN o_pivot e ON p.partner_id = e.partner_id),
o_activation AS (
  SELECT *, CAST(activation_eligible_30d_flag = 1 AND coalesce(days_to_first_booking BETWEEN 0 AND 30, false)
                 AS BIGINT) AS activated_30d_flag
  FROM o_act0)"""

PERFORMANCE = f"""o_perf_agg AS (
  SELECT partner_id, count(session_id) AS sessions, CAST(sum(search_count) AS BIGINT) AS searches,
         CAST(sum(booking_count) AS BIGINT) AS bookings, CAST(sum(booked_flag) AS BIGINT) AS booking_sessions,
         CAST(sum(zero_result_searches) AS BIGINT) AS zero_result_searches,
         CAST(sum(alternatives_shown_count) AS BIGINT) AS alternatives_shown,
         CAST(sum(total_search_latency_ms) AS BIGINT) AS total_search_latency_ms,
         round(sum(booking_value), 2) AS booking_value,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue,
         CAST(sum(cancellations) AS BIGINT) AS cancellations, CAST(sum(refunds) AS BIGINT) AS refunds
  FROM fct_session GROUP BY partner_id),
o_perf0 AS (
  SELECT p.partner_id, p.partner_type, p.country, p.integration_type, p.contract_tier,
         coalesce(a.sessions, 0) AS sessions, coalesce(a.searches, 0) AS searches,
         coalesce(a.bookings, 0) AS bookings, coalesce(a.booking_sessions, 0) AS booking_sessions,
         coalesce(a.zero_result_searches, 0) AS zero_result_searches,
         coalesce(a.alternatives_shown, 0) AS alternatives_shown,
         coalesce(a.total_search_latency_ms, 0) AS total_search_latency_ms,
         coalesce(a.booking_value, CAST(0 AS DOUBLE)) AS booking_value,
         coalesce(a.successful_booking_value, CAST(0 AS DOUBLE)) AS successful_booking_value,
         coalesce(a.platform_revenue, CAST(0 AS DOUBLE)) AS platform_revenue,
         coalesce(a.cancellations, 0) AS cancellations, coalesce(a.refunds, 0) AS refunds
  FROM v_partners p LEFT JOIN o_perf_agg a ON p.partner_id = a.partner_id),
o_perf AS (
  SELECT *, {sd('booking_sessions', 'sessions')} AS session_booking_conversion,
         {sd('zero_result_searches', 'searches')} AS no_result_rate,
         {sd('alternatives_shown', 'searches')} AS alternatives_exposure_rate,
         {sd('total_search_latency_ms', 'searches')} AS avg_search_latency_ms
  FROM o_perf0)"""

WEEKLY = f"""o_weekly AS (
  SELECT partner_id, session_week, count(session_id) AS sessions, CAST(sum(search_count) AS BIGINT) AS searches,
         CAST(sum(booking_count) AS BIGINT) AS bookings, CAST(sum(booked_flag) AS BIGINT) AS booking_sessions,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue,
         {sd('sum(booked_flag)', 'count(session_id)')} AS session_booking_conversion
  FROM fct_session GROUP BY partner_id, session_week)"""

RETENTION = f"""o_ract AS (SELECT DISTINCT partner_id, session_month FROM fct_session),
o_rfirst AS (SELECT partner_id, min(session_month) AS cohort_month FROM o_ract GROUP BY partner_id),
o_retention AS (
  SELECT a.cohort_month, a.month_index, a.active_partners, s.cohort_size,
         {sd('a.active_partners', 's.cohort_size')} AS retention_rate
  FROM (SELECT f.cohort_month,
               CAST((year(x.session_month) - year(f.cohort_month)) * 12 + month(x.session_month)
                    - month(f.cohort_month) AS BIGINT) AS month_index,
               count(x.partner_id) AS active_partners
        FROM o_ract x JOIN o_rfirst f ON x.partner_id = f.partner_id GROUP BY 1, 2) a
  JOIN (SELECT cohort_month, count(partner_id) AS cohort_size FROM o_rfirst GROUP BY 1) s
    ON a.cohort_month = s.cohort_month)"""

RETENTION_SUMMARY = """o_ret_summary AS (
  SELECT cohort_month,
         max(CASE WHEN month_index = 0 THEN retention_rate END) AS month_0_retention,
         max(CASE WHEN month_index = 1 THEN retention_rate END) AS month_1_retention,
         max(CASE WHEN month_index = 2 THEN retention_rate END) AS month_2_retention,
         max(CASE WHEN month_index = 3 THEN retention_rate END) AS month_3_retention
  FROM o_retention GROUP BY cohort_month)"""


def _window_sums(prefix: str, lo: str, hi: str) -> str:
    cols = [("sessions", "sessions", False), ("searches", "searches", False), ("bookings", "bookings", False),
            ("booking_sessions", "booking_sessions", False),
            ("successful_value", "successful_booking_value", True), ("platform_revenue", "platform_revenue", True)]
    out = []
    for name, src, money in cols:
        cond = f"CASE WHEN session_week BETWEEN {lo} AND {hi} THEN {src} END"
        expr = f"round(sum({cond}), 2)" if money else f"CAST(sum({cond}) AS BIGINT)"
        out.append(f"{expr} AS {prefix}_{name}")
    return ",\n         ".join(out)


def _fill(prefix: str) -> str:
    cols = ["sessions", "searches", "bookings", "booking_sessions"]
    money = ["successful_value", "platform_revenue"]
    return ", ".join([f"coalesce(r.{prefix}_{c}, 0) AS {prefix}_{c}" for c in cols]
                     + [f"coalesce(r.{prefix}_{c}, CAST(0 AS DOUBLE)) AS {prefix}_{c}" for c in money])


GROWTH = f"""o_anchor AS (
  SELECT max(session_week) AS recent_window_end, max(session_week) - 21 AS recent_window_start,
         max(session_week) - 22 AS prior_window_end, max(session_week) - 43 AS prior_window_start
  FROM o_weekly),
o_roll AS (
  SELECT w.partner_id,
         {_window_sums('recent_4w', 'recent_window_start', 'recent_window_end')},
         {_window_sums('prior_4w', 'prior_window_start', 'prior_window_end')}
  FROM o_weekly w CROSS JOIN o_anchor GROUP BY w.partner_id),
o_growth0 AS (
  SELECT p.*, {_fill('recent_4w')}, {_fill('prior_4w')}, a.*
  FROM o_perf p LEFT JOIN o_roll r ON p.partner_id = r.partner_id CROSS JOIN o_anchor a),
o_growth1 AS (
  SELECT *, {sd('recent_4w_booking_sessions', 'recent_4w_sessions')} AS recent_4w_conversion,
         {sd('prior_4w_booking_sessions', 'prior_4w_sessions')} AS prior_4w_conversion
  FROM o_growth0),
o_growth AS (
  SELECT *, recent_4w_conversion - prior_4w_conversion AS conversion_change_pp,
         CAST(CASE WHEN prior_4w_successful_value > 0
                   THEN recent_4w_successful_value / prior_4w_successful_value - 1
                   WHEN recent_4w_successful_value > 0 THEN 1 ELSE 0 END AS DOUBLE) AS successful_value_growth_rate
  FROM o_growth1)"""


def zscores(src: str, comps: list[str], name: str) -> str:
    """CTEs ``{name}_c`` (components c0..) and ``{name}_z`` (z0.. added)."""
    cs = ", ".join(f"CAST({e} AS DOUBLE) AS c{i}" for i, e in enumerate(comps))
    st = ", ".join(f"avg(c{i}) AS m{i}, stddev_pop(c{i}) AS s{i}" for i in range(len(comps)))
    zs = ", ".join(f"CASE WHEN s{i} IS NULL OR s{i} = 0 THEN CAST(0 AS DOUBLE) ELSE (c{i} - m{i}) / s{i} END AS z{i}"
                   for i in range(len(comps)))
    return (f"{name}_c AS (SELECT *, {cs} FROM {src}),\n"
            f"{name}_s AS (SELECT {st} FROM {name}_c),\n"
            f"{name}_z AS (SELECT {name}_c.*, {zs} FROM {name}_c CROSS JOIN {name}_s)")


def weighted(weights: list[float]) -> str:
    return " + ".join(f"{w} * z{i}" for i, w in enumerate(weights))


OPPORTUNITIES = """o_ostats AS (
  SELECT quantile_cont(session_booking_conversion, 0.5) AS conv_med,
         quantile_cont(no_result_rate, 0.5) AS nr_med, quantile_cont(no_result_rate, 0.75) AS nr_p75,
         quantile_cont(searches, 0.5) AS search_med
  FROM o_growth),
o_og AS (SELECT * FROM o_growth CROSS JOIN o_ostats),
""" + zscores("o_og", [
    "ln(1 + searches)", "ln(1 + successful_booking_value)",
    "greatest(conv_med - session_booking_conversion, 0)",
    "greatest(no_result_rate - nr_med, 0)", "greatest(-conversion_change_pp, 0)"], "o_oz") + """,
o_opps0 AS (
  SELECT *, """ + weighted([0.30, 0.20, 0.22, 0.18, 0.10]) + """ AS opportunity_score,
         CASE WHEN searches >= search_med AND session_booking_conversion < conv_med
                THEN 'High-volume conversion opportunity'
              WHEN no_result_rate > nr_p75 THEN 'Search-result availability opportunity'
              WHEN conversion_change_pp < 0 THEN 'Recent conversion deterioration'
              WHEN successful_value_growth_rate > 0.20 THEN 'Growth / expansion candidate'
              ELSE 'Monitor' END AS opportunity_type
  FROM o_oz_z),
o_opps AS (
  SELECT * EXCLUDE (conv_med, nr_med, nr_p75, search_med, c0, c1, c2, c3, c4, z0, z1, z2, z3, z4),
         row_number() OVER (ORDER BY opportunity_score DESC, partner_id) AS priority_rank
  FROM o_opps0)"""

FUNNEL = f"""o_fc AS (
  SELECT CAST(count(*) AS DOUBLE) AS s1,
         CAST(sum(CASE WHEN no_result_flag = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS s2,
         CAST(sum(selected_flag) AS DOUBLE) AS s3, CAST(sum(booked_flag) AS DOUBLE) AS s4
  FROM fct_search),
o_funnel AS (
  SELECT 'Searches' AS stage, CAST(1 AS BIGINT) AS stage_order, s1 AS count,
         CAST(1 AS DOUBLE) AS conversion_from_previous, CAST(1 AS DOUBLE) AS conversion_from_search,
         CAST(0 AS DOUBLE) AS dropoff_from_previous FROM o_fc
  UNION ALL SELECT 'Results returned', 2, s2, {sd('s2', 's1')}, {sd('s2', 's1')}, 1 - {sd('s2', 's1')} FROM o_fc
  UNION ALL SELECT 'Journey selected', 3, s3, {sd('s3', 's2')}, {sd('s3', 's1')}, 1 - {sd('s3', 's2')} FROM o_fc
  UNION ALL SELECT 'Booked', 4, s4, {sd('s4', 's3')}, {sd('s4', 's1')}, 1 - {sd('s4', 's3')} FROM o_fc)"""


def _segment(dims: list[str]) -> str:
    label = " x ".join(dims)
    value = " || ' | ' || ".join(f"CAST({d} AS VARCHAR)" for d in dims)
    return f"""SELECT '{label}' AS dimension, {value} AS segment_value, count(session_id) AS sessions,
         count(DISTINCT partner_id) AS partners, CAST(sum(search_count) AS BIGINT) AS searches,
         CAST(sum(booking_count) AS BIGINT) AS bookings,
         {sd('sum(booked_flag)', 'count(session_id)')} AS session_booking_conversion,
         {sd('sum(booking_count)', 'sum(search_count)')} AS search_to_book_conversion,
         {sd('sum(zero_result_searches)', 'sum(search_count)')} AS no_result_rate,
         {sd('sum(selected_searches)', 'sum(search_count)')} AS result_selection_rate,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue
  FROM fct_session WHERE {' AND '.join(f'{d} IS NOT NULL' for d in dims)} GROUP BY {', '.join(dims)}"""


SEGMENTS = "o_segments AS (\n  " + "\n  UNION ALL ".join(
    _segment(d) for d in [["device_type"], ["traveller_type"], ["acquisition_channel"],
                          ["device_type", "traveller_type"]]) + ")"


def _act_segment(dim: str) -> str:
    return f"""SELECT '{dim}' AS dimension, CAST({dim} AS VARCHAR) AS segment_value,
         count(DISTINCT partner_id) AS partners,
         avg(CAST(integration_completed_flag AS DOUBLE)) AS integration_completion_rate,
         avg(CAST(first_search_flag AS DOUBLE)) AS first_search_rate,
         avg(CAST(first_booking_flag AS DOUBLE)) AS first_booking_rate,
         avg(CAST(activated_30d_flag AS DOUBLE)) AS activation_30d_rate,
         quantile_cont(CAST(days_to_first_booking AS DOUBLE), 0.5) AS median_days_to_first_booking
  FROM o_activation WHERE activation_eligible_30d_flag = 1 AND {dim} IS NOT NULL GROUP BY {dim}"""


ACT_SEGMENTS = "o_act_segments AS (\n  " + "\n  UNION ALL ".join(
    _act_segment(d) for d in ["partner_type", "country", "integration_type", "contract_tier"]) + ")"


ROUTES = f"""o_routes AS (
  SELECT origin_station_id, destination_station_id, count(search_id) AS searches,
         CAST(sum(booked_flag) AS BIGINT) AS booked_searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
         CAST(sum(no_result_flag) AS BIGINT) AS zero_result_searches, avg(search_latency_ms) AS avg_search_latency_ms,
         round(sum(booking_value), 2) AS booking_value, round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue,
         {sd('sum(booked_flag)', 'count(search_id)')} AS search_to_book_conversion,
         {sd('sum(no_result_flag)', 'count(search_id)')} AS no_result_rate
  FROM fct_search GROUP BY origin_station_id, destination_station_id)"""
