"""DuckDB restatement of the domain views and the two facts.

Same mapping as ``kestrel.sources.views`` (see its docstring), written as
CTEs so each oracle query in the registry is self-contained over the
driver's pre-registered test tables.  Used only for verification.
"""

PRELUDE = """
WITH
nr AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
v_partners AS (
  SELECT c.c_custkey AS partner_id, c.c_mktsegment AS partner_type, nr.n_name AS country,
         nr.r_name AS integration_type,
         CASE WHEN c.c_acctbal < 2000 THEN 'Growth' WHEN c.c_acctbal < 6000 THEN 'Scale'
              ELSE 'Enterprise' END AS contract_tier,
         CAST(date_trunc('month', fo.first_ts) AS TIMESTAMP) AS launch_date,
         nr.r_name AS account_manager_region, c.c_acctbal AS traffic_weight
  FROM customer c
  LEFT JOIN nr ON c.c_nationkey = nr.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_ts FROM orders GROUP BY o_custkey) fo
    ON c.c_custkey = fo.o_custkey),
v_stations AS (
  SELECT CAST(n_nationkey AS BIGINT) AS station_id, n_name AS station_name, n_name AS city,
         r_name AS country, CAST(-48 + 4 * n_nationkey AS DOUBLE) AS latitude,
         CAST(-150 + 12 * n_nationkey AS DOUBLE) AS longitude, CAST(1 AS DOUBLE) AS hub_weight
  FROM nr),
v_sessions AS (
  SELECT o_orderkey AS session_id, o_custkey AS partner_id, o_orderdate AS session_ts,
         o_orderpriority AS device_type,
         'channel_' || CAST(o_orderkey % 4 AS VARCHAR) AS acquisition_channel,
         (o_orderkey % 3 <> 0) AS is_logged_in, o_orderstatus AS traveller_type,
         CASE WHEN year(o_orderdate) = 1998 THEN 'checkout_test' ELSE 'not_eligible' END AS experiment_name,
         CASE WHEN year(o_orderdate) = 1998 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'control' ELSE 'variant' END
              ELSE 'not_eligible' END AS experiment_variant
  FROM orders),
v_raw AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, c.c_nationkey, s.s_nationkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
v_search_raw AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS search_id,
         l_orderkey AS session_id, o_custkey AS partner_id, l_shipdate AS search_ts,
         CAST(s_nationkey AS BIGINT) AS origin_station_id,
         CAST(c_nationkey AS BIGINT) AS destination_station_id,
         CASE WHEN l_linenumber % 2 = 0 THEN 'Return' ELSE 'Single' END AS journey_type,
         CAST(l_linenumber AS BIGINT) AS passengers,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) AS days_before_travel,
         CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_partkey % 25 + 1 END AS BIGINT) AS result_count,
         CAST(l_returnflag = 'R' AS BIGINT) AS no_result_flag,
         CAST(l_quantity AS BIGINT) AS search_latency_ms,
         CAST(l_suppkey % 4 AS BIGINT) AS alternatives_shown,
         CAST(l_returnflag <> 'R' AND l_linestatus = 'O' AS BIGINT) AS selected_flag,
         CASE WHEN year(o_orderdate) = 1998 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'control' ELSE 'variant' END
              ELSE 'not_eligible' END AS experiment_variant,
         l_returnflag, l_linestatus, l_extendedprice, l_discount, l_tax
  FROM v_raw),
v_searches AS (
  SELECT search_id, session_id, partner_id, search_ts, origin_station_id, destination_station_id,
         journey_type, passengers, days_before_travel, result_count, no_result_flag,
         search_latency_ms, alternatives_shown, selected_flag, experiment_variant
  FROM v_search_raw),
v_bookings AS (
  SELECT search_id AS booking_id, search_id, session_id, partner_id, search_ts AS booking_ts,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS booking_value,
         CAST(round(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                    * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS platform_revenue,
         CAST(l_tax >= 0.07 AS BIGINT) AS cancelled_flag,
         CAST(l_tax >= 0.07 AND l_discount >= 0.05 AS BIGINT) AS refund_flag,
         experiment_variant
  FROM v_search_raw WHERE l_returnflag = 'N' AND l_linestatus = 'O'),
v_partner_events AS (
  SELECT user_id AS partner_id, ts AS event_ts,
         CASE event_type WHEN 'signup' THEN 'contract_signed' WHEN 'view' THEN 'api_key_created'
              WHEN 'click' THEN 'integration_test' WHEN 'error' THEN 'webhook_configured'
              ELSE event_type END AS event_type
  FROM events),
v_bk AS (
  SELECT *, CASE WHEN cancelled_flag = 0 AND refund_flag = 0 THEN booking_value ELSE CAST(0 AS DOUBLE) END
            AS successful_booking_value
  FROM v_bookings),
v_bk_by_search AS (
  SELECT search_id, count(booking_id) AS booking_count, round(sum(booking_value), 2) AS booking_value,
         round(sum(successful_booking_value), 2) AS successful_booking_value, round(sum(platform_revenue), 2) AS platform_revenue,
         CAST(sum(cancelled_flag) AS BIGINT) AS cancellations, CAST(sum(refund_flag) AS BIGINT) AS refunds
  FROM v_bk GROUP BY search_id),
v_bk_by_session AS (
  SELECT session_id, count(booking_id) AS booking_count, round(sum(booking_value), 2) AS booking_value,
         round(sum(successful_booking_value), 2) AS successful_booking_value, round(sum(platform_revenue), 2) AS platform_revenue,
         CAST(sum(cancelled_flag) AS BIGINT) AS cancellations, CAST(sum(refund_flag) AS BIGINT) AS refunds
  FROM v_bk GROUP BY session_id),
v_se_by_session AS (
  SELECT session_id, count(search_id) AS search_count,
         CAST(sum(no_result_flag) AS BIGINT) AS zero_result_searches,
         CAST(sum(selected_flag) AS BIGINT) AS selected_searches,
         CAST(sum(alternatives_shown) AS BIGINT) AS alternatives_shown_count,
         CAST(sum(search_latency_ms) AS BIGINT) AS total_search_latency_ms,
         avg(search_latency_ms) AS avg_search_latency_ms
  FROM v_searches GROUP BY session_id),
fct_search AS (
  SELECT s.*, ses.device_type, ses.acquisition_channel, ses.is_logged_in, ses.traveller_type,
         coalesce(b.booking_count, 0) AS booking_count,
         coalesce(b.booking_value, CAST(0 AS DOUBLE)) AS booking_value,
         coalesce(b.successful_booking_value, CAST(0 AS DOUBLE)) AS successful_booking_value,
         coalesce(b.platform_revenue, CAST(0 AS DOUBLE)) AS platform_revenue,
         coalesce(b.cancellations, 0) AS cancellations, coalesce(b.refunds, 0) AS refunds,
         CAST(coalesce(b.booking_count, 0) > 0 AS BIGINT) AS booked_flag,
         CAST(s.search_ts AS DATE) AS search_date,
         CAST(date_trunc('week', s.search_ts) AS DATE) AS search_week,
         CAST(date_trunc('month', s.search_ts) AS DATE) AS search_month
  FROM v_searches s
  LEFT JOIN v_sessions ses ON s.session_id = ses.session_id AND s.partner_id = ses.partner_id
  LEFT JOIN v_bk_by_search b ON s.search_id = b.search_id),
fct_session AS (
  SELECT s.*,
         coalesce(q.search_count, 0) AS search_count,
         coalesce(q.zero_result_searches, 0) AS zero_result_searches,
         coalesce(q.selected_searches, 0) AS selected_searches,
         coalesce(q.alternatives_shown_count, 0) AS alternatives_shown_count,
         coalesce(q.total_search_latency_ms, 0) AS total_search_latency_ms,
         coalesce(q.avg_search_latency_ms, CAST(0 AS DOUBLE)) AS avg_search_latency_ms,
         coalesce(b.booking_count, 0) AS booking_count,
         coalesce(b.booking_value, CAST(0 AS DOUBLE)) AS booking_value,
         coalesce(b.successful_booking_value, CAST(0 AS DOUBLE)) AS successful_booking_value,
         coalesce(b.platform_revenue, CAST(0 AS DOUBLE)) AS platform_revenue,
         coalesce(b.cancellations, 0) AS cancellations, coalesce(b.refunds, 0) AS refunds,
         CAST(coalesce(b.booking_count, 0) > 0 AS BIGINT) AS booked_flag,
         CAST(s.session_ts AS DATE) AS session_date,
         CAST(date_trunc('week', s.session_ts) AS DATE) AS session_week,
         CAST(date_trunc('month', s.session_ts) AS DATE) AS session_month
  FROM v_sessions s
  LEFT JOIN v_se_by_session q ON s.session_id = q.session_id
  LEFT JOIN v_bk_by_session b ON s.session_id = b.session_id)
"""


def with_prelude(*ctes: str) -> str:
    """PRELUDE plus extra ``name AS (...)`` CTEs, ready for a final SELECT."""
    extra = "".join(f",\n{c}" for c in ctes)
    return PRELUDE + extra + "\n"
