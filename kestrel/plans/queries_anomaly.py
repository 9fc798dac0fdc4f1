"""Registered queries: anomaly triage and evidence cases (AN-01..AN-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import paths
from kestrel.operators import anomaly as A
from kestrel.plans.queries_core import sql
from kestrel.plans.queries_marts import DAILY
from kestrel.plans.registry import register

W = "(PARTITION BY metric ORDER BY metric_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)"
LONG = "a_long AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT metric_date, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, '{d}' AS adverse_direction FROM o_daily"
    for m, d in A.METRIC_RULES.items()) + ")"
SCORES = LONG + f""",
a_s1 AS (SELECT *, CASE WHEN count(value) OVER {W} >= 14 THEN quantile_cont(value, 0.5) OVER {W} END AS baseline_median
         FROM a_long),
a_s2 AS (SELECT *, abs(value - baseline_median) AS dev FROM a_s1),
a_s3 AS (SELECT *, CASE WHEN count(dev) OVER {W} >= 14 THEN quantile_cont(dev, 0.5) OVER {W} END AS rolling_mad,
                stddev_pop(value) OVER (PARTITION BY metric) AS fb
         FROM a_s2),
a_s4 AS (SELECT metric_date, metric, value, adverse_direction, baseline_median, rolling_mad,
                coalesce(nullif(1.4826 * rolling_mad, 0),
                         CASE WHEN fb IS NULL OR isnan(fb) OR fb = 0 THEN 1e-6 ELSE fb END) AS scale
         FROM a_s3),
a_scores AS (SELECT *, (value - baseline_median) / scale AS robust_z FROM a_s4)"""
ANOMS = SCORES + """,
a_det AS (
  SELECT metric_date, metric, adverse_direction, value AS observed_value, baseline_median,
         value - baseline_median AS absolute_delta,
         CASE WHEN baseline_median <> 0 THEN (value - baseline_median) / baseline_median ELSE CAST(0 AS DOUBLE) END
           AS relative_delta,
         robust_z,
         CASE WHEN abs(robust_z) >= 7 THEN 'critical' WHEN abs(robust_z) >= 5 THEN 'high' ELSE 'medium' END AS severity
  FROM a_scores
  WHERE robust_z IS NOT NULL AND baseline_median IS NOT NULL AND value IS NOT NULL
    AND ((adverse_direction = 'high' AND robust_z >= 3.5) OR (adverse_direction = 'low' AND robust_z <= -3.5))),
a_anoms AS (
  SELECT *, 'CASE-' || strftime(metric_date, '%Y%m%d') || '-' || printf('%03d', CAST(row_number() OVER (
           ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END, metric_date, metric)
           AS BIGINT)) AS case_id
  FROM a_det)"""

SUMS = """count(*) AS sessions, sum(booked_flag) AS booked, sum(search_count) AS searches,
         sum(booking_count) AS bookings, sum(zero_result_searches) AS zero_results,
         sum(total_search_latency_ms) AS latency, sum(cancellations) AS cancellations, sum(refunds) AS refunds,
         round(sum(successful_booking_value), 2) AS value"""


def _mv(p):
    def r(n, d):
        return f"CASE WHEN {p}{d} <> 0 THEN CAST({p}{n} AS DOUBLE) / {p}{d} END"
    return (f"CASE metric WHEN 'session_booking_conversion' THEN {r('booked', 'sessions')}"
            f" WHEN 'search_to_book_conversion' THEN {r('bookings', 'searches')}"
            f" WHEN 'no_result_rate' THEN {r('zero_results', 'searches')}"
            f" WHEN 'avg_search_latency_ms' THEN {r('latency', 'searches')}"
            f" WHEN 'cancellation_rate' THEN {r('cancellations', 'bookings')}"
            f" WHEN 'refund_rate' THEN {r('refunds', 'bookings')}"
            f" WHEN 'successful_booking_value_per_active_partner' THEN {r('value', 'partners')} END")


def _side(cond, p):
    cols = ["sessions", "booked", "searches", "bookings", "zero_results", "latency", "cancellations", "refunds"]
    out = [f"CAST(sum({c}) FILTER (WHERE {cond}) AS BIGINT) AS {p}{c}" for c in cols]
    out.append(f"round(sum(value) FILTER (WHERE {cond}), 2) AS {p}value")
    out.append(f"count(DISTINCT partner_id) FILTER (WHERE {cond}) AS {p}partners")
    return ", ".join(out)


DIM_LONG = "\n    UNION ALL ".join(
    f"SELECT session_date, partner_id, booked_flag, search_count, booking_count, zero_result_searches, "
    f"total_search_latency_ms, cancellations, refunds, successful_booking_value, '{d}' AS dimension, "
    f"CAST({d} AS VARCHAR) AS segment FROM fct_session" for d in A.DRIVER_DIMENSIONS)

DRIVER = ANOMS + f""",
a_pre AS (
  SELECT session_date, dimension, segment, partner_id, {SUMS}
  FROM ({DIM_LONG}) AS l WHERE segment IS NOT NULL GROUP BY session_date, dimension, segment, partner_id),
a_j AS (
  SELECT a.case_id, a.metric, a.adverse_direction, p.*, p.session_date = a.metric_date AS cur
  FROM a_anoms a JOIN a_pre p ON p.session_date BETWEEN a.metric_date - 28 AND a.metric_date),
a_seg0 AS (
  SELECT case_id, metric, adverse_direction, dimension, segment, {_side('cur', 'cur_')}, {_side('NOT cur', 'base_')}
  FROM a_j GROUP BY case_id, metric, adverse_direction, dimension, segment),
a_seg1 AS (
  SELECT *, {_mv('cur_')} AS current_value, {_mv('base_')} AS baseline_value
  FROM a_seg0 WHERE coalesce(cur_sessions, 0) >= 5 AND coalesce(base_sessions, 0) >= 20),
a_seg2 AS (
  SELECT *, CASE WHEN adverse_direction = 'high' THEN current_value - baseline_value
                 ELSE baseline_value - current_value END AS adverse_gap
  FROM a_seg1),
a_best AS (
  SELECT case_id, dimension, segment, current_value, baseline_value, adverse_gap,
         cur_sessions AS current_sessions, base_sessions AS baseline_sessions
  FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY adverse_gap DESC,
          CASE dimension {' '.join(f"WHEN '{d}' THEN {i + 1}" for i, d in enumerate(A.DRIVER_DIMENSIONS))} END,
          segment) AS rn
        FROM a_seg2 WHERE adverse_gap IS NOT NULL AND NOT isnan(adverse_gap)) AS r WHERE rn = 1),
a_has AS (
  SELECT DISTINCT a.case_id FROM a_anoms a
  JOIN (SELECT DISTINCT session_date FROM fct_session) f ON f.session_date BETWEEN a.metric_date - 28 AND a.metric_date),
a_driver AS (
  SELECT a.case_id, coalesce(b.dimension, 'none') AS dimension,
         CASE WHEN b.dimension IS NOT NULL THEN b.segment WHEN h.case_id IS NULL THEN 'no_data'
              ELSE 'insufficient_segment_data' END AS segment,
         b.current_value, b.baseline_value, b.adverse_gap, b.current_sessions, b.baseline_sessions
  FROM a_anoms a LEFT JOIN a_best b ON a.case_id = b.case_id LEFT JOIN a_has h ON a.case_id = h.case_id)"""


def _lookup_sql():
    owner = " ".join(f"WHEN '{m}' THEN '{o}'" for m, o in A.OWNERS.items())
    hyp = " ".join(f"WHEN '{m}' THEN '{' || '.join(h)}'" for m, h in A.HYPOTHESES.items())
    n = " ".join(f"WHEN '{m}' THEN {len(h)}" for m, h in A.HYPOTHESES.items())
    return (f"CASE metric {owner} ELSE '{A.DEFAULT_OWNER}' END", f"CASE metric {hyp} ELSE '{A.DEFAULT_HYPOTHESES[0]}' END",
            f"CAST(CASE metric {n} ELSE 1 END AS INTEGER)")


SCORE_R6 = ("value", "baseline_median", "rolling_mad", "scale", "robust_z")
ANOM_R6 = ("observed_value", "baseline_median", "absolute_delta", "relative_delta", "robust_z")


@register("an01_metric_long", ids=("AN-01",), r6=("value",), sql=sql("SELECT * FROM a_long", DAILY, LONG))
def q_long(c):
    return A.metric_long(c.daily)


@register("an04_rolling_scores", ids=("AN-02", "AN-03", "AN-04"), r6=SCORE_R6,
          sql=sql("SELECT * FROM a_scores", DAILY, SCORES))
def q_scores(c):
    return c.anomaly_scores


CALENDAR = LONG.replace("a_long AS (", "a_rows AS (", 1) + """,
a_ends AS (SELECT metric, any_value(adverse_direction) AS adverse_direction, min(metric_date) AS a, max(metric_date) AS b FROM a_rows GROUP BY metric),
a_days AS (SELECT metric, adverse_direction, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
             AS metric_date FROM a_ends),
a_long AS (SELECT d.metric_date, d.metric, r.value, d.adverse_direction FROM a_days d
           LEFT JOIN a_rows r ON r.metric = d.metric AND r.metric_date = d.metric_date),
""" + SCORES[len(LONG) + 1:].lstrip()
#: Every 20th day is missing: what the calendar does with gaps shows.
_KEEP = "dayofyear(metric_date) % 20 <> 0"


def _gaps(c):
    return A.metric_long(c.daily.where(F.dayofyear("metric_date") % 20 != 0))


@register("an02_calendar_scores", ids=("AN-02", "AN-03", "AN-04"), r6=SCORE_R6,
          sql=sql("SELECT * FROM a_scores", DAILY, CALENDAR.replace("FROM o_daily", f"FROM o_daily WHERE {_KEEP}")))
def q_calendar_scores(c):
    """Windows of calendar days over a series with gaps."""
    return A.rolling_scores(A.calendar_spine(_gaps(c)))


@register("an02_late_days", ids=("AN-02", "AN-03", "AN-04"), r6=SCORE_R6, sql=sql("SELECT * FROM a_scores", DAILY, CALENDAR))
def q_late_days(c):
    """The missing days come in late: the scores of the days that they touch are computed anew."""
    before = c.mart(A.rolling_scores(A.calendar_spine(_gaps(c))))
    now = c.mart(A.calendar_spine(A.metric_long(c.daily)))
    late = now.where(F.dayofyear("metric_date") % 20 == 0).select("metric", "metric_date")
    return A.rescored(before, now, late)


@register("an07_daily_anomalies", ids=("AN-05", "AN-06", "AN-07"), r6=ANOM_R6,
          sql=sql("SELECT * FROM a_anoms", DAILY, ANOMS))
def q_anoms(c):
    return c.anomalies


@register("an08_segment_metrics", ids=("AN-08",), r6=("metric_value",), sql=sql(f"""
SELECT dimension, segment, m.metric, {_mv('')} AS metric_value
FROM (SELECT dimension, segment, {SUMS}, count(DISTINCT partner_id) AS partners
      FROM ({DIM_LONG}) AS l WHERE segment IS NOT NULL GROUP BY dimension, segment) AS s
CROSS JOIN (SELECT unnest([{', '.join(f"'{m}'" for m in A.METRIC_RULES)}]) AS metric) AS m"""))
def q_segment_metrics(c):
    return A.segment_metrics(c.session_fact)


@register("an09_primary_driver", ids=("AN-09",), r6=("current_value", "baseline_value", "adverse_gap"),
          sql=sql("SELECT * FROM a_driver", DAILY, DRIVER))
def q_driver(c):
    return c.driver


@register("an10_top_partner_context", ids=("AN-10",), r2=("successful_booking_value",),
          r6=("session_booking_conversion", "no_result_rate"), sql=sql("""
SELECT * EXCLUDE (session_date) FROM (
  SELECT p.*, a.case_id, row_number() OVER (PARTITION BY a.case_id ORDER BY p.sessions DESC, p.partner_id) AS context_rank
  FROM (SELECT session_date, partner_id, count(*) AS sessions, CAST(sum(search_count) AS BIGINT) AS searches,
               CAST(sum(booking_count) AS BIGINT) AS bookings, avg(CAST(booked_flag AS DOUBLE)) AS session_booking_conversion,
               CAST(sum(zero_result_searches) AS DOUBLE) / nullif(CAST(sum(search_count) AS DOUBLE), 0) AS no_result_rate,
               round(sum(successful_booking_value), 2) AS successful_booking_value
        FROM fct_session GROUP BY session_date, partner_id) p
  JOIN a_anoms a ON p.session_date = a.metric_date) AS r
WHERE context_rank <= 5""", DAILY, ANOMS))
def q_top_partners(c):
    return A.top_partners(c.anomalies, c.session_fact)


@register("an11_top_route_context", ids=("AN-11",), r6=("no_result_rate", "avg_search_latency_ms"), sql=sql("""
SELECT * EXCLUDE (search_date) FROM (
  SELECT p.*, a.case_id, row_number() OVER (PARTITION BY a.case_id
           ORDER BY p.searches DESC, p.origin_station_id, p.destination_station_id) AS context_rank
  FROM (SELECT search_date, origin_station_id, destination_station_id, count(*) AS searches,
               CAST(sum(booked_flag) AS BIGINT) AS booked_searches, avg(CAST(no_result_flag AS DOUBLE)) AS no_result_rate,
               avg(CAST(search_latency_ms AS DOUBLE)) AS avg_search_latency_ms
        FROM fct_search GROUP BY 1, 2, 3) p
  JOIN a_anoms a ON p.search_date = a.metric_date) AS r
WHERE context_rank <= 5""", DAILY, ANOMS))
def q_top_routes(c):
    return A.top_routes(c.anomalies, c.search_fact)


_OWNER, _HYP, _N = _lookup_sql()


@register("an12_case_lookup", ids=("AN-12",), sql=sql(f"""
SELECT case_id, metric, {_OWNER} AS recommended_owner, {_HYP} AS hypotheses_text, {_N} AS hypothesis_count
FROM a_anoms""", DAILY, ANOMS))
def q_lookup(c):
    e = A.enrich_lookup(c.anomalies.select("case_id", "metric"), c.lookup)
    return e.select("case_id", "metric", "recommended_owner", F.concat_ws(" || ", "hypotheses").alias("hypotheses_text"),
                    F.size("hypotheses").alias("hypothesis_count"))


@register("an13_case_register", ids=("AN-13",), r6=("robust_z", "observed_value", "baseline_median"), sql=sql(f"""
SELECT a.case_id, a.metric_date, a.metric, a.severity, a.robust_z, a.observed_value, a.baseline_median,
       d.dimension AS primary_driver_dimension, d.segment AS primary_driver_segment,
       {_OWNER.replace('CASE metric', 'CASE a.metric')} AS recommended_owner, true AS human_review_required
FROM a_anoms a LEFT JOIN a_driver d ON a.case_id = d.case_id""", DAILY, DRIVER))
def q_register(c):
    return A.case_register(c.anomalies, c.driver, c.lookup)


@register("an13_evidence_packets", ids=("AN-13",))
def q_packets(c):
    return A.evidence_packets(c.anomalies, c.driver, A.top_partners(c.anomalies, c.session_fact),
                              A.top_routes(c.anomalies, c.search_fact), c.lookup)


_PARTNER_CONTEXT = """SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY context_rank) - 1 AS k FROM (
  SELECT p.*, a.case_id, row_number() OVER (PARTITION BY a.case_id ORDER BY p.sessions DESC, p.partner_id) AS context_rank
  FROM (SELECT session_date, partner_id, count(*) AS sessions, CAST(sum(search_count) AS BIGINT) AS searches,
               CAST(sum(booking_count) AS BIGINT) AS bookings, avg(CAST(booked_flag AS DOUBLE)) AS session_booking_conversion,
               CAST(sum(zero_result_searches) AS DOUBLE) / nullif(CAST(sum(search_count) AS DOUBLE), 0) AS no_result_rate,
               round(sum(successful_booking_value), 2) AS successful_booking_value
        FROM fct_session GROUP BY session_date, partner_id) p
  JOIN a_anoms a ON p.session_date = a.metric_date) AS r WHERE context_rank <= 5"""
_ROUTE_CONTEXT = """SELECT *, context_rank - 1 AS k FROM (
  SELECT p.*, a.case_id, row_number() OVER (PARTITION BY a.case_id
           ORDER BY p.searches DESC, p.origin_station_id, p.destination_station_id) AS context_rank
  FROM (SELECT search_date, origin_station_id, destination_station_id, count(*) AS searches,
               CAST(sum(booked_flag) AS BIGINT) AS booked_searches, avg(CAST(no_result_flag AS DOUBLE)) AS no_result_rate,
               avg(CAST(search_latency_ms AS DOUBLE)) AS avg_search_latency_ms
        FROM fct_search GROUP BY 1, 2, 3) p
  JOIN a_anoms a ON p.search_date = a.metric_date) AS r WHERE context_rank <= 5"""


def _text(path: str, expr: str, src: str) -> str:
    return f"SELECT case_id, {path} AS path, CAST({expr} AS VARCHAR) AS text, CAST(NULL AS DOUBLE) AS number FROM {src}"


def _number(path: str, expr: str, src: str) -> str:
    return f"SELECT case_id, {path} AS path, CAST(NULL AS VARCHAR) AS text, CAST({expr} AS DOUBLE) AS number FROM {src}"


def _packet_sql() -> str:
    at = lambda name, field: f"'$.{name}[' || k || '].{field}'"
    parts = [_text(f"'$.{f}'", e, "a_anoms") for f, e in (
        ("case_id", "case_id"), ("data_classification", "'unclassified'"), ("metric_date", "strftime(metric_date, '%Y-%m-%d')"),
        ("metric", "metric"), ("severity", "severity"), ("recommended_owner", _OWNER), ("human_review_required", "true"),
        ("reasoning_policy.observations_are_facts", "true"), ("reasoning_policy.hypotheses_are_not_causal_claims", "true"),
        ("reasoning_policy.do_not_invent_missing_evidence", "true"))]
    parts += [_number(f"'$.observation.{f}'", f, "a_anoms") for f in ("observed_value", "baseline_median", "absolute_delta", "relative_delta",
                                                                    "robust_z")]
    parts += [_text(f"'$.primary_segment_driver.{f}'", f, "a_driver") for f in ("dimension", "segment")]
    parts += [_number(f"'$.primary_segment_driver.{f}'", f, "a_driver") for f in ("current_value", "baseline_value", "adverse_gap")]
    parts += [_number(at("top_partner_context", f), f, "a_pc") for f in (
        "context_rank", "partner_id", "sessions", "searches", "bookings", "session_booking_conversion", "no_result_rate",
        "successful_booking_value")]
    parts += [_number(at("top_route_context", f), f, "a_rc") for f in (
        "context_rank", "origin_station_id", "destination_station_id", "searches", "booked_searches", "no_result_rate",
        "avg_search_latency_ms")]
    parts.append("SELECT case_id, '$.hypotheses_to_test[' || k || ']' AS path, h[CAST(k + 1 AS INTEGER)] AS text, CAST(NULL AS DOUBLE) AS number "
                 f"FROM (SELECT case_id, string_split({_HYP}, ' || ') AS h, unnest(range({_N})) AS k FROM a_anoms) AS u")
    return "\nUNION ALL ".join(parts)


@register("an13_packet_paths", ids=("AN-13", "IN-05"), r6=("number",),
          sql=sql(_packet_sql(), DAILY, DRIVER, f"a_pc AS ({_PARTNER_CONTEXT})", f"a_rc AS ({_ROUTE_CONTEXT})"))
def q_packet_paths(c):
    """The nested packets, read back from their JSON text and flattened to paths and values."""
    return paths.path_values(paths.parsed(q_packets(c), "packet", "packet_json"), ["case_id"], "packet")


@register("in05_json_paths", ids=("IN-05",), r6=("number",), sql=sql("\nUNION ALL ".join(
    [_text(f"'$.{f}'", f, "a_anoms") for f in ("metric", "adverse_direction", "severity", "case_id", "metric_date")]
    + [_number(f"'$.{f}'", f, "a_anoms") for f in ANOM_R6]), DAILY, ANOMS))
def q_json_paths(c):
    """JSON records read back from their text, as paths and values."""
    whole = c.anomalies.select("case_id", F.struct(*c.anomalies.columns).alias("record"))
    told = whole.withColumn("text", F.to_json("record"))
    return paths.path_values(paths.parsed(told, "record", "text"), ["case_id"], "record")


@register("an14_detection_summary", ids=("AN-14",), sql=sql("""
SELECT s.severity, s.severity_order, coalesce(k.cases, 0) AS cases, t.top_case_id
FROM (SELECT 'critical' AS severity, 1 AS severity_order UNION ALL SELECT 'high', 2 UNION ALL SELECT 'medium', 3) s
LEFT JOIN (SELECT severity, count(*) AS cases FROM a_anoms GROUP BY severity) k ON s.severity = k.severity
CROSS JOIN (SELECT (SELECT case_id FROM a_anoms
                    ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END, abs(robust_z) DESC, case_id
                    LIMIT 1) AS top_case_id) t""", DAILY, ANOMS))
def q_summary(c):
    return A.detection_summary(c.anomalies)
