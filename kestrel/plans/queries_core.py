"""Registered queries: quality gates, facts and product metric marts."""

from __future__ import annotations

from kestrel.operators import facts, metrics
from kestrel.plans.oracle_views import with_prelude
from kestrel.plans.registry import register

MONEY = ("booking_value", "successful_booking_value", "platform_revenue")
RATIOS6 = ("session_booking_conversion", "search_to_book_conversion", "no_result_rate",
           "result_selection_rate", "alternatives_exposure_rate", "avg_search_latency_ms",
           "cancellation_rate", "refund_rate")


def sql(final: str, *ctes: str) -> str:
    return with_prelude(*ctes) + "-- final\n" + final


# ---------------------------------------------------------------- facts

@register("fc01_successful_value", ids=("FC-01",), r2=("booking_value", "successful_booking_value"),
          sql=sql("SELECT booking_id, booking_value, successful_booking_value FROM v_bk"))
def q_successful_value(c):
    return facts.add_successful_value(c.views.bookings).select(
        "booking_id", "booking_value", "successful_booking_value")


@register("fc02_outcomes_by_item", ids=("FC-02",), r2=MONEY,
          sql=sql("SELECT * FROM v_bk_by_search"))
def q_outcomes_by_item(c):
    return facts.outcome_rollup(c.views.bookings, "search_id")


@register("fc03_search_fact", ids=("FC-03",), r2=MONEY, sql=sql("SELECT * FROM fct_search"))
def q_search_fact(c):
    return c.search_fact


@register("fc04_items_by_unit", ids=("FC-04",), r6=("avg_search_latency_ms",),
          sql=sql("SELECT * FROM v_se_by_session"))
def q_items_by_unit(c):
    return facts.item_rollup(c.views.searches)


@register("fc05_session_fact", ids=("FC-05",), r2=MONEY, r6=("avg_search_latency_ms",),
          sql=sql("SELECT * FROM fct_session"))
def q_session_fact(c):
    return c.session_fact


@register("fc07_first_item_per_unit", ids=("FC-07",),
          sql=sql("""SELECT search_id, session_id, search_ts FROM (
                       SELECT search_id, session_id, search_ts,
                              row_number() OVER (PARTITION BY session_id ORDER BY search_ts, search_id) AS rn
                       FROM v_searches) WHERE rn = 1"""))
def q_first_item(c):
    s = c.views.searches.select("search_id", "session_id", "search_ts")
    return facts.first_per_group(s, "session_id", ["search_ts", "search_id"])


# ---------------------------------------------------------------- product metrics

_ROLLUP_SQL = """
SELECT {grain} AS {alias}, count(session_id) AS sessions, count(DISTINCT partner_id) AS active_partners,
       CAST(sum(search_count) AS BIGINT) AS searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
       CAST(sum(booked_flag) AS BIGINT) AS booking_sessions,
       CAST(sum(zero_result_searches) AS BIGINT) AS zero_result_searches,
       CAST(sum(selected_searches) AS BIGINT) AS selected_searches,
       CAST(sum(alternatives_shown_count) AS BIGINT) AS alternatives_shown,
       CAST(sum(total_search_latency_ms) AS BIGINT) AS total_search_latency_ms,
       round(sum(booking_value), 2) AS booking_value, round(sum(successful_booking_value), 2) AS successful_booking_value,
       round(sum(platform_revenue), 2) AS platform_revenue, CAST(sum(cancellations) AS BIGINT) AS cancellations,
       CAST(sum(refunds) AS BIGINT) AS refunds,
       {ratios}
FROM fct_session GROUP BY {grain}"""

_RATIO_SQL = """
       coalesce(CAST(sum(booked_flag) AS DOUBLE) / nullif(count(session_id), 0), 0) AS session_booking_conversion,
       coalesce(CAST(sum(booking_count) AS DOUBLE) / nullif(sum(search_count), 0), 0) AS search_to_book_conversion,
       coalesce(CAST(sum(zero_result_searches) AS DOUBLE) / nullif(sum(search_count), 0), 0) AS no_result_rate,
       coalesce(CAST(sum(selected_searches) AS DOUBLE) / nullif(sum(search_count), 0), 0) AS result_selection_rate,
       coalesce(CAST(sum(alternatives_shown_count) AS DOUBLE) / nullif(sum(search_count), 0), 0) AS alternatives_exposure_rate,
       coalesce(CAST(sum(total_search_latency_ms) AS DOUBLE) / nullif(sum(search_count), 0), 0) AS avg_search_latency_ms,
       coalesce(CAST(sum(cancellations) AS DOUBLE) / nullif(sum(booking_count), 0), 0) AS cancellation_rate,
       coalesce(CAST(sum(refunds) AS DOUBLE) / nullif(sum(booking_count), 0), 0) AS refund_rate,
       coalesce(round(sum(successful_booking_value), 2) / nullif(count(DISTINCT partner_id), 0), 0)
         AS successful_booking_value_per_active_partner"""

ROLLUP_R2 = MONEY
RATIOS6 = RATIOS6 + ("successful_booking_value_per_active_partner",)


def rollup_sql(grain: str, alias: str) -> str:
    return _ROLLUP_SQL.format(grain=grain, alias=alias, ratios=_RATIO_SQL)


@register("pm03_daily_metrics", ids=("PM-01", "PM-02", "PM-03"), r2=ROLLUP_R2, r6=RATIOS6,
          sql=sql(rollup_sql("session_date", "metric_date")))
def q_daily(c):
    return metrics.daily_metrics(c.session_fact)


@register("pm03_weekly_metrics", ids=("PM-01", "PM-02", "PM-03"), r2=ROLLUP_R2, r6=RATIOS6,
          sql=sql(rollup_sql("session_week", "metric_week")))
def q_weekly(c):
    return metrics.weekly_metrics(c.session_fact)


@register("pm01_monthly_metrics", ids=("PM-01", "PM-02"), r2=ROLLUP_R2, r6=RATIOS6,
          sql=sql(rollup_sql("session_month", "session_month")))
def q_monthly(c):
    return metrics.metric_rollup(c.session_fact, "session_month")
