"""Product metric marts (PM-01..13).

Every mart is a single hash aggregate over a fact (partial aggregation on
the map side, final after one shuffle on the grouping key) followed by
row-local ratio expressions.  Ratios are always ratios of sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.core import money_sum

from kestrel.functions.core import safe_div

BASE_MEASURES = ["sessions", "active_partners", "searches", "bookings", "booking_sessions",
                 "zero_result_searches", "selected_searches", "alternatives_shown",
                 "total_search_latency_ms", "booking_value", "successful_booking_value",
                 "platform_revenue", "cancellations", "refunds"]
RATIOS = ["session_booking_conversion", "search_to_book_conversion", "no_result_rate",
          "result_selection_rate", "alternatives_exposure_rate", "avg_search_latency_ms",
          "cancellation_rate", "refund_rate", "successful_booking_value_per_active_partner"]


def base_measures(unit: str = "session_id", entity: str = "partner_id") -> list[Column]:
    """PM-01: the 14 base measures of a product rollup."""
    return [
        F.count(unit).alias("sessions"),
        F.countDistinct(entity).alias("active_partners"),
        F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.sum("booked_flag").alias("booking_sessions"),
        F.sum("zero_result_searches").alias("zero_result_searches"),
        F.sum("selected_searches").alias("selected_searches"),
        F.sum("alternatives_shown_count").alias("alternatives_shown"),
        F.sum("total_search_latency_ms").alias("total_search_latency_ms"),
        money_sum("booking_value").alias("booking_value"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
        F.sum("cancellations").alias("cancellations"),
        F.sum("refunds").alias("refunds"),
    ]


def ratio_columns() -> dict[str, Column]:
    """PM-02: the nine derived ratios (0.0 on a zero denominator)."""
    return {
        "session_booking_conversion": safe_div("booking_sessions", "sessions"),
        "search_to_book_conversion": safe_div("bookings", "searches"),
        "no_result_rate": safe_div("zero_result_searches", "searches"),
        "result_selection_rate": safe_div("selected_searches", "searches"),
        "alternatives_exposure_rate": safe_div("alternatives_shown", "searches"),
        "avg_search_latency_ms": safe_div("total_search_latency_ms", "searches"),
        "cancellation_rate": safe_div("cancellations", "bookings"),
        "refund_rate": safe_div("refunds", "bookings"),
        "successful_booking_value_per_active_partner": safe_div("successful_booking_value", "active_partners"),
    }


def metric_rollup(fact: DataFrame, grain: str | Sequence[str], rename: str | None = None) -> DataFrame:
    """PM-01/02: rollup of the unit fact at any grain (one distinct count)."""
    keys = [grain] if isinstance(grain, str) else list(grain)
    out = fact.groupBy(*keys).agg(*base_measures()).withColumns(ratio_columns())
    if rename and isinstance(grain, str):
        out = out.withColumnRenamed(grain, rename)
    return out


def daily_metrics(fact: DataFrame) -> DataFrame:
    """PM-03: daily mart."""
    return metric_rollup(fact, "session_date", "metric_date")


def weekly_metrics(fact: DataFrame) -> DataFrame:
    """PM-03: weekly mart."""
    return metric_rollup(fact, "session_week", "metric_week")


def kpi_summary(fact: DataFrame, activation: DataFrame) -> DataFrame:
    """PM-04: 14 global KPIs as a (metric, value) long table."""
    f = fact.agg(
        F.count("*").cast("double").alias("sessions"),
        F.countDistinct("partner_id").cast("double").alias("active_partners"),
        F.sum("search_count").cast("double").alias("searches"),
        F.sum("booking_count").cast("double").alias("bookings"),
        F.sum("booked_flag").cast("double").alias("booking_sessions"),
        F.sum("zero_result_searches").cast("double").alias("zero_results"),
        F.sum("selected_searches").cast("double").alias("selected"),
        money_sum("booking_value").cast("double").alias("booking_value"),
        money_sum("successful_booking_value").cast("double").alias("successful_booking_value"),
        money_sum("platform_revenue").cast("double").alias("platform_revenue"),
    )
    a = activation.agg(
        F.avg(F.col("integration_completed_flag").cast("double")).alias("integration_completion_rate"),
        F.coalesce(F.avg(F.when(F.col("activation_eligible_30d_flag") == 1,
                                F.col("activated_30d_flag").cast("double"))), F.lit(0.0))
        .alias("activation_30d_rate"),
    )
    row = f.crossJoin(a).select(
        "sessions", "active_partners", "searches", "bookings",
        safe_div("booking_sessions", "sessions").alias("session_booking_conversion"),
        safe_div("bookings", "searches").alias("search_to_book_conversion"),
        safe_div("zero_results", "searches").alias("no_result_rate"),
        safe_div("selected", "searches").alias("result_selection_rate"),
        "booking_value", "successful_booking_value", "platform_revenue",
        safe_div("successful_booking_value", "active_partners").alias("successful_booking_value_per_active_partner"),
        "integration_completion_rate", "activation_30d_rate",
    )
    cols = row.columns
    return row.unpivot([], cols, "metric", "value").withColumn(
        "metric_order", F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("metric")).cast("bigint"))


def overview(fact: DataFrame) -> DataFrame:
    """PM-05: overview KPI row."""
    return fact.agg(
        F.count("*").alias("sessions"),
        F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.avg(F.col("booked_flag").cast("double")).alias("session_booking_conversion"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
        F.countDistinct("partner_id").alias("active_partners"),
    )


def partner_performance(partners: DataFrame, fact: DataFrame) -> DataFrame:
    """PM-06: entity dimension left-joined to its rollup; inactive entities kept."""
    agg = fact.groupBy("partner_id").agg(
        F.count("session_id").alias("sessions"),
        F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.sum("booked_flag").alias("booking_sessions"),
        F.sum("zero_result_searches").alias("zero_result_searches"),
        F.sum("alternatives_shown_count").alias("alternatives_shown"),
        F.sum("total_search_latency_ms").alias("total_search_latency_ms"),
        money_sum("booking_value").alias("booking_value"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
        F.sum("cancellations").alias("cancellations"),
        F.sum("refunds").alias("refunds"),
    )
    dims = partners.select("partner_id", "partner_type", "country", "integration_type", "contract_tier")
    out = dims.join(agg, "partner_id", "left")
    longs = ["sessions", "searches", "bookings", "booking_sessions", "zero_result_searches",
             "alternatives_shown", "total_search_latency_ms", "cancellations", "refunds"]
    out = out.fillna(0, subset=longs).fillna(0.0, subset=["booking_value", "successful_booking_value",
                                                          "platform_revenue"])
    return out.withColumns({
        "session_booking_conversion": safe_div("booking_sessions", "sessions"),
        "no_result_rate": safe_div("zero_result_searches", "searches"),
        "alternatives_exposure_rate": safe_div("alternatives_shown", "searches"),
        "avg_search_latency_ms": safe_div("total_search_latency_ms", "searches"),
    })


def partner_weekly(fact: DataFrame) -> DataFrame:
    """PM-07: entity x week rollup with conversion."""
    return fact.groupBy("partner_id", "session_week").agg(
        F.count("session_id").alias("sessions"),
        F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.sum("booked_flag").alias("booking_sessions"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
    ).withColumn("session_booking_conversion", safe_div("booking_sessions", "sessions"))


def retention(fact: DataFrame) -> DataFrame:
    """PM-08: monthly cohort retention; cohort = first month of activity.

    (entity, month) pairs are distinct, so the active counts are plain
    counts; the cohort size comes from the same pairs at month index 0.
    """
    activity = fact.select("partner_id", "session_month").distinct()
    first = activity.groupBy("partner_id").agg(F.min("session_month").alias("cohort_month"))
    cohort = activity.join(first, "partner_id").withColumn(
        "month_index",
        ((F.year("session_month") - F.year("cohort_month")) * 12
         + F.month("session_month") - F.month("cohort_month")).cast("bigint"))
    active = cohort.groupBy("cohort_month", "month_index").agg(
        F.count("partner_id").alias("active_partners"))
    sizes = first.groupBy("cohort_month").agg(F.count("partner_id").alias("cohort_size"))
    return active.join(sizes, "cohort_month").withColumn(
        "retention_rate", safe_div("active_partners", "cohort_size"))


def route_performance(search_fact: DataFrame, src: str = "origin_station_id",
                      dst: str = "destination_station_id") -> DataFrame:
    """PM-09: per ordered pair counts; latency here is a plain mean."""
    return search_fact.groupBy(src, dst).agg(
        F.count("search_id").alias("searches"),
        F.sum("booked_flag").alias("booked_searches"),
        F.sum("booking_count").alias("bookings"),
        F.sum("no_result_flag").alias("zero_result_searches"),
        F.avg("search_latency_ms").alias("avg_search_latency_ms"),
        money_sum("booking_value").alias("booking_value"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
    ).withColumns({
        "search_to_book_conversion": safe_div("booked_searches", "searches"),
        "no_result_rate": safe_div("zero_result_searches", "searches"),
    })


FUNNEL_STAGES = ["Searches", "Results returned", "Journey selected", "Booked"]


def funnel(search_fact: DataFrame) -> DataFrame:
    """PM-10: 4-stage funnel from one global aggregate (4 output rows)."""
    counts = search_fact.agg(
        F.count("*").cast("double").alias("s1"),
        F.sum(F.when(F.col("no_result_flag") == 0, 1).otherwise(0)).cast("double").alias("s2"),
        F.sum("selected_flag").cast("double").alias("s3"),
        F.sum("booked_flag").cast("double").alias("s4"),
    )
    stages = ", ".join(f"'{name}', {i + 1}, s{i + 1}" for i, name in enumerate(FUNNEL_STAGES))
    long = counts.selectExpr(f"stack(4, {stages}) AS (stage, stage_order, count)")
    # the window runs over the 4 stacked rows only
    w = Window.orderBy("stage_order")
    prev = F.lag("count").over(w)
    first = F.first("count").over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = long.withColumns({
        "conversion_from_previous": F.when(F.col("stage_order") == 1, F.lit(1.0)).otherwise(safe_div(F.col("count"), prev)),
        "conversion_from_search": F.when(F.col("stage_order") == 1, F.lit(1.0)).otherwise(safe_div(F.col("count"), first)),
    })
    return out.withColumns({
        "dropoff_from_previous": F.when(F.col("stage_order") == 1, F.lit(0.0)).otherwise(
            F.lit(1.0) - F.col("conversion_from_previous")),
        "stage_order": F.col("stage_order").cast("bigint"),
    })


SEGMENT_SETS = [["device_type"], ["traveller_type"], ["acquisition_channel"], ["device_type", "traveller_type"]]


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], measures: dict[str, Column], also: Sequence[str] = ()) -> DataFrame:
    """GROUPING SETS -> (dimension, segment_value, also..., measures...) in one pass; ``also`` is in every set.

    Spark expands each row once per set and runs a single aggregate (one
    shuffle) instead of one scan per set.  ``dimension`` joins the set's
    column names with " x ", ``segment_value`` its values with " | ".  Rows
    with a NULL dimension value are dropped, as a per-set group-by would.
    """
    dims = sorted({d for s in sets for d in s})
    columns = [*dims, *also]
    agg = df.groupingSets([[*s, *also] for s in sets], *columns).agg(
        *[m.alias(n) for n, m in measures.items()], F.grouping_id(*columns).alias("__gid"))
    label = value = present = None
    for s in sets:
        bits = sum(1 << (len(columns) - 1 - i) for i, d in enumerate(dims) if d not in s)
        cond = F.col("__gid") == bits
        lab = F.lit(" x ".join(s))
        val = F.concat_ws(" | ", *[F.col(d).cast("string") for d in s])
        ok = None
        for d in s:
            ok = F.col(d).isNotNull() if ok is None else ok & F.col(d).isNotNull()
        label = F.when(cond, lab) if label is None else label.when(cond, lab)
        value = F.when(cond, val) if value is None else value.when(cond, val)
        present = F.when(cond, ok) if present is None else present.when(cond, ok)
    out = agg.filter(present).withColumns({"dimension": label, "segment_value": value})
    return out.select("dimension", "segment_value", *also, *measures.keys())


def product_segments(fact: DataFrame, sets: Sequence[Sequence[str]] = SEGMENT_SETS) -> DataFrame:
    """PM-11: product segments over grouping sets with four ratios.

    Units are summed once for each partner and combination of levels; only those sums are expanded by the
    sets, still by partner, so that partners are counted as rows and nothing is expanded for a distinct count.
    """
    dims = sorted({d for s in sets for d in s})
    counts = {"searches": "search_count", "bookings": "booking_count", "booking_sessions": "booked_flag",
              "zero_result_searches": "zero_result_searches", "selected_searches": "selected_searches"}
    money = ["successful_booking_value", "platform_revenue"]
    fine = fact.groupBy(*dims, "partner_id").agg(
        F.count("session_id").alias("sessions"), *[F.sum(c).alias(n) for n, c in counts.items()], *[money_sum(c).alias(c) for c in money])
    again = {n: F.sum(n) for n in ("sessions", *counts)} | {c: money_sum(c) for c in money}
    by_partner = grouping_sets(fine, sets, again, also=["partner_id"])
    agg = by_partner.groupBy("dimension", "segment_value").agg(
        F.count("partner_id").alias("partners"), *[m.alias(n) for n, m in again.items()])
    return agg.select(
        "dimension", "segment_value", "sessions", "partners", "searches", "bookings",
        safe_div("booking_sessions", "sessions").alias("session_booking_conversion"),
        safe_div("bookings", "searches").alias("search_to_book_conversion"),
        safe_div("zero_result_searches", "searches").alias("no_result_rate"),
        safe_div("selected_searches", "searches").alias("result_selection_rate"),
        "successful_booking_value", "platform_revenue",
    )


def retention_summary(ret: DataFrame, months: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """PM-12: cohort x month-index wide table; absent cells stay NULL."""
    wide = ret.groupBy("cohort_month").pivot("month_index", list(months)).agg(F.first("retention_rate"))
    return wide.select("cohort_month", *[F.col(str(m)).alias(f"month_{m}_retention") for m in months])


def retention_long(summary: DataFrame, months: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """PM-13: wide -> long, dropping NULL cells."""
    cols = [f"month_{m}_retention" for m in months]
    return summary.unpivot(["cohort_month"], cols, "retention_month", "retention_rate").dropna(
        subset=["retention_rate"])
