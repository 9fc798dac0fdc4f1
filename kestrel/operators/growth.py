"""Activation, growth and opportunity scoring (PG-01..PG-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.core import classify, composite_score, money_sum, rank_unique, safe_div
from kestrel.functions.ranking import quantiles
from kestrel.operators.metrics import grouping_sets

ACTIVATION_EVENTS = ["contract_signed", "api_key_created", "integration_test", "webhook_configured",
                     "first_search", "first_booking"]
TS_RENAMES = {"api_key_created": "api_key_created_ts", "integration_test": "integration_test_ts",
              "webhook_configured": "webhook_configured_ts", "first_search": "first_search_ts",
              "first_booking": "first_booking_ts"}


def derive_milestones(searches: DataFrame, bookings: DataFrame, recorded: DataFrame | None = None,
                      entity: str = "partner_id") -> DataFrame:
    """PG-01: first item / first outcome per entity, unioned with recorded milestones."""
    fs = searches.groupBy(entity).agg(F.min("search_ts").alias("event_ts")).withColumn(
        "event_type", F.lit("first_search"))
    fb = bookings.groupBy(entity).agg(F.min("booking_ts").alias("event_ts")).withColumn(
        "event_type", F.lit("first_booking"))
    out = fs.unionByName(fb)
    if recorded is not None:
        out = recorded.select(entity, "event_ts", "event_type").unionByName(out)
    return out


def pivot_milestones(events: DataFrame, entity: str = "partner_id",
                     types: Sequence[str] = ACTIVATION_EVENTS) -> DataFrame:
    """PG-02: earliest timestamp per event type, one column per type.

    The explicit value list keeps the pivot to one aggregation pass (no
    distinct-values job) and gives absent types a NULL column.
    """
    p = events.groupBy(entity).pivot("event_type", list(types)).agg(F.min("event_ts"))
    return p.withColumnsRenamed({k: v for k, v in TS_RENAMES.items() if k in types})


def partner_activation(partners: DataFrame, events: DataFrame, observation_end: str,
                       window_days: int = 30) -> DataFrame:
    """PG-03/PG-04: activation flags and right-censoring-aware 30-day activation.

    Eligible when launched at least ``window_days`` before the observation
    end (a timestamp); activated when eligible and 0 <= days <= window.
    """
    out = partners.join(pivot_milestones(events), "partner_id", "left")
    end = F.to_timestamp(F.lit(observation_end)).cast("timestamp_ntz")
    eligible = F.coalesce(F.col("launch_date") <= end - F.expr(f"INTERVAL {window_days} DAYS"), F.lit(False))
    days = F.datediff(F.to_date("first_booking_ts"), F.to_date("launch_date")).cast("bigint")
    out = out.withColumns({
        "integration_completed_flag": F.col("integration_test_ts").isNotNull().cast("bigint"),
        "first_search_flag": F.col("first_search_ts").isNotNull().cast("bigint"),
        "first_booking_flag": F.col("first_booking_ts").isNotNull().cast("bigint"),
        "days_to_first_booking": days,
        "activation_eligible_30d_flag": eligible.cast("bigint"),
    })
    activated = (F.col("activation_eligible_30d_flag") == 1) & F.coalesce(
        F.col("days_to_first_booking").between(0, window_days), F.lit(False))
    return out.withColumn("activated_30d_flag", activated.cast("bigint"))


ACTIVATION_DIMENSIONS = ["partner_type", "country", "integration_type", "contract_tier"]


def activation_segments(activation: DataFrame, dimensions: Sequence[str] = ACTIVATION_DIMENSIONS) -> DataFrame:
    """PG-05: eligible entities by each single dimension (grouping sets, one pass)."""
    elig = activation.filter(F.col("activation_eligible_30d_flag") == 1)
    measures = {
        "partners": F.count_distinct("partner_id"),
        "integration_completion_rate": F.avg(F.col("integration_completed_flag").cast("double")),
        "first_search_rate": F.avg(F.col("first_search_flag").cast("double")),
        "first_booking_rate": F.avg(F.col("first_booking_flag").cast("double")),
        "activation_30d_rate": F.avg(F.col("activated_30d_flag").cast("double")),
        "median_days_to_first_booking": F.median(F.col("days_to_first_booking").cast("double")),
    }
    return grouping_sets(elig, [[d] for d in dimensions], measures)


WINDOW_MEASURES = {"sessions": "sessions", "searches": "searches", "bookings": "bookings",
                   "booking_sessions": "booking_sessions", "successful_value": "successful_booking_value",
                   "platform_revenue": "platform_revenue"}


def partner_growth(weekly: DataFrame, performance: DataFrame, reference_window: bool = True) -> DataFrame:
    """PG-06: recent vs prior window per entity, anchored at the latest week.

    Recent = [max_week - 3 weeks, max_week]; prior ends the day before the
    recent start and spans 3 weeks (so it holds 3 Monday buckets, 4 with
    ``reference_window=False``).  One conditional aggregate replaces two
    filtered group-bys; the anchor is a 1-row aggregate, broadcast.
    """
    prior_weeks = 21 if reference_window else 28
    anchor = weekly.agg(F.max("session_week").alias("recent_window_end")).select(
        "recent_window_end",
        F.date_sub("recent_window_end", 21).alias("recent_window_start"),
        F.date_sub("recent_window_end", 22).alias("prior_window_end"),
        F.date_sub("recent_window_end", 22 + prior_weeks).alias("prior_window_start"))
    w = weekly.crossJoin(F.broadcast(anchor))
    in_recent = F.col("session_week").between(F.col("recent_window_start"), F.col("recent_window_end"))
    in_prior = F.col("session_week").between(F.col("prior_window_start"), F.col("prior_window_end"))
    aggs = []
    for prefix, cond in (("recent_4w", in_recent), ("prior_4w", in_prior)):
        for out_name, src in WINDOW_MEASURES.items():
            val = F.when(cond, F.col(src))
            agg = money_sum(val) if src in ("successful_booking_value", "platform_revenue") else F.sum(val)
            aggs.append(agg.alias(f"{prefix}_{out_name}"))
    rolled = w.groupBy("partner_id").agg(*aggs)
    win_cols = [c for c in rolled.columns if c != "partner_id"]
    g = performance.join(rolled, "partner_id", "left").crossJoin(F.broadcast(anchor))
    money = [c for c in win_cols if c.endswith("successful_value") or c.endswith("platform_revenue")]
    g = g.fillna(0, subset=[c for c in win_cols if c not in money]).fillna(0.0, subset=money)
    g = g.withColumns({
        "recent_4w_conversion": safe_div("recent_4w_booking_sessions", "recent_4w_sessions"),
        "prior_4w_conversion": safe_div("prior_4w_booking_sessions", "prior_4w_sessions"),
    })
    growth = F.when(F.col("prior_4w_successful_value") > 0,
                    F.col("recent_4w_successful_value") / F.col("prior_4w_successful_value") - 1).otherwise(
        F.when(F.col("recent_4w_successful_value") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return g.withColumns({
        "conversion_change_pp": F.col("recent_4w_conversion") - F.col("prior_4w_conversion"),
        "successful_value_growth_rate": growth.cast("double"),
    })


OPPORTUNITY_WEIGHTS = {"volume": 0.30, "value": 0.20, "gap": 0.22, "no_result": 0.18, "decline": 0.10}
OPPORTUNITY_TYPES = ["High-volume conversion opportunity", "Search-result availability opportunity",
                     "Recent conversion deterioration", "Growth / expansion candidate", "Monitor"]


def partner_opportunities(growth: DataFrame) -> DataFrame:
    """PG-07..PG-10: composite score, first-match classification, unique rank."""
    stats = quantiles(growth, [
        ("__conv_med", "session_booking_conversion", 0.5), ("__nr_med", "no_result_rate", 0.5),
        ("__nr_p75", "no_result_rate", 0.75), ("__search_med", "searches", 0.5)])
    g = growth.crossJoin(F.broadcast(stats))
    w = OPPORTUNITY_WEIGHTS
    g = composite_score(g, [
        (w["volume"], F.log1p(F.col("searches"))),
        (w["value"], F.log1p(F.col("successful_booking_value"))),
        (w["gap"], F.greatest(F.col("__conv_med") - F.col("session_booking_conversion"), F.lit(0.0))),
        (w["no_result"], F.greatest(F.col("no_result_rate") - F.col("__nr_med"), F.lit(0.0))),
        (w["decline"], F.greatest(-F.col("conversion_change_pp"), F.lit(0.0))),
    ], "opportunity_score")
    g = g.withColumn("opportunity_type", classify([
        ((F.col("searches") >= F.col("__search_med"))
         & (F.col("session_booking_conversion") < F.col("__conv_med")), OPPORTUNITY_TYPES[0]),
        (F.col("no_result_rate") > F.col("__nr_p75"), OPPORTUNITY_TYPES[1]),
        (F.col("conversion_change_pp") < 0, OPPORTUNITY_TYPES[2]),
        (F.col("successful_value_growth_rate") > 0.20, OPPORTUNITY_TYPES[3]),
    ], OPPORTUNITY_TYPES[4]))
    g = rank_unique(g, [F.col("opportunity_score").desc(), F.col("partner_id").asc()], "priority_rank")
    return g.drop("__conv_med", "__nr_med", "__nr_p75", "__search_med")


def stage3_findings(funnel: DataFrame, activation_segs: DataFrame, product_segs: DataFrame,
                    opportunities: DataFrame, retention_wide: DataFrame) -> DataFrame:
    """PG-11: one row of selections; each is a max_by/min_by over a small mart."""
    drop = funnel.filter(F.col("stage_order") > 1).agg(
        F.max_by(F.struct("stage", "dropoff_from_previous", "conversion_from_previous"),
                 F.struct(F.col("dropoff_from_previous"), -F.col("stage_order"))).alias("d"))
    act = activation_segs.filter(F.col("dimension") == "integration_type").agg(
        F.min_by(F.struct(F.col("segment_value").alias("segment"), "activation_30d_rate", "partners"),
                 F.struct("activation_30d_rate", "segment_value")).alias("a"))
    med = product_segs.agg(F.greatest(F.lit(25), F.floor(F.median("sessions")).cast("bigint")).alias("__min"))
    seg = product_segs.crossJoin(F.broadcast(med)).filter(F.col("sessions") >= F.col("__min")).agg(
        F.min_by(F.struct("dimension", F.col("segment_value").alias("segment"), "sessions",
                          "session_booking_conversion", "no_result_rate"),
                 F.struct("session_booking_conversion", "dimension", "segment_value")).alias("s"))
    top = opportunities.filter(F.col("priority_rank") == 1).select(
        F.struct("partner_id", "opportunity_type", "priority_rank", "sessions", "searches",
                 "session_booking_conversion", "no_result_rate").alias("o"))
    ret = retention_wide.filter(F.col("month_1_retention").isNotNull()).agg(
        F.max_by(F.struct("cohort_month", "month_1_retention"),
                 F.struct(F.col("month_1_retention"), F.expr("-unix_date(cohort_month)"))).alias("r"))
    one = drop.crossJoin(act).crossJoin(seg).crossJoin(top).crossJoin(ret)
    return one.select(
        F.col("d.stage").alias("largest_drop_stage"),
        F.col("d.dropoff_from_previous").alias("largest_drop_rate"),
        F.col("a.segment").alias("weakest_activation_segment"),
        F.col("a.activation_30d_rate").alias("weakest_activation_rate"),
        F.col("a.partners").alias("weakest_activation_partners"),
        F.col("s.dimension").alias("weakest_product_dimension"),
        F.col("s.segment").alias("weakest_product_segment"),
        F.col("s.session_booking_conversion").alias("weakest_product_conversion"),
        F.col("o.partner_id").alias("top_partner_id"),
        F.col("o.opportunity_type").alias("top_partner_opportunity_type"),
        F.col("r.cohort_month").alias("best_month1_cohort"),
        F.col("r.month_1_retention").alias("best_month1_retention"),
    )
