"""Rolling robust-z anomaly triage and evidence cases (AN-01..AN-14).

The reference walks anomalies one by one and queries the facts three times
per anomaly.  Here every context is one join: the anomaly list (bounded by
metrics x calendar days, so it is broadcast) is exploded to the dates it
needs and joined to a fact pre-aggregated once by date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.core import money_sum

LOOKBACK = 28
MIN_HISTORY = 14
Z_THRESHOLD = 3.5
MAD_SCALE = 1.4826

# fixed values: metric -> adverse direction
METRIC_RULES = {
    "session_booking_conversion": "low",
    "search_to_book_conversion": "low",
    "no_result_rate": "high",
    "avg_search_latency_ms": "high",
    "cancellation_rate": "high",
    "refund_rate": "high",
    "successful_booking_value_per_active_partner": "low",
}
SEVERITY_ORDER = {"critical": 1, "high": 2, "medium": 3}
DRIVER_DIMENSIONS = ["device_type", "traveller_type", "acquisition_channel"]

# fixed values: owner and hypotheses per metric (default for unknown metrics last)
OWNERS = {
    "no_result_rate": "Search / Supply Product",
    "avg_search_latency_ms": "Search / Supply Product",
    "cancellation_rate": "Booking / Post-Booking Product",
    "refund_rate": "Booking / Post-Booking Product",
    "successful_booking_value_per_active_partner": "B2B Growth / Commercial",
}
DEFAULT_OWNER = "Product Analytics / Growth"
HYPOTHESES = {
    "session_booking_conversion": [
        "Check whether the drop is concentrated by device, acquisition channel or traveller type.",
        "Compare no-result rate and search latency on the same date.",
        "Inspect high-volume partners for simultaneous conversion deterioration.",
    ],
    "search_to_book_conversion": [
        "Check route-level booking conversion and no-result exposure.",
        "Inspect whether journey-result selection weakened before booking.",
        "Compare high-volume partner performance with the prior 28-day baseline.",
    ],
    "no_result_rate": [
        "Inspect origin-destination routes contributing the most zero-result searches.",
        "Check whether the issue is concentrated by country, partner or device.",
        "Compare latency and booking conversion for the same affected segments.",
    ],
    "avg_search_latency_ms": [
        "Check whether latency is concentrated by device or acquisition channel.",
        "Compare latency with conversion and no-result changes.",
        "Review high-volume routes and partners for shared degradation.",
    ],
    "cancellation_rate": [
        "Check whether the increase is concentrated in particular partners or journey types.",
        "Compare booking-value mix and route mix with recent history.",
        "Treat the signal cautiously on low-booking-volume days.",
    ],
    "refund_rate": [
        "Check whether refunds follow a cancellation spike or specific partner/route mix.",
        "Compare booking volume to ensure the rate is not driven by a small denominator.",
        "Inspect journey type and commercial-value mix.",
    ],
    "successful_booking_value_per_active_partner": [
        "Separate traffic loss from conversion loss and lower booking value.",
        "Inspect whether high-value partners contributed less than normal.",
        "Compare partner and route mix with the prior 28-day baseline.",
    ],
}
DEFAULT_HYPOTHESES = ["Review the supporting product metrics and segment mix."]


def metric_long(daily: DataFrame, rules: Mapping[str, str] = METRIC_RULES, date: str = "metric_date") -> DataFrame:
    """AN-01: wide daily mart -> (date, metric, value, adverse_direction)."""
    missing = [m for m in rules if m not in daily.columns]
    if missing:
        raise ValueError("Required daily metrics are missing: " + ", ".join(missing))
    long = daily.select(date, *[F.col(m).cast("double").alias(m) for m in rules]).unpivot(
        [date], list(rules), "metric", "value")
    direction = F.create_map(*[x for k, v in rules.items() for x in (F.lit(k), F.lit(v))])
    return long.withColumn("adverse_direction", direction[F.col("metric")])


def rolling_scores(long: DataFrame, lookback: int = LOOKBACK, min_history: int = MIN_HISTORY,
                   date: str = "metric_date", fallback: str = "series") -> DataFrame:
    """AN-02..AN-04: prior rolling median, rolling MAD and scale.

    Windows count rows (Q4): the frame is the ``lookback`` rows before the
    current one.  The MAD window runs over deviations that themselves need
    a baseline, so it becomes valid ``min_history`` rows later (Q2).  The
    fallback scale is the whole-series population std (``series``, Q3) or
    the std of the prior frame only (``prior``).
    """
    w = Window.partitionBy("metric").orderBy(date)
    frame = w.rowsBetween(-lookback, -1)
    v = F.col("value")
    out = long.withColumn("baseline_median", F.when(F.count(v).over(frame) >= min_history,
                                                    F.percentile(v, 0.5).over(frame)))
    out = out.withColumn("__dev", F.abs(v - F.col("baseline_median")))
    out = out.withColumn("rolling_mad", F.when(F.count("__dev").over(frame) >= min_history,
                                               F.percentile("__dev", 0.5).over(frame)))
    if fallback == "series":
        fb = F.stddev_pop(v).over(Window.partitionBy("metric"))
    else:
        fb = F.stddev_pop(v).over(frame)
    fb = F.when(fb.isNull() | F.isnan(fb) | (fb == 0), F.lit(1e-6)).otherwise(fb)
    scale = F.coalesce(F.nullif(F.lit(MAD_SCALE) * F.col("rolling_mad"), F.lit(0.0)), fb)
    out = out.withColumn("scale", scale).drop("__dev")
    return out.withColumn("robust_z", (v - F.col("baseline_median")) / F.col("scale"))


def calendar_spine(long: DataFrame, date: str = "metric_date") -> DataFrame:
    """AN-02 by calendar day: one row for each metric and day from its first to its last.

    Gap rule: a day without a row gets one without a value.  It takes up a day of the windows but is no
    observation, so a median needs as many observations as before, within the last days instead of rows.
    """
    ends = long.groupBy("metric").agg(F.min(date).alias("__a"), F.max(date).alias("__b"),
                                      F.first("adverse_direction").alias("adverse_direction"))
    days = ends.select("metric", "adverse_direction", F.explode(F.sequence("__a", "__b", F.expr("INTERVAL 1 DAY"))).alias(date))
    return days.withColumn(date, F.to_date(date)).join(long.select(date, "metric", "value"), [date, "metric"], "left").select(
        date, "metric", "value", "adverse_direction")


def rescored(scores: DataFrame, long: DataFrame, late: DataFrame, lookback: int = LOOKBACK, min_history: int = MIN_HISTORY,
             date: str = "metric_date") -> DataFrame:
    """The scores of a calendar after values of ``late`` (metric, date) have come in or changed.

    A day's value moves the medians of the ``lookback`` days after it and, through their deviations, the MADs of as
    many days again; only those days are computed anew, from the values of that stretch and its history.  All
    others keep median and MAD; the series' deviation, which stands in for a MAD of zero, is renewed for all.
    ``long`` has all values as they are now, on the calendar.
    """
    touched = late.select("metric", F.explode(F.sequence(F.to_date(date), F.date_add(F.to_date(date), 2 * lookback),
                                                         F.expr("INTERVAL 1 DAY"))).alias(date))
    touched = touched.select("metric", F.to_date(date).alias(date)).distinct()
    history = touched.select("metric", F.explode(F.sequence(F.date_sub(date, 2 * lookback), F.col(date),
                                                            F.expr("INTERVAL 1 DAY"))).alias(date)).distinct()
    history = history.select("metric", F.to_date(date).alias(date))
    # stretches that are not neighbours must not share a window
    part = long.join(history, ["metric", date], "left_semi")
    w = Window.partitionBy("metric").orderBy(date)
    begins = F.coalesce((F.datediff(F.col(date), F.lag(date).over(w)) > 1).cast("int"), F.lit(1))
    part = part.withColumn("__stretch", F.sum(begins).over(w)).withColumn("__metric", F.col("metric"))
    part = part.withColumn("metric", F.concat_ws("#", "metric", "__stretch"))
    fresh = rolling_scores(part, lookback, min_history, date).withColumn("metric", F.col("__metric"))
    fresh = fresh.join(touched, ["metric", date], "left_semi").select(*[c for c in scores.columns])
    kept = scores.join(touched, ["metric", date], "left_anti").unionByName(fresh)
    spread = long.groupBy("metric").agg(F.stddev_pop("value").alias("__fb"))
    kept = kept.drop("scale", "robust_z").join(spread, "metric")
    fb = F.when(F.col("__fb").isNull() | F.isnan("__fb") | (F.col("__fb") == 0), F.lit(1e-6)).otherwise(F.col("__fb"))
    kept = kept.withColumn("scale", F.coalesce(F.nullif(F.lit(MAD_SCALE) * F.col("rolling_mad"), F.lit(0.0)), fb))
    return kept.withColumn("robust_z", (F.col("value") - F.col("baseline_median")) / F.col("scale")).select(*scores.columns)


def detect(scores: DataFrame, threshold: float = Z_THRESHOLD, prefix: str = "CASE",
           date: str = "metric_date") -> DataFrame:
    """AN-05..AN-07: directional filter, deltas, severity and global case ids (Q25)."""
    z = F.col("robust_z")
    adverse = (((F.col("adverse_direction") == "high") & (z >= threshold))
               | ((F.col("adverse_direction") == "low") & (z <= -threshold)))
    a = scores.filter(z.isNotNull() & F.col("baseline_median").isNotNull() & F.col("value").isNotNull() & adverse)
    delta = F.col("value") - F.col("baseline_median")
    a = a.select(
        date, "metric", "adverse_direction", F.col("value").alias("observed_value"), "baseline_median",
        delta.alias("absolute_delta"),
        F.when(F.col("baseline_median") != 0, delta / F.col("baseline_median")).otherwise(F.lit(0.0)).alias("relative_delta"),
        "robust_z",
        F.when(F.abs(z) >= 7, "critical").when(F.abs(z) >= 5, "high").otherwise("medium").alias("severity"))
    order = F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "high", 2).otherwise(3)
    # anomalies are few (bounded by metrics x days): a global ordering is fine here
    n = F.row_number().over(Window.orderBy(order, F.col(date), F.col("metric")))
    return a.withColumn("case_id", F.concat(F.lit(prefix + "-"), F.date_format(date, "yyyyMMdd"), F.lit("-"),
                                            F.format_string("%03d", n)))


SEGMENT_SUMS = ["sessions", "booked", "searches", "bookings", "zero_results", "latency", "cancellations", "refunds",
                "value"]


def _sums(prefix: str = "") -> list[Column]:
    return [F.count(F.lit(1)).alias(prefix + "sessions"), F.sum("booked_flag").alias(prefix + "booked"),
            F.sum("search_count").alias(prefix + "searches"), F.sum("booking_count").alias(prefix + "bookings"),
            F.sum("zero_result_searches").alias(prefix + "zero_results"),
            F.sum("total_search_latency_ms").alias(prefix + "latency"),
            F.sum("cancellations").alias(prefix + "cancellations"), F.sum("refunds").alias(prefix + "refunds"),
            money_sum("successful_booking_value").alias(prefix + "value")]


def _resums() -> list[Column]:
    """Sums of what ``_sums`` has counted, over a coarser grain."""
    return [(money_sum if c == "value" else F.sum)(c).alias(c) for c in SEGMENT_SUMS]


def metric_value(metric: Column, p: str = "") -> Column:
    """AN-08: the seven metrics from segment sums; NULL when the denominator is 0."""
    def ratio(n, d):
        return F.when(F.col(p + d) != 0, F.col(p + n).cast("double") / F.col(p + d))
    return (F.when(metric == "session_booking_conversion", ratio("booked", "sessions"))
            .when(metric == "search_to_book_conversion", ratio("bookings", "searches"))
            .when(metric == "no_result_rate", ratio("zero_results", "searches"))
            .when(metric == "avg_search_latency_ms", ratio("latency", "searches"))
            .when(metric == "cancellation_rate", ratio("cancellations", "bookings"))
            .when(metric == "refund_rate", ratio("refunds", "bookings"))
            .when(metric == "successful_booking_value_per_active_partner", ratio("value", "partners")))


def segment_metrics(fact: DataFrame, dimensions: Sequence[str] = DRIVER_DIMENSIONS,
                    metrics: Sequence[str] = tuple(METRIC_RULES)) -> DataFrame:
    """AN-08 over whole segments: all metrics from one aggregate, then long."""
    cols = [F.col(d).cast("string").alias(d) for d in dimensions]
    rolled = fact.withColumns(dict(zip(dimensions, cols))).groupBy(*dimensions, "partner_id").agg(*_sums())
    long = rolled.unpivot(["partner_id", *SEGMENT_SUMS], list(dimensions), "dimension", "segment")
    agg = long.filter(F.col("segment").isNotNull()).groupBy("dimension", "segment").agg(
        *_resums(), F.count_distinct("partner_id").alias("partners"))
    ms = F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric")
    return agg.select("dimension", "segment", ms, *agg.columns[2:]).select(
        "dimension", "segment", "metric", metric_value(F.col("metric")).alias("metric_value"))


def _exploded(anomalies: DataFrame, lookback: int, date: str) -> DataFrame:
    # rows <= anomalies x (lookback + 1); anomalies are bounded by metrics x days
    a = anomalies.select("case_id", "metric", "adverse_direction", F.col(date).alias("__d"))
    a = a.withColumn("session_date", F.explode(F.sequence(F.date_sub("__d", lookback), F.col("__d"))))
    return F.broadcast(a.withColumn("__current", F.col("session_date") == F.col("__d")))


def primary_driver(anomalies: DataFrame, fact: DataFrame, dimensions: Sequence[str] = DRIVER_DIMENSIONS,
                   lookback: int = LOOKBACK, min_current: int = 5, min_baseline: int = 20,
                   date: str = "metric_date") -> DataFrame:
    """AN-09: largest adverse gap of a segment, current day vs the prior ``lookback`` days.

    Calendar days here (Q5).  Ties: dimension order, then level (Q20).
    Anomalies without any fact rows get ``none/no_data``; with rows but no
    eligible segment ``none/insufficient_segment_data``.
    """
    cols = [F.col(d).cast("string").alias(d) for d in dimensions]
    ex = _exploded(anomalies, lookback, date)
    needed = F.broadcast(ex.select("session_date").distinct())   # <= anomalies x (lookback + 1) dates
    base = fact.join(needed, "session_date", "left_semi").select(
        "session_date", "partner_id", "booked_flag", "search_count", "booking_count",
        "zero_result_searches", "total_search_latency_ms", "cancellations", "refunds",
        "successful_booking_value", *cols)
    # units are summed once to (date, levels, entity) and only those sums are unpivoted;
    # the entity is kept for the distinct-based metric
    rolled = base.groupBy("session_date", *dimensions, "partner_id").agg(*_sums())
    long = rolled.unpivot(["session_date", "partner_id", *SEGMENT_SUMS], list(dimensions), "dimension", "segment")
    pre = long.filter(F.col("segment").isNotNull()).groupBy("session_date", "dimension", "segment", "partner_id").agg(*_resums())
    j = pre.join(ex, "session_date")

    def side(cond, p):
        return [(money_sum if c == "value" else F.sum)(F.when(cond, F.col(c))).alias(p + c) for c in SEGMENT_SUMS] + [
            F.count_distinct(F.when(cond, F.col("partner_id"))).alias(p + "partners")]
    seg = j.groupBy("case_id", "metric", "adverse_direction", "dimension", "segment").agg(
        *side(F.col("__current"), "cur_"), *side(~F.col("__current"), "base_"))
    seg = seg.filter((F.coalesce(F.col("cur_sessions"), F.lit(0)) >= min_current)
                     & (F.coalesce(F.col("base_sessions"), F.lit(0)) >= min_baseline))
    cur = metric_value(F.col("metric"), "cur_")
    bas = metric_value(F.col("metric"), "base_")
    seg = seg.withColumns({"current_value": cur, "baseline_value": bas})
    gap = F.when(F.col("adverse_direction") == "high", F.col("current_value") - F.col("baseline_value")).otherwise(
        F.col("baseline_value") - F.col("current_value"))
    seg = seg.withColumn("adverse_gap", gap).filter(F.col("adverse_gap").isNotNull() & ~F.isnan("adverse_gap"))
    dim_idx = F.array_position(F.array(*[F.lit(d) for d in dimensions]), F.col("dimension"))
    best = seg.withColumn("__rn", F.row_number().over(
        Window.partitionBy("case_id").orderBy(F.col("adverse_gap").desc(), dim_idx, F.col("segment"))))
    best = best.filter("__rn = 1").select(
        "case_id", "dimension", "segment", "current_value", "baseline_value", "adverse_gap",
        F.col("cur_sessions").alias("current_sessions"), F.col("base_sessions").alias("baseline_sessions"))
    dates = fact.select("session_date").join(needed, "session_date", "left_semi").distinct()     # one column, not the sums again
    has_data = dates.join(ex, "session_date").select("case_id").distinct().withColumn(
        "__has", F.lit(True))
    out = anomalies.select("case_id").join(best, "case_id", "left").join(has_data, "case_id", "left")
    fill_dim = F.when(F.col("dimension").isNull(), F.lit("none")).otherwise(F.col("dimension"))
    fill_seg = F.when(F.col("dimension").isNotNull(), F.col("segment")).when(
        F.col("__has").isNull(), F.lit("no_data")).otherwise(F.lit("insufficient_segment_data"))
    return out.select("case_id", fill_dim.alias("dimension"), fill_seg.alias("segment"), "current_value",
                      "baseline_value", "adverse_gap", "current_sessions", "baseline_sessions")


def top_partners(anomalies: DataFrame, fact: DataFrame, k: int = 5, date: str = "metric_date") -> DataFrame:
    """AN-10: top-k entities of the anomaly day by units, ties by id."""
    days = F.broadcast(anomalies.select(F.col(date).alias("session_date")).distinct())
    per = fact.join(days, "session_date", "left_semi").groupBy("session_date", "partner_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.avg(F.col("booked_flag").cast("double")).alias("session_booking_conversion"),
        F.try_divide(F.sum("zero_result_searches").cast("double"), F.sum("search_count").cast("double")).alias("no_result_rate"),
        money_sum("successful_booking_value").alias("successful_booking_value"))
    a = F.broadcast(anomalies.select("case_id", F.col(date).alias("session_date")))
    j = per.join(a, "session_date")
    j = j.withColumn("context_rank", F.row_number().over(
        Window.partitionBy("case_id").orderBy(F.col("sessions").desc(), F.col("partner_id"))).cast("bigint"))
    return j.filter(F.col("context_rank") <= k).drop("session_date")


def top_routes(anomalies: DataFrame, search_fact: DataFrame, k: int = 5, date: str = "metric_date") -> DataFrame:
    """AN-11: top-k routes of the anomaly day by items."""
    days = F.broadcast(anomalies.select(F.col(date).alias("search_date")).distinct())
    per = search_fact.join(days, "search_date", "left_semi").groupBy(
        "search_date", "origin_station_id", "destination_station_id").agg(
        F.count(F.lit(1)).alias("searches"), F.sum("booked_flag").alias("booked_searches"),
        F.avg(F.col("no_result_flag").cast("double")).alias("no_result_rate"),
        F.avg(F.col("search_latency_ms").cast("double")).alias("avg_search_latency_ms"))
    a = F.broadcast(anomalies.select("case_id", F.col(date).alias("search_date")))
    j = per.join(a, "search_date")
    j = j.withColumn("context_rank", F.row_number().over(
        Window.partitionBy("case_id").orderBy(F.col("searches").desc(), F.col("origin_station_id"),
                                              F.col("destination_station_id"))).cast("bigint"))
    return j.filter(F.col("context_rank") <= k).drop("search_date")


def metric_lookup(spark, metrics: Sequence[str] = tuple(METRIC_RULES)) -> DataFrame:
    """AN-12: metric -> owner and hypotheses, plus a default row (metric NULL)."""
    rows = [(m, OWNERS.get(m, DEFAULT_OWNER), HYPOTHESES.get(m, DEFAULT_HYPOTHESES)) for m in metrics]
    rows.append((None, DEFAULT_OWNER, DEFAULT_HYPOTHESES))
    return spark.createDataFrame(rows, "metric string, recommended_owner string, hypotheses array<string>")


def enrich_lookup(anomalies: DataFrame, lookup: DataFrame) -> DataFrame:
    """AN-12 join: known metrics get their row, unknown ones the default row."""
    known = F.broadcast(lookup.filter(F.col("metric").isNotNull()))
    default = F.broadcast(lookup.filter(F.col("metric").isNull()).select(
        F.col("recommended_owner").alias("__do"), F.col("hypotheses").alias("__dh")))
    j = anomalies.join(known, "metric", "left").crossJoin(default)
    return j.withColumns({"recommended_owner": F.coalesce("recommended_owner", "__do"),
                          "hypotheses": F.coalesce("hypotheses", "__dh")}).drop("__do", "__dh")


def case_register(anomalies: DataFrame, driver: DataFrame, lookup: DataFrame, date: str = "metric_date") -> DataFrame:
    """AN-13 (flat): one row per case, human review always required."""
    a = enrich_lookup(anomalies, lookup).join(driver, "case_id", "left")
    return a.select("case_id", date, "metric", "severity", "robust_z", "observed_value", "baseline_median",
                    F.col("dimension").alias("primary_driver_dimension"),
                    F.col("segment").alias("primary_driver_segment"), "recommended_owner",
                    F.lit(True).alias("human_review_required"))


def evidence_packets(anomalies: DataFrame, driver: DataFrame, partners: DataFrame, routes: DataFrame,
                     lookup: DataFrame, date: str = "metric_date", classification: str = "unclassified") -> DataFrame:
    """AN-13 (nested): evidence packet per case as a struct and its JSON text.

    ``classification`` states what kind of data the packets hold.
    """
    pc = partners.groupBy("case_id").agg(F.sort_array(F.collect_list(F.struct(
        "context_rank", "partner_id", "sessions", "searches", "bookings", "session_booking_conversion",
        "no_result_rate", "successful_booking_value"))).alias("top_partner_context"))
    rc = routes.groupBy("case_id").agg(F.sort_array(F.collect_list(F.struct(
        "context_rank", "origin_station_id", "destination_station_id", "searches", "booked_searches",
        "no_result_rate", "avg_search_latency_ms"))).alias("top_route_context"))
    a = enrich_lookup(anomalies, lookup).join(driver, "case_id", "left").join(pc, "case_id", "left").join(
        rc, "case_id", "left")
    packet = F.struct(
        F.col("case_id"), F.lit(classification).alias("data_classification"),
        F.date_format(date, "yyyy-MM-dd").alias("metric_date"), F.col("metric"), F.col("severity"),
        F.struct("observed_value", "baseline_median", "absolute_delta", "relative_delta", "robust_z").alias("observation"),
        F.struct("dimension", "segment", "current_value", "baseline_value", "adverse_gap").alias("primary_segment_driver"),
        F.coalesce("top_partner_context", F.array()).alias("top_partner_context"),
        F.coalesce("top_route_context", F.array()).alias("top_route_context"),
        F.col("hypotheses").alias("hypotheses_to_test"), F.col("recommended_owner"),
        F.lit(True).alias("human_review_required"),
        F.struct(F.lit(True).alias("observations_are_facts"), F.lit(True).alias("hypotheses_are_not_causal_claims"),
                 F.lit(True).alias("do_not_invent_missing_evidence")).alias("reasoning_policy"))
    return a.select("case_id", packet.alias("packet")).withColumn("packet_json", F.to_json("packet"))


def detection_summary(anomalies: DataFrame) -> DataFrame:
    """AN-14: cases per severity (all three levels) and the first case in queue order."""
    sev = anomalies.sparkSession.createDataFrame([(k, v) for k, v in SEVERITY_ORDER.items()],
                                                 "severity string, severity_order int")
    counts = anomalies.groupBy("severity").agg(F.count(F.lit(1)).alias("cases"))
    out = F.broadcast(sev).join(counts, "severity", "left").fillna(0, subset=["cases"])
    top = anomalies.agg(F.min_by("case_id", F.struct(
        F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "high", 2).otherwise(3),
        F.abs("robust_z") * -1, F.col("case_id"))).alias("top_case_id"))
    return out.crossJoin(top)
