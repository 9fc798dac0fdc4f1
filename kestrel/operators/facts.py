"""Fact building: successful value, item fact, unit fact, first item (FC-01..07).

Scale notes: outcomes are aggregated to the join key *before* joining
(FC-02, FC-04) so joins never fan out, and both rollups are grouped by the
same key as the following join, so Spark reuses the hash partitioning
(one shuffle per input, no extra exchange for the join itself).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.core import money_sum
from kestrel.operators.gates import Gate

OUTCOME_MEASURES = ["booking_count", "booking_value", "successful_booking_value",
                    "platform_revenue", "cancellations", "refunds"]


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                 cardinality: str = "many_to_one", validate: bool = False) -> DataFrame:
    """Equi-join with an optional cardinality assertion (IN-12).

    ``validate=True`` runs one aggregate for each side that must be unique and raises on violation.
    It is an action of its own; builds that write a table watch the rows before and after their
    joins inside the writing job instead (`gates.Gate.kept`).
    """
    if validate:
        sides = {"many_to_one": [right], "one_to_one": [left, right], "one_to_many": [left]}[cardinality]
        for side in sides:
            dup = side.groupBy(*on).count().filter(F.col("count") > 1).limit(1).count()
            if dup:
                raise ValueError(f"join keys {list(on)} are not unique ({cardinality})")
    return left.join(right, list(on), how)


def add_successful_value(bookings: DataFrame, value: str = "booking_value",
                         cancelled: str = "cancelled_flag", refunded: str = "refund_flag",
                         out: str = "successful_booking_value") -> DataFrame:
    """FC-01: keep the value only when neither cancelled nor refunded."""
    ok = (F.col(cancelled) == 0) & (F.col(refunded) == 0)
    return bookings.withColumn(out, F.when(ok, F.col(value)).otherwise(F.lit(0.0)).cast("double"))


def outcome_rollup(bookings: DataFrame, *keys: str) -> DataFrame:
    """FC-02: count and five sums of outcomes per ``keys``."""
    b = add_successful_value(bookings)
    return b.groupBy(*keys).agg(
        F.count("booking_id").alias("booking_count"),
        money_sum("booking_value").alias("booking_value"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
        F.sum("cancelled_flag").alias("cancellations"),
        F.sum("refund_flag").alias("refunds"),
    )


def _calendar(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    d = F.to_date(F.col(ts))
    return df.withColumns({
        f"{prefix}_date": d,
        f"{prefix}_week": F.trunc(d, "week"),     # Monday start
        f"{prefix}_month": F.trunc(d, "month"),
    })


def build_search_fact(searches: DataFrame, sessions: DataFrame, bookings: DataFrame,
                      validate: bool = False, gate: Gate | None = None, by_session: bool = False) -> DataFrame:
    """FC-03: item fact = items + unit attributes + per-item outcome rollup.

    ``gate`` watches that the joins neither lose nor multiply items.  With ``by_session`` outcomes are matched
    on (session, item) instead of the item alone, so that inputs bucketed by session need no exchange; right
    when every outcome names the session of its item (`fact_tables` sees to that).
    """
    if gate:
        searches = gate.rows(searches, "items")
    attrs = sessions.select("session_id", "partner_id", "device_type", "acquisition_channel",
                            "is_logged_in", "traveller_type")
    fact = checked_join(searches, attrs, ["session_id", "partner_id"], "left", "many_to_one", validate)
    on = ["session_id", "search_id"] if by_session else ["search_id"]
    fact = checked_join(fact, outcome_rollup(bookings, *on), on, "left", "one_to_one", validate)
    if gate:
        fact = gate.kept(fact, "item fact", "items")
    fact = fact.fillna(0, subset=["booking_count", "cancellations", "refunds"]).fillna(
        0.0, subset=["booking_value", "successful_booking_value", "platform_revenue"])
    fact = fact.withColumn("booked_flag", (F.col("booking_count") > 0).cast("bigint"))
    return _calendar(fact, "search_ts", "search")


def item_rollup(searches: DataFrame, key: str = "session_id") -> DataFrame:
    """FC-04: items rolled up to unit grain (count, sums, mean latency)."""
    return searches.groupBy(key).agg(
        F.count("search_id").alias("search_count"),
        F.sum("no_result_flag").alias("zero_result_searches"),
        F.sum("selected_flag").alias("selected_searches"),
        F.sum("alternatives_shown").alias("alternatives_shown_count"),
        F.sum("search_latency_ms").alias("total_search_latency_ms"),
        F.avg("search_latency_ms").alias("avg_search_latency_ms"),
    )


UNIT_MEASURES = ["search_count", "zero_result_searches", "selected_searches",
                 "alternatives_shown_count", "total_search_latency_ms", "avg_search_latency_ms",
                 *OUTCOME_MEASURES]


def build_session_fact(sessions: DataFrame, searches: DataFrame, bookings: DataFrame,
                       validate: bool = False, gate: Gate | None = None) -> DataFrame:
    """FC-05: unit fact = units + item rollup + outcome rollup, zero filled.

    ``avg_search_latency_ms`` is zero filled too (reference behaviour).  ``gate`` watches that the joins neither
    lose nor multiply units.
    """
    if gate:
        sessions = gate.rows(sessions, "units")
    fact = checked_join(sessions, item_rollup(searches), ["session_id"], "left", "one_to_one", validate)
    fact = checked_join(fact, outcome_rollup(bookings, "session_id"), ["session_id"], "left",
                        "one_to_one", validate)
    if gate:
        fact = gate.kept(fact, "unit fact", "units")
    longs = ["search_count", "zero_result_searches", "selected_searches", "alternatives_shown_count",
             "total_search_latency_ms", "booking_count", "cancellations", "refunds"]
    doubles = ["avg_search_latency_ms", "booking_value", "successful_booking_value", "platform_revenue"]
    fact = fact.fillna(0, subset=longs).fillna(0.0, subset=doubles)
    fact = fact.withColumn("booked_flag", (F.col("booking_count") > 0).cast("bigint"))
    return _calendar(fact, "session_ts", "session")


def first_per_group(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """FC-07: deterministic top-1 row per group (``row_number() = 1``).

    Catalyst turns the filter into a WindowGroupLimit, so each task keeps
    only the current best row per group before the shuffle's sort.
    """
    w = Window.partitionBy(group).orderBy(*[F.col(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
