"""Domain views over the driver's TPC-H-like test tables.

Operators are written against six domain tables (partners, stations,
sessions, searches, bookings, partner_events).  This module binds them to
the test tables; the same mapping is restated in DuckDB SQL in
``kestrel.plans.oracle`` so results can be compared.

Mapping (fixed values, must equal the oracle's):
  partner   = customer; type = c_mktsegment, country = nation name,
              integration_type = region name, tier by c_acctbal
              (< 2000 Growth, < 6000 Scale, else Enterprise),
              launch_date = first day of the month of the first order
  station   = nation; country = region name,
              latitude = -48 + 4 * key, longitude = -150 + 12 * key
  session   = orders; device = o_orderpriority, traveller = o_orderstatus,
              channel = 'channel_' || (o_orderkey % 4),
              logged in = o_orderkey % 3 <> 0,
              experiment 'checkout_test' in 1998: even key control, odd variant
  search    = lineitem (joined to its order); origin = supplier nation,
              destination = customer nation, no result = returnflag 'R',
              selected = not 'R' and linestatus 'O', latency = l_quantity
  booking   = search with returnflag 'N' and linestatus 'O';
              value = round(extendedprice * (1 - discount), 2),
              revenue = round(value * tax, 2), cancelled = tax >= 0.07,
              refunded = cancelled and discount >= 0.05
  partner_events = events with signup/view/click/error renamed to
              contract_signed/api_key_created/integration_test/webhook_configured
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.tables import Tables

EXPERIMENT_NAME = "checkout_test"
EXPERIMENT_YEAR = 1998
EXPERIMENT_START = "1998-01-01 00:00:00"
EXPERIMENT_END = "1999-01-01 00:00:00"   # half-open
OBSERVATION_END = "2001-08-01 23:59:59"
EVENT_RENAMES = {
    "signup": "contract_signed",
    "view": "api_key_created",
    "click": "integration_test",
    "error": "webhook_configured",
}


def _money(expr: Column) -> Column:
    """Exact 2-dp rounding (decimal arithmetic), stored as double."""
    return F.round(expr, 2).cast("double")


def _dec(c: str, p: int, s: int) -> Column:
    return F.col(c).cast(f"decimal({p},{s})")


@dataclass
class DomainViews:
    partners: DataFrame
    stations: DataFrame
    sessions: DataFrame
    searches: DataFrame
    bookings: DataFrame
    partner_events: DataFrame
    raw_searches: DataFrame     # searches with BOOKING_COLUMNS


def nation_region(t: Tables) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H spec
    return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")


def partners_view(t: Tables) -> DataFrame:
    first_order = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("__first"))
    nr = F.broadcast(nation_region(t).select("n_nationkey", "n_name", "r_name"))
    c = t.customer.join(nr, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    c = c.join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(
        F.col("c_custkey").alias("partner_id"),
        F.col("c_mktsegment").alias("partner_type"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("integration_type"),
        F.when(F.col("c_acctbal") < 2000, "Growth").when(F.col("c_acctbal") < 6000, "Scale")
         .otherwise("Enterprise").alias("contract_tier"),
        F.trunc(F.to_date("__first"), "month").cast("timestamp_ntz").alias("launch_date"),
        F.col("r_name").alias("account_manager_region"),
        F.col("c_acctbal").alias("traffic_weight"),
    )


def stations_view(t: Tables) -> DataFrame:
    return nation_region(t).select(
        F.col("n_nationkey").cast("bigint").alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        (F.lit(-48.0) + F.lit(4.0) * F.col("n_nationkey")).alias("latitude"),
        (F.lit(-150.0) + F.lit(12.0) * F.col("n_nationkey")).alias("longitude"),
        F.lit(1.0).alias("hub_weight"),
    )


def _variant(key: Column, ts: Column) -> Column:
    in_window = F.year(ts) == EXPERIMENT_YEAR
    return F.when(in_window, F.when(key % 2 == 0, "control").otherwise("variant")).otherwise("not_eligible")


def sessions_view(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("session_id"),
        F.col("o_custkey").alias("partner_id"),
        F.col("o_orderdate").alias("session_ts"),
        F.col("o_orderpriority").alias("device_type"),
        F.concat(F.lit("channel_"), (F.col("o_orderkey") % 4).cast("string")).alias("acquisition_channel"),
        (F.col("o_orderkey") % 3 != 0).alias("is_logged_in"),
        F.col("o_orderstatus").alias("traveller_type"),
        F.when(F.year("o_orderdate") == EXPERIMENT_YEAR, F.lit(EXPERIMENT_NAME))
         .otherwise(F.lit("not_eligible")).alias("experiment_name"),
        _variant(F.col("o_orderkey"), F.col("o_orderdate")).alias("experiment_variant"),
    )


def searches_view(t: Tables) -> DataFrame:
    # order-grain attributes first (orders-sized join), then the lineitem joins
    oc = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    li = t.lineitem.join(oc, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    li = li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    no_result = F.col("l_returnflag") == "R"
    search_id = F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"))
    return li.select(
        search_id.alias("search_id"),
        F.col("l_orderkey").alias("session_id"),
        F.col("o_custkey").alias("partner_id"),
        F.col("l_shipdate").alias("search_ts"),
        F.col("s_nationkey").cast("bigint").alias("origin_station_id"),
        F.col("c_nationkey").cast("bigint").alias("destination_station_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "Return").otherwise("Single").alias("journey_type"),
        F.col("l_linenumber").cast("bigint").alias("passengers"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("bigint").alias("days_before_travel"),
        F.when(no_result, F.lit(0)).otherwise(F.col("l_partkey") % 25 + 1).cast("bigint").alias("result_count"),
        no_result.cast("bigint").alias("no_result_flag"),
        F.col("l_quantity").cast("bigint").alias("search_latency_ms"),
        (F.col("l_suppkey") % 4).cast("bigint").alias("alternatives_shown"),
        ((~no_result) & (F.col("l_linestatus") == "O")).cast("bigint").alias("selected_flag"),
        _variant(F.col("l_orderkey"), F.col("o_orderdate")).alias("experiment_variant"),
        *BOOKING_COLUMNS,
    )


SEARCH_COLUMNS = ["search_id", "session_id", "partner_id", "search_ts", "origin_station_id",
                  "destination_station_id", "journey_type", "passengers", "days_before_travel",
                  "result_count", "no_result_flag", "search_latency_ms", "alternatives_shown",
                  "selected_flag", "experiment_variant"]
#: What a search carries for the booking view only.
BOOKING_COLUMNS = ["l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_tax"]


def bookings_view(raw_searches: DataFrame) -> DataFrame:
    booked = raw_searches.filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
    value = F.round(_dec("l_extendedprice", 12, 2) * (F.lit(1) - _dec("l_discount", 4, 2)), 2)
    cancelled = F.col("l_tax") >= 0.07
    return booked.select(
        F.col("search_id").alias("booking_id"),
        "search_id", "session_id", "partner_id",
        F.col("search_ts").alias("booking_ts"),
        value.cast("double").alias("booking_value"),
        _money(value * _dec("l_tax", 4, 2)).alias("platform_revenue"),
        cancelled.cast("bigint").alias("cancelled_flag"),
        (cancelled & (F.col("l_discount") >= 0.05)).cast("bigint").alias("refund_flag"),
        "experiment_variant",
    )


def partner_events_view(t: Tables) -> DataFrame:
    mapping = None
    for src, dst in EVENT_RENAMES.items():
        cond = F.col("event_type") == src
        mapping = F.when(cond, dst) if mapping is None else mapping.when(cond, dst)
    return t.events.select(
        F.col("user_id").alias("partner_id"),
        F.col("ts").alias("event_ts"),
        mapping.otherwise(F.col("event_type")).alias("event_type"),
    )


def domain_views(spark: SparkSession, base: str) -> DomainViews:
    t = Tables(spark, base)
    # searches and bookings derive from the same 4-way join; it is not cached: whole rows would fill memory and disk
    # beside the tables that facts are written to, while a reader of the join needs a few columns or a part of the rows
    raw = searches_view(t)
    return DomainViews(
        partners=partners_view(t),
        stations=stations_view(t),
        sessions=sessions_view(t),
        searches=raw.select(*SEARCH_COLUMNS),
        bookings=bookings_view(raw),
        partner_events=partner_events_view(t),
        raw_searches=raw,
    )
