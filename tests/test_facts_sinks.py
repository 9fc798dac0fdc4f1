import datetime as dt
import json
import os
import tempfile

from kestrel.operators import facts, metrics
from kestrel.sources import sinks, versions


def _frames(spark):
    ts = dt.datetime(2024, 1, 3, 10, 0)
    sessions = spark.createDataFrame(
        [(1, 10, ts, "web", "Direct", True, "Leisure"), (2, 10, ts, "web", "CRM", False, "Business"),
         (3, 20, ts, "app", "Direct", True, "Leisure")],
        "session_id long, partner_id long, session_ts timestamp_ntz, device_type string, "
        "acquisition_channel string, is_logged_in boolean, traveller_type string")
    searches = spark.createDataFrame(
        [("s1", 1, 10, ts, 0, 1, 2, 100), ("s2", 1, 10, ts, 1, 0, 0, 300), ("s3", 3, 20, ts, 0, 1, 1, 50)],
        "search_id string, session_id long, partner_id long, search_ts timestamp_ntz, no_result_flag long, "
        "selected_flag long, alternatives_shown long, search_latency_ms long")
    bookings = spark.createDataFrame(
        [("b1", "s1", 1, 10, ts, 100.0, 5.0, 1, 1), ("b2", "s3", 3, 20, ts, 40.0, 2.0, 0, 0)],
        "booking_id string, search_id string, session_id long, partner_id long, booking_ts timestamp_ntz, "
        "booking_value double, platform_revenue double, cancelled_flag long, refund_flag long")
    return sessions, searches, bookings


def test_unit_fact_zero_fill_and_successful_value(spark):
    sessions, searches, bookings = _frames(spark)
    f = {r.session_id: r for r in facts.build_session_fact(sessions, searches, bookings, validate=True).collect()}
    assert f[2].search_count == 0 and f[2].avg_search_latency_ms == 0.0 and f[2].booked_flag == 0
    assert f[1].successful_booking_value == 0.0      # cancelled and refunded
    assert f[3].successful_booking_value == 40.0
    assert f[1].session_week == dt.date(2024, 1, 1)  # Monday start


def test_entity_without_activity_kept(spark):
    sessions, searches, bookings = _frames(spark)
    fact = facts.build_session_fact(sessions, searches, bookings)
    partners = spark.createDataFrame([(10, "t", "GB", "API", "Growth"), (30, "t", "FR", "API", "Scale")],
                                     "partner_id long, partner_type string, country string, integration_type string, "
                                     "contract_tier string")
    p = {r.partner_id: r for r in metrics.partner_performance(partners, fact).collect()}
    assert p[30].sessions == 0 and p[30].session_booking_conversion == 0.0
    assert p[10].sessions == 2 and p[10].booking_sessions == 1


def test_sinks_round_trip(spark):
    sessions, searches, bookings = _frames(spark)
    fact = facts.build_session_fact(sessions, searches, bookings)
    out = tempfile.mkdtemp(prefix="kestrel-sink-")
    sinks.write_table(fact, os.path.join(out, "t"), partition_by=["session_month"])
    assert versions.read(spark, os.path.join(out, "t")).count() == 3
    sinks.write_csv(fact, os.path.join(out, "c"))
    assert spark.read.option("header", True).csv(os.path.join(out, "c")).count() == 3
    sinks.write_json(fact, os.path.join(out, "j"))
    assert spark.read.json(os.path.join(out, "j")).count() == 3
    rec = sinks.records_json(fact.select("session_id", "session_date")).first().record
    assert json.loads(rec)["session_date"] == "2024-01-03"


def test_pipeline_stages_2_3_write_marts(spark):
    from kestrel.plans import pipeline
    out = tempfile.mkdtemp(prefix="kestrel-wh-")
    written = pipeline.run(spark, "/root/testdata/sf0.001", out, stages=(2, 3))
    assert "mart_stage3_partner_opportunities" in written and "fct_session_journey" in written
    assert spark.read.parquet(written["mart_daily_product_metrics"]).count() > 0
    opp = spark.read.parquet(written["mart_stage3_partner_opportunities"])
    assert opp.count() == opp.select("priority_rank").distinct().count()
