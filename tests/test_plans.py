"""Physical-plan properties the scale design relies on."""

from kestrel.plans.registry import load_all


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_and_filter_reach_the_scan(spark):
    p = _plan(load_all()["in02_projected_scan"].run(spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_rollups_aggregate_before_the_shuffle(spark):
    from kestrel.operators import facts
    from kestrel.sources.views import domain_views
    v = domain_views(spark, "/root/testdata/sf0.001")
    p = _plan(facts.build_session_fact(v.sessions, v.searches, v.bookings))
    assert "partial_count" in p and "partial_sum" in p


def test_first_item_is_group_limited(spark):
    from pyspark.sql import functions as F

    from kestrel.operators import facts
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), F.col("id").alias("v"))
    p = _plan(facts.first_per_group(df, "g", ["v"]))
    assert "WindowGroupLimit" in p


def test_results_do_not_depend_on_session_time_zone(spark):
    from kestrel.operators import growth
    from kestrel.sources.views import OBSERVATION_END, domain_views

    def run():
        v = domain_views(spark, "/root/testdata/sf0.001")
        ms = growth.derive_milestones(v.searches, v.bookings, v.partner_events)
        act = growth.partner_activation(v.partners, ms, OBSERVATION_END)
        return sorted(tuple(r) for r in act.select("partner_id", "activation_eligible_30d_flag",
                                                    "days_to_first_booking", "launch_date").collect())
    before = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        after = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after
