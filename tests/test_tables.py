"""Tables that are replaced whole, gates inside the writing job, facts without repeated exchanges."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from test_facts_sinks import _frames

from kestrel.operators import facts, gates
from kestrel.sources import fact_tables, versions


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    for n in (3, 5):
        versions.publish(spark, path, lambda folder, n=n: spark.range(n).write.parquet(folder))
    assert [v.number for v in versions.versions(spark, path)] == [1, 2]
    assert versions.read(spark, path).count() == 5
    versions.publish(spark, path, lambda folder: spark.range(7).write.parquet(folder))
    assert len(versions.clean(spark, path, keep=1)) == 2
    assert versions.read(spark, path).count() == 7


def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark, path, lambda folder: spark.range(4).write.parquet(folder))

    def dies(batches):
        for b in batches:
            if b.column(0)[0].as_py() > 50:
                raise RuntimeError("lost")
            yield b
    with pytest.raises(Exception, match="lost"):
        versions.publish(spark, path, lambda folder: spark.range(0, 100, 1, 8).mapInArrow(dies, "id long").write.parquet(folder))
    assert versions.read(spark, path).count() == 4
    # a manifest that was cut short does not count either
    good = versions.current(spark, path)
    with open(os.path.join(path, versions.MANIFESTS, "2.json"), "w") as f:
        f.write('{"data": "data-2-x", "fac')
    assert versions.current(spark, path) == good
    versions.publish(spark, path, lambda folder: spark.range(6).write.parquet(folder))
    assert versions.current(spark, path).number == 3 and versions.read(spark, path).count() == 6
    assert len(versions.clean(spark, path, keep=1)) >= 1 and versions.read(spark, path).count() == 6


def test_two_writers_cannot_commit_one_version(spark, tmp_path):
    path = str(tmp_path / "t")

    def slow(folder):
        spark.range(1).write.parquet(folder)
        versions.publish(spark, path, lambda f: spark.range(2).write.parquet(f))
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, slow)
    assert versions.read(spark, path).count() == 2


def test_a_fan_out_is_not_published(spark, tmp_path):
    sessions, searches, bookings = _frames(spark)
    path = str(tmp_path / "fact")
    gates.publish(spark, path, lambda g: facts.build_search_fact(searches, sessions, bookings, gate=g))
    assert versions.current(spark, path).facts == {"rows": 3}
    twice = sessions.unionByName(sessions.limit(1))
    for build in (lambda g: facts.build_search_fact(searches, twice, bookings, gate=g),):
        with pytest.raises(gates.GateFailed, match="as many rows"):
            gates.publish(spark, path, build)
    assert versions.read(spark, path).count() == 3


def test_a_mart_that_breaks_its_contract_is_not_published(spark, tmp_path):
    path = str(tmp_path / "mart")
    good = [(1, 0.5, 0.1, 0.2, 0.04, 1.0), (2, None, None, None, None, 2.0)]
    columns = "opportunity_rank long, no_result_rate double, ci_low double, ci_high double, p_value double, market_opportunity_score double"

    def build(rows):
        df = spark.createDataFrame(rows, columns)
        return lambda g: g.contract(df, "mart", gates.conventions(df.columns))
    gates.publish(spark, path, build(good), unique=[["opportunity_rank"]])
    for column, value in ((1, 1.5), (2, 0.3), (4, -0.1), (5, float("nan")), (5, float("inf"))):
        bad = [list(r) for r in good]
        bad[0][column] = value
        with pytest.raises(gates.GateFailed):
            gates.publish(spark, path, build([tuple(r) for r in bad]))
    with pytest.raises(gates.GateFailed, match="unique"):
        gates.publish(spark, path, build([good[0], good[0]]), unique=[["opportunity_rank"]])
    assert versions.current(spark, path).number == 1


def test_gates_need_no_scan_of_their_own(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches
    src = spark.range(0, 10, 1, 1).mapInArrow(count, "id long").withColumn("x_rate", F.lit(0.5))
    gates.publish(spark, str(tmp_path / "t"), lambda g: g.contract(g.kept(g.rows(src, "a"), "b", "a"), "t", gates.conventions(src.columns)))
    assert runs.value == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_are_exchanged_once(spark):
    from kestrel.sources.views import domain_views
    v = domain_views(spark, "/root/testdata/sf0.001")
    t = fact_tables.deal(v.sessions, v.searches, v.bookings)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with fact_tables.co_partitioned(spark):
            # dealing them was the one exchange: neither fact nor rollup needs another
            for plan in (_plan(fact_tables.item_fact_plan(t)), _plan(facts.build_session_fact(t.units, t.items, t.outcomes)),
                         _plan(facts.item_rollup(t.items))):
                assert "Exchange" not in plan and len(re.findall("Bucketed: true", plan)) >= 1
        got = fact_tables.item_fact(t)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = facts.build_search_fact(v.searches, v.sessions, v.bookings).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    units = fact_tables.unit_fact(t)
    want = facts.build_session_fact(v.sessions, v.searches, v.bookings).select(*units.columns)
    assert sorted(map(str, units.collect())) == sorted(map(str, want.collect()))


def test_outcomes_of_another_session_and_hot_sessions(spark):
    sessions, searches, bookings = _frames(spark)
    ts = dt.datetime(2024, 1, 3, 10, 0)
    strange = bookings.unionByName(spark.createDataFrame([("b3", "s2", 3, 20, ts, 7.0, 1.0, 0, 0)], bookings.schema))
    t = fact_tables.deal(sessions, searches, strange)
    got = fact_tables.item_fact(t)
    want = facts.build_search_fact(searches, sessions, strange).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("search_id = 's2'").first().booking_count == 1
    hot = searches.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).withColumn("search_id", F.concat("search_id", F.lit("-"), "n")).drop("n")
    t = fact_tables.deal(sessions, hot.where("session_id = 1"), bookings, hot=2, hot_rows=10)
    assert "Bucketed: true" not in _plan(facts.item_rollup(t.items))
    assert fact_tables.item_fact(t).count() == 80


def test_raw_rows_are_not_cached_beside_the_tables(spark):
    from kestrel.sources.views import domain_views
    v = domain_views(spark, "/root/testdata/sf0.001")
    for df in (v.searches, v.bookings):
        assert "InMemoryTableScan" not in _plan(df.select("search_id"))
    by_partner = _plan(v.searches.groupBy("partner_id").agg(F.min("search_ts")))
    assert "l_extendedprice" not in by_partner and "date_format" not in by_partner


def test_buckets_grow_with_the_items(spark):
    """A bucket is sorted by one task: a number of them fixed by the session's partitions spills at 60 times sf0.1."""
    from kestrel.sources.views import BOOKING_COLUMNS, bookings_view, domain_views
    v = domain_views(spark, "/root/testdata/sf0.001")
    n, partitions = v.searches.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = fact_tables.deal(v.sessions, v.raw_searches, bookings_view, rows=n, bucket_rows=n // (4 * partitions), carried=BOOKING_COLUMNS)
    assert t.buckets >= 4 * partitions and spark.conf.get("spark.sql.shuffle.partitions") == str(partitions)
    assert fact_tables.deal(v.sessions, v.searches, v.bookings).buckets == partitions
    assert t.items.columns == v.searches.columns
    assert sorted(map(str, t.outcomes.collect())) == sorted(map(str, v.bookings.collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with fact_tables.co_partitioned(spark):
            for plan in (_plan(fact_tables.item_fact_plan(t)), _plan(facts.build_session_fact(t.units, t.items, t.outcomes))):
                assert "Exchange" not in plan and "Bucketed: true" in plan
        got, units = fact_tables.item_fact(t), fact_tables.unit_fact(t)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name in ("items", "units", "item_fact", "unit_fact"):       # a task writes its bucket alone
        assert len([f for f in os.listdir(f"{t.folder.removeprefix('file:')}/{name}") if f.endswith(".parquet")]) <= t.buckets
    want = facts.build_search_fact(v.searches, v.sessions, v.bookings).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    want = facts.build_session_fact(v.sessions, v.searches, v.bookings).select(*units.columns)
    assert sorted(map(str, units.collect())) == sorted(map(str, want.collect()))


def test_a_mart_that_reads_items_once_writes_no_fact(spark):
    from kestrel.operators import metrics
    from kestrel.plans.context import Context
    sf = "/root/testdata/sf0.001"
    c = Context(spark, sf)
    got = c.routes
    assert not {"dealt", "search_fact"} & set(c.__dict__)
    v = c.views
    want = metrics.route_performance(facts.build_search_fact(v.searches, v.sessions, v.bookings)).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    after = Context(spark, sf)
    assert after.search_fact and sorted(map(str, after.routes.collect())) == sorted(map(str, want.collect()))


def test_items_in_one_pass_by_session_or_by_item(spark):
    sessions, searches, bookings = _frames(spark)
    ts = dt.datetime(2024, 1, 3, 10, 0)
    strange = bookings.unionByName(spark.createDataFrame([("b3", "s2", 3, 20, ts, 7.0, 1.0, 0, 0)], bookings.schema))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for outcomes, hot, passes in ((bookings, {}, 1), (strange, {}, 2), (strange, {"hot": 0, "hot_rows": 1}, 1)):
        made = []

        def use(fact):
            made.append(fact.localCheckpoint())
            return made[-1]
        got = fact_tables.over_items(sessions, searches, outcomes, searches.select("session_id"), use, **hot)
        want = facts.build_search_fact(searches, sessions, outcomes).select(*got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert len(made) == passes and spark.conf.get("spark.sql.shuffle.partitions") == partitions
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    with pytest.raises(gates.GateFailed, match="item fact"):
        fact_tables.over_items(sessions.unionByName(sessions), searches, bookings, searches.select("session_id"), lambda f: f.localCheckpoint())


def test_what_is_about_units_alone_needs_no_items(spark):
    from kestrel.plans.context import Context
    from kestrel.plans.queries_ml import q_scored_units
    from kestrel.plans.registry import load_all
    load_all()
    c = Context(spark, "/root/testdata/sf0.001")
    got = q_scored_units(c)
    assert got.count() == c.cuped_data.count() > 0
    assert "search_fact" not in c.__dict__ and "Join" not in _plan(c.evaluated)
    pop = c.experiment
    assert list(pop) == ["session", "searches", "bookings", "preperiod"] and "search_fact" not in c.__dict__
    items = c.views.searches.where("experiment_variant IN ('control', 'variant') AND year(search_ts) = 1998").count()
    assert pop["searches"].count() == items and "search_fact" in c.__dict__
    sessions, searches, bookings = _frames(spark)
    fact_tables.judge_units(fact_tables.deal(sessions, searches, bookings))
    with pytest.raises(gates.GateFailed, match="item fact"):
        fact_tables.judge_units(fact_tables.deal(sessions.unionByName(sessions), searches, bookings))
