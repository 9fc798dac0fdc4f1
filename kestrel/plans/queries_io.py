"""Registered queries: scans (IN-01/02), safe ratio (FC-06) and sink round trips (IN-03/04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.core import safe_div
from kestrel.plans.queries_core import RATIOS6, ROLLUP_R2, rollup_sql, sql
from kestrel.plans.oracle_marts import sd
from kestrel.plans.registry import register
from kestrel.session import scratch_dir
from kestrel.sources import sinks, versions
from kestrel.sources.tables import TEST_TABLES, load_raw


@register("in01_raw_scan", ids=("IN-01",), sql=sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TEST_TABLES)))
def q_raw(c):
    frames = load_raw(c.spark, c.base)
    out = None
    for name, df in frames.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


@register("in02_projected_scan", ids=("IN-02",), sql=sql("""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"""))
def q_projected(c):
    # projection and range filter reach the parquet scan (ReadSchema / PushedFilters)
    o = c.tables.orders
    return o.select("o_orderkey", "o_custkey", "o_orderdate").filter(
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))


@register("fc06_safe_ratio", ids=("FC-06",), r6=("cancellations_per_booked_search", "booked_per_zero_result"),
          sql=sql(f"""
SELECT origin_station_id, destination_station_id,
       {sd('sum(cancellations)', 'sum(booked_flag)')} AS cancellations_per_booked_search,
       {sd('sum(booked_flag)', 'sum(no_result_flag)')} AS booked_per_zero_result
FROM fct_search GROUP BY origin_station_id, destination_station_id"""))
def q_safe(c):
    agg = c.search_fact.groupBy("origin_station_id", "destination_station_id").agg(
        F.sum("cancellations").alias("c"), F.sum("booked_flag").alias("b"), F.sum("no_result_flag").alias("z"))
    return agg.select("origin_station_id", "destination_station_id",
                      safe_div("c", "b").alias("cancellations_per_booked_search"),
                      safe_div("b", "z").alias("booked_per_zero_result"))


def _sink_path(c, kind: str) -> str:
    # a fresh folder under the shared checkpoint location (never a machine-local path on a cluster)
    return f"{scratch_dir(c.spark, 'sinks')}/{kind}"


@register("in03_table_sink_round_trip", ids=("IN-03",), r2=ROLLUP_R2, r6=RATIOS6,
          sql=sql(rollup_sql("session_month", "session_month")))
def q_table_sink(c):
    from kestrel.operators import metrics
    mart = metrics.metric_rollup(c.session_fact, "session_month")
    path = _sink_path(c, "table")
    sinks.write_table(mart.limit(1), path)      # replaced by the next version
    sinks.write_table(mart, path)
    return versions.read(c.spark, path)


@register("in04_csv_sink_round_trip", ids=("IN-04",), r2=ROLLUP_R2, r6=RATIOS6,
          sql=sql(rollup_sql("session_month", "session_month")))
def q_csv_sink(c):
    from kestrel.operators import metrics
    mart = metrics.metric_rollup(c.session_fact, "session_month")
    path = sinks.write_csv(mart, _sink_path(c, "csv"))
    return c.spark.read.option("header", True).schema(mart.schema).csv(path)
