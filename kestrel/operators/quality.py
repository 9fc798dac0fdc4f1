"""Quality gates and contracts (IN-06..IN-16).

Checks are expressed as small aggregates; checks on the same table share a
single scan (one aggregate with several counters) and the results are
stacked into one long ``(check, violations)`` table.  Only the gate
(``assert_checks``) is an action, and it collects that small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(df: DataFrame) -> DataFrame:
    cols = df.columns
    return df.unpivot([], cols, "check", "violations").withColumn(
        "violations", F.col("violations").cast("bigint"))


def duplicate_keys(df: DataFrame, key: str | Sequence[str], name: str) -> DataFrame:
    """IN-06: rows beyond the first per key (count(*) - count(DISTINCT key))."""
    keys = [key] if isinstance(key, str) else list(key)
    distinct = F.count_distinct(*[F.col(k) for k in keys])
    return _long(df.agg((F.count(F.lit(1)) - distinct).alias(name)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """IN-07: child rows whose foreign key has no parent (anti join, then count).

    Catalyst plans the anti join as a shuffle join on the key (or a
    broadcast when AQE measures the parent side as small).
    """
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    missing = child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")
    return _long(missing.agg(F.count(F.lit(1)).alias(name)))


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """IN-08: rows violating each boolean rule; all rules in one scan."""
    return _long(df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()]))


def temporal_violations(child: DataFrame, parent: DataFrame, key: str, child_ts: str,
                        parent_ts: str, name: str) -> DataFrame:
    """IN-09: child rows time-stamped before their parent (many-to-one join)."""
    p = parent.select(F.col(key).alias("__k"), F.col(parent_ts).alias("__pts"))
    j = child.select(key, child_ts).join(p, F.col(key) == F.col("__k"), "left")
    return _long(j.agg(F.count_if(F.col(child_ts) < F.col("__pts")).alias(name)))


def outcome_parent_violations(items: DataFrame, outcomes: DataFrame, key: str,
                              rules: Mapping[str, Column]) -> DataFrame:
    """IN-10: rules over items that have at least one outcome (semi join)."""
    has = items.join(outcomes.select(key), key, "left_semi")
    return rule_violations(has, rules)


def check_table(*parts: DataFrame) -> DataFrame:
    """IN-11: one long table of all checks."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_checks(checks: DataFrame, allow: Sequence[str] = ()) -> None:
    """IN-11 gate: raise when any check (outside ``allow``) is non-zero."""
    bad = checks.filter((F.col("violations") != 0) & (~F.col("check").isin(list(allow)) if allow else F.lit(True)))
    rows = bad.collect()   # at most one row per check
    if rows:
        raise RuntimeError(f"integrity failed: { {r['check']: r['violations'] for r in rows} }")


def grain_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """IN-12: rows, distinct keys and duplicates of a fact's grain."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def contract(df: DataFrame, name: str, rate_cols: Sequence[str] = (), rank_col: str | None = None,
             finite_cols: Sequence[str] = (), ci: tuple[str, str] | None = None,
             p_cols: Sequence[str] = ()) -> DataFrame:
    """IN-13: output contract of a mart as one row of booleans."""
    aggs = [F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows")]
    if rate_cols:
        cond = None
        for c in rate_cols:
            ok = F.col(c).isNull() | F.col(c).between(0.0, 1.0)
            cond = ok if cond is None else cond & ok
        aggs.append(F.coalesce(F.bool_and(cond), F.lit(True)).alias("rates_in_unit_interval"))
    if rank_col:
        aggs.append((F.count(rank_col) == F.count_distinct(rank_col)).alias("ranks_unique"))
    if finite_cols:
        cond = None
        for c in finite_cols:
            ok = F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) < F.lit(float("inf")))
            cond = ok if cond is None else cond & ok
        aggs.append(F.coalesce(F.bool_and(cond), F.lit(True)).alias("scores_finite"))
    if ci:
        aggs.append(F.coalesce(F.bool_and(F.col(ci[0]) <= F.col(ci[1])), F.lit(True)).alias("ci_ordered"))
    if p_cols:
        cond = None
        for c in p_cols:
            ok = F.col(c).isNull() | F.col(c).between(0.0, 1.0)
            cond = ok if cond is None else cond & ok
        aggs.append(F.coalesce(F.bool_and(cond), F.lit(True)).alias("p_values_valid"))
    return df.agg(*aggs)


def monotonic_non_increasing(df: DataFrame, order_col: str, value_col: str) -> DataFrame:
    """IN-13 (funnel): every value <= the previous one in ``order_col`` order.

    Used on small marts only (the window has no partition key).
    """
    from pyspark.sql import Window
    prev = F.lag(value_col).over(Window.orderBy(order_col))
    ok = F.col("__prev").isNull() | (F.col(value_col) <= F.col("__prev"))
    return df.withColumn("__prev", prev).agg(
        F.coalesce(F.bool_and(ok), F.lit(True)).alias("monotonic_non_increasing"))


def table_counts(tables: Mapping[str, DataFrame], required: Sequence[str]) -> DataFrame:
    """IN-14: row count per present table plus a row per missing required table."""
    spark = next(iter(tables.values())).sparkSession
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                    F.lit(True).alias("present")) for name, df in tables.items()]
    missing = [n for n in required if n not in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if missing:
        m = spark.createDataFrame([(n, None, False) for n in missing], "table_name string, rows bigint, present boolean")
        out = out.unionByName(m)
    return out


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """IN-15: NULL count per feature column (one scan) as a long table."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot(["__rows"], list(columns), "feature", "nulls").withColumnRenamed("__rows", "rows")


def quality_snapshot(sessions: DataFrame, searches: DataFrame, bookings: DataFrame,
                     unit: str = "session_id", item: str = "search_id", outcome_key: str = "session_id",
                     entity: str = "partner_id", arm: str = "experiment_variant") -> DataFrame:
    """IN-16: per-arm unit count and share of units with an outcome, plus global ratios."""
    booked_units = bookings.select(F.col(outcome_key).alias(unit)).distinct().withColumn("__b", F.lit(1.0))
    per_unit = sessions.select(unit, arm).join(booked_units, unit, "left").fillna(0.0, subset=["__b"])
    by_arm = per_unit.groupBy(arm).agg(F.count(F.lit(1)).alias("sessions"),
                                      F.avg("__b").alias("booked_session_share"))
    glob = searches.agg(
        F.count_distinct(item).alias("distinct_searches"),
        F.avg(F.col("no_result_flag").cast("double")).alias("no_result_rate"),
    ).crossJoin(bookings.agg(F.count_distinct("booking_id").alias("distinct_bookings"))).crossJoin(
        sessions.agg(F.count_distinct(entity).alias("active_partners")))
    glob = glob.withColumn("bookings_per_search", F.try_divide(F.col("distinct_bookings"), F.col("distinct_searches")))
    return by_arm.crossJoin(F.broadcast(glob))
