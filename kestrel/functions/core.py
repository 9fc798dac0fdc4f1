"""Null-safe ratios, z-scores, weighted scores and unique ranks.

All helpers return Column expressions or lazily extended DataFrames; none
collects data.  Population statistics are computed in one global aggregate
(one row, so broadcasting it is bounded) and joined back, instead of an
unpartitioned window that would pull every row into one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(numerator, denominator, null_as_zero: bool = False) -> Column:
    """n / d as double, 0.0 where d is 0 or NULL.

    Spark 4 runs ANSI mode, so a plain ``/`` by zero raises; ``try_divide``
    returns NULL instead.  With ``null_as_zero`` a NULL numerator also gives
    0.0 (the network stage fills before dividing); otherwise it stays NULL.
    """
    n = _col(numerator).cast("double")
    d = _col(denominator).cast("double")
    if null_as_zero:
        n = F.coalesce(n, F.lit(0.0))
    ratio = F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(F.try_divide(n, d))
    return ratio.cast("double")


def money_sum(c) -> Column:
    """Sum of a currency column kept to cents.

    Inputs carry cents, so the exact sum has two decimals; rounding removes
    the floating-point noise of summation order.  Results are then identical
    however the data is partitioned (and ratios built on them reproducible).
    """
    return F.round(F.sum(_col(c)), 2)


def global_stats(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """One-row aggregate, broadcast-joined back to ``df`` (bounded: 1 row)."""
    stats = df.agg(*[expr.alias(name) for name, expr in aggs.items()])
    return df.crossJoin(F.broadcast(stats))


def zscore(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Population z-score per column; NULL treated as 0; constant column -> 0."""
    aggs: dict[str, Column] = {}
    for c in columns:
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        aggs[f"__mu_{c}"] = F.avg(v)
        aggs[f"__sd_{c}"] = F.stddev_pop(v)
    out = global_stats(df, aggs)
    new = {}
    for c in columns:
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        sd = F.col(f"__sd_{c}")
        new[f"{prefix}{c}"] = F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise(
            (v - F.col(f"__mu_{c}")) / sd)
    return out.withColumns(new).drop(*aggs.keys())


def composite_score(df: DataFrame, components: Iterable[tuple[float, Column]],
                    name: str, materialize: bool = True) -> DataFrame:
    """Weighted sum of population z-scores of arbitrary component expressions.

    ``components`` is a list of (weight, expression); each expression is
    z-scored over the whole frame and weighted.  Scoring runs on mart-grain
    frames (entities, routes, markets); with ``materialize`` the frame is
    written once (reliable checkpoint) so the statistics joined back to it
    do not re-derive its upstream plan once per statistic.
    """
    comps = list(components)
    tmp = [f"__comp{i}" for i in range(len(comps))]
    df = df.withColumns({t: e.cast("double") for t, (_, e) in zip(tmp, comps)})
    if materialize:
        from kestrel.session import cut_lineage
        df = cut_lineage(df)
    df = zscore(df, tmp, prefix="z")
    score = None
    for t, (w, _) in zip(tmp, comps):
        term = F.lit(float(w)) * F.col(f"z{t}")
        score = term if score is None else score + term
    return df.withColumn(name, score).drop(*tmp, *[f"z{t}" for t in tmp])


def rank_unique(df: DataFrame, order: Sequence[Column], name: str,
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """Unique 1..n rank; ``order`` must end with a key so ties are stable.

    pandas ``rank(method="first")`` breaks ties by row order, which a
    distributed frame does not have: the caller's key replaces it.  A global
    rank is computed over range partitions with per-partition offsets
    (``kestrel.functions.ranking``), never in a single task.
    """
    if partition_by:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order)))
    from kestrel.functions.ranking import global_row_number
    return global_row_number(df, order, name)


def classify(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching rule wins (``np.select`` semantics)."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns (used to compare against an oracle)."""
    present = {c: d for c, d in digits.items() if c in df.columns}
    return df.withColumns({c: F.round(F.col(c), d) for c, d in present.items()})
