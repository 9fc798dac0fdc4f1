"""Gates inside the writing job (IN-12, IN-13).

Counts of rows before and after a join and the contract of a mart are observed metrics:
they ride along with the one job that writes the table, without a scan of their
own, and are read when it has ended.  A table whose gate fails is not published
(`publish`).

Observed sums may count the rows of a task that was run again after its executor was
lost.  So before a gate fails, the metrics that failed are taken once more by a plain
aggregate; only that decides.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kestrel.sources import versions

#: Seconds to wait for the metrics of a job that has ended; without them they are taken by an aggregate.
PATIENCE = 20


class GateFailed(RuntimeError):
    """What a table broke, as (rule, found) pairs."""

    def __init__(self, broken: list[tuple[str, object]]):
        super().__init__(f"gate failed: {broken}")
        self.broken = broken


@dataclass
class _Watched:
    frame: DataFrame
    aggregates: list[Column]
    observation: Observation

    def seen(self) -> dict:
        """The observed metrics; where the plan has lost them (an empty side may be planned away), the counted ones."""
        found: list[dict] = []
        wait = threading.Thread(target=lambda: found.append(self.observation.get), daemon=True)
        wait.start()
        wait.join(PATIENCE)
        return dict(found[0]) if found and found[0] else self.counted()

    def counted(self) -> dict:
        return self.frame.agg(*self.aggregates).first().asDict()


def _bad(condition: Column) -> Column:
    """How many rows break a condition; NULL breaks nothing."""
    return F.count_if(~F.coalesce(condition, F.lit(True)))


def rules(columns: Sequence[str], rates: Sequence[str] = (), finite: Sequence[str] = (), ci: Sequence[tuple[str, str]] = (),
          p_values: Sequence[str] = (), rates_where: Column | None = None) -> dict[str, Column]:
    """Rows that break the contract of a mart, by rule: rates and p values in [0, 1], finite scores, ordered intervals.

    ``rates_where`` says in which rows rates are rates.
    """
    out, apply = {}, F.lit(True) if rates_where is None else rates_where
    for c in rates:
        out[f"{c} in [0, 1]"] = _bad(~apply | F.col(c).between(0.0, 1.0))
    for c in p_values:
        out[f"{c} is a probability"] = _bad(F.col(c).between(0.0, 1.0) & ~F.isnan(F.col(c).cast("double")))
    for c in finite:
        v = F.col(c).cast("double")
        out[f"{c} is finite"] = _bad(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    for low, high in ci:
        out[f"{low} <= {high}"] = _bad(F.col(low) <= F.col(high))
    return {k: v for k, v in out.items() if columns}


#: Ratios that may leave [0, 1], though their names end like those of shares.
UNBOUNDED = ("alternatives_exposure_rate", "_growth_rate")


def conventions(columns: Sequence[str]) -> dict[str, Column]:
    """The contract that the names of a mart's columns imply."""
    cols = set(columns)
    deltas = ("relative_", "absolute_")
    rates = [c for c in columns if c.endswith(("_rate", "_share", "_conversion")) and not c.startswith(deltas)
             and not c.endswith(UNBOUNDED)]
    p_values = [c for c in columns if c == "p_value" or c.startswith("p_value_") or c.endswith("_p_value")]
    ends = [(c, c.replace("ci_low", "ci_high")) for c in columns if "ci_low" in c]
    finite = [c for c in columns if c.endswith("opportunity_score") or c == "robust_z"]
    # a table of tests has the means of continuous metrics in the columns of rates
    binary = F.col("metric_type") == "binary" if "metric_type" in cols else None
    return rules(columns, rates, finite, [e for e in ends if e[1] in cols], p_values, binary)


class Gate:
    """What one writing job watches, and the rules on it."""

    def __init__(self) -> None:
        self._watched: dict[str, _Watched] = {}
        self._rules: list[tuple[str, list[str], Callable[[dict], object]]] = []

    def watch(self, df: DataFrame, name: str, *aggregates: Column) -> DataFrame:
        """Observe aggregates of ``df`` under a name."""
        o = Observation(f"{name}-{len(self._watched)}")
        self._watched[name] = _Watched(df, list(aggregates), o)
        return df.observe(o, *aggregates)

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        """Count the rows that pass here."""
        return self.watch(df, name, F.count(F.lit(1)).alias("rows"))

    def kept(self, df: DataFrame, name: str, before: str) -> DataFrame:
        """The rows that pass here must be as many as ``before``."""
        out = self.rows(df, name)
        self.expect(f"{name}: as many rows as {before}", [before, name],
                    lambda m: None if m[before]["rows"] == m[name]["rows"] else (m[before]["rows"], m[name]["rows"]))
        return out

    def contract(self, df: DataFrame, name: str, broken: dict[str, Column]) -> DataFrame:
        """No row may break a rule; ``broken`` counts those that do."""
        if not broken:
            return df
        names = list(broken)
        out = self.watch(df, name, *[broken[k].alias(f"r{i}") for i, k in enumerate(names)])

        def holds(m: dict) -> object:
            bad = {k: m[name][f"r{i}"] for i, k in enumerate(names) if m[name][f"r{i}"]}
            return bad or None
        self.expect(f"{name}: contract", [name], holds)
        return out

    def expect(self, rule: str, needs: Sequence[str], holds: Callable[[dict], object]) -> None:
        """A rule on the metrics of ``needs``: None where it holds, else what was found."""
        self._rules.append((rule, list(needs), holds))

    def metrics(self, name: str) -> dict:
        """What was observed under a name, after the job has ended."""
        return self._watched[name].seen()

    def judge(self) -> None:
        """Raise GateFailed when a rule is broken; to be called after the job has ended."""
        seen = {name: w.seen() for name, w in self._watched.items()}
        broken = []
        for rule, needs, holds in self._rules:
            if holds(seen) is not None:
                found = holds({n: self._watched[n].counted() for n in needs})
                if found is not None:
                    broken.append((rule, found))
        if broken:
            raise GateFailed(broken)


def _unique(spark: SparkSession, folder: str, keys: Sequence[str], name: str) -> None:
    """Ranks and grains cannot be observed: their columns are read once from what was written."""
    t = spark.read.parquet(folder)
    twice = t.where(F.col(keys[0]).isNotNull()).groupBy(*keys).count().where("count > 1").limit(1).count()
    if twice:
        raise GateFailed([(f"{name}: {', '.join(keys)} unique", "repeated")])


def publish(spark: SparkSession, path: str, build: Callable[[Gate], DataFrame], unique: Sequence[Sequence[str]] = (),
            partition_by: Sequence[str] = ()) -> versions.Version:
    """Write the table that ``build`` makes as the next version of ``path``, if it passes its gate."""
    def write(folder: str) -> dict:
        gate = Gate()
        df = gate.watch(build(gate), "written", F.count(F.lit(1)).alias("rows"))
        w = df.write.mode("error")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
        gate.judge()
        for keys in unique:
            _unique(spark, folder, list(keys), path.rpartition("/")[2])
        return {"rows": gate.metrics("written")["rows"]}
    return versions.publish(spark, path, write)
