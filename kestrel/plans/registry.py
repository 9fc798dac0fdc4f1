"""Query registry: every operator bound to the test tables, with its oracle.

Each entry carries the Spark builder, the DuckDB oracle SQL (None when the
operator is not SQL-expressible) and the double columns that are rounded on
both sides before comparison (money to 2 dp, everything else to 6 dp).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kestrel.functions.core import round_columns
from kestrel.plans.context import Context


@dataclass
class Query:
    name: str
    build: Callable[[Context], DataFrame]
    sql: str | None = None
    r2: tuple[str, ...] = ()
    r6: tuple[str, ...] = ()
    ids: tuple[str, ...] = field(default_factory=tuple)

    def run(self, spark: SparkSession, base: str) -> DataFrame:
        df = self.build(Context.shared(spark, base))
        return round_columns(df, {**{c: 6 for c in self.r6}, **{c: 2 for c in self.r2}})

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        # Spark rounds the shortest decimal form of a double half-up; DuckDB's
        # VARCHAR cast gives that same shortest form, so round it as DECIMAL
        parts = [f"CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,17)), {d}) AS DOUBLE) AS {c}"
                 for c, d in [*[(c, 2) for c in self.r2], *[(c, 6) for c in self.r6]]]
        if not parts:
            return self.sql
        body = self.sql.strip().rstrip(";")
        # the prelude's CTEs must stay at the top level: wrap only the final SELECT
        head, sep, tail = body.rpartition("\n-- final\n")
        if sep:
            return f"{head}\n, __final AS ({tail})\nSELECT * REPLACE ({', '.join(parts)}) FROM __final"
        return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({body}) AS __q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, r2=(), r6=(), ids=()):
    def deco(fn: Callable[[Context], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, tuple(r2), tuple(r6), tuple(ids))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the query modules fills REGISTRY
    from kestrel.plans import (  # noqa: F401
        queries_anomaly, queries_core, queries_experiment, queries_marts, queries_ml, queries_network,
        queries_io, queries_serving)
    return REGISTRY
