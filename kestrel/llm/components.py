"""Connected components of a graph of links, by alternating star contractions.

Links are first contracted inside each task, then every node is linked to the
smallest node around it, from the larger side and from the smaller side in turn,
until nothing changes.  Every round is a join and two aggregations on the node;
the links of a node are summed before the shuffle and dealt to a few tasks for the
join.  Nodes of more than ``HOT`` links, of which there are at most a HOT-th as many as
links, are joined where their links are.  Rounds are cut by checkpoints; only a few sums
for each reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import staged

#: Links that a task contracts at once.
LOCAL_LINKS = 200_000
#: Tasks that the links of one node are dealt to, links that make a node hot, and hot nodes that are sent to every task.
SALTS, HOT, HOT_NODES = 8, 100_000, 100_000


def roots(links: Iterator[tuple[int, int]]) -> dict[int, int]:
    """The smallest node that each node of the links is connected with."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        up.setdefault(a, a)
        up.setdefault(b, b)
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def _contracted(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            out = [(x, r) for x, r in roots(iter(held)).items() if x != r]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], ["u", "v"])
        for batch in batches:
            held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            if len(held) >= LOCAL_LINKS:
                yield flush()
        if held:
            yield flush()
    return links.mapInArrow(run, "u long, v long")


def _salted(links: DataFrame, low: DataFrame) -> DataFrame:
    """Links with what ``low`` says of their node u; the links of one node are dealt to SALTS tasks."""
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("salt")
    spread = low.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return links.select("u", "v", salt).join(spread, ["u", "salt"])


def _told(links: DataFrame, low: DataFrame, most: int) -> DataFrame:
    """Links (u, v) with m of their node u, which ``low`` (u, m, n) has; ``most`` bounds the links n of a node."""
    if most <= HOT:
        return _salted(links, low).select("u", "v", "m")
    hot = low.where(F.col("n") > HOT).select("u", F.col("m").alias("hot_m"))
    hot = F.broadcast(hot) if hot.limit(HOT_NODES + 1).count() <= HOT_NODES else hot
    both = links.join(hot, "u", "left")
    cold = _salted(both.where("hot_m IS NULL").select("u", "v"), low.where(F.col("n") <= HOT)).select("u", "v", "m")
    return both.where("hot_m IS NOT NULL").select("u", "v", F.col("hot_m").alias("m")).union(cold)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links``, two columns of longs; component is its smallest node.

    Links of a node with itself add nothing; nodes without links to others are not in the result;
    links with a null are ignored.
    """
    a, b = links.columns
    now = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    now = staged(_contracted(now).distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        if state is not None and state[0] <= HOT:
            most = state[0]             # no node has more links than there are
        else:
            most = both.groupBy("u").count().agg(F.max("count")).first()[0] or 0
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _told(both.where("v > u"), low, most).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _told(large, low, most).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == (found["n"], found["h"]):
            break
        state = (found["n"], found["h"])
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())
