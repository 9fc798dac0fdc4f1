"""Facts as written tables, bucketed by session (FC-03, FC-05).

Items, units and outcomes are each dealt by session once, into tables of as many
buckets as their rows need: a bucket is what one task joins, so it has about
``BUCKET_ROWS`` items however large the tables are.  Outcomes that are items themselves
are read from the items' table.  The item fact, the unit fact and both
rollups are joins and aggregates on these tables and need no further exchange of
items; the facts are written bucketed as well, by the tasks that have joined them.

Two cases take the way with exchanges instead, which gives the same rows.  A session
with a large share of all rows would make one bucket one long task: when the largest
bucket is far over the mean, the tables are read as plain files, and Spark deals and
splits them itself.  And matching outcomes by (session, item) presumes that an
outcome names the session of its item: the outcomes that the item fact has taken up
are counted while it is written, and if any is missing, it is built again by item.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import facts
from kestrel.operators.gates import Gate, GateFailed
from kestrel.session import scratch_dir

KEY = "session_id"
#: A bucket over this many times the mean, and over so many rows, is a hot one.
HOT, HOT_ROWS = 4, 1_000_000
#: Items of a bucket, about: a task sorts them, wide, beside those of the other cores.
BUCKET_ROWS = 250_000
#: Joins on (session, ...) may use tables that are dealt by the session alone.
_CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
#: Where the rows to be dealt come out of a join by session, its exchange is the one of the write.  Merging its partitions
#: would leave a few tasks that sort many buckets each, beyond their memory.
_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
_PARTITIONS = "spark.sql.shuffle.partitions"
#: A task has rows of one bucket: it writes them as they come, where Spark would sort them by bucket first.
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass
class FactTables:
    items: DataFrame
    units: DataFrame
    outcomes: DataFrame
    folder: str
    buckets: int


class _Setting:
    """A setting of the session for the time of a block."""

    def __init__(self, spark: SparkSession, key: str, value: str):
        self.conf, self.key, self.value = spark.conf, key, value

    def __enter__(self) -> None:
        self.before = self.conf.get(self.key, None)
        self.conf.set(self.key, self.value)

    def __exit__(self, *_) -> None:
        self.conf.unset(self.key) if self.before is None else self.conf.set(self.key, self.before)


def _save(df: DataFrame, folder: str, name: str, buckets: int) -> DataFrame:
    spark = df.sparkSession
    table = f"kestrel_{name}_{uuid.uuid4().hex}"
    with _Setting(spark, _WRITERS, "2"):
        df.write.mode("error").bucketBy(buckets, KEY).option("path", f"{folder}/{name}").saveAsTable(table)
    return spark.table(table)


def _is_hot(sizes: Row, buckets: int, hot: int, hot_rows: int) -> bool:
    """Whether the largest bucket has far more rows than its part of all."""
    return bool(sizes["most"]) and sizes["most"] > hot_rows and sizes["most"] * buckets > hot * sizes["all"]


def _dealt(df: DataFrame, folder: str, name: str, buckets: int, hot: int, hot_rows: int) -> DataFrame:
    """The table by bucket; as plain files when one bucket has far more than its part."""
    with _Setting(df.sparkSession, _COALESCE, "false"), _Setting(df.sparkSession, _PARTITIONS, str(buckets)):
        table = _save(df.repartition(buckets, KEY), folder, name, buckets)
    plain = df.sparkSession.read.parquet(f"{folder}/{name}")
    sizes = plain.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return plain if _is_hot(sizes, buckets, hot, hot_rows) else table


def deal(sessions: DataFrame, searches: DataFrame, bookings: DataFrame | Callable[[DataFrame], DataFrame], hot: int = HOT,
         hot_rows: int = HOT_ROWS, rows: int | None = None, bucket_rows: int = BUCKET_ROWS, carried: Sequence[str] = ()) -> FactTables:
    """Write items, units and outcomes by session.

    ``rows`` is about the number of items, which are counted if it is not given.  Where ``bookings`` is a function, it gives the
    outcomes out of the dealt items; ``carried`` names what the items have for it alone.
    """
    spark = sessions.sparkSession
    rows = searches.count() if rows is None else rows
    buckets = max(2, int(spark.conf.get(_PARTITIONS)), -(-rows // bucket_rows))
    folder = scratch_dir(spark, "facts")
    items = _dealt(searches, folder, "items", buckets, hot, hot_rows)
    units = _dealt(sessions, folder, "units", buckets, hot, hot_rows)
    outcomes = bookings(items) if callable(bookings) else _dealt(bookings, folder, "outcomes", buckets, hot, hot_rows)
    return FactTables(items.drop(*carried), units, outcomes, folder=folder, buckets=buckets)


def item_fact_plan(t: FactTables, gate: Gate | None = None) -> DataFrame:
    """The item fact over the dealt tables; to be planned inside `co_partitioned`."""
    return facts.build_search_fact(t.items, t.units, t.outcomes, gate=gate, by_session=True)


def co_partitioned(spark: SparkSession) -> _Setting:
    """Plan joins with keys beyond the bucket's without an exchange."""
    return _Setting(spark, _CO_PARTITION, "false")


def item_fact(t: FactTables) -> DataFrame:
    """The item fact as a written table."""
    spark = t.items.sparkSession
    gate = Gate()
    fact = gate.watch(item_fact_plan(t, gate), "taken", F.sum("booking_count").alias("n"))
    with co_partitioned(spark):
        table = _save(fact, t.folder, "item_fact", t.buckets)
    gate.judge()
    if (gate.metrics("taken")["n"] or 0) == t.outcomes.where("booking_id IS NOT NULL").count():
        return table
    gate = Gate()
    again = facts.build_search_fact(t.items, t.units, t.outcomes, gate=gate)
    table = _save(again.repartition(t.buckets, KEY), t.folder, "item_fact_by_item", t.buckets)
    gate.judge()
    return table


def judge_units(t: FactTables) -> None:
    """What the gate of the item fact rules out, an item with several units, for a reader of units alone."""
    on = [KEY, "partner_id"]
    twice = t.units.groupBy(*on).count().where("count > 1")
    if twice.limit(1).count() and t.items.join(twice, on, "left_semi").limit(1).count():
        raise GateFailed([("item fact: as many rows as items", "units repeated")])


def over_items(sessions: DataFrame, searches: DataFrame, bookings: DataFrame, keys: DataFrame, use: Callable[[DataFrame], DataFrame],
               hot: int = HOT, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """What ``use`` makes, and writes, of the item fact in one pass.

    For a mart that reads the fact once, before the tables are dealt: only the columns that it needs are exchanged, by
    session as in `deal`, and neither items nor fact are written.  Gates are those of `item_fact`; so is the way by item,
    taken for a hot session or outcomes of another one.  ``keys`` has the session of every item at little cost.
    """
    spark = searches.sparkSession
    parts = max(int(spark.conf.get(_PARTITIONS)), -(-keys.count() // bucket_rows))
    sizes = keys.groupBy(F.pmod(F.hash(KEY), F.lit(parts))).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    ways = [False] if _is_hot(sizes, parts, hot, hot_rows) else [True, False]
    for by_session in ways:
        gate = Gate()
        seen = gate.watch(bookings, "outcomes", F.count("booking_id").alias("n"))
        fact = gate.watch(facts.build_search_fact(searches, sessions, seen, gate=gate, by_session=by_session),
                          "taken", F.sum("booking_count").alias("n"))
        with _Setting(spark, _PARTITIONS, str(parts)), co_partitioned(spark) if by_session else nullcontext():
            out = use(fact)
        gate.judge()
        if not by_session or (gate.metrics("taken")["n"] or 0) == gate.metrics("outcomes")["n"]:
            break
    return out


def unit_fact(t: FactTables) -> DataFrame:
    """The unit fact as a written table."""
    gate = Gate()
    with co_partitioned(t.items.sparkSession):
        table = _save(facts.build_session_fact(t.units, t.items, t.outcomes, gate=gate), t.folder, "unit_fact", t.buckets)
    gate.judge()
    return table
