"""Global row numbers and running sums without a single-partition window.

A window with no PARTITION BY moves every row into one task.  Instead the rows
are range-partitioned on the ordering, sorted inside their partitions and written
to the checkpoint folder, which fixes who is where.  A row's place in its
partition is then known without another shuffle; each partition's count or sums
(one row per partition) become offsets that are broadcast and added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import cut_lineage


def _ranged(df: DataFrame, order: Sequence[Column], parts: int | None) -> DataFrame:
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))


def _offsets(totals: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Running sums over the partitions before each one; a row for each partition."""
    prev = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__pid", *[F.coalesce(F.sum(c).over(prev), F.lit(0)).alias(f"__o_{c}") for c in cols])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, parts: int | None = None) -> DataFrame:
    """1..n in ``order`` (which must be a total order, e.g. end with a key)."""
    r = _ranged(df, order, parts).withColumn("__m", F.monotonically_increasing_id())
    r = r.withColumns({"__pid": F.shiftright("__m", 33), "__at": F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))})
    off = _offsets(r.groupBy("__pid").agg(F.count(F.lit(1)).alias("c")), ["c"])
    r = r.join(F.broadcast(off), "__pid")
    return r.withColumn(name, (F.col("__at") + 1 + F.col("__o_c")).cast("bigint")).drop("__pid", "__at", "__m", "__o_c")


def global_cumsum(df: DataFrame, order: Sequence[Column], cols: Sequence[str], prefix: str = "cum_",
                  parts: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` (a total order)."""
    r = _ranged(df, order, parts).withColumn("__pid", F.spark_partition_id())
    off = _offsets(r.groupBy("__pid").agg(*[F.sum(c).alias(c) for c in cols]), cols)
    fields = r.schema.fields + [T.StructField(f"{prefix}{c}", r.schema[c].dataType) for c in cols]

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = dict.fromkeys(cols, 0)
        for b in batches:
            out = list(b.columns)
            for c in cols:
                col = b.column(b.schema.get_field_index(c))
                sums = np.cumsum(col.fill_null(0).to_numpy(zero_copy_only=False)) + before[c]
                before[c] = sums[-1] if len(sums) else before[c]
                out.append(pa.array(sums, col.type))
            yield pa.RecordBatch.from_arrays(out, [*b.schema.names, *[f"{prefix}{c}" for c in cols]])
    r = r.mapInArrow(running, T.StructType(fields)).join(F.broadcast(off), "__pid")
    r = r.withColumns({f"{prefix}{c}": F.col(f"{prefix}{c}") + F.col(f"__o_{c}") for c in cols})
    return r.drop("__pid", *[f"__o_{c}" for c in cols])


def quantiles(df: DataFrame, wants: Sequence[tuple[str, str, float]], by: str | None = None) -> DataFrame:
    """Exact quantiles (name, column, share), linear between neighbours, NULLs left out.

    One row, or one for each value of ``by``.  Counts of distinct values get running sums over
    range partitions, and a quantile is the least value whose sum passes its position: no
    task sees all values of a column.
    """
    cols = list(dict.fromkeys(c for _, c, _ in wants))
    group = F.col(by) if by else F.lit(0)
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    long = df.select(group.alias("__by"), F.explode(pairs).alias("s")).select("__by", "s.k", "s.v").filter("v IS NOT NULL")
    counts = long.groupBy("__by", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    # read three times below: written once
    c = cut_lineage(global_cumsum(counts, [F.col("__by").asc(), F.col("k").asc(), F.col("v").asc()], ["n"]))
    total = c.groupBy("__by", "k").agg(F.sum("n").alias("t"), F.max("cum_n").alias("e"))
    c = c.join(total, ["__by", "k"]).withColumn("upto", F.col("cum_n") - (F.col("e") - F.col("t")))
    aggs, out = [], []
    for j, (name, col, share) in enumerate(wants):
        mine, place = F.col("k") == cols.index(col), F.lit(float(share)) * (F.col("t") - 1)
        aggs += [F.max(F.when(mine, place)).alias(f"__p{j}"),
                 F.min(F.when(mine & (F.col("upto") > F.floor(place)), F.col("v"))).alias(f"__l{j}"),
                 F.min(F.when(mine & (F.col("upto") > F.ceil(place)), F.col("v"))).alias(f"__h{j}")]
        p, lo, hi = F.col(f"__p{j}"), F.col(f"__l{j}"), F.col(f"__h{j}")
        out.append(F.when((F.floor(p) == F.ceil(p)) | (lo == hi), lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi).alias(name))
    if by:
        return c.groupBy("__by").agg(*aggs).select(F.col("__by").alias(by), *out)
    return c.agg(*aggs).select(*out)
