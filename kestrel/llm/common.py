"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir, staged  # noqa: F401

#: Rows per Arrow batch handed to Python; bounds a worker's memory when texts are long.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: bounded Arrow batches and a shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) not in range(1, ARROW_ROWS + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_of(col: str) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(col), F.lit(""))


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``fn`` on every Arrow batch of ``df``; a batch for which it returns None gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def pack(*arrays: np.ndarray) -> bytes:
    """64-bit arrays of any lengths as one compressed block, byte planes apart (small values cost little)."""
    head = np.array([len(arrays), *map(len, arrays)], dtype="<i8")
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    return zstandard.compress(head.tobytes() + b"".join(planes), 1)


def unpack(block: bytes) -> list[np.ndarray]:
    """The arrays of `pack`, as int64."""
    raw = np.frombuffer(zstandard.decompress(block), dtype=np.uint8)
    n = int(raw[:8].view("<i8")[0])
    sizes = raw[8:8 + 8 * n].view("<i8")
    out, at = [], 8 + 8 * n
    for size in sizes:
        out.append(np.ascontiguousarray(raw[at:at + 8 * size].reshape(8, -1).T).view("<i8").reshape(-1))
        at += 8 * int(size)
    return out


def text_bytes(docs: DataFrame, col: str) -> int:
    """Bytes of all texts of a column, from one narrow aggregate."""
    return docs.agg(F.sum(F.octet_length(col))).first()[0] or 0


def groups_for(spark: SparkSession, size: int, each: int) -> int:
    """Groups to deal ``size`` bytes to so that one has about ``each``, at least a few for each shuffle partition."""
    return max(4 * max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-size // each))


class Copies:
    """Numbers the copies of a key that a task has met: equal rows can be dealt apart by it, others are not moved by it."""

    def __init__(self) -> None:
        self.seen: dict[int, int] = {}

    def next(self, key: int) -> int:
        n = self.seen.get(key, 0)
        self.seen[key] = n + 1
        return n
