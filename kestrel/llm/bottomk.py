"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint is the set of the ``k`` smallest distinct shingle hashes of a
text (all of them when it has fewer), ascending, 48 bits each, in base64.
Sketches of parts merge to the sketch of the whole (`merge`), and estimate
resemblance, containment and the number of distinct shingles.

Defined results: a null text counts as empty; a text without words has the
empty fingerprint; two empty fingerprints have likeness 1, one empty and one
not 0.  Rows are ordered by (id, text); rows that repeat both follow each
other; a null id comes last.  Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, staged, text_of
from kestrel.llm.shingles import shingle_hashes

#: Hashes kept in a sketch: a standard error of about 0.03 for resemblance.
K = 256
#: Bits kept of each hash.
BITS = 48


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Bottom-k sketch of shingle hashes (repeats allowed), ascending."""
    if len(hashes) > 4 * k:
        # everything that can be among the k smallest distinct values, unless values repeat
        part = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(part) >= k:
            return part[:k]
    return np.unique(hashes)[:k]


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - BITS)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of the two shingle sets."""
    return np.unique(np.concatenate([a, b]))[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0 ** BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets; exact when both have fewer than ``k``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, union, assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has as well."""
    if not len(a):
        return 1.0
    union = merge(a, b, k)
    size = distinct(union, k)
    return min(1.0, resemblance(a, b, k) * size / max(distinct(a, k), 1.0))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(s: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s or ""), dtype=np.uint8).reshape(-1, BITS // 8)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, 2:] = raw
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _sketches(texts: list[str]) -> list[np.ndarray]:
    hashes, at = shingle_hashes(texts)
    hashes = _short(hashes)
    return [sketch(hashes[at[i]:at[i + 1]]) for i in range(len(texts))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, n_shingles (estimate) and fingerprint."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        sk = _sketches(texts)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([distinct(s) for s in sk], pa.float64()), pa.array([encode(s) for s in sk], pa.string())],
            ["doc_id", "n_chars", "n_shingles", "fingerprint"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, "doc_id long, n_chars long, n_shingles double, fingerprint string", run)


def _rank(key: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``, by two short searches."""
    def lit(rows: list[tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(a).cast("long").alias("o"), F.lit(b).cast("long").alias("h")) for a, b in rows])
    step = max(1, isqrt(len(bounds)))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(lit([b[0] for b in blocks]), lambda b: b <= key))
    within = F.size(F.filter(F.element_at(F.array(*[lit(b) for b in blocks]), F.greatest(coarse, F.lit(1))),
                             lambda b: b <= key))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * F.lit(step) + within)


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in id order, cut into runs, each run ended by a copy of the row that follows it.

    Columns run, last, o (the id, or the largest long for null), h, doc_id, text; ``last`` is 1 for the
    copy.  The run bounds (one key for each partition, all that reaches the driver) come from a sort of
    narrow rows; then each text moves once.  Rows of a run are in one partition, in order.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("o"), F.xxhash64("text").alias("h"),
                       "doc_id", "text")
    narrow = staged(rows.select("o", "h").repartitionByRange(2 * parts, "o", "h"))
    heads = narrow.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("o", "h")).alias("m"))
    bounds = sorted((r.m.o, r.m.h) for r in heads.collect())
    if not bounds:
        return rows.select(F.lit(0).alias("run"), F.lit(0).alias("last"), "o", "h", "doc_id", "text")
    key = F.struct(F.col("o"), F.col("h"))
    rank = _rank(key, bounds)
    head = F.array_contains(F.array(*[F.struct(F.lit(a).cast("long").alias("o"), F.lit(b).cast("long").alias("h"))
                                      for a, b in bounds]), key)
    n = len(bounds)
    own = F.struct((F.col("k") - 1).alias("run"), F.lit(0).alias("last"))
    # the first row of a run also ends the run before; the first of all ends the last run
    copy = F.struct(F.when(F.col("k") == 1, F.lit(n - 1)).otherwise(F.col("k") - 2).alias("run"), F.lit(1).alias("last"))
    placed = (rows.withColumn("k", rank).withColumn("to", F.explode(F.when(head, F.array(own, copy)).otherwise(F.array(own))))
              .select("to.run", "to.last", "o", "h", "doc_id", "text"))
    return placed.repartition(2 * parts, "run").sortWithinPartitions("run", "last", "o", "h")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n_chars / 4) code points replaced by the first
    as many (or all) of the next document in id order (after the last: the first).
    ``near_edited`` and ``near_next`` are the likeness of the text's fingerprint to the
    edited text's and to the next document's.
    """
    def close(pairs: list[tuple]) -> pa.RecordBatch:
        """Result rows of (doc_id, text, next text) triples."""
        texts = [p[1] for p in pairs]
        edited = [t[: len(t) - len(t) // 4] + nxt[: len(t) // 4] for _, t, nxt in pairs]
        after = [p[2] for p in pairs]
        own, new = _sketches(texts), _sketches(edited)
        # the next text is the text of the pair that follows, but for the last of a run
        nexts = [own[i + 1] if i + 1 < len(pairs) and texts[i + 1] is after[i] else _sketches([after[i]])[0]
                 for i in range(len(pairs))]
        return pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array([encode(s) for s in own], pa.string()), pa.array([encode(s) for s in new], pa.string()),
            pa.array([resemblance(a, b) for a, b in zip(own, new)], pa.float64()),
            pa.array([resemblance(a, b) for a, b in zip(own, nexts)], pa.float64()),
            pa.array([distinct(s) for s in own], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "n_shingles"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None                                   # (run, doc_id, text), its next row not seen yet
        for batch in batches:
            runs, lasts, ids, texts = (batch.column(i).to_pylist() for i in (0, 1, 4, 5))
            pairs, held = [], 0
            for run, last, doc, text in zip(runs, lasts, ids, texts):
                if before is not None and before[0] == run:
                    pairs.append((before[1], before[2], text))
                    held += len(before[2])
                    if held > 1 << 22:                  # long texts: bound what is in work
                        yield close(pairs)
                        pairs, held = [], 0
                before = (run, doc, text) if not last else None
            if pairs:
                yield close(pairs)

    return followed(docs, id_col, text_col).mapInArrow(walk, (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double"))
