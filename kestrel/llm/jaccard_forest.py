"""N-gram Jaccard join by MinHash trees with exact verification.

Each document's set of word 5-grams has ``TREES`` signatures of minimum hashes.  Two
documents are candidates when they share a prefix in some tree.  The length of the
prefix is found from the recall that is wanted: from ``LONGEST`` hashes on it is
shortened, one hash at a time, until a pair at the threshold shares one of the trees'
prefixes with the target probability (`prefix_length`).  All trees are cut at that
depth, whatever the data is like; prefixes are not shortened step by step as in an
adaptive forest (README says why).

Documents with equal sets make a class, and only classes go on.  In each prefix
the classes are linked in a star around the smallest, never pairwise; components
of those links hold all candidate pairs.  Inside a component the whole sets are
compared exactly.  Large components are cut into blocks, each pair of blocks a
task, and only counts and a spanning forest leave the task.

Defined results: null texts count as empty; a text without words has no set and
links with nothing; a text of fewer than five words has one shingle; texts with
equal sets (case and white space do not count) are linked; rows that repeat
count as documents of their own; a null id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, mix, seeds, staged, text_of
from kestrel.llm.components import components
from kestrel.llm.shingles import shingle_hashes

THRESHOLD = 0.8
#: Words in a shingle.
WIDTH = 5
#: Trees of the forest, longest prefix, and the probability with which a pair at the threshold must share one.
TREES, LONGEST, RECALL = 24, 8, 0.9999
#: Classes in a block of a large component.
BLOCK = 512
#: Shingles multiplied at once when sets are compared.
COLUMNS = 8192


def prefix_length(threshold: float, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold shares one of the trees' prefixes often enough."""
    for length in range(longest, 0, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    raise ValueError("too few trees for this recall")


def _sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one after the other, and the bounds between them."""
    hashes, at = shingle_hashes(texts, WIDTH)
    parts = [np.unique(hashes[i:j]) for i, j in zip(at[:-1], at[1:])]
    return (np.concatenate(parts) if parts else hashes), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _class(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each non-empty set, from sums over its members."""
    mult = seeds(2, 11)
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    if len(full):
        at = bounds[full]
        out[full] = mix(np.add.reduceat(mix(flat * mult[0]), at) ^ (np.add.reduceat(mix(flat * mult[1]), at) * mult[1])
                        + np.diff(bounds)[full].astype(np.uint64))
    return out


def _prefixes(flat: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """One row for each non-empty set, one 64-bit prefix hash for each tree."""
    full = np.flatnonzero(np.diff(bounds))
    at, mult = bounds[full], seeds(TREES * length, 23)
    out = np.empty((len(full), TREES), dtype=np.uint64)
    for t in range(TREES):
        key = np.full(len(full), t + 1, dtype=np.uint64)
        for j in range(length):
            x = flat * mult[t * length + j]
            x ^= x >> np.uint64(29)
            x *= mult[(t * length + j + 1) % len(mult)]
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + (np.minimum.reduceat(x, at) >> np.uint64(16)))
        out[:, t] = key
    return out


def signed(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(o, h, c, n, keys) of every document: id, text hash, class, set size and prefix hashes."""
    length = prefix_length(threshold)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = _sets(batch.column(2).to_pylist())
        sizes = np.diff(bounds)
        keys = _prefixes(flat, bounds, length).astype(np.int64) if len(flat) else np.zeros((0, TREES), np.int64)
        offsets = np.concatenate([[0], np.cumsum((sizes > 0) * TREES)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(_class(flat, bounds).astype(np.int64)), pa.array(sizes.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))], ["o", "h", "c", "n", "keys"])
    return map_batches(_keyed(docs, id_col, text_col), "o long, h long, c long, n long, keys array<long>", run)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("o"),
                       F.xxhash64(text_of(text_col)).alias("h"), text_of(text_col).alias("text"))


def candidates(classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that share a prefix with another, chains of such included."""
    keys = classes.select("c", F.explode("keys").alias("key"))
    lead = keys.groupBy("key").agg(F.min("c").alias("lead"), F.max("c").alias("last")).where("lead < last")
    links = keys.join(lead.select("key", "lead"), "key").where("c <> lead").select("c", "lead")
    return staged(components(links))


def _compare(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold; exact, by products over the shingles that both sides have."""
    a, b = np.concatenate(sets), np.concatenate(others)
    shared = np.intersect1d(a, b)
    both = np.zeros((len(sets), len(others)))

    def places(flat: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        ok = shared[at] == flat if len(shared) else np.zeros(len(flat), dtype=bool)
        return row[ok], at[ok]
    (ra, ca), (rb, cb) = places(a, sets), places(b, others)
    for lo in range(0, len(shared), COLUMNS):
        x = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        y = np.zeros((len(others), COLUMNS), dtype=np.float32)
        for m, r, c in ((x, ra, ca), (y, rb, cb)):
            ok = (c >= lo) & (c < lo + COLUMNS)
            m[r[ok], c[ok] - lo] = 1
        both += x @ y.T
    union = np.array([len(s) for s in sets])[:, None] + np.array([len(s) for s in others])[None, :] - both
    return both >= threshold * union - 1e-9


def verified(docs: DataFrame, classes: DataFrame, comps: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(c, root, links): in each compared block, a class, the smallest class it is connected with there and the
    number of documents of the other classes that it is linked with there."""
    sizes = comps.groupBy("component").agg(F.count("*").alias("size"))
    some = (classes.join(comps, classes["c"] == comps["node"]).join(sizes, "component")
            .select("o", "h", "c", "copies", "component", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = _keyed(docs, id_col, text_col).join(some, ["o", "h"]).dropDuplicates(["o", "h"])
    block = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = _sets(batch.column(0).to_pylist())
        out = [flat[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.binary())], [*batch.schema.names[1:], "set"])
    sent = map_batches(rows.select("text", "c", "copies", "component", "blocks", block.alias("block")),
                       "c long, copies long, component long, blocks int, block int, set binary", sets)
    # a block meets every block of its component, itself included
    sent = sent.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "c", "copies", "set")

    def meet(key: tuple, t: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, c, copies = (t.column(x).to_numpy() for x in ("block", "c", "copies"))
        parts = [np.frombuffer(x, dtype=np.uint64) for x in t.column("set").to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        root, links = c.copy(), np.zeros(len(c), dtype=np.int64)
        near = np.zeros((len(left), len(right)), dtype=bool)
        for lo in range(0, len(left), BLOCK):
            for at in range(0, len(right), BLOCK):
                near[lo:lo + BLOCK, at:at + BLOCK] = _compare([parts[x] for x in left[lo:lo + BLOCK]],
                                                              [parts[x] for x in right[at:at + BLOCK]], threshold)
        near &= c[left][:, None] != c[right][None, :]
        links[left] = near @ copies[right]
        if i != j:
            links[right] = near.T @ copies[left]
        while near.any():                       # spread the smallest class along the links
            before = root.copy()
            top = np.iinfo(np.int64).max
            root[left] = np.minimum(root[left], np.where(near, root[right][None, :], top).min(axis=1))
            root[right] = np.minimum(root[right], np.where(near, root[left][:, None], top).min(axis=0))
            if (root == before).all():
                break
        some = links > 0
        return pa.table({"c": pa.array(c[some]), "root": pa.array(root[some]), "links": pa.array(links[some])})
    return sent.groupBy("component", "i", "j").applyInArrow(meet, "c long, root long, links long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(o, h, class_id, class_h, n_links) of every row of ``docs``.

    o and h are the id (the largest long for null) and the text's hash.  Rows of one class_id and class_h are
    connected by links; these are the smallest (o, h) among them.  n_links counts the other documents that the
    row is linked with directly.
    """
    rows = staged(signed(docs, id_col, text_col, threshold))
    full = rows.where("n > 0")
    classes = full.groupBy("c").agg(F.min(F.struct("o", "h")).alias("first"), F.count("*").alias("copies"),
                                    F.first("keys").alias("keys"))
    classes = staged(classes.select("c", "first.o", "first.h", "copies", "keys"))
    comps = candidates(classes)
    found = staged(verified(docs, classes, comps, threshold, id_col, text_col))
    linked = found.groupBy("c").agg(F.sum("links").alias("links"))
    group = components(found.select("c", "root"))
    named = (classes.join(group, classes["c"] == group["node"], "left").join(linked, "c", "left")
             .select("c", "o", "h", "copies", F.coalesce("component", "c").alias("g"), F.coalesce("links", F.lit(0)).alias("links")))
    first = named.groupBy("g").agg(F.min(F.struct("o", "h")).alias("first"))
    named = named.join(first, "g").select("c", "first", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return (rows.select("o", "h", F.when(F.col("n") > 0, F.col("c")).alias("c")).join(named, "c", "left")
            .select("o", "h", F.coalesce("first.o", "o").alias("class_id"), F.coalesce("first.h", "h").alias("class_h"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links and kept (whether the document is the one of its class that stays)."""
    null = F.lit((1 << 63) - 1)
    out = join(docs, id_col, text_col, threshold)
    return out.select(F.when(F.col("o") < null, F.col("o")).alias("doc_id"),
                      F.when(F.col("class_id") < null, F.col("class_id")).alias("class_id"), "n_links",
                      ((F.col("o") == F.col("class_id")) & (F.col("h") == F.col("class_h"))).alias("kept"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that are linked with an earlier one: one row of each class."""
    keep = (join(docs, id_col, text_col, threshold).where((F.col("o") == F.col("class_id")) & (F.col("h") == F.col("class_h")))
            .select(F.col("o").alias("__o"), F.col("h").alias("__h")).distinct())
    rows = docs.withColumns({"__o": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)),
                             "__h": F.xxhash64(text_of(text_col))})
    return rows.join(keep, ["__o", "__h"], "left_semi").dropDuplicates(["__o", "__h"]).select(*docs.columns)
