"""Trees of a random forest grown side by side, a task for a few trees (ML-07).

Spark grows a forest level by level over dealt rows: each row is met by every tree of every level in the JVM, with a
look-up of its node and an update of the sums of each drawn feature.  Rows whose features are levels of few categorical
columns and binned numbers are small, about a byte for each column, so that many rows fit into a task; there a tree
takes one histogram of a column over all nodes of a level, which has the sums of all indicator features of that column.

The trees are those of Spark's definition: Poisson bootstrap, Gini gain, a draw of features for each node, the least rows
of a child, a depth.  They are stored as Spark stores a forest, and read by it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import remove, scratch_dir

#: Bytes of all coded rows that a task may hold.
MOST_BYTES = 160_000_000
#: Rows from which this takes less time than Spark's passes; over 90,000 rows it did not.
LEAST_ROWS = 250_000
#: Trees of a job: short jobs let those of other candidates in between.
TREES = 2


@dataclass
class Column:
    """A categorical column, whose level k is the indicator feature ``first + k``, or a number with its thresholds."""
    first: int
    levels: int
    thresholds: np.ndarray | None = None

    @property
    def size(self) -> int:
        """Codes: levels and one for none of them, or bins."""
        return self.levels + 1 if self.thresholds is None else len(self.thresholds) + 1

    @property
    def features(self) -> int:
        return self.levels if self.thresholds is None else 1


@dataclass
class Tree:
    """Nodes, parents before children; ``left`` is -1 for a leaf, ``right`` is the node after ``left``."""
    counts: np.ndarray
    gain: np.ndarray
    left: np.ndarray
    column: np.ndarray
    code: np.ndarray


def _gini(c: np.ndarray) -> np.ndarray:
    """Rows times Gini impurity."""
    s = c.sum(-1)
    return s - (c * c).sum(-1) / np.maximum(s, 1.0)


def grow(codes: np.ndarray, y: np.ndarray, columns: Sequence[Column], seed: Sequence[int], depth: int, least: int, drawn: int) -> Tree:
    """One tree.  ``codes`` has a line for each column, ``y`` is 0 or 1; ``drawn`` features are considered at a node."""
    r = np.random.default_rng(seed)
    width = sum(c.features for c in columns)
    weight = r.poisson(1.0, len(y))
    rows = np.flatnonzero(weight)
    w, codes, label = weight[rows].astype(np.float64), codes[:, rows], y[rows].astype(np.int64)
    at, node = None, np.zeros(len(rows), dtype=np.int64)        # rows of open nodes (None: all), and their nodes
    counts, gains, lefts, cols, cuts = [np.bincount(label, weights=w, minlength=2)[None, :]], [], [], [], []
    for level in range(depth + 1):
        total = counts[-1]
        m = len(total)
        best, col, cut = np.zeros(m), np.full(m, -1), np.zeros(m, dtype=np.int64)
        if level < depth and len(node):
            some = r.random((m, width)).argpartition(min(drawn, width) - 1, axis=1)[:, :drawn]
            open_ = np.zeros((m, width), dtype=bool)
            open_[np.arange(m)[:, None], some] = True
            whole, size = _gini(total), total.sum(1)
            pair = 2 * node + label
            for k, c in enumerate(columns):
                code = codes[k] if at is None else codes[k][at]
                key = np.multiply(code, 2 * m, dtype=np.int64)
                key += pair
                h = np.bincount(key, weights=w, minlength=2 * m * c.size).reshape(c.size, m, 2).swapaxes(0, 1)
                if c.thresholds is None:        # an indicator is 0 on the left
                    left = total[:, None, :] - h[:, :c.levels]
                else:
                    left = h.cumsum(1)[:, :-1]
                if not left.shape[1]:
                    continue
                right = total[:, None, :] - left
                may = open_[:, c.first:c.first + c.features] & (left.sum(2) >= least) & (right.sum(2) >= least)
                gain = np.where(may, (whole[:, None] - _gini(left) - _gini(right)) / np.maximum(size, 1.0)[:, None], 0.0)
                first = gain.argmax(1)
                most = gain[np.arange(m), first]
                more = most > best
                best[more], col[more], cut[more] = most[more], k, first[more]
        parted = np.flatnonzero((col >= 0) & (best > 1e-12))
        child = np.full(m, -1)
        child[parted] = 2 * np.arange(len(parted))
        gains.append(best), lefts.append(child), cols.append(col), cuts.append(cut)
        if not len(parted):
            break
        keep = np.flatnonzero(child[node] >= 0)
        if len(keep) < len(node):
            at = keep if at is None else at[keep]
            node, w, label = node[keep], w[keep], label[keep]
        place = np.arange(codes.shape[1]) if at is None else at
        code, limit = codes[col[node], place], cut[node]
        up = np.where(np.array([c.thresholds is None for c in columns])[col[node]], code == limit, code > limit)
        node = child[node] + up
        counts.append(np.bincount(2 * node + label, weights=w, minlength=4 * len(parted)).reshape(-1, 2))
    ends = np.cumsum([len(c) for c in counts])
    left = np.concatenate([np.where(c >= 0, c + end, -1) for c, end in zip(lefts, ends)])
    return Tree(np.concatenate(counts), np.concatenate(gains), left, np.concatenate(cols), np.concatenate(cuts))


def pruned(t: Tree) -> Tree:
    """Without splits whose two sides are leaves that say the same, as Spark prunes."""
    left, says = t.left.copy(), t.counts.argmax(1)
    for k in np.flatnonzero(left >= 0)[::-1]:
        a = left[k]
        if left[a] < 0 and left[a + 1] < 0 and says[a] == says[a + 1]:
            left[k] = -1
    kept = np.zeros(len(left), dtype=bool)
    kept[0] = True
    for k in np.flatnonzero(left >= 0):
        if kept[k]:
            kept[left[k]:left[k] + 2] = True
    place = np.cumsum(kept) - 1
    return Tree(t.counts[kept], t.gain[kept], np.where(left >= 0, place[left], -1)[kept], t.column[kept], t.code[kept])


def _thresholds(t: DataFrame, name: str, bins: int) -> np.ndarray:
    """Midpoints of few different values, else quantiles."""
    few = sorted(r[0] for r in t.select(name).distinct().limit(bins + 1).collect())
    if len(few) <= bins:
        return np.array([(a + b) / 2 for a, b in zip(few, few[1:])])
    return np.unique(t.approxQuantile(name, [k / bins for k in range(1, bins)], 1e-3))


def coded(train: DataFrame, labels: Sequence[Sequence[str]], indexed: Sequence[str], scaled: str, numbers: int,
          bins: int) -> tuple[list[Column], DataFrame, np.dtype]:
    """Columns in the order of the features, and the rows' codes: blocks of a label line and a line for each column."""
    columns, first = [], 0
    for levels in labels:
        columns.append(Column(first, len(levels)))
        first += len(levels)
    t = train.withColumn("__v", vector_to_array(scaled)).select("label", *indexed, *[F.col("__v")[i].alias(f"__n{i}") for i in range(numbers)])
    folder = f"{scratch_dir(train.sparkSession, 'forest')}/rows"      # passed over for each number's thresholds
    t.write.parquet(folder)
    t = train.sparkSession.read.schema(t.schema).parquet(folder)
    for i in range(numbers):
        columns.append(Column(first + i, 0, _thresholds(t, f"__n{i}", bins)))
    kind = np.dtype(np.uint8 if max(c.size for c in columns) <= 256 else np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [b.column(k).to_numpy(zero_copy_only=False) for k in range(b.num_columns)]
            block = np.stack([lines[0].astype(kind), *(v.astype(kind) if c.thresholds is None else np.searchsorted(c.thresholds, v).astype(kind)
                                                       for c, v in zip(columns, lines[1:]))])
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["n", "block"])
    return columns, t.mapInArrow(run, "n int, block binary"), kind


def fits(n: int, labels: Sequence[Sequence[str]], numbers: int, bins: int) -> bool:
    """Whether a task can hold so many coded rows."""
    return n * (1 + len(labels) + numbers) * (1 if max([bins, *(len(x) + 1 for x in labels)]) <= 256 else 2) <= MOST_BYTES


def fit(columns: Sequence[Column], blocks: DataFrame, kind: np.dtype, rf: RandomForestClassifier,
        shell: RandomForestClassificationModel) -> RandomForestClassificationModel:
    """The forest of ``rf`` over coded rows; ``shell`` is one that Spark has fitted, which gives all but the trees."""
    spark = blocks.sparkSession
    parts = [np.frombuffer(r["block"], dtype=kind).reshape(1 + len(columns), r["n"]) for r in blocks.toLocalIterator()]
    sent = spark.sparkContext.broadcast(np.concatenate(parts, axis=1))
    del parts
    trees, seed, depth, least = rf.getNumTrees(), rf.getSeed(), rf.getMaxDepth(), rf.getMinInstancesPerNode()
    drawn = int(np.ceil(np.sqrt(sum(c.features for c in columns))))
    first, binary = np.array([c.first for c in columns]), np.array([c.thresholds is None for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree in b.column(0).to_pylist():
                t = pruned(grow(sent.value[1:], sent.value[0], columns, [seed, tree], depth, least, drawn))
                size, inner = t.counts.sum(1), t.left >= 0
                said = [[0.0] if binary[k] else [float(columns[k].thresholds[c])] for k, c in zip(t.column[inner], t.code[inner])]
                value = np.full(len(inner), None, dtype=object)
                value[:] = [[]] * len(inner)
                value[inner] = np.fromiter(said, dtype=object, count=len(said))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(inner), tree, dtype=np.int32)), pa.array(np.arange(len(inner), dtype=np.int32)),
                    pa.array(t.counts.argmax(1).astype(np.float64)), pa.array(_gini(t.counts) / np.maximum(size, 1.0)),
                    pa.array(t.counts.tolist(), pa.list_(pa.float64())), pa.array(size.astype(np.int64)),
                    pa.array(np.where(inner, t.gain, -1.0)), pa.array(t.left.astype(np.int32)),
                    pa.array(np.where(inner, t.left + 1, -1).astype(np.int32)),
                    pa.array(np.where(inner, first[t.column] + np.where(binary[t.column], t.code, 0), -1).astype(np.int32)),
                    pa.array(list(value), pa.list_(pa.float64())),
                    pa.array(np.where(inner & binary[t.column], 2, -1).astype(np.int32))], names)
    names = ["treeID", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild",
             "featureIndex", "leftCategoriesOrThreshold", "numCategories"]
    folder = scratch_dir(spark, "forest")
    schema = ("treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
              "rightChild int, featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int")

    def some(lo: int) -> None:
        nodes = spark.range(lo, min(lo + TREES, trees), 1, 1).mapInArrow(run, schema)
        nodes.select("treeID", F.struct(*names[1:9], F.struct(*names[9:]).alias("split")).alias("nodeData")).write.parquet(
            f"{folder}/model/data/job={lo}")
    with ThreadPoolExecutor(max_workers=spark.sparkContext.defaultParallelism) as pool:
        list(pool.map(some, range(0, trees, TREES)))
    sent.unpersist()
    # all but the trees as Spark has written it
    shell.write().save(f"{folder}/shell")
    whole = {"maxDepth": depth, "numTrees": trees}
    said = json.loads(spark.read.text(f"{folder}/shell/metadata").first()["value"])
    said["paramMap"] |= whole
    said["numTrees"] = trees
    spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{folder}/model/metadata")
    of = json.loads(spark.read.parquet(f"{folder}/shell/treesMetadata").first()["_2"])
    of["paramMap"] |= {"maxDepth": depth}
    spark.range(trees).select(F.col("id").cast("int").alias("_1"), F.lit(json.dumps(of)).alias("_2"), F.lit(1.0).alias("_3")).coalesce(1).write.parquet(
        f"{folder}/model/treesMetadata")
    model = RandomForestClassificationModel.load(f"{folder}/model")
    remove(spark, folder)       # the trees are read
    return model
