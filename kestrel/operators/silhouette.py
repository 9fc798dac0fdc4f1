"""Mean Euclidean silhouette of several clusterings at once (ML-20).

The silhouette of a point needs its mean distance to every cluster, so all
distances are taken.  Points are dealt to blocks, a task for each; slabs of blocks, of bounded
size, are broadcast.  Within a slab a pair of blocks is met by one of its two tasks, which adds
up its distances for the points of both; points of other slabs are met from each side.  Only sums
leave a task, a few for each point: what is exchanged grows with the points and the cores, not with
the pairs of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import FEW_ROWS, cut_lineage

#: Points of a slab; rows and columns whose distances are held at once.
SLAB, ROWS, COLUMNS = 1 << 20, 128, 256


def _matrix(lists: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = [c.flatten() for c in (lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists])]
    return np.concatenate([f.to_numpy(zero_copy_only=False) for f in flat]).reshape(n, -1) if n else np.zeros((0, 0))


@dataclass
class Block:
    """Points with their numbers and labels, points of equal labels (a group) side by side."""
    at: np.ndarray
    points: np.ndarray
    labels: np.ndarray
    groups: np.ndarray

    @classmethod
    def of(cls, t: pa.Table) -> Block:
        at, points = t.column("at").to_numpy(), _matrix(t.column("vector"), t.num_rows).astype(np.float64)
        labels = _matrix(t.column("labels"), t.num_rows).astype(np.int32)
        groups = np.unique(labels, axis=0, return_inverse=True)[1].reshape(-1)
        order = np.argsort(groups, kind="stable")
        return cls(at[order], points[order], labels[order], groups[order])

    def chunks(self, size: int, clusters: Sequence[int]) -> list[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By slices: points, their squares, to which group of the slice each belongs, and to which clusters each group."""
        first, out = np.cumsum([0, *clusters])[:-1], []
        for lo in range(0, len(self.at), size):
            part = slice(lo, lo + size)
            x, found = self.points[part], np.unique(self.groups[part], return_index=True)[1]
            one = np.zeros((len(x), len(found)))
            one[np.arange(len(x)), np.searchsorted(found, np.arange(len(x)), side="right") - 1] = 1
            member = np.zeros((len(found), sum(clusters)))
            member[np.arange(len(found))[:, None], first[None, :] + self.labels[lo + found]] = 1
            out.append((part, x, (x * x).sum(1), one, member))
        return out


def meet(a: Block, b: Block, clusters: Sequence[int], to_a: np.ndarray, to_b: np.ndarray | None) -> None:
    """Add to ``to_a`` for each point of ``a`` its distances to the clusters of ``b``, and the other way round to ``to_b``."""
    left = [(*c, np.column_stack([-2 * c[1], c[2], np.ones(len(c[1]))])) for c in a.chunks(ROWS, clusters)]
    for cols, y, yy, one_y, member_y in b.chunks(COLUMNS, clusters):
        # the squared distance as one product: (-2x, xx, 1) . (y, 1, yy)
        right, most = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), yy]).T), yy.max()
        for rows, x, xx, one_x, member_x, said in left:
            d = said @ right
            # by differences where the product form would cancel
            least = 1e-6 * (xx + most)
            close = np.flatnonzero(d.min(1) < least)
            if len(close):
                i, j = np.nonzero(d[close] < least[close, None])
                i = close[i]
                d[i, j] = ((x[i] - y[j]) ** 2).sum(1)
            np.sqrt(d, out=d)
            to_a[rows] += (d @ one_y) @ member_y
            if to_b is not None:
                to_b[cols] += (d.T @ one_x) @ member_x


def turn(own: int, other: int, blocks: int) -> bool:
    """Whether of two blocks of a slab it is ``own`` whose task takes the pair; each block has half of the others."""
    ahead = (other - own) % blocks
    return 2 * ahead < blocks or 2 * ahead == blocks and own < other


def partial_sums(points: DataFrame, clusters: Sequence[int], blocks: int, slab: int) -> DataFrame:
    """(at, labels, s0, s1, ...): sums that one task has for a point, of distances to points of one slab.

    ``points`` are written in as many partitions as there are blocks in all, ``blocks`` for each slab.
    """
    names = [f"s{k}" for k in range(sum(clusters))]
    mine = F.shiftright("at", 33)
    t = points.where(mine.between(slab * blocks, (slab + 1) * blocks - 1)).select("at", "vector", "labels").toArrow()
    of = t.column("at").to_numpy() >> 33
    sent = points.sparkSession.sparkContext.broadcast({int(p): Block.of(t.filter(pa.array(of == p))) for p in np.unique(of)})

    def rows(b: Block, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(b.at), 10_000):
            part = slice(lo, lo + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(b.at[part]), pa.array(list(b.labels[part]), pa.list_(pa.int32())),
                                              *(pa.array(c) for c in sums[part].T.copy())], ["at", "labels", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [b for b in batches if b.num_rows]
        if not have:
            return
        own = Block.of(pa.Table.from_batches(have))
        me = int(own.at[0] >> 33)
        to_own = np.zeros((len(own.at), len(names)))
        for p, other in sent.value.items():
            if p == me or me not in sent.value:
                meet(own, other, clusters, to_own, None)
            elif turn(me, p, blocks):
                to_other = np.zeros((len(other.at), len(names)))
                meet(own, other, clusters, to_own, to_other)
                yield from rows(other, to_other)
        yield from rows(own, to_own)
    return points.mapInArrow(run, "at long, labels array<int>, " + ", ".join(f"{n} double" for n in names))


def cluster_sums(points: DataFrame, clusters: Sequence[int], slab: int = SLAB) -> DataFrame:
    """(labels, s0, s1, ...): for each point the sum of its distances to each cluster of each clustering.

    ``points`` has vector and labels, one label from 0 on for each clustering; ``clusters`` says how many clusters each has.
    """
    points = cut_lineage(points.select("vector", "labels"))
    n, cores = points.count(), points.sparkSession.sparkContext.defaultParallelism
    slabs = max(1, -(-n // slab))
    blocks = max(1, min(2 * cores, -(-n // (slabs * FEW_ROWS))))
    # points may be equal: they are numbered where they are written
    dealt = cut_lineage(cut_lineage(points.repartition(slabs * blocks)).withColumn("at", F.monotonically_increasing_id()))
    out = None
    for s in range(slabs):
        parts = partial_sums(dealt, clusters, blocks, s)
        some = parts if out is None else out.unionByName(parts)
        out = some.groupBy("at").agg(F.first("labels").alias("labels"), *[F.sum(c).alias(c) for c in parts.columns[2:]])
        out = cut_lineage(out) if slabs > 1 else out
    return out


def mean_silhouettes(points: DataFrame, clusters: Sequence[int], block: int = SLAB) -> list[float]:
    """The mean silhouette of each clustering; a point alone in its cluster counts 0."""
    first = np.cumsum([0, *clusters])[:-1].tolist()
    sums = cluster_sums(points, clusters, block)
    counted = points.select("labels").agg(*[F.count_if(F.element_at("labels", k + 1) == c).alias(f"n{first[k] + c}")
                                            for k, m in enumerate(clusters) for c in range(m)]).first()
    scores = []
    for k, m in enumerate(clusters):
        own = F.element_at("labels", k + 1)
        sizes = [counted[f"n{first[k] + c}"] for c in range(m)]

        def pick(values: Sequence[Column]) -> Column:
            out = values[0]
            for c in range(1, len(values)):
                out = F.when(own == c, values[c]).otherwise(out)
            return out
        mine, size = pick([F.col(f"s{first[k] + c}") for c in range(m)]), pick([F.lit(s) for s in sizes])
        others = [F.when((own != c) & F.lit(sizes[c] > 0), F.col(f"s{first[k] + c}") / F.lit(max(sizes[c], 1))) for c in range(m)]
        a, b = mine / (size - 1), F.least(*others) if m > 1 else F.lit(None).cast("double")
        scores.append(F.when(size <= 1, F.lit(0.0)).otherwise(F.coalesce((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)), F.lit(0.0))))
    row = sums.agg(*[F.avg(s).alias(f"m{k}") for k, s in enumerate(scores)]).first()
    return [row[f"m{k}"] for k in range(len(clusters))]
