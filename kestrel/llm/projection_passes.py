"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets the signs of its products with random directions,
one bit after the other.  Products are taken from a centre: the mean of the sampled
vectors that share the bits so far, so that a dense region is split as evenly as
any other.  Sorted by these bits, vectors of a small angle tend to be neighbours,
and each vector is compared with its next ``WINDOW`` neighbours.

How many passes that takes is measured, not assumed.  Where keys are sorted, each
vector sees how many bits leave no more than a window around it; its distances from
the centres of these bits bound the probability that a partner at the threshold
shares them (`agreement`), whatever the data is like.  Vectors for which all passes
together do not reach the target probability go through further passes among
themselves, with centres of their own (a pair is settled when one of its ends is).
When passes would take more comparisons than all pairs of the vectors left over,
all these pairs are compared, block by block.  Pairs that reach the threshold in
double precision are links.

The union of all passes is taken as a spanning forest.  Windows are bounded, so
pairs of a large group may never be neighbours themselves: inside the components
all pairs are compared, block by block, which gives the exact number of links.

Defined results: vectors that are null, zero, or hold nulls or values that are not
finite link with nothing, as do vectors of different lengths; equal vectors are
compared once and count as often as they occur; rows that repeat count as vectors
of their own; a null id comes after all others and stays null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import staged
from kestrel.llm.components import components, roots

THRESHOLD = 0.95
#: Bits of a sort key, neighbours compared, and the probability with which a pair at the threshold must meet.
BITS, WINDOW, RECALL, SEED = 48, 64, 0.9995, 17
#: Passes made at first, relative to evenly spread keys, and passes of a further round at most.
SPARE, ROUND = 1.5, 64
#: Vectors (and bytes of them) sampled for centres, and the fewest that make one; the sample moves centres only, every vector is compared.
SAMPLE, SAMPLE_BYTES, CENTRE = 8192, 1 << 24, 32
#: Vectors in a block of a large component, or of what passes do not settle.
BLOCK = 1024
_NULL = (1 << 63) - 1


def passes(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which two vectors at the threshold have been neighbours with probability ``recall``.

    They are when they agree on the bits that leave about a window of the n vectors.  For evenly
    spread keys: where to start from.
    """
    agree = 1 - math.acos(threshold) / math.pi
    met = agree ** max(1.0, math.log2(max(2, n) / window) + 1)
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def unit(rows: list[list[float] | None]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, in double precision, of the rows that have a direction, and which rows these are."""
    sizes = [len(r) if r else 0 for r in rows]
    out = np.zeros((len(rows), max([1, *sizes])))
    ok = np.zeros(len(rows), dtype=bool)
    for i, r in enumerate(rows):
        if r and None not in r:
            v = np.asarray(r, dtype=np.float64)
            top = np.abs(v).max()
            if np.isfinite(top) and top > 0:
                v = v / top                     # no overflow of squares
                out[i, :len(v)] = v / math.sqrt(float(v @ v))
                ok[i] = True
    return out, ok


def agreement(distance: np.ndarray, threshold: float) -> np.ndarray:
    """Logarithm of the least probability with which a vector shares a bit with a partner at the threshold.

    Seen from a centre at this distance, the two are apart by an angle of asin(apart / distance) at most.
    """
    ratio = math.sqrt(max(0.0, 2 - 2 * threshold)) / np.maximum(distance, 1e-9)
    return np.log(np.where(ratio < 1, 1 - np.arcsin(np.minimum(ratio, 1)) / math.pi, 0.02))


def centres(sample: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, its products with the directions, next node for either bit) of each node of the prefixes in the sample."""
    products = sample @ directions
    centre, after = [sample.mean(axis=0) if len(sample) else np.zeros(len(directions))], [[0, 0]]
    todo = [(0, np.arange(len(sample)), 0)] if len(sample) >= CENTRE else []
    while todo:
        node, rows, bit = todo.pop()
        up = products[rows, bit] > centre[node] @ directions[:, bit]
        for side, some in enumerate((rows[~up], rows[up])):
            after[node][side] = child = len(centre)
            after.append([child, child])
            centre.append(sample[some].mean(axis=0) if len(some) >= CENTRE else centre[node])
            if len(some) >= CENTRE and bit + 1 < BITS:
                todo.append((child, some, bit + 1))
    found = np.array(centre)
    return found, found @ directions, np.array(after)


def _keys(x: np.ndarray, directions: np.ndarray, tree: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of unit vectors of one length, and for each number of bits the summed `agreement`."""
    centre, cut, after = tree
    products, node = x @ directions, np.zeros(len(x), dtype=np.int64)
    bits, agreed = np.empty((len(x), BITS), dtype=bool), np.empty((len(x), BITS))
    now = agreement(np.linalg.norm(x - centre[node], axis=1), threshold)
    for k in range(BITS):
        bits[:, k], agreed[:, k] = products[:, k] > cut[node, k], now
        child = after[node, bits[:, k].astype(np.int64)]
        moved = np.flatnonzero(child != node)
        if not len(moved):
            bits[:, k:], agreed[:, k:] = products[:, k:] > cut[node, k:], now[:, None]
            break
        node = child
        now[moved] = agreement(np.linalg.norm(x[moved] - centre[node[moved]], axis=1), threshold)
    return bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)), np.cumsum(agreed, axis=1)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that keys have in common."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _missed(keys: np.ndarray, agreed: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """For sorted (pass, size, key), the logarithm of the probability that a partner is not in the row's window.

    It is there when the two share so many bits that no more than a window of rows do.  Rows that share bits
    with one of ``edges`` may go on in another task, and count as more than a window.
    """
    n, ahead = len(keys), WINDOW + 1
    bits = np.full(n + ahead, -1)
    if n > ahead:
        a, b = keys[:-ahead], keys[ahead:]
        bits[ahead:n] = np.where((a[:, :2] == b[:, :2]).all(axis=1), _shared(a[:, 2], b[:, 2]), -1)
    bits = np.lib.stride_tricks.sliding_window_view(bits, ahead + 1).max(axis=1)
    for e in edges:
        bits = np.maximum(bits, np.where((keys[:, :2] == e[:2]).all(axis=1), _shared(keys[:, 2], e[2]), -1))
    met = np.exp(agreed[np.arange(n), np.clip(bits, 0, BITS - 1)].astype(np.float64))
    met = np.where(bits < 0, 1.0, np.where(bits >= BITS, 0.0, met))
    return np.log1p(-np.minimum(met, 1 - 1e-9))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(c, o, copies, size, vector): the vectors that can be linked, equal ones once; o is the smallest id."""
    good = rows.where("size(vector) > 0").where(
        ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("vector", lambda v: v != 0))
    return good.groupBy("c").agg(F.min("o").alias("o"), F.count("*").alias("copies"), F.size(F.first("vector")).alias("size"),
                                 F.first("vector").alias("vector"))


def _samples(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Sampled unit vectors of each length."""
    longest = vectors.agg(F.max("size")).first()[0] or 1
    most = max(CENTRE, min(SAMPLE, SAMPLE_BYTES // (8 * longest)))
    mark = F.xxhash64(F.lit("centres"), F.lit(n), F.col("c"))
    rows = vectors.select("size", "vector", "c").orderBy(mark, "c").limit(most).collect()
    return {size: unit([r.vector for r in rows if r.size == size])[0] for size in {r.size for r in rows}}


def one_round(vectors: DataFrame, first: int, n: int, threshold: float) -> DataFrame:
    """(a, b, missed): links that connect whatever the windows of passes ``first`` to ``first + n`` have linked,
    and with b null what `_missed` says of vector a in each pass."""
    sent = vectors.sparkSession.sparkContext.broadcast(_samples(vectors, first))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            keys = np.empty((len(sizes), n), dtype=np.int64)
            agreed = np.empty((len(sizes), n, BITS), dtype="<f2")
            for size in np.unique(sizes).tolist():
                if size not in trees and size in sent.value:
                    drawn = [np.random.default_rng([SEED, first + k, size]).standard_normal((size, BITS)) for k in range(n)]
                    trees[size] = [(d, centres(sent.value[size], d)) for d in drawn]
                some = np.flatnonzero(sizes == size)
                x = unit([raw[i] for i in some])[0]
                for k in range(n):
                    # a length that the sample lacks: signs from the origin
                    if size in trees:
                        directions, tree = trees[size][k]
                    else:
                        directions = np.random.default_rng([SEED, first + k, size]).standard_normal((size, BITS))
                        tree = centres(np.zeros((0, size)), directions)
                    keys[some, k], agreed[some, k] = _keys(x, directions, tree, threshold)
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * n)
            flat = agreed.reshape(-1, BITS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))),
                 pa.ListArray.from_arrays(offsets, pa.array([row.tobytes() for row in flat], pa.binary()))],
                ["c", "size", "vector", "keys", "agreed"])

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None       # the last rows: unit vectors, (pass, size, key), c, agreed
        first_row, told = None, 0       # where the task starts; rows held that `_missed` was asked for

        def tell(lo: int, hi: int, edges: list[np.ndarray]) -> pa.RecordBatch:
            missed = _missed(held[1], held[3], edges)[lo:hi]
            return pa.RecordBatch.from_arrays([pa.array(held[2][lo:hi]), pa.nulls(hi - lo, pa.int64()), pa.array(missed)], ["a", "b", "missed"])
        for batch in batches:
            if not batch.num_rows:
                continue
            x, _ = unit(batch.column(4).to_pylist())
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 3, 1)], axis=1)
            rows = x, keys, batch.column(2).to_numpy(), np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype="<f2").reshape(-1, BITS)
            old = 0
            if held is None:
                first_row = keys[0]
            else:
                old, width = len(held[2]), max(x.shape[1], held[0].shape[1])
                x = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in (held[0], x)])
                rows = x, *(np.concatenate([u, v]) for u, v in zip(held[1:], rows[1:]))
            held = rows
            x, keys, c, _ = held
            number = np.unique(keys[:, :2], axis=0, return_inverse=True)[1].reshape(-1)
            links = []
            for lo in range(0, len(c), 256):
                hi = min(len(c), lo + 256 + WINDOW)
                near = x[lo:lo + 256] @ x[lo:hi].T >= threshold
                i, j = np.nonzero(near)
                ok = (j > i) & (j - i <= WINDOW) & (lo + j >= old) & (number[lo + i] == number[lo + j])
                links += zip(c[lo + i[ok]].tolist(), c[lo + j[ok]].tolist())
            if out := _forest(links):
                yield pa.RecordBatch.from_arrays([*out, pa.nulls(len(out[0]), pa.float64())], ["a", "b", "missed"])
            if (sure := len(c) - WINDOW - 1) > told:
                yield tell(told, sure, [first_row])
                told = sure
            gone = max(0, len(c) - 2 * (WINDOW + 1))
            held, told = tuple(v[gone:] for v in held), told - gone
        if held is not None:
            yield tell(told, len(held[2]), [first_row, held[1][-1]])

    spread = vectors.select("c", "size", "vector").mapInArrow(keyed, "c long, size int, vector array<double>, keys array<long>, agreed array<binary>")
    spread = spread.select("c", "size", "vector", F.posexplode(F.arrays_zip("keys", "agreed")).alias("pass", "z")).select(
        "pass", F.col("z.keys").alias("key"), "c", "size", "vector", F.col("z.agreed").alias("agreed"))
    parts = max(2, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = spread.repartitionByRange(parts, "pass", "size", "key", "c").sortWithinPartitions("pass", "size", "key", "c")
    return ordered.mapInArrow(slide, "a long, b long, missed double")


def _forest(links: list[tuple[int, int]]) -> list[pa.Array]:
    """Links that connect the same, as two arrays; empty when there are none."""
    out = [(a, b) for a, b in roots(iter(links)).items() if a != b]
    return [pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)] if out else []


def _block_pairs(rows: DataFrame, by: list[str], *columns: str) -> DataFrame:
    """Every row for each pair (i, j) of blocks that its own is in; ``blocks`` says how many its group has."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    return rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *by, F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", *columns)


def all_links(vectors: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b) links that connect whatever is linked among n vectors, block against block."""
    def meet(key: tuple, t: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        block, c, size = (t.column(k).to_numpy() for k in ("block", "c", "size"))
        x, _ = unit(t.column("vector").to_pylist())
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links: list[tuple[int, int]] = []
        for lo in range(0, len(left), BLOCK):
            some = left[lo:lo + BLOCK]
            near = (x[some] @ x[right].T >= threshold) & (size[some][:, None] == size[right][None, :]) & (some[:, None] != right[None, :])
            u, v = np.nonzero(near)
            links = list(zip(*(o.to_pylist() for o in _forest([*links, *zip(c[some[u]].tolist(), c[right[v]].tolist())]))))
        return pa.table(_forest(links) or [pa.array([], pa.int64())] * 2, names=["a", "b"])
    rows = _block_pairs(vectors.withColumn("blocks", F.lit(math.ceil(n / BLOCK))), [], "c", "size", "vector")
    return rows.groupBy("i", "j").applyInArrow(meet, "a long, b long")


def neighbour_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links that connect whatever is linked: by passes, and all pairs of what passes do not settle."""
    rest, n, tried, goal = vectors.select("c", "size", "vector", F.lit(0.0).alias("missed")), vectors.count(), 0, math.log(1 - RECALL)
    more, found = math.ceil(SPARE * passes(n, threshold)), None
    while True:
        made = staged(one_round(rest, tried, more, threshold))
        tried += more
        links = made.where("b IS NOT NULL").select("a", "b")
        found = links if found is None else found.union(links)
        now = made.where("b IS NULL").groupBy("a").agg(F.sum("missed").alias("now"))
        rest = staged(rest.join(now, rest["c"] == now["a"]).select("c", "size", "vector", (F.col("missed") + F.col("now")).alias("missed"))
                      .where(F.col("missed") > goal))
        n, typical = rest.agg(F.count("*"), F.percentile_approx("missed", 0.5)).first()
        if not n:
            return found
        more = math.ceil(tried * (goal / min(typical, -1e-9) - 1))
        if 2 * WINDOW * more >= n:
            return found.union(all_links(rest, n, threshold))
        more = min(more, ROUND)


def link_counts(vectors: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """(c, links): how many vectors of the others in its component each is linked with, block against block."""
    sizes = comps.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = vectors.join(comps, vectors["c"] == comps["node"]).join(sizes, "component")
    rows = _block_pairs(rows, ["component"], "c", "copies", "size", "vector")

    def meet(key: tuple, t: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, c, copies, size = (t.column(k).to_numpy() for k in ("block", "c", "copies", "size"))
        x, _ = unit(t.column("vector").to_pylist())
        links = np.zeros(len(c), dtype=np.int64)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for lo in range(0, len(left), BLOCK):
            some = left[lo:lo + BLOCK]
            near = (x[some] @ x[right].T >= threshold) & (size[some][:, None] == size[right][None, :]) & (some[:, None] != right[None, :])
            links[some] += near @ copies[right]
            if i != j:
                links[right] += near.T @ copies[some]
        return pa.table({"c": pa.array(c), "links": pa.array(links)})
    return rows.groupBy("component", "i", "j").applyInArrow(meet, "c long, links long").groupBy("c").agg(F.sum("links").alias("links"))


def link(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = embeddings.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL)).alias("o"),
                             F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("c", F.xxhash64("vector", F.size("vector")))
    vectors = staged(distinct_vectors(rows))
    found = neighbour_links(vectors, threshold)
    comps = staged(components(found))
    counts = link_counts(vectors, comps, threshold)
    low = vectors.join(comps, vectors["c"] == comps["node"], "left").select("c", "o", "copies", F.coalesce("component", "c").alias("g"))
    first = low.groupBy("g").agg(F.min("o").alias("first"))
    named = low.join(first, "g").join(counts, "c", "left").select(
        "c", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("o", "c").join(named, "c", "left").select(
        "o", F.coalesce("first", "o").alias("g"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.select(F.when(F.col("o") < _NULL, F.col("o")).alias("vec_id"), "n_links",
                      F.when(F.col("g") < _NULL, F.col("g")).alias("component_id"), (F.col("o") == F.col("g")).alias("kept"))
