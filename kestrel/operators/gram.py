"""Least squares on sparse rows: X'WX in long form (EX-11, ML-09).

A row of a design is an array of its non-zero terms.  Every task adds up the products
of the pairs of non-zero terms of its rows (`_products`), so work follows the number of
non-zero terms, not the square of the number of columns, and sends one (i, j, sum) for
each pair of terms it has seen.  The k x k matrix that a solution needs, k being the
number of terms of the model, is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import special
from kestrel.session import cut_lineage

#: Terms of a model at most: a matrix of them is solved on the driver.
MOST_TERMS = 4000
#: The outcome, carried along as one more term.
OUTCOME = "__y"
#: Pairs of terms taken at once, if a row has no more.
PAIRS = 1 << 19


def with_outcome(x: Column, y: Column) -> Column:
    """The terms of a row and its outcome."""
    return F.concat(x, F.array(F.struct(F.lit(OUTCOME).alias("term"), y.cast("double").alias("value"))))


def _products(at: np.ndarray, value: np.ndarray, ends: np.ndarray, w: np.ndarray, k: int, total: np.ndarray) -> None:
    """Add the weighted products of the pairs of terms of each row to ``total``: a k x k matrix as one vector, and which
    of its cells were met.

    Row r has the terms ``at[ends[r]:ends[r + 1]]``, numbered below k.
    """
    sizes = np.diff(ends)
    upto = np.concatenate([[0], np.cumsum(sizes * (sizes + 1) // 2)])
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + PAIRS, side="right")) - 1)
        a, b = ends[lo], ends[hi]
        left_of = np.repeat(ends[lo + 1:hi + 1], sizes[lo:hi]) - np.arange(a, b)       # terms of the row from here on
        first = np.repeat(np.arange(b - a), left_of)
        second = first + np.arange(len(first)) - np.repeat(np.cumsum(left_of) - left_of, left_of)
        t, v = at[a:b].astype(np.int64), value[a:b]
        v_w = v * np.repeat(w[lo:hi], sizes[lo:hi])
        cell = np.minimum(t[first], t[second]) * k + np.maximum(t[first], t[second])
        product = v_w[first] * v[second]
        if k * k <= 4 * len(cell):
            total[0] += np.bincount(cell, product, k * k)
            total[1, cell] = 1
        else:
            cells, place = np.unique(cell, return_inverse=True)
            total[0, cells] += np.bincount(place, product, len(cells))
            total[1, cells] = 1
        lo = hi


def _entries(terms: Sequence[str], total: np.ndarray) -> pa.RecordBatch:
    """The cells of a matrix that were met, as (i, j, v) with i <= j by name."""
    k, names = len(terms), np.array(terms, dtype=object)
    cells = np.flatnonzero(total[1])
    i, j = names[cells // k], names[cells % k]
    swap = (i > j).astype(bool)
    return pa.RecordBatch.from_arrays([pa.array(np.where(swap, j, i).tolist(), pa.string()), pa.array(np.where(swap, i, j).tolist(), pa.string()),
                                       pa.array(total[0, cells])], ["i", "j", "v"])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("i", "j").agg(F.sum("v").alias("sum"))


def _flat(x: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Terms, values and ends of the rows of a column of designs; terms without a value are left out."""
    ends, inner = x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), x.flatten()
    term, value = inner.field(0), inner.field(1)
    if term.null_count or value.null_count:
        some = np.logical_and(term.is_valid().to_numpy(zero_copy_only=False), value.is_valid().to_numpy(zero_copy_only=False))
        ends = np.bincount(np.repeat(np.arange(len(ends)), ends)[some], minlength=len(ends))
        term, value = term.filter(pa.array(some)), value.filter(pa.array(some))
    return term, value.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)


def gram(rows: DataFrame, x: Column, weight: Column | None = None) -> DataFrame:
    """(i, j, sum): sums of products of terms i <= j over all rows, each row times its weight.

    A task keeps the sums of at most ``MOST_TERMS`` terms; when it meets more, it sends what it has and goes on.
    """
    w = F.lit(1.0) if weight is None else weight
    src = rows.select(x.alias("x"), w.cast("double").alias("w")).where(F.col("w").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        total = np.zeros((2, 0))
        for b in batches:
            term, value, ends = _flat(b.column(0))
            ws = b.column(1).to_numpy(zero_copy_only=False)
            coded = term.dictionary_encode()
            here = coded.dictionary.to_pylist()
            if known and len(known.keys() | set(here)) > MOST_TERMS:
                yield _entries(list(known), total)
                known, total = {}, np.zeros((2, 0))
            if len(here) > MOST_TERMS:          # more terms than rows can share: row by row
                for r in range(len(ends) - 1):
                    mine = term.slice(ends[r], ends[r + 1] - ends[r]).dictionary_encode()
                    some = mine.dictionary.to_pylist()
                    one = np.zeros((2, len(some) ** 2))
                    _products(mine.indices.to_numpy(), value[ends[r]:ends[r + 1]], np.array([0, len(mine)]), ws[r:r + 1], len(some), one)
                    yield _entries(some, one)
                continue
            old = len(known)
            for name in here:
                known.setdefault(name, len(known))
            k = len(known)
            if k > old:
                wider = np.zeros((2, k, k))
                wider[:, :old, :old] = total.reshape(2, old, old)
                total = wider.reshape(2, -1)
            number = np.array([known[name] for name in here], dtype=np.int64)
            _products(number[coded.indices.to_numpy()], value, ends, ws, k, total)
        if known:
            yield _entries(list(known), total)
    return _summed(src.mapInArrow(run, "i string, j string, v double"))


def matrix(entries: DataFrame) -> tuple[list[str], np.ndarray]:
    """The terms, ascending, and the symmetric matrix of a long form."""
    rows = entries.limit(MOST_TERMS * (MOST_TERMS + 1) // 2 + 1).collect()
    names = sorted({r["i"] for r in rows} | {r["j"] for r in rows})
    if len(names) > MOST_TERMS:
        raise ValueError(f"{len(names)} terms: a model may have {MOST_TERMS}")
    at = {n: k for k, n in enumerate(names)}
    out = np.zeros((len(names), len(names)))
    for r in rows:
        out[at[r["i"]], at[r["j"]]] = out[at[r["j"]], at[r["i"]]] = r["sum"]
    return names, out


def split_outcome(names: list[str], m: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Terms, X'WX, X'Wy and y'Wy of a matrix that has the outcome as a term."""
    y = names.index(OUTCOME)
    rest = [k for k in range(len(names)) if k != y]
    return [names[k] for k in rest], m[np.ix_(rest, rest)], m[rest, y], float(m[y, y])


def inverse(m: np.ndarray) -> np.ndarray:
    """The (pseudo-)inverse, taken after scaling to a unit diagonal, as terms differ in size by orders of magnitude."""
    d = 1.0 / np.sqrt(np.where(np.diag(m) > 0, np.diag(m), 1.0))
    return np.linalg.pinv(m * d[:, None] * d[None, :], rcond=1e-12, hermitian=True) * d[:, None] * d[None, :]


def linear(x: Column, names: Sequence[str], beta: Sequence[float]) -> Column:
    """x . beta of a row; terms that the model lacks add nothing."""
    table = F.create_map(*[F.lit(v) for n, b in zip(names, beta) for v in (n, float(b))])
    return F.aggregate(x, F.lit(0.0), lambda acc, s: acc + F.coalesce(s["value"] * table[s["term"]], F.lit(0.0)))


def independent(names: Sequence[str], m: np.ndarray, first: Sequence[str] = (), tolerance: float = 1e-9) -> list[int]:
    """Terms that are not linear functions of those before them, ``first`` taken first, then by name."""
    d = 1.0 / np.sqrt(np.where(np.diag(m) > 0, np.diag(m), 1.0))
    left, kept = m * d[:, None] * d[None, :], []
    order = sorted(range(len(names)), key=lambda k: (first.index(names[k]) if names[k] in first else len(first), names[k]))
    for k in order:
        if left[k, k] > tolerance:
            kept.append(k)
            left = left - np.outer(left[:, k], left[k]) / left[k, k]
    return sorted(kept)


def cluster_robust_ols(rows: DataFrame, x: Column, y: Column, cluster: Column, small_sample: bool = True,
                       first: Sequence[str] = ("Intercept",)) -> dict:
    """OLS with cluster-robust covariance: names, beta, se, n, G, r_squared.

    Terms that depend on others are left out, those of ``first`` last, so that a treatment that covariates
    determine keeps its effect.

    One pass sums X'X, X'y and y'y.  A second sums the scores x e of each (cluster, term); their products within
    a cluster, summed over clusters, are the meat of the sandwich.  A cluster has at most one score for each term.
    Correction G/(G-1) * (n-1)/(n-k) as in the usual small-sample rule.
    """
    data = cut_lineage(rows.select(x.alias("x"), y.cast("double").alias("y"), cluster.alias("g")))
    names, whole = matrix(gram(data, with_outcome(F.col("x"), F.col("y"))))
    sum_y = float(whole[names.index("Intercept"), names.index(OUTCOME)])
    names, xtx, xty, yy = split_outcome(names, whole)
    kept = independent(names, xtx, list(first))
    names, xtx, xty = [names[k] for k in kept], xtx[np.ix_(kept, kept)], xty[kept]
    inv = inverse(xtx)
    beta, k, n = inv @ xty, len(names), int(round(xtx[names.index("Intercept"), names.index("Intercept")]))
    scored = data.select("g", F.explode("x").alias("s"), (F.col("y") - linear(F.col("x"), names, beta)).alias("e"))
    scores = scored.groupBy("g", F.col("s.term").alias("term")).agg(F.sum(F.col("s.value") * F.col("e")).alias("value"))
    by_cluster = scores.groupBy("g").agg(F.collect_list(F.struct("term", "value")).alias("x"))
    by_cluster = cut_lineage(by_cluster)
    some, partial = matrix(gram(by_cluster, F.col("x")))
    here = [i for i, s in enumerate(some) if s in names]
    at = [names.index(some[i]) for i in here]
    meat = np.zeros((k, k))
    meat[np.ix_(at, at)] = partial[np.ix_(here, here)]
    groups = by_cluster.count()
    cov = inv @ meat @ inv
    if small_sample and groups > 1 and n > k:
        cov *= (groups / (groups - 1)) * ((n - 1) / (n - k))
    ssr, sst = float(yy - 2 * beta @ xty + beta @ xtx @ beta), float(yy - sum_y ** 2 / n)
    return {"names": names, "beta": beta, "se": np.sqrt(np.maximum(np.diag(cov), 0.0)), "n": n, "G": groups,
            "r_squared": 1.0 - ssr / sst if sst > 0 else 0.0}


def correlation(names: list[str], m: np.ndarray) -> np.ndarray:
    """Correlations of all terms but the intercept, from X'X; NaN where a term is constant."""
    k = names.index("Intercept")
    rest = [i for i in range(len(names)) if i != k]
    mean = m[rest, k] / m[k, k]
    cov = m[np.ix_(rest, rest)] / m[k, k] - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    sd[sd < 1e-12 * np.maximum(1.0, np.abs(mean))] = np.nan
    return cov / np.outer(sd, sd)


def _blocks(rows: DataFrame, x: Column, y: Column, names: Sequence[str]) -> DataFrame:
    """The rows as blocks: terms by their place in ``names``, values, ends of the rows and outcomes, each as bytes."""
    src = rows.select(x.alias("x"), y.cast("double").alias("y"))
    place = {n: k for k, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, value, ends = _flat(b.column(0))
            coded = term.dictionary_encode()
            number = np.array([place[n] for n in coded.dictionary.to_pylist()], dtype="<i4")
            ys = b.column(1).cast(pa.float64()).to_numpy(zero_copy_only=False)
            said = [number[coded.indices.to_numpy()], value.astype("<f8"), ends.astype("<i8"), ys.astype("<f8"),
                    b.column(1).is_null().to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in said], ["at", "value", "ends", "y", "unknown"])
    return cut_lineage(src.mapInArrow(run, "at binary, value binary, ends binary, y binary, unknown binary"))


def _terms(rows: DataFrame, x: Column) -> list[str]:
    """All terms of a design, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            new = set(_flat(b.column(0))[0].unique().to_pylist()) - seen
            seen = seen | new if len(seen) <= MOST_TERMS else new
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.string())], ["term"])
    found = rows.select(x.alias("x")).mapInArrow(run, "term string").distinct().limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms: a model may have {MOST_TERMS}")
    return sorted(r["term"] for r in found)


def _information(blocks: DataFrame, names: Sequence[str], beta: np.ndarray) -> DataFrame:
    """X'WX in long form of a round of the probit, the working residual being one more term."""
    k = len(names) + 1
    sent = blocks.sparkSession.sparkContext.broadcast(([*names, OUTCOME], np.append(beta, 0.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, slope = sent.value
        total = np.zeros((2, k * k))
        for b in batches:
            for at, value, ends, y, unknown in zip(*(c.to_pylist() for c in b.columns)):
                at, value, ends = np.frombuffer(at, "<i4"), np.frombuffer(value, "<f8"), np.frombuffer(ends, "<i8")
                y, has = np.frombuffer(y, "<f8"), ~np.frombuffer(unknown, bool)
                row = np.repeat(np.arange(len(y)), np.diff(ends))
                eta = np.bincount(row, value * slope[at], len(y))
                mu = np.clip(special.norm_cdf(eta), 1e-10, 1 - 1e-10)
                pdf = np.maximum(np.exp(-eta * eta / 2) / np.sqrt(2 * np.pi), 1e-12)
                # the residual of a row comes after its terms; a row without an outcome has none
                stop = ends[1:][has]
                at = np.insert(at, stop, k - 1)
                value = np.insert(value, stop, ((y - mu) / pdf)[has])
                ends = ends + np.concatenate([[0], np.cumsum(has)])
                _products(at, value, ends, pdf * pdf / (mu * (1 - mu)), k, total)
        yield _entries(terms, total)
    return _summed(blocks.mapInArrow(run, "i string, j string, v double"))


def probit(rows: DataFrame, x: Column, y: Column, max_iter: int = 250, tolerance: float = 1e-10) -> dict:
    """Binomial model with a probit link by iteratively reweighted least squares: names, beta, se, iterations.

    Every round is one pass over the rows, which are written once as blocks of numbered terms: a task works out
    weights and working residuals of its blocks and adds up their X'WX.  Standard errors come from the expected information.
    """
    names = _terms(rows, x)
    blocks = _blocks(rows, x, y, names)
    beta = np.zeros(len(names))
    for step in range(1, max_iter + 1):
        entries = _information(blocks, names, beta)
        names, info, right, _ = split_outcome(*matrix(entries))
        inv = inverse(info)
        change = inv @ right
        beta = beta + change
        if np.max(np.abs(change) * np.sqrt(np.diag(info))) < tolerance * max(1.0, np.max(np.abs(beta) * np.sqrt(np.diag(info)))):
            break
    return {"names": names, "beta": beta, "se": np.sqrt(np.maximum(np.diag(inv), 0.0)), "iterations": step}
