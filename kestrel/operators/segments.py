"""Entity segmentation with K-Means (ML-19..ML-21).

Spark's K-Means draws the first centers of every restart; the rounds of all restarts of all
numbers of clusters then run side by side, one job for a round of all (`lloyd`).  The
number of clusters is chosen by the mean Euclidean silhouette, from sums of distances by
cluster (`silhouette`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.ranking import quantiles
from kestrel.operators import silhouette
from kestrel.operators.neural import tree_sum
from kestrel.session import cut_lineage, spread

CLUSTER_FEATURES = ["log_sessions", "log_searches", "session_booking_conversion", "no_result_rate",
                    "avg_search_latency_ms", "log_successful_booking_value", "log_platform_revenue"]
# fixed values: cluster names in precedence order
VALUE_LABEL, FRICTION_LABEL, CONVERSION_LABEL = "High-Value Scale", "Availability Friction", "Conversion Opportunity"
REMAINING_LABELS = ["Core Growth", "Emerging Partners", "Established Core", "Long-Tail Opportunity"]


def cluster_features(performance: DataFrame) -> DataFrame:
    """ML-19: active entities with log1p / ratio features (NULL ratios -> 0)."""
    active = performance.filter(F.col("sessions") > 0)
    return active.withColumns({
        "log_sessions": F.log1p("sessions"), "log_searches": F.log1p("searches"),
        "session_booking_conversion": F.coalesce("session_booking_conversion", F.lit(0.0)),
        "no_result_rate": F.coalesce("no_result_rate", F.lit(0.0)),
        "avg_search_latency_ms": F.coalesce("avg_search_latency_ms", F.lit(0.0)),
        "log_successful_booking_value": F.log1p("successful_booking_value"),
        "log_platform_revenue": F.log1p("platform_revenue"),
    })


#: Points whose distances to all centers a task holds at once.
CHUNK = 2048


def _round(points: DataFrame, tasks: int, centers: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each run the sums and counts of the points by their nearest center, and the sum of squared distances to it."""
    sizes = [len(c) for c in centers]
    ends = np.cumsum([0, *sizes])
    width = centers[0].shape[1]
    # runs of as many centers are taken together
    groups = [(k, np.flatnonzero(np.array(sizes) == k)) for k in sorted(set(sizes))]
    sent = points.sparkSession.sparkContext.broadcast(np.concatenate(centers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        c = sent.value
        squares = (c * c).sum(1)
        sums, counts, costs = np.zeros(c.shape), np.zeros(len(c)), np.zeros(len(sizes))
        for b in batches:
            rows = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            for lo in range(0, len(rows), CHUNK):
                x = rows[lo:lo + CHUNK]
                d = squares[None, :] - 2 * x @ c.T
                own, at = (x * x).sum(1), np.arange(len(x))
                member = np.zeros((len(x), len(c)))
                for k, runs in groups:
                    columns = ends[runs][:, None] + np.arange(k)[None, :]
                    some = d[:, columns]                    # point, run, center
                    nearest = some.argmin(2)
                    least = np.take_along_axis(some, nearest[:, :, None], 2)[:, :, 0]
                    costs[runs] += np.maximum(least + own[:, None], 0.0).sum(0)
                    member[at[:, None], ends[runs][None, :] + nearest] = 1.0
                sums += member.T @ x
                counts += member.sum(0)
        total = np.concatenate([sums.reshape(-1), counts, costs])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["slot", "vector"])
    parts = points.mapInArrow(run, "slot int, vector binary")
    found = sorted(tree_sum(parts, tasks).collect(), key=lambda r: r["slot"])
    total = np.sum([np.frombuffer(r["vector"], dtype="<f8") for r in found], axis=0)
    sent.unpersist()
    n = int(ends[-1])
    sums, counts, costs = total[:n * width].reshape(n, width), total[n * width:n * width + n], total[n * width + n:]
    return [(sums[a:b], counts[a:b], float(costs[i])) for i, (a, b) in enumerate(zip(ends, ends[1:]))]


def lloyd(points: DataFrame, starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """Centers and cost of each run of Lloyd's algorithm, from its first centers; all runs share the pass of a round.

    ``points`` has one column, an array of coordinates.  As in Spark's K-Means, a run ends when no center moves by more than
    ``tol``, a center without points stays, and the cost is that of the last assignment.
    """
    points = cut_lineage(points)
    tasks = points.rdd.getNumPartitions()
    out, left = [(np.asarray(c, dtype=float), 0.0) for c in starts], list(range(len(starts)))
    for _ in range(max_iter):
        again = []
        for i, (sums, counts, cost) in zip(left, _round(points, tasks, [out[i][0] for i in left])):
            old = out[i][0]
            new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1.0)[:, None], old)
            out[i] = (new, cost)
            if (((new - old) ** 2).sum(1) > tol * tol).any():
                again.append(i)
        left = again
        if not left:
            break
    return out


def nearest_center(vector: str, centers: np.ndarray) -> Column:
    """The number of the center that is nearest to an array of coordinates; the first one of equally near ones."""
    squares = []
    for c in centers:
        d = None
        for i, v in enumerate(c):
            gap = F.col(vector)[i] - F.lit(float(v))
            d = gap * gap if d is None else d + gap * gap
        squares.append(d)
    return (F.array_position(F.array(*squares), F.array_min(F.array(*squares))) - 1).cast("int")


def fit_clusters(features: DataFrame, k_max: int = 6, restarts: int = 25, seed: int = 42, parallel_fits: int = 8):
    """ML-20: k = 2..min(k_max, n-1); per k the lowest-cost of ``restarts`` seeds; best silhouette, then smaller k."""
    n = features.count()
    if n < 8:
        raise RuntimeError(f"{n} active entities are too few to be clustered")
    prep = Pipeline(stages=[VectorAssembler(inputCols=CLUSTER_FEATURES, outputCol="__raw"),
                            StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True)])
    pm = prep.fit(features)
    x = pm.transform(features).cache()
    x.count()
    ks = list(range(2, min(k_max, n - 1) + 1))

    def start(job):
        k, r = job
        return np.array(KMeans(k=k, seed=seed + r, featuresCol="features", maxIter=0).fit(x).clusterCenters())

    # the first centers of the restarts are independent Spark jobs: submit them concurrently
    jobs = [(k, r) for k in ks for r in range(restarts)]
    with ThreadPoolExecutor(max_workers=parallel_fits) as pool:
        starts = list(pool.map(start, jobs))
    points = x.withColumn("__vector", vector_to_array("features")).drop("features", "__raw")
    fits = list(zip(jobs, lloyd(spread(points.select("__vector"), n), starts)))
    centers = {k: min((f for f in fits if f[0][0] == k), key=lambda f: (f[1][1], f[0][1]))[1][0] for k in ks}
    labels = F.array(*[nearest_center("__vector", centers[k]) for k in ks])
    scores = list(zip(ks, silhouette.mean_silhouettes(
        points.select(F.xxhash64("partner_id").alias("id"), F.col("__vector").alias("vector"), labels.alias("labels")), ks)))
    best_k = sorted(scores, key=lambda t: (-t[1], t[0]))[0][0]
    labelled = points.withColumn("cluster_id", nearest_center("__vector", centers[best_k]).cast("bigint"))
    x.unpersist()
    return labelled.drop("__vector"), best_k, scores


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """ML-21: per cluster medians and means, then precedence labels (Q22)."""
    prof = clustered.groupBy("cluster_id").agg(
        F.count_distinct("partner_id").alias("partners"), F.avg("session_booking_conversion").alias("mean_conversion"),
        F.avg("no_result_rate").alias("mean_no_result_rate"), F.avg("avg_search_latency_ms").alias("mean_latency_ms"))
    medians = quantiles(clustered, [(f"median_{c}", c, 0.5) for c in (
        "sessions", "searches", "successful_booking_value", "platform_revenue")], by="cluster_id")
    return label_clusters(prof.join(medians, "cluster_id").select(
        "cluster_id", "partners", "median_sessions", "median_searches", "mean_conversion", "mean_no_result_rate",
        "mean_latency_ms", "median_successful_booking_value", "median_platform_revenue"))


def label_clusters(prof: DataFrame) -> DataFrame:
    """Value first; friction only if its cluster is free; conversion likewise; then names by id, numbered after the last name."""
    picks = prof.agg(
        F.max_by("cluster_id", F.struct(F.col("median_successful_booking_value"), -F.col("cluster_id"))).alias("v"),
        F.max_by("cluster_id", F.struct(F.col("mean_no_result_rate"), -F.col("cluster_id"))).alias("f"),
        F.min_by("cluster_id", F.struct(F.col("mean_conversion"), F.col("cluster_id"))).alias("c"))
    p = prof.crossJoin(F.broadcast(picks))
    named = (F.when(F.col("cluster_id") == F.col("v"), F.lit(VALUE_LABEL))
             .when(F.col("cluster_id") == F.col("f"), F.lit(FRICTION_LABEL))
             .when(F.col("cluster_id") == F.col("c"), F.lit(CONVERSION_LABEL)))
    p = p.withColumn("__named", named)
    # remaining clusters take the fallback names in cluster-id order (few clusters: global window is bounded)
    from pyspark.sql import Window
    idx = F.row_number().over(Window.partitionBy(F.col("__named").isNull()).orderBy("cluster_id")) - 1
    names = F.array(*[F.lit(x) for x in REMAINING_LABELS])
    fallback = F.coalesce(F.get(names, idx.cast("int")), F.concat(F.lit(f"{REMAINING_LABELS[-1]} "), (idx - len(REMAINING_LABELS) + 2).cast("string")))
    p = p.withColumn("cluster_label", F.coalesce(F.col("__named"), fallback))
    return p.drop("v", "f", "c", "__named")


def label_entities(clustered: DataFrame, profile: DataFrame) -> DataFrame:
    return clustered.join(F.broadcast(profile.select("cluster_id", "cluster_label")), "cluster_id", "left")
