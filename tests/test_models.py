"""Models in long form, the network, stored models, silhouettes, nested rows and calendars against plain versions."""

import datetime as dt
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import paths, special
from kestrel.operators import anomaly, encoding, experiment, forest, gram, model_bundle, neural, propensity, segments, silhouette


def test_normal_distribution_function(spark):
    x = np.concatenate([np.linspace(-39, 39, 79), np.linspace(-8, 8, 65)])
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in x], "x double").select(special.normal_cdf(F.col("x"))).collect()]
    np.testing.assert_allclose(got, special.norm_cdf(x), rtol=1e-7, atol=1e-15)


def _table(spark, n=400, seed=3):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, u, v = "xyz"[r.integers(3)], "pq"[r.integers(2)], float(r.normal()), float(r.normal(5, 3))
        p = 1 / (1 + np.exp(-(1.5 * (a == "x") - 0.8 * (b == "p") + u + 0.1 * (v - 5))))
        rows.append((i, a, b, u, v, float(r.random() < p)))
    return spark.createDataFrame(rows, "key long, a string, b string, u double, v double, y double"), rows


def _design(rows):
    return np.array([[1.0, r[1] == "y", r[1] == "z", r[2] == "q", r[3], r[4]] for r in rows], dtype=float), np.array([r[5] for r in rows])


NAMES = ["Intercept", "a[T.y]", "a[T.z]", "b[T.q]", "u", "v"]


def test_long_gram_and_probit(spark):
    df, rows = _table(spark)
    terms = encoding.treatment_terms(["u", "v"], ["a", "b"], encoding.reference_levels(df, ["a", "b"]))
    x, y = _design(rows)
    names, m = gram.matrix(gram.gram(df, terms, F.col("v") * F.col("v")))
    place = [names.index(n) for n in NAMES]
    np.testing.assert_allclose(m[np.ix_(place, place)], x.T @ (x * x[:, 5:6] ** 2), rtol=1e-10)
    fit = gram.probit(df, terms, F.col("y"))
    beta = np.zeros(6)
    for _ in range(30):
        eta = x @ beta
        mu, pdf = special.norm_cdf(eta), np.exp(-eta ** 2 / 2) / np.sqrt(2 * np.pi)
        w = pdf ** 2 / (mu * (1 - mu))
        info = x.T @ (x * w[:, None])
        beta = beta + np.linalg.solve(info, x.T @ (w * (y - mu) / pdf))
    place = [fit["names"].index(n) for n in NAMES]
    np.testing.assert_allclose(fit["beta"][place], beta, rtol=1e-8)
    np.testing.assert_allclose(fit["se"][place], np.sqrt(np.diag(np.linalg.inv(info))), rtol=1e-6)


def test_encoder_ignores_unseen_levels(spark):
    df, rows = _table(spark, 60)
    new = spark.createDataFrame([(1, "x", "never", 1.0, None, 0.0), (2, None, "q", 2.0, 5.0, 1.0)], df.schema)
    got = encoding.encoded(new, ["key"], encoding.level_dictionary(df, ["a", "b"]), encoding.scaling(df, ["u", "v"]), ["a", "b"], ["u", "v"])
    u, v = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    want = {(1, "a=x"): 1.0, (2, "b=q"): 1.0, (1, "u"): (1 - u.mean()) / u.std(), (2, "u"): (2 - u.mean()) / u.std(), (2, "v"): (5 - v.mean()) / v.std()}
    have = {(r.key, r.term): r.value for r in got.collect()}
    assert have.keys() == want.keys()
    for k in want:
        assert abs(have[k] - want[k]) < 1e-12


def test_gradient_of_the_network():
    r = np.random.default_rng(1)
    sizes = [5, 4, 3, 1]
    x, y, flat = r.normal(size=(20, 5)), r.integers(0, 2, 20).astype(float), neural.initial(sizes, 2)

    def loss(p):
        return neural.partial_gradient(p, sizes, x, y)[1] / 20 + 0.01 / 2 / 20 * sum((w ** 2).sum() for w, _ in neural.layers(p, sizes))
    got = neural.penalised(neural.partial_gradient(flat, sizes, x, y)[0], flat, sizes, 20, 0.01)
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-6 - got[k]) < 1e-6


def _plain_fit(rows, model, batches, epochs, patience, held_out, spark, seed=42):
    """The same training in one process."""
    df = spark.createDataFrame([(r[0],) for r in rows], "key long")
    unit = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    where = F.when(unit < held_out, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(batches)))
    batch = {r[0]: r[1] for r in df.select("key", where.cast("int")).collect()}
    x, y = np.zeros((len(rows), model.sizes[0])), np.array([r[5] for r in rows])
    for i, r in enumerate(rows):
        for c, v in (("a", r[1]), ("b", r[2])):
            x[i, model.columns[c][v]] = 1
        for c, v in (("u", r[3]), ("v", r[4])):
            at, mean, scale = model.scales[c]
            x[i, at] = (v - mean) / scale
    b = np.array([batch[r[0]] for r in rows])
    p, adam = neural.initial(model.sizes, seed), neural.Adam(len(neural.initial(model.sizes, seed)), neural.RATE)
    best, best_p, waited, seen = -1.0, p, 0, []
    for _ in range(epochs):
        for k in range(batches):
            some = b == k
            grad, _ = neural.partial_gradient(p, model.sizes, x[some], y[some])
            p = p + adam.step(neural.penalised(grad, p, model.sizes, some.sum(), neural.PENALTY))
        right = ((neural.forward(p, model.sizes, x[b < 0])[-1][:, 0] > 0) == (y[b < 0] > 0.5)).mean()
        seen.append(right)
        waited = 0 if right > best + neural.RISE else waited + 1
        if right > best:
            best, best_p = right, p
        if waited >= patience:
            break
    return best_p, seen


def test_network_equals_a_plain_run_on_any_partitioning(spark):
    df, rows = _table(spark)
    args = {"hidden": (8, 4), "rows": 100, "epochs": 12, "patience": 4}
    fits = [neural.fit(df.repartition(n), ["a", "b"], ["u", "v"], "key", "y", **args) for n in (1, 7)]
    want, seen = _plain_fit(rows, fits[0], 4, 12, 4, neural.HELD_OUT, spark)
    for model in fits:
        np.testing.assert_allclose(model.params, want, rtol=1e-8, atol=1e-11)
        np.testing.assert_allclose(model.accuracies, seen)
    assert fits[0].losses[-1] < fits[0].losses[0]
    longer = neural.fit(df, ["a", "b"], ["u", "v"], "key", "y", hidden=(32, 16), rows=100, epochs=25, patience=25, rate=0.01)
    assert longer.losses[-1] < 0.55 < longer.losses[0] and max(longer.accuracies) > 0.7
    scored = longer.transform(df).select("key", F.col("probability")).collect()
    assert all(abs(sum(r.probability) - 1) < 1e-12 for r in scored) and len({r.probability[1] for r in scored}) > 300


def test_partial_gradients_add_up_in_a_tree(spark):
    rows = [(i, (np.arange(3) * float(i)).astype("<f8").tobytes()) for i in range(100)]
    parts = spark.createDataFrame(rows, "slot int, vector binary").repartition(100)
    few = neural.tree_sum(parts, 100, fan=5).collect()
    assert len(few) <= 5
    np.testing.assert_allclose(np.sum([np.frombuffer(r.vector) for r in few], axis=0), np.arange(3) * 4950.0)


def _frame(spark, n=120):
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, int(r.integers(2)), "ab"[i % 2]) for i in range(n)], "session_id long, booked_flag int, level string")
    for c in propensity.CATEGORICAL:
        df = df.withColumn(c, F.col("level"))
    for k, c in enumerate(propensity.NUMERIC):
        df = df.withColumn(c, (F.col("session_id") * (k + 3) % 11 + 1).cast("double"))
    return df.drop("level")


def _requests(df):
    return df.select(F.col("session_id").alias("request_id"), *propensity.FEATURES)


@pytest.mark.parametrize("kind", ["network", "pipeline"])
def test_stored_model_scores_in_another_session(spark, tmp_path, kind):
    df, path = _frame(spark), str(tmp_path / "model")
    train = df.withColumn("label", F.col("booked_flag").cast("double"))
    if kind == "network":
        model = neural.fit(train, propensity.CATEGORICAL, propensity.NUMERIC, "session_id", "label", hidden=(4,), epochs=2)
    else:
        model = propensity.without_summary(Pipeline(stages=[*propensity.preprocessor(), LogisticRegression(maxIter=5)]).fit(train))
    dates = {"train_end": "a", "val_start": "b", "val_end": "c", "test_start": "d"}
    model_bundle.save(spark, path, model, "M", 0.4, dates, "synthetic")
    want = {r.request_id: r.booking_probability for r in propensity.batch_score(model, _requests(df), 0.4).collect()}
    other = spark.newSession()
    bundle = model_bundle.load(other, path)
    asked = _requests(df).collect()
    got = model_bundle.score(bundle, other.createDataFrame(asked, _requests(df).schema)).collect()
    assert {r.request_id: r.booking_probability for r in got} == want
    assert {r.threshold for r in got} == {0.4}
    row = model_bundle.registry_row(other, bundle).first()
    assert row.data_classification == "synthetic" and row.bundle_digest == bundle.digest and row.champion == "M"
    with pytest.raises(ValueError, match="contract"):
        model_bundle.score(bundle, _requests(df).drop("passengers"))
    with pytest.raises(ValueError, match="leakage"):
        model_bundle.score(bundle, _requests(df).withColumn("booking_count", F.lit(1)))
    out = model_bundle.score(bundle, _requests(df).withColumn("passengers", F.lit(99.0))).collect()
    assert all(not r.accepted and r.rejection_reason == "passengers out of range" for r in out)
    # a file that was changed is noticed
    with open(f"{bundle.path}/metadata.json", "a") as f:
        f.write(" ")
    for crc in (tmp_path / "model").glob("data-*/.metadata.json.crc"):
        crc.unlink()
    with pytest.raises(model_bundle.Damaged):
        model_bundle.load(other, path)


def test_models_score_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    train = _frame(spark).withColumn("label", F.col("booked_flag").cast("double"))
    for model in propensity.candidate_pipelines(120, rf_trees=3).values():
        fitted = propensity.without_summary(model.fit(train))
        assert propensity.with_probability(fitted, train).select("p").checkpoint().count() == 120


def test_permutation_importance_by_brute_force(spark):
    df = _frame(spark, 60).withColumn("label", F.col("booked_flag").cast("double"))
    model = propensity.without_summary(Pipeline(stages=[*propensity.preprocessor(), LogisticRegression(maxIter=20)]).fit(df))
    features = ["passengers", "device_type"]
    got = {r.feature: (r.importance_mean_pr_auc, r.importance_std) for r in
           propensity.permutation_importance(model, df, propensity.FEATURES, repeats=2).collect() if r.feature in features}
    rows = df.withColumns({"k": F.xxhash64("session_id", F.lit(42)), "r0": F.xxhash64("session_id", F.lit(0), F.lit(43)),
                           "r1": F.xxhash64("session_id", F.lit(1), F.lit(43))}).collect()

    def ap(frame):
        pairs = [(r.booked_flag, r.p) for r in propensity.with_probability(model, frame).select("booked_flag", "p").collect()]
        total = sum(y for y, _ in pairs)
        return sum(sum(y for y, p in pairs if p == t) * sum(y for y, p in pairs if p >= t) / sum(p >= t for _, p in pairs)
                   for t in {p for _, p in pairs}) / total
    base, order = ap(df), sorted(rows, key=lambda r: (r.k, r.session_id))
    for f in features:
        drops = []
        for rep in ("r0", "r1"):
            donors = sorted(rows, key=lambda r: (r[rep], r.session_id))
            value = {a.session_id: b[f] for a, b in zip(order, donors)}
            moved = [{**r.asDict(), f: value[r.session_id]} for r in rows]
            drops.append(base - ap(spark.createDataFrame([tuple(m[c] for c in df.columns) for m in moved], df.schema)))
        np.testing.assert_allclose(got[f], (np.mean(drops), np.std(drops)), atol=1e-9)


def test_models_pass_once_over_rows_and_in_few_tasks(spark):
    seen, tasks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    class Counted(neural.NetworkModel):
        def __init__(self):
            pass

        def transform(self, df):
            def run(batches):
                tasks.add(1)
                for b in batches:
                    seen.add(b.num_rows)
                    p = [[1.0 - v / 20.0, v / 20.0] for v in b.column(b.schema.get_field_index("passengers")).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, "probability"])
            return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("probability", T.ArrayType(T.DoubleType()))]))
    df = _frame(spark, 60).withColumns({"partner_id": F.col("session_id"), "session_ts": F.lit("2000-01-01")})
    df = df.checkpoint()
    scored = propensity.score_locked(Counted(), df, 0.2)
    assert scored.agg(F.sum("probability_bin")).count() == 1 and scored.count() == 60
    assert seen.value == 60
    few, before = spark.sparkContext.defaultParallelism, tasks.value
    propensity.permutation_importance(Counted(), df, propensity.FEATURES, repeats=6).collect()
    # unshuffled rows, and copies that got another value, sampled and sorted from one aggregate
    assert tasks.value - before <= df.rdd.getNumPartitions() + few


def test_silhouettes_by_brute_force(spark):
    r = np.random.default_rng(7)
    x = np.concatenate([r.normal(0, 1, (40, 3)), r.normal(4, 1, (30, 3)), [[50.0, 0, 0]], np.zeros((5, 3))])
    first = [0] * 40 + [1] * 30 + [1] + [0] * 5
    second = [0] * 40 + [1] * 30 + [2] + [0] * 5
    points = spark.createDataFrame([(i, v.tolist(), [a, b]) for i, (v, a, b) in enumerate(zip(x, first, second))],
                                   "id long, vector array<double>, labels array<int>")
    got = silhouette.mean_silhouettes(points, [2, 3], block=20)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for labels, have in ((np.array(first), got[0]), (np.array(second), got[1])):
        s = []
        for i, k in enumerate(labels):
            own = labels == k
            if own.sum() == 1:
                s.append(0.0)
                continue
            a, b = d[i][own].sum() / (own.sum() - 1), min(d[i][labels == m].mean() for m in set(labels) if m != k)
            s.append((b - a) / max(a, b))
        assert abs(have - np.mean(s)) < 1e-9


def test_points_of_silhouettes_are_not_copied_for_each_block(spark, monkeypatch):
    """Points stay where they are, equal ones too; blocks and slabs give the same sums."""
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(0, 1, (150, 2)), np.ones((30, 2))])
    labels = np.stack([np.arange(180) % 2, np.arange(180) % 3], 1)
    points = spark.createDataFrame([(i // 2, v, k) for i, (v, k) in enumerate(zip(x.tolist(), labels.tolist()))],
                                   "id long, vector array<double>, labels array<int>")
    assert "explode" not in silhouette.cluster_sums(points, [2, 3])._jdf.queryExecution().toString()
    monkeypatch.setattr(silhouette, "FEW_ROWS", 10)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = sorted((*k, *(d[i][labels[:, c] == m].sum() for c, n in enumerate((2, 3)) for m in range(n))) for i, k in enumerate(labels.tolist()))
    for slab in (1000, 70):
        sums = silhouette.cluster_sums(points, [2, 3], slab).collect()
        got = sorted((*row["labels"], *(row[f"s{k}"] for k in range(5))) for row in sums)
        np.testing.assert_allclose(got, want, atol=1e-6)


def _entities(spark, n=400, seed=5):
    r = np.random.default_rng(seed)
    rows = [(i, *(float(v) for v in r.normal(3.0 * (i % 3), 1.0, len(segments.CLUSTER_FEATURES)))) for i in range(n)]
    return spark.createDataFrame(rows, "partner_id long, " + ", ".join(f"{c} double" for c in segments.CLUSTER_FEATURES))


def test_rounds_side_by_side_equal_spark_kmeans(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    x = VectorAssembler(inputCols=segments.CLUSTER_FEATURES, outputCol="features").transform(_entities(spark)).cache()
    jobs = [(2, 7), (3, 7), (3, 8), (5, 9)]
    fit = lambda k, s, m: KMeans(k=k, seed=s, maxIter=m).fit(x)
    whole = [fit(k, s, 300) for k, s in jobs]
    got = segments.lloyd(x.select(vector_to_array("features")).repartition(3), [np.array(fit(k, s, 0).clusterCenters()) for k, s in jobs])
    for m, (centers, cost) in zip(whole, got):
        np.testing.assert_allclose(centers, np.array(m.clusterCenters()), rtol=1e-9)
        assert abs(cost - m.summary.trainingCost) < 1e-6 * cost
    marked = x.withColumn("v", vector_to_array("features")).withColumn("near", segments.nearest_center("v", got[3][0]))
    assert whole[3].transform(marked).where("near <> prediction").count() == 0
    x.unpersist()


def test_restarts_share_the_jobs_of_a_round(spark):
    seen = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = seen()
    clustered, k, scores = segments.fit_clusters(_entities(spark, 120), k_max=4, restarts=10)
    assert k == 3 and len(scores) == 3 and clustered.count() == 120
    assert seen() - before < 30 * 14         # some 11 draw the first centers of a restart


def test_center_without_points_stays(spark):
    points = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],)], "v array<double>")
    (centers, cost), = segments.lloyd(points, [np.array([[1.0, 1.0], [90.0, 90.0]])])
    assert centers.tolist() == [[1.0, 0.0], [90.0, 90.0]] and cost == 2.0


def test_many_clusters_keep_names(spark):
    rows = [(i, 1.0 if i else 9.0, 0.0 if i else 1.0, 0.0 if not i else 0.5) for i in range(8)]
    prof = spark.createDataFrame([(i, v, n, c) for i, v, n, c in rows],
                                 "cluster_id long, median_successful_booking_value double, mean_no_result_rate double, mean_conversion double")
    labels = [r.cluster_label for r in segments.label_clusters(prof).orderBy("cluster_id").collect()]
    assert labels[0] == segments.VALUE_LABEL and labels[1:5] == segments.REMAINING_LABELS
    assert labels[5:] == [f"{segments.REMAINING_LABELS[-1]} {k}" for k in (2, 3, 4)]


def test_digest_arms_are_stable_and_even(spark):
    units = spark.range(40000).select(F.col("id").alias("u"), F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz").alias("t"))

    def arms(salt, share=0.5):
        got = experiment.assign_arms(units, "u", "t", "2024-01-01", "2025-01-01", salt, variant_share=share)
        return {r.u: r.experiment_variant for r in got.collect()}
    one, two = arms("first"), arms("second")
    assert one == arms("first")
    for u in (0, 17, 39999):
        bucket = int(hashlib.sha256(f"first:{u}".encode()).hexdigest()[:8], 16) % experiment.BUCKETS
        assert one[u] == ("control" if bucket >= 5000 else "variant")
    share = [np.mean([a == "variant" for a in x.values()]) for x in (one, two, arms("third", 0.2))]
    np.testing.assert_allclose(share, [0.5, 0.5, 0.2], atol=0.01)
    assert abs(np.mean([one[u] == two[u] for u in one]) - 0.5) < 0.01       # arms of two experiments are independent
    out = experiment.assign_arms(units.limit(3).withColumn("u", F.lit(None).cast("long")), "u", "t", "2024-01-01", "2025-01-01", "x")
    assert {r.experiment_variant for r in out.collect()} == {"not_eligible"}


def test_paths_of_nested_rows_survive_json(spark):
    df = spark.sql("""SELECT 1 AS k, named_struct('a', named_struct('x', 1.5D, 'y', CAST(NULL AS STRING)), 'b', array(named_struct('z', 1L, 'f', true),
      named_struct('z', 2L, 'f', false)), 'c', CAST(array() AS array<string>), 'd', DATE'2024-02-03', 'e', array(array('p', 'q'))) AS n""")
    got = {r.path: (r.text, r.number) for r in paths.path_values(df, ["k"], "n").collect()}
    assert got == {"$.a.x": (None, 1.5), "$.a.y": (None, None), "$.b[0].z": (None, 1.0), "$.b[0].f": ("true", None), "$.b[1].z": (None, 2.0),
                   "$.b[1].f": ("false", None), "$.d": ("2024-02-03", None), "$.e[0][0]": ("p", None), "$.e[0][1]": ("q", None)}
    again = paths.path_values(paths.parsed(df.withColumn("text", F.to_json("n")), "n", "text"), ["k"], "n")
    assert {r.path: (r.text, r.number) for r in again.collect()} == got


def test_calendar_windows_and_late_days(spark):
    r = np.random.default_rng(11)
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), m, float(r.normal(10, 2)), "high") for m in ("p", "q") for i in range(200) if i % 7 != 3 and not 60 < i < 75]
    schema = "metric_date date, metric string, value double, adverse_direction string"
    long = anomaly.calendar_spine(spark.createDataFrame(rows, schema))
    assert long.groupBy("metric").count().first()["count"] == (max(x[0] for x in rows) - start).days + 1
    before = anomaly.rolling_scores(long)
    plain = {(m, d): v for d, m, v, _ in rows}
    for s in before.where("metric = 'p'").collect():
        past = [plain[m, d] for m, d in plain if m == "p" and 1 <= (s.metric_date - d).days <= 28]
        want = float(np.median(past)) if len(past) >= 14 else None
        assert (s.baseline_median is None) == (want is None) and (want is None or abs(s.baseline_median - want) < 1e-12)
    late_rows = [(start + dt.timedelta(days=i), "p", 99.0, "high") for i in (3, 66, 67, 150)]
    changed = [x for x in rows if not (x[1] == "p" and x[0] in {y[0] for y in late_rows})] + late_rows
    now = anomaly.calendar_spine(spark.createDataFrame(changed, schema))
    late = spark.createDataFrame([(y[1], y[0]) for y in late_rows], "metric string, metric_date date")

    def told(df):
        return {(x.metric, x.metric_date): tuple(None if v is None else round(v, 9) for v in (x.value, x.baseline_median, x.rolling_mad, x.scale, x.robust_z))
                for x in df.collect()}
    assert told(anomaly.rescored(before, now, late)) == told(anomaly.rolling_scores(now))


def test_long_sums_are_added_up_inside_tasks(spark, monkeypatch):
    """No row for each pair of terms of each row; more terms than a task may keep, and terms without a value."""
    df, rows = _table(spark)
    terms = encoding.treatment_terms(["u", "v"], ["a", "b"], encoding.reference_levels(df, ["a", "b"]))
    assert "Generate" not in gram.gram(df, terms)._jdf.queryExecution().executedPlan().toString()
    long = spark.createDataFrame([(i % 3, [(f"t{i}", 2.0), ("n", None), ("all", 1.0)]) for i in range(50)],
                                 "w int, x array<struct<term string, value double>>").coalesce(1)
    monkeypatch.setattr(gram, "MOST_TERMS", 7)
    monkeypatch.setattr(gram, "PAIRS", 5)
    got = {(r.i, r.j): r["sum"] for r in gram.gram(long, F.col("x"), F.col("w")).collect()}
    want = {("all", "all"): float(sum(i % 3 for i in range(50)))}
    for i in range(50):
        want |= {("all", f"t{i}"): 2.0 * (i % 3), (f"t{i}", f"t{i}"): 4.0 * (i % 3)}
    assert got == want


def test_forest_is_fitted_in_groups_of_trees(spark, monkeypatch, tmp_path):
    """Groups of trees over the same rows make one forest, which votes, is stored and read as one."""
    train = _frame(spark, 400).repartition(5).withColumn("label", F.col("booked_flag").cast("double"))
    monkeypatch.setattr(propensity, "FEW_ROWS", 50)
    model = propensity.fit_forest(train, propensity.candidate_pipelines(400, rf_trees=11)["RandomForest"], 400)
    forest = model.stages[-1]
    assert forest.getNumTrees == len(forest.trees) == 11 and forest.getOrDefault("numTrees") == 11
    assert forest.getOrDefault("maxDepth") == 14 and forest.getOrDefault("seed") == 42
    assert len({t.toDebugString.partition("\n")[2] for t in forest.trees}) > 1
    assert abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9
    x = model.transform(train).select("features", "probability").limit(40).collect()
    for r in x:
        votes = np.array([t.predictRaw(r.features).toArray() for t in forest.trees])
        np.testing.assert_allclose(r.probability.toArray(), (votes / votes.sum(1, keepdims=True)).mean(0), rtol=1e-9)
    model.write().save(str(tmp_path / "forest"))
    again = type(model).load(str(tmp_path / "forest"))
    key = ["session_id", "probability"]
    assert sorted(again.transform(train).select(*key).collect()) == sorted(model.transform(train).select(*key).collect())


def test_a_tree_takes_the_best_split_of_each_node():
    r = np.random.default_rng(3)
    columns = [forest.Column(0, 3), forest.Column(3, 0, np.arange(4) + 0.5), forest.Column(4, 0, np.array([]))]
    codes = np.stack([r.integers(0, 4, 500), r.integers(0, 5, 500), np.zeros(500)]).astype(np.uint8)
    y = ((codes[0] == 1) ^ (codes[1] > 2) ^ (r.random(500) < 0.2)).astype(np.uint8)
    t = forest.grow(codes, y, columns, [1, 2], 4, 5, 5)
    w = np.random.default_rng([1, 2]).poisson(1.0, 500).astype(float)
    gini = lambda v: 1 - ((v / v.sum()) ** 2).sum()
    count = lambda some: np.bincount(y[some], weights=w[some], minlength=2)
    reach, inner = {0: np.ones(500, dtype=bool)}, 0
    for k in range(len(t.left)):
        rows = reach[k]
        whole = count(rows)
        assert whole.tolist() == t.counts[k].tolist()
        gains = []
        for up in [*(codes[0] == v for v in range(3)), *(codes[1] > v for v in range(4))]:
            a, b = count(rows & ~up), count(rows & up)
            if a.sum() >= 5 and b.sum() >= 5:
                gains.append(gini(whole) - (a.sum() * gini(a) + b.sum() * gini(b)) / whole.sum())
        if t.left[k] < 0:
            continue
        inner += 1
        assert abs(t.gain[k] - max(gains)) < 1e-9
        up = codes[0] == t.code[k] if t.column[k] == 0 else codes[1] > t.code[k]
        reach[t.left[k]], reach[t.left[k] + 1] = rows & ~up, rows & up
    assert inner >= 3 and len(reach) == len(t.left)
    short = forest.pruned(t)
    assert len(short.left) < len(t.left)

    def answer(tree, k, row):
        while tree.left[k] >= 0:
            k = tree.left[k] + int(codes[0, row] == tree.code[k] if tree.column[k] == 0 else codes[1, row] > tree.code[k])
        return tree.counts[k].argmax()
    assert all(answer(t, 0, row) == answer(short, 0, row) for row in range(100))
    pairs = [k for k in range(len(short.left)) if short.left[k] >= 0 and (short.left[short.left[k]:short.left[k] + 2] < 0).all()]
    assert pairs and all(short.counts[short.left[k]].argmax() != short.counts[short.left[k] + 1].argmax() for k in pairs)


def test_forest_of_many_rows_is_grown_in_tasks(spark, monkeypatch, tmp_path):
    """Without a pass of Spark's over the rows for each level; the forest is one that Spark scores, explains and stores."""
    train = _frame(spark, 400).repartition(5).withColumn("label", F.col("booked_flag").cast("double"))
    pipe = propensity.candidate_pipelines(400, rf_trees=41)["RandomForest"]
    plain = propensity.fit_forest(train, pipe, 400)
    monkeypatch.setattr(forest, "LEAST_ROWS", 300)
    fitted = []
    plainly = type(pipe.getStages()[-1])._fit
    monkeypatch.setattr(type(pipe.getStages()[-1]), "_fit", lambda self, df: fitted.append(self.getNumTrees()) or plainly(self, df))
    model = propensity.fit_forest(train, pipe, 400)
    assert fitted == [1]
    trees = model.stages[-1]
    assert trees.getNumTrees == len(trees.trees) == 41 and trees.getOrDefault("numTrees") == 41
    assert trees.getOrDefault("maxDepth") == 14 and trees.getOrDefault("seed") == 42 and trees.getOrDefault("minInstancesPerNode") == 5
    assert trees.numFeatures == plain.stages[-1].numFeatures and max(t.depth for t in trees.trees) <= 14
    assert len({t.toDebugString.partition("\n")[2] for t in trees.trees}) == 41
    assert abs(sum(trees.featureImportances.toArray()) - 1) < 1e-9
    score = lambda m: np.array([r.probability[1] for r in m.transform(train).orderBy("session_id").collect()])
    y = np.array([r.label for r in train.orderBy("session_id").collect()])
    one, two = score(model), score(plain)
    assert np.corrcoef(one, two)[0, 1] > 0.85 and abs(((one - y) ** 2).mean() - ((two - y) ** 2).mean()) < 0.02
    model.write().save(str(tmp_path / "forest"))
    assert score(type(model).load(str(tmp_path / "forest"))).tolist() == one.tolist()


def test_rows_for_training_are_dealt_to_all_cores(spark):
    from kestrel.session import FEW_ROWS, MANY_ROWS, spread
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(FEW_ROWS).coalesce(1), spark.range(FEW_ROWS * 3).coalesce(1)
    assert spread(few, FEW_ROWS, "id").rdd.getNumPartitions() == 1
    assert spread(many, FEW_ROWS * 3, "id").rdd.getNumPartitions() == min(cores, 3)
    assert spread(few, MANY_ROWS * cores * 2, "id").rdd.getNumPartitions() == cores * 2
    assert spread(many, FEW_ROWS * 3, "id").count() == FEW_ROWS * 3


def test_a_fitted_candidate_is_scored_while_others_train(spark, monkeypatch):
    """The network trains longest: it ends here only when the others have been scored."""
    import threading
    from types import SimpleNamespace
    rows = spark.createDataFrame([(i, i % 2) for i in range(8)], "session_id long, booked_flag long")
    scored, both = [], threading.Event()

    def metric_row(df, name, split):
        scored.append(name)
        if {"LogisticRegression", "RandomForest"} <= set(scored):
            both.set()
        return spark.createDataFrame([(name, df.count())], "model string, rows long")

    monkeypatch.setattr(propensity, "candidate_pipelines", lambda *a: {
        "LogisticRegression": SimpleNamespace(fit=lambda df: "lr"), "RandomForest": None})
    monkeypatch.setattr(propensity, "without_summary", lambda model: model)
    monkeypatch.setattr(propensity, "fit_forest", lambda *a: "forest")
    monkeypatch.setattr(propensity.neural, "fit", lambda *a, **k: ("network", both.wait(60)))
    monkeypatch.setattr(propensity, "with_probability", lambda model, df, name="p": df.withColumn(name, F.lit(0.5)))
    monkeypatch.setattr(propensity, "metric_row", metric_row)
    fitted, comparison = propensity.fit_candidates(rows, rows)
    assert fitted == {"LogisticRegression": "lr", "RandomForest": "forest", "MLP": ("network", True)}
    assert [tuple(r) for r in comparison.collect()] == [(n, 8) for n in (*propensity.CANDIDATES, "Dummy")]
