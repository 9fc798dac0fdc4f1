"""Leakage-aware propensity models (ML-01..ML-09, ML-13, ML-14, ML-17, ML-18, ML-22, ML-23).

Logistic regression and the forest are Spark ML pipelines, the network is `neural`, the
probit a reweighted least squares on long-form sums (`gram`); fitting and scoring are
distributed jobs and only metric rows and the k-dimensional model reach the driver.
Documented differences from single-machine libraries: trees bin features, and the
network's mini-batches are fixed by a row hash; these two are compared by invariants,
not equality.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import special
from kestrel.functions.core import rank_unique
from kestrel.functions.ranking import global_cumsum, global_row_number
from kestrel.operators import encoding, gram, ml_metrics, neural
from kestrel.operators import forest as forests
from kestrel.operators.facts import first_per_group
from kestrel.session import FEW_ROWS, MANY_ROWS, cut_lineage

# fixed values: the feature contract (names) and the columns that would leak the outcome
CATEGORICAL = ["device_type", "acquisition_channel", "traveller_type", "partner_type", "partner_country",
               "integration_type", "contract_tier", "journey_type", "origin_country", "destination_country",
               "search_dow"]
NUMERIC = ["is_logged_in", "passengers", "days_before_travel", "result_count", "no_result_flag",
           "search_latency_ms", "international_flag", "search_hour"]
FEATURES = CATEGORICAL + NUMERIC
LEAKAGE_EXCLUSIONS = ["selected_flag", "booking_count", "booking_value", "successful_booking_value",
                      "platform_revenue", "cancellations", "refunds", "experiment_variant", "alternatives_shown"]
# fixed values: categorical terms of the probit benchmark's reduced formula
REDUCED = ["device_type", "acquisition_channel", "traveller_type", "partner_type", "integration_type", "contract_tier",
           "journey_type"]
CANDIDATES = ["LogisticRegression", "RandomForest", "MLP"]
# fixed values: feature contract ranges of the scoring interface
RANGES = {"passengers": (1, 20), "days_before_travel": (0, 730), "result_count": (0, 500),
          "search_latency_ms": (0, 120000), "search_hour": (0, 23)}


def model_frame(session_fact: DataFrame, partners: DataFrame, search_fact: DataFrame,
                stations: DataFrame) -> DataFrame:
    """ML-01/ML-02: unit x entity x first item, endpoint countries, derived features.

    The first item per unit is a top-1 window (WindowGroupLimit); the unit
    fact and the first items are both keyed by session_id.
    """
    fs = first_per_group(search_fact.select(
        "session_id", "partner_id", "search_id", "search_ts", "journey_type", "passengers", "days_before_travel",
        "result_count", "no_result_flag", "search_latency_ms", "origin_station_id", "destination_station_id"),
        "session_id", ["search_ts", "search_id"]).drop("search_id")
    s = session_fact.select("session_id", "partner_id", "session_ts", "booked_flag", "successful_booking_value",
                            "device_type", "acquisition_channel", "is_logged_in", "traveller_type")
    p = partners.select("partner_id", "partner_type", F.col("country").alias("partner_country"), "integration_type",
                        "contract_tier")
    os_ = stations.select(F.col("station_id").alias("origin_station_id"), F.col("country").alias("origin_country"))
    ds = stations.select(F.col("station_id").alias("destination_station_id"),
                         F.col("country").alias("destination_country"))
    f = s.join(p, "partner_id", "inner").join(fs, ["session_id", "partner_id"], "inner")
    f = f.join(os_, "origin_station_id", "left").join(ds, "destination_station_id", "left")
    return f.withColumns({
        "search_hour": F.hour("search_ts").cast("bigint"),
        "search_dow": F.date_format("search_ts", "EEEE"),
        "international_flag": (F.col("origin_country") != F.col("destination_country")).cast("bigint"),
        "is_logged_in": F.col("is_logged_in").cast("bigint"),
        "booked_flag": F.col("booked_flag").cast("bigint"),
    })


def temporal_split(frame: DataFrame, train_end: str, val_start: str, val_end: str, test_start: str,
                   ts: str = "session_ts") -> dict[str, DataFrame]:
    """ML-03: three time-ordered splits."""
    t = F.col(ts)
    lit = lambda v: F.lit(v).cast("timestamp_ntz")
    return {"train": frame.filter(t <= lit(train_end)),
            "validation": frame.filter((t >= lit(val_start)) & (t <= lit(val_end))),
            "test": frame.filter(t >= lit(test_start))}


def split_summary(splits: dict[str, DataFrame], label: str = "booked_flag") -> DataFrame:
    """ML-03 guard input: rows and classes per split (one small aggregate each)."""
    out = None
    for name, df in splits.items():
        part = df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                      F.sum(F.col(label)).alias("positives"), F.count_distinct(label).alias("classes"))
        out = part if out is None else out.unionByName(part)
    return out


def assert_splits(summary: DataFrame, min_rows: int = 100) -> None:
    """Raise when a split is too small or single-class (collects one row per split)."""
    for r in summary.collect():
        if r["rows"] < min_rows:
            raise RuntimeError(f"{r['split']} split is too small: {r['rows']} rows.")
        if r["classes"] < 2:
            raise RuntimeError(f"{r['split']} split contains only one target class.")


def preprocessor(categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC,
                 order: str = "alphabetAsc") -> list:
    """ML-04 as pipeline stages: one-hot (unknown levels -> all zeros) + standardised numerics.

    Spark's scaler divides by the sample deviation, that of `encoding` and `neural` by the population's.
    """
    idx = [f"{c}__idx" for c in categorical]
    oh = [f"{c}__oh" for c in categorical]
    return [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep", stringOrderType=order),
            OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="error"),
            VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="error"),
            StandardScaler(inputCol="__num", outputCol="__num_scaled", withMean=True, withStd=True),
            VectorAssembler(inputCols=oh + ["__num_scaled"], outputCol="features")]


def candidate_pipelines(n_train: int, seed: int = 42, rf_trees: int = 350) -> dict[str, Pipeline]:
    """ML-06, ML-07: logistic (L2, C=1) and random forest."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / max(n_train, 1),
                            elasticNetParam=0.0, standardization=False, maxIter=1500)
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=rf_trees, maxDepth=14,
                                minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=seed,
                                maxMemoryInMB=1024, cacheNodeIds=True)
    return {name: Pipeline(stages=[*preprocessor(), m]) for name, m in [("LogisticRegression", lr), ("RandomForest", rf)]}


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("booked_flag").cast("double"))


def assert_model_frame(frame: DataFrame, features: Sequence[str] = FEATURES) -> None:
    """IN-15 gate: an empty frame or any missing feature value fails (one aggregate, one row collected)."""
    row = frame.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    if not row["__n"]:
        raise RuntimeError("The model frame has no rows.")
    bad = {c: row[c] for c in features if row[c]}
    if bad:
        raise RuntimeError(f"The model frame lacks feature values: {bad}")


def with_probability(model, df: DataFrame, name: str = "p") -> DataFrame:
    """The rows with the probability of a yes, from a pipeline or a network."""
    out = model.transform(_labelled(df))
    if isinstance(model, neural.NetworkModel):
        return out.withColumn(name, F.col("probability")[1])
    return out.withColumn(name, vector_to_array(F.col("probability"))[1])


def without_summary(model):
    """The model without what training recorded: a summary holds its session, which cannot be sent to tasks once a
    query of that session has been observed (`gates`)."""
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkContext._jvm.scala.Option.empty())
    return model


#: Rows of a partition of a forest's input: each partition sends sums for every node of every tree, however few its rows.
FOREST_ROWS = 1_000_000


def fit_forest(train: DataFrame, forest: Pipeline, n: int) -> PipelineModel:
    """ML-07: the trees in as many forests as keep all cores busy, fitted at the same time over the same rows, as one model.

    Every tree sees a sample of all rows.  Dealing the rows to all cores instead would multiply the sums of nodes that
    are exchanged, which outweigh the rows.
    """
    *stages, rf = forest.getStages()
    prep = Pipeline(stages=stages).fit(train)
    index, _, numeric = prep.stages[:3]
    if n >= forests.LEAST_ROWS and forests.fits(n, index.labelsArray, len(numeric.getInputCols()), rf.getMaxBins()):
        # Spark's passes over the rows would take most of the training
        rows = prep.transform(train)
        shell = without_summary(rf.copy({rf.numTrees: 1, rf.maxDepth: 1}).fit(rows.select("label", "features").limit(FEW_ROWS)))
        coded = forests.coded(rows, index.labelsArray, index.getOutputCols(), prep.stages[3].getOutputCol(), len(numeric.getInputCols()), rf.getMaxBins())
        return PipelineModel([*prep.stages, forests.fit(*coded, rf, shell)])
    parts = max(1, -(-n // FOREST_ROWS))
    rows = cut_lineage(prep.transform(train).select("label", "features")).coalesce(parts)
    trees = rf.getNumTrees()
    groups = min(-(-train.sparkSession.sparkContext.defaultParallelism // parts), max(1, n // FEW_ROWS), trees)

    def fit(g: int) -> RandomForestClassificationModel:
        some = trees // groups + (g < trees % groups)
        return without_summary(rf.copy({rf.numTrees: some, rf.seed: rf.getSeed() + g}).fit(rows))
    with ThreadPoolExecutor(max_workers=groups) as pool:
        grown = list(pool.map(fit, range(groups)))
    return PipelineModel([*prep.stages, grown[0] if groups == 1 else merged(grown, rf.getSeed())])


def merged(forests: Sequence[RandomForestClassificationModel], seed: int) -> RandomForestClassificationModel:
    """One forest of the trees of all."""
    jvm, first = SparkContext._jvm, forests[0]._java_obj
    trees = [t for f in forests for t in f._java_obj.trees()]
    array = SparkContext._gateway.new_array(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(trees))
    for k, t in enumerate(trees):
        array[k] = t
    whole = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(first.uid(), array, first.numFeatures(), first.numClasses())
    first.copyValues(whole, jvm.org.apache.spark.ml.param.ParamMap.empty())
    whole.set(whole.numTrees(), len(trees))
    whole.set(whole.seed(), seed)
    model = RandomForestClassificationModel(whole)
    model._transfer_params_from_java()
    return model


def fit_candidates(train: DataFrame, validation: DataFrame, rf_trees: int = 350, seed: int = 42):
    """ML-13: fit candidates, score validation, metric rows and best-F1 thresholds."""
    tr = _labelled(train)
    n = tr.count()
    pipes = candidate_pipelines(n, seed, rf_trees)
    jobs = {"LogisticRegression": lambda: without_summary(pipes["LogisticRegression"].fit(tr)),
            "RandomForest": lambda: fit_forest(tr, pipes["RandomForest"], n)}
    jobs["MLP"] = lambda: neural.fit(tr, CATEGORICAL, NUMERIC, "session_id", "label", seed=seed)

    def judged(name: str):
        model = jobs[name]()
        return model, metric_row(with_probability(model, validation).select("session_id", "booked_flag", "p"), name, "validation")
    # the candidates are independent jobs: fit them concurrently (the network's small steps overlap the forest); each is
    # scored as soon as it is fitted, while others still train
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        done = dict(zip(jobs, pool.map(judged, jobs)))
    fitted = {name: model for name, (model, _) in done.items()}
    rows = reduce(DataFrame.unionByName, [m for _, m in done.values()])
    prior = tr.agg(F.avg("label").alias("p")).first()["p"]
    dummy = validation.select("session_id", "booked_flag", F.lit(float(prior)).alias("p"))
    rows = rows.unionByName(metric_row(dummy, "Dummy", "validation"))
    return fitted, rows


def metric_row(scored: DataFrame, model: str, split: str, threshold=None) -> DataFrame:
    """ML-10/11/12 combined into one row for a scored split.

    The scored split is materialised once: every metric below is another
    aggregate over it, and re-running the model transform for each would
    multiply the scoring cost.
    """
    scored = cut_lineage(scored.select("session_id", "booked_flag", "p"))
    rank = ml_metrics.ranking_metrics(scored, "booked_flag", "p")
    if threshold is None:
        thr = ml_metrics.best_f1_threshold(scored, "booked_flag", "p").select("threshold")
    else:
        thr = scored.sparkSession.range(1).select(F.lit(float(threshold)).alias("threshold"))
    t = thr.first()["threshold"]
    tm = ml_metrics.threshold_metrics(scored, "booked_flag", "p", t if t is not None else 0.5)
    return rank.crossJoin(tm.select("accuracy", "precision", "recall", "f1")).select(
        F.lit(model).alias("model"), F.lit(split).alias("split"), "roc_auc", "pr_auc", "log_loss", "brier",
        F.lit(t).cast("double").alias("threshold"), "accuracy", "precision", "recall", "f1")


def select_champion(comparison: DataFrame, eligible: Sequence[str] = CANDIDATES) -> str:
    """ML-13: (PR-AUC desc, ROC-AUC desc, log loss asc) among the eligible models (Q21)."""
    best = comparison.filter(F.col("model").isin(*eligible)).agg(F.max_by("model", F.struct(
        F.col("pr_auc"), F.col("roc_auc"), -F.col("log_loss"))).alias("m")).first()
    return best["m"]


def lock(scored: DataFrame, threshold: float, score: str = "booking_probability", key: str = "session_id") -> DataFrame:
    """ML-14: every scored row with the decision at the locked threshold and its probability bin."""
    s = scored.withColumn("predicted_booking", (F.col(score) >= F.lit(threshold)).cast("bigint"))
    return ml_metrics.with_bins(s, score, key)


def score_locked(model, test: DataFrame, threshold: float) -> DataFrame:
    """ML-14: test scoring with the validation-locked threshold, one row per unit.

    The scores are written once: bins sample, count and order them, and each pass would apply the model again.
    """
    s = with_probability(model, test, "booking_probability").select("session_id", "partner_id", "session_ts", "booked_flag",
                                                                    "booking_probability")
    return lock(cut_lineage(s), threshold)


PROBIT_CLIP = 1e-6


def independent_columns(corr, tolerance: float = 1e-9) -> list[int]:
    """Columns of a correlation matrix, in order, that are not linear functions of those kept before.

    Gram-Schmidt on the matrix itself: what remains of a column's variance after the kept
    ones decides.  Constant columns (no correlation) are left out.
    """
    left, kept = np.array(corr, dtype=float), []
    usable = np.isfinite(np.diag(left)) & (np.nan_to_num(left) != 0).any(axis=1)
    off = np.isnan(left).sum(axis=1) >= len(left) - 1
    left = np.nan_to_num(left)
    for j in range(len(left)):
        if usable[j] and not off[j] and left[j, j] > tolerance:
            kept.append(j)
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return kept


PROBIT_NAMES = "C({0})[T.{1}]"


@dataclass
class ProbitModel:
    """A probit benchmark: its design and coefficients."""
    categorical: list[str]
    reference: dict[str, str | None]
    dropped: list[str]
    names: list[str]
    beta: list[float]

    def terms(self) -> Column:
        return encoding.treatment_terms(NUMERIC, self.categorical, self.reference, PROBIT_NAMES, self.dropped)


def probit_design(train: DataFrame) -> ProbitModel:
    """ML-09: the full formula where its columns are independent, else the reduced one without what depends on others.

    Independence is judged on the correlations of all columns, from one long-form X'X.  The first level of each
    categorical is its reference.
    """
    for categorical in (CATEGORICAL, REDUCED):
        model = ProbitModel(list(categorical), encoding.reference_levels(train, categorical), [], [], [])
        names, xtx = gram.matrix(gram.gram(train, model.terms()))
        corr = gram.correlation(names, xtx)
        columns = [n for n in names if n != "Intercept"]
        kept = {columns[i] for i in independent_columns(corr)}
        model.dropped = [n for n in columns if n not in kept]
        if not model.dropped:
            break
    return model


def fit_probit(train: DataFrame, max_iter: int = 250) -> tuple[ProbitModel, DataFrame]:
    """ML-09: probit on raw numerics and reference-coded categoricals, with Wald statistics."""
    model = probit_design(train)
    fit = gram.probit(train, model.terms(), F.col("booked_flag"), max_iter)
    model.names, model.beta = fit["names"], [float(b) for b in fit["beta"]]
    formula = "full" if model.categorical == CATEGORICAL else "reduced"
    rows = [(n, b, float(se), float(special.two_sided_normal_p(b / se)) if se > 0 else None, b - special.Z_975 * float(se),
             b + special.Z_975 * float(se), formula) for n, b, se in zip(model.names, model.beta, fit["se"])]
    table = train.sparkSession.createDataFrame(
        rows, "term string, coefficient double, standard_error double, p_value double, ci_low double, "
              "ci_high double, formula_used string")
    return model, table


def score_probit(model: ProbitModel, frame: DataFrame) -> DataFrame:
    """Probabilities of the probit benchmark, kept off 0 and 1."""
    eta = gram.linear(model.terms(), model.names, model.beta)
    scored = frame.withColumn("__eta", eta)
    p = F.least(F.greatest(special.normal_cdf(F.col("__eta")), F.lit(PROBIT_CLIP)), F.lit(1 - PROBIT_CLIP))
    return scored.select("session_id", "booked_flag", p.alias("p"))


def permutation_importance(model, validation: DataFrame, features: Sequence[str] = FEATURES,
                           repeats: int = 5, seed: int = 42) -> DataFrame:
    """ML-17: mean/std drop in average precision when one feature is shuffled, over all validation rows.

    A repeat is a permutation: rows numbered in one hash order take their values from the
    rows of that number in another, so it does not depend on the partitioning.  Row
    numbers come from range partitions, and all (feature, repeat) copies are ranked by
    one range-partitioned running sum: no group is ever in one task.  Unshuffled rows are scored once and written.
    """
    rows = cut_lineage(with_probability(model, validation, "__p").select("session_id", "booked_flag", "__p", *features))
    key = F.xxhash64("session_id", F.lit(seed))
    base = global_row_number(rows, [key, F.col("session_id")], "__i")
    shuffled = None
    for r in range(repeats):
        other = F.xxhash64("session_id", F.lit(r), F.lit(seed + 1))
        donors = global_row_number(rows.select("session_id", *features), [other, F.col("session_id")], "__i").select(
            "__i", *[F.col(f).alias(f"__d_{f}") for f in features])
        part = base.join(donors, "__i").withColumn("rep", F.lit(r))
        shuffled = part if shuffled is None else shuffled.unionByName(part)
    # each task that scores reads the whole model first: no more tasks than cores, unless these would be large
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shuffled = cut_lineage(shuffled.drop("__i")).coalesce(max(cores, -(-rows.count() * repeats // MANY_ROWS)))
    copies = shuffled.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    own = F.coalesce(*[F.when(F.col("feature") == f, F.col(f).eqNullSafe(F.col(f"__d_{f}"))) for f in features])
    # a copy that got the value it had keeps its score
    same = copies.where(own).select("feature", "rep", "booked_flag", F.col("__p").alias("p"))
    copies = copies.where(~own).withColumns({f: F.when(F.col("feature") == f, F.col(f"__d_{f}")).otherwise(F.col(f))
                                             for f in features}).drop("__p", *[f"__d_{f}" for f in features])
    scored = with_probability(model, copies).select("feature", "rep", "booked_flag", "p").unionByName(same)
    ap = grouped_ap(scored, ["feature", "rep"], "booked_flag", "p")
    base_ap = ml_metrics.ranking_metrics(rows.select("booked_flag", F.col("__p").alias("p")), "booked_flag", "p").select(
        F.col("pr_auc").alias("__base"))
    imp = ap.crossJoin(F.broadcast(base_ap)).withColumn("drop", F.col("__base") - F.col("ap"))
    out = imp.groupBy("feature").agg(F.avg("drop").alias("importance_mean_pr_auc"),
                                     F.stddev_pop("drop").alias("importance_std"))
    return rank_unique(out, [F.col("importance_mean_pr_auc").desc(), F.col("feature").asc()], "importance_rank")


def grouped_ap(scored: DataFrame, groups: Sequence[str], label: str, score: str) -> DataFrame:
    """Average precision per group; NULL for a group without positives.

    One running sum over all groups in order; what a group's predecessors add is taken off
    again by the groups' totals (one row for each group).
    """
    agg = scored.groupBy(*groups, F.col(score).alias("t")).agg(F.sum(F.col(label)).alias("pos"),
                                                               F.sum(1 - F.col(label)).alias("neg"))
    c = global_cumsum(agg, [*[F.col(g).asc() for g in groups], F.col("t").desc()], ["pos", "neg"])
    ends = c.groupBy(*groups).agg(F.max(F.col("cum_pos")).alias("__p"), F.max(F.col("cum_neg")).alias("__n"),
                                  F.sum("pos").alias("__gp"), F.sum("neg").alias("__gn"))
    c = c.join(F.broadcast(ends), list(groups))
    cp = F.col("cum_pos") - (F.col("__p") - F.col("__gp"))
    cn = F.col("cum_neg") - (F.col("__n") - F.col("__gn"))
    return c.groupBy(*groups).agg(F.try_divide(F.sum(F.col("pos") * F.try_divide(cp, cp + cn)), F.sum("pos")).alias("ap"))


def model_specific_importance(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """ML-18: coefficients (logistic) or impurity importances (forest) with feature names."""
    m = model.stages[-1]
    attrs = model.transform(_labelled(frame.limit(1))).schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for kind in attrs for a in attrs[kind]}
    if hasattr(m, "coefficients"):
        vals = list(m.coefficients)
        kind = "coefficient"
    else:
        vals = list(m.featureImportances.toArray())
        kind = "feature_importance"
    rows = [(names.get(i, f"x{i}"), float(v), float(abs(v))) for i, v in enumerate(vals)]
    df = frame.sparkSession.createDataFrame(rows, f"feature string, {kind} double, absolute_value double")
    return rank_unique(df, [F.col("absolute_value").desc(), F.col("feature").asc()], "importance_rank")


def batch_score(model, requests: DataFrame, threshold: float,
                required: Sequence[str] = FEATURES) -> DataFrame:
    """ML-22: strict feature contract, then probability / threshold / decision per row.

    Rows violating the contract (unknown or missing columns fail fast; out of
    range or NULL values are rejected per row with a reason).
    """
    cols = set(requests.columns) - {"request_id"}
    extra = cols - set(required)
    leak = cols & set(LEAKAGE_EXCLUSIONS)
    missing = set(required) - cols
    if extra or missing or leak:
        raise ValueError(f"feature contract violated: extra={sorted(extra)} missing={sorted(missing)} "
                         f"leakage={sorted(leak)}")
    reason = None
    for c in required:
        cond = F.col(c).isNull()
        msg = F.lit(f"{c} is null")
        reason = F.when(cond, msg) if reason is None else reason.when(cond, msg)
    for c, (lo, hi) in RANGES.items():
        reason = reason.when(~F.col(c).between(lo, hi), F.lit(f"{c} out of range"))
    for c in CATEGORICAL:
        reason = reason.when((F.length(c) < 1) | (F.length(c) > 80), F.lit(f"{c} length out of range"))
    checked = requests.withColumn("rejection_reason", reason)
    ok = checked.filter(F.col("rejection_reason").isNull()).withColumn("booked_flag", F.lit(0))
    scored = with_probability(model, ok, "booking_probability").select(*requests.columns, "booking_probability")
    scored = scored.withColumns({"threshold": F.lit(float(threshold)),
                                 "predicted_booking": (F.col("booking_probability") >= threshold).cast("bigint"),
                                 "accepted": F.lit(True), "rejection_reason": F.lit(None).cast("string")})
    rej = checked.filter(F.col("rejection_reason").isNotNull()).select(
        *requests.columns, F.lit(None).cast("double").alias("booking_probability"),
        F.lit(float(threshold)).alias("threshold"), F.lit(None).cast("bigint").alias("predicted_booking"),
        F.lit(False).alias("accepted"), "rejection_reason")
    return scored.unionByName(rej)


def registry_row(spark, champion: str, threshold: float, split_dates: dict, features=FEATURES, classification: str = "unclassified",
                 bundle: str | None = None, digest: str | None = None) -> DataFrame:
    """ML-23: one-row model registry record; ``bundle`` and ``digest`` name the stored model behind it."""
    return spark.createDataFrame([(
        champion, float(threshold), "validation", split_dates["train_end"], split_dates["val_start"],
        split_dates["val_end"], split_dates["test_start"], list(features), list(LEAKAGE_EXCLUSIONS),
        "first search of the session", classification, bundle, digest)],
        "champion string, locked_threshold double, threshold_source string, train_end string, "
        "validation_start string, validation_end string, test_start string, features array<string>, "
        "leakage_exclusions array<string>, prediction_point string, data_classification string, bundle string, "
        "bundle_digest string")
