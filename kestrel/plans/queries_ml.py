"""Registered queries: propensity models, metrics and segmentation (ML-01..ML-23, IN-15).

Metric operators are checked against DuckDB on a SQL-reproducible score:
the entity pre-period conversion (the CUPED covariate) as a predictor of
unit conversion in the experiment window.  Encoded rows and the probit have
oracles of their own; the outputs of forest, network and K-Means are checked by row
counts here and by invariants in the tests.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from kestrel.operators import ml_metrics as MM
from kestrel.operators import propensity as P
from kestrel.operators import encoding, model_bundle, quality, segments
from kestrel.plans import oracle_experiment as OX
from kestrel.plans import oracle_marts as M
from kestrel.plans import oracle_models as OM
from kestrel.plans.queries_core import sql
from kestrel.plans.registry import register
from kestrel.session import scratch_dir, spread, staged

SPLITS = {"train_end": "1999-12-31 23:59:59", "val_start": "2000-01-01 00:00:00",
          "val_end": "2000-06-30 23:59:59", "test_start": "2000-07-01 00:00:00"}
_MODELS: dict = {}


def frame(c):
    return P.model_frame(c.session_fact, c.views.partners, c.search_fact, c.views.stations)


def splits(c):
    return P.temporal_split(frame(c), SPLITS["train_end"], SPLITS["val_start"], SPLITS["val_end"],
                            SPLITS["test_start"])


def dealt_frame(c):
    """The model frame, built and dealt to all cores once for everything that trains or scores."""
    key = (c.spark.sparkContext.applicationId, c.base, "frame")
    if key not in _MODELS:
        _MODELS[key] = staged(spread(frame(c), c.session_fact.count(), "session_id"))
    return _MODELS[key]


def dealt_splits(c):
    return P.temporal_split(dealt_frame(c), *SPLITS.values())


def trained(c, rf_trees: int = 350):
    """Fit once per (session, data folder): candidates, champion, threshold, probit."""
    key = (c.spark.sparkContext.applicationId, c.base, rf_trees)
    if key not in _MODELS:
        s = dealt_splits(c)
        P.assert_model_frame(dealt_frame(c))
        P.assert_splits(P.split_summary(s))
        tr, va = s["train"], s["validation"]
        with ThreadPoolExecutor(max_workers=1) as pool:     # the benchmark is fitted beside the candidates
            benchmark = pool.submit(P.fit_probit, tr)
            fitted, comparison = P.fit_candidates(tr, va, rf_trees=rf_trees)
            probit, coefficients = benchmark.result()
        comparison = c.mart(comparison.unionByName(P.metric_row(P.score_probit(probit, va), "Probit", "validation")))
        champ = P.select_champion(comparison)
        thr = comparison.filter(F.col("model") == champ).first()["threshold"]
        _MODELS[key] = {"fitted": fitted, "comparison": comparison, "champion": champ, "threshold": thr,
                        "splits": s, "probit": probit, "coefficients": coefficients}
    return _MODELS[key]


M_FRAME = """m_fs AS (
  SELECT * FROM (
    SELECT session_id, partner_id, search_ts, journey_type, passengers, days_before_travel, result_count,
           no_result_flag, search_latency_ms, origin_station_id, destination_station_id,
           row_number() OVER (PARTITION BY session_id ORDER BY search_ts, search_id) AS rn
    FROM fct_search) AS r WHERE rn = 1),
m_frame AS (
  SELECT s.session_id, s.partner_id, s.session_ts, CAST(s.booked_flag AS BIGINT) AS booked_flag,
         s.successful_booking_value, s.device_type, s.acquisition_channel, CAST(s.is_logged_in AS BIGINT) AS is_logged_in,
         s.traveller_type, p.partner_type, p.country AS partner_country, p.integration_type, p.contract_tier,
         fs.search_ts, fs.journey_type, fs.passengers, fs.days_before_travel, fs.result_count, fs.no_result_flag,
         fs.search_latency_ms, fs.origin_station_id, fs.destination_station_id, os.country AS origin_country,
         ds.country AS destination_country, CAST(hour(fs.search_ts) AS BIGINT) AS search_hour,
         dayname(fs.search_ts) AS search_dow, CAST(os.country <> ds.country AS BIGINT) AS international_flag
  FROM fct_session s
  JOIN v_partners p ON s.partner_id = p.partner_id
  JOIN m_fs fs ON s.session_id = fs.session_id AND s.partner_id = fs.partner_id
  LEFT JOIN v_stations os ON fs.origin_station_id = os.station_id
  LEFT JOIN v_stations ds ON fs.destination_station_id = ds.station_id)"""

M_SPLITS = f"""m_split AS (
  SELECT 'train' AS split, * FROM m_frame WHERE session_ts <= TIMESTAMP '{SPLITS['train_end']}'
  UNION ALL SELECT 'validation', * FROM m_frame
    WHERE session_ts >= TIMESTAMP '{SPLITS['val_start']}' AND session_ts <= TIMESTAMP '{SPLITS['val_end']}'
  UNION ALL SELECT 'test', * FROM m_frame WHERE session_ts >= TIMESTAMP '{SPLITS['test_start']}')"""

EV = "m_ev AS (SELECT session_id AS key, CAST(booked_flag AS BIGINT) AS label, pre_partner_conversion AS score FROM x_cd)"
EPS = "2.220446049250313e-16"
CURVE = """m_curve AS (
  SELECT score AS t, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM m_ev GROUP BY score),
m_cum AS (
  SELECT *, sum(pos) OVER (ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS cp,
         sum(neg) OVER (ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS cn FROM m_curve),
m_tot AS (SELECT CAST(sum(label) AS DOUBLE) AS P, CAST(sum(1 - label) AS DOUBLE) AS N FROM m_ev),
m_f1 AS (
  SELECT t, CAST(cp AS DOUBLE) / (cp + cn) AS prec, CASE WHEN P > 0 THEN cp / P ELSE 1 END AS rec
  FROM m_cum CROSS JOIN m_tot),
m_best AS (
  SELECT t AS threshold, f1 AS best_f1 FROM (
    SELECT t, CASE WHEN prec + rec <> 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f1 FROM m_f1) AS x
  ORDER BY f1 DESC, t LIMIT 1)"""

METRIC_FINAL = f"""SELECT CASE WHEN P > 0 AND N > 0 THEN a.s_auc / (P * N) END AS roc_auc,
       CASE WHEN P > 0 THEN a.s_ap / P END AS pr_auc, b.log_loss, b.brier
FROM (SELECT sum(CAST(neg AS DOUBLE) * (cp - pos + CAST(pos AS DOUBLE) / 2)) AS s_auc,
             sum(CAST(pos AS DOUBLE) * cp / (cp + cn)) AS s_ap FROM m_cum) AS a
CROSS JOIN m_tot
CROSS JOIN (SELECT avg(-(label * ln(least(greatest(score, {EPS}), 1 - {EPS}))
                         + (1 - label) * ln(1 - least(greatest(score, {EPS}), 1 - {EPS})))) AS log_loss,
                   avg(pow(score - label, 2)) AS brier FROM m_ev) AS b"""


def ev(c):
    return c.evaluated


MR6 = ("roc_auc", "pr_auc", "log_loss", "brier")


@register("ml02_model_frame", ids=("ML-01", "ML-02"), r2=("successful_booking_value",),
          sql=sql("SELECT * FROM m_frame", M_FRAME))
def q_frame(c):
    return frame(c)


@register("ml03_temporal_split", ids=("ML-03",), sql=sql("""
SELECT split, count(*) AS rows, CAST(sum(booked_flag) AS BIGINT) AS positives, count(DISTINCT booked_flag) AS classes
FROM m_split GROUP BY split""", M_FRAME, M_SPLITS))
def q_split(c):
    return P.split_summary(splits(c))


@register("in15_feature_nulls", ids=("IN-15",), sql=sql("\nUNION ALL ".join(
    f"SELECT count(*) AS rows, '{f}' AS feature, count(*) FILTER (WHERE {f} IS NULL) AS nulls FROM m_frame"
    for f in P.FEATURES), M_FRAME))
def q_nulls(c):
    return quality.null_counts(frame(c), P.FEATURES)


@register("ml05_prior_baseline", ids=("ML-05",), r6=("prior_probability",) + MR6, sql=sql(f"""
SELECT * FROM (SELECT avg(CAST(booked_flag AS DOUBLE)) AS prior_probability FROM m_split WHERE split = 'train') AS pr
CROSS JOIN ({METRIC_FINAL.replace('m_ev', 'm_ev0')}) AS met""", M_FRAME, M_SPLITS,
    "m_ev AS (SELECT session_id AS key, booked_flag AS label, (SELECT avg(CAST(booked_flag AS DOUBLE)) FROM m_split "
    "WHERE split = 'train') AS score FROM m_split WHERE split = 'validation')",
    CURVE, "m_ev0 AS (SELECT * FROM m_ev)"))
def q_prior(c):
    s = splits(c)
    prior = s["train"].agg(F.avg(F.col("booked_flag").cast("double")).alias("prior_probability"))
    val = s["validation"].crossJoin(F.broadcast(prior)).select(
        F.col("booked_flag").alias("label"), F.col("prior_probability").alias("score"))
    return prior.crossJoin(MM.ranking_metrics(val, "label", "score"))


@register("ml10_ranking_metrics", ids=("ML-10",), r6=MR6,
          sql=sql(METRIC_FINAL, OX.POPULATION, OX.CUPED, EV, CURVE))
def q_ranking(c):
    return MM.ranking_metrics(ev(c), "label", "score")


@register("ml11_best_f1_threshold", ids=("ML-11",), r6=("threshold", "best_f1"),
          sql=sql("SELECT * FROM m_best", OX.POPULATION, OX.CUPED, EV, CURVE))
def q_best_f1(c):
    return MM.best_f1_threshold(ev(c), "label", "score")


@register("ml12_threshold_metrics", ids=("ML-12",), r6=("accuracy", "precision", "recall", "f1"), sql=sql(f"""
SELECT tp, fp, fn, tn, {M.sd('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {M.sd('tp', 'tp + fp')} AS precision,
       {M.sd('tp', 'tp + fn')} AS recall,
       {M.sd(f"2 * {M.sd('tp', 'tp + fp')} * {M.sd('tp', 'tp + fn')}", f"{M.sd('tp', 'tp + fp')} + {M.sd('tp', 'tp + fn')}")} AS f1
FROM (SELECT count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= threshold AND label <> 1) AS fp,
             count(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
             count(*) FILTER (WHERE score < threshold AND label <> 1) AS tn
      FROM m_ev CROSS JOIN m_best) AS k""", OX.POPULATION, OX.CUPED, EV, CURVE))
def q_threshold(c):
    e = ev(c)
    t = MM.best_f1_threshold(e, "label", "score").first()["threshold"]
    return MM.threshold_metrics(e, "label", "score", t)


@register("ml15_top_decile", ids=("ML-15",),
          r6=("overall_booking_rate", "top_decile_booking_rate", "top_decile_lift", "top_decile_positive_capture"),
          sql=sql(f"""
SELECT sessions, top_sessions, positives, top_positives,
       {M.sd('positives', 'sessions')} AS overall_booking_rate,
       {M.sd('top_positives', 'top_sessions')} AS top_decile_booking_rate,
       {M.sd(M.sd('top_positives', 'top_sessions'), M.sd('positives', 'sessions'))} AS top_decile_lift,
       {M.sd('top_positives', 'positives')} AS top_decile_positive_capture
FROM (SELECT count(*) AS sessions, any_value(n_top) AS top_sessions, CAST(sum(label) AS DOUBLE) AS positives,
             CAST(sum(CASE WHEN r <= n_top THEN label ELSE 0 END) AS DOUBLE) AS top_positives
      FROM (SELECT label, row_number() OVER (ORDER BY score DESC, key) AS r,
                   CAST(greatest(1, ceil(count(*) OVER () * CAST(0.1 AS DOUBLE))) AS BIGINT) AS n_top
            FROM m_ev) AS x) AS y""", OX.POPULATION, OX.CUPED, EV))
def q_top_decile(c):
    return MM.top_decile(ev(c), "label", "score", "key")


@register("ml16_calibration", ids=("ML-16",), r6=("mean_predicted_probability", "observed_booking_rate"), sql=sql("""
SELECT probability_bin, count(*) AS sessions, avg(score) AS mean_predicted_probability,
       avg(CAST(label AS DOUBLE)) AS observed_booking_rate
FROM (SELECT score, label,
             CASE WHEN n <= 1 THEN 0 ELSE CAST(greatest(floor(((r - 1) * least(10, n) + n - 2) / (n - 1)) - 1, 0) AS BIGINT)
             END AS probability_bin
      FROM (SELECT score, label, row_number() OVER (ORDER BY score, key) AS r, count(*) OVER () AS n FROM m_ev) AS a) AS b
GROUP BY probability_bin""", OX.POPULATION, OX.CUPED, EV))
def q_calibration(c):
    return MM.calibration(ev(c), "label", "score", "key")


# ---------------------------------------------------------------- trained models (rows-only)

VAL_R6 = ("roc_auc", "pr_auc", "log_loss", "brier", "threshold", "accuracy", "precision", "recall", "f1")


@register("ml13_model_comparison", ids=("ML-06", "ML-07", "ML-08", "ML-13"), r6=VAL_R6)
def q_comparison(c):
    t = trained(c)
    return t["comparison"].withColumn("champion", F.col("model") == F.lit(t["champion"]))


@register("ml09_probit_coefficients", ids=("ML-09",), r6=("coefficient", "standard_error", "p_value", "ci_low", "ci_high"), sql=sql(f"""
SELECT term, coefficient, standard_error, {OX.p_normal('(coefficient / standard_error)')} AS p_value,
       coefficient - {OX.Z} * standard_error AS ci_low, coefficient + {OX.Z} * standard_error AS ci_high, 'reduced' AS formula_used
FROM pb_fit""", M_FRAME, M_SPLITS, OM.probit(P.REDUCED)))
def q_probit(c):
    """The probit benchmark's coefficients; on these tables the full formula has dependent columns, so the reduced one counts."""
    return P.fit_probit(dealt_splits(c)["train"])[1]


@register("ml14_test_scores", ids=("ML-14",), r6=("booking_probability",))
def q_test_scores(c):
    t = trained(c)
    return P.score_locked(t["fitted"][t["champion"]], t["splits"]["test"], t["threshold"])


@register("ml14_scored_units", ids=("ML-14",), r6=("score",), sql=sql("""
SELECT key, label, score, CAST(score >= threshold AS BIGINT) AS predicted_booking,
       CASE WHEN n <= 1 THEN 0 ELSE CAST(greatest(floor(((r - 1) * least(10, n) + n - 2) / (n - 1)) - 1, 0) AS BIGINT)
       END AS probability_bin
FROM (SELECT key, score, label, row_number() OVER (ORDER BY score, key) AS r, count(*) OVER () AS n FROM m_ev) AS a
CROSS JOIN m_best""", OX.POPULATION, OX.CUPED, EV, CURVE))
def q_scored_units(c):
    """The locked decision and bin of every unit, on the SQL-reproducible score."""
    e = ev(c)
    return P.lock(e, MM.best_f1_threshold(e, "label", "score").first()["threshold"], "score", "key")


@register("ml14_probit_test_metrics", ids=("ML-09", "ML-14"), r6=VAL_R6)
def q_probit_test(c):
    t = trained(c)
    thr = t["comparison"].filter(F.col("model") == "Probit").first()["threshold"]
    return P.metric_row(P.score_probit(t["probit"], t["splits"]["test"]), "Probit", "test", threshold=thr)


@register("ml16_champion_calibration", ids=("ML-16",), r6=("mean_predicted_probability", "observed_booking_rate"))
def q_champion_calibration(c):
    return MM.calibration(q_test_scores(c), "booked_flag", "booking_probability", "session_id")


@register("ml14_locked_threshold_metrics", ids=("ML-14", "ML-15"), r6=VAL_R6)
def q_locked(c):
    t = trained(c)
    scored = P.score_locked(t["fitted"][t["champion"]], t["splits"]["test"], t["threshold"])
    s = scored.select("session_id", "booked_flag", F.col("booking_probability").alias("p"))
    return P.metric_row(s, t["champion"], "test", threshold=t["threshold"]).crossJoin(
        MM.top_decile(s, "booked_flag", "p", "session_id").select("top_decile_lift", "top_decile_positive_capture"))


@register("ml17_permutation_importance", ids=("ML-17",), r6=("importance_mean_pr_auc", "importance_std"))
def q_importance(c):
    t = trained(c)
    return P.permutation_importance(t["fitted"][t["champion"]], t["splits"]["validation"]).withColumn(
        "model", F.lit(t["champion"]))


@register("ml18_logistic_coefficients", ids=("ML-18",), r6=("coefficient", "absolute_value"))
def q_coefficients(c):
    t = trained(c)
    return P.model_specific_importance(t["fitted"]["LogisticRegression"], t["splits"]["train"])


@register("ml18_forest_importance", ids=("ML-18",), r6=("feature_importance", "absolute_value"))
def q_forest(c):
    t = trained(c)
    return P.model_specific_importance(t["fitted"]["RandomForest"], t["splits"]["train"])


def _stored(c):
    """The champion, published as a bundle and loaded from it."""
    t = trained(c)
    if "bundle" not in t:
        path = f"{scratch_dir(c.spark, 'models')}/champion"
        model_bundle.save(c.spark, path, t["fitted"][t["champion"]], t["champion"], t["threshold"], SPLITS, "synthetic")
        t["bundle"] = model_bundle.load(c.spark, path)
    return t["bundle"]


@register("ml22_batch_scoring", ids=("ML-22",), r6=("booking_probability",))
def q_batch(c):
    t = trained(c)
    req = t["splits"]["test"].select(F.col("session_id").alias("request_id"), *P.FEATURES)
    return model_bundle.score(_stored(c), req)


@register("ml23_model_registry", ids=("ML-23",), r6=("locked_threshold",))
def q_registry(c):
    return model_bundle.registry_row(c.spark, _stored(c))


CF = [("log_sessions", "ln(1 + sessions)"), ("log_searches", "ln(1 + searches)"),
      ("log_successful_booking_value", "ln(1 + successful_booking_value)"),
      ("log_platform_revenue", "ln(1 + platform_revenue)")]


@register("ml19_cluster_features", ids=("ML-19",), r2=("booking_value", "successful_booking_value", "platform_revenue"),
          r6=("session_booking_conversion", "no_result_rate", "alternatives_exposure_rate", "avg_search_latency_ms",
              "log_sessions", "log_searches", "log_successful_booking_value", "log_platform_revenue"),
          sql=sql(f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in CF)} FROM o_perf WHERE sessions > 0", M.PERFORMANCE))
def q_cluster_features(c):
    return segments.cluster_features(c.performance)


def _clusters(c):
    key = (c.spark.sparkContext.applicationId, c.base, "clusters")
    if key not in _MODELS:
        clustered, k, scores = segments.fit_clusters(segments.cluster_features(c.performance))
        clustered = c.mart(clustered)
        _MODELS[key] = (clustered, c.mart(segments.cluster_profile(clustered)), k, scores)
    return _MODELS[key]


@register("ml20_partner_clusters", ids=("ML-20",))
def q_clusters(c):
    clustered, prof, _, _ = _clusters(c)
    return segments.label_entities(clustered, prof)


PROFILE_R6 = ("median_sessions", "median_searches", "mean_conversion", "mean_no_result_rate", "mean_latency_ms",
              "median_successful_booking_value", "median_platform_revenue")


@register("ml21_cluster_profile", ids=("ML-21",), r6=PROFILE_R6)
def q_profile(c):
    return _clusters(c)[1]


@register("ml04_encoded_rows", ids=("ML-04",), r6=("value",),
          sql=sql("SELECT * FROM m_enc", M_FRAME, M_SPLITS, OM.encoded()))
def q_encoded(c):
    """Validation rows under the dictionary and the scaling of the training rows, as sparse long rows."""
    s = splits(c)
    tr, va = c.mart(s["train"].select("session_id", *P.FEATURES)), s["validation"]
    return encoding.encoded(va, ["session_id"], encoding.level_dictionary(tr, P.CATEGORICAL), encoding.scaling(tr, P.NUMERIC),
                            P.CATEGORICAL, P.NUMERIC)


@register("ml04_preprocessed_features", ids=("ML-04",))
def q_preprocess(c):
    """One-hot (unseen levels -> all zeros) + standardised numerics, fitted on train only."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    s = splits(c)
    model = Pipeline(stages=P.preprocessor()).fit(s["train"])
    out = model.transform(s["validation"])
    return out.select("session_id", F.size(vector_to_array("features")).alias("width"),
                      vector_to_array("features").alias("features"))
