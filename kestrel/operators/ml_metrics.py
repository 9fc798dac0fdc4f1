"""Model evaluation as aggregates (ML-10, ML-11, ML-12, ML-15, ML-16).

Exact and tie-aware: scores are first aggregated to distinct values, then
running sums over the score order give every threshold at once.  Nothing is
collected; global orderings use ``kestrel.functions.ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.core import safe_div
from kestrel.functions.ranking import global_cumsum, global_row_number

LOG_EPS = 2.220446049250313e-16   # float64 machine epsilon: log-loss clipping


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score (descending): positives, negatives and running totals."""
    agg = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))
    return global_cumsum(agg, [F.col("threshold").desc()], ["pos", "neg"])


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ML-10: ROC-AUC (ties count one half), average precision, log loss, Brier."""
    curve = score_curve(df, label, score)
    tot = df.agg(F.sum(F.col(label).cast("double")).alias("P"),
                 F.sum((1 - F.col(label)).cast("double")).alias("N"))
    c = curve.crossJoin(F.broadcast(tot))
    auc_part = F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0)
    ap_part = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    curve_m = c.agg(F.sum(auc_part).alias("__auc"), F.sum(ap_part).alias("__ap"),
                    F.first("P").alias("P"), F.first("N").alias("N"))
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(LOG_EPS)), F.lit(1.0 - LOG_EPS))
    y = F.col(label).cast("double")
    pt = df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
                F.avg(F.pow(F.col(score).cast("double") - y, 2)).alias("brier"))
    return curve_m.crossJoin(pt).select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("__auc") / (F.col("P") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.col("__ap") / F.col("P")).alias("pr_auc"), "log_loss", "brier")


def best_f1_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """ML-11: threshold with the best F1 over all distinct scores; lowest threshold on ties."""
    curve = score_curve(df, label, score)
    tot = df.agg(F.sum(F.col(label).cast("double")).alias("P"))
    c = curve.crossJoin(F.broadcast(tot))
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    rec = F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).otherwise(F.lit(1.0))
    c = c.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") != 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return c.withColumn("f1", f1).agg(
        F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("threshold"),
        F.max("f1").alias("best_f1"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold) -> DataFrame:
    """ML-12: accuracy, precision, recall, F1 at ``score >= threshold`` (zero division -> 0)."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    c = df.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
               F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    c = c.withColumns({
        "accuracy": safe_div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
        "precision": safe_div("tp", F.col("tp") + F.col("fp")),
        "recall": safe_div("tp", F.col("tp") + F.col("fn")),
    })
    return c.withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"),
                                       F.col("precision") + F.col("recall")))


def top_decile(df: DataFrame, label: str, score: str, key: str, share: float = 0.10) -> DataFrame:
    """ML-15: lift and positive capture in the top ``max(1, ceil(share * n))`` rows (ties by key)."""
    ranked = global_row_number(df.select(key, label, score), [F.col(score).desc(), F.col(key).asc()], "__r")
    n = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("pos"))
    n = n.withColumn("n_top", F.greatest(F.lit(1), F.ceil(F.col("n") * share)).cast("bigint"))
    j = ranked.crossJoin(F.broadcast(n))
    top = F.col("__r") <= F.col("n_top")
    a = j.agg(F.first("n").alias("sessions"), F.first("n_top").alias("top_sessions"),
              F.first("pos").alias("positives"),
              F.sum(F.when(top, F.col(label).cast("double")).otherwise(0.0)).alias("top_positives"))
    a = a.withColumns({"overall_booking_rate": safe_div("positives", "sessions"),
                       "top_decile_booking_rate": safe_div("top_positives", "top_sessions")})
    return a.withColumns({
        "top_decile_lift": safe_div("top_decile_booking_rate", "overall_booking_rate"),
        "top_decile_positive_capture": safe_div("top_positives", "positives"),
    })


def with_bins(df: DataFrame, score: str, key: str, bins: int = 10) -> DataFrame:
    """Every row with ``probability_bin``: equal-frequency bins of the score rank, as ``qcut`` of ranks 1..n (Q6)."""
    ranked = global_row_number(df, [F.col(score).asc(), F.col(key).asc()], "__r")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    j = ranked.crossJoin(F.broadcast(n))
    q = F.least(F.lit(bins), F.col("__n"))
    raw = F.floor(F.try_divide((F.col("__r") - 1) * q + F.col("__n") - 2, F.col("__n") - 1)) - 1
    b = F.when(F.col("__n") <= 1, F.lit(0)).otherwise(F.greatest(raw, F.lit(0))).cast("bigint")
    return j.withColumn("probability_bin", b).drop("__r", "__n")


def calibration(df: DataFrame, label: str, score: str, key: str, bins: int = 10) -> DataFrame:
    """ML-16: predicted and observed rates per bin."""
    return with_bins(df.select(key, label, score), score, key, bins).groupBy("probability_bin").agg(
        F.count(F.lit(1)).alias("sessions"), F.avg(F.col(score).cast("double")).alias("mean_predicted_probability"),
        F.avg(F.col(label).cast("double")).alias("observed_booking_rate"))
