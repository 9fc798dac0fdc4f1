import math

import numpy as np
import pandas as pd

from kestrel.operators import ml_metrics as MM


def _fixture(n=37, seed=1):
    rng = np.random.default_rng(seed)
    score = np.round(rng.random(n), 1)          # many ties
    label = (rng.random(n) < score).astype(int)
    return score, label


def _auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _ap(score, label):
    thr = np.unique(score)[::-1]
    ap, prev_r = 0.0, 0.0
    for t in thr:
        pred = score >= t
        tp = (pred & (label == 1)).sum()
        prec = tp / pred.sum()
        rec = tp / label.sum()
        ap += (rec - prev_r) * prec
        prev_r = rec
    return ap


def test_ranking_metrics_tie_aware(spark):
    score, label = _fixture()
    df = spark.createDataFrame([(int(i), float(s), int(y)) for i, (s, y) in enumerate(zip(score, label))],
                               "k long, s double, y long")
    r = MM.ranking_metrics(df, "y", "s").first()
    assert abs(r.roc_auc - _auc(score, label)) < 1e-12
    assert abs(r.pr_auc - _ap(score, label)) < 1e-12
    p = np.clip(score, MM.LOG_EPS, 1 - MM.LOG_EPS)
    assert abs(r.log_loss - np.mean(-(label * np.log(p) + (1 - label) * np.log(1 - p)))) < 1e-12
    assert abs(r.brier - np.mean((score - label) ** 2)) < 1e-12


def test_best_f1_lowest_threshold_on_ties(spark):
    score, label = _fixture(50, 4)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "s double, y long")
    best = MM.best_f1_threshold(df, "y", "s").first()
    f1s = {}
    for t in np.unique(score):
        pred = score >= t
        tp = (pred & (label == 1)).sum()
        p, r = tp / pred.sum(), tp / label.sum()
        f1s[t] = 2 * p * r / (p + r) if p + r else 0.0
    top = max(f1s.values())
    assert best.threshold == min(t for t, f in f1s.items() if f == top)


def test_calibration_bins_equal_qcut_of_ranks(spark):
    for n in (7, 10, 11, 37, 100, 1003):
        rng = np.random.default_rng(n)
        score = rng.random(n)
        df = spark.createDataFrame([(int(i), float(s), int(i % 2)) for i, s in enumerate(score)],
                                   "k long, s double, y long")
        got = {r.probability_bin: r.sessions for r in MM.calibration(df, "y", "s", "k").collect()}
        ranks = pd.Series(score).rank(method="first")
        bins = pd.qcut(ranks, q=min(10, n), labels=False, duplicates="drop")
        assert got == bins.value_counts().to_dict(), n


def test_top_decile(spark):
    score, label = _fixture(123, 9)
    df = spark.createDataFrame([(int(i), float(s), int(y)) for i, (s, y) in enumerate(zip(score, label))],
                               "k long, s double, y long")
    r = MM.top_decile(df, "y", "s", "k").first()
    order = sorted(range(len(score)), key=lambda i: (-score[i], i))
    n_top = max(1, math.ceil(len(score) * 0.10))
    top_pos = label[order[:n_top]].sum()
    assert r.top_sessions == n_top and r.top_positives == top_pos
    assert abs(r.top_decile_lift - (top_pos / n_top) / label.mean()) < 1e-12


def test_batch_scoring_contract_rejects_unknown_and_leakage_columns(spark):
    import pytest

    from kestrel.operators import propensity as P
    row = {c: "x" for c in P.CATEGORICAL} | {c: 1 for c in P.NUMERIC}
    base = spark.createDataFrame([row])
    with pytest.raises(ValueError, match="extra"):
        P.batch_score(None, base.withColumn("unexpected", base["passengers"]), 0.5)
    with pytest.raises(ValueError, match="leakage"):
        P.batch_score(None, base.withColumn("booking_value", base["passengers"]), 0.5)
    with pytest.raises(ValueError, match="missing"):
        P.batch_score(None, base.drop("search_hour"), 0.5)
