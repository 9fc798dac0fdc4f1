"""Cases that once cut ids, divided by zero or passed a gate they should fail."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import anomaly, experiment, propensity
from kestrel.sources.tables import read_table


def test_case_ids_stay_unique_beyond_999(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i // 7), f"m{i % 7}", "high", 9.0, 1.0, 4.0 + (i % 5)) for i in range(2800)]
    scores = spark.createDataFrame(rows, "metric_date date, metric string, adverse_direction string, value double, "
                                         "baseline_median double, robust_z double")
    found = anomaly.detect(scores)
    assert found.count() == 2800 and found.select("case_id").distinct().count() == 2800


def test_degenerate_arms_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1, 2.0, 0.0, 5), (1.0, 0.5, 9, 2.0, 0.5, 9)], "mt double, vt double, nt int, mc double, vc double, nc int")
    got = experiment.welch_columns(df, "mt", "vt", "nt", "mc", "vc", "nc").orderBy("nt").collect()
    assert got[0]["p_value"] is None and 0 < got[1]["p_value"] < 1


def test_average_precision_by_group(spark):
    rows = [("a", 0, y, p) for y, p in [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.05)]] + [("b", 1, 0, 0.3), ("b", 1, 0, 0.7)]
    rows += [("c", 0, i % 3 == 0, (i * 37 % 101) / 101) for i in range(400)]
    df = spark.createDataFrame([(f, r, int(y), float(p)) for f, r, y, p in rows], "feature string, rep int, booked_flag int, p double")
    got = {x["feature"]: x["ap"] for x in propensity.grouped_ap(df, ["feature", "rep"], "booked_flag", "p").collect()}

    def brute(pairs):
        total, out = sum(y for y, _ in pairs), 0.0
        for t in {p for _, p in pairs}:
            above = [y for y, p in pairs if p >= t]
            out += sum(y for y, p in pairs if p == t) * sum(above) / len(above)
        return out / total
    for f in "ac":
        assert abs(got[f] - brute([(int(y), p) for g, _, y, p in rows if g == f])) < 1e-12
    assert got["b"] is None


def test_model_frame_gate(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "a int, b double")
    propensity.assert_model_frame(df, ["a"])
    with pytest.raises(RuntimeError, match="b"):
        propensity.assert_model_frame(df, ["a", "b"])
    with pytest.raises(RuntimeError):
        propensity.assert_model_frame(df.limit(0), ["a"])


def test_dependent_columns_are_found():
    import numpy as np
    r = np.random.default_rng(1)
    x = r.standard_normal((200, 3))
    with np.errstate(invalid="ignore"):
        corr = np.corrcoef(np.column_stack([x, x[:, 0] - 2 * x[:, 1], np.ones(200)]).T)
    assert propensity.independent_columns(corr) == [0, 1, 2]


def test_probit_is_scored_off_zero_and_one(spark):
    rows = [(i, i % 2, float(i % 7), "x" if i % 3 else "y") for i in range(300)]
    df = spark.createDataFrame(rows, "session_id int, booked_flag int, v double, c string")
    for name in propensity.NUMERIC:
        df = df.withColumn(name, F.col("v") + F.rand(len(name)))
    for name in propensity.CATEGORICAL:
        df = df.withColumn(name, F.col("c"))
    model, table = propensity.fit_probit(df)
    assert {r["formula_used"] for r in table.collect()} == {"reduced"}      # the categoricals are copies of one another
    p = propensity.score_probit(model, df).agg(F.min("p"), F.max("p")).first()
    assert 1e-6 <= p[0] <= p[1] <= 1 - 1e-6


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path), "nothing")
