import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import anomaly, growth


def test_growth_windows_recent_4_prior_3(spark):
    # 12 Monday buckets for 2 entities, one unit per bucket
    mondays = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(12)]
    rows = [(p, w, 1, 1, 1, 1, 10.0, 1.0) for p in (1, 2) for w in mondays]
    weekly = spark.createDataFrame(rows, "partner_id long, session_week date, sessions long, searches long, "
                                         "bookings long, booking_sessions long, successful_booking_value double, "
                                         "platform_revenue double")
    perf = spark.createDataFrame([(1,), (2,), (3,)], "partner_id long")
    g = {r.partner_id: r for r in growth.partner_growth(weekly, perf).collect()}
    assert g[1].recent_4w_sessions == 4 and g[1].prior_4w_sessions == 3
    assert g[3].recent_4w_sessions == 0 and g[3].successful_value_growth_rate == 0.0
    g4 = {r.partner_id: r for r in growth.partner_growth(weekly, perf, reference_window=False).collect()}
    assert g4[1].prior_4w_sessions == 4


def test_growth_rate_zero_prior_counts_as_one(spark):
    w = dt.date(2024, 3, 4)
    weekly = spark.createDataFrame([(1, w, 1, 1, 1, 1, 5.0, 0.0)],
                                   "partner_id long, session_week date, sessions long, searches long, bookings long, "
                                   "booking_sessions long, successful_booking_value double, platform_revenue double")
    perf = spark.createDataFrame([(1,)], "partner_id long")
    assert growth.partner_growth(weekly, perf).first().successful_value_growth_rate == 1.0


def test_pivot_missing_type_is_null_column(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), "contract_signed"),
                                (1, dt.datetime(2024, 1, 1), "contract_signed"),
                                (1, dt.datetime(2024, 1, 5), "first_search"),
                                (2, dt.datetime(2024, 1, 3), "integration_test")],
                               "partner_id long, event_ts timestamp_ntz, event_type string")
    p = {r.partner_id: r for r in growth.pivot_milestones(ev).collect()}
    assert p[1].contract_signed == dt.datetime(2024, 1, 1)
    assert p[1].first_booking_ts is None and p[2].first_search_ts is None


def _pandas_reference(values, lookback=28, min_hist=14):
    s = pd.Series(values, dtype=float)
    med = s.shift(1).rolling(lookback, min_periods=min_hist).median()
    mad = (s - med).abs().shift(1).rolling(lookback, min_periods=min_hist).median()
    fb = float(s.std(ddof=0)) or 1e-6
    scale = (1.4826 * mad).replace(0, np.nan).fillna(fb)
    return med, mad, (s - med) / scale


def test_rolling_robust_z_matches_pandas_rules(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(10, 1, 40))
    vals[20:26] = [10.0] * 6          # zero-MAD stretch
    vals[35] = 30.0                   # spike
    base = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([(base + dt.timedelta(days=i), float(v)) for i, v in enumerate(vals)],
                                  "metric_date date, no_result_rate double")
    long = anomaly.metric_long(daily, {"no_result_rate": "high"})
    got = anomaly.rolling_scores(long).orderBy("metric_date").toPandas()
    med, mad, z = _pandas_reference(vals)
    assert got.baseline_median.isna().sum() == 14 and med.isna().sum() == 14
    assert got.rolling_mad.isna().sum() == 28 and mad.isna().sum() == 28
    np.testing.assert_allclose(got.baseline_median[14:], med[14:], rtol=1e-12)
    np.testing.assert_allclose(got.robust_z[14:], z[14:], rtol=1e-9)
    det = anomaly.detect(anomaly.rolling_scores(long)).collect()
    assert any(r.metric_date == base + dt.timedelta(days=35) for r in det)
    nums = sorted(int(r.case_id[-3:]) for r in det)
    assert nums == list(range(1, len(det) + 1))     # one global counter (Q25)
