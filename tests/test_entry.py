import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "metric_date" in df.columns and "session_booking_conversion" in df.columns


def test_registry_contract():
    qs, sq = E.queries(), E.oracle_sql()
    assert set(sq) <= set(qs)
    assert len(qs) >= 100
    for name, sql in sq.items():
        assert sql.lstrip().upper().startswith("WITH"), name


def test_small_queries_run(spark):
    qs = E.queries()
    for name in ["in11_check_table", "pm10_funnel", "ex05_srm", "nw15_endpoint_count", "an14_detection_summary"]:
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_quality_gate_raises_on_violation(spark):
    import pytest

    from kestrel.operators import quality
    checks = spark.createDataFrame([("a", 0), ("b", 2)], "check string, violations long")
    with pytest.raises(RuntimeError):
        quality.assert_checks(checks)
    quality.assert_checks(checks, allow=["b"])
