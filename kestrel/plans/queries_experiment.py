"""Registered queries: experimentation (EX-01..EX-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import paths
from kestrel.operators import encoding, gram
from kestrel.operators import experiment as X
from kestrel.plans import oracle_experiment as OX
from kestrel.plans import oracle_models as OM
from kestrel.plans.oracle_marts import sd
from kestrel.plans.queries_core import MONEY, sql
from kestrel.plans.registry import register
from kestrel.sources.views import EXPERIMENT_END, EXPERIMENT_NAME, EXPERIMENT_START

TP6 = ("control_rate", "variant_rate", "absolute_effect", "relative_effect", "standard_error", "ci_low", "ci_high",
       "z_stat")


@register("ex01_arm_assignment", ids=("EX-01",), sql=sql("""
SELECT o_orderkey AS session_id, o_orderdate AS session_ts,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
            THEN 'checkout_test' ELSE 'not_eligible' END AS experiment_name,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
            THEN CASE WHEN o_orderkey % 2 = 0 THEN 'control' ELSE 'variant' END ELSE 'not_eligible' END
         AS experiment_variant
FROM orders"""))
def q_assign(c):
    units = c.tables.orders.select(F.col("o_orderkey").alias("session_id"), F.col("o_orderdate").alias("session_ts"))
    return X.assign_arms(units, "session_id", "session_ts", EXPERIMENT_START, EXPERIMENT_END, EXPERIMENT_NAME,
                         method="modulo")


@register("ex01_digest_assignment", ids=("EX-01",), sql=sql("""
SELECT o_orderkey AS session_id, o_orderdate AS session_ts,
       CASE WHEN eligible THEN 'checkout_test' ELSE 'not_eligible' END AS experiment_name,
       CASE WHEN NOT eligible THEN 'not_eligible'
            WHEN CAST('0x' || substr(sha256('checkout_test:' || o_orderkey), 1, 8) AS BIGINT) % 10000 >= 5000 THEN 'control'
            ELSE 'variant' END AS experiment_variant
FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AS eligible FROM orders) AS o"""))
def q_digest_assign(c):
    units = c.tables.orders.select(F.col("o_orderkey").alias("session_id"), F.col("o_orderdate").alias("session_ts"))
    return X.assign_arms(units, "session_id", "session_ts", EXPERIMENT_START, EXPERIMENT_END, EXPERIMENT_NAME)


@register("ex02_population", ids=("EX-02",), sql=sql("""
SELECT 'session' AS population, experiment_variant, count(*) AS rows FROM x_session GROUP BY 2
UNION ALL SELECT 'searches', experiment_variant, count(*) FROM x_searches GROUP BY 2
UNION ALL SELECT 'bookings', experiment_variant, count(*) FROM x_bookings GROUP BY 2
UNION ALL SELECT 'preperiod', experiment_variant, count(*) FROM x_pre GROUP BY 2""", OX.POPULATION))
def q_population(c):
    e = c.experiment
    out = None
    for name in ("session", "searches", "bookings", "preperiod"):
        part = e[name].groupBy("experiment_variant").agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "population", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


ARM_R6 = ("session_booking_conversion", "no_result_rate", "alternatives_exposure_rate", "avg_search_latency_ms",
          "cancellation_rate", "refund_rate")


@register("ex03_arm_summary", ids=("EX-03",), r2=MONEY, r6=ARM_R6,
          sql=sql("SELECT * FROM x_summary", OX.POPULATION, OX.SUMMARY))
def q_arm_summary(c):
    return X.arm_summary(c.experiment["session"])


EFFECT_COLS = ("control_conversion", "variant_conversion", "absolute_conversion_uplift", "relative_conversion_uplift",
               "control_no_result_rate", "variant_no_result_rate", "no_result_rate_delta", "control_latency_ms",
               "variant_latency_ms", "latency_delta_ms", "control_cancellation_rate", "variant_cancellation_rate",
               "control_refund_rate", "variant_refund_rate")


@register("ex04_arm_effects", ids=("EX-04",), r6=EFFECT_COLS, sql=sql(f"""
SELECT c.session_booking_conversion AS control_conversion, v.session_booking_conversion AS variant_conversion,
       v.session_booking_conversion - c.session_booking_conversion AS absolute_conversion_uplift,
       {sd('v.session_booking_conversion - c.session_booking_conversion', 'c.session_booking_conversion')}
         AS relative_conversion_uplift,
       c.no_result_rate AS control_no_result_rate, v.no_result_rate AS variant_no_result_rate,
       v.no_result_rate - c.no_result_rate AS no_result_rate_delta,
       c.avg_search_latency_ms AS control_latency_ms, v.avg_search_latency_ms AS variant_latency_ms,
       v.avg_search_latency_ms - c.avg_search_latency_ms AS latency_delta_ms,
       c.cancellation_rate AS control_cancellation_rate, v.cancellation_rate AS variant_cancellation_rate,
       c.refund_rate AS control_refund_rate, v.refund_rate AS variant_refund_rate
FROM x_summary c, x_summary v WHERE c.experiment_variant = 'control' AND v.experiment_variant = 'variant'""",
    OX.POPULATION, OX.SUMMARY))
def q_arm_effects(c):
    return X.arm_effects(X.arm_summary(c.experiment["session"]))


@register("ex05_srm_stats", ids=("EX-05",), r6=("variant_share", "chi_square"), sql=sql(f"""
SELECT control_sessions, variant_sessions, {sd('variant_sessions', 'control_sessions + variant_sessions')} AS variant_share,
       CASE WHEN control_sessions + variant_sessions > 0 THEN
         (pow(control_sessions - (control_sessions + variant_sessions) / 2.0, 2)
          + pow(variant_sessions - (control_sessions + variant_sessions) / 2.0, 2))
         / ((control_sessions + variant_sessions) / 2.0) END AS chi_square
FROM (SELECT count(*) FILTER (WHERE {OX.ARM_C}) AS control_sessions,
             count(*) FILTER (WHERE {OX.ARM_V}) AS variant_sessions FROM x_session) AS t""", OX.POPULATION))
def q_srm_stats(c):
    return X.srm(c.experiment["session"], with_p=False)


@register("ex05_srm", ids=("EX-05",), r6=("variant_share", "chi_square", "p_value"),
          sql=sql("SELECT *, p_value < 0.001 AS srm_flag FROM x_srm", OX.POPULATION, OX.SRM))
def q_srm(c):
    return X.srm(c.experiment["session"])


@register("ex06_balance", ids=("EX-06",), r6=("control_share", "variant_share", "standardized_difference",
                                              "abs_standardized_difference"), sql=sql(f"""
SELECT covariate, level, control_share, variant_share,
       (variant_share - control_share) / sqrt(greatest(pooled * (1 - pooled), 1e-12)) AS standardized_difference,
       abs((variant_share - control_share) / sqrt(greatest(pooled * (1 - pooled), 1e-12))) AS abs_standardized_difference
FROM (SELECT covariate, level, {sd('cn', 'tc')} AS control_share, {sd('vn', 'tv')} AS variant_share,
             {sd('cn + vn', 'tc + tv')} AS pooled
      FROM (SELECT covariate, level, count(*) FILTER (WHERE {OX.ARM_C}) AS cn,
                   count(*) FILTER (WHERE {OX.ARM_V}) AS vn
            FROM (SELECT experiment_variant, 'device_type' AS covariate, CAST(device_type AS VARCHAR) AS level FROM x_session
                  UNION ALL SELECT experiment_variant, 'traveller_type', CAST(traveller_type AS VARCHAR) FROM x_session
                  UNION ALL SELECT experiment_variant, 'acquisition_channel', CAST(acquisition_channel AS VARCHAR) FROM x_session
                  UNION ALL SELECT experiment_variant, 'is_logged_in', CAST(is_logged_in AS VARCHAR) FROM x_session) AS l
            GROUP BY covariate, level) AS k
      CROSS JOIN (SELECT count(*) FILTER (WHERE {OX.ARM_C}) AS tc, count(*) FILTER (WHERE {OX.ARM_V}) AS tv
                  FROM x_session) AS t) AS s""", OX.POPULATION))
def q_balance(c):
    return X.balance_table(c.experiment["session"], ["device_type", "traveller_type", "acquisition_channel",
                                                     "is_logged_in"])


@register("ex08_primary_effect_stats", ids=("EX-07", "EX-08"), r6=TP6,
          sql=sql(OX.PRIMARY_FINAL, OX.POPULATION, OX.PRIMARY_COUNTS))
def q_primary_stats(c):
    return X.primary_effect(c.experiment["session"], with_p=False)


@register("ex08_primary_effect", ids=("EX-07", "EX-08"), r6=TP6 + ("p_value",),
          sql=sql(f"SELECT *, {OX.p_normal('z_stat')} AS p_value FROM ({OX.PRIMARY_FINAL}) AS p", OX.POPULATION, OX.PRIMARY_COUNTS))
def q_primary(c):
    return X.primary_effect(c.experiment["session"])


@register("ex09_preperiod_baseline", ids=("EX-09",), r6=("pre_partner_conversion",), sql=sql(f"""
SELECT partner_id, count(session_id) AS pre_sessions,
       {sd('sum(booked_flag)', 'count(session_id)')} AS pre_partner_conversion
FROM x_pre GROUP BY partner_id""", OX.POPULATION))
def q_baseline(c):
    return X.preperiod_baseline(c.experiment["preperiod"])


CUPED_R6 = ("theta", "control_adjusted_mean", "variant_adjusted_mean", "adjusted_effect", "standard_error", "ci_low",
            "ci_high", "t_stat", "variance_reduction")


@register("ex10_cuped_stats", ids=("EX-10",), r6=CUPED_R6, sql=sql(OX.CUPED_FINAL, OX.POPULATION, OX.CUPED))
def q_cuped_stats(c):
    return X.cuped_effect(c.cuped_data, with_p=False)


@register("ex10_cuped", ids=("EX-10",), r6=CUPED_R6 + ("p_value",),
          sql=sql(f"SELECT p.*, {OX.p_t('p.t_stat', OX.welch_df('a.vv', 'a.vn', 'a.cv', 'a.cn'))} AS p_value "
                  f"FROM ({OX.CUPED_FINAL}) AS p CROSS JOIN x_carm AS a", OX.POPULATION, OX.CUPED))
def q_cuped(c):
    return X.cuped_effect(c.cuped_data)


@register("ex11_cluster_adjusted", ids=("EX-11",),
          r6=("adjusted_effect", "standard_error", "ci_low", "ci_high", "p_value", "r_squared"), sql=sql(f"""
SELECT 'cluster-robust covariate-adjusted LPM' AS method, effect AS adjusted_effect, se AS standard_error, effect - {OX.Z} * se AS ci_low,
       effect + {OX.Z} * se AS ci_high, {OX.p_normal('effect / se')} AS p_value, g AS partner_clusters, n AS observations, r2 AS r_squared
FROM lm_fit""", OX.POPULATION, OX.CUPED, OM.CLUSTERED))
def q_cluster(c):
    return X.cluster_adjusted_effect(c.cuped_data)


@register("ex11_gram_entries", ids=("EX-11",), r6=("sum",), sql=sql("""
SELECT a.term AS i, b.term AS j, g.v AS sum FROM lm_g g JOIN lm_t a ON a.i = g.i JOIN lm_t b ON b.i = g.j
WHERE a.term <= b.term AND EXISTS (SELECT 1 FROM lm_x x JOIN lm_x z USING (session_id) WHERE x.i = g.i AND z.i = g.j)""",
    OX.POPULATION, OX.CUPED, OM.CLUSTERED))
def q_gram(c):
    """X'X of the covariate-adjusted model in long form."""
    d = c.cuped_data.withColumn("treatment", (F.col("experiment_variant") == "variant").cast("double"))
    return gram.gram(d, encoding.treatment_terms(["treatment", "pre_partner_conversion"], OM.COVARIATES,
                                                 encoding.reference_levels(d, OM.COVARIATES)))


@register("ex12_guardrails_stats", ids=("EX-12",), r6=TP6, sql=sql("SELECT * FROM x_guard", OX.POPULATION, OX.GUARD))
def q_guard_stats(c):
    e = c.experiment
    return X.guardrails(e["searches"], e["bookings"], with_p=False)


@register("ex12_guardrails", ids=("EX-12",), r6=TP6 + ("p_value",),
          sql=sql("SELECT *, p_value < 0.05 AS significant_at_0_05 FROM x_guard_p", OX.POPULATION, OX.GUARD, OX.GUARD_P))
def q_guard(c):
    e = c.experiment
    return X.guardrails(e["searches"], e["bookings"])


@register("ex13_segment_effects_stats", ids=("EX-13",), r6=TP6, sql=sql("""
SELECT dimension, segment, control_n, variant_n, control_rate, variant_rate, absolute_effect, relative_effect,
       standard_error, ci_low, ci_high, z_stat FROM x_seg""", OX.POPULATION, OX.SEGMENTS))
def q_segment_stats(c):
    return X.segment_effects(c.experiment["session"], c.views.partners, with_p=False)


@register("ex14_segment_effects_fdr", ids=("EX-13", "EX-14"), r6=TP6 + ("p_value", "p_value_fdr_bh"), sql=sql("""
SELECT dimension, segment, control_n, variant_n, control_rate, variant_rate, absolute_effect, relative_effect,
       standard_error, ci_low, ci_high, z_stat, p_value, p_value_fdr_bh, p_value_fdr_bh <= 0.05 AS significant_after_fdr
FROM x_bh""", OX.POPULATION, OX.SEGMENTS, OX.SEGMENTS_P))
def q_segment(c):
    return X.segment_effects(c.experiment["session"], c.views.partners)


@register("ex15_power_mde", ids=("EX-15",),
          r6=("allocation_ratio_variant_to_control", "control_baseline_rate", "observed_absolute_effect",
              "observed_standardized_effect_size", "observed_approximate_power", "minimum_detectable_absolute_effect"),
          sql=sql(f"""
SELECT CAST(0.05 AS DOUBLE) AS alpha, CAST(0.8 AS DOUBLE) AS target_power, control_n, variant_n,
       CAST(variant_n AS DOUBLE) / control_n AS allocation_ratio_variant_to_control, control_rate AS control_baseline_rate,
       absolute_effect AS observed_absolute_effect, h AS observed_standardized_effect_size,
       {OX.power_of('h', 'control_n', 'variant_n')} AS observed_approximate_power,
       abs(pow(sin(asin(sqrt(control_rate)) + mde / 2), 2) - control_rate) AS minimum_detectable_absolute_effect
FROM (SELECT *, abs(2 * asin(sqrt(variant_rate)) - 2 * asin(sqrt(control_rate))) AS h FROM x_primary) AS p
CROSS JOIN (SELECT (lo + hi) / 2 AS mde FROM x_bisect ORDER BY step DESC LIMIT 1) AS b""", OX.POPULATION, OX.PRIMARY_COUNTS,
    f"""x_bisect AS (
  WITH RECURSIVE b AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS lo, CAST(8 AS DOUBLE) AS hi, control_n, variant_n FROM x_primary
    UNION ALL
    SELECT step + 1, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END, control_n, variant_n
    FROM (SELECT *, {OX.power_of('mid', 'control_n', 'variant_n')} < 0.8 AS low
          FROM (SELECT *, (lo + hi) / 2 AS mid FROM b WHERE step < 50) AS m) AS n)
  SELECT * FROM b)"""))
def q_power(c):
    return X.power_mde(X.primary_effect(c.experiment["session"], with_p=False))


@register("ex16_business_impact", ids=("EX-16",),
          r6=("raw_absolute_conversion_effect", "estimated_incremental_booking_sessions",
              "control_avg_successful_value_per_booked_session", "estimated_incremental_successful_booking_value"),
          sql=sql(f"""
SELECT p.variant_n AS variant_sessions, p.absolute_effect AS raw_absolute_conversion_effect,
       a.avg_value AS control_avg_successful_value_per_booked_session,
       p.absolute_effect * p.variant_n AS estimated_incremental_booking_sessions,
       p.absolute_effect * p.variant_n * a.avg_value AS estimated_incremental_successful_booking_value,
       'Synthetic scenario estimate only.' AS interpretation
FROM x_primary p CROSS JOIN (
  SELECT {sd('round(sum(successful_booking_value), 2)', 'count(*)')} AS avg_value
  FROM x_session WHERE {OX.ARM_C} AND booked_flag = 1) AS a""", OX.POPULATION, OX.PRIMARY_COUNTS))
def q_impact(c):
    return X.business_impact(X.primary_effect(c.experiment["session"], with_p=False), c.experiment["session"])


@register("ex17_decision", ids=("EX-17",), r6=("primary_p_value", "srm_p_value"), sql=sql(f"""
SELECT primary_p_value, srm_p_value, srm_p_value < 0.001 AS srm_flag, adverse_guardrails,
       CASE WHEN srm_p_value < 0.001 THEN 'stop_srm' WHEN primary_p_value < 0.05 AND adverse_guardrails = 0 THEN 'positive'
            WHEN primary_p_value < 0.05 THEN 'review_guardrails' ELSE 'insufficient_evidence' END AS decision
FROM (SELECT {OX.p_normal('z_stat')} AS primary_p_value FROM x_primary) AS p
CROSS JOIN (SELECT p_value AS srm_p_value FROM x_srm) AS s
CROSS JOIN (SELECT count(*) FILTER (WHERE p_value < 0.05 AND absolute_effect > 0) AS adverse_guardrails FROM x_guard_p) AS g""",
    OX.POPULATION, OX.PRIMARY_COUNTS, OX.SRM, OX.GUARD, OX.GUARD_P))
def q_decision(c):
    e = c.experiment
    return X.decision(X.primary_effect(e["session"]), X.srm(e["session"]), X.guardrails(e["searches"], e["bookings"]))


@register("ex18_experiment_bundle", ids=("EX-18",), r6=TP6 + ("p_value",))
def q_bundle(c):
    e = c.experiment
    return X.experiment_bundle(X.primary_effect(e["session"]), X.srm(e["session"]),
                               X.guardrails(e["searches"], e["bookings"]))


_GUARD_FIELDS = ("metric", "metric_type", "control_rate", "variant_rate", "absolute_effect", "relative_effect", "standard_error", "ci_low",
                 "ci_high", "z_stat", "p_value", "significant_at_0_05")
_SRM_FIELDS = ("control_sessions", "variant_sessions", "variant_share", "chi_square", "p_value", "srm_flag")
_TEXT_FIELDS = ("metric", "metric_type", "significant_at_0_05", "srm_flag")


def _leaf_sql(path: str, field: str, src: str) -> str:
    text = field in _TEXT_FIELDS
    return (f"SELECT {path} AS path, {f'CAST({field} AS VARCHAR)' if text else 'CAST(NULL AS VARCHAR)'} AS text, "
            f"{'CAST(NULL AS DOUBLE)' if text else f'CAST({field} AS DOUBLE)'} AS number FROM {src}")


@register("ex18_bundle_paths", ids=("EX-18", "IN-05"), r6=("number",), sql=sql("\nUNION ALL ".join(
    [_leaf_sql(f"'$.sample_ratio_mismatch.{f}'", f, "x_srm_b") for f in _SRM_FIELDS]
    + [_leaf_sql(f"'$.guardrails[' || k || '].{f}'", f, "x_guard_b") for f in _GUARD_FIELDS]),
    OX.POPULATION, OX.SRM, OX.GUARD, OX.GUARD_P, """x_srm_b AS (SELECT *, p_value < 0.001 AS srm_flag FROM x_srm),
x_guard_b AS (SELECT *, p_value < 0.05 AS significant_at_0_05, row_number() OVER (ORDER BY metric) - 1 AS k FROM x_guard_p)"""))
def q_bundle_paths(c):
    """The nested bundle, read back from its JSON text and flattened to paths and values."""
    b = q_bundle(c).select("bundle_json", F.struct("sample_ratio_mismatch", "guardrails").alias("bundle"))
    return paths.path_values(paths.parsed(b, "bundle", "bundle_json"), [], "bundle")
