"""DuckDB CTEs for the experiment stage; tail probabilities by Simpson's rule over a list of steps."""

from kestrel.plans.oracle_marts import sd

Z = "1.959963984540054"
ARM_C = "experiment_variant = 'control'"
ARM_V = "experiment_variant = 'variant'"

POPULATION = """x_session AS (
  SELECT * FROM fct_session WHERE experiment_name = 'checkout_test' AND experiment_variant IN ('control', 'variant')),
x_searches AS (
  SELECT * FROM fct_search WHERE experiment_variant IN ('control', 'variant')
    AND search_ts >= TIMESTAMP '1998-01-01 00:00:00' AND search_ts < TIMESTAMP '1999-01-01 00:00:00'),
x_bookings AS (
  SELECT * FROM v_bookings WHERE experiment_variant IN ('control', 'variant')
    AND booking_ts >= TIMESTAMP '1998-01-01 00:00:00' AND booking_ts < TIMESTAMP '1999-01-01 00:00:00'),
x_pre AS (SELECT * FROM fct_session WHERE session_ts < TIMESTAMP '1998-01-01 00:00:00')"""


def _integral(upper: str, density: str, steps: int = 2000) -> str:
    """Integral from 0 to ``upper`` (at least 0) of a density that writes @ for its variable."""
    at = density.replace("@", f"(__i * ({upper}) / {steps})")
    return (f"(({upper}) / {3 * steps} * list_sum([(CASE WHEN __i = 0 OR __i = {steps} THEN 1 WHEN __i % 2 = 1 THEN 4 ELSE 2 END) "
            f"* {at} for __i in range({steps + 1})]))")


def normal_cdf(x: str) -> str:
    return f"(CAST(0.5 AS DOUBLE) + sign({x}) * {_integral(f'abs({x})', 'exp(-0.5 * @ * @)')} / sqrt(2 * pi()))"


def p_normal(z: str) -> str:
    """Two-sided p of a standard normal statistic."""
    return f"(2 * (1 - {normal_cdf(f'abs({z})')}))"


def p_t(t: str, df: str) -> str:
    """Two-sided p of Student's t."""
    area = _integral(f"abs({t})", f"pow(1 + @ * @ / ({df}), -(({df}) + 1) / 2)")
    return f"(1 - 2 * exp(lgamma((({df}) + 1) / 2) - lgamma(({df}) / 2)) / sqrt(({df}) * pi()) * {area})"


def welch_df(vt: str, nt: str, vc: str, nc: str) -> str:
    a, b = f"({vt} / {nt})", f"({vc} / {nc})"
    return f"(pow({a} + {b}, 2) / (pow({a}, 2) / ({nt} - 1) + pow({b}, 2) / ({nc} - 1)))"


def two_prop(xt: str, nt: str, xc: str, nc: str, src: str, keep: str = "*") -> str:
    """SELECT over ``src`` adding the EX-07 columns (no p-value)."""
    inner = (f"SELECT {keep}, {sd(xc, nc)} AS control_rate, {sd(xt, nt)} AS variant_rate, "
             f"CAST({xt} + {xc} AS DOUBLE) / ({nt} + {nc}) AS __pool, {nt} AS __nt, {nc} AS __nc FROM {src}")
    mid = ("SELECT *, variant_rate - control_rate AS absolute_effect, "
           f"sqrt({sd('variant_rate * (1 - variant_rate)', '__nt')} + {sd('control_rate * (1 - control_rate)', '__nc')})"
           " AS standard_error, sqrt(__pool * (1 - __pool) * (CAST(1 AS DOUBLE) / __nt + CAST(1 AS DOUBLE) / __nc)) AS __sep"
           f" FROM ({inner}) AS i")
    return ("SELECT * EXCLUDE (__pool, __nt, __nc, __sep), "
            f"{sd('absolute_effect', 'control_rate')} AS relative_effect, "
            f"absolute_effect - {Z} * standard_error AS ci_low, absolute_effect + {Z} * standard_error AS ci_high, "
            "CASE WHEN __sep > 0 THEN absolute_effect / __sep END AS z_stat"
            f" FROM ({mid}) AS m")


SUMMARY = f"""x_summary AS (
  SELECT experiment_variant, count(session_id) AS sessions, CAST(sum(booked_flag) AS BIGINT) AS booking_sessions,
         CAST(sum(search_count) AS BIGINT) AS searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
         CAST(sum(zero_result_searches) AS BIGINT) AS zero_result_searches,
         CAST(sum(alternatives_shown_count) AS BIGINT) AS alternatives_shown,
         CAST(sum(total_search_latency_ms) AS BIGINT) AS total_search_latency_ms,
         CAST(sum(cancellations) AS BIGINT) AS cancellations, CAST(sum(refunds) AS BIGINT) AS refunds,
         round(sum(booking_value), 2) AS booking_value, round(sum(successful_booking_value), 2) AS successful_booking_value,
         round(sum(platform_revenue), 2) AS platform_revenue,
         {sd('sum(booked_flag)', 'count(session_id)')} AS session_booking_conversion,
         {sd('sum(zero_result_searches)', 'sum(search_count)')} AS no_result_rate,
         {sd('sum(alternatives_shown_count)', 'sum(search_count)')} AS alternatives_exposure_rate,
         {sd('sum(total_search_latency_ms)', 'sum(search_count)')} AS avg_search_latency_ms,
         {sd('sum(cancellations)', 'sum(booking_count)')} AS cancellation_rate,
         {sd('sum(refunds)', 'sum(booking_count)')} AS refund_rate
  FROM x_session GROUP BY experiment_variant)"""

PRIMARY_COUNTS = f"""x_pa AS (
  SELECT count(*) FILTER (WHERE {ARM_C}) AS control_n, count(*) FILTER (WHERE {ARM_V}) AS variant_n,
         CAST(sum(booked_flag) FILTER (WHERE {ARM_C}) AS BIGINT) AS control_x,
         CAST(sum(booked_flag) FILTER (WHERE {ARM_V}) AS BIGINT) AS variant_x
  FROM x_session),
x_primary AS (""" + two_prop("variant_x", "variant_n", "control_x", "control_n", "x_pa") + ")"

PRIMARY_FINAL = """SELECT control_rate, variant_rate, absolute_effect, relative_effect, standard_error, ci_low, ci_high,
       z_stat, 'session_booking_conversion' AS metric, control_n, variant_n, control_x AS control_successes,
       variant_x AS variant_successes FROM x_primary"""

CUPED = f"""x_base AS (
  SELECT partner_id, count(session_id) AS pre_sessions,
         {sd('sum(booked_flag)', 'count(session_id)')} AS pre_partner_conversion
  FROM x_pre GROUP BY partner_id),
x_glob AS (SELECT {sd('sum(booked_flag)', 'count(*)')} AS g FROM x_pre),
x_cd AS (
  SELECT s.*, coalesce(b.pre_partner_conversion, x_glob.g) AS pre_partner_conversion,
         coalesce(b.pre_sessions, 0) AS pre_sessions
  FROM x_session s LEFT JOIN x_base b ON s.partner_id = b.partner_id CROSS JOIN x_glob),
x_th AS (
  SELECT var_samp(pre_partner_conversion) AS vx,
         covar_samp(CAST(booked_flag AS DOUBLE), pre_partner_conversion) AS cxy,
         avg(pre_partner_conversion) AS mx, var_samp(CAST(booked_flag AS DOUBLE)) AS vy
  FROM x_cd),
x_adj AS (
  SELECT d.experiment_variant,
         CAST(d.booked_flag AS DOUBLE) - (CASE WHEN vx > 0 THEN cxy / vx ELSE 0 END) * (d.pre_partner_conversion - mx)
           AS cuped
  FROM x_cd d CROSS JOIN x_th),
x_carm AS (
  SELECT avg(cuped) FILTER (WHERE {ARM_C}) AS cm, var_samp(cuped) FILTER (WHERE {ARM_C}) AS cv,
         count(*) FILTER (WHERE {ARM_C}) AS cn, avg(cuped) FILTER (WHERE {ARM_V}) AS vm,
         var_samp(cuped) FILTER (WHERE {ARM_V}) AS vv, count(*) FILTER (WHERE {ARM_V}) AS vn,
         var_samp(cuped) AS vc
  FROM x_adj)"""

CUPED_FINAL = f"""SELECT 'session_booking_conversion' AS metric, 'CUPED-style partner pre-period adjustment' AS method,
       CASE WHEN vx > 0 THEN cxy / vx ELSE 0 END AS theta, cm AS control_adjusted_mean, vm AS variant_adjusted_mean,
       vm - cm AS adjusted_effect, sqrt(vv / vn + cv / cn) AS standard_error,
       vm - cm - {Z} * sqrt(vv / vn + cv / cn) AS ci_low, vm - cm + {Z} * sqrt(vv / vn + cv / cn) AS ci_high,
       CASE WHEN sqrt(vv / vn + cv / cn) > 0 THEN (vm - cm) / sqrt(vv / vn + cv / cn) END AS t_stat,
       CASE WHEN vy > 0 THEN 1 - {sd('vc', 'vy')} ELSE 0 END AS variance_reduction
FROM x_carm CROSS JOIN x_th"""

GUARD = f"""x_gs AS (
  SELECT count(*) FILTER (WHERE {ARM_C}) AS control_n, count(*) FILTER (WHERE {ARM_V}) AS variant_n,
         CAST(sum(no_result_flag) FILTER (WHERE {ARM_C}) AS BIGINT) AS control_x,
         CAST(sum(no_result_flag) FILTER (WHERE {ARM_V}) AS BIGINT) AS variant_x,
         avg(CAST(search_latency_ms AS DOUBLE)) FILTER (WHERE {ARM_C}) AS control_m,
         avg(CAST(search_latency_ms AS DOUBLE)) FILTER (WHERE {ARM_V}) AS variant_m,
         var_samp(CAST(search_latency_ms AS DOUBLE)) FILTER (WHERE {ARM_C}) AS control_v,
         var_samp(CAST(search_latency_ms AS DOUBLE)) FILTER (WHERE {ARM_V}) AS variant_v
  FROM x_searches),
x_gb AS (
  SELECT count(*) FILTER (WHERE {ARM_C}) AS control_n, count(*) FILTER (WHERE {ARM_V}) AS variant_n,
         CAST(sum(cancelled_flag) FILTER (WHERE {ARM_C}) AS BIGINT) AS control_xc,
         CAST(sum(cancelled_flag) FILTER (WHERE {ARM_V}) AS BIGINT) AS variant_xc,
         CAST(sum(refund_flag) FILTER (WHERE {ARM_C}) AS BIGINT) AS control_xr,
         CAST(sum(refund_flag) FILTER (WHERE {ARM_V}) AS BIGINT) AS variant_xr
  FROM x_bookings),
x_gb2 AS (SELECT * FROM x_gb WHERE control_n > 0 AND variant_n > 0),
x_guard AS (
  SELECT 'no_result_rate' AS metric, 'binary' AS metric_type, control_rate, variant_rate, absolute_effect,
         relative_effect, standard_error, ci_low, ci_high, z_stat
  FROM ({two_prop('variant_x', 'variant_n', 'control_x', 'control_n', 'x_gs')}) AS a
  UNION ALL
  SELECT 'search_latency_ms', 'continuous', control_m, variant_m, variant_m - control_m,
         {sd('variant_m - control_m', 'control_m')}, sqrt(variant_v / variant_n + control_v / control_n),
         variant_m - control_m - {Z} * sqrt(variant_v / variant_n + control_v / control_n),
         variant_m - control_m + {Z} * sqrt(variant_v / variant_n + control_v / control_n),
         CASE WHEN sqrt(variant_v / variant_n + control_v / control_n) > 0
              THEN (variant_m - control_m) / sqrt(variant_v / variant_n + control_v / control_n) END
  FROM x_gs
  UNION ALL
  SELECT 'cancellation_rate', 'binary', control_rate, variant_rate, absolute_effect, relative_effect,
         standard_error, ci_low, ci_high, z_stat
  FROM ({two_prop('variant_xc', 'variant_n', 'control_xc', 'control_n', 'x_gb2')}) AS b
  UNION ALL
  SELECT 'refund_rate', 'binary', control_rate, variant_rate, absolute_effect, relative_effect,
         standard_error, ci_low, ci_high, z_stat
  FROM ({two_prop('variant_xr', 'variant_n', 'control_xr', 'control_n', 'x_gb2')}) AS c)"""


def _seg_long(dims):
    return "\n  UNION ALL ".join(
        f"SELECT experiment_variant, booked_flag, '{d}' AS dimension, CAST({d} AS VARCHAR) AS segment FROM x_sp"
        for d in dims)


SEGMENTS = f"""x_sp AS (
  SELECT s.*, p.partner_type, p.integration_type, p.contract_tier
  FROM x_session s LEFT JOIN v_partners p ON s.partner_id = p.partner_id),
x_sl AS (
  {_seg_long(['device_type', 'traveller_type', 'partner_type', 'integration_type', 'contract_tier'])}),
x_sc AS (
  SELECT dimension, segment, count(*) FILTER (WHERE {ARM_C}) AS control_n,
         count(*) FILTER (WHERE {ARM_V}) AS variant_n,
         CAST(coalesce(sum(CASE WHEN {ARM_C} THEN booked_flag ELSE 0 END), 0) AS BIGINT) AS control_x,
         CAST(coalesce(sum(CASE WHEN {ARM_V} THEN booked_flag ELSE 0 END), 0) AS BIGINT) AS variant_x
  FROM x_sl WHERE segment IS NOT NULL GROUP BY dimension, segment),
x_seg AS (
  {two_prop('variant_x', 'variant_n', 'control_x', 'control_n',
            '(SELECT * FROM x_sc WHERE control_n >= 50 AND variant_n >= 50) AS f')})"""


GUARD_P = f"""x_guard_p AS (
  SELECT g.*, CASE WHEN g.metric_type = 'binary' THEN {p_normal('g.z_stat')}
                   ELSE {p_t('g.z_stat', welch_df('s.variant_v', 's.variant_n', 's.control_v', 's.control_n'))} END AS p_value
  FROM x_guard g CROSS JOIN x_gs s)"""

SRM = f"""x_srm AS (
  SELECT *, {p_normal('sqrt(chi_square)')} AS p_value FROM (
    SELECT control_sessions, variant_sessions, {sd('variant_sessions', 'control_sessions + variant_sessions')} AS variant_share,
           CASE WHEN control_sessions + variant_sessions > 0 THEN
             (pow(control_sessions - (control_sessions + variant_sessions) / 2.0, 2)
              + pow(variant_sessions - (control_sessions + variant_sessions) / 2.0, 2))
             / ((control_sessions + variant_sessions) / 2.0) END AS chi_square
    FROM (SELECT count(*) FILTER (WHERE {ARM_C}) AS control_sessions,
                 count(*) FILTER (WHERE {ARM_V}) AS variant_sessions FROM x_session) AS t) AS u)"""

SEGMENTS_P = f"""x_seg_p AS (SELECT *, {p_normal('z_stat')} AS p_value FROM x_seg),
x_bh AS (
  SELECT *, least(min(p_value * m / i) OVER (ORDER BY p_value, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1) AS p_value_fdr_bh
  FROM (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p_value) AS i FROM x_seg_p) AS r)"""


def power_of(h: str, n1: str, n2: str) -> str:
    """Two-sided power of a two-sample normal test."""
    shift = f"(({h}) / sqrt(CAST(1 AS DOUBLE) / ({n1}) + CAST(1 AS DOUBLE) / ({n2})))"
    return f"(1 - {normal_cdf(f'({Z} - {shift})')} + {normal_cdf(f'(-{Z} - {shift})')})"
