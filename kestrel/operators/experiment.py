"""Controlled-experiment statistics (EX-01..EX-18).

Pattern: aggregate the fact once to a few rows (per arm, per metric, per
segment x arm), pivot the arms side by side, then compute statistics as
column expressions over those rows.  The only Python on executors is the
p-value / power UDFs of ``kestrel.functions.special`` over those few rows;
the regression (EX-11) sums products of its sparse rows in long form (`gram`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import special
from kestrel.functions.core import money_sum, safe_div
from kestrel.functions.special import Z_975
from kestrel.operators import encoding, gram

ARMS = ("control", "variant")
ALPHA = 0.05
TARGET_POWER = 0.80
SRM_THRESHOLD = 0.001


#: Parts that a digest deals units to.
BUCKETS = 10_000


def digest_bucket(unit: str, salt: str, buckets: int = BUCKETS) -> Column:
    """A bucket from 0 on: the first 32 bits of sha256(salt:unit), as any system can compute it."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), F.col(unit).cast("string")).cast("binary"), 256), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % buckets).cast("bigint")


def assign_arms(units: DataFrame, unit: str, ts: str, start: str, end: str, experiment: str,
                method: str = "digest", salt: str | None = None, variant_share: float = 0.5) -> DataFrame:
    """EX-01: an arm inside the half-open window, ``not_eligible`` outside.

    ``digest`` deals by `digest_bucket` with the experiment's name as the salt unless one is given, so that arms of
    two experiments are independent, and gives the variant the buckets below its share; ``modulo`` is id % 2.
    A unit without an id is not eligible.
    """
    in_window = in_range(ts, start, end) & F.col(unit).isNotNull()
    if method == "digest":
        control = digest_bucket(unit, salt or experiment) >= int(round(variant_share * BUCKETS))
    else:
        control = F.col(unit) % 2 == 0
    arm = F.when(in_window, F.when(control, F.lit(ARMS[0])).otherwise(F.lit(ARMS[1]))).otherwise(F.lit("not_eligible"))
    name = F.when(in_window, F.lit(experiment)).otherwise(F.lit("not_eligible"))
    return units.withColumns({"experiment_name": name, "experiment_variant": arm})


def in_range(ts: str, start: str, end: str) -> Column:
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))


class Population(Mapping[str, DataFrame]):
    """The parts of a population by name; a part is made when it is first read."""

    def __init__(self, parts: dict[str, Callable[[], DataFrame]]):
        self._parts, self._made = parts, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._parts[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._parts)

    def __len__(self) -> int:
        return len(self._parts)


def select_population(session_fact: DataFrame, search_fact: DataFrame | Callable[[], DataFrame], bookings: DataFrame,
                      experiment: str, start: str, end: str, arm: str = "experiment_variant") -> Population:
    """EX-02: units by name + arm; items / outcomes by arm and their own ts (Q15); pre-period.

    Where ``search_fact`` is a function, it is called when the items are read: writing their fact is most of the work,
    and what is about units alone needs none of it.
    """
    arms = F.col(arm).isin(*ARMS)
    items = search_fact if callable(search_fact) else lambda: search_fact
    return Population({
        "session": lambda: session_fact.filter((F.col("experiment_name") == experiment) & arms),
        "searches": lambda: items().filter(arms & in_range("search_ts", start, end)),
        "bookings": lambda: bookings.filter(arms & in_range("booking_ts", start, end)),
        "preperiod": lambda: session_fact.filter(F.col("session_ts") < F.lit(start).cast("timestamp_ntz")),
    })


def arm_summary(exp: DataFrame, arm: str = "experiment_variant") -> DataFrame:
    """EX-03: counts, sums and six rates per arm."""
    return exp.groupBy(arm).agg(
        F.count("session_id").alias("sessions"),
        F.sum("booked_flag").alias("booking_sessions"),
        F.sum("search_count").alias("searches"),
        F.sum("booking_count").alias("bookings"),
        F.sum("zero_result_searches").alias("zero_result_searches"),
        F.sum("alternatives_shown_count").alias("alternatives_shown"),
        F.sum("total_search_latency_ms").alias("total_search_latency_ms"),
        F.sum("cancellations").alias("cancellations"),
        F.sum("refunds").alias("refunds"),
        money_sum("booking_value").alias("booking_value"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        money_sum("platform_revenue").alias("platform_revenue"),
    ).withColumns({
        "session_booking_conversion": safe_div("booking_sessions", "sessions"),
        "no_result_rate": safe_div("zero_result_searches", "searches"),
        "alternatives_exposure_rate": safe_div("alternatives_shown", "searches"),
        "avg_search_latency_ms": safe_div("total_search_latency_ms", "searches"),
        "cancellation_rate": safe_div("cancellations", "bookings"),
        "refund_rate": safe_div("refunds", "bookings"),
    })


def _side(df: DataFrame, arm: str, cols: Sequence[str]) -> DataFrame:
    """Pivot the 2-row arm table into one row: ``control_<c>``, ``variant_<c>``."""
    aggs = []
    for a in ARMS:
        for c in cols:
            aggs.append(F.max(F.when(F.col(arm) == a, F.col(c))).alias(f"{a}_{c}"))
    aggs.append(F.count_if(F.col(arm) == ARMS[0]).alias("__has_control"))
    aggs.append(F.count_if(F.col(arm) == ARMS[1]).alias("__has_variant"))
    return df.agg(*aggs)


def _require_arms(df: DataFrame) -> DataFrame:
    both = (F.col("__has_control") > 0) & (F.col("__has_variant") > 0)
    return df.withColumn("__ok", F.when(both, F.lit(True)).otherwise(
        F.raise_error(F.lit("Both experiment arms are required")))).filter("__ok").drop(
        "__ok", "__has_control", "__has_variant")


def arm_effects(summary: DataFrame, arm: str = "experiment_variant") -> DataFrame:
    """EX-04: arms side by side with uplifts; raises if an arm is missing."""
    rates = ["session_booking_conversion", "no_result_rate", "avg_search_latency_ms", "cancellation_rate",
             "refund_rate"]
    s = _require_arms(_side(summary, arm, rates))
    c, v = "control_", "variant_"
    return s.select(
        F.col(c + "session_booking_conversion").alias("control_conversion"),
        F.col(v + "session_booking_conversion").alias("variant_conversion"),
        (F.col(v + "session_booking_conversion") - F.col(c + "session_booking_conversion")).alias("absolute_conversion_uplift"),
        safe_div(F.col(v + "session_booking_conversion") - F.col(c + "session_booking_conversion"),
                 F.col(c + "session_booking_conversion")).alias("relative_conversion_uplift"),
        F.col(c + "no_result_rate").alias("control_no_result_rate"),
        F.col(v + "no_result_rate").alias("variant_no_result_rate"),
        (F.col(v + "no_result_rate") - F.col(c + "no_result_rate")).alias("no_result_rate_delta"),
        F.col(c + "avg_search_latency_ms").alias("control_latency_ms"),
        F.col(v + "avg_search_latency_ms").alias("variant_latency_ms"),
        (F.col(v + "avg_search_latency_ms") - F.col(c + "avg_search_latency_ms")).alias("latency_delta_ms"),
        F.col(c + "cancellation_rate").alias("control_cancellation_rate"),
        F.col(v + "cancellation_rate").alias("variant_cancellation_rate"),
        F.col(c + "refund_rate").alias("control_refund_rate"),
        F.col(v + "refund_rate").alias("variant_refund_rate"),
    )


def srm(exp: DataFrame, arm: str = "experiment_variant", with_p: bool = True) -> DataFrame:
    """EX-05: chi-square against an equal split; flag when p < 0.001."""
    counts = exp.agg(F.count_if(F.col(arm) == ARMS[0]).alias("control_sessions"),
                     F.count_if(F.col(arm) == ARMS[1]).alias("variant_sessions"))
    total = F.col("control_sessions") + F.col("variant_sessions")
    exp_n = total.cast("double") / 2
    chi = ((F.col("control_sessions") - exp_n) ** 2 + (F.col("variant_sessions") - exp_n) ** 2) / exp_n
    out = counts.withColumns({
        "variant_share": safe_div("variant_sessions", total),
        "chi_square": F.when(exp_n > 0, chi),
    })
    if with_p:
        out = out.withColumn("p_value", special.p_chi2_1(F.col("chi_square")))
        out = out.withColumn("srm_flag", F.col("p_value") < SRM_THRESHOLD)
    return out


def balance_table(exp: DataFrame, covariates: Sequence[str], arm: str = "experiment_variant") -> DataFrame:
    """EX-06: level shares per arm and standardised difference (pooled variance floor 1e-12)."""
    cols = [F.col(c).cast("string").alias(c) for c in covariates]
    long = exp.select(arm, *cols).unpivot([arm], list(covariates), "covariate", "level")
    counts = long.groupBy("covariate", "level").agg(
        F.count_if(F.col(arm) == ARMS[0]).alias("control_n"),
        F.count_if(F.col(arm) == ARMS[1]).alias("variant_n"))
    totals = exp.agg(F.count_if(F.col(arm) == ARMS[0]).alias("total_control"),
                     F.count_if(F.col(arm) == ARMS[1]).alias("total_variant"))
    t = counts.crossJoin(F.broadcast(totals))
    t = t.withColumns({
        "control_share": safe_div("control_n", "total_control"),
        "variant_share": safe_div("variant_n", "total_variant"),
        "__pooled": safe_div(F.col("control_n") + F.col("variant_n"), F.col("total_control") + F.col("total_variant")),
    })
    denom = F.sqrt(F.greatest(F.col("__pooled") * (1 - F.col("__pooled")), F.lit(1e-12)))
    t = t.withColumn("standardized_difference", (F.col("variant_share") - F.col("control_share")) / denom)
    return t.select("covariate", "level", "control_share", "variant_share", "standardized_difference",
                    F.abs("standardized_difference").alias("abs_standardized_difference"))


def two_prop_test(df: DataFrame, xt: str, nt: str, xc: str, nc: str, with_p: bool = True) -> DataFrame:
    """EX-07 as columns over any number of rows.

    Unpooled SE and normal CI; z statistic from the pooled variance (Q13).
    """
    p_t = safe_div(xt, nt)
    p_c = safe_div(xc, nc)
    out = df.withColumns({"control_rate": p_c, "variant_rate": p_t})
    out = out.withColumn("absolute_effect", F.col("variant_rate") - F.col("control_rate"))
    var_t = safe_div(F.col("variant_rate") * (1 - F.col("variant_rate")), F.col(nt))
    var_c = safe_div(F.col("control_rate") * (1 - F.col("control_rate")), F.col(nc))
    pooled = (F.col(xt) + F.col(xc)).cast("double") / (F.col(nt) + F.col(nc))
    se_pooled = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / F.col(nt) + F.lit(1.0) / F.col(nc)))
    out = out.withColumns({
        "relative_effect": safe_div("absolute_effect", "control_rate"),
        "standard_error": F.sqrt(var_t + var_c),
        "z_stat": F.when(se_pooled > 0, F.col("absolute_effect") / se_pooled),
    })
    out = out.withColumns({
        "ci_low": F.col("absolute_effect") - F.lit(Z_975) * F.col("standard_error"),
        "ci_high": F.col("absolute_effect") + F.lit(Z_975) * F.col("standard_error"),
    })
    if with_p:
        out = out.withColumn("p_value", special.p_normal(F.col("z_stat")))
    return out


def welch_columns(df: DataFrame, mean_t: str, var_t: str, n_t: str, mean_c: str, var_c: str, n_c: str,
                  with_p: bool = True) -> DataFrame:
    """Welch t statistic and df; CI from the normal, p from t (Q12)."""
    a = F.col(var_t) / F.col(n_t)
    b = F.col(var_c) / F.col(n_c)
    out = df.withColumns({
        "absolute_effect": F.col(mean_t) - F.col(mean_c),
        "standard_error": F.sqrt(a + b),
        # NULL when an arm has one unit or neither varies
        "__df": F.try_divide((a + b) ** 2, F.try_divide(a ** 2, F.col(n_t) - 1) + F.try_divide(b ** 2, F.col(n_c) - 1)),
    })
    out = out.withColumns({
        "ci_low": F.col("absolute_effect") - F.lit(Z_975) * F.col("standard_error"),
        "ci_high": F.col("absolute_effect") + F.lit(Z_975) * F.col("standard_error"),
        "t_stat": F.when(F.col("standard_error") > 0, F.col("absolute_effect") / F.col("standard_error")),
    })
    if with_p:
        out = out.withColumn("p_value", special.p_t(F.col("t_stat"), F.col("__df")))
    return out.drop("__df")


def primary_effect(exp: DataFrame, arm: str = "experiment_variant", with_p: bool = True) -> DataFrame:
    """EX-08: EX-07 on unit conversion."""
    per_arm = exp.groupBy(arm).agg(F.count("session_id").alias("n"), F.sum("booked_flag").alias("x"))
    s = _require_arms(_side(per_arm, arm, ["n", "x"]))
    out = two_prop_test(s, "variant_x", "variant_n", "control_x", "control_n", with_p)
    cols = ["control_rate", "variant_rate", "absolute_effect", "relative_effect", "standard_error", "ci_low",
            "ci_high", "z_stat"] + (["p_value"] if with_p else [])
    return out.select(*cols, F.lit("session_booking_conversion").alias("metric"), "control_n", "variant_n",
                      F.col("control_x").alias("control_successes"), F.col("variant_x").alias("variant_successes"))


def preperiod_baseline(pre: DataFrame, entity: str = "partner_id") -> DataFrame:
    """EX-09: per-entity pre-period units and conversion."""
    return pre.groupBy(entity).agg(F.count("session_id").alias("pre_sessions"),
                                   F.sum("booked_flag").alias("pre_booking_sessions")).withColumn(
        "pre_partner_conversion", safe_div("pre_booking_sessions", "pre_sessions")).select(
        entity, "pre_sessions", "pre_partner_conversion")


def cuped_frame(exp: DataFrame, pre: DataFrame, entity: str = "partner_id") -> DataFrame:
    """EX-10 input: units with the entity pre-period rate (global pre rate when absent, Q14)."""
    glob = pre.agg(safe_div(F.sum("booked_flag"), F.count(F.lit(1))).alias("__global_pre"))
    d = exp.join(preperiod_baseline(pre, entity), entity, "left").crossJoin(F.broadcast(glob))
    return d.withColumns({
        "pre_partner_conversion": F.coalesce(F.col("pre_partner_conversion"), F.col("__global_pre")),
        "pre_sessions": F.coalesce(F.col("pre_sessions"), F.lit(0)),
    }).drop("__global_pre")


def cuped_effect(data: DataFrame, arm: str = "experiment_variant", with_p: bool = True) -> DataFrame:
    """EX-10: theta = cov(y, x) / var(x) on pooled arms, Welch on the adjusted outcome."""
    x, y = F.col("pre_partner_conversion").cast("double"), F.col("booked_flag").cast("double")
    th = data.agg(F.var_samp(x).alias("__vx"), F.covar_samp(y, x).alias("__cxy"), F.avg(x).alias("__mx"),
                  F.var_samp(y).alias("__vy"))
    th = th.withColumn("theta", F.when(F.col("__vx") > 0, F.col("__cxy") / F.col("__vx")).otherwise(F.lit(0.0)))
    adj = data.crossJoin(F.broadcast(th)).withColumn(
        "cuped_outcome", y - F.col("theta") * (x - F.col("__mx")))
    per_arm = adj.groupBy(arm).agg(F.avg("cuped_outcome").alias("m"), F.var_samp("cuped_outcome").alias("v"),
                                   F.count(F.lit(1)).alias("n"))
    s = _require_arms(_side(per_arm, arm, ["m", "v", "n"]))
    tot = adj.agg(F.var_samp("cuped_outcome").alias("__vc"), F.first("theta").alias("theta"),
                  F.first("__vy").alias("__vy"))
    out = welch_columns(s.crossJoin(tot), "variant_m", "variant_v", "variant_n", "control_m", "control_v",
                        "control_n", with_p)
    vr = F.when(F.col("__vy") > 0, F.lit(1.0) - safe_div("__vc", "__vy")).otherwise(F.lit(0.0))
    cols = [F.lit("session_booking_conversion").alias("metric"),
            F.lit("CUPED-style partner pre-period adjustment").alias("method"), "theta",
            F.col("control_m").alias("control_adjusted_mean"), F.col("variant_m").alias("variant_adjusted_mean"),
            F.col("absolute_effect").alias("adjusted_effect"), "standard_error", "ci_low", "ci_high", "t_stat"]
    if with_p:
        cols.append("p_value")
    return out.select(*cols, vr.alias("variance_reduction"))


def cluster_adjusted_effect(data: DataFrame, arm: str = "experiment_variant", cluster: str = "partner_id",
                            categorical: Sequence[str] = ("device_type", "traveller_type", "acquisition_channel",
                                                          "is_logged_in")) -> DataFrame:
    """EX-11: treatment effect from the covariate-adjusted LPM with clustered SEs.

    Levels of covariates that the treatment and the others determine are left out.
    """
    d = data.withColumn("treatment", (F.col(arm) == ARMS[1]).cast("double"))
    x = encoding.treatment_terms(["treatment", "pre_partner_conversion"], categorical, encoding.reference_levels(d, categorical))
    fit = gram.cluster_robust_ols(d, x, F.col("booked_flag"), F.col(cluster), first=("Intercept", "treatment", "pre_partner_conversion"))
    i = fit["names"].index("treatment")
    b, se = float(fit["beta"][i]), float(fit["se"][i])
    p = float(special.two_sided_normal_p(b / se)) if se > 0 else None
    row = [("cluster-robust covariate-adjusted LPM", b, se, b - Z_975 * se, b + Z_975 * se, p, fit["G"], fit["n"],
            float(fit["r_squared"]))]
    return data.sparkSession.createDataFrame(
        row, "method string, adjusted_effect double, standard_error double, ci_low double, ci_high double, "
             "p_value double, partner_clusters bigint, observations bigint, r_squared double")


def guardrails(searches: DataFrame, bookings: DataFrame, arm: str = "experiment_variant",
               with_p: bool = True) -> DataFrame:
    """EX-12: no-result (proportion), latency (Welch), cancellation and refund (proportion)."""
    s = searches.groupBy(arm).agg(F.count(F.lit(1)).alias("n"), F.sum("no_result_flag").alias("x"),
                                  F.avg(F.col("search_latency_ms").cast("double")).alias("m"),
                                  F.var_samp(F.col("search_latency_ms").cast("double")).alias("v"))
    ss = _require_arms(_side(s, arm, ["n", "x", "m", "v"]))
    nr = two_prop_test(ss, "variant_x", "variant_n", "control_x", "control_n", with_p).withColumns(
        {"metric": F.lit("no_result_rate"), "metric_type": F.lit("binary")})
    lat = welch_columns(ss, "variant_m", "variant_v", "variant_n", "control_m", "control_v", "control_n", with_p)
    lat = lat.withColumns({
        "metric": F.lit("search_latency_ms"), "metric_type": F.lit("continuous"),
        "control_rate": F.col("control_m"), "variant_rate": F.col("variant_m"),
        "relative_effect": safe_div("absolute_effect", "control_m"), "z_stat": F.col("t_stat")})
    b = bookings.groupBy(arm).agg(F.count(F.lit(1)).alias("n"), F.sum("cancelled_flag").alias("xc"),
                                  F.sum("refund_flag").alias("xr"))
    bb = _side(b, arm, ["n", "xc", "xr"])
    bb = bb.filter((F.col("__has_control") > 0) & (F.col("__has_variant") > 0))  # skip if an arm has none
    canc = two_prop_test(bb, "variant_xc", "variant_n", "control_xc", "control_n", with_p).withColumns(
        {"metric": F.lit("cancellation_rate"), "metric_type": F.lit("binary")})
    refd = two_prop_test(bb, "variant_xr", "variant_n", "control_xr", "control_n", with_p).withColumns(
        {"metric": F.lit("refund_rate"), "metric_type": F.lit("binary")})
    cols = ["metric", "metric_type", "control_rate", "variant_rate", "absolute_effect", "relative_effect",
            "standard_error", "ci_low", "ci_high", "z_stat"] + (["p_value"] if with_p else [])
    out = nr.select(*cols).unionByName(lat.select(*cols)).unionByName(canc.select(*cols)).unionByName(refd.select(*cols))
    if with_p:
        out = out.withColumn("significant_at_0_05", F.col("p_value") < ALPHA)
    return out


SEGMENT_DIMENSIONS = ["device_type", "traveller_type", "partner_type", "integration_type", "contract_tier"]


def segment_counts(exp: DataFrame, partners: DataFrame, dimensions: Sequence[str] = SEGMENT_DIMENSIONS,
                   min_n: int = 50, arm: str = "experiment_variant") -> DataFrame:
    """EX-13 input: (dimension, segment) x arm counts, kept when both arms have >= min_n (Q16)."""
    attrs = [d for d in dimensions if d not in exp.columns]
    d = exp.join(partners.select("partner_id", *attrs), "partner_id", "left") if attrs else exp
    cols = [F.col(c).cast("string").alias(c) for c in dimensions]
    # units are counted once per combination of levels; only those counts are unpivoted
    d = d.select(arm, "booked_flag", *cols).groupBy(arm, *dimensions).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("booked_flag").alias("__x"))
    long = d.unpivot([arm, "__n", "__x"], list(dimensions), "dimension", "segment").filter(F.col("segment").isNotNull())

    def of(column: str, side: int) -> Column:
        return F.sum(F.when(F.col(arm) == ARMS[side], F.col(column)).otherwise(0))
    c = long.groupBy("dimension", "segment").agg(
        of("__n", 0).alias("control_n"), of("__n", 1).alias("variant_n"),
        of("__x", 0).alias("control_x"), of("__x", 1).alias("variant_x"))
    return c.filter((F.col("control_n") >= min_n) & (F.col("variant_n") >= min_n))


def bh_adjust(df: DataFrame, p: str = "p_value", alpha: float = ALPHA, family: Sequence[str] = ()) -> DataFrame:
    """EX-14: Benjamini-Hochberg adjusted p and reject flag.

    adjusted_i = min(1, min_{j >= i} p_(j) * m / j) as a reverse running
    minimum window.  ``family`` partitions independent families; without it
    the whole frame is one family (segment tables are small).
    """
    fam = list(family)
    w_all = Window.partitionBy(*fam) if fam else Window.partitionBy()
    w_rank = (Window.partitionBy(*fam) if fam else Window).orderBy(F.col(p).asc())
    d = df.withColumns({"__m": F.count(F.lit(1)).over(w_all), "__i": F.row_number().over(w_rank)})
    d = d.withColumn("__raw", F.col(p) * F.col("__m") / F.col("__i"))
    w_tail = w_rank.rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumn("p_value_fdr_bh", F.least(F.min("__raw").over(w_tail), F.lit(1.0)))
    return d.withColumn("significant_after_fdr", F.col("p_value_fdr_bh") <= alpha).drop("__m", "__i", "__raw")


def segment_effects(exp: DataFrame, partners: DataFrame, with_p: bool = True, min_n: int = 50) -> DataFrame:
    """EX-13 + EX-14: heterogeneous effects with FDR control over the survivors."""
    c = segment_counts(exp, partners, min_n=min_n)
    out = two_prop_test(c, "variant_x", "variant_n", "control_x", "control_n", with_p)
    cols = ["dimension", "segment", "control_n", "variant_n", "control_rate", "variant_rate", "absolute_effect",
            "relative_effect", "standard_error", "ci_low", "ci_high", "z_stat"] + (["p_value"] if with_p else [])
    out = out.select(*cols)
    return bh_adjust(out) if with_p else out


def power_mde(primary: DataFrame, alpha: float = ALPHA, target_power: float = TARGET_POWER) -> DataFrame:
    """EX-15: observed power and MDE for two proportions, per row (any number of rows)."""
    h = F.abs(F.lit(2.0) * F.asin(F.sqrt("variant_rate")) - F.lit(2.0) * F.asin(F.sqrt("control_rate")))
    ratio = safe_div("variant_n", "control_n")
    d = primary.withColumns({"observed_standardized_effect_size": h,
                             "allocation_ratio_variant_to_control": ratio})
    d = d.withColumns({
        "observed_approximate_power": special.power(F.col("observed_standardized_effect_size"), F.col("control_n"),
                                                    F.col("control_n") * F.col("allocation_ratio_variant_to_control"), alpha),
        "__h": special.mde_effect_size(F.col("control_n"), F.col("control_n") * F.col("allocation_ratio_variant_to_control"),
                                       alpha, target_power),
    })
    p2 = F.pow(F.sin(F.asin(F.sqrt("control_rate")) + F.col("__h") / 2), 2)
    return d.select(F.lit(alpha).alias("alpha"), F.lit(target_power).alias("target_power"), "control_n", "variant_n",
                    "allocation_ratio_variant_to_control", F.col("control_rate").alias("control_baseline_rate"),
                    F.col("absolute_effect").alias("observed_absolute_effect"), "observed_standardized_effect_size",
                    "observed_approximate_power",
                    F.abs(p2 - F.col("control_rate")).alias("minimum_detectable_absolute_effect"))


def business_impact(primary: DataFrame, exp: DataFrame, arm: str = "experiment_variant") -> DataFrame:
    """EX-16: effect x variant units x mean successful value of booked control units."""
    ctrl = exp.filter((F.col(arm) == ARMS[0]) & (F.col("booked_flag") == 1)).agg(
        safe_div(money_sum("successful_booking_value"), F.count(F.lit(1))).alias(
            "control_avg_successful_value_per_booked_session"))
    d = primary.select(F.col("variant_n").alias("variant_sessions"),
                       F.col("absolute_effect").alias("raw_absolute_conversion_effect")).crossJoin(ctrl)
    d = d.withColumn("estimated_incremental_booking_sessions",
                     F.col("raw_absolute_conversion_effect") * F.col("variant_sessions"))
    return d.withColumns({
        "estimated_incremental_successful_booking_value":
            F.col("estimated_incremental_booking_sessions") * F.col("control_avg_successful_value_per_booked_session"),
        "interpretation": F.lit("Synthetic scenario estimate only."),
    })


ADVERSE_METRICS = ["no_result_rate", "search_latency_ms", "cancellation_rate", "refund_rate"]


def decision(primary: DataFrame, srm_df: DataFrame, guard: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """EX-17: SRM -> stop; significant and no adverse guardrail -> positive; etc."""
    adverse = guard.agg(F.count_if(F.col("significant_at_0_05") & (F.col("absolute_effect") > 0)
                                   & F.col("metric").isin(*ADVERSE_METRICS)).alias("adverse_guardrails"))
    d = primary.select(F.col("p_value").alias("primary_p_value")).crossJoin(
        srm_df.select(F.col("p_value").alias("srm_p_value"), "srm_flag")).crossJoin(adverse)
    return d.withColumn("decision", F.when(F.col("srm_flag"), F.lit("stop_srm"))
                        .when((F.col("primary_p_value") < alpha) & (F.col("adverse_guardrails") == 0), F.lit("positive"))
                        .when(F.col("primary_p_value") < alpha, F.lit("review_guardrails"))
                        .otherwise(F.lit("insufficient_evidence")))


def experiment_bundle(primary: DataFrame, srm_df: DataFrame, guard: DataFrame) -> DataFrame:
    """EX-18: primary row + SRM struct + ordered guardrail array, as one nested row."""
    g = guard.agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in guard.columns]))).alias("guardrails"))
    s = srm_df.select(F.struct(*srm_df.columns).alias("sample_ratio_mismatch"))
    return primary.crossJoin(s).crossJoin(g).withColumn(
        "bundle_json", F.to_json(F.struct("sample_ratio_mismatch", "guardrails")))
