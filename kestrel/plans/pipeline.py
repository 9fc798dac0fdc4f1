"""Staged mart build: the marts of each stage written as tables (IN-03/04).

usage: python -m kestrel.plans.pipeline --data DIR --out DIR [--stages 2,3,4,5,6,7] [--csv]

Stage 2 runs the integrity gate first (IN-11) and fails the build on any
violation outside ``allow``.  The facts watch their joins while they are written.
Every mart is published as a new version of its table by one job, which also
observes the contract that its columns' names imply (rates and p values in [0, 1],
ordered intervals, finite scores); a mart that breaks it, or whose ranks or grain repeat,
is not published and its last version stays what readers see (`sources.versions`).
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators import anomaly as A
from kestrel.operators import experiment as X
from kestrel.operators import gates, growth, metrics, model_bundle, network, quality
from kestrel.plans.context import Context
from kestrel.sources import sinks, versions


def _checks(c: Context) -> DataFrame:
    from kestrel.plans.queries_marts import q_check_table
    return q_check_table(c)


def stage_marts(c: Context) -> dict[int, dict[str, Callable[[], DataFrame]]]:
    e = lambda: c.experiment
    return {
        2: {
            "stg_partners": lambda: c.views.partners, "stg_stations": lambda: c.views.stations,
            "fct_search_journey": lambda: c.search_fact, "fct_session_journey": lambda: c.session_fact,
            "mart_daily_product_metrics": lambda: c.daily,
            "mart_weekly_product_metrics": lambda: metrics.weekly_metrics(c.session_fact),
            "mart_partner_activation": lambda: c.activation, "mart_partner_performance": lambda: c.performance,
            "mart_partner_weekly": lambda: c.weekly, "mart_partner_retention": lambda: c.retention,
            "mart_experiment_summary": lambda: X.arm_summary(e()["session"]),
            "mart_experiment_effects": lambda: X.arm_effects(X.arm_summary(e()["session"])),
            "mart_route_performance": lambda: c.routes,
            "mart_kpi_summary": lambda: metrics.kpi_summary(c.session_fact, c.activation),
        },
        3: {
            "mart_stage3_funnel": lambda: metrics.funnel(c.search_fact),
            "mart_stage3_activation_segments": lambda: growth.activation_segments(c.activation),
            "mart_stage3_product_segments": lambda: metrics.product_segments(c.session_fact),
            "mart_stage3_partner_growth": lambda: c.growth,
            "mart_stage3_partner_opportunities": lambda: c.opportunities,
            "mart_stage3_retention_summary": lambda: metrics.retention_summary(c.retention),
        },
        4: {
            "mart_stage4_srm": lambda: X.srm(e()["session"]),
            "mart_stage4_balance": lambda: X.balance_table(
                e()["session"], ["device_type", "traveller_type", "acquisition_channel", "is_logged_in"]),
            "mart_stage4_primary_effect": lambda: X.primary_effect(e()["session"]),
            "mart_stage4_cuped_effect": lambda: X.cuped_effect(c.cuped_data),
            "mart_stage4_cluster_adjusted_effect": lambda: X.cluster_adjusted_effect(c.cuped_data),
            "mart_stage4_guardrails": lambda: X.guardrails(e()["searches"], e()["bookings"]),
            "mart_stage4_segment_effects": lambda: X.segment_effects(e()["session"], c.views.partners),
            "mart_stage4_business_impact": lambda: X.business_impact(X.primary_effect(e()["session"]), e()["session"]),
        },
        5: {
            "mart_stage5_station_network": lambda: network.station_network(
                c.views.stations, c.net_routes, c.centrality, c.net_strength, c.net_degree),
            "mart_stage5_route_opportunities": lambda: c.central_route_opportunities,
            "mart_stage5_city_market_opportunities": lambda: network.city_markets(c.central_route_opportunities),
            "mart_stage5_partner_route_opportunities": lambda: network.partner_route_opportunities(
                c.search_fact, c.central_route_opportunities),
        },
        6: {
            "mart_stage6_model_validation": lambda: _ml(c, "ml13_model_comparison"),
            "mart_stage6_locked_test_metrics": lambda: _ml(c, "ml14_locked_threshold_metrics"),
            "mart_stage6_probit_coefficients": lambda: _ml(c, "ml09_probit_coefficients"),
            "mart_stage6_probit_test_metrics": lambda: _ml(c, "ml14_probit_test_metrics"),
            "mart_stage6_calibration": lambda: _ml(c, "ml16_champion_calibration"),
            "mart_stage6_logistic_coefficients": lambda: _ml(c, "ml18_logistic_coefficients"),
            "mart_stage6_forest_importance": lambda: _ml(c, "ml18_forest_importance"),
            "mart_stage6_model_registry": lambda: _ml(c, "ml23_model_registry"),
            "mart_stage6_test_scores": lambda: _ml(c, "ml14_test_scores"),
            "mart_stage6_feature_importance": lambda: _ml(c, "ml17_permutation_importance"),
            "mart_stage6_partner_clusters": lambda: _ml(c, "ml20_partner_clusters"),
            "mart_stage6_cluster_profile": lambda: _ml(c, "ml21_cluster_profile"),
        },
        7: {
            "mart_stage7_daily_anomalies": lambda: c.anomalies,
            "mart_stage7_investigation_cases": lambda: A.case_register(c.anomalies, c.driver, c.lookup),
            "stage7_evidence_packets": lambda: A.evidence_packets(
                c.anomalies, c.driver, A.top_partners(c.anomalies, c.session_fact),
                A.top_routes(c.anomalies, c.search_fact), c.lookup),
        },
    }


def _ml(c: Context, name: str) -> DataFrame:
    from kestrel.plans.registry import load_all
    return load_all()[name].build(c)


#: Columns, or sets of columns, that no two rows of a mart may share.
UNIQUE = {
    "fct_search_journey": [["search_id"]], "fct_session_journey": [["session_id"]], "stg_partners": [["partner_id"]],
    "mart_stage3_partner_opportunities": [["priority_rank"]], "mart_stage5_station_network": [["station_opportunity_rank"]],
    "mart_stage5_route_opportunities": [["opportunity_rank"]], "mart_stage5_city_market_opportunities": [["market_rank"]],
    "mart_stage5_partner_route_opportunities": [["partner_route_rank"]], "mart_stage6_feature_importance": [["importance_rank"]],
    "mart_stage7_daily_anomalies": [["case_id"]],
}


def publish_mart(spark: SparkSession, out: str, name: str, df: DataFrame) -> str:
    """One mart as the next version of its table; the folder of the version."""
    flat = [c for c in df.columns if not df.schema[c].dataType.simpleString().startswith(("struct", "array", "map"))]
    return gates.publish(spark, f"{out.rstrip('/')}/{name}", lambda gate: gate.contract(df, name, gates.conventions(flat)),
                         UNIQUE.get(name, ())).path


def run(spark: SparkSession, data: str, out: str, stages=(2, 3, 4, 5, 6, 7), csv: bool = False,
        allow=()) -> dict[str, str]:
    """Build the stages; the folder that each mart's current version is in (of packets: the JSON folder)."""
    c = Context.shared(spark, data)
    if 2 in stages:
        quality.assert_checks(_checks(c), allow=allow)
    written = {}
    marts = stage_marts(c)
    for st in stages:
        for name, build in marts[st].items():
            df = build()
            if name.endswith("packets"):
                written[name] = versions.publish(spark, f"{out.rstrip('/')}/{name}", lambda folder, df=df: {} if sinks.write_json(df, folder) else {}).path
                continue
            written[name] = publish_mart(spark, out, name, df)
            if csv:
                sinks.write_csv(spark.read.parquet(written[name]), f"{out.rstrip('/')}/{name}_csv")
    if 6 in stages:
        from kestrel.plans.queries_ml import SPLITS, trained
        t = trained(c)
        written["champion_model"] = model_bundle.save(spark, f"{out.rstrip('/')}/champion_model", t["fitted"][t["champion"]],
                                                      t["champion"], t["threshold"], SPLITS).path
    return written


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--stages", default="2,3,4,5,6,7")
    ap.add_argument("--csv", action="store_true")
    a = ap.parse_args()
    from kestrel.session import get_spark
    spark = get_spark()
    for name, path in run(spark, a.data, a.out, tuple(int(s) for s in a.stages.split(",")), a.csv).items():
        print(name, path)


if __name__ == "__main__":
    main()
