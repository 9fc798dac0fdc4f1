"""Registered queries: serving views (SV-01..SV-08) and the JSON sink form (IN-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import anomaly as A
from kestrel.operators import experiment as X
from kestrel.operators import growth, metrics, network
from kestrel.operators import serving as S
from kestrel.plans import oracle_experiment as OX
from kestrel.plans import oracle_marts as M
from kestrel.plans import oracle_network as ON
from kestrel.plans.queries_anomaly import ANOMS, DRIVER, _OWNER
from kestrel.plans.queries_core import sql
from kestrel.plans.queries_experiment import TP6
from kestrel.plans.queries_marts import DAILY, RET_R6
from kestrel.plans.queries_ml import PROFILE_R6, VAL_R6, q_profile, trained
from kestrel.plans.registry import register
from kestrel.sources import sinks


@register("sv01_top_partner_opportunities", ids=("SV-01",),
          r6=("session_booking_conversion", "no_result_rate", "conversion_change_pp", "successful_value_growth_rate",
              "opportunity_score"),
          sql=sql(f"SELECT {', '.join(S.PARTNER_COLUMNS)} FROM o_opps ORDER BY priority_rank LIMIT 20",
                  M.PERFORMANCE, M.WEEKLY, M.GROWTH, M.OPPORTUNITIES))
def q_sv01(c):
    return S.top_partners(c.opportunities, 20)


@register("sv02_top_route_opportunities", ids=("SV-02",),
          r6=("search_to_book_conversion", "no_result_rate", "distance_km", "underserved_opportunity_score"),
          sql=sql(f"SELECT {', '.join(S.ROUTE_COLUMNS)} FROM n_route_opps ORDER BY opportunity_rank LIMIT 20",
                  ON.ENRICHED, ON.ROUTES_SCORED))
def q_sv02(c):
    return S.top_routes(c.route_opportunities, 20)


@register("sv03_top_anomalies", ids=("SV-03",),
          r6=("observed_value", "baseline_median", "absolute_delta", "relative_delta", "robust_z"),
          sql=sql("SELECT * FROM a_anoms ORDER BY abs(robust_z) DESC, case_id LIMIT 20", DAILY, ANOMS))
def q_sv03(c):
    return S.top_anomalies(c.anomalies, 20)


@register("sv04_case_queue", ids=("SV-04",), r6=("robust_z", "observed_value", "baseline_median"), sql=sql(f"""
SELECT *, row_number() OVER (ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END,
                                      metric_date DESC, case_id) AS queue_position
FROM (SELECT a.case_id, a.metric_date, a.metric, a.severity, a.robust_z, a.observed_value, a.baseline_median,
             d.dimension AS primary_driver_dimension, d.segment AS primary_driver_segment,
             {_OWNER.replace('CASE metric', 'CASE a.metric')} AS recommended_owner, true AS human_review_required
      FROM a_anoms a LEFT JOIN a_driver d ON a.case_id = d.case_id) AS r""", DAILY, DRIVER))
def q_sv04(c):
    return S.case_queue(A.case_register(c.anomalies, c.driver, c.lookup))


@register("sv05_top_stations", ids=("SV-05",),
          r6=("pagerank_search_demand", "betweenness_centrality", "outbound_conversion", "outbound_no_result_rate",
              "station_opportunity_score"),
          sql=sql(f"SELECT {', '.join(S.STATION_COLUMNS)} FROM n_stations ORDER BY station_opportunity_rank LIMIT 30",
                  ON.ENRICHED, ON.STATIONS_SCORED))
def q_sv05(c):
    return S.top_stations(network.station_network(c.views.stations, c.net_routes, c.strength_centrality,
                                                  c.net_strength, c.net_degree), 30)


@register("sv06_funnel_ordered", ids=("SV-06",),
          r6=("conversion_from_previous", "conversion_from_search", "dropoff_from_previous"),
          sql=sql("SELECT * FROM o_funnel ORDER BY stage_order", M.FUNNEL))
def q_sv06(c):
    return S.ordered(metrics.funnel(c.search_fact), "stage_order")


@register("sv06_daily_by_date", ids=("SV-06",),
          r2=("booking_value", "successful_booking_value", "platform_revenue"),
          r6=("session_booking_conversion", "search_to_book_conversion", "no_result_rate", "result_selection_rate",
              "alternatives_exposure_rate", "avg_search_latency_ms", "cancellation_rate", "refund_rate",
              "successful_booking_value_per_active_partner"),
          sql=sql("SELECT * FROM o_daily ORDER BY metric_date", DAILY))
def q_sv06_daily(c):
    return S.ordered(c.daily, "metric_date")


@register("sv06_top_feature_importance", ids=("SV-06",), r6=("importance_mean_pr_auc", "importance_std"))
def q_sv06_importance(c):
    from kestrel.operators.propensity import permutation_importance
    t = trained(c)
    imp = permutation_importance(t["fitted"][t["champion"]], t["splits"]["validation"])
    return S.ordered(imp, "importance_rank", n=15)


@register("sv06_retention_by_cohort", ids=("SV-06",), r6=RET_R6,
          sql=sql("SELECT * FROM o_ret_summary ORDER BY cohort_month", M.RETENTION, M.RETENTION_SUMMARY))
def q_sv06_retention(c):
    return S.ordered(metrics.retention_summary(c.retention), "cohort_month")


@register("sv06_guardrails_by_metric", ids=("SV-06",), r6=TP6,
          sql=sql("SELECT * FROM x_guard ORDER BY metric", OX.POPULATION, OX.GUARD))
def q_sv06_guardrails(c):
    e = c.experiment
    return S.ordered(X.guardrails(e["searches"], e["bookings"], with_p=False), "metric")


@register("sv06_validation_by_pr_auc", ids=("SV-06",), r6=VAL_R6)
def q_sv06_validation(c):
    return S.ordered(trained(c)["comparison"], F.desc("pr_auc"), "model")


@register("sv06_clusters_by_id", ids=("SV-06",), r6=PROFILE_R6)
def q_sv06_clusters(c):
    return S.ordered(q_profile(c), "cluster_id")


@register("sv07_activation_bars", ids=("SV-07",),
          r6=("integration_completion_rate", "first_search_rate", "first_booking_rate", "activation_30d_rate",
              "median_days_to_first_booking"),
          sql=sql("SELECT * FROM o_act_segments WHERE dimension = 'integration_type' "
                  "ORDER BY activation_30d_rate, segment_value",
                  M.MILESTONES, M.PIVOT, M.ACTIVATION, M.ACT_SEGMENTS))
def q_sv07(c):
    return S.activation_bars(growth.activation_segments(c.activation), "integration_type")


@register("sv08_top_picks", ids=("SV-08",), sql=sql("""
SELECT r.origin_city AS top_route_origin_city, r.destination_city AS top_route_destination_city,
       p.partner_id AS top_partner_id, p.opportunity_type AS top_partner_type
FROM (SELECT * FROM n_route_opps WHERE opportunity_rank = 1) r
CROSS JOIN (SELECT * FROM o_opps WHERE priority_rank = 1) p""",
    ON.ENRICHED, ON.ROUTES_SCORED, M.PERFORMANCE, M.WEEKLY, M.GROWTH, M.OPPORTUNITIES))
def q_sv08(c):
    from pyspark.sql import functions as F
    r = S.top_pick(c.route_opportunities, "opportunity_rank",
                   [F.col("origin_city").alias("top_route_origin_city"),
                    F.col("destination_city").alias("top_route_destination_city")])
    p = S.top_pick(c.opportunities, "priority_rank", [F.col("partner_id").alias("top_partner_id"),
                                                      F.col("opportunity_type").alias("top_partner_type")])
    return r.crossJoin(F.broadcast(p))      # one row: a product of partitions would be a task for each pair of them


@register("in05_json_records", ids=("IN-05",))
def q_json(c):
    return sinks.records_json(c.anomalies)
