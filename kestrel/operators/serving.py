"""Serving views over the marts (SV-01..SV-08).

Top-N views are ``orderBy(rank).limit(n)``, planned as a
TakeOrderedAndProject (each task keeps its own top n; the driver merges
at most n x tasks rows).  The limit is the feature here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTNER_COLUMNS = ["priority_rank", "partner_id", "partner_type", "country", "integration_type", "contract_tier",
                   "sessions", "searches", "session_booking_conversion", "no_result_rate", "conversion_change_pp",
                   "successful_value_growth_rate", "opportunity_type", "opportunity_score"]
ROUTE_COLUMNS = ["opportunity_rank", "origin_city", "destination_city", "origin_country", "destination_country",
                 "searches", "bookings", "search_to_book_conversion", "no_result_rate", "distance_km",
                 "opportunity_type", "underserved_opportunity_score"]
STATION_COLUMNS = ["station_opportunity_rank", "station_name", "city", "country", "network_degree",
                   "pagerank_search_demand", "betweenness_centrality", "outbound_conversion",
                   "outbound_no_result_rate", "station_opportunity_score"]
def severity_rank():
    return F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "high", 2).otherwise(3)


def _check_limit(n: int, hi: int = 100) -> int:
    if not 1 <= n <= hi:
        raise ValueError(f"limit must be in 1..{hi}")
    return n


def top_partners(opportunities: DataFrame, n: int = 20) -> DataFrame:
    """SV-01."""
    return opportunities.select(*PARTNER_COLUMNS).orderBy("priority_rank").limit(_check_limit(n))


def top_routes(route_opps: DataFrame, n: int = 20) -> DataFrame:
    """SV-02."""
    return route_opps.select(*ROUTE_COLUMNS).orderBy("opportunity_rank").limit(_check_limit(n))


def top_anomalies(anomalies: DataFrame, n: int = 20) -> DataFrame:
    """SV-03: largest absolute robust z first (case id breaks ties)."""
    return anomalies.orderBy(F.abs("robust_z").desc(), F.col("case_id")).limit(_check_limit(n))


def case_queue(cases: DataFrame) -> DataFrame:
    """SV-04: severity order, newest first."""
    # cases are few (bounded by metrics x days): a global ordering is fine
    return cases.withColumn("queue_position", F.row_number().over(
        Window.orderBy(severity_rank(), F.col("metric_date").desc(), F.col("case_id"))).cast("bigint"))


def top_stations(stations: DataFrame, n: int = 30) -> DataFrame:
    """SV-05."""
    return stations.select(*STATION_COLUMNS).orderBy("station_opportunity_rank").limit(n)


def ordered(df: DataFrame, *order, n: int | None = None) -> DataFrame:
    """SV-06: a small mart in display order, optionally limited."""
    out = df.orderBy(*order)
    return out.limit(n) if n else out


def activation_bars(segments: DataFrame, dimension: str) -> DataFrame:
    """SV-07: one dimension of the activation segments, sorted by rate."""
    return segments.filter(F.col("dimension") == dimension).orderBy(F.col("activation_30d_rate"),
                                                                    F.col("segment_value"))


def top_pick(df: DataFrame, rank_col: str, cols) -> DataFrame:
    """SV-08: the rank-1 row (a filter, no sort)."""
    return df.filter(F.col(rank_col) == 1).select(*cols)
