"""Registered queries: route network and geospatial scoring (NW-01..NW-15).

Scoring operators take centrality as an input.  The ``*_scores`` queries
feed them the weighted strengths, the full pipeline queries PageRank to
convergence and exact betweenness.
"""

from __future__ import annotations

from kestrel.operators import network as N
from kestrel.plans import oracle_network as ON
from kestrel.plans.queries_core import MONEY, sql
from kestrel.plans.registry import register

ROUTE_R6 = ("avg_search_latency_ms", "search_to_book_conversion", "no_result_rate", "distance_km",
            "origin_latitude", "origin_longitude", "origin_hub_weight", "destination_latitude",
            "destination_longitude", "destination_hub_weight")
OPP_R6 = ROUTE_R6 + ("origin_pagerank", "destination_pagerank", "origin_betweenness", "destination_betweenness",
                     "underserved_opportunity_score")
STATION_R6 = ("latitude", "longitude", "hub_weight", "pagerank_search_demand", "betweenness_centrality",
              "inbound_search_strength", "outbound_search_strength", "outbound_conversion", "outbound_no_result_rate",
              "station_opportunity_score")


@register("nw01_haversine", ids=("NW-01",), r6=("distance_km",), sql=sql(
    "SELECT origin_station_id, destination_station_id, distance_km FROM n_routes", ON.ENRICHED))
def q_haversine(c):
    return c.net_routes.select("origin_station_id", "destination_station_id", "distance_km")


@register("nw02_route_enrichment", ids=("NW-02",), r2=MONEY, r6=ROUTE_R6, sql=sql("SELECT * FROM n_routes", ON.ENRICHED))
def q_enrich(c):
    return c.net_routes


@register("nw03_graph_edges", ids=("NW-03",), r6=("conversion", "inverse_demand_cost", "conversion_cost"),
          sql=sql("SELECT * FROM n_edges", ON.ENRICHED))
def q_edges(c):
    return c.net_edges


@register("nw04_pagerank_20_rounds", ids=("NW-04",), r6=("pagerank_search_demand",), sql=sql(
    "SELECT id AS station_id, rank AS pagerank_search_demand FROM pr_20", ON.ENRICHED, ON.pagerank_ctes(20)))
def q_pagerank20(c):
    return N.pagerank(c.views.stations, c.net_edges, max_iter=20, tol=None)


@register("nw04_pagerank", ids=("NW-04",), r6=("pagerank_search_demand",), sql=sql(
    "SELECT id AS station_id, rank AS pagerank_search_demand FROM pr_final", ON.ENRICHED, ON.converged_ctes(40)))
def q_pagerank(c):
    return N.pagerank(c.views.stations, c.net_edges)


@register("nw05_strengths", ids=("NW-05",), sql=sql("SELECT * FROM n_strength", ON.ENRICHED))
def q_strength(c):
    return c.net_strength


@register("nw06_undirected_edges", ids=("NW-06",), r6=("inverse_demand_cost",),
          sql=sql("SELECT * FROM n_und", ON.ENRICHED))
def q_und(c):
    return c.net_undirected


@register("nw06_degree", ids=("NW-06",), sql=sql("SELECT * FROM n_degree", ON.ENRICHED))
def q_degree(c):
    return c.net_degree


@register("nw07_betweenness", ids=("NW-07",), r6=("betweenness_centrality",),
          # shortest paths of the 25 stations have at most 24 edges
          sql=sql(ON.BETWEENNESS_FINAL, ON.ENRICHED, ON.betweenness_ctes(24)))
def q_betweenness(c):
    return N.betweenness(c.views.stations, c.net_undirected)


def _stations(c, centrality):
    return N.station_network(c.views.stations, c.net_routes, centrality, c.net_strength, c.net_degree)


@register("nw09_station_scores", ids=("NW-08", "NW-09"), r2=("outbound_successful_booking_value",), r6=STATION_R6,
          sql=sql("SELECT * FROM n_stations", ON.ENRICHED, ON.STATIONS_SCORED))
def q_station_scores(c):
    return _stations(c, c.strength_centrality)


@register("nw08_station_network", ids=("NW-08", "NW-09"), r2=("outbound_successful_booking_value",), r6=STATION_R6,
          sql=sql("SELECT * FROM n_stations", ON.CENTRAL, ON.STATIONS_SCORED))
def q_station_network(c):
    return _stations(c, c.centrality)


@register("nw11_route_scores", ids=("NW-10", "NW-11"), r2=MONEY, r6=OPP_R6,
          sql=sql("SELECT * FROM n_route_opps", ON.ENRICHED, ON.ROUTES_SCORED))
def q_route_scores(c):
    return c.route_opportunities


@register("nw10_route_opportunities", ids=("NW-10", "NW-11"), r2=MONEY, r6=OPP_R6,
          sql=sql("SELECT * FROM n_route_opps", ON.CENTRAL, ON.ROUTES_SCORED))
def q_route_opps(c):
    return c.central_route_opportunities


CITY_R6 = ("average_no_result_rate", "average_route_score", "conversion", "market_opportunity_score")


@register("nw12_city_market_scores", ids=("NW-12",), r2=("successful_booking_value",), r6=CITY_R6,
          sql=sql("SELECT * FROM n_cities", ON.ENRICHED, ON.ROUTES_SCORED, ON.CITIES))
def q_city_scores(c):
    return N.city_markets(c.route_opportunities)


PR_R6 = ("conversion", "underserved_opportunity_score", "partner_route_opportunity_score")


@register("nw13_partner_route_scores", ids=("NW-13",), r2=("successful_booking_value",), r6=PR_R6,
          sql=sql("SELECT * FROM n_partner_routes", ON.ENRICHED, ON.ROUTES_SCORED, ON.PARTNER_ROUTES))
def q_partner_route_scores(c):
    return N.partner_route_opportunities(c.search_fact, c.route_opportunities)


@register("nw14_network_findings", ids=("NW-14",), r6=("top_station_pagerank", "top_station_betweenness"),
          sql=sql("""
SELECT s.station_id AS top_station_id, s.pagerank_search_demand AS top_station_pagerank,
       s.betweenness_centrality AS top_station_betweenness, r.origin_station_id AS top_route_origin,
       r.destination_station_id AS top_route_destination, r.opportunity_type AS top_route_type,
       ci.origin_city AS top_city, p.partner_id AS top_partner_route_partner,
       (SELECT count(*) FROM n_stations) AS stations, (SELECT count(*) FROM n_route_opps) AS routes,
       (SELECT count(*) FROM n_cities) AS cities
FROM (SELECT * FROM n_stations WHERE station_opportunity_rank = 1) s
CROSS JOIN (SELECT * FROM n_route_opps WHERE opportunity_rank = 1) r
CROSS JOIN (SELECT * FROM n_cities WHERE market_rank = 1) ci
CROSS JOIN (SELECT arg_min(partner_id, partner_route_rank) AS partner_id FROM n_partner_routes) p""",
              ON.ENRICHED, ON.STATIONS_SCORED, ON.ROUTES_SCORED, ON.CITIES, ON.PARTNER_ROUTES))
def q_net_findings(c):
    items = c.search_fact       # first: the route mart reads it where it is written
    ro = c.route_opportunities
    return N.network_findings(_stations(c, c.strength_centrality), ro, N.city_markets(ro), N.partner_route_opportunities(items, ro))


@register("nw15_endpoint_count", ids=("NW-15",), sql=sql("""
SELECT count(DISTINCT origin_station_id) + count(DISTINCT destination_station_id) AS route_endpoints
FROM o_routes""", ON.ENRICHED))
def q_endpoints(c):
    return N.endpoint_count(c.routes)
