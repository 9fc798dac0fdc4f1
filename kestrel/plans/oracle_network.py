"""DuckDB CTEs for the network stage (strength-fed scoring, unrolled PageRank)."""

from kestrel.plans.oracle_marts import ROUTES, sd, weighted, zscores

STATION_COLS = ["station_name", "city", "country", "latitude", "longitude", "hub_weight"]


def _haversine(lat1, lon1, lat2, lon2):
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"CAST(2 * 6371.0088 AS DOUBLE) * asin(sqrt(least(CAST(1 AS DOUBLE), {a})))"


ENRICHED = ROUTES + f""",
n_routes AS (
  SELECT r.*, {', '.join(f'o.{c} AS origin_{c}' for c in STATION_COLS)},
         {', '.join(f'd.{c} AS destination_{c}' for c in STATION_COLS)},
         {_haversine('o.latitude', 'o.longitude', 'd.latitude', 'd.longitude')} AS distance_km,
         CAST(o.country <> d.country AS BIGINT) AS international_flag
  FROM o_routes r
  LEFT JOIN v_stations o ON r.origin_station_id = o.station_id
  LEFT JOIN v_stations d ON r.destination_station_id = d.station_id
  WHERE r.origin_station_id <> r.destination_station_id),
n_edges AS (
  SELECT origin_station_id AS src, destination_station_id AS dst, CAST(searches AS DOUBLE) AS weight,
         CAST(bookings AS DOUBLE) AS bookings, search_to_book_conversion AS conversion,
         CAST(1 AS DOUBLE) / greatest(CAST(searches AS DOUBLE), CAST(1 AS DOUBLE)) AS inverse_demand_cost,
         CAST(1 AS DOUBLE) / greatest(search_to_book_conversion, 1e-6) AS conversion_cost
  FROM n_routes),
n_strength AS (
  SELECT s.station_id, coalesce(i.w, CAST(0 AS DOUBLE)) AS inbound_search_strength,
         coalesce(o.w, CAST(0 AS DOUBLE)) AS outbound_search_strength
  FROM v_stations s
  LEFT JOIN (SELECT dst, sum(weight) AS w FROM n_edges GROUP BY dst) i ON s.station_id = i.dst
  LEFT JOIN (SELECT src, sum(weight) AS w FROM n_edges GROUP BY src) o ON s.station_id = o.src),
n_und AS (
  SELECT least(src, dst) AS u, greatest(src, dst) AS v, arg_max(inverse_demand_cost, src) AS inverse_demand_cost,
         arg_max(weight, src) AS weight
  FROM n_edges GROUP BY 1, 2),
n_degree AS (
  SELECT s.station_id, coalesce(k.d, 0) AS network_degree
  FROM v_stations s LEFT JOIN (SELECT x AS station_id, count(*) AS d FROM (
      SELECT u AS x FROM n_und UNION ALL SELECT v FROM n_und) AS e GROUP BY x) k ON s.station_id = k.station_id),
n_cent AS (
  SELECT station_id, inbound_search_strength AS pagerank_search_demand,
         outbound_search_strength AS betweenness_centrality FROM n_strength)"""


def pagerank_ctes(iters: int, alpha: float = 0.85) -> str:
    a = f"CAST({alpha} AS DOUBLE)"
    parts = [
        "pr_nodes AS (SELECT DISTINCT station_id AS id FROM v_stations)",
        "pr_n AS (SELECT count(*) AS n FROM pr_nodes)",
        "pr_out AS (SELECT src, sum(weight) AS w FROM n_edges GROUP BY src)",
        "pr_t AS (SELECT e.src, e.dst, e.weight / o.w AS p FROM n_edges e JOIN pr_out o ON e.src = o.src)",
        "pr_base AS (SELECT id, id NOT IN (SELECT src FROM pr_out WHERE w > 0) AS dangling FROM pr_nodes)",
        "pr_0 AS MATERIALIZED (SELECT b.id, b.dangling, CAST(1 AS DOUBLE) / pr_n.n AS rank FROM pr_base b CROSS JOIN pr_n)",
    ]
    for i in range(1, iters + 1):
        parts.append(
            f"pr_{i} AS MATERIALIZED (SELECT b.id, b.dangling, {a} * (coalesce(c.c, CAST(0 AS DOUBLE)) + d.dm / pr_n.n)"
            f" + (CAST(1 AS DOUBLE) - {a}) / pr_n.n AS rank FROM pr_base b"
            f" LEFT JOIN (SELECT t.dst, sum(r.rank * t.p) AS c FROM pr_{i - 1} r JOIN pr_t t ON r.id = t.src"
            f" GROUP BY t.dst) c ON b.id = c.dst"
            f" CROSS JOIN (SELECT coalesce(sum(CASE WHEN dangling THEN rank END), CAST(0 AS DOUBLE)) AS dm"
            f" FROM pr_{i - 1}) d CROSS JOIN pr_n)")
    return ",\n".join(parts)


STATIONS_SCORED = f"""n_roll AS (
  SELECT origin_station_id AS station_id, CAST(sum(searches) AS BIGINT) AS outbound_route_searches,
         CAST(sum(bookings) AS BIGINT) AS outbound_bookings,
         CAST(sum(zero_result_searches) AS BIGINT) AS outbound_no_result_searches,
         round(sum(successful_booking_value), 2) AS outbound_successful_booking_value
  FROM n_routes GROUP BY origin_station_id),
n_st0 AS (
  SELECT s.*, coalesce(c.pagerank_search_demand, CAST(0 AS DOUBLE)) AS pagerank_search_demand,
         coalesce(c.betweenness_centrality, CAST(0 AS DOUBLE)) AS betweenness_centrality,
         coalesce(g.network_degree, 0) AS network_degree, st.inbound_search_strength, st.outbound_search_strength,
         coalesce(r.outbound_route_searches, 0) AS outbound_route_searches,
         coalesce(r.outbound_bookings, 0) AS outbound_bookings,
         coalesce(r.outbound_no_result_searches, 0) AS outbound_no_result_searches,
         coalesce(r.outbound_successful_booking_value, CAST(0 AS DOUBLE)) AS outbound_successful_booking_value
  FROM v_stations s LEFT JOIN n_cent c ON s.station_id = c.station_id
  LEFT JOIN n_degree g ON s.station_id = g.station_id LEFT JOIN n_strength st ON s.station_id = st.station_id
  LEFT JOIN n_roll r ON s.station_id = r.station_id),
n_st1 AS (
  SELECT *, {sd('outbound_bookings', 'outbound_route_searches')} AS outbound_conversion,
         {sd('outbound_no_result_searches', 'outbound_route_searches')} AS outbound_no_result_rate
  FROM n_st0),
n_st2 AS (SELECT n_st1.*, m.med FROM n_st1 CROSS JOIN (SELECT quantile_cont(outbound_conversion, 0.5) AS med FROM n_st1) m),
{zscores('n_st2', ['ln(1 + outbound_route_searches)', 'pagerank_search_demand', 'betweenness_centrality',
                   'outbound_no_result_rate', 'greatest(med - outbound_conversion, 0)'], 'n_sz')},
n_stations AS (
  SELECT * EXCLUDE (med, c0, c1, c2, c3, c4, z0, z1, z2, z3, z4, station_opportunity_score0),
         row_number() OVER (ORDER BY station_opportunity_score0 DESC, station_id) AS station_opportunity_rank,
         station_opportunity_score0 AS station_opportunity_score
  FROM (SELECT *, {weighted([0.30, 0.20, 0.20, 0.18, 0.12])} AS station_opportunity_score0 FROM n_sz_z) AS q)"""

ROUTES_SCORED = f"""n_ro0 AS (
  SELECT r.*, o.pagerank_search_demand AS origin_pagerank, o.betweenness_centrality AS origin_betweenness,
         d.pagerank_search_demand AS destination_pagerank, d.betweenness_centrality AS destination_betweenness
  FROM n_routes r LEFT JOIN n_cent o ON r.origin_station_id = o.station_id
  LEFT JOIN n_cent d ON r.destination_station_id = d.station_id),
n_ro1 AS (
  SELECT n_ro0.*, s.* FROM n_ro0 CROSS JOIN (
    SELECT quantile_cont(search_to_book_conversion, 0.5) AS conv_med, quantile_cont(no_result_rate, 0.5) AS nr_med,
           quantile_cont(no_result_rate, 0.75) AS nr_p75, quantile_cont(searches, 0.75) AS s_p75,
           quantile_cont(searches, 0.5) AS s_med FROM n_ro0) s),
{zscores('n_ro1', ['ln(1 + searches)', 'greatest(conv_med - search_to_book_conversion, 0)',
                   'greatest(no_result_rate - nr_med, 0)',
                   'origin_pagerank + destination_pagerank + origin_betweenness + destination_betweenness',
                   'ln(1 + distance_km)'], 'n_rz')},
n_ro2 AS (SELECT *, {weighted([0.32, 0.23, 0.20, 0.15, 0.10])} AS underserved_opportunity_score FROM n_rz_z),
n_route_opps AS (
  SELECT * EXCLUDE (conv_med, nr_med, nr_p75, s_p75, s_med, c0, c1, c2, c3, c4, z0, z1, z2, z3, z4),
         row_number() OVER (ORDER BY underserved_opportunity_score DESC, origin_station_id, destination_station_id)
           AS opportunity_rank,
         CASE WHEN searches >= s_p75 AND search_to_book_conversion < conv_med THEN 'High-demand conversion gap'
              WHEN no_result_rate >= nr_p75 THEN 'High no-result demand'
              WHEN international_flag = 1 AND searches >= s_med THEN 'Cross-border expansion opportunity'
              ELSE 'Network optimisation opportunity' END AS opportunity_type
  FROM n_ro2)"""

CITIES = f"""n_ci0 AS (
  SELECT origin_city, origin_country, CAST(sum(searches) AS BIGINT) AS searches, CAST(sum(bookings) AS BIGINT) AS bookings,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         avg(no_result_rate) AS average_no_result_rate, avg(underserved_opportunity_score) AS average_route_score,
         count(*) FILTER (WHERE opportunity_rank <= 100) AS high_priority_routes,
         {sd('sum(bookings)', 'sum(searches)')} AS conversion
  FROM n_route_opps GROUP BY origin_city, origin_country),
n_ci1 AS (SELECT n_ci0.*, m.med FROM n_ci0 CROSS JOIN (SELECT quantile_cont(conversion, 0.5) AS med FROM n_ci0) m),
{zscores('n_ci1', ['ln(1 + searches)', 'average_no_result_rate', 'greatest(med - conversion, 0)',
                   'average_route_score'], 'n_cz')},
n_cities AS (
  SELECT * EXCLUDE (med, c0, c1, c2, c3, z0, z1, z2, z3, s0),
         row_number() OVER (ORDER BY s0 DESC, origin_city, origin_country) AS market_rank,
         s0 AS market_opportunity_score
  FROM (SELECT *, {weighted([0.35, 0.25, 0.20, 0.20])} AS s0 FROM n_cz_z) AS q)"""

PARTNER_ROUTES = f"""n_pr0 AS (
  SELECT partner_id, origin_station_id, destination_station_id, count(*) AS searches,
         CAST(sum(booked_flag) AS BIGINT) AS booked_searches, CAST(sum(booking_count) AS BIGINT) AS bookings,
         round(sum(successful_booking_value), 2) AS successful_booking_value,
         {sd('sum(booked_flag)', 'count(*)')} AS conversion
  FROM fct_search GROUP BY 1, 2, 3),
n_pr1 AS (
  SELECT p.*, t.opportunity_rank, t.underserved_opportunity_score, t.opportunity_type
  FROM n_pr0 p JOIN (SELECT * FROM n_route_opps WHERE opportunity_rank <= 250) t
    ON p.origin_station_id = t.origin_station_id AND p.destination_station_id = t.destination_station_id),
n_pr2 AS (SELECT n_pr1.*, m.med FROM n_pr1 CROSS JOIN (SELECT quantile_cont(conversion, 0.5) AS med FROM n_pr1) m),
{zscores('n_pr2', ['underserved_opportunity_score', 'ln(1 + searches)', 'greatest(med - conversion, 0)'], 'n_pz')},
n_partner_routes AS (
  SELECT * EXCLUDE (med, c0, c1, c2, z0, z1, z2, s0),
         row_number() OVER (ORDER BY s0 DESC, partner_id, origin_station_id, destination_station_id) AS partner_route_rank,
         s0 AS partner_route_opportunity_score
  FROM (SELECT *, {weighted([0.45, 0.30, 0.25])} AS s0 FROM n_pz_z) AS q)"""


def betweenness_ctes(rounds: int) -> str:
    """Distances, path counts and dependencies unrolled to shortest paths of at most ``rounds`` edges."""
    parts = [
        "b_e AS MATERIALIZED (SELECT u, v, inverse_demand_cost AS cost FROM n_und UNION ALL SELECT v, u, inverse_demand_cost FROM n_und)",
        "b_d0 AS (SELECT DISTINCT station_id AS s, station_id AS node, CAST(0 AS DOUBLE) AS dist FROM v_stations)"]
    for i in range(1, rounds + 1):
        parts.append(f"b_d{i} AS MATERIALIZED (SELECT s, node, min(dist) AS dist FROM (SELECT * FROM b_d{i - 1} UNION ALL "
                     f"SELECT d.s, e.v, d.dist + e.cost FROM b_d{i - 1} d JOIN b_e e ON d.node = e.u) AS x GROUP BY s, node)")
    parts.append(f"b_step AS MATERIALIZED (SELECT a.s, e.u, e.v FROM b_d{rounds} a JOIN b_e e ON a.node = e.u "
                 f"JOIN b_d{rounds} b ON b.s = a.s AND b.node = e.v WHERE a.dist + e.cost = b.dist)")
    parts.append("b_p0 AS (SELECT s, node, CAST(1 AS DOUBLE) AS x FROM b_d0)")
    for i in range(1, rounds + 1):
        parts.append(f"b_p{i} AS MATERIALIZED (SELECT p.s, t.v AS node, sum(p.x) AS x FROM b_p{i - 1} p "
                     "JOIN b_step t ON t.s = p.s AND t.u = p.node GROUP BY p.s, t.v)")
    union = " UNION ALL ".join(f"SELECT * FROM b_p{i}" for i in range(rounds + 1))
    parts.append(f"b_sigma AS MATERIALIZED (SELECT s, node, sum(x) AS sigma FROM ({union}) AS q GROUP BY s, node)")
    parts.append("b_h0 AS (SELECT s, node, 1 / sigma AS x FROM b_sigma)")
    for i in range(1, rounds + 1):
        parts.append(f"b_h{i} AS MATERIALIZED (SELECT p.s, t.u AS node, sum(p.x) AS x FROM b_h{i - 1} p "
                     "JOIN b_step t ON t.s = p.s AND t.v = p.node GROUP BY p.s, t.u)")
    union = " UNION ALL ".join(f"SELECT * FROM b_h{i}" for i in range(1, rounds + 1))
    parts.append(f"b_dep AS (SELECT h.node, sum(h.x * g.sigma) AS dep FROM ({union}) AS h "
                 "JOIN b_sigma g ON g.s = h.s AND g.node = h.node WHERE h.s <> h.node GROUP BY h.node)")
    return ",\n".join(parts)


BETWEENNESS_FINAL = """SELECT s.station_id, coalesce(d.dep, 0) / ((n.c - 1) * (n.c - 2)) AS betweenness_centrality
FROM v_stations s LEFT JOIN b_dep d ON d.node = s.station_id CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS c FROM v_stations) AS n"""


def converged_ctes(rounds: int, tol: float = 1e-6) -> str:
    """pr_final(id, rank): unrolled PageRank up to the first round that moves all ranks by less than n * tol together."""
    moved = "\n  UNION ALL ".join(f"SELECT {i} AS i, sum(abs(a.rank - b.rank)) AS e FROM pr_{i} a JOIN pr_{i - 1} b USING (id)"
                               for i in range(1, rounds + 1))
    ranks = "\n  UNION ALL ".join(f"SELECT {i} AS i, id, rank FROM pr_{i}" for i in range(1, rounds + 1))
    return f"""{pagerank_ctes(rounds)},
pr_moved AS ({moved}),
pr_stop AS (SELECT min(i) AS i FROM pr_moved WHERE e < (SELECT n FROM pr_n) * CAST({tol} AS DOUBLE)),
pr_final AS (SELECT id, rank FROM ({ranks}) AS r WHERE i = (SELECT i FROM pr_stop))"""


#: The centralities themselves in place of strengths: PageRank to convergence and exact betweenness.
CENTRAL = ENRICHED.rpartition(",\nn_cent AS")[0] + ",\n" + converged_ctes(40) + ",\n" + betweenness_ctes(24) + f""",
n_cent AS (
  SELECT b.station_id, p.rank AS pagerank_search_demand, b.betweenness_centrality
  FROM ({BETWEENNESS_FINAL}) AS b JOIN pr_final p ON p.id = b.station_id)"""
