import itertools

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import encoding, gram
from kestrel.operators import experiment as X
from kestrel.operators import network as N

# 5-node digraph: node 4 is dangling, 0<->1 is a two-way pair
EDGES = [(0, 1, 10.0), (1, 0, 4.0), (1, 2, 3.0), (2, 3, 5.0), (3, 0, 2.0), (0, 2, 1.0), (2, 4, 6.0)]


def _graph(spark):
    nodes = spark.createDataFrame([(i,) for i in range(5)], "station_id long")
    edges = spark.createDataFrame(EDGES, "src long, dst long, weight double").withColumn(
        "inverse_demand_cost", F.lit(1.0) / F.col("weight"))
    return nodes, edges


def _pagerank_numpy(n=5, alpha=0.85, tol=1e-6):
    W = np.zeros((n, n))
    for s, d, w in EDGES:
        W[s, d] += w
    out = W.sum(1)
    x = np.full(n, 1 / n)
    for _ in range(100):
        last = x
        dang = x[out == 0].sum()
        x = alpha * (np.divide(x, out, out=np.zeros(n), where=out > 0) @ W + dang / n) + (1 - alpha) / n
        if np.abs(x - last).sum() < n * tol:
            break
    return x


def test_pagerank_matches_power_iteration(spark):
    nodes, edges = _graph(spark)
    got = {r.station_id: r.pagerank_search_demand for r in N.pagerank(nodes, edges, checkpoint_every=3).collect()}
    exp = _pagerank_numpy()
    assert abs(sum(got.values()) - 1.0) < 1e-9
    assert all(abs(got[i] - exp[i]) < 1e-12 for i in range(5))


def test_undirected_weight_from_later_origin(spark):
    _, edges = _graph(spark)
    und = {(r.u, r.v): r.weight for r in N.undirected_edges(edges).collect()}
    assert und[(0, 1)] == 4.0      # 1 -> 0 wins: origin 1 comes after 0 (Q8)
    assert len(und) == 6


def _betweenness_brute(n, und):
    dist = np.full((n, n), np.inf)
    np.fill_diagonal(dist, 0)
    for (u, v), c in und.items():
        dist[u, v] = dist[v, u] = c
    for k in range(n):
        dist = np.minimum(dist, dist[:, [k]] + dist[[k], :])
    adj = {i: [] for i in range(n)}
    for (u, v), c in und.items():
        adj[u].append((v, c))
        adj[v].append((u, c))

    def paths(s, t):      # all shortest paths by DFS on the tight edges
        if s == t:
            return [[s]]
        out = []
        for w, c in adj[s]:
            if abs(dist[s, w] + dist[w, t] - dist[s, t]) < 1e-12 and dist[s, w] == c:
                out += [[s] + p for p in paths(w, t)]
        return out
    bc = np.zeros(n)
    for s, t in itertools.permutations(range(n), 2):
        ps = paths(s, t)
        for v in range(n):
            if v not in (s, t):
                bc[v] += sum(v in p for p in ps) / len(ps)
    return bc / ((n - 1) * (n - 2))


def test_betweenness_brute_force(spark):
    nodes, edges = _graph(spark)
    und_df = N.undirected_edges(edges)
    und = {(r.u, r.v): r.inverse_demand_cost for r in und_df.collect()}
    got = {r.station_id: r.betweenness_centrality for r in N.betweenness(nodes, und_df).collect()}
    exp = _betweenness_brute(5, und)
    assert all(abs(got[i] - exp[i]) < 1e-12 for i in range(5))


def test_cluster_robust_ols_by_hand(spark):
    rows = [(1, 1.0, 0.2, "a", 1.0), (1, 0.0, 0.5, "b", 0.0), (2, 1.0, 0.1, "a", 1.0),
            (2, 0.0, 0.9, "b", 1.0), (3, 1.0, 0.4, "b", 0.0), (3, 0.0, 0.3, "a", 0.0)]
    df = spark.createDataFrame(rows, "g long, t double, x double, c string, y double")
    terms = encoding.treatment_terms(["t", "x"], ["c"], encoding.reference_levels(df, ["c"]))
    fit = gram.cluster_robust_ols(df, terms, F.col("y"), F.col("g"))
    assert fit["names"] == ["Intercept", "c[T.b]", "t", "x"]
    place = [fit["names"].index(n) for n in ("Intercept", "t", "x", "c[T.b]")]
    Xm = np.array([[1, r[1], r[2], 1.0 if r[3] == "b" else 0.0] for r in rows])
    y = np.array([r[4] for r in rows])
    xtx_inv = np.linalg.inv(Xm.T @ Xm)
    beta = xtx_inv @ Xm.T @ y
    e = y - Xm @ beta
    meat = sum(np.outer(Xm[[i for i, r in enumerate(rows) if r[0] == g]].T @ e[[i for i, r in enumerate(rows) if r[0] == g]],
                        Xm[[i for i, r in enumerate(rows) if r[0] == g]].T @ e[[i for i, r in enumerate(rows) if r[0] == g]])
               for g in (1, 2, 3))
    cov = xtx_inv @ meat @ xtx_inv * (3 / 2) * (5 / 2)
    np.testing.assert_allclose(fit["beta"][place], beta, atol=1e-10)
    np.testing.assert_allclose(fit["se"][place], np.sqrt(np.diag(cov)), atol=1e-10)


def test_bh_adjust_brute_force(spark):
    ps = [0.01, 0.04, 0.03, 0.5, 0.04, 0.2]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "i int, p_value double")
    got = {r.i: r.p_value_fdr_bh for r in X.bh_adjust(df).collect()}
    m = len(ps)
    order = np.argsort(ps, kind="stable")
    adj = np.empty(m)
    run = 1.0
    for rank in range(m, 0, -1):
        i = order[rank - 1]
        run = min(run, ps[i] * m / rank)
        adj[i] = run
    assert all(abs(got[i] - adj[i]) < 1e-12 for i in range(m))


def test_two_prop_and_srm_columns(spark):
    df = spark.createDataFrame([(362, 1352, 354, 1293)], "xt long, nt long, xc long, nc long")
    r = X.two_prop_test(df, "xt", "nt", "xc", "nc").first()
    assert round(r.p_value, 6) == 0.727150
    assert round(r.ci_low, 4) == -0.0399 and round(r.ci_high, 4) == 0.0278
    units = spark.createDataFrame([("control",)] * 1293 + [("variant",)] * 1352, "experiment_variant string")
    s = X.srm(units).first()
    assert round(s.p_value, 6) == 0.251299 and s.srm_flag is False
    pw = X.power_mde(spark.createDataFrame([(354 / 1293, 362 / 1352, 1293, 1352, 362 / 1352 - 354 / 1293)],
                                           "control_rate double, variant_rate double, control_n long, "
                                           "variant_n long, absolute_effect double")).first()
    assert round(pw.observed_approximate_power, 4) == 0.0641
    assert round(pw.minimum_detectable_absolute_effect, 4) == 0.0498


def test_findings_take_no_product_of_partitions(spark):
    top = lambda rank, n: spark.range(0, n, 1, 40).select((F.col("id") + 1).alias(rank), "id")
    stations = top("station_opportunity_rank", 50).selectExpr("*", "id AS station_id", "0.5D AS pagerank_search_demand",
                                                              "0.1D AS betweenness_centrality")
    routes = top("opportunity_rank", 60).selectExpr("*", "id AS origin_station_id", "id + 1 AS destination_station_id", "'t' AS opportunity_type")
    cities = top("market_rank", 70).selectExpr("*", "concat('c', id) AS origin_city")
    found = N.network_findings(stations, routes, cities, top("partner_route_rank", 80).selectExpr("*", "id + 7 AS partner_id"))
    assert found.rdd.getNumPartitions() <= 40
    assert [tuple(r) for r in found.collect()] == [(0, 0.5, 0.1, 0, 1, "t", "c0", 7, 50, 60, 70)]
    assert N.network_findings(stations.where("id > 0"), routes, cities, routes.selectExpr("id AS partner_id", "id AS partner_route_rank")).count() == 0
