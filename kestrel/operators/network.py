"""Route network and geospatial scoring (NW-01..NW-15).

Graph data lives in two DataFrames: ``nodes(station_id, ...)`` and
``edges(src, dst, weight, ...)``.  PageRank is an iterative join +
aggregate over the edges with reliable checkpoints every few rounds;
betweenness is a series of joins over batches of sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.core import classify, composite_score, money_sum, rank_unique, safe_div
from kestrel.functions.ranking import quantiles
from kestrel.session import cut_lineage

EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """NW-01: great-circle distance as a native expression (argument clamped to 1)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dl = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


STATION_COLS = ["station_name", "city", "country", "latitude", "longitude", "hub_weight"]


def enrich_routes(routes: DataFrame, stations: DataFrame, drop_self_loops: bool = True) -> DataFrame:
    """NW-02: stations joined as origin and destination, distance, cross-border flag.

    Stations are a dimension; the join is left to the planner (broadcast
    when AQE measures it as small).  Missing coordinates raise at runtime.
    """
    o = stations.select(F.col("station_id").alias("origin_station_id"),
                        *[F.col(c).alias(f"origin_{c}") for c in STATION_COLS])
    d = stations.select(F.col("station_id").alias("destination_station_id"),
                        *[F.col(c).alias(f"destination_{c}") for c in STATION_COLS])
    r = routes.filter(F.col("origin_station_id") != F.col("destination_station_id")) if drop_self_loops else routes
    out = r.join(o, "origin_station_id", "left").join(d, "destination_station_id", "left")
    missing = (F.col("origin_latitude").isNull() | F.col("origin_longitude").isNull()
               | F.col("destination_latitude").isNull() | F.col("destination_longitude").isNull())
    dist = F.when(missing, F.raise_error(F.lit("Route enrichment produced missing station coordinates."))).otherwise(
        haversine_km(F.col("origin_latitude"), F.col("origin_longitude"), F.col("destination_latitude"),
                     F.col("destination_longitude")))
    return out.withColumns({
        "distance_km": dist.cast("double"),
        "international_flag": (F.col("origin_country") != F.col("destination_country")).cast("bigint"),
    })


def graph_edges(enriched: DataFrame) -> DataFrame:
    """NW-03: directed edges with weight = searches and the two cost columns."""
    return enriched.select(
        F.col("origin_station_id").alias("src"), F.col("destination_station_id").alias("dst"),
        F.col("searches").cast("double").alias("weight"),
        F.col("bookings").cast("double").alias("bookings"),
        F.col("search_to_book_conversion").alias("conversion"),
        (F.lit(1.0) / F.greatest(F.col("searches").cast("double"), F.lit(1.0))).alias("inverse_demand_cost"),
        (F.lit(1.0) / F.greatest(F.col("search_to_book_conversion"), F.lit(1e-6))).alias("conversion_cost"),
    )


def pagerank(nodes: DataFrame, edges: DataFrame, alpha: float = 0.85, max_iter: int = 100,
             tol: float | None = 1e-6, checkpoint_every: int = 5, node: str = "station_id") -> DataFrame:
    """NW-04: weighted PageRank with uniform teleport and dangling mass spread uniformly.

    Stops when the L1 change is below ``N * tol`` (``tol=None`` runs exactly
    ``max_iter`` rounds).  Each round is one join of ranks to edges and one
    aggregate by destination; the dangling mass and the L1 change are
    one-row aggregates.  The plan is cut with a reliable checkpoint every
    ``checkpoint_every`` rounds so lineage stays short and survives executor
    loss.
    """
    n_nodes = nodes.select(F.col(node).alias("id")).distinct()
    n = n_nodes.count()
    if n == 0:
        return n_nodes.withColumn("pagerank", F.lit(None).cast("double"))
    out_w = edges.groupBy("src").agg(F.sum("weight").alias("__out"))
    trans = edges.join(out_w, "src").select("src", "dst", (F.col("weight") / F.col("__out")).alias("p"))
    dangling = n_nodes.join(out_w.filter(F.col("__out") > 0).select(F.col("src").alias("id")), "id", "left_anti")
    dangling = dangling.withColumn("__dangling", F.lit(True))
    base = n_nodes.join(dangling, "id", "left").withColumn(
        "__dangling", F.coalesce(F.col("__dangling"), F.lit(False)))
    base = cut_lineage(base)
    trans = cut_lineage(trans)
    ranks = base.withColumn("rank", F.lit(1.0 / n))
    # dangling mass of the current ranks, carried as a scalar between rounds
    dm = base.agg(F.count_if("__dangling").alias("c")).first()["c"] * (1.0 / n)
    for it in range(1, max_iter + 1):
        contrib = ranks.join(trans, ranks.id == trans.src).groupBy("dst").agg(
            F.sum(F.col("rank") * F.col("p")).alias("__c"))
        new = base.join(contrib, base.id == contrib.dst, "left").select(
            "id", "__dangling",
            (F.lit(alpha) * (F.coalesce(F.col("__c"), F.lit(0.0)) + F.lit(dm) / n)
             + F.lit((1.0 - alpha) / n)).alias("rank"))
        if it % checkpoint_every == 0:
            new = cut_lineage(new)          # reliable: written to the shared checkpoint folder
        else:
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
        # one job per round: L1 change and the next round's dangling mass
        row = new.alias("a").join(ranks.alias("b"), "id").agg(
            F.sum(F.abs(F.col("a.rank") - F.col("b.rank"))).alias("e"),
            F.coalesce(F.sum(F.when(F.col("a.__dangling"), F.col("a.rank"))), F.lit(0.0)).alias("dm")).first()
        ranks.unpersist()
        ranks = new
        dm = row["dm"]
        if tol is not None and row["e"] < n * tol:
            break
    return ranks.select(F.col("id").alias(node), F.col("rank").alias("pagerank_search_demand"))


def strengths(nodes: DataFrame, edges: DataFrame, node: str = "station_id") -> DataFrame:
    """NW-05: weighted in/out strength per node (0 for isolated nodes)."""
    ins = edges.groupBy(F.col("dst").alias(node)).agg(F.sum("weight").alias("inbound_search_strength"))
    outs = edges.groupBy(F.col("src").alias(node)).agg(F.sum("weight").alias("outbound_search_strength"))
    return nodes.select(node).join(ins, node, "left").join(outs, node, "left").fillna(
        0.0, subset=["inbound_search_strength", "outbound_search_strength"])


def undirected_edges(edges: DataFrame, attrs: Sequence[str] = ("inverse_demand_cost", "weight")) -> DataFrame:
    """NW-06: one row per unordered pair; attributes of the direction whose origin comes last (Q8)."""
    a = F.least("src", "dst").alias("u")
    b = F.greatest("src", "dst").alias("v")
    return edges.groupBy(a, b).agg(*[F.max_by(F.col(c), F.col("src")).alias(c) for c in attrs])


def degree(nodes: DataFrame, und: DataFrame, node: str = "station_id") -> DataFrame:
    """NW-06: undirected degree (distinct neighbours)."""
    ends = und.select(F.col("u").alias(node)).unionAll(und.select(F.col("v").alias(node)))
    d = ends.groupBy(node).agg(F.count(F.lit(1)).alias("network_degree"))
    return nodes.select(node).join(d, node, "left").fillna(0, subset=["network_degree"])


def _shortest_distances(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, node, dist) of every node that a source reaches: relaxations until none improves."""
    dist = sources.select("source", F.col("source").alias("node"), F.lit(0.0).alias("dist"))
    dist = cut_lineage(dist.withColumn("fresh", F.lit(True)))
    while True:
        ahead = (dist.filter("fresh").join(edges, F.col("node") == F.col("u"))
                 .select("source", F.col("v").alias("node"), (F.col("dist") + F.col("cost")).alias("new")))
        best = ahead.groupBy("source", "node").agg(F.min("new").alias("new"))
        better = F.col("new") < F.coalesce("dist", F.lit(float("inf")))
        dist = cut_lineage(dist.drop("fresh").join(best, ["source", "node"], "full").select(
            "source", "node", F.least("dist", "new").alias("dist"), F.coalesce(better, F.lit(False)).alias("fresh")))
        if dist.filter("fresh").isEmpty():
            return dist.drop("fresh")


def _sum_over_paths(start: DataFrame, steps: DataFrame, at: str, to: str) -> DataFrame:
    """(source, node, total): what all paths of ``steps`` carry to each node from the values of ``start``.

    ``start`` has source, node and x; ``steps`` are edges without cycles, walked from ``at`` to
    ``to``.  Round k holds what paths of k edges carry, until no path is longer.
    """
    wave = cut_lineage(start)
    total = wave
    while True:
        wave = cut_lineage(wave.join(steps.select("source", F.col(at).alias("node"), F.col(to).alias("__to")), ["source", "node"])
                           .groupBy("source", F.col("__to").alias("node")).agg(F.sum("x").alias("x")))
        if wave.isEmpty():
            return total.groupBy("source", "node").agg(F.sum("x").alias("total"))
        total = total.unionByName(wave)


def betweenness(nodes: DataFrame, und: DataFrame, cost: str = "inverse_demand_cost", node: str = "station_id",
                normalized: bool = True, batch: int = 1000) -> DataFrame:
    """NW-07: exact weighted shortest-path betweenness (undirected), as joins over batches of sources.

    For every source: distances by relaxation; the edges on shortest paths; the number of
    shortest paths to each node as a sum over paths from the source; and each node's share of
    the paths beyond it as a sum over the same edges backwards.  The state is a row for each
    (source, node) of a batch, keyed and joined like any fact; no source is sampled.
    """
    one = und.select("u", "v", F.col(cost).cast("double").alias("cost"))
    edges = cut_lineage(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"), "cost")))
    ids = cut_lineage(nodes.select(F.col(node).alias("source")).distinct())
    n = ids.count()
    batches = max(1, -(-n // batch))
    parts = None
    for k in range(batches):
        some = ids.filter(F.pmod(F.xxhash64("source"), F.lit(batches)) == k)
        dist = _shortest_distances(some, edges)
        ends = dist.select("source", F.col("node").alias("v"), F.col("dist").alias("__dv"))
        steps = cut_lineage(dist.join(edges, F.col("node") == F.col("u")).join(ends, ["source", "v"])
                            .filter(F.col("dist") + F.col("cost") == F.col("__dv")).select("source", "u", "v"))
        first = some.select("source", F.col("source").alias("node"), F.lit(1.0).alias("x"))
        sigma = cut_lineage(_sum_over_paths(first, steps, "u", "v").select("source", "node", F.col("total").alias("sigma")))
        # a node's dependency over its path count is the sum, over what lies beyond it, of 1 / path count
        beyond = _sum_over_paths(sigma.select("source", "node", (1.0 / F.col("sigma")).alias("x")), steps, "v", "u")
        part = (beyond.join(sigma, ["source", "node"]).filter(F.col("source") != F.col("node"))
                .groupBy("node").agg(F.sum(F.col("total") * F.col("sigma") - 1.0).alias("dep")))
        part = cut_lineage(part)
        parts = part if parts is None else parts.unionByName(part)
    deps = parts.groupBy("node").agg(F.sum("dep").alias("raw"))
    scale = 1.0 / ((n - 1) * (n - 2)) if (normalized and n > 2) else (0.5 if not normalized else 1.0)
    return nodes.select(node).join(deps, F.col(node) == F.col("node"), "left").select(
        node, (F.coalesce(F.col("raw"), F.lit(0.0)) * F.lit(scale)).alias("betweenness_centrality"))


def station_network(stations: DataFrame, enriched: DataFrame, centrality: DataFrame, strength: DataFrame,
                    deg: DataFrame) -> DataFrame:
    """NW-08/NW-09: node metric table, outbound rollup, score and unique rank."""
    roll = enriched.groupBy(F.col("origin_station_id").alias("station_id")).agg(
        F.sum("searches").alias("outbound_route_searches"), F.sum("bookings").alias("outbound_bookings"),
        F.sum("zero_result_searches").alias("outbound_no_result_searches"),
        money_sum("successful_booking_value").alias("outbound_successful_booking_value"))
    m = (stations.join(centrality, "station_id", "left").join(deg, "station_id", "left")
         .join(strength, "station_id", "left").join(roll, "station_id", "left"))
    m = m.fillna(0.0, subset=["pagerank_search_demand", "betweenness_centrality", "inbound_search_strength",
                              "outbound_search_strength", "outbound_successful_booking_value"]).fillna(
        0, subset=["network_degree", "outbound_route_searches", "outbound_bookings", "outbound_no_result_searches"])
    m = m.withColumns({
        "outbound_conversion": safe_div("outbound_bookings", "outbound_route_searches", null_as_zero=True),
        "outbound_no_result_rate": safe_div("outbound_no_result_searches", "outbound_route_searches", null_as_zero=True),
    })
    med = quantiles(m, [("__med", "outbound_conversion", 0.5)])
    m = m.crossJoin(F.broadcast(med))
    m = composite_score(m, [
        (0.30, F.log1p("outbound_route_searches")), (0.20, F.col("pagerank_search_demand")),
        (0.20, F.col("betweenness_centrality")), (0.18, F.col("outbound_no_result_rate")),
        (0.12, F.greatest(F.col("__med") - F.col("outbound_conversion"), F.lit(0.0)))], "station_opportunity_score")
    m = rank_unique(m, [F.col("station_opportunity_score").desc(), F.col("station_id").asc()],
                    "station_opportunity_rank")
    return m.drop("__med")


ROUTE_TYPES = ["High-demand conversion gap", "High no-result demand", "Cross-border expansion opportunity",
               "Network optimisation opportunity"]


def route_opportunities(enriched: DataFrame, centrality: DataFrame) -> DataFrame:
    """NW-10/NW-11: endpoint centrality, score, unique rank and rule class (>= P75 here, Q10)."""
    c = centrality.select("station_id", "pagerank_search_demand", "betweenness_centrality")
    o = c.select(F.col("station_id").alias("origin_station_id"),
                 F.col("pagerank_search_demand").alias("origin_pagerank"),
                 F.col("betweenness_centrality").alias("origin_betweenness"))
    d = c.select(F.col("station_id").alias("destination_station_id"),
                 F.col("pagerank_search_demand").alias("destination_pagerank"),
                 F.col("betweenness_centrality").alias("destination_betweenness"))
    out = enriched.join(o, "origin_station_id", "left").join(d, "destination_station_id", "left")
    st = quantiles(out, [
        ("__conv_med", "search_to_book_conversion", 0.5), ("__nr_med", "no_result_rate", 0.5),
        ("__nr_p75", "no_result_rate", 0.75), ("__s_p75", "searches", 0.75), ("__s_med", "searches", 0.5)])
    out = out.crossJoin(F.broadcast(st))
    endpoint = (F.col("origin_pagerank") + F.col("destination_pagerank") + F.col("origin_betweenness")
                + F.col("destination_betweenness"))
    out = composite_score(out, [
        (0.32, F.log1p("searches")),
        (0.23, F.greatest(F.col("__conv_med") - F.col("search_to_book_conversion"), F.lit(0.0))),
        (0.20, F.greatest(F.col("no_result_rate") - F.col("__nr_med"), F.lit(0.0))),
        (0.15, endpoint), (0.10, F.log1p("distance_km"))], "underserved_opportunity_score")
    out = rank_unique(out, [F.col("underserved_opportunity_score").desc(), F.col("origin_station_id").asc(),
                            F.col("destination_station_id").asc()], "opportunity_rank")
    out = out.withColumn("opportunity_type", classify([
        ((F.col("searches") >= F.col("__s_p75")) & (F.col("search_to_book_conversion") < F.col("__conv_med")),
         ROUTE_TYPES[0]),
        (F.col("no_result_rate") >= F.col("__nr_p75"), ROUTE_TYPES[1]),
        ((F.col("international_flag") == 1) & (F.col("searches") >= F.col("__s_med")), ROUTE_TYPES[2]),
    ], ROUTE_TYPES[3]))
    return out.drop("__conv_med", "__nr_med", "__nr_p75", "__s_p75", "__s_med")


def city_markets(routes_opp: DataFrame, priority_cut: int = 100) -> DataFrame:
    """NW-12: origin-city rollup; rates are unweighted means of route rates (Q19)."""
    c = routes_opp.groupBy("origin_city", "origin_country").agg(
        F.sum("searches").alias("searches"), F.sum("bookings").alias("bookings"),
        money_sum("successful_booking_value").alias("successful_booking_value"),
        F.avg("no_result_rate").alias("average_no_result_rate"),
        F.avg("underserved_opportunity_score").alias("average_route_score"),
        F.count_if(F.col("opportunity_rank") <= priority_cut).alias("high_priority_routes"))
    c = c.withColumn("conversion", safe_div("bookings", "searches"))
    med = quantiles(c, [("__med", "conversion", 0.5)])
    c = c.crossJoin(F.broadcast(med))
    c = composite_score(c, [
        (0.35, F.log1p("searches")), (0.25, F.col("average_no_result_rate")),
        (0.20, F.greatest(F.col("__med") - F.col("conversion"), F.lit(0.0))),
        (0.20, F.col("average_route_score"))], "market_opportunity_score")
    c = rank_unique(c, [F.col("market_opportunity_score").desc(), F.col("origin_city").asc(),
                        F.col("origin_country").asc()], "market_rank")
    return c.drop("__med")


def partner_route_opportunities(search_fact: DataFrame, routes_opp: DataFrame, top_n: int = 250) -> DataFrame:
    """NW-13: entity x route rollup inside the top-N routes, score and unique rank.

    The route side is bounded by ``top_n`` rows, so it is broadcast, and the fact is cut down to these routes
    before it is rolled up.  The rollup is written once; its median and its scores are taken from there.
    """
    route = ["origin_station_id", "destination_station_id"]
    kept = ["opportunity_rank", "underserved_opportunity_score", "opportunity_type"]
    top = routes_opp.filter(F.col("opportunity_rank") <= top_n).select(*route, *kept)
    pr = search_fact.join(F.broadcast(top), route, "inner").groupBy("partner_id", *route, *kept).agg(
        F.count(F.lit(1)).alias("searches"), F.sum("booked_flag").alias("booked_searches"),
        F.sum("booking_count").alias("bookings"), money_sum("successful_booking_value").alias("successful_booking_value"))
    out = cut_lineage(pr.withColumn("conversion", safe_div("booked_searches", "searches")))
    med = quantiles(out, [("__med", "conversion", 0.5)])
    out = out.crossJoin(F.broadcast(med))
    out = composite_score(out, [
        (0.45, F.col("underserved_opportunity_score")), (0.30, F.log1p("searches")),
        (0.25, F.greatest(F.col("__med") - F.col("conversion"), F.lit(0.0)))], "partner_route_opportunity_score")
    out = rank_unique(out, [F.col("partner_route_opportunity_score").desc(), F.col("partner_id").asc(),
                            F.col("origin_station_id").asc(), F.col("destination_station_id").asc()],
                      "partner_route_rank")
    return out.drop("__med")


def network_findings(stations_m: DataFrame, routes_opp: DataFrame, cities: DataFrame, partner_routes: DataFrame) -> DataFrame:
    """NW-14: top node / route / market / entity-route and scale counts in one row.

    Ranks are unique, so each side is one row: sides are broadcast, as a product of their partitions would be a task for each
    combination of these.
    """
    s = stations_m.filter(F.col("station_opportunity_rank") == 1).select(
        F.col("station_id").alias("top_station_id"), F.col("pagerank_search_demand").alias("top_station_pagerank"),
        F.col("betweenness_centrality").alias("top_station_betweenness"))
    r = routes_opp.filter(F.col("opportunity_rank") == 1).select(
        F.col("origin_station_id").alias("top_route_origin"), F.col("destination_station_id").alias("top_route_destination"),
        F.col("opportunity_type").alias("top_route_type"))
    c = cities.filter(F.col("market_rank") == 1).select(F.col("origin_city").alias("top_city"))
    p = partner_routes.agg(F.min_by(F.col("partner_id"), F.col("partner_route_rank")).alias("top_partner_route_partner"))
    counts = [df.agg(F.count(F.lit(1)).alias(name)) for df, name in (
        (stations_m, "stations"), (routes_opp, "routes"), (cities, "cities"))]
    out = s
    for side in (r, c, p, *counts):
        out = out.crossJoin(F.broadcast(side))
    return out


def endpoint_count(routes: DataFrame) -> DataFrame:
    """NW-15: distinct origins + distinct destinations (two distinct counts, one pass)."""
    return routes.agg((F.count_distinct("origin_station_id") + F.count_distinct("destination_station_id"))
                      .alias("route_endpoints"))
