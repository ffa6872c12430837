"""Routes between places off the road graph: candidates to enter and leave it by, pairs of them in order, and the first route that is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajkit.operators import routing, spatial
from trajkit.session import written

NODES, CANDIDATES, SNAP_M = 5, 10, 500.0


def candidates(points: DataFrame, nodes: DataFrame, edges: DataFrame, most_m: float = SNAP_M) -> DataFrame:
    """``id, rank, node, snap_m, lat, lon`` of at most ten ways for a point (``id, lat, lon``) to get onto the graph, nearest first, ties to the smaller node.

    They are the five nearest nodes and the ends of all edges that pass within ``most_m``, each with its
    least distance: of the node itself, or of the point's projection on the edge, whose place is given.
    ``nodes``: ``id, lat, lon``; ``edges``: ``src, dst`` with the ends' places. Edges are looked up by their
    middle, so no edge may be longer than ``most_m`` twice over to be found for sure; longer ones are cut.
    """
    near = spatial.within(points, nodes, most_m, k=NODES).select(F.col("left_id").alias("id"), F.col("right_id").alias("node"), F.col("dist").alias("d"))
    near = near.join(nodes.select(F.col("id").alias("node"), "lat", "lon"), "node").select("id", "node", "d", "lat", "lon")
    once = edges.select("src", "dst", "src_lat", "src_lon", "dst_lat", "dst_lon").distinct()
    n = F.greatest(F.ceil(spatial.haversine(*(F.col(c) for c in ("src_lat", "src_lon", "dst_lat", "dst_lon"))) / most_m), F.lit(1))
    cut = once.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda c, k: F.col(f"src_{c}") + (F.col(f"dst_{c}") - F.col(f"src_{c}")) * k / F.col("n")
    pieces = written(cut.withColumn("id", F.xxhash64("src", "dst", "k")).withColumn("lat", at("lat", F.col("k") + 0.5)).withColumn("lon", at("lon", F.col("k") + 0.5)), "snapping-pieces")
    met = spatial.within(points, pieces, 1.5 * most_m).select("left_id", "right_id")
    met = met.join(pieces.drop("lat", "lon").withColumnRenamed("id", "right_id"), "right_id").join(points.withColumnRenamed("id", "left_id"), "left_id")
    p = spatial.projected(*(F.col(c) for c in ("lat", "lon", "src_lat", "src_lon", "dst_lat", "dst_lon")))
    on = met.select(F.col("left_id").alias("id"), "src", "dst", p.alias("p")).filter(F.col("p.dist") <= most_m)
    ends = on.select("id", F.explode(F.array("src", "dst")).alias("node"), F.col("p.dist").alias("d"), F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))
    best = near.unionByName(ends).groupBy("id", "node").agg(F.min(F.struct("d", "lat", "lon")).alias("m"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("m.d", "node"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= CANDIDATES).select("id", "rank", "node", F.col("m.d").alias("snap_m"), F.col("m.lat").alias("lat"), F.col("m.lon").alias("lon"))


def routed(queries: DataFrame, nodes: DataFrame, edges: DataFrame, most_m: float = SNAP_M, restrictions: DataFrame | None = None) -> DataFrame:
    """``query_id, status, start_node, end_node, distance, duration, start_snap_m, end_snap_m, geometry`` of routes between places.

    ``queries``: ``query_id, from_lat, from_lon, to_lat, to_lon``. Pairs of candidates are tried in order: the two
    best, then each further start with every end; the first pair with a route wins, and where none of these has
    one, the shortest route of the best start to any end. A route's length is that between its nodes; its
    geometry also has the places where it enters and leaves. ``edges`` as ``routing.routes`` has them, one region.
    """
    q = written(queries, "snapping-queries")
    end = lambda side, x: q.select(F.struct("query_id", F.lit(side).alias("side")).alias("id"), F.col(f"{x}_lat").alias("lat"), F.col(f"{x}_lon").alias("lon"))
    found = written(candidates(end("a", "from").unionByName(end("b", "to")), nodes, edges, most_m), "snapping-candidates")
    of = lambda side: found.filter(F.col("id.side") == side).select(F.col("id.query_id").alias("query_id"), *(F.col(c).alias(f"{c}_{side}") for c in ("rank", "node", "snap_m", "lat", "lon")))
    pairs = of("a").join(of("b"), "query_id").filter("node_a <> node_b")  # at most ten by ten a query
    first = (F.col("rank_a") == 1) & (F.col("rank_b") > 1)
    pairs = pairs.withColumn("late", first).withColumn("place", F.col("rank_a") * 100 + F.col("rank_b"))
    pairs = written(pairs.withColumn("pair", F.xxhash64("node_a", "node_b")), "snapping-pairs")
    asked = pairs.select(F.col("pair").alias("query_id"), F.lit(0).cast("long").alias("region"), F.col("node_a").alias("src"), F.col("node_b").alias("dst")).distinct()
    ways = routing.routes(edges.withColumn("region", F.lit(0).cast("long")), asked, restrictions).filter("status = 'OK'").withColumnRenamed("query_id", "pair")
    ok = pairs.join(ways, "pair")
    turn = F.struct("late", F.when(F.col("late"), F.col("distance")).otherwise(F.col("place").cast("double")), "place")
    best = ok.groupBy("query_id").agg(F.min_by(F.struct(*[c for c in ok.columns if c != "query_id"]), turn).alias("r")).select("query_id", "r.*")
    at = nodes.select(F.col("id").alias("n"), F.struct("lat", "lon").alias("p"))
    line = best.select("query_id", F.posexplode("nodes").alias("i", "n")).join(at, "n").groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda x: x["p"]).alias("line"))
    best = best.join(line, "query_id")
    enter, leave = (F.struct(F.col(f"lat_{s}").alias("lat"), F.col(f"lon_{s}").alias("lon")) for s in "ab")
    geometry = F.concat(F.when(F.element_at("line", 1) == enter, F.array().cast("array<struct<lat:double,lon:double>>")).otherwise(F.array(enter)), F.col("line"), F.when(F.element_at("line", -1) == leave, F.array().cast("array<struct<lat:double,lon:double>>")).otherwise(F.array(leave)))
    best = best.select("query_id", F.lit("OK").alias("status"), F.col("node_a").alias("start_node"), F.col("node_b").alias("end_node"), "distance", "duration", F.col("snap_m_a").alias("start_snap_m"), F.col("snap_m_b").alias("end_snap_m"), geometry.alias("geometry"))
    return q.select("query_id").join(best, "query_id", "left").withColumn("status", F.coalesce("status", F.lit("NONE")))


def smoke_test(points: DataFrame, nodes: DataFrame, edges: DataFrame, want: int = 20, separations: tuple[int, ...] = (40, 80, 160)) -> DataFrame:
    """``separation, from_id, to_id, status, distance`` of routes between numbered places (``no, id, lat, lon``) a number of places apart.

    For each separation pairs are taken at strides of half of it; of all pairs the first ``want`` with a route are the test.
    """
    pairs = None
    for s in separations:
        own = points.filter(F.col("no") % max(s // 2, 1) == 0).select(F.col("no").alias("a"), F.lit(s).alias("separation"))
        pairs = own if pairs is None else pairs.unionByName(own)
    end = lambda x, no: points.select(F.col("no").alias(no), F.col("id").alias(f"{x}_id"), F.col("lat").alias(f"{x}_lat"), F.col("lon").alias(f"{x}_lon"))
    pairs = pairs.withColumn("b", F.col("a") + F.col("separation")).join(end("from", "a"), "a").join(end("to", "b"), "b").withColumn("query_id", F.xxhash64("separation", "a"))
    pairs = written(pairs, "snapping-smoke")
    found = routed(pairs.select("query_id", "from_lat", "from_lon", "to_lat", "to_lon"), nodes, edges)
    return pairs.join(found.filter("status = 'OK'"), "query_id").select("separation", "a", "from_id", "to_id", "status", "distance").orderBy("separation", "a").limit(want).drop("a")
