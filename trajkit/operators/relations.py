"""Reference networks from map relations: rail lines with stations, bus routes between stops, stitched ways.

Tables: ``relations`` (relation, tags), ``members`` (relation, place, type, ref, role), ``ways`` (way, refs
array<long>), ``nodes`` (id, lat, lon, tags). A relation is one task's work where its members must be taken
in order; relations are bounded by their length.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajkit.operators import routing, spatial
from trajkit.session import written

#: What makes a node a stop, how far a station may lie from its line, and reasons for a failed route.
STOPS = ("station", "stop", "halt")
JOIN_M = 250.0


def rail_relations(relations: DataFrame, kinds: tuple[str, ...] = ("subway",)) -> DataFrame:
    """Relations of type route whose ``route`` tag is one of the kinds, with their line, direction and name."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    kept = relations.filter((tag("type") == "route") & tag("route").isin(*kinds))
    return kept.select("relation", F.trim(F.coalesce(tag("ref"), F.lit(""))).alias("line"), tag("route").alias("route"), tag("from").alias("direction_from"), tag("to").alias("direction_to"), tag("name").alias("name"))


def wanted_ways(members: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """The ways that the relations refer to, and no other."""
    asked = members.filter("type = 'w'").join(relations.select("relation"), "relation", "left_semi").select(F.col("ref").alias("way")).distinct()
    return ways.join(asked, "way", "left_semi")


def station_sequence(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``relation, no, ref, name, lat, lon``: the stops among a relation's node members, each at its first place, numbered from 0."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    stop = tag("railway").isin(*STOPS) | (tag("public_transport") == "stop_position")
    known = nodes.filter(F.coalesce(stop, F.lit(False))).select(F.col("id").alias("ref"), F.coalesce(tag("name"), F.col("id").cast("string")).alias("name"), "lat", "lon")
    first = members.filter("type = 'n'").groupBy("relation", "ref").agg(F.min("place").alias("place"))
    no = F.row_number().over(Window.partitionBy("relation").orderBy("place")) - 1
    return first.join(known, "ref").select("relation", no.alias("no"), "ref", "name", "lat", "lon")


def relation_edges(members: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """``region, src, dst, way, length_m, speed`` and the ends' places: the undirected graph of each relation's ways, both directions, no zero lengths."""
    own = members.filter("type = 'w'").select("relation", F.col("ref").alias("way")).distinct().join(ways, "way")
    step = F.arrays_zip(F.expr("slice(refs, 1, size(refs) - 1)").alias("a"), F.expr("slice(refs, 2, size(refs) - 1)").alias("b"))
    hops = own.filter("size(refs) > 1").select("relation", "way", F.explode(step).alias("h")).select("relation", "way", "h.a", "h.b")
    at = lambda n: nodes.select(F.col("id").alias(n), F.col("lat").alias(f"{n}_lat"), F.col("lon").alias(f"{n}_lon"))
    full = hops.join(at("a"), "a").join(at("b"), "b").withColumn("length_m", spatial.haversine(*(F.col(c) for c in ("a_lat", "a_lon", "b_lat", "b_lon")))).filter("length_m > 0")
    ends = lambda p, q: [F.col("relation").alias("region"), F.col(p).alias("src"), F.col(q).alias("dst"), "way", "length_m", F.lit(1.0).alias("speed"), F.col(f"{p}_lat").alias("src_lat"), F.col(f"{p}_lon").alias("src_lon"), F.col(f"{q}_lat").alias("dst_lat"), F.col(f"{q}_lon").alias("dst_lon")]
    return full.select(*ends("a", "b")).unionByName(full.select(*ends("b", "a")))


def missing_ways(members: DataFrame, ways: DataFrame) -> DataFrame:
    """``relation, missing``: how many way members have no way."""
    asked = members.filter("type = 'w'").select("relation", F.col("ref").alias("way")).join(ways.select("way", F.lit(1).alias("there")), "way", "left")
    return asked.groupBy("relation").agg(F.count_if(F.col("there").isNull()).alias("missing"))


def stitched(members: DataFrame, ways: DataFrame) -> DataFrame:
    """``relation, refs, missing, breaks``: the ways of a relation joined in order, one turned round where only its end meets what is before."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        line: list[int] = []
        missing = breaks = 0
        for refs in part.sort_values("place").refs:
            if refs is None or not len(refs):
                missing += 1
                continue
            way = list(refs)
            if line and way[0] != line[-1]:
                if way[-1] == line[-1]:
                    way.reverse()
                else:
                    breaks += 1
            line += way[1:] if line and way[0] == line[-1] else way
        return pd.DataFrame({"relation": [part.relation.iloc[0]], "refs": [line], "missing": [missing], "breaks": [breaks]})

    own = members.filter("type = 'w'").select("relation", "place", F.col("ref").alias("way")).join(ways, "way", "left").select("relation", "place", "refs")
    return own.groupBy("relation").applyInPandas(run, "relation long, refs array<long>, missing int, breaks int")


def nearest_node(points: DataFrame, nodes: DataFrame, most_m: float = JOIN_M) -> DataFrame:
    """``key, region, node, dist`` of the nearest node of its own region for each point (``key, region, lat, lon``); null beyond ``most_m``.

    ``nodes``: ``region, node, lat, lon``. A station of a relation meets that relation's nodes only.
    """
    met = points.join(nodes.select("region", "node", F.col("lat").alias("nlat"), F.col("lon").alias("nlon")), "region")
    met = met.withColumn("d", spatial.haversine(F.col("lat"), F.col("lon"), F.col("nlat"), F.col("nlon")))
    best = met.groupBy("key", "region").agg(F.min(F.struct("d", "node")).alias("m"))
    return points.select("key", "region").join(best, ["key", "region"], "left").select("key", "region", F.when(F.col("m.d") <= most_m, F.col("m.node")).alias("node"), F.col("m.d").alias("dist"))


def routed_pairs(pairs: DataFrame, edges: DataFrame, restrictions: DataFrame | None = None) -> DataFrame:
    """``pairs`` (region, src, dst and more) with ``status, distance, nodes`` of the shortest route; equal pairs are searched once."""
    once = pairs.filter("src IS NOT NULL AND dst IS NOT NULL").select("region", "src", "dst").distinct()
    once = written(once.withColumn("query_id", F.xxhash64("region", "src", "dst")), "relations-pairs")
    found = written(routing.routes(edges, once, restrictions).join(once, "query_id").select("region", "src", "dst", "status", "distance", "nodes"), "relations-routes")
    return pairs.join(found, ["region", "src", "dst"], "left").withColumn("status", F.coalesce("status", F.lit("NONE")))


def rail_reference(relations: DataFrame, members: DataFrame, ways: DataFrame, nodes: DataFrame, kinds: tuple[str, ...] = ("subway",)) -> DataFrame:
    """A row a rail relation: its stations, the route of its tracks through all of them, and whether it holds.

    Continuity holds where no way is missing and every pair of neighbouring stations has a route; the order
    of stations holds where there are two at least, no two neighbours share a place and each lies within 250 m
    of the tracks.
    """
    lines = written(rail_relations(relations, kinds), "relations-lines")
    members = written(members.join(lines.select("relation"), "relation", "left_semi"), "relations-members")
    stations = written(station_sequence(members, nodes), "relations-stations")
    edges = written(relation_edges(members, ways, nodes), "relations-edges")
    tracks = edges.select("region", F.col("src").alias("node"), F.col("src_lat").alias("lat"), F.col("src_lon").alias("lon")).distinct()
    joined = nearest_node(stations.select(F.col("no").alias("key"), F.col("relation").alias("region"), "lat", "lon"), tracks)
    stations = written(stations.join(joined.select(F.col("key").alias("no"), F.col("region").alias("relation"), "node", "dist"), ["relation", "no"]), "relations-joined")
    w = Window.partitionBy("relation").orderBy("no")
    nxt = F.lead(F.struct("node", "lat", "lon")).over(w)
    pairs = stations.withColumn("nx", nxt).filter("nx IS NOT NULL").select(F.col("relation").alias("region"), "no", F.col("node").alias("src"), F.col("nx.node").alias("dst"), spatial.haversine(F.col("lat"), F.col("lon"), F.col("nx.lat"), F.col("nx.lon")).alias("apart"))
    found = routed_pairs(pairs, edges)
    by_pair = found.groupBy(F.col("region").alias("relation")).agg(
        F.count_if(F.col("status") != "OK").alias("failures"),
        F.bool_and(F.col("apart") > 0).alias("distinct_places"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "OK", F.struct("no", "nodes", "distance")))).alias("paths"),
    )
    by_station = stations.groupBy("relation").agg(F.count("*").alias("stations"), F.count_if(F.col("node").isNull()).alias("unmatched"), F.bool_and(F.coalesce(F.col("dist") <= JOIN_M, F.lit(False))).alias("near"), F.transform(F.array_sort(F.collect_list(F.struct("no", "name", "lat", "lon"))), lambda s: F.struct(s["name"].alias("name"), s["lat"].alias("lat"), s["lon"].alias("lon"))).alias("station_sequence"))
    out = lines.join(by_station, "relation", "left").join(by_pair, "relation", "left").join(missing_ways(members, ways), "relation", "left")
    # paths follow each other; a joint is named once
    nodes_of = F.aggregate("paths", F.array().cast("array<long>"), lambda a, p: F.concat(a, F.when((F.size(a) > 0) & (F.size(p["nodes"]) > 0) & (F.try_element_at(a, F.lit(-1)) == F.try_element_at(p["nodes"], F.lit(1))), F.slice(p["nodes"], 2, F.greatest(F.size(p["nodes"]) - 1, F.lit(0)))).otherwise(p["nodes"])))
    whole = (F.coalesce("missing", F.lit(0)) == 0) & (F.coalesce("failures", F.lit(0)) == 0) & (F.size("track") > 0)
    order = (F.coalesce("stations", F.lit(0)) >= 2) & F.coalesce("distinct_places", F.lit(False)) & F.coalesce("near", F.lit(False))
    verdict = lambda c: F.when(c, "PASS").otherwise("FAIL")
    out = out.withColumn("track", F.coalesce(nodes_of, F.array().cast("array<long>"))).withColumn("length_m", F.round(F.coalesce(F.aggregate("paths", F.lit(0.0), lambda t, p: t + p["distance"]), F.lit(0.0)), 3))
    out = out.withColumn("geometry_continuity", verdict(whole)).withColumn("station_ordering", verdict(order)).withColumn("status", verdict(whole & order))
    return out.select("relation", "line", "name", "direction_from", "direction_to", F.coalesce("stations", F.lit(0)).alias("stations"), F.coalesce("unmatched", F.lit(0)).alias("unmatched"), F.coalesce("missing", F.lit(0)).alias("missing_ways"), F.coalesce("failures", F.lit(0)).alias("routing_failures"), "length_m", "geometry_continuity", "station_ordering", "status", "station_sequence", "track")


def both_directions(lines: DataFrame, line: str) -> DataFrame:
    """One row: how many passed relations a line has, and whether two of them have each other's stations in reverse."""
    own = lines.filter((F.col("line") == line) & (F.col("status") == "PASS")).select("relation", F.transform("station_sequence", lambda s: s["name"]).alias("names"))
    back = own.select(F.col("relation").alias("other"), F.reverse("names").alias("names"))
    pairs = own.join(back, "names").filter("relation < other")
    return own.agg(F.count("*").alias("relations")).crossJoin(pairs.agg(F.count("*").alias("reverse_pairs"))).withColumn("status", F.when(F.col("reverse_pairs") > 0, "PASS").otherwise("FAIL"))  # two single rows


def bus_reference(stops: DataFrame, edges: DataFrame, restrictions: DataFrame | None = None, region: Column | None = None) -> DataFrame:
    """A row a bus route (``route, no, stop, node``: a stop's node on the road graph, null where none is near): every pair of neighbours routed.

    Equal pairs of all routes are searched once. A route passes when it has three stops or more and all its
    pairs have a route; else it names its first three reasons in order.
    """
    w = Window.partitionBy("route").orderBy("no")
    pairs = stops.withColumn("dst", F.lead("node").over(w)).withColumn("later", F.lead("no").over(w)).filter("later IS NOT NULL")
    found = routed_pairs(pairs.select("route", "no", (F.lit(0) if region is None else region).cast("long").alias("region"), F.col("node").alias("src"), "dst"), edges, restrictions)
    reason = F.when(F.col("src").isNull() | F.col("dst").isNull(), "stop without road").when(F.col("src") == F.col("dst"), "stops share a node").when(F.col("status") == "LIMIT", "search given up").when(F.col("status") != "OK", "no road between stops")
    found = found.withColumn("reason", reason)
    own = found.groupBy("route").agg(
        F.count("*").alias("pairs"),
        F.count_if(F.col("reason").isNull()).alias("routed"),
        F.round(F.sum(F.when(F.col("reason").isNull(), F.col("distance"))), 3).alias("distance_m"),
        F.array_join(F.slice(F.sort_array(F.collect_set("reason")), 1, 3), "; ").alias("reasons"),
    )
    n = stops.groupBy("route").agg(F.count("*").alias("stops"), (F.count("*") - F.count_distinct("no")).alias("duplicate_numbers"))
    out = n.join(own, "route", "left").na.fill(0, ["pairs", "routed"]).na.fill("", ["reasons"])
    out = out.withColumn("coverage", F.round(F.col("routed") / F.greatest(F.lit(1), F.col("pairs")), 6))
    ok = (F.col("stops") >= 3) & (F.col("pairs") == F.col("routed")) & (F.col("duplicate_numbers") == 0)
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def best_candidates(candidates: DataFrame) -> DataFrame:
    """Of several builds of a route (``route, build, max_snap_m, pairs``) the one with the least largest snap, then the most pairs."""
    return candidates.groupBy("route").agg(F.min_by(F.struct("build", "max_snap_m", "pairs"), F.struct("max_snap_m", -F.col("pairs"), "build")).alias("r")).select("route", "r.*")


def replaced(base: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of ``fresh`` in place of those with the same key, and its new ones added."""
    return base.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)
