"""Reference builders, snapping, readers and writers on small hand-made networks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from trajkit.operators import arrays, checks, quantiles, relations, reports, snapping, spatial, synthesis
from trajkit.plans import drive
from trajkit.sinks import files as sinks
from trajkit.sources import reference


def rail(spark):
    """Two subway relations of one track of 12 nodes, there and back, one with a missing way, and a bus relation."""
    tags = {"type": "route", "route": "subway", "ref": " 5 "}
    rel = [(1, {**tags, "from": "A", "to": "D", "name": "there"}), (2, {**tags, "name": "back"}), (3, {**tags, "name": "torn"}), (4, {"type": "route", "route": "bus"})]
    nodes = [(100 + i, 37.5, 127.0 + 0.001 * i, {}) for i in range(12)]
    names = {200: (100, "A"), 201: (104, "B"), 202: (108, "C"), 203: (111, "D")}
    nodes += [(k, 37.5003, 127.0 + 0.001 * (n - 100), {"railway": "station" if k != 201 else "halt", "name": s}) for k, (n, s) in names.items()]
    nodes += [(300, 37.5, 127.0, {"amenity": "cafe"}), (301, 37.6, 127.0, {"public_transport": "stop_position"})]
    ways = [(10, [100, 101, 102, 103, 104]), (11, [108, 107, 106, 105, 104]), (12, [108, 109, 110, 111])]
    there = [("n", 200), ("w", 10), ("n", 201), ("n", 300), ("w", 11), ("n", 202), ("n", 201), ("w", 12), ("n", 203)]
    back = [("n", 203), ("n", 202), ("n", 201), ("n", 200), ("w", 12), ("w", 11), ("w", 10)]
    torn = [("n", 200), ("w", 10), ("w", 99), ("n", 203), ("n", 301), ("w", 12)]
    members = [(r, i, t, ref, "") for r, own in ((1, there), (2, back), (3, torn), (4, back)) for i, (t, ref) in enumerate(own)]
    return (
        spark.createDataFrame(rel, "relation long, tags map<string,string>"),
        spark.createDataFrame(members, "relation long, place int, type string, ref long, role string"),
        spark.createDataFrame(ways, "way long, refs array<long>"),
        spark.createDataFrame(nodes, "id long, lat double, lon double, tags map<string,string>"),
    )


def test_rail_reference(spark):
    rel, members, ways, nodes = rail(spark)
    got = {r.relation: r for r in relations.rail_reference(rel, members, ways, nodes).collect()}
    assert set(got) == {1, 2, 3}
    assert [s.name for s in got[1].station_sequence] == ["A", "B", "C", "D"] and got[1].line == "5"
    assert (got[1].status, got[1].missing_ways, got[1].routing_failures, list(got[1].track)) == ("PASS", 0, 0, list(range(100, 112)))
    assert list(got[2].track) == list(range(111, 99, -1)) and got[2].status == "PASS"
    assert (got[3].missing_ways, got[3].unmatched, got[3].geometry_continuity, got[3].station_ordering, got[3].status) == (1, 1, "FAIL", "FAIL", "FAIL")
    length = sum(r.d for r in spark.createDataFrame([(127.0 + 0.001 * i,) for i in range(11)], "x double").select(spatial.haversine(F.lit(37.5), F.col("x"), F.lit(37.5), F.col("x") + 0.001).alias("d")).collect())
    assert abs(got[1].length_m - length) < 0.01
    both = relations.both_directions(relations.rail_reference(rel, members, ways, nodes), "5").first()
    assert (both.relations, both.reverse_pairs, both.status) == (2, 1, "PASS")
    assert {r.way for r in relations.wanted_ways(members, ways, rel.filter("relation = 3")).collect()} == {10, 12}


def test_stitched_ways(spark):
    _, members, ways, _ = rail(spark)
    got = {r.relation: r for r in relations.stitched(members, ways).collect()}
    assert (list(got[1].refs), got[1].missing, got[1].breaks) == (list(range(100, 112)), 0, 0)
    assert (got[3].missing, got[3].breaks) == (1, 1)


def grid(spark, n=8):
    """A road graph of n x n crossings about 90 m apart, both directions."""
    at = lambda i, j: (37.5 + 0.0008 * i, 127.0 + 0.001 * j)
    nodes = [(i * n + j, *at(i, j)) for i in range(n) for j in range(n)]
    places = {k: (lat, lon) for k, lat, lon in nodes}
    steps = [(i * n + j, (i + a) * n + j + b) for i in range(n) for j in range(n) for a, b in ((0, 1), (1, 0)) if i + a < n and j + b < n]
    edges = [(0, a, b, 1000 + k, *places[a], *places[b]) for k, (x, y) in enumerate(steps) for a, b in ((x, y), (y, x))]
    e = spark.createDataFrame(edges, "region long, src long, dst long, way long, src_lat double, src_lon double, dst_lat double, dst_lon double")
    e = e.withColumn("length_m", spatial.haversine(*(F.col(c) for c in ("src_lat", "src_lon", "dst_lat", "dst_lon")))).withColumn("speed", F.lit(10.0))
    return spark.createDataFrame(nodes, "id long, lat double, lon double"), e


def test_candidates_and_routes_between_places(spark):
    nodes, edges = grid(spark)
    points = spark.createDataFrame([(1, 37.5001, 127.0004), (2, 37.9, 127.9)], "id long, lat double, lon double")
    found = snapping.candidates(points, nodes, edges, 200.0).orderBy("rank").collect()
    assert {r.id for r in found} == {1} and len(found) <= 10 and [r["rank"] for r in found] == list(range(1, len(found) + 1))
    assert {found[0].node, found[1].node} == {0, 1} and abs(found[0].snap_m - 11.1) < 0.2 and abs(found[0].lat - 37.5) < 1e-9
    q = spark.createDataFrame([(5, 37.5001, 127.0004, 37.5001, 127.0044), (6, 37.5, 127.0, 38.9, 127.0)], "query_id long, from_lat double, from_lon double, to_lat double, to_lon double")
    got = {r.query_id: r for r in snapping.routed(q, nodes, edges, 200.0).collect()}
    assert got[6].status == "NONE" and got[5].status == "OK"
    assert (got[5].start_node, got[5].end_node) == (0, 4) and abs(got[5].distance - 4 * 88.2) < 2
    assert (got[5].geometry[0].lat, got[5].geometry[-1].lat) == (37.5, 37.5) and len(got[5].geometry) == 7 and got[5].start_snap_m < 12
    rows = [(k, k, 37.5 + 0.0008 * (k // 8), 127.0 + 0.001 * (k % 8)) for k in range(64)]
    tests = snapping.smoke_test(spark.createDataFrame(rows, "no long, id long, lat double, lon double"), nodes, edges, want=5, separations=(10, 20)).collect()
    assert len(tests) == 5 and all(r.status == "OK" and r.to_id - r.from_id == r.separation for r in tests)


def test_bus_reference(spark):
    _, edges = grid(spark)
    stops = [("a", 1, "s1", 0), ("a", 2, "s2", 3), ("a", 3, "s3", 19), ("b", 1, "t1", 0), ("b", 2, "t2", None), ("b", 3, "t3", 5), ("c", 1, "u1", 7), ("c", 1, "u2", 9), ("c", 3, "u3", 900)]
    got = {r.route: r for r in relations.bus_reference(spark.createDataFrame(stops, "route string, no int, stop string, node long"), edges).collect()}
    assert (got["a"].status, got["a"].pairs, got["a"].routed, got["a"].coverage, got["a"].reasons) == ("PASS", 2, 2, 1.0, "")
    assert (got["b"].status, got["b"].routed, got["b"].reasons) == ("FAIL", 0, "stop without road")
    assert got["c"].duplicate_numbers == 1 and got["c"].reasons == "no road between stops"
    new = relations.replaced(spark.createDataFrame([("a", 1), ("b", 2)], "route string, n int"), spark.createDataFrame([("b", 3), ("c", 4)], "route string, n int"), "route")
    assert {tuple(r) for r in new.collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_exact_percentiles(spark):
    rnd = random.Random(2)
    rows = [("a", rnd.lognormvariate(0, 3)) for _ in range(5000)] + [("b", 7.0)] * 400 + [("b", None), ("c", 3.0)] + [("d", float(i % 5)) for i in range(999)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in quantiles.percentiles(df, "g", "v", {"mid": (0.5, True), "high": (0.95, False), "least": (0.0, True), "most": (1.0, False)}).collect()}
    for g in "abcd":
        own = sorted(v for k, v in rows if k == g and v is not None)
        place = 0.5 * (len(own) - 1)
        k = int(place)
        mid = own[k] + (own[min(k + 1, len(own) - 1)] - own[k]) * (place - k)
        high = own[max(-(-95 * len(own) // 100) - 1, 0)]
        assert (got[g].mid, got[g].high, got[g].least, got[g].most) == (pytest.approx(mid, abs=1e-12), high, own[0], own[-1])
    assert quantiles.percentiles(df.limit(0), "g", "v", {"x": (0.5, True)}).count() == 0


def test_arrays(spark):
    df = spark.createDataFrame([([1, 2, 3, 2], [2, 3], [3, 2, 1]), ([1, 2], [], [1, 5]), ([1], [1, 2], [1])], "a array<int>, b array<int>, c array<int>")
    got = df.select(arrays.has_run(F.col("a"), F.col("b")), arrays.in_order(F.col("c"), F.col("a")), arrays.in_order(F.col("b"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (True, False, True), (False, True, False)]


def test_reference_readers(spark, tmp_path):
    net = {"stations": [{"name": "A", "lat": 37.5, "lon": 127.0, "osm_id": 1, "line_id": "5"}], "bus_routes": [], "surface_corridors": [{"corridor_id": "c", "source": "s", "geometry": [[1.0, 2.0]]}]}
    (tmp_path / "net.json").write_text(json.dumps(net))
    frames = reference.network(spark, str(tmp_path / "net.json"))
    assert frames["stations"].first().name == "A" and frames["bus_routes"].count() == 0 and frames["surface_corridors"].count() == 1
    net["stations"][0]["lat"] = 95.0
    (tmp_path / "bad.json").write_text(json.dumps(net))
    with pytest.raises(Exception, match="place on the globe"):
        reference.network(spark, str(tmp_path / "bad.json"))["stations"].collect()
    station = {"name": "A", "lat": 37.5, "lon": 127.0, "osm_id": 1}
    line = lambda i, n, status: {"line_id": "5", "relation_id": i, "geometry": [], "station_sequence": [station] * n, "validation": {"status": status}}
    (tmp_path / "rail_network.json").write_text(json.dumps({"lines": [line(1, 3, "PASS"), line(2, 2, "PASS"), line(3, 3, "FAIL")]}))
    kept = reference.rail_catalog(spark, str(tmp_path / "rail_network.json"))
    assert [r.relation_id for r in kept.collect()] == [1] and reference.line_stops(kept, "rail").count() == 3
    pair = {"distance_m": 1.0, "geometry": [[1.0, 2.0]]}
    route = lambda i, pairs: {"route_uid": i, "stops": [{"ars_id": str(k), "sequence": k} for k in range(3)], "pair_geometry": pairs, "validation": {"status": "PASS"}}
    (tmp_path / "bus_network.json").write_text(json.dumps({"routes": [route(1, [pair, pair]), route(2, [pair]), route(3, [pair, {"distance_m": 1.0, "geometry": []}])]}))
    assert [r.route_uid for r in reference.bus_catalog(spark, str(tmp_path / "bus_network.json")).collect()] == [1]
    nodes, edges = grid(spark, 3)
    for mode in ("walk", "bike", "car"):
        sinks.write_graph({"nodes": nodes, "edges": edges} | ({"restrictions": spark.createDataFrame([(0, 1, 2, 3)], "region long, from_way long, via long, to_way long")} if mode == "car" else {}), str(tmp_path / "graphs"), mode)
    held = reference.context(spark, str(tmp_path))
    assert held["car_restrictions"].count() == 1 and held["walk_restrictions"].count() == 0 and held["bike_nodes"].count() == 9
    rows = spark.createDataFrame([("7", "2", " 12 ", "x", "37.5", "127"), ("7", "?", "13", "y", "n/a", None)], "route_id string, sequence string, ars_id string, name string, lat string, lon string")
    stops = reference.stop_rows(rows)
    assert [tuple(r) for r in stops.collect()] == [("7", 2, "12", "x", 37.5, 127.0), ("7", None, "13", "y", None, None)]
    assert tuple(reference.coordinate_coverage(stops).first()) == (2, 1, 37.5, 37.5, 127.0, 127.0)
    assert [r.ars_id for r in reference.candidate_points(stops).collect()] == ["12"]
    again = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "osm_id long, name string, place int")
    assert {tuple(r) for r in reference.distinct_stations(again).collect()} == {(1, "b", 2), (2, "c", 1)}
    named = reference.anchored(spark.createDataFrame([("r", 0, "A"), ("r", 1, "zz")], "route string, place int, name string"), spark.createDataFrame([("A", 2, 1.0, 2.0), ("A", 1, 3.0, 4.0)], "name string, id int, lat double, lon double"), spark.createDataFrame([(0, 9.0, 9.0)], "no long, lat double, lon double"), 1)
    assert sorted(tuple(r) for r in named.collect()) == [("r", 1, "A", 3.0, 4.0), ("r", 2, "zz", 9.0, 9.0)]
    assert reference.config_hash({"b": 1, "a": [1]}) == reference.config_hash({"a": [1], "b": 1})


def test_package_is_written_frozen_and_guarded(spark, sf, tmp_path):
    cat, data = drive.dataset(spark, sf)
    path = str(tmp_path / "package")
    moved, events = synthesis.transfers(data.segments), synthesis.timeline_events(data.points)
    sinks.write_package(path, data, events, moved, {"seed": "42026"})
    truth = spark.read.json(f"{path}/ground_truth")
    assert truth.count() == data.trips.count() and truth.filter("size(segments) = 0 OR origin IS NULL").count() == 0
    assert truth.selectExpr("explode(segments) AS s").count() == data.segments.count()
    manifest = spark.read.json(f"{path}/manifests/dataset").first()
    assert (manifest.journey_count, manifest.gps_event_count, manifest.seed) == (data.trips.count(), data.fixes.count(), "42026")
    line = spark.read.text(f"{path}/gps").filter("value LIKE '2.0,%'").first().value.split(",")
    assert [len(x.split(".")[1]) for x in line[5:12]] == [7, 7, 2, 2, 2, 3, 2]
    with pytest.raises(Exception, match="already exists"):
        sinks.write_package(path, data, events, moved, {})
    ok = spark.createDataFrame([("PASS",)], "status string")
    with pytest.raises(ValueError, match="of 0 checks"):
        sinks.freeze(spark, path, ok.limit(0), {})
    with pytest.raises(ValueError, match="gate"):
        sinks.freeze(spark, path, ok, {}, spark.createDataFrame([("FAIL",)], "status string"))
    sinks.freeze(spark, path, ok, {"commit": "x"}, ok)
    assert {r.state for r in sinks.integrity(spark, path).select("state").distinct().collect()} == {"same"}
    rows = checks.rolled_up(checks.fix_checks(checks.Package.of(data, cat)))
    sinks.write_checks(rows.withColumn("scope", F.lit("trip")), str(tmp_path / "validation"))
    assert spark.read.csv(str(tmp_path / "validation/segment"), header=True).count() == 0
    sinks.write_pages(reports.pages(data.fixes), str(tmp_path / "pages"))
    assert spark.read.text(str(tmp_path / "pages")).count() == data.trips.count()
    found = reports.artifacts(spark, str(tmp_path / "pages"), ["nothing.json", "_SUCCESS"]).collect()
    assert {(r.name, r.present) for r in found} == {("nothing.json", False), ("_SUCCESS", False)}
    told = reports.provenance(spark, f"{path}/manifests/dataset", {}).collect()
    assert all(r.sha256 and r.bytes > 0 for r in told)
    sinks.write_network(spark.createDataFrame([(1, [2.0])], "route int, geometry array<double>"), str(tmp_path / "net"), ("geometry",))
    assert spark.read.csv(str(tmp_path / "net/validation"), header=True).columns == ["route"]
