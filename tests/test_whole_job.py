"""Queries take every row of their tables: against plain Python on small fixtures, not against their own SQL."""

import datetime
import heapq
import math
import random

import duckdb
import pytest

from trajkit.operators import routing, synthesis
from trajkit.plans import catalogue

DAY = 86_400_000_000
T0 = datetime.datetime(2026, 1, 1)


@pytest.fixture
def tables(tmp_path):
    """Writes small tables and gives their folder."""

    def write(**made):
        c = duckdb.connect()
        for name, (columns, rows) in made.items():
            c.execute(f"CREATE TABLE {name} ({columns})")
            c.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
            c.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        return str(tmp_path)

    return write


def events(rows):
    """From ``user_id, event_id, seconds``."""
    columns = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR"
    return columns, [(e, T0 + datetime.timedelta(seconds=s), u, "view", 10.0, "{}") for u, e, s in rows]


def result(spark, folder, name):
    return [tuple(r) for r in catalogue.QUERIES[name](spark, folder).collect()]


def test_near_signatures_tell_trips_apart_that_part_after_the_third_fix(spark, tables):
    same = [(u, e, 10 * e) for u in (1, 2, 3) for e in (1, 2, 3)]
    folder = tables(events=events([*same, (1, 4, 40), (2, 5, 40), (3, 4, 40)]))
    assert sorted((n, first) for _, n, first in result(spark, folder, "near_signatures")) == [(1, 2), (2, 1)]


def lineitem(rows):
    """From ``order, part, supplier, line, quantity``."""
    columns = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE"
    return columns, [(*r, 1.0) for r in rows]


def shortest(links, src, dst):
    reached, at = {src: 0}, [(0, src)]
    while at:
        d, node = heapq.heappop(at)
        for nxt, length in links[node].items():
            if d + length < reached.get(nxt, float("inf")):
                reached[nxt] = d + length
                heapq.heappush(at, (d + length, nxt))
    return reached[dst]


def test_graph_queries_take_every_stop_and_only_adjacent_ones(spark, tables):
    rnd = random.Random(8)
    routes = [[rnd.randrange(40) for _ in range(rnd.randint(1, 6))] for _ in range(30)] + [[100, 101, 102, 103], [104]]
    folder = tables(lineitem=lineitem([(o, stop, 1, i, rnd.randint(1, 50)) for o, way in enumerate(routes) for i, stop in enumerate(way)]))
    edges = {(min(p), max(p)) for way in routes for p in zip(way, way[1:], strict=False) if p[0] != p[1]}
    links = {n: {} for e in edges for n in e}
    for a, b in edges:
        links[a][b] = links[b][a] = 1 + (a * 31 + b) % 9
    group = {n: n for n in links}
    for _ in links:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    far = {a: max((c for b in links[a] for c in links[b] if c != a), default=None) for a in links}
    want = {(a, shortest(links, a, c)) for a, c in far.items() if c is not None}
    assert set(result(spark, folder, "graph_edges")) == edges
    assert result(spark, folder, "graph_stats") == [(len(edges), len(links), max(map(len, links.values())))]
    assert set(result(spark, folder, "connected_components")) == set(group.items())
    assert set(result(spark, folder, "shortest_distances")) == want
    assert set(result(spark, folder, "shortest_routes")) == {(a, "OK", d) for a, d in want}


def shuffled(spark, work):
    """Rows that ``work`` put through exchanges."""
    store = spark.sparkContext._jsc.sc().statusStore()
    no = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, no, None))}
    before = set(stages())
    got = work()
    return got, sum(n for s, n in stages().items() if s not in before)


def star(leaves):
    """Stops 1, 2, ... that all meet stop 0 only, so any two of them are two hops apart."""
    length = {n: 1 + n % 9 for n in range(1, leaves + 1)}
    want = {(n, length[n] + length[leaves if n < leaves else leaves - 1]) for n in length}
    return lineitem([(n, stop, 1, i, 1) for n in length for i, stop in enumerate((0, n))]), want


def test_routes_make_no_pairs_of_the_hops_of_a_stop(spark, tables):
    leaves = 600
    rows, want = star(leaves)
    folder = tables(lineitem=rows)
    got, moved = shuffled(spark, lambda: result(spark, folder, "shortest_routes"))
    assert set(got) == {(a, "OK", d) for a, d in want} and len(got) == leaves
    assert moved < 60 * leaves


def test_distances_hold_no_label_for_every_stop_within_reach(spark, tables):
    leaves = 600
    rows, want = star(leaves)
    folder = tables(lineitem=rows)
    got, moved = shuffled(spark, lambda: result(spark, folder, "shortest_distances"))
    assert set(got) == want and len(got) == leaves
    assert moved < 60 * leaves


def test_distances_in_tasks_equal_those_by_joins(spark, monkeypatch):
    rnd = random.Random(14)
    links = [(base + rnd.randrange(30), base + rnd.randrange(30), float(rnd.randint(0, 9))) for base in (0, 100) for _ in range(90 + base)]
    asked = [(i, rnd.choice((0, 100)) + rnd.randrange(32), rnd.choice((0, 100)) + rnd.randrange(32)) for i in range(300)] + [(300, 999, 999)]
    edges, queries = spark.createDataFrame(links, "src long, dst long, length double"), spark.createDataFrame(asked, "query_id long, src long, dst long")
    out = {}
    for a, b, n in links:
        out.setdefault(a, {})[b] = min(n, out.get(a, {}).get(b, n))
    for node in {n for a, b, _ in links for n in (a, b)}:
        out.setdefault(node, {})
    want = {(i, d) for i, a, b in asked if (d := 0 if a == b else shortest_or_none(out, a, b)) is not None and d <= 14}
    for most in (2_000_000, 120, 0):
        monkeypatch.setattr(routing, "IN_TASK", most)
        assert {tuple(r) for r in routing.distances(edges, queries, 14.0).collect()} == want


def shortest_or_none(links, src, dst):
    try:
        return shortest(links, src, dst)
    except KeyError:
        return None


def test_mode_sequences_take_all_segments(spark, tables):
    days = {1: range(6), 2: range(6), 3: [0, 1, 2, 3, 5]}
    folder = tables(events=events([(u, 10 * u + k, 86400 * k) for u, own in days.items() for k in own]))
    first = int((T0 - datetime.datetime(1970, 1, 1)).days)
    modes = [">".join(["walk", "bike", "car", "bus", "rail"][(u + first + k) % 5] for k in own) for u, own in days.items()]
    assert sorted(result(spark, folder, "mode_sequence_histogram")) == sorted((m, modes.count(m)) for m in set(modes))


def test_hard_cases_come_at_every_stride_without_an_upper_bound(spark, tables):
    folder = tables(customer=("c_custkey BIGINT", [(k,) for k in range(1500)]))
    want = set()
    for k in range(1500):
        category, offset = synthesis.CATEGORIES[k % 6], k // 6
        if offset % 20 == 0:
            own = synthesis.HARD_CASES[category]
            want.add((k, category, offset, own[offset % len(own)]))
    assert set(result(spark, folder, "hard_case_schedule")) == want


def test_usage_and_shared_stops_take_all_line_items(spark, tables):
    rnd = random.Random(4)
    rows = [(rnd.randrange(20), rnd.randrange(12), rnd.randrange(6), i, rnd.randint(1, 50)) for i in range(60)] + [(50, 90, 6, 0, 1), (51, 90, 7, 0, 1)]
    folder = tables(lineitem=lineitem(rows), supplier=("s_suppkey BIGINT", [(s,) for s in range(9)]))
    uses = {s: [o for o, _, own, *_ in rows if own == s] for s in range(9)}
    assert set(result(spark, folder, "route_usage")) == {(s, len(o), len(set(o)), bool(o)) for s, o in uses.items()}
    names = {s: {part for _, part, own, *_ in rows if own == s} for s in range(9)}
    shared = {(a, b, len(names[a] & names[b])) for a in names for b in names if a < b}
    assert set(result(spark, folder, "journeys_at_transfer_names")) == {x for x in shared if x[2]}


def metres(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


def test_resampled_lines_have_a_point_every_35_m_and_both_ends(spark, tables):
    trips = {1: [0, 1], 2: [3, 3, 7, 11], 3: [5, 5], 4: [6]}
    folder = tables(events=events([(u, e, i) for u, own in trips.items() for i, e in enumerate(own)]))
    want = {}
    for u, own in trips.items():
        line = [(37.45 + e * 7919 % 10000 * 1e-5, 126.9 + e * 104729 % 10000 * 1e-5) for e in own]
        points, left = [line[0]] if len(line) > 1 else [], 35.0
        for a, b in zip(line, line[1:], strict=False):
            while left <= (long := metres(a, b)) and long:
                points.append((a[0] + left / long * (b[0] - a[0]), a[1] + left / long * (b[1] - a[1])))
                left += 35.0
            left -= long
        points += [line[-1]] if points and points[-1] != line[-1] else []
        want |= {(f"trip_{u:06d}", k): p for k, p in enumerate(points)}
    got = {(trip, k): (lat, lon) for trip, k, lat, lon in result(spark, folder, "polyline_resample")}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 6e-6 for k, p in want.items() for x, y in zip(p, got[k], strict=True))


def test_times_outside_all_segments_get_the_nearest_one(spark, tables):
    # segments of user 1: day 0 from 1 h to 2 h, day 1 from 1 h to 6 h, day 3 at 1 h; probes come an hour after each fix
    fixes = [(1, 0, 3600), (1, 1, 7200), (1, 2, 86400 + 3600), (1, 3, 86400 + 21600), (1, 4, 3 * 86400 + 3600), (2, 5, 0), (2, 6, 86399), (2, 7, 86400 + 5400)]
    folder = tables(events=events(fixes))
    first, spans = (T0 - datetime.datetime(1970, 1, 1)).days, {}
    for u, _, s in fixes:
        spans.setdefault(u, {}).setdefault(s // 86400, []).append(s)
    want = set()
    for u, e, s in fixes:
        own = [(min(x), max(x), day) for day, x in sorted(spans[u].items())]
        inside = [k for k, (a, b, _) in enumerate(own) if a <= s + 3600 <= b]
        k = inside[0] if inside else min(range(len(own)), key=lambda i: min(abs(s + 3600 - own[i][0]), abs(s + 3600 - own[i][1])))
        want.add((e, k, ["walk", "bike", "car", "bus", "rail"][(u + first + own[k][2]) % 5]))
    assert set(result(spark, folder, "mode_at_interval")) == want


def test_a_tie_between_segments_goes_to_the_first(spark, tables):
    # the probe of fix 0, at 23 h, is an hour after it and an hour before fix 1
    folder = tables(events=events([(1, 0, 22 * 3600), (1, 1, 24 * 3600)]))
    assert {(e, k) for e, k, _ in result(spark, folder, "mode_at_interval")} == {(0, 0), (1, 1)}


def test_nearest_rows_are_sought_from_a_small_radius_and_equal_brute_force(spark, monkeypatch):
    import random

    from trajkit.operators import spatial

    rnd = random.Random(5)
    a = [(i, 37 + rnd.random() / 100, 127 + rnd.random() / 100) for i in range(300)] + [(300, 37.06, 127.06)]
    b = [(i, 37 + rnd.random() / 100, 127 + rnd.random() / 100) for i in range(800)] + [(800 + i, 37.005, 127.005) for i in range(20)]
    radii, real = [], spatial.within
    monkeypatch.setattr(spatial, "within", lambda left, right, radius, k=None, **more: radii.append(radius) or real(left, right, radius, k, **more))
    frame = lambda rows: spark.createDataFrame(rows, "id long, lat double, lon double")
    got = sorted((r.left_id, r["rank"], r.right_id) for r in spatial.within(frame(a), frame(b), 20_000.0, k=3).collect())
    pairs = frame(a).crossJoin(frame(b).toDF("right_id", "rlat", "rlon")).select("id", "right_id", spatial.haversine(*(spatial.F.col(c) for c in ("lat", "lon", "rlat", "rlon"))).alias("d")).collect()
    near = {}
    for r in sorted(pairs, key=lambda r: (r.id, r.d, r.right_id)):
        near.setdefault(r.id, []).append(r.right_id)
    assert got == sorted((i, n + 1, x) for i, own in near.items() for n, x in enumerate(own[:3]))
    assert radii[1] < 2000 and len(radii) > 3  # the first is the call itself


def test_pairs_carry_columns_of_both_sides(spark):
    from trajkit.operators import spatial

    rows = spark.createDataFrame([(1, 37.0, 127.0, "a"), (2, 37.0005, 127.0, "b"), (3, 38.0, 127.0, None)], "id long, lat double, lon double, line string")
    got = {(r.left_id, r.right_id, r.left_line, r.right_line) for r in spatial.within(rows, rows, 120.0, carry=("line",)).collect()}
    assert got == {(1, 1, "a", "a"), (2, 2, "b", "b"), (1, 2, "a", "b"), (2, 1, "b", "a"), (3, 3, None, None)}


def test_distances_to_lines_equal_the_search_by_cells(spark, monkeypatch):
    import random

    from trajkit.operators import spatial

    F, rnd = spatial.F, random.Random(3)
    place = lambda: (37 + rnd.random() / 20, 127 + rnd.random() / 20)
    lines = spark.createDataFrame([(f"t{i}", 1, [place() for _ in range(n)]) for i, n in enumerate((2, 5, 19, 1, 0))], "trip_id string, leg int, line array<struct<lat:double,lon:double>>")
    points = spark.createDataFrame([(f"t{i % 6}", 1, i, *place()) for i in range(600)], "trip_id string, leg int, idx long, lat double, lon double")
    want = spatial.nearest_segment(points.select(F.col("idx").alias("id"), "trip_id", "leg", "lat", "lon"), spatial.pieces(lines, "trip_id", "leg"), "trip_id", "leg")
    want = {r.id: r.dist for r in want.collect()}
    for most in (65, 4):  # with lines of more than four places by cells
        monkeypatch.setattr(spatial, "PLACES", most)
        got = {r.idx: r.dist for r in spatial.line_distances(points, lines, "trip_id", "leg", id="idx").collect()}
        assert len(got) == 500 and {k for k, d in got.items() if d is not None} == set(want)  # t3 and t4 have no piece, t5 no line
        assert all(abs(got[k] - d) < 1e-6 for k, d in want.items())


def test_only_what_is_asked_for_is_generated_and_motion_is_dealt_out(spark, monkeypatch):
    from trajkit.operators import routing, synthesis

    stops = [{"lat": 37.0, "lon": 127.0}, {"lat": 37.01, "lon": 127.0}]
    legs = spark.createDataFrame([(f"t{i}", 1, "walk", "r", stops, [], [0.0, 1111.9]) for i in range(9)], "trip_id string, leg int, mode string, ref string, stops array<struct<lat:double,lon:double>>, names array<string>, offsets array<double>")
    trips = spark.createDataFrame([(i, f"t{i}", "d", "walk", "clean", 1_000_000) for i in range(9)], "number long, trip_id string, device_id string, category string, noise string, start_us long")
    monkeypatch.setattr(synthesis, "TASK_LEGS", 2)
    names, real = [], synthesis.written
    monkeypatch.setattr(synthesis, "written", lambda df, name: names.append(name) or real(df, name))
    data = synthesis.Dataset(trips, legs, 5)
    assert data.points_once().rdd.getNumPartitions() == 5 and not names
    few = sorted(map(str, data.only(["t3"]).fixes.collect()))
    assert few and few == sorted(map(str, data.fixes.filter("trip_id = 't3'").collect())) and names == ["synthesis-fixes"] * 2
    assert data.segments.filter("geometry_status = 'PASS' AND max_error_m < 0.01 AND p95_error_m <= max_error_m").count() == 9


def test_copies_are_found_whole(spark):
    from trajkit.operators import checks

    rows = [("a", 0, 1, 1.0), ("a", 1, 2, 2.0), ("b", 0, 1, 1.0), ("b", 1, 2, 2.0), ("c", 0, 1, 2.0), ("c", 1, 2, 1.0), ("d", 0, 1, 9.0)]
    fixes = spark.createDataFrame(rows, "trip_id string, sequence int, s int, latitude double").selectExpr("*", "timestamp_seconds(s) AS timestamp", "0D AS longitude")
    assert [r["count"] for r in checks.copies(fixes).collect()] == [2]  # c has the same places in another order


def test_segments_of_long_lines_are_found_without_a_look_at_each_pair_of_stops(spark):
    import time

    from trajkit.operators import checks

    F = checks.F
    lines = spark.sql("SELECT 'bus' AS kind, 'b' AS ref, 3000 AS n, transform(sequence(1, 3000), i -> named_struct('place', i, 'name', concat('n', i % 1000), 'lat', 37D, 'lon', 127D)) AS stops")
    own = spark.sql("SELECT concat('t', id) AS trip_id, 1 AS leg, 'bus' AS mode, 'b' AS line, transform(sequence(id, id + 4), i -> concat('n', i)) AS sequence, 'x' AS geometry_hash FROM range(1, 201)")
    p, began = checks.Package(None, None, own, None, lines), time.time()
    found = checks.reference_checks(p).groupBy("name").agg(F.count_if(F.col("status") == "PASS")).collect()
    assert dict(map(tuple, found)) == {"external_sequence": 200, "geometry_reconstruction": 0}
    assert time.time() - began < 30


def test_every_route_is_found_beyond_the_limit_of_the_searchs_contract(spark, tables, monkeypatch):
    monkeypatch.setattr(routing, "EXPANSIONS", 3)
    monkeypatch.setattr(routing.routes, "__defaults__", tuple(3 if x == 150_000 else x for x in routing.routes.__defaults__))
    rows, want = star(30)
    assert set(result(spark, tables(lineitem=rows), "shortest_routes")) == {(a, "OK", d) for a, d in want}
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    edges = frame([(0, i, i + 1, i, 1.0, 1.0, None, None, None, None) for i in range(9)], "region long, src long, dst long, way long, length_m double, speed double, src_lat double, src_lon double, dst_lat double, dst_lon double")
    queries = frame([(1, 0, 0, 9)], "query_id long, region long, src long, dst long")
    assert routing.routes(edges, queries).first().status == "LIMIT" and routing.routes(edges, queries, limit=math.inf).first().distance == 9.0
