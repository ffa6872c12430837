"""The generate, validate and audit drive: rules against plain Python, mutations, and the same rows on any partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trajkit.operators import checks, folds, numbering, reports, spatial, synthesis
from trajkit.operators import synthesis_first as first
from trajkit.plans import drive


@pytest.fixture(scope="module")
def made(spark, sf):
    return drive.dataset(spark, sf)


def metres(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h)))


def test_same_seed_same_rows_on_any_partitioning(spark, sf):
    cat = drive.catalog(spark, sf)
    own = drive.trips(spark, sf).filter("number <= 12")

    def rows(parts):
        legs = synthesis.plan(own.repartition(parts), cat, 7)
        points = synthesis.move(legs, own.repartition(parts + 1), 7)
        return sorted(map(str, legs.collect())), sorted(map(str, synthesis.observe(points, own, 7).collect()))

    assert rows(2) == rows(5)


def test_plans_keep_the_rules(made):
    cat, data = made
    kinds = {r.trip_id: r.category for r in data.trips.collect()}
    legs = {}
    for r in data.legs.collect():
        legs.setdefault(r.trip_id, []).append(r)
    lines = {(r.kind, r.ref): [(s.name, s.lat, s.lon) for s in r.stops] for r in cat.lines.collect()}
    assert set(kinds.values()) == set(synthesis.CATEGORIES)
    for trip, own in legs.items():
        own.sort(key=lambda r: r.leg)
        assert [r.leg for r in own] == list(range(1, len(own) + 1))
        for r in own:
            if r.mode in ("bus", "rail"):
                known, names = lines[r.mode, r.ref], list(r.names)
                at = [i for i in range(len(known)) if [k[0] for k in known[i : i + len(names)]] == names]
                assert at and 2 <= len(names) - 1 <= synthesis.HOPS[r.mode]
                assert any([(s.lat, s.lon) for s in r.stops] == [k[1:] for k in known[i : i + len(names)]] for i in at)
        if kinds[trip] in ("walk", "bike", "car"):
            a, b = own[0].stops
            assert len(own) == 1 and 700 <= metres(a.lat, a.lon, b.lat, b.lon) <= 8000
        if kinds[trip] == "multimodal":
            assert own[0].mode == own[-1].mode == "walk" and any(r.mode in ("bus", "rail") for r in own)
            for r in (own[0], own[-1]):
                a, b = r.stops
                assert 900 <= metres(a.lat, a.lon, b.lat, b.lon) <= 2500
            for p, q in zip(own, own[1:], strict=False):
                assert metres(p.stops[-1].lat, p.stops[-1].lon, q.stops[0].lat, q.stops[0].lon) <= 2.0


def test_motion_is_sound():
    for mode in synthesis.PACE:
        for total, offsets in ((500.0, [0.0, 500.0]), (5000.0, [0.0, 1200.0, 1200.0, 3000.0, 5000.0]), (3.0, [0.0, 3.0])):
            rows = list(synthesis.ticks(mode, total, offsets, synthesis.Draws(1, mode, total)))
            t, d, v = zip(*rows, strict=True)
            assert all(b - a >= 0.25 for a, b in zip(t, t[1:], strict=False)) and list(d) == sorted(d)
            assert d[0] == 0.0 and d[-1] == total and max(v) <= synthesis.TOP[mode] and v[0] == 0.0
            for (t0, d0, _), (t1, d1, v1) in zip(rows, rows[1:-1], strict=False):
                assert v1 == 0.0 and d1 >= d0 or abs((d1 - d0) / v1 - (t1 - t0)) < 1e-6 or t1 - t0 > (d1 - d0) / v1
            if len(offsets) > 2 and mode == "rail":  # a short stop of a bus may fall between two points
                assert {x for x, y in zip(d, v, strict=True) if y == 0} >= set(offsets[1:-1])


def test_all_checks_pass_and_all_mutations_are_detected(made):
    cat, data = made
    p = checks.Package.of(data, cat)
    rows = checks.validate(p)
    assert [tuple(r) for r in checks.rolled_up(rows).filter("status <> 'PASS'").collect()] == []
    tests = checks.mutation_tests(p)
    assert {r.mutation for r in tests.filter("detected").collect()} == set(checks.MUTATIONS)
    assert checks.gate(rows, tests).first().status == "PASS" and checks.gate(rows.limit(0)).first().status == "FAIL"
    assert {r.status for r in checks.journey_gate(data.points, data.segments).collect()} == {"PASS"}
    broken = data.points.withColumn("us", F.when(F.col("idx") == 3, F.col("us") - 10_000_000).otherwise(F.col("us")))
    assert {r.status for r in checks.journey_gate(broken, data.segments).collect()} == {"FAIL"}


def test_a_leak_is_a_whole_name():
    assert checks.leaked(["trip_id", "mode", "mode_hint", "bus_line"]) == ["mode"]
    assert checks.contract(list(checks.REQUIRED)) and not checks.contract([*checks.REQUIRED, "label"]) and not checks.contract(["trip_id"])


def test_observation_against_a_plain_loop(spark):
    """Drift, kept fixes and times of the first model, folded in order."""
    rnd = random.Random(3)
    rows = [("t1", i, 1_000_000 * i * 5, 37.5, 127.0, 0.0 if rnd.random() < 0.6 else 3.0, 90.0, False) for i in range(300)]
    points = spark.createDataFrame(rows, "trip_id string, idx long, us long, lat double, lon double, speed double, course double, joint boolean")
    trips = spark.createDataFrame([("t1", "d", "noisy")], "trip_id string, device_id string, noise string")
    got = synthesis.observe_first(points, trips, 5).orderBy("sequence").collect()
    of = synthesis.FIRST_NOISE["noisy"]
    u = lambda i, what: float(DRAWS[i][what])
    names = ("missing", "time", "lat", "drift_lat")
    drawn = points.select("idx", *(numbering.draw(F.lit(5), "trip_id", "idx", F.lit(n)).alias(n) if n == "missing" else numbering.normal(F.lit(5), "trip_id", "idx", F.lit(n)).alias(n) for n in names))
    DRAWS = {r.idx: r.asDict() for r in drawn.collect()}
    drift, before, out = 0.0, None, []
    for _, i, us, lat, _, speed, _, _ in rows:
        if i not in (0, 299) and u(i, "missing") < of["missing"]:
            continue
        seen = lat + u(i, "lat") * of["sigma"] / 111_000 + drift
        drift = drift + u(i, "drift_lat") * of["drift"] / 111_000 if speed == 0 else 0.0
        t = us if before is None else max(before + 100_000, us + round(u(i, "time") * of["jitter"] * 1e6))
        before = t
        out.append((round(seen, 7), t))
    assert len(got) == len(out) < 300
    assert all(abs(r.latitude - lat) < 2e-7 and abs(r.timestamp.timestamp() * 1e6 - t) < 1 for r, (lat, t) in zip(got, out, strict=True))


def test_observed_times_always_rise(made):
    fixes = made[1].fixes
    steps = checks._steps(fixes)
    assert steps.filter("dt <= 0").count() == 0 and steps.filter("sequence > 0 AND b IS NULL").count() == 0
    assert folds.repaired_times(fixes.withColumn("us", F.unix_micros("timestamp")), "trip_id", "sequence", "us").exceptAll(fixes.withColumn("us", F.unix_micros("timestamp"))).count() == 0


def test_nearest_segment_equals_brute_force(spark):
    rnd = random.Random(6)
    points = [(i, i % 3, rnd.uniform(37, 37.2), rnd.uniform(127, 127.2)) for i in range(150)] + [(900, 0, 40.0, 120.0), (901, 7, 37.0, 127.0)]
    lines = []
    for k in range(3):
        at = (rnd.uniform(37, 37.2), rnd.uniform(127, 127.2))
        for part in range(40):
            to = (at[0] + rnd.uniform(-0.02, 0.02), at[1] + rnd.uniform(-0.02, 0.02))
            lines.append((k, part, *at, *to))
            at = to
    got = spatial.nearest_segment(spark.createDataFrame(points, "id long, line int, lat double, lon double"), spark.createDataFrame(lines, "line int, part int, alat double, alon double, blat double, blon double"), "line")
    got = {r.id: (r.part, r.dist) for r in got.collect()}
    k = math.pi * 6_371_000 / 180
    for i, line, lat, lon in points[:-1]:
        best = []
        for own, part, a, b, c, d in lines:
            if own == line:
                w = math.cos(math.radians(lat))
                ay, ax, dy, dx = (a - lat) * k, (b - lon) * k * w, (c - a) * k, (d - b) * k * w
                t = max(0.0, min(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy)))
                best.append((math.hypot(ax + t * dx, ay + t * dy), part))
        assert abs(got[i][1] - min(best)[0]) < 1e-6 and abs(dict((p, x) for x, p in best)[got[i][0]] - got[i][1]) < 1e-6
    assert 901 not in got


def test_spatial_join_goes_round_the_globe(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CROWD", 3)
    rnd = random.Random(9)
    near = lambda n: [(i, rnd.uniform(-17.1, -16.9), rnd.choice((-1, 1)) * rnd.uniform(179.9, 180.0)) for i in range(n)]
    a, b = near(120), near(120)
    frame = lambda rows: spark.createDataFrame(rows, "id long, lat double, lon double")
    got = {(r.left_id, r.right_id) for r in spatial.within(frame(a), frame(b), 3000.0).collect()}
    want = {(p[0], q[0]) for p in a for q in b if metres(p[1], p[2], q[1], q[2]) <= 3000}
    assert got == want and any(p[2] * q[2] < 0 for p in a for q in b if (p[0], q[0]) in want)
    with pytest.raises(ValueError):
        spatial.within(frame([(1, 89.9, 0.0)]), frame(b), 3000.0)


def test_dense_numbers(spark):
    rows = spark.range(1000).selectExpr("id * 37 % 1009 AS k")
    got = sorted((r.no, r.k) for r in numbering.numbered(rows.repartition(5), "k").collect())
    assert got == list(enumerate(sorted(r.k for r in rows.collect())))


def test_journeys_are_numbered_through_the_categories(spark):
    rows = synthesis.journeys(spark, {"walk": 3, "poc_walk": 9, "rail": 2}, 42).orderBy("number").collect()
    assert [(r.trip_id, r.category) for r in rows] == [("trip_000001", "walk"), ("trip_000002", "walk"), ("trip_000003", "walk"), ("trip_000004", "rail"), ("trip_000005", "rail")]
    assert all(6 <= (r.start_us // 3_600_000_000) % 24 <= 21 for r in rows)


def test_reports(made, spark):
    cat, data = made
    p = checks.Package.of(data, cat)
    seg, trips = data.segments.collect(), {r.trip_id: r.category for r in data.trips.collect()}
    by_mode = {r.mode: r for r in reports.mode_reality(p).collect()}
    assert set(by_mode) == set(synthesis.PACE)
    for mode, r in by_mode.items():
        own = [s for s in seg if s.mode == mode]
        assert (r.segments, r.points, r.distinct_references) == (len(own), sum(s.points for s in own), len({s.reference for s in own}))
    used = {(r.kind, r.ref): r.uses for r in reports.usage_of_lines(p).collect()}
    assert len(used) == cat.lines.count() and sum(used.values()) == sum(s.mode in ("bus", "rail") for s in seg)
    assert sum(r.trips for r in reports.diversity(p).collect()) == len(trips)
    assert reports.duplicates(checks.Package(p.trips, data.fixes, data.segments, p.points, p.lines)).first().exact_duplicates == 0
    moved = {(r.trip_id, r.leg): r for r in synthesis.transfers(data.segments).collect()}
    assert len(moved) == len(seg) - len(trips) and all(r.valid for r in moved.values())
    page = reports.pages(data.fixes.filter(F.col("trip_id") == min(trips))).first()
    places = [tuple(map(float, x.split(","))) for x in page.html.split("points='")[1].split("'")[0].split()]
    assert len(places) == page.points and all(0 <= x <= 1000 and 0 <= y <= 600 for x, y in places)
    rows = spark.createDataFrame([(f"t{i}", "walk" if i % 3 else "multimodal", (i * 7) % 31) for i in range(31)], "trip_id string, category string, points long")
    picked = {}
    for r in reports.spread_samples(rows).collect():
        picked.setdefault(r.kind, set()).add(r.trip_id)
    order = sorted((r.points, r.trip_id) for r in rows.collect())
    assert picked["short"] == {t for _, t in order[:2]} and picked["long"] == {t for _, t in order[-2:]} and picked["middle"] == {order[14][1], order[15][1]}
    assert "| mode |" in reports.markdown("x", {"a": spark.createDataFrame([("w",)], "mode string")})


def test_timeline_events(spark):
    rows = [("t", i, 1, "bus", 10 * i, 1.0 * i, 2.0, v) for i, v in enumerate([0.0, 3.0, 0.0, 0.0, 2.0, 0.0])]
    points = spark.createDataFrame(rows, "trip_id string, idx long, leg int, mode string, us long, lat double, lon double, speed double")
    got = sorted((r.start_us, r.end_us, r.event_type, r.lat) for r in synthesis.timeline_events(points).collect())
    assert got == [(0, 0, "dwell", 0.0), (20, 30, "dwell", 2.0), (50, 50, "dwell", 5.0)]


def test_first_model(spark, sf):
    cat = drive.catalog(spark, sf)
    own = drive.trips(spark, sf).filter("number <= 30").select("number", "category").withColumn("hard_case", synthesis.hard_case(F.col("category"), F.col("number") % 20, 5, synthesis.HARD_CASES))
    trips = first.seeded(own, 2026)
    corridors = spark.createDataFrame([(k, f"c{k}", [(37.5 + 0.01 * k, 127.0), (37.5 + 0.01 * k, 127.01), (37.51 + 0.01 * k, 127.02)]) for k in range(3)], "no long, id string, places array<struct<lat:double,lon:double>>")
    legs = first.plan(trips, cat, corridors, 2026)
    kinds = {r.trip_id: r for r in trips.collect()}
    modes = {}
    for r in legs.orderBy("trip_id", "leg").collect():
        modes.setdefault(r.trip_id, []).append(r.mode)
    assert all(tuple(m) in first.PATTERNS if kinds[t].category == "multimodal" else m == [kinds[t].category] for t, m in modes.items()) and len(modes) == 31
    rows = {}
    for r in first.move(legs.repartition(3), trips, 2026).collect():
        rows.setdefault(r.trip_id, []).append(r)
    again = sorted(map(str, first.move(legs.repartition(5), trips, 2026).collect()))
    assert again == sorted(str(r) for own in rows.values() for r in own)
    for own in rows.values():
        own.sort(key=lambda r: r.idx)
        for a, b in zip(own, own[1:], strict=False):
            low, high = first.RANGE[a.mode]
            assert 0 <= a.speed <= high and (b.us - a.us == 5_000_000 or b.joint and b.us == a.us)
            assert metres(a.lat, a.lon, b.lat, b.lon) <= max(a.speed * 5, 0.02) + 0.01
    hours = {(r.start_us // 3_600_000_000) % 24 for r in kinds.values()}
    assert all(any(low <= h < high for low, high, _ in first.HOURS.values()) for h in hours) and {r.noise for r in kinds.values()} <= {n for n, _ in first.NOISE}


def test_zigzag_resampling_and_choices(spark):
    import numpy as np

    lat, lon = first.resampled(np.array([37.5, 37.5]), np.array([127.0, 127.01]), 30.0)
    steps = [metres(*a, *b) for a, b in zip(zip(lat, lon, strict=True), list(zip(lat, lon, strict=True))[1:], strict=False)]
    assert all(abs(s - 30) < 0.01 for s in steps[:-1]) and steps[-1] <= 30.01 and lon[-1] == 127.01
    y, x = first.joined((37.0, 127.0), np.array([37.2, 37.3]), np.array([127.2, 127.3]))
    assert np.allclose(y, [37.0, 37.1012, 37.0988, 37.2, 37.3]) and np.allclose(x, [127.0, 127.0988, 127.1012, 127.2, 127.3])
    picked = spark.range(4000).select(numbering.weighted({"a": 1, "b": 3}, F.lit(1), "id").alias("k")).groupBy("k").count().collect()
    assert abs({r.k: r["count"] for r in picked}["b"] - 3000) < 150
    some = numbering.sampled(spark.range(100), 10, "id").collect()
    assert len(some) == 10 and some == numbering.sampled(spark.range(100).repartition(7), 10, "id").collect()
