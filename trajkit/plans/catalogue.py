"""All queries on movement data, by name, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajkit.functions.dialect import Dialect, SparkSql
from trajkit.operators import arrays, graph, quantiles, reports, spatial
from trajkit.operators.synthesis_first import HOURS
from trajkit.plans import audits, drive, rules
from trajkit.plans import views as v
from trajkit.session import written

SQL: dict[str, Callable[[Dialect], str]] = {}


def query(f: Callable[[Dialect], str]) -> Callable[[Dialect], str]:
    SQL[f.__name__] = f
    return f


@query
def gps_implied_motion(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, seq, round(dt, 3) AS dt_s, round(dist, 3) AS dist_m, round(bearing, 3) AS bearing_deg, round(implied, 4) AS implied_mps, round(acc, 5) AS accel FROM accel"""


@query
def reported_acceleration(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, seq, round((speed - speed0) / dt, 6) AS accel FROM motion WHERE dt > 0"""


@query
def gps_contract_checks(d):
    return f"""WITH {v.motion(d)}, t AS (SELECT trip_id, count(*) AS n, coalesce(bool_and(dt > 0 OR us0 IS NULL), false) AS time_ok, coalesce(min(seq) = 0 AND max(seq) = count(*) - 1 AND count(DISTINCT seq) = count(*), false) AS seq_ok,
        coalesce(bool_and(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), false) AS range_ok, coalesce(bool_and(accuracy > 0), false) AS accuracy_ok, coalesce(bool_and(speed BETWEEN 0 AND 35), false) AS speed_ok,
        coalesce(bool_and(implied <= 100 OR implied IS NULL OR dt < {d.f(0.1)}), false) AS jump_ok, coalesce(bool_and(NOT (us = us0 AND lat = lat0 AND lon = lon0) OR us0 IS NULL), false) AS distinct_ok FROM motion GROUP BY trip_id)
        SELECT trip_id, n, CASE WHEN time_ok THEN 'PASS' ELSE 'FAIL' END AS monotone_time, CASE WHEN seq_ok THEN 'PASS' ELSE 'FAIL' END AS contiguous_sequence, CASE WHEN range_ok THEN 'PASS' ELSE 'FAIL' END AS coordinates,
        CASE WHEN accuracy_ok THEN 'PASS' ELSE 'FAIL' END AS accuracy, CASE WHEN speed_ok THEN 'PASS' ELSE 'FAIL' END AS speed, CASE WHEN jump_ok THEN 'PASS' ELSE 'FAIL' END AS jump, CASE WHEN distinct_ok THEN 'PASS' ELSE 'FAIL' END AS adjacent_duplicate FROM t"""


@query
def check_rollup(d):
    return f"""WITH {v.motion(d)}, t AS (SELECT trip_id, coalesce(bool_and(dt > 0 OR us0 IS NULL), false) AS a, coalesce(bool_and(speed BETWEEN 0 AND 35), false) AS b, coalesce(bool_and(dt BETWEEN 3.5 AND 35 OR us0 IS NULL), false) AS c FROM motion GROUP BY trip_id),
        r AS (SELECT name, CASE name WHEN 'monotone_time' THEN a WHEN 'speed' THEN b ELSE c END AS ok FROM t CROSS JOIN (VALUES ('monotone_time'), ('speed'), ('interval')) AS x(name))
        SELECT name, count(CASE WHEN ok THEN 1 END) AS passed, count(CASE WHEN NOT ok THEN 1 END) AS failed, CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END AS status FROM r GROUP BY name"""


@query
def trip_extents(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, count(*) AS points, CAST(floor((max(us) - min(us)) / {d.f(1e6)}) AS BIGINT) AS duration_s, round(sum(dist), 2) AS distance_m, round(max(speed), 3) AS max_speed, round(min(dt), 3) AS min_dt, round(max(dt), 3) AS max_dt FROM motion GROUP BY trip_id"""


@query
def endpoint_validity(d):
    return f"""WITH {v.gps(d)}, o AS (SELECT trip_id, user_id, min(seq) AS lo, max(seq) AS hi FROM gps GROUP BY trip_id, user_id), {v.places(d, "customer", "c_custkey", "home")},
        e AS (SELECT o.trip_id, {d.haversine("a.lat", "a.lon", "h.lat", "h.lon")} AS at_start, {d.haversine("b.lat", "b.lon", "h.lat", "h.lon")} AS at_end FROM o JOIN gps a ON a.user_id = o.user_id AND a.seq = o.lo JOIN gps b ON b.user_id = o.user_id AND b.seq = o.hi JOIN home h ON h.id = o.user_id + 1)
        SELECT trip_id, round(at_start, 2) AS start_m, round(at_end, 2) AS end_m, at_start <= 200 AND at_end <= 200 AS valid FROM e"""


@query
def asof_nearest_truth(d):
    return f"""WITH {v.gps(d)}, k AS (SELECT *, CASE WHEN event_id % 2 = 1 THEN us END AS t FROM gps),
        w AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before, min(t) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM k)
        SELECT event_id, CASE WHEN before IS NULL THEN after WHEN after IS NULL THEN before WHEN us - before <= after - us THEN before ELSE after END AS truth_us FROM w"""


@query
def mode_at_interval(d):
    return f"""WITH {v.gps(d)}, {v.segments(d)}, p AS (SELECT g.event_id, g.user_id, g.us, g.us + 3600000000 AS probe FROM gps g),
        hit AS (SELECT p.event_id, min(s.segment_id) AS segment_id FROM p JOIN segments s ON s.user_id = p.user_id AND s.day BETWEEN CAST(floor(p.probe / {d.f(86400e6)}) AS BIGINT) - 1 AND CAST(floor(p.probe / {d.f(86400e6)}) AS BIGINT) AND p.probe BETWEEN s.start_us AND s.end_us GROUP BY p.event_id),
        w AS (SELECT p.event_id, p.user_id, p.probe, h.segment_id AS inside FROM p LEFT JOIN hit h ON h.event_id = p.event_id),
        gap AS (SELECT w.event_id, s.segment_id, least(abs(w.probe - s.start_us), abs(w.probe - s.end_us)) AS gap_us FROM w JOIN segments s ON s.user_id = w.user_id WHERE w.inside IS NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap_us, segment_id) AS rn FROM gap),
        found AS (SELECT w.event_id, w.user_id, coalesce(w.inside, r.segment_id) AS segment_id FROM w LEFT JOIN r ON r.event_id = w.event_id AND r.rn = 1)
        SELECT f.event_id, f.segment_id, s.mode FROM found f LEFT JOIN segments s ON s.user_id = f.user_id AND s.segment_id = f.segment_id"""


@query
def mode_at_last_segment_fallback(d):
    return f"""WITH {v.gps(d)}, {v.segments(d)}, last AS (SELECT user_id, max(segment_id) AS last_id FROM segments GROUP BY user_id),
        hit AS (SELECT g.event_id, min(s.segment_id) AS segment_id FROM gps g JOIN segments s ON s.user_id = g.user_id AND s.day = CAST(floor((g.us + 3600000000) / {d.f(86400e6)}) AS BIGINT) AND g.us + 3600000000 BETWEEN s.start_us AND s.end_us GROUP BY g.event_id)
        SELECT g.event_id, coalesce(h.segment_id, l.last_id) AS segment_id FROM gps g JOIN last l ON l.user_id = g.user_id LEFT JOIN hit h ON h.event_id = g.event_id"""


@query
def mode_at_no_fallback(d):
    return f"""WITH {v.gps(d)}, {v.segments(d)} SELECT s.mode, count(*) AS fixes FROM gps g JOIN segments s ON s.user_id = g.user_id AND s.day = CAST(floor(g.us / {d.f(86400e6)}) AS BIGINT) AND g.us BETWEEN s.start_us AND s.end_us GROUP BY s.mode"""


@query
def file_match(d):
    return f"""WITH a AS (SELECT DISTINCT o_custkey AS id FROM {d.t("orders")} WHERE o_orderkey % 3 = 0), b AS (SELECT c_custkey AS id FROM {d.t("customer")} WHERE c_custkey % 4 <> 0)
        SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'missing_left' WHEN b.id IS NULL THEN 'missing_right' ELSE 'matched' END AS state FROM a FULL OUTER JOIN b ON a.id = b.id"""


@query
def coverage_left_join(d):
    return f"""SELECT n.n_name AS name, count(s.s_suppkey) AS stops, CASE WHEN count(s.s_suppkey) >= 3 THEN 'PASS' ELSE 'FAIL' END AS status FROM {d.t("nation")} n LEFT JOIN {d.t("supplier")} s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name"""


@query
def upsert_validation(d):
    return f"""WITH base AS (SELECT p_partkey AS id, p_size AS val FROM {d.t("part")}), patch AS (SELECT l_partkey AS id, max(l_linenumber) AS val FROM {d.t("lineitem")} WHERE l_quantity >= 49 GROUP BY l_partkey)
        SELECT coalesce(p.id, b.id) AS id, coalesce(p.val, b.val) AS val, p.id IS NOT NULL AS replaced FROM base b FULL OUTER JOIN patch p ON b.id = p.id"""


@query
def first_match_by_key(d):
    return f"""SELECT c_mktsegment AS name, min(c_custkey) AS first_id, count(*) AS n FROM {d.t("customer")} GROUP BY c_mktsegment"""


@query
def stop_pairs(d):
    return f"""WITH {v.stops(d)}, p AS (SELECT route, pos, stop, lead(stop) OVER (PARTITION BY route ORDER BY pos) AS next_stop FROM stops) SELECT route, pos, stop, next_stop FROM p WHERE next_stop IS NOT NULL"""


@query
def dup_sequence(d):
    return f"""SELECT l_orderkey AS route, l_linenumber AS order_no, count(*) AS n FROM {d.t("lineitem")} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


@query
def route_coverage(d):
    return f"""WITH {v.stops(d)}, r AS (SELECT route, count(*) AS stops, count(CASE WHEN qty >= 5 THEN 1 END) AS routable FROM stops GROUP BY route)
        SELECT route, stops, routable, round(routable / greatest({d.f(1)}, stops), 6) AS coverage, CASE WHEN stops = routable THEN 'PASS' ELSE 'FAIL' END AS status FROM r"""


@query
def coverage_summary(d):
    return f"""WITH {v.stops(d)}, r AS (SELECT route, count(*) AS stops, count(CASE WHEN qty >= 5 THEN 1 END) AS routable FROM stops GROUP BY route)
        SELECT CASE WHEN stops = routable THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS routes, CAST(sum(greatest(stops - 1, 0)) AS BIGINT) AS pairs FROM r GROUP BY CASE WHEN stops = routable THEN 'PASS' ELSE 'FAIL' END"""


@query
def order_test(d):
    return f"""WITH {v.stops(d)}, w AS (SELECT route, stop, lag(stop) OVER (PARTITION BY route ORDER BY pos) AS before FROM stops) SELECT route, coalesce(bool_and(before IS NULL OR stop > before), false) AS in_order, count(DISTINCT stop) = count(*) AS all_distinct FROM w GROUP BY route"""


@query
def reverse_direction_pairs(d):
    return f"""WITH {v.stops(d)}, p AS (SELECT stop AS a, lead(stop) OVER (PARTITION BY route ORDER BY pos) AS b FROM stops), u AS (SELECT DISTINCT a, b FROM p WHERE b IS NOT NULL AND a <> b) SELECT x.a, x.b FROM u x JOIN u y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b"""


@query
def dwell_events(d):
    return f"""WITH {v.gps(d)}, z AS (SELECT *, value < 60 AS still FROM gps), g AS (SELECT *, seq - row_number() OVER (PARTITION BY user_id, still ORDER BY seq) AS island FROM z)
        SELECT trip_id, min(seq) AS first_seq, count(*) AS fixes, min(us) AS start_us, max(us) AS end_us FROM g WHERE still GROUP BY trip_id, island"""


@query
def segment_overlap(d):
    return f"""WITH {v.segments(d)}, w AS (SELECT *, lag(end_us) OVER (PARTITION BY user_id ORDER BY segment_id) AS before FROM segments) SELECT user_id, segment_id, before IS NULL OR start_us >= before AS ordered, (start_us - before) / {d.f(1e6)} AS gap_s FROM w"""


@query
def segment_transfers(d):
    return f"""WITH {v.gps(d)}, {v.segments(d)}, e AS (SELECT s.user_id, s.segment_id, s.mode, a.lat AS lat0, a.lon AS lon0, b.lat AS lat1, b.lon AS lon1 FROM segments s JOIN (SELECT user_id, us, min(lat) AS lat, min(lon) AS lon FROM gps GROUP BY user_id, us) a ON a.user_id = s.user_id AND a.us = s.start_us JOIN (SELECT user_id, us, min(lat) AS lat, min(lon) AS lon FROM gps GROUP BY user_id, us) b ON b.user_id = s.user_id AND b.us = s.end_us),
        w AS (SELECT *, lag(mode) OVER (PARTITION BY user_id ORDER BY segment_id) AS from_mode, lag(lat1) OVER (PARTITION BY user_id ORDER BY segment_id) AS plat, lag(lon1) OVER (PARTITION BY user_id ORDER BY segment_id) AS plon FROM e),
        x AS (SELECT user_id, segment_id, from_mode, mode AS to_mode, {d.haversine("plat", "plon", "lat0", "lon0")} AS dist, (plat + lat0) / 2 AS mid_lat, (plon + lon0) / 2 AS mid_lon FROM w WHERE from_mode IS NOT NULL)
        SELECT user_id, segment_id, from_mode, to_mode, round(dist, 2) AS distance_m, round(mid_lat, 6) AS mid_lat, round(mid_lon, 6) AS mid_lon, dist <= 450 AS valid FROM x"""


@query
def mode_sequence_histogram(d):
    return f"""WITH {v.segments(d)}, s AS (SELECT user_id, {d.joined("mode", "segment_id", ">")} AS modes FROM segments GROUP BY user_id) SELECT modes, count(*) AS trips FROM s GROUP BY modes"""


@query
def diversity_audit(d):
    end = lambda f: f"CAST(round({f}(g.lat, g.seq), 4) AS STRING) || ',' || CAST(round({f}(g.lon, g.seq), 4) AS STRING)"
    return f"""WITH {v.gps(d)}, {v.segments(d)}, m AS (SELECT s.mode, s.user_id, s.segment_id, count(*) AS pts, {end("min_by")} || '>' || {end("max_by")} AS od, (max(g.us) - min(g.us)) / {d.f(1e6)} AS dur FROM gps g JOIN segments s ON s.user_id = g.user_id AND s.day = CAST(floor(g.us / {d.f(86400e6)}) AS BIGINT) GROUP BY s.mode, s.user_id, s.segment_id)
        SELECT mode, count(*) AS segments, count(DISTINCT od) AS distinct_od, min(pts) AS min_points, max(pts) AS max_points, CAST(min(floor(dur)) AS BIGINT) AS min_s, CAST(max(floor(dur)) AS BIGINT) AS max_s FROM m GROUP BY mode"""


@query
def exact_duplicates(d):
    return f"""WITH h AS (SELECT {d.sha("text")} AS hash, count(*) AS n, min(doc_id) AS first_id FROM {d.t("documents")} GROUP BY {d.sha("text")}) SELECT hash, n, first_id, n - 1 AS surplus FROM h WHERE n > 1"""


@query
def near_signatures(d):
    return f"""WITH {v.gps(d)}, s AS (SELECT user_id, {d.sha(d.joined("CAST(CAST(floor(lat * 50) AS BIGINT) AS STRING) || ',' || CAST(CAST(floor(lon * 50) AS BIGINT) AS STRING)", "seq", ";"))} AS signature FROM gps GROUP BY user_id) SELECT signature, count(*) AS n, min(user_id) AS first_user FROM s GROUP BY signature"""


@query
def schema_profile(d):
    return f"""SELECT count(*) AS n_rows, count(*) - count(text) AS null_text, count(*) - count(DISTINCT doc_id) AS duplicate_ids, count(DISTINCT lang) AS langs, count(DISTINCT source) AS sources, min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM {d.t("documents")}"""


@query
def tag_histogram(d):
    return f"""WITH c AS (SELECT lower(trim(p_type)) AS tag, count(*) AS n FROM {d.t("part")} GROUP BY lower(trim(p_type))), t AS (SELECT tag, n FROM c ORDER BY n DESC, tag LIMIT 30)
        SELECT tag, n, row_number() OVER (ORDER BY n DESC, tag) AS rank FROM t"""


@query
def manifest_counts(d):
    return f"""WITH {v.segments(d)} SELECT mode, count(*) AS segments, count(DISTINCT user_id) AS trips, CAST(sum(floor((end_us - start_us) / 1000000)) AS BIGINT) AS seconds FROM segments GROUP BY mode"""


@query
def sample_first_per_category(d):
    return f"""WITH {v.segments(d)}, r AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY user_id, segment_id) AS rn FROM segments) SELECT mode, user_id, segment_id FROM r WHERE rn = 1"""


@query
def line_rollup_with_total(d):
    return f"""WITH g AS (SELECT l_returnflag AS line, count(*) AS n, count(CASE WHEN l_quantity > 25 THEN 1 END) AS passed FROM {d.t("lineitem")} GROUP BY l_returnflag) SELECT line, n, passed FROM g UNION ALL SELECT 'TOTAL', CAST(sum(n) AS BIGINT), CAST(sum(passed) AS BIGINT) FROM g"""


@query
def failure_reasons(d):
    return f"""WITH r AS (SELECT DISTINCT o_custkey AS id, o_orderpriority AS reason FROM {d.t("orders")} WHERE o_orderstatus <> 'O'), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY reason) AS rn FROM r) SELECT id, {d.joined("reason", "rn", "; ")} AS reasons FROM k WHERE rn <= 3 GROUP BY id"""


@query
def maxspeed_parse(d):
    return f"""WITH x AS (SELECT p_partkey AS id, CAST(p_size AS STRING) || CASE WHEN p_partkey % 3 = 0 THEN ' mph' ELSE '' END AS raw FROM {d.t("part")}), n AS (SELECT id, raw, CAST({d.only("raw", "0-9.")} AS DOUBLE) AS num FROM x) SELECT id, raw, round(least({d.f(33.3)}, CASE WHEN raw LIKE '%mph%' THEN num * {d.f(0.44704)} ELSE num / {d.f(3.6)} END), 6) AS mps FROM n"""


@query
def hash_uniform_noise(d):
    return f"""SELECT event_id, round({d.uniform("2026", "event_id", "'u'")}, 9) AS u, round({d.normal("2026", "event_id")}, 6) AS z FROM {d.t("events")}"""


@query
def observe_v1(d):
    n = lambda k: d.normal("2026", "user_id", "seq", f"'{k}'")
    return f"""WITH {v.gps(d)}, k AS (SELECT *, {d.uniform("2026", "user_id", "seq", "'drop'")} AS drop_u, max(seq) OVER (PARTITION BY user_id) AS last FROM gps),
        o AS (SELECT user_id, seq, lat + {n("lat")} * 4 / 111000 AS lat, lon + {n("lon")} * 4 / (111000 * greatest({d.f(0.1)}, cos(radians(lat)))) AS lon, us + CAST(round({n("t")} * 200000) AS BIGINT) AS t, greatest({d.f(0)}, speed + {n("v")} * {d.f(0.4)}) AS speed FROM k WHERE drop_u >= {d.f(0.03)} OR seq = 0 OR seq = last),
        r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1 AS i FROM o)
        SELECT user_id, i AS seq, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed, 3) AS speed, max(t - i * 100000) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + i * 100000 AS us FROM r"""


@query
def journey_seeding(d):
    return f"""WITH n AS (SELECT c_custkey AS k, {d.pmod("c_custkey", "6")} AS cat FROM {d.t("customer")}) SELECT 'trip_' || lpad(CAST(k AS STRING), 6, '0') AS trip_id, 'device_' || lpad(CAST(k % 23 + 1 AS STRING), 3, '0') AS device_id, 42026 + (k - 1) * 1000003 AS seed, cat, CAST(floor({d.uniform("42026", "k", "'h'")} * 24) AS BIGINT) AS start_hour,
        CASE WHEN {d.uniform("42026", "k", "'n'")} < 0.2 THEN 'low' WHEN {d.uniform("42026", "k", "'n'")} < 0.8 THEN 'medium' ELSE 'high' END AS noise FROM n"""


@query
def time_band_factor(d):
    """The pace of an hour: that of the first profile that has it, a tenth up or down; 1 outside all profiles."""
    bands = " ".join(f"WHEN hr >= {low} AND hr < {high} THEN {d.f(x)}" for low, high, x in HOURS.values())
    return f"""WITH h AS (SELECT event_id, CAST(floor({d.us("ts")} / {d.f(3600e6)}) AS BIGINT) % 24 AS hr FROM {d.t("events")}), b AS (SELECT *, CASE {bands} END AS band FROM h)
        SELECT event_id, hr, round(coalesce(band * ({d.f(0.9)} + {d.f(0.2)} * {d.uniform("7", "event_id")}), 1), 6) AS factor FROM b"""


@query
def polyline_cumulative(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, seq, round(coalesce(sum(dist) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 3) AS along_m FROM motion"""


@query
def point_at_distance(d):
    return f"""WITH {v.motion(d)}, c AS (SELECT user_id, trip_id, seq, lat0, lon0, lat, lon, dist, coalesce(sum(dist) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS along FROM motion),
        x AS (SELECT trip_id, seq, lat0 + (lat - lat0) * (5000 - (along - dist)) / dist AS plat, lon0 + (lon - lon0) * (5000 - (along - dist)) / dist AS plon, row_number() OVER (PARTITION BY trip_id ORDER BY seq) AS rn FROM c WHERE dist > 0 AND along >= 5000 AND along - dist < 5000) SELECT trip_id, seq, round(plat, 6) AS lat, round(plon, 6) AS lon FROM x WHERE rn = 1"""


@query
def event_property_histogram(d):
    return f"""SELECT event_type, {d.json_int("props", "k")} % 10 AS k, count(*) AS n FROM {d.t("events")} GROUP BY event_type, {d.json_int("props", "k")} % 10"""


@query
def release_gate(d):
    return f"""WITH {v.motion(d)}, c AS (SELECT coalesce(bool_and(dt > 0 OR us0 IS NULL), false) AS time_ok, coalesce(bool_and(speed BETWEEN 0 AND 35), false) AS speed_ok, count(DISTINCT user_id) AS trips, count(*) AS points FROM motion) SELECT trips, points, time_ok, speed_ok, CASE WHEN time_ok AND speed_ok THEN 'PASS' ELSE 'FAIL' END AS gate FROM c"""


@query
def graph_edges(d):
    return f"WITH {v.edges(d)} SELECT src, dst FROM edges"


@query
def graph_stats(d):
    return f"WITH {v.edges(d)}, n AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges) SELECT (SELECT count(*) FROM edges) AS edges, (SELECT count(*) FROM n) AS nodes, (SELECT max(c) FROM (SELECT count(*) AS c FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) a GROUP BY id) b) AS max_degree"


def _runner(text: Callable[[Dialect], str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.sql(text(SparkSql(sf_dir)))


def _sql(spark: SparkSession, sf_dir: str, text: Callable[[Dialect], str]) -> DataFrame:
    return spark.sql(text(SparkSql(sf_dir)))


LIMITS = {"walk": 8, "bike": 20, "car": 50, "bus": 35, "rail": 80, "unknown": 100}


def _intervals(d: Dialect) -> str:
    """Each fix with the one before and the mode of the day's segment that it falls into, unknown outside."""
    day = f"CAST(floor(a.us / {d.f(86400e6)}) AS BIGINT)"
    return f"""WITH {v.motion(d)}, {v.segments(d)}, m AS (SELECT coalesce(s.mode, 'unknown') AS mode, a.dt, a.implied, a.acc, a.us0, a.lat = a.lat0 AND a.lon = a.lon0 AS still FROM accel a LEFT JOIN segments s ON a.user_id = s.user_id AND {day} = s.day AND a.us BETWEEN s.start_us AND s.end_us WHERE a.us0 IS NOT NULL)
        SELECT * FROM m"""


_COUNTS = """count(*) AS intervals, count(CASE WHEN dt < 0 THEN 1 END) AS negative_time, count(CASE WHEN dt = 0 THEN 1 END) AS duplicate_time, count(CASE WHEN dt = 0 AND NOT still THEN 1 END) AS zero_time_movement,
        count(CASE WHEN implied > 80 THEN 1 END) AS over_80, count(CASE WHEN implied > most THEN 1 END) AS over_limit, count(CASE WHEN abs(acc) > 8 THEN 1 END) AS accel_over_8, count(CASE WHEN implied > 100 THEN 1 END) AS teleports, round(max(implied), 3) AS max_mps, round(max(abs(acc)), 3) AS max_abs_accel"""
_MOST = "CASE mode " + " ".join(f"WHEN '{m}' THEN {x}" for m, x in LIMITS.items()) + " END AS most"


def physical_profile_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speeds and accelerations between fixes by mode, and how many break a rule; every mode has a row."""
    rows = written(_sql(spark, sf_dir, _intervals).select("mode", "dt", "implied", "acc", "still"), "profile-intervals")
    modes = spark.createDataFrame([(m,) for m in LIMITS], "mode string")
    own = rows.selectExpr("*", _MOST).groupBy("mode").agg(*(F.expr(x) for x in _split(_COUNTS)))
    mid = quantiles.percentiles(rows, "mode", "implied", {"median_mps": (0.5, True), "p95_mps": (0.95, True)})
    out = modes.join(own, "mode", "left").na.fill(0, [c for c in own.columns if c not in ("mode", "max_mps", "max_abs_accel")]).join(mid, "mode", "left")
    bad = F.col("negative_time") + F.col("duplicate_time") + F.col("teleports") + F.col("over_limit") + F.col("accel_over_8")
    return out.withColumns({c: F.round(c, 3) for c in ("median_mps", "p95_mps")}).withColumn("status", F.when(bad == 0, "PASS").otherwise("FAIL"))


def _split(columns: str) -> list[str]:
    """The expressions of a list, cut at commas outside brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[at:i].strip())
            at = i + 1
    return [*out, columns[at:].strip()]


def _profile_sql() -> str:
    d = Dialect()
    modes = ", ".join(f"('{m}')" for m in LIMITS)
    return f"""WITH i AS ({_intervals(d)}), r AS (SELECT *, {_MOST} FROM i), p AS (SELECT mode, {_COUNTS}, round(quantile_cont(implied, 0.5), 3) AS median_mps, round(quantile_cont(implied, 0.95), 3) AS p95_mps FROM r GROUP BY mode)
        SELECT x.mode, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('intervals', 'negative_time', 'duplicate_time', 'zero_time_movement', 'over_80', 'over_limit', 'accel_over_8', 'teleports'))}, max_mps, max_abs_accel, median_mps, p95_mps,
        CASE WHEN coalesce(negative_time + duplicate_time + teleports + over_limit + accel_over_8, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (VALUES {modes}) AS x(mode) LEFT JOIN p ON p.mode = x.mode"""


def time_range_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _sql(spark, sf_dir, lambda d: f"SELECT event_type, {d.us('ts')} AS us, value FROM {d.t('events')}")
    span = events.groupBy("event_type").agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    p95 = quantiles.percentiles(events, "event_type", "value", {"p95": (0.95, False)}).withColumn("p95", F.round("p95", 3))
    return span.join(p95, "event_type", "left")


def sample_short_mid_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two shortest, middle and longest trips by fixes."""
    counts = _sql(spark, sf_dir, lambda d: f"SELECT user_id AS trip_id, count(*) AS points, '' AS category FROM {d.t('events')} GROUP BY user_id")
    counts = written(counts, "sample-counts")
    return reports.spread_samples(counts).join(counts, "trip_id").select(F.col("trip_id").alias("user_id"), F.col("points").alias("pts"), "kind")


def subsequence_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each route's inner stops, as they are, reversed, and without every second one, are a run of its stops."""
    rows = _sql(spark, sf_dir, lambda d: f"WITH {v.stops(d)} SELECT route, pos, stop FROM stops")
    whole = rows.groupBy("route").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "stop"))), lambda x: x["stop"]).alias("a")).filter("size(a) >= 2")
    inner = F.slice("a", 2, F.size("a") - 1)
    asked = [("inner", inner), ("reversed", F.reverse(inner)), ("thinned", F.filter(inner, lambda _, i: i % 2 == 0))]
    each = F.array(*(F.struct(F.lit(n).alias("kind"), x.alias("b")) for n, x in asked))
    return whole.select("route", "a", F.explode(each).alias("x")).select("route", "x.kind", F.size("x.b").alias("stops"), arrays.has_run(F.col("a"), F.col("x.b")).alias("found"))


def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.connected_components(_sql(spark, sf_dir, graph_edges))


def nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'customer', 'c_custkey', 'p')} SELECT * FROM p")
    stations = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'supplier', 's_suppkey', 'p')} SELECT * FROM p")
    return spatial.within(fixes, stations, 900.0, k=1).selectExpr("left_id AS id", "right_id AS station", "round(dist, 2) AS distance_m")


def knn_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'customer', 'c_custkey', 'p')} SELECT * FROM p")
    stations = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'supplier', 's_suppkey', 'p')} SELECT * FROM p")
    return spatial.within(fixes, stations, 1500.0, k=5).selectExpr("left_id AS id", "rank", "right_id AS station", "round(dist, 2) AS distance_m")


def transfer_anchors_within_150m(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'customer', 'c_custkey', 'p')} SELECT * FROM p")
    stations = _sql(spark, sf_dir, lambda d: f"WITH {v.places(d, 'supplier', 's_suppkey', 'p')} SELECT * FROM p")
    return spatial.within(fixes, stations, 150.0).selectExpr("left_id AS stop", "right_id AS station", "round(dist, 2) AS distance_m")


def _near_sql(radius: float, k: int | None, cols: str) -> str:
    d = Dialect()
    top = f"WHERE rank <= {k}" if k else ""
    return f"""WITH {v.places(d, "customer", "c_custkey", "a")}, {v.places(d, "supplier", "s_suppkey", "b")}, m AS (SELECT a.id AS left_id, b.id AS right_id, {d.haversine("a.lat", "a.lon", "b.lat", "b.lon")} AS dist FROM a, b),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY left_id ORDER BY dist, right_id) AS INTEGER) AS rank FROM m WHERE dist <= {radius}) SELECT {cols} FROM r {top}"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _runner(text) for name, text in SQL.items()} | {
    "physical_profile_by_mode": physical_profile_by_mode,
    "time_range_by_category": time_range_by_category,
    "sample_short_mid_long": sample_short_mid_long,
    "subsequence_membership": subsequence_membership,
    "connected_components": connected_components,
    "nearest_station": nearest_station,
    "knn_stations": knn_stations,
    "transfer_anchors_within_150m": transfer_anchors_within_150m,
    **audits.QUERIES,
    **drive.QUERIES,
    **rules.QUERIES,
}
ORACLE_SQL: dict[str, str] = {name: text(Dialect()) for name, text in SQL.items()} | {
    "physical_profile_by_mode": _profile_sql(),
    "time_range_by_category": "SELECT event_type, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us, round(quantile_disc(value, 0.95), 3) AS p95 FROM events GROUP BY event_type",
    "sample_short_mid_long": """WITH c AS (SELECT user_id, count(*) AS pts FROM events GROUP BY user_id), r AS (SELECT *, row_number() OVER (ORDER BY pts, user_id) AS rn, count(*) OVER () AS n FROM c)
        SELECT user_id, pts, CASE WHEN rn <= 2 THEN 'short' WHEN rn BETWEEN n // 2 AND n // 2 + 1 THEN 'middle' ELSE 'long' END AS kind FROM r WHERE rn <= 2 OR rn > n - 2 OR rn BETWEEN n // 2 AND n // 2 + 1""",
    "subsequence_membership": f"""WITH {v.stops(Dialect())}, w AS (SELECT route, count(*) AS n, string_agg(stop, ',' ORDER BY pos) AS a FROM stops GROUP BY route HAVING count(*) >= 2),
        x AS (SELECT route, 'inner' AS kind, count(*) AS stops, string_agg(stop, ',' ORDER BY pos) AS b FROM stops WHERE pos >= 1 GROUP BY route
              UNION ALL SELECT route, 'reversed', count(*), string_agg(stop, ',' ORDER BY pos DESC) FROM stops WHERE pos >= 1 GROUP BY route
              UNION ALL SELECT route, 'thinned', count(*), string_agg(stop, ',' ORDER BY pos) FROM stops WHERE pos >= 1 AND pos % 2 = 1 GROUP BY route)
        SELECT x.route, x.kind, CAST(x.stops AS INTEGER) AS stops, contains(',' || w.a || ',', ',' || x.b || ',') AS found FROM x JOIN w ON w.route = x.route""",
    "connected_components": f"""WITH RECURSIVE {v.edges(Dialect())}, adj AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges), reach AS (SELECT DISTINCT a AS node, a AS seen FROM adj UNION SELECT r.node, e.b FROM reach r JOIN adj e ON r.seen = e.a) SELECT node, min(seen) AS component FROM reach GROUP BY node""",
    "nearest_station": _near_sql(900.0, 1, "left_id AS id, right_id AS station, round(dist, 2) AS distance_m"),
    "knn_stations": _near_sql(1500.0, 5, "left_id AS id, rank, right_id AS station, round(dist, 2) AS distance_m"),
    "transfer_anchors_within_150m": _near_sql(150.0, None, "left_id AS stop, right_id AS station, round(dist, 2) AS distance_m"),
    **audits.ORACLE_SQL,
    **drive.ORACLE_SQL,
    **rules.ORACLE_SQL,
}
