"""Further queries: audits of points and trips, geometry along lines, usage, routes."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajkit.functions.dialect import Dialect, SparkSql
from trajkit.operators import folds, graph, routing, spatial
from trajkit.plans import views as v
from trajkit.session import released, written
from trajkit.sources import files
from trajkit.streaming import trips

SQL: dict[str, Callable[[Dialect], str]] = {}
SPACING_M, REACH = 35, 18


def query(f: Callable[[Dialect], str]) -> Callable[[Dialect], str]:
    SQL[f.__name__] = f
    return f


def _day(d: Dialect, us: str) -> str:
    return f"CAST(floor({us} / {d.f(86400e6)}) AS BIGINT)"


def _polyline_sql(d: Dialect) -> str:
    """Distance of each fix to the line through its day's true points, in a plane at the fix."""
    k = d.f(111194.92664455873)
    return f"""WITH {v.gps(d)}, p AS (SELECT user_id, {_day(d, "us")} AS day, event_id, seq, lat, lon FROM gps),
        q AS (SELECT *, lead(lat) OVER (PARTITION BY user_id, day ORDER BY seq) AS lat1, lead(lon) OVER (PARTITION BY user_id, day ORDER BY seq) AS lon1 FROM p WHERE event_id % 2 = 1),
        s AS (SELECT user_id, day, lat AS alat, lon AS alon, coalesce(lat1, lat) AS blat, coalesce(lon1, lon) AS blon FROM q),
        m AS (SELECT p.event_id, (s.alat - p.lat) * {k} AS ay, (s.alon - p.lon) * {k} * cos(radians(p.lat)) AS ax, (s.blat - s.alat) * {k} AS dy, (s.blon - s.alon) * {k} * cos(radians(p.lat)) AS dx FROM p JOIN s ON p.user_id = s.user_id AND p.day = s.day),
        f AS (SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN greatest({d.f(0)}, least({d.f(1)}, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) ELSE {d.f(0)} END AS t FROM m)
        SELECT event_id, round(min(sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))), 2) AS distance_m, min(sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))) <= 35 AS near FROM f GROUP BY event_id"""


def point_to_polyline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each fix to the line through its day's true points, in a plane at the fix."""
    d = SparkSql(sf_dir)
    points = spark.sql(f"WITH {v.gps(d)} SELECT event_id AS id, user_id, {_day(d, 'us')} AS day, seq, lat, lon FROM gps")
    w = Window.partitionBy("user_id", "day").orderBy("seq")
    true = points.filter("id % 2 = 1").withColumn("q", F.lead(F.struct("lat", "lon")).over(w))
    part = F.row_number().over(w)
    lines = true.select("user_id", "day", part.alias("part"), F.col("lat").alias("alat"), F.col("lon").alias("alon"), F.coalesce("q.lat", "lat").alias("blat"), F.coalesce("q.lon", "lon").alias("blon"))
    found = spatial.nearest_segment(points.drop("seq"), written(lines, "polyline-lines"), "user_id", "day")
    return found.select(F.col("id").alias("event_id"), F.round("dist", 2).alias("distance_m"), (F.col("dist") <= 35).alias("near"))


@query
def polyline_resample(d):
    """Points at every multiple of the spacing along each trip's line, and its first and last vertex; a line has two vertices at least."""
    own = "OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""WITH {v.motion(d)}, c AS (SELECT user_id, trip_id, seq, lat0, lon0, lat, lon, CASE WHEN seq > 0 THEN dist ELSE {d.f(0)} END AS dist, count(*) OVER (PARTITION BY user_id) AS n FROM motion),
        s AS (SELECT *, sum(dist) {own} AS along FROM c WHERE n > 1), a AS (SELECT *, coalesce(lag(along) OVER (PARTITION BY user_id ORDER BY seq), {d.f(0)}) AS before FROM s),
        b AS (SELECT *, CAST(floor(before / {d.f(SPACING_M)}) AS BIGINT) + 1 AS lo, CAST(floor(along / {d.f(SPACING_M)}) AS BIGINT) AS hi FROM a),
        e AS (SELECT *, {d.series("lo", "hi")} AS k FROM b WHERE dist > 0 AND hi >= lo)
        SELECT trip_id, k, round(lat0 + (lat - lat0) * (k * {d.f(SPACING_M)} - before) / dist, 5) AS lat, round(lon0 + (lon - lon0) * (k * {d.f(SPACING_M)} - before) / dist, 5) AS lon FROM e
        UNION ALL SELECT trip_id, CAST(0 AS BIGINT), round(lat, 5), round(lon, 5) FROM a WHERE seq = 0
        UNION ALL SELECT trip_id, hi + 1, round(lat, 5), round(lon, 5) FROM b WHERE seq = n - 1 AND hi * {d.f(SPACING_M)} < along"""


@query
def gt_consistency(d):
    """Whether the segments first occur among a trip's fixes in the order of the ground truth."""
    return f"""WITH {v.gps(d)}, {v.segments(d)}, f AS (SELECT g.user_id, s.segment_id, min(g.seq) AS first_seq FROM gps g JOIN segments s ON s.user_id = g.user_id AND s.day = {_day(d, "g.us")} GROUP BY g.user_id, s.segment_id),
        w AS (SELECT user_id, segment_id, row_number() OVER (PARTITION BY user_id ORDER BY first_seq) - 1 AS place FROM f), n AS (SELECT user_id, count(*) AS n FROM segments GROUP BY user_id)
        SELECT n.user_id, coalesce(bool_and(w.segment_id = w.place), false) AND count(w.segment_id) = max(n.n) AS consistent FROM n LEFT JOIN w ON w.user_id = n.user_id GROUP BY n.user_id"""


@query
def true_trajectory_checks(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, coalesce(bool_and(dt > 0 OR us0 IS NULL), false) AS time_ok, coalesce(bool_and(speed <= 35), false) AS speed_ok, coalesce(bool_and(dist <= 250 OR us0 IS NULL), false) AS step_ok,
        coalesce(bool_and(abs((speed - speed0) / CASE WHEN dt > 0 THEN dt END) <= 8 OR us0 IS NULL), false) AS accel_ok FROM motion GROUP BY trip_id"""


@query
def point_audit(d):
    return f"""WITH {v.motion(d)} SELECT trip_id, seq, CASE WHEN dt IS NULL THEN 'FIRST' WHEN dt <= 0 THEN 'FAIL' WHEN implied <= 80 AND coalesce(abs(acc) <= 20, true) THEN 'PASS' ELSE 'FAIL' END AS status, CASE WHEN dt <= 0 THEN 'inf' WHEN acc IS NULL THEN '' ELSE 'set' END AS accel_state FROM accel"""


@query
def route_usage(d):
    return f"""WITH u AS (SELECT l_suppkey AS id, count(*) AS n, count(DISTINCT l_orderkey) AS trips FROM {d.t("lineitem")} GROUP BY l_suppkey)
        SELECT s.s_suppkey AS route, coalesce(u.n, 0) AS uses, coalesce(u.trips, 0) AS trips, u.n IS NOT NULL AS used FROM {d.t("supplier")} s LEFT JOIN u ON u.id = s.s_suppkey"""


@query
def id_sets_equal(d):
    return f"""WITH a AS (SELECT o_custkey AS id FROM {d.t("orders")}), b AS (SELECT c_custkey AS id FROM {d.t("customer")}), x AS (SELECT id FROM a EXCEPT SELECT id FROM b), y AS (SELECT id FROM b EXCEPT SELECT id FROM a), z AS (SELECT id FROM a INTERSECT SELECT id FROM b)
        SELECT (SELECT count(*) FROM x) AS only_left, (SELECT count(*) FROM y) AS only_right, (SELECT count(*) FROM z) AS both_sides, (SELECT count(*) FROM x) + (SELECT count(*) FROM y) = 0 AS equal_sets"""


@query
def journeys_at_transfer_names(d):
    """Lines that meet at a stop of the same name, counted."""
    return f"""WITH s AS (SELECT DISTINCT l_suppkey AS line, l_partkey AS name FROM {d.t("lineitem")}) SELECT a.line AS line_a, b.line AS line_b, count(*) AS shared FROM s a JOIN s b ON a.name = b.name AND a.line < b.line GROUP BY a.line, b.line"""


@query
def geometry_hash(d):
    shown = f"CAST(CAST(round(lat * {d.f(1e7)}) AS BIGINT) AS STRING) || ',' || CAST(CAST(round(lon * {d.f(1e7)}) AS BIGINT) AS STRING)"
    return f"""WITH {v.gps(d)} SELECT trip_id, count(*) AS points, {d.sha(d.joined(shown, "seq", ";"))} AS hash FROM gps GROUP BY trip_id"""


def weighted(d: Dialect) -> str:
    return f"WITH {v.edges(d)} SELECT src, dst, 1 + (src * 31 + dst) % 9 AS length FROM edges"


def asked(d: Dialect) -> str:
    """From each node to the ends of two hops, by the end's largest number; ``most`` is the length of the shortest such two hops."""
    return f"""WITH w AS ({weighted(d)}), adj AS (SELECT src AS a, dst AS b, length FROM w UNION SELECT dst, src, length FROM w), two AS (SELECT x.a AS src, y.b AS dst, x.length + y.length AS m FROM adj x JOIN adj y ON x.b = y.a WHERE x.a <> y.b),
        far AS (SELECT src, max(dst) AS dst FROM two GROUP BY src) SELECT far.src, far.dst, min(two.m) AS most FROM far JOIN two ON two.src = far.src AND two.dst = far.dst GROUP BY far.src, far.dst"""


def _asked(edges: DataFrame) -> DataFrame:
    """As ``asked`` has it, without ``most``: each node and the end of two hops from it with the largest number.

    Every node offers each of its neighbours the largest of the others, so no pair of hops is made.
    """
    down = Window.partitionBy("src").orderBy(F.desc("dst"))
    offers = edges.select(F.col("dst").alias("node"), F.first("dst").over(down).alias("top"), F.lead("dst").over(down).alias("below"))
    far = offers.groupBy(F.col("node").alias("src")).agg(F.max(F.when(F.col("top") == F.col("node"), F.col("below")).otherwise(F.col("top"))).alias("dst"))
    return far.filter("dst IS NOT NULL").select(F.col("src").alias("query_id"), "src", "dst")


def _frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each edge once, the edges both ways, and what is asked."""
    one = written(spark.sql(weighted(SparkSql(sf_dir))), "audits-edges")
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "length"))
    queries = written(_asked(both), "audits-asked")
    released(spark)
    return one, both, queries


def shortest_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, edges, queries = _frames(spark, sf_dir)
    found = routing.distances(edges, queries, REACH)
    return found.select("query_id", F.col("distance").cast("long").alias("distance"))


def shortest_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As shortest_distances, by the search within connected components."""
    one, edges, queries = _frames(spark, sf_dir)
    part = graph.connected_components(one)
    released(spark)
    own = edges.join(part.select(F.col("node").alias("src"), F.col("component").alias("region")), "src")
    none = F.lit(None).cast("double")
    own = own.select("region", "src", "dst", (F.least("src", "dst") * 1_000_000 + F.greatest("src", "dst")).alias("way"), F.col("length").alias("length_m"), F.lit(1.0).alias("speed"), *(none.alias(c) for c in ("src_lat", "src_lon", "dst_lat", "dst_lon")))
    q = queries.join(part.select(F.col("node").alias("src"), F.col("component").alias("region")), "src")
    return routing.routes(own, q, limit=math.inf).select("query_id", "status", F.col("distance").cast("long").alias("distance"))


def route_pair_anchors_120m(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = SparkSql(sf_dir)
    stops = spark.sql(f"WITH {v.places(d, 'customer', 'c_custkey', 'p')} SELECT p.*, c.c_nationkey AS line FROM p JOIN {d.t('customer')} c ON c.c_custkey = p.id")
    pairs = spatial.within(stops, stops, 120.0, carry=("line",))
    return pairs.filter("left_id <> right_id AND left_line <> right_line").selectExpr("left_id AS stop_a", "right_id AS stop_b", "round(dist, 2) AS distance_m")


def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts spoilt by a wrong decoding and repaired again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spoilt = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", F.sha2(files.repaired(spoilt), 256).alias("sha256"))


def repaired_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes whose times were disturbed, with times that rise again."""
    d = SparkSql(sf_dir)
    return folds.repaired_times(spark.sql(f"WITH {v.gps(d)} SELECT trip_id, seq, us + CAST(round({d.normal('7', 'user_id', 'seq')} * 3600000000) AS BIGINT) AS us FROM gps"))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    found = trips.sessions(events, "user_id", "ts", gap="6 hours")
    return found.select("user_id", F.unix_micros("started").alias("started_us"), F.unix_micros("ended").alias("ended_us"), "fixes")


def _runner(text: Callable[[Dialect], str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.sql(text(SparkSql(sf_dir)))


_D = Dialect()
_REACHED = f"""WITH RECURSIVE w AS ({weighted(_D)}), q AS ({asked(_D)}), adj AS (SELECT src AS a, dst AS b, length FROM w UNION SELECT dst, src, length FROM w),
    r AS (SELECT src AS query_id, src AS node, CAST(0 AS BIGINT) AS d, most FROM q UNION SELECT r.query_id, adj.b, CAST(r.d + adj.length AS BIGINT), r.most FROM r JOIN adj ON adj.a = r.node WHERE r.d + adj.length <= r.most),
    s AS (SELECT q.src AS query_id, min(r.d) AS distance FROM q JOIN r ON r.query_id = q.src AND r.node = q.dst GROUP BY q.src)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _runner(text) for name, text in SQL.items()} | {
    "point_to_polyline": point_to_polyline,
    "shortest_distances": shortest_distances,
    "shortest_routes": shortest_routes,
    "route_pair_anchors_120m": route_pair_anchors_120m,
    "mojibake_repair": mojibake_repair,
    "repaired_times": repaired_times,
    "event_sessions": event_sessions,
}
ORACLE_SQL: dict[str, str] = {name: text(_D) for name, text in SQL.items()} | {
    "point_to_polyline": _polyline_sql(_D),
    "shortest_distances": f"{_REACHED} SELECT query_id, distance FROM s",
    "shortest_routes": f"{_REACHED} SELECT query_id, 'OK' AS status, distance FROM s",
    "route_pair_anchors_120m": f"""WITH {v.places(_D, "customer", "c_custkey", "p")}, m AS (SELECT a.id AS stop_a, b.id AS stop_b, {_D.haversine("a.lat", "a.lon", "b.lat", "b.lon")} AS dist FROM p a JOIN p b ON a.id <> b.id JOIN customer x ON x.c_custkey = a.id JOIN customer y ON y.c_custkey = b.id AND x.c_nationkey <> y.c_nationkey)
        SELECT stop_a, stop_b, round(dist, 2) AS distance_m FROM m WHERE dist <= 120""",
    "repaired_times": f"""WITH RECURSIVE {v.gps(_D)}, g AS (SELECT trip_id, seq, us + CAST(round({_D.normal('7', 'user_id', 'seq')} * 3600000000) AS BIGINT) AS us FROM gps),
        r AS (SELECT trip_id, seq, us FROM g WHERE seq = 0 UNION ALL SELECT g.trip_id, g.seq, CASE WHEN g.us <= r.us THEN r.us + 100000 ELSE g.us END FROM r JOIN g ON g.trip_id = r.trip_id AND g.seq = r.seq + 1) SELECT trip_id, seq, us FROM r""",
    "mojibake_repair": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents",
    "event_sessions": """WITH e AS (SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE ts IS NOT NULL),
        g AS (SELECT *, sum(CASE WHEN before IS NULL OR us - before >= 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM e)
        SELECT user_id, min(us) AS started_us, max(us) AS ended_us, count(*) AS fixes FROM g GROUP BY user_id, part""",
}
