"""Spatial joins on grid cells, so that only points and lines of touching cells meet."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trajkit.functions.dialect import EARTH_M
from trajkit.session import sent_if_small, written


def haversine(a: Column, b: Column, c: Column, d: Column) -> Column:
    h = F.pow(F.sin(F.radians(c - a) * 0.5), 2) + F.cos(F.radians(a)) * F.cos(F.radians(c)) * F.pow(F.sin(F.radians(d - b) * 0.5), 2)
    return 2.0 * EARTH_M * F.asin(F.sqrt(F.when(h > 1.0, 1.0).otherwise(h)))  # null stays null, as least() would not have it


#: Rows of a cell's left side that meet its right side in one task.
CROWD = 4096


def bearing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Degrees from north, 0 to 360, of the way from (a, b) to (c, d)."""
    y = F.sin(F.radians(d - b)) * F.cos(F.radians(c))
    x = F.cos(F.radians(a)) * F.sin(F.radians(c)) - F.sin(F.radians(a)) * F.cos(F.radians(c)) * F.cos(F.radians(d - b))
    raw = F.degrees(F.atan2(y, x)) + 360
    return raw - 360 * F.floor(raw / 360)


def projected(lat: Column, lon: Column, a: Column, b: Column, c: Column, d: Column) -> Column:
    """``dist, lat, lon, share`` of the point of the segment (a, b)-(c, d) nearest to (lat, lon), in a plane at the latter."""
    k = math.pi * EARTH_M / 180
    wide = F.cos(F.radians(lat))
    ay, ax, dy, dx = (a - lat) * k, (b - lon) * k * wide, (c - a) * k, (d - b) * k * wide
    t = F.when(dx * dx + dy * dy > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / (dx * dx + dy * dy)))).otherwise(F.lit(0.0))
    dist = F.sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))
    return F.struct(dist.alias("dist"), (a + t * (c - a)).alias("lat"), (b + t * (d - b)).alias("lon"), t.alias("share"))


def nearest_segment(points: DataFrame, segments: DataFrame, *key: str, least: float = 0.002) -> DataFrame:
    """``id, part, dist, lat, lon``: for each point (``id, *key, lat, lon``) the nearest segment of its line.

    ``segments``: ``*key, part, alat, alon, blat, blon``; ties go to the smaller part, points of lines without
    segments are left out. Segments are laid into the grid cells that their box covers, points look into
    the 3x3 cells around theirs; what lies farther than a cell, or finds nothing, meets its whole line. A
    cell is as wide as two mean segments, ``least`` degrees at least, so a segment covers few cells.
    """
    extent = segments.agg(F.avg(F.greatest(F.abs(F.col("alat") - F.col("blat")), F.abs(F.col("alon") - F.col("blon"))))).first()[0]
    cell = max(least, 2 * (extent or 0.0))
    span = lambda p, q: F.explode(F.sequence(F.floor(F.least(p, q) / cell), F.floor(F.greatest(p, q) / cell)))
    laid = segments.withColumn("i", span("alat", "blat")).withColumn("j", span("alon", "blon"))
    near = F.array(*(F.lit(x) for x in (-1, 0, 1)))
    looks = points.withColumn("di", F.explode(near)).withColumn("dj", F.explode(near))
    looks = looks.withColumn("i", F.floor(F.col("lat") / cell) + F.col("di")).withColumn("j", F.floor(F.col("lon") / cell) + F.col("dj")).drop("di", "dj")
    at = projected(*(F.col(c) for c in ("lat", "lon", "alat", "alon", "blat", "blon")))

    def best(pairs: DataFrame) -> DataFrame:
        met = pairs.select("id", "part", at.alias("p"))
        return met.groupBy("id").agg(F.min(F.struct("p.dist", "part", "p.lat", "p.lon")).alias("m")).select("id", "m.part", "m.dist", "m.lat", "m.lon")

    found = best(looks.join(laid, [*key, "i", "j"]))
    reach = F.lit(cell * math.pi * EARTH_M / 180) * F.cos(F.radians("lat")) * 0.999
    sure = found.join(points.select("id", reach.alias("reach")), "id").filter("dist <= reach").drop("reach")
    left = points.join(sure.select("id"), "id", "left_anti")
    return sure.unionByName(best(left.join(segments, list(key))))


#: Places of a line up to which its points meet all of it; longer lines are laid into cells.
PLACES = 65


def off_line(lat: np.ndarray, lon: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Metres from each place to the nearest piece of a line of ``places`` (rows of lat, lon), as ``projected``; NaN for less than two places."""
    k, best = math.pi * EARTH_M / 180, np.full(len(lat), np.inf if len(places) > 1 else np.nan)
    wide = np.cos(np.radians(lat)) * k
    for (a, b), (c, d) in zip(places[:-1], places[1:], strict=True):
        ay, ax, dy, dx = (a - lat) * k, (b - lon) * wide, (c - a) * k, (d - b) * wide
        size = dx * dx + dy * dy
        t = np.where(size > 0, np.clip(-(ax * dx + ay * dy) / np.where(size > 0, size, 1.0), 0.0, 1.0), 0.0)
        best = np.minimum(best, (ax + t * dx) ** 2 + (ay + t * dy) ** 2)
    return np.sqrt(best)


def pieces(lines: DataFrame, *key: str) -> DataFrame:
    """``*key, part, alat, alon, blat, blon``: the pieces of ``*key, line`` (an array of ``lat, lon``)."""
    own = lines.select(*key, "line", F.posexplode("line").alias("part", "p")).withColumn("q", F.get("line", F.col("part") + 1)).filter("q IS NOT NULL")
    return own.select(*key, "part", F.col("p.lat").alias("alat"), F.col("p.lon").alias("alon"), F.col("q.lat").alias("blat"), F.col("q.lon").alias("blon"))


def line_distances(points: DataFrame, lines: DataFrame, *key: str, id: str) -> DataFrame:
    """``points`` (``*key, id, lat, lon`` and others) with ``dist``, the metres to their line (``*key, line``), one a key; points without a line are left out.

    Points and lines are brought together and in order by one exchange, and each line goes before its points. Lines of
    more than ``PLACES`` places are searched by cells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places = None, None
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            first, keys = batch.column("_kind").to_numpy() == 0, [batch.column(c) for c in key]
            new = first.copy()
            new[0], new[1:] = True, new[1:] | first[:-1]
            for c in keys:
                new[1:] |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
            lat, lon = (pc.fill_null(batch.column(c), math.nan).to_numpy(zero_copy_only=False) for c in ("lat", "lon"))
            dist, kept, cuts = np.full(n, np.nan), np.zeros(n, bool), np.append(np.flatnonzero(new), n)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = tuple(c[int(a)].as_py() for c in keys)
                if first[a]:
                    now, places = own, np.array([(p["lat"], p["lon"]) for p in batch.column("_line")[int(a)].as_py()], float).reshape(-1, 2)
                elif own == now:
                    dist[a:b], kept[a:b] = off_line(lat[a:b], lon[a:b], places), True
            if kept.any():
                out = batch.select(names).append_column("dist", pa.array(dist, from_pandas=True))
                yield out if kept.all() else out.filter(pa.array(kept))

    names = points.columns
    some = lines.filter(F.size("line") <= PLACES).select(*key, F.col("line").alias("_line"), F.lit(0).alias("_kind")).dropna(subset=list(key))
    rows = some.unionByName(points.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    kinds = StructType([*(StructField(f.name, f.dataType) for f in points.schema.fields), StructField("dist", DoubleType())])
    out = rows.repartition(*key).sortWithinPartitions(*key, "_kind").mapInArrow(run, kinds)
    long = lines.filter(F.size("line") > PLACES)
    if long.isEmpty():
        return out
    own = points.join(long.select(*key), list(key), "left_semi")
    near = nearest_segment(own.select(F.struct(*key, id).alias("id"), *key, "lat", "lon"), written(pieces(long, *key), "spatial-pieces"), *key)
    near = near.select(*(F.col(f"id.{c}").alias(c) for c in (*key, id)), "dist")
    return out.unionByName(own.join(near, [*key, id], "left").select(out.columns))


def within(left: DataFrame, right: DataFrame, radius_m: float, k: int | None = None, max_lat: float = 89.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """``left_id, right_id, dist, rank`` of pairs of ``id, lat, lon`` rows at most ``radius_m`` apart, with ``k`` the nearest only.

    Cells are as high as the radius and as wide as it is at the left rows' farthest latitude, so a right
    row sent to the 3x3 cells around it meets every left row within the radius; cells go round the globe,
    so the 180th meridian is no border. Left rows nearer to a pole than ``max_lat`` allows raise an error.
    Without ``k``, columns to ``carry`` come along as ``left_`` and ``right_`` and their name.
    """
    if k is not None:
        return _nearest(left, right, radius_m, k, max_lat)
    lat_step = math.degrees(radius_m / EARTH_M) * 1.0001
    bound = left.select(F.max(F.abs("lat")).alias("m")).first()["m"] or 0.0
    if bound + lat_step > max_lat:
        raise ValueError(f"points beyond {max_lat} degrees from the equator need a larger max_lat (below 90)")
    n_lon = math.floor(360 / (lat_step / math.cos(math.radians(bound + lat_step))))  # cells around the globe: the last touches the first
    lon_step = 360 / max(n_lon, 1)
    y, x, wide = F.radians("lat"), F.radians("lon"), F.cos(F.radians("lat"))
    cell = lambda df: df.select("id", "lat", "lon", *carry, (wide * F.cos(x)).alias("x"), (wide * F.sin(x)).alias("y"), F.sin(y).alias("z"), F.floor(F.col("lat") / lat_step).alias("i"), F.pmod(F.floor(F.col("lon") / lon_step), F.lit(n_lon)).alias("j"))
    near = F.array(*(F.lit(x) for x in (-1, 0, 1)))
    turn = F.array(*(F.lit(x) for x in ((-1, 0, 1) if n_lon > 2 else range(n_lon))))
    r = cell(right).withColumn("di", F.explode(near)).withColumn("dj", F.explode(turn))
    r = r.select((F.col("i") + F.col("di")).alias("i"), F.pmod(F.col("j") + F.col("dj"), F.lit(n_lon)).alias("j"), F.col("id").alias("right_id"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), *(F.col(c).alias(f"r{c}") for c in "xyz"), *(F.col(c).alias(f"right_{c}") for c in carry))
    own = cell(left).withColumnsRenamed({c: f"left_{c}" for c in carry})
    # a crowded cell's left side is dealt into parts, and its right side goes to each of them
    crowd = own.groupBy("i", "j").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("parts")).filter("parts > 1")
    crowd = sent_if_small(written(crowd, "spatial-crowd"))
    own = own.join(crowd, ["i", "j"], "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    r = r.join(crowd, ["i", "j"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    # the square of the straight line between two rows is cheaper than the distance and, with some slack, leaves most of the others out
    line = sum((F.col(c) - F.col(f"r{c}")) * (F.col(c) - F.col(f"r{c}")) for c in "xyz")
    slack = (2 * math.sin(min(radius_m / EARTH_M, math.pi) / 2)) ** 2 * (1 + 1e-6) + 1e-13
    pairs = own.join(r, ["i", "j", "part"]).filter(line <= slack)
    pairs = pairs.select(F.col("id").alias("left_id"), "right_id", haversine(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon")).alias("dist"), *(f"{s}_{c}" for s in ("left", "right") for c in carry))
    return pairs.filter(F.col("dist") <= radius_m)


def _nearest(left: DataFrame, right: DataFrame, radius_m: float, k: int, max_lat: float) -> DataFrame:
    """The k nearest within the radius, from a radius that holds a few times k rows where these are densest.

    Rows that find k of them within a radius have their nearest, ties included; the others go on with twice
    the radius, up to ``radius_m``. Of right rows at one place only the k first by id can be among the nearest.
    """
    right = right.select("id", "lat", "lon").withColumn("copy", F.row_number().over(Window.partitionBy("lat", "lon").orderBy("id"))).filter(F.col("copy") <= k).drop("copy")
    left, right = written(left.select("id", "lat", "lon"), "spatial-left"), written(right, "spatial-right")
    step = math.degrees(radius_m / EARTH_M)
    most = right.groupBy(F.floor(F.col("lat") / step), F.floor(F.col("lon") / step)).count().agg(F.max("count")).first()[0] or 1
    reach, out = min(radius_m, radius_m * math.sqrt(3 * k / (math.pi * most))), None
    while True:
        last = reach > radius_m / 2
        pairs = within(left, right, radius_m if last else reach, max_lat=max_lat)
        found = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("left_id").orderBy("dist", "right_id"))).filter(F.col("rank") <= k)
        if last:
            return found if out is None else out.unionByName(found)
        found = written(found, "spatial-near")
        full = found.filter(F.col("rank") == k).select("left_id")
        sure = found.join(full, "left_id", "left_semi")
        out = sure if out is None else out.unionByName(sure)
        left = written(left.join(full, left.id == full.left_id, "left_anti"), "spatial-left")
        if left.isEmpty():
            return out
        reach *= 2
