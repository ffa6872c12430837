"""Readers of reference data: networks and catalogs in JSON, graphs as tables, landed map elements, and what lies in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajkit.sources import files

STATION = "struct<name:string,lat:double,lon:double,osm_id:long,line_id:string>"
NETWORK = f"stations array<{STATION}>, bus_routes array<struct<route_id:string,route_name:string,stops:array<struct<name:string,lat:double,lon:double>>>>, surface_corridors array<struct<corridor_id:string,source:string,geometry:array<array<double>>>>"
RAIL = "lines array<struct<line_id:string,relation_id:long,direction_from:string,direction_to:string,geometry:array<array<double>>,station_sequence:array<struct<name:string,lat:double,lon:double,osm_id:long>>,validation:struct<status:string>>>"
BUS = "routes array<struct<route_id:string,route_uid:long,direction:string,routing_profile:string,route_geometry_reference:string,stops:array<struct<ars_id:string,name:string,sequence:int,lat:double,lon:double>>,pair_geometry:array<struct<distance_m:double,geometry:array<array<double>>>>,validation:struct<status:string>>>"


def network(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Stations, bus routes and corridors of a network file; running a frame fails on a place outside the globe or a row without its name."""
    raw = spark.read.schema(NETWORK).json(path, multiLine=True)
    stations = raw.select(F.explode("stations").alias("s")).select("s.*")
    bad = ~(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    stations = stations.withColumn("lat", F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("a station without a place on the globe: "), F.coalesce("name", F.lit("")))).cast("double")).otherwise(F.col("lat")))
    return {
        "stations": files.require_values(stations, "name", "line_id"),
        "bus_routes": raw.select(F.explode("bus_routes").alias("r")).select("r.*"),
        "surface_corridors": raw.select(F.explode("surface_corridors").alias("c")).select("c.*"),
    }


def distinct_stations(stations: DataFrame, order: str = "place") -> DataFrame:
    """One row an ``osm_id``: the last by ``order``."""
    last = F.row_number().over(Window.partitionBy("osm_id").orderBy(F.desc(order)))
    return stations.withColumn("_last", last).filter("_last = 1").drop("_last")


def rail_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Rail lines that passed and have three stations."""
    rows = spark.read.schema(RAIL).json(path, multiLine=True).select(F.explode("lines").alias("l")).select("l.*")
    return rows.filter("validation.status = 'PASS' AND size(station_sequence) >= 3")


def bus_catalog(spark: SparkSession, path: str, override: str | None = None) -> DataFrame:
    """Bus routes that passed and have geometry between all stops; a later release's file (``override``) takes the place of the first."""
    rows = spark.read.schema(BUS).json(override or path, multiLine=True).select(F.explode("routes").alias("r")).select("r.*")
    whole = "size(pair_geometry) = size(stops) - 1 AND forall(pair_geometry, p -> size(p.geometry) > 0)"
    return rows.filter(f"validation.status = 'PASS' AND {whole}")


def line_stops(catalog: DataFrame, kind: str) -> DataFrame:
    """``ref, place, name, lat, lon`` of a catalog's lines (``kind`` rail or bus), as the synthesis takes them."""
    key, stops = ("relation_id", "station_sequence") if kind == "rail" else ("route_uid", "stops")
    name = "name" if kind == "rail" else "ars_id"
    return catalog.select(F.col(key).cast("string").alias("ref"), F.posexplode(stops).alias("place", "s")).select("ref", "place", F.col(f"s.{name}").alias("name"), "s.lat", "s.lon")


def graph(spark: SparkSession, path: str, mode: str) -> dict[str, DataFrame]:
    """``nodes``, ``edges`` and ``restrictions`` of a mode's graph; a frame is read when it is used. Restrictions matter to cars only."""
    out = {n: spark.read.parquet(f"{path}/{mode}/{n}") for n in ("nodes", "edges")}
    rules = spark.read.parquet(f"{path}/{mode}/restrictions") if mode == "car" else spark.createDataFrame([], "region long, from_way long, via long, to_way long")
    return {**out, "restrictions": rules}


def context(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All that an audit compares with: official routes, bus and rail catalogs, and the graph of each mode."""
    out = {"bus": bus_catalog(spark, f"{root}/bus_network.json"), "rail": rail_catalog(spark, f"{root}/rail_network.json")}
    for mode in ("walk", "bike", "car"):
        out |= {f"{mode}_{n}": df for n, df in graph(spark, f"{root}/graphs", mode).items()}
    return out


def stop_rows(rows: DataFrame) -> DataFrame:
    """Official stop rows under our names and types; what can't be read as a number is null."""
    num = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return rows.select(F.col("route_id").cast("string").alias("route"), F.expr("try_cast(sequence AS INT)").alias("no"), F.trim("ars_id").alias("ars_id"), F.trim("name").alias("name"), num("lat").alias("lat"), num("lon").alias("lon"))


def coordinate_coverage(rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row: rows, those with places in the country's box (120-132 E, 30-40 N), and the box that they fill."""
    ok = F.col(lat).between(30, 40) & F.col(lon).between(120, 132)
    inside = lambda c: F.when(ok, F.col(c))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(ok).alias("valid"), F.min(inside(lat)).alias("min_lat"), F.max(inside(lat)).alias("max_lat"), F.min(inside(lon)).alias("min_lon"), F.max(inside(lon)).alias("max_lon"))


def candidate_points(stops: DataFrame) -> DataFrame:
    """Stops with a place, once each, as ends of test routes."""
    return stops.filter("lat IS NOT NULL AND lon IS NOT NULL").select("ars_id", "lat", "lon").dropDuplicates(["ars_id"])


def by_name(rows: DataFrame, order: str) -> DataFrame:
    """``name, first, last, all``: of the rows of a name the first, the last and all in order; nameless rows are left out."""
    kept = rows.filter("name IS NOT NULL AND name <> ''")
    one = F.struct(F.col(order).alias("o"), *(c for c in rows.columns if c not in ("name", order)))
    return kept.groupBy("name").agg(F.min(one).alias("first"), F.max(one).alias("last"), F.array_sort(F.collect_list(one)).alias("all"))


def anchored(names: DataFrame, places: DataFrame, fallback: DataFrame, n_fallback: int) -> DataFrame:
    """``route, no, name, lat, lon`` of named anchors (``route, place, name``): the place of that name, else one of the numbered ``fallback`` places, picked by the name's hash; numbered from 1."""
    first = places.groupBy("name").agg(F.min_by(F.struct("lat", "lon"), "id").alias("p"))
    pick = F.pmod(F.conv(F.substring(F.sha2("name", 256), 1, 8), 16, 10).cast("long"), F.lit(n_fallback))
    spare = fallback.select(F.col("no").alias("pick"), F.struct("lat", "lon").alias("q"))
    out = names.join(first, "name", "left").withColumn("pick", pick).join(spare, "pick", "left").withColumn("at", F.coalesce("p", "q"))
    no = F.row_number().over(Window.partitionBy("route").orderBy("place"))
    return out.select("route", no.alias("no"), "name", "at.lat", "at.lon")


def corridors(hubs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``from_name, to_name`` with the places of both hubs (``name, lat, lon``); pairs without both hubs are left out."""
    end = lambda x: hubs.select(F.col("name").alias(f"{x}_name"), F.struct("lat", "lon").alias(f"{x}_at"))
    return pairs.join(end("from"), "from_name").join(end("to"), "to_name")


def canonical(value: Column) -> Column:
    """JSON text of a struct or map with its keys sorted and no spaces, for hashing."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def config_hash(settings: dict[str, object]) -> str:
    """The hash of settings as canonical JSON."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
