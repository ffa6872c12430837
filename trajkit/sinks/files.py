"""Writers of trajectory packages, and their freeze, export and integrity checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajkit.sources.files import GPS_TYPES, listing


def write_gps(fixes: DataFrame, path: str, force: bool = False) -> None:
    """Fixes as CSV, each trip's rows together and in order, a folder for every hundredth part of the trips.

    Coordinates have 7 decimals, speeds 3, accuracies, altitude and course 2; times are ISO-8601 with an
    offset. Refuses a path that is there, unless forced.
    """
    places = {c: 2 for c, t in GPS_TYPES.items() if t == "double"} | {"latitude": 7, "longitude": 7, "speed_mps": 3}
    shown = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c) if t == "timestamp" else F.format_string(f"%.{places[c]}f", c).alias(c) if t == "double" else F.col(c) for c, t in GPS_TYPES.items()]
    shown = [F.when(F.col(c).isNotNull(), x).otherwise("").alias(c) if GPS_TYPES[c] == "double" else x for c, x in zip(GPS_TYPES, shown, strict=True)]
    bucket = F.pmod(F.xxhash64("trip_id"), F.lit(100)).alias("trip_bucket")
    kept = fixes.select(bucket, *GPS_TYPES).repartition("trip_bucket", "trip_id").sortWithinPartitions("trip_bucket", "trip_id", "sequence")
    kept.select("trip_bucket", *shown).write.partitionBy("trip_bucket").csv(path, header=True, mode="overwrite" if force else "errorifexists")


def write_ground_truth(trips: DataFrame, segments: DataFrame, path: str, drop: tuple[str, ...] = ("reference_geometry",), force: bool = False) -> None:
    """One JSON line a trip with its segments in order; trips without segments keep an empty list."""
    kept = [c for c in segments.columns if c not in ("trip_id", *drop)]
    own = segments.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("segment_id", *(c for c in kept if c != "segment_id")))).alias("segments"))
    empty = F.array().cast(own.schema["segments"].dataType)
    trips.join(own, "trip_id", "left").withColumn("segments", F.coalesce("segments", empty)).write.json(path, mode="overwrite" if force else "errorifexists")


def journey_manifest(fixes: DataFrame, trips: DataFrame) -> DataFrame:
    """``trip_id, scenario_category, start_timestamp, end_timestamp, duration_seconds, points`` of every trip."""
    own = fixes.groupBy("trip_id").agg(F.min("timestamp").alias("start_timestamp"), F.max("timestamp").alias("end_timestamp"), F.count("*").alias("points"))
    took = F.floor((F.unix_micros("end_timestamp") - F.unix_micros("start_timestamp")) / 1e6).cast("long")
    return trips.select("trip_id", "scenario_category").join(own, "trip_id", "left").select("trip_id", "scenario_category", "start_timestamp", "end_timestamp", took.alias("duration_seconds"), F.coalesce("points", F.lit(0)).alias("points"))


def union_csv(frames: list[DataFrame], path: str) -> None:
    """All frames in one CSV under the union of their columns; what a frame lacks is empty."""
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    whole.write.csv(path, header=True, mode="errorifexists")


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """``name, length, sha256`` of a package's files, names from its top; the freeze record and markers are left out."""
    found = listing(spark, path, hashes=True).withColumn("name", F.regexp_replace("path", r"^[^/]+:/*(?=/)", ""))
    top = path.split(":", 1)[-1].rstrip("/")
    top = "/" + top.lstrip("/") + "/"
    return found.select(F.expr("name").substr(F.lit(len(top) + 1), F.length("name")).alias("name"), "length", "sha256").filter("name NOT LIKE '\\_freeze/%' AND name NOT LIKE '%\\_SUCCESS' AND name NOT LIKE '%.crc'")


def freeze(spark: SparkSession, path: str, checks: DataFrame, facts: dict[str, str], gate: DataFrame | None = None) -> None:
    """Record the hashes of a package after its last write; refuses while a check (``status``) isn't PASS, without any check, or while the gate's status isn't PASS.

    The record lies in ``_freeze`` below the package: a table of hashes and one row of facts.
    """
    total, failed = checks.agg(F.count("*"), F.count_if(F.coalesce(F.col("status") != "PASS", F.lit(True)))).first()
    if failed or not total:
        raise ValueError(f"{failed} of {total} checks did not pass: the package is not frozen")
    if gate is not None and [r.status for r in gate.select("status").limit(2).collect()] != ["PASS"]:
        raise ValueError("the release gate did not pass: the package is not frozen")
    fingerprints(spark, path).write.parquet(f"{path}/_freeze/hashes")
    spark.createDataFrame([(json.dumps(facts, sort_keys=True),)], "facts string").write.parquet(f"{path}/_freeze/facts")


def integrity(spark: SparkSession, path: str) -> DataFrame:
    """``name, state`` (same, changed, missing, added) of every file against the freeze record."""
    then = spark.read.parquet(f"{path}/_freeze/hashes").select("name", F.col("sha256").alias("then"))
    now = fingerprints(spark, path).select("name", F.col("sha256").alias("now"))
    state = F.when(F.col("now").isNull(), "missing").when(F.col("then").isNull(), "added").when(F.col("now") == F.col("then"), "same").otherwise("changed")
    return then.join(now, "name", "full_outer").select("name", state.alias("state"))


def export(spark: SparkSession, path: str, to: str, tables: dict[str, str]) -> None:
    """Copy tables (folder -> format) of a frozen, unchanged package and record the copy's hashes."""
    changed = integrity(spark, path).filter("state <> 'same'").count()
    if changed:
        raise ValueError(f"{changed} files differ from the freeze record: nothing is exported")
    for name, kind in tables.items():
        spark.read.format(kind).load(f"{path}/{name}").write.format(kind).mode("errorifexists").save(f"{to}/{name}")
    freeze(spark, to, spark.createDataFrame([("PASS",)], "status string"), {"from": path})


def _mode(force: bool) -> str:
    return "overwrite" if force else "errorifexists"


def ground_truth_rows(trips: DataFrame, segments: DataFrame, events: DataFrame, transfers: DataFrame) -> DataFrame:
    """A row a trip, nested as its ground truth file has it: ends, validation with its transfers, and segments with their timeline; the reference's own geometry is left out."""
    at = lambda us: F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    seen = events.groupBy("trip_id", "leg").agg(F.transform(F.array_sort(F.collect_list(F.struct("start_us", "event_type", "end_us", "lat", "lon"))), lambda e: F.struct(e["event_type"].alias("event_type"), at(e["start_us"]).alias("start_time"), at(e["end_us"]).alias("end_time"), e["lat"].alias("lat"), e["lon"].alias("lon"))).alias("timeline_events"))
    own = segments.join(seen, ["trip_id", "leg"], "left").withColumn("timeline_events", F.coalesce("timeline_events", F.array().cast(seen.schema["timeline_events"].dataType)))
    fit = F.struct(F.col("geometry_status").alias("status"), "max_error_m", "p95_error_m", F.col("geometry_hash").alias("reference_geometry_hash"))
    item = F.struct(F.col("leg").alias("segment_id"), "mode", at(F.col("start_us")).alias("start_time"), at(F.col("end_us")).alias("end_time"), "start", "end", F.col("reference").alias("network_reference"), "line", "sequence", fit.alias("validation"), "timeline_events")
    whole = own.groupBy("trip_id").agg(F.array_sort(F.collect_list(item)).alias("segments"), F.min_by("start", "leg").alias("origin"), F.max_by("end", "leg").alias("destination"), at(F.min("start_us")).alias("start_time"), at(F.max("end_us")).alias("end_time"))
    moved = transfers.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("leg", "from_mode", "to_mode", "distance_m", "kind", "valid"))).alias("transfers"))
    both = trips.select("trip_id", F.col("category").alias("scenario_category")).join(whole, "trip_id").join(moved, "trip_id", "left")
    checked = F.struct(F.coalesce("transfers", F.array().cast(moved.schema["transfers"].dataType)).alias("transfers"))
    line = F.struct(F.col("trip_id").alias("single_trip_id"), F.lit(True).alias("continuous"))
    return both.select("trip_id", "scenario_category", "start_time", "end_time", "origin", "destination", line.alias("journey_timeline"), checked.alias("post_generation_validation"), "segments")


def dataset_manifest(trips: DataFrame, segments: DataFrame, fixes: DataFrame, facts: dict[str, str]) -> DataFrame:
    """One row: journeys by category and noise profile, segments by mode, all fixes, and facts such as seed and configuration hash."""
    as_map = lambda rows, key: rows.groupBy(key).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "count")))).alias(f"{key}_counts"))
    one = trips.agg(F.count("*").alias("journey_count")).crossJoin(fixes.agg(F.count("*").alias("gps_event_count")))  # single rows, as all that follow
    for rows, key in ((trips, "category"), (trips, "noise"), (segments, "mode")):
        one = one.crossJoin(as_map(rows, key))
    return one.select(*(F.lit(v).alias(k) for k, v in sorted(facts.items())), *one.columns)


def write_package(path: str, data, events: DataFrame, transfers: DataFrame, facts: dict[str, str], force: bool = False) -> None:
    """A generated dataset as a package: fixes, ground truth, true trajectories and manifests."""
    write_gps(data.fixes, f"{path}/gps", force)
    ground_truth_rows(data.trips, data.segments, events, transfers).write.json(f"{path}/ground_truth", mode=_mode(force))
    true = data.points.filter("NOT joint").select("trip_id", "idx", F.timestamp_micros("us").alias("timestamp"), "lat", "lon", "speed", F.col("leg").alias("segment_id"), "mode")
    true.repartition("trip_id").sortWithinPartitions("trip_id", "idx").write.parquet(f"{path}/true_trajectories", mode=_mode(force))
    own = data.trips.select("trip_id", F.col("category").alias("scenario_category"))
    journey_manifest(data.fixes, own).write.csv(f"{path}/manifests/journeys", header=True, mode=_mode(force))
    dataset_manifest(data.trips, data.segments, data.fixes, facts).coalesce(1).write.json(f"{path}/manifests/dataset", mode=_mode(force))


def write_graph(graph: dict[str, DataFrame], path: str, mode: str, force: bool = False) -> None:
    """A mode's nodes, edges and restrictions as tables, and one row of statistics beside them."""
    for name, df in graph.items():
        df.write.parquet(f"{path}/{mode}/{name}", mode=_mode(force))
    stats = graph["nodes"].agg(F.count("*").alias("nodes")).crossJoin(graph["edges"].agg(F.count("*").alias("edges"), F.round(F.sum("length_m"), 3).alias("length_m")))  # single rows
    stats.write.json(f"{path}/{mode}/stats", mode=_mode(force))


def write_network(rows: DataFrame, path: str, nested: tuple[str, ...], force: bool = False) -> None:
    """A reference network: all rows with their geometry as a table, and the validation columns alone as CSV."""
    rows.write.parquet(f"{path}/network", mode=_mode(force))
    rows.drop(*nested).write.csv(f"{path}/validation", header=True, mode=_mode(force))


def write_checks(checks: DataFrame, path: str, force: bool = False) -> None:
    """Checks as CSV by scope; a scope without checks has a file with a header, and none has a row that says PASS for want of one."""
    for scope in ("dataset", "trip", "segment"):
        checks.filter(F.col("scope") == scope).drop("scope").write.csv(f"{path}/{scope}", header=True, mode=_mode(force))


def write_pages(pages: DataFrame, path: str, force: bool = False) -> None:
    """Trip pages as text, a file a task, each page on a line of its own under its trip's folder bucket."""
    pages.select(F.pmod(F.xxhash64("trip_id"), F.lit(100)).alias("bucket"), F.col("html").alias("value")).write.mode(_mode(force)).partitionBy("bucket").text(path)
