"""Common table expressions: movement data derived from the given tables."""

from __future__ import annotations

from trajkit.functions.dialect import Dialect


def gps(d: Dialect) -> str:
    return f"""gps AS (SELECT user_id, 'trip_' || lpad(CAST(user_id AS STRING), 6, '0') AS trip_id, event_id, event_type,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, {d.us("ts")} AS us,
        {d.f(37.45)} + (event_id * 7919 % 10000) * {d.f(0.00001)} AS lat, {d.f(126.9)} + (event_id * 104729 % 10000) * {d.f(0.00001)} AS lon,
        least({d.f(35)}, value / 10) AS speed, {d.f(4)} + (CAST(floor(value) AS BIGINT) % 21) AS accuracy, (event_id * 37) % 360 AS course, value
        FROM {d.t("events")})"""


def motion(d: Dialect) -> str:
    lag = lambda c: f"lag({c}) OVER (PARTITION BY user_id ORDER BY seq)"
    return f"""{gps(d)}, lagged AS (SELECT *, {lag("us")} AS us0, {lag("lat")} AS lat0, {lag("lon")} AS lon0, {lag("speed")} AS speed0 FROM gps),
        steps AS (SELECT *, (us - us0) / {d.f(1e6)} AS dt, {d.haversine("lat0", "lon0", "lat", "lon")} AS dist, {d.bearing("lat0", "lon0", "lat", "lon")} AS bearing FROM lagged),
        motion AS (SELECT *, CASE WHEN dt > 0 THEN dist / dt END AS implied FROM steps),
        accel AS (SELECT *, CASE WHEN dt > 0 THEN (implied - lag(implied) OVER (PARTITION BY user_id ORDER BY seq)) / dt END AS acc FROM motion)"""


MODES = "CASE {x} WHEN 0 THEN 'walk' WHEN 1 THEN 'bike' WHEN 2 THEN 'car' WHEN 3 THEN 'bus' ELSE 'rail' END"


def segments(d: Dialect) -> str:
    day = f"CAST(floor({d.us('ts')} / {d.f(86400e6)}) AS BIGINT)"
    return f"""seg AS (SELECT user_id, {day} AS day, min({d.us("ts")}) AS start_us, max({d.us("ts")}) AS end_us FROM {d.t("events")} GROUP BY user_id, {day}),
        segments AS (SELECT user_id, day, start_us, end_us, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS segment_id, {MODES.format(x="(user_id + day) % 5")} AS mode FROM seg)"""


def places(d: Dialect, table: str, key: str, name: str) -> str:
    return f"""{name} AS (SELECT {key} AS id, {d.f(37.45)} + ({d.hex(f"CAST({key} AS STRING) || 'a'", 6)} % 10000) * {d.f(0.00001)} AS lat,
        {d.f(126.9)} + ({d.hex(f"CAST({key} AS STRING) || 'o'", 6)} % 10000) * {d.f(0.00001)} AS lon FROM {d.t(table)})"""


def stops(d: Dialect) -> str:
    return f"""stops AS (SELECT l_orderkey AS route, l_partkey AS stop, l_linenumber AS order_no, l_quantity AS qty,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos FROM {d.t("lineitem")})"""


def edges(d: Dialect) -> str:
    return f"""{stops(d)}, hops AS (SELECT stop AS src, lead(stop) OVER (PARTITION BY route ORDER BY pos) AS dst, route, qty FROM stops),
        edges AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM hops WHERE dst IS NOT NULL AND src <> dst)"""
