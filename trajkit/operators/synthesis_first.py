"""The first synthesis model: corridors and straight lines between stops, eight patterns of modes, speeds that swing.

Like ``synthesis``, all draws are keyed, and a journey is one task's work.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajkit.operators.numbering import draw, weighted
from trajkit.operators.synthesis import POINTS, Catalog, Draws, _metres, _points

#: Patterns of modes, pace and range of speed by mode, spacing of points, hours with their pace, dwell, and what hard cases do to the pace.
PATTERNS = (
    ("walk", "rail", "walk"),
    ("walk", "bus", "walk"),
    ("walk", "bike", "walk"),
    ("walk", "car", "walk"),
    ("walk", "bus", "rail", "walk"),
    ("walk", "rail", "bus", "walk"),
    ("walk", "bike", "rail", "walk"),
    ("walk", "bus", "rail", "bus", "walk"),
)
PACE = {"walk": 1.35, "bike": 4.8, "car": 9.0, "bus": 7.5, "rail": 13.5}
RANGE = {"walk": (0.65, 2.2), "bike": (1.0, 9.5), "car": (0.2, 22.0), "bus": (0.0, 17.0), "rail": (0.0, 25.0)}
SPACING = {"walk": 30.0, "bike": 30.0, "car": 30.0, "rail": 55.0, "bus": 40.0}
HOURS = {"commute_morning": (7, 9, 0.82), "daytime": (10, 16, 1.0), "commute_evening": (17, 20, 0.78), "evening": (20, 23, 0.92), "weekend": (11, 18, 1.05)}
STOP_S = {"bus": (8, 38), "rail": (22, 76)}
HARD = {"congested_car": ("car", 0.48), "stop_like_car": ("car", 0.48), "fast_bike": ("bike", 1.45), "slow_bike": ("bike", 0.42), "fast_walk": ("walk", 1.35), "walking_bike": ("bike", 0.28), "slow_bus": ("bus", 0.55)}
NOISE = (("clean", 0.2), ("normal", 0.6), ("noisy", 0.2))
TICK_S, ZIGZAG = 5, 0.0012


def start_us(number: Column, seed: int, first_day: str = "2026-03-01") -> Column:
    """A start on one of seven days, in an hour of one of the day's profiles, in microseconds."""
    u = lambda what: draw(F.lit(seed), number, F.lit(what))
    names = sorted(HOURS)
    which = F.floor(u("profile") * len(names))
    hour = F.lit(0.0)
    for i, n in enumerate(names):
        low, high, _ = HOURS[n]
        hour = F.when(which == i, low + F.floor(u("hour") * max(1, high - low))).otherwise(hour)
    seconds = F.floor(u("day") * 7) * 86400 + hour * 3600 + F.floor(u("minute") * 60) * 60 + F.floor(u("second") * 60)
    return F.unix_micros(F.lit(first_day).cast("timestamp")) + (seconds * 1_000_000).cast("long")


def seeded(rows: DataFrame, seed: int, devices: int = 23) -> DataFrame:
    """``rows`` of ``number, category, hard_case`` with names, noise profile (by weight) and start."""
    noise = weighted(dict(NOISE), F.lit(seed), "number", F.lit("noise"))
    return rows.select("number", F.format_string("trip_%06d", "number").alias("trip_id"), F.format_string("device_%03d", F.col("number") % devices + 1).alias("device_id"), "category", "hard_case", noise.alias("noise"), start_us(F.col("number"), seed).alias("start_us"))


def plan(trips: DataFrame, cat: Catalog, corridors: DataFrame, seed: int) -> DataFrame:
    """``trip_id, leg, mode, ref, places, stop_count`` of all legs: a corridor, one way or the other, or a stretch of a line.

    ``corridors``: ``no, id, places`` numbered from 0. A journey of several modes follows one of eight patterns.
    """
    u = lambda what: draw(F.lit(seed), "number", "leg", F.lit(what))
    patterns = F.array(*(F.array(*(F.lit(m) for m in p)) for p in PATTERNS))
    pick = F.element_at(patterns, (F.floor(draw(F.lit(seed), "number", F.lit("pattern")) * len(PATTERNS)) + 1).cast("int"))
    modes = F.when(F.col("category") == "multimodal", pick).otherwise(F.array("category"))
    legs = trips.select("number", "trip_id", F.posexplode(modes).alias("leg", "mode"))
    n = corridors.count()
    own = legs.filter(F.col("mode").isin("walk", "bike", "car")).withColumn("no", F.floor(u("corridor") * n)).join(corridors, "no")
    turned = F.when(u("turn") < 0.5, F.reverse("places")).otherwise(F.col("places"))
    out = own.select("trip_id", "leg", "mode", F.col("id").cast("string").alias("ref"), turned.alias("places"), F.lit(0).alias("stop_count"))
    for kind in ("rail", "bus"):
        if cat.n_lines[kind]:
            met = legs.filter(F.col("mode") == kind).withColumn("no", F.floor(u("line") * cat.n_lines[kind])).join(cat.lines.filter(F.col("kind") == kind), "no")
            met = met.withColumn("lo", F.floor(u("lo") * (F.col("n") - 1)).cast("int"))
            met = met.withColumn("hi", (F.col("lo") + 1 + F.floor(u("hi") * (F.col("n") - 1 - F.col("lo")))).cast("int"))
            count = F.greatest(F.col("hi") - F.col("lo") - 1, F.lit(0)) if kind == "bus" else F.lit(0)
            out = out.unionByName(met.select("trip_id", "leg", "mode", "ref", _points(F.expr("slice(stops, lo + 1, hi - lo + 1)")).alias("places"), count.alias("stop_count")))
    return out


def resampled(lat: np.ndarray, lon: np.ndarray, spacing: float) -> tuple[np.ndarray, np.ndarray]:
    """Places every ``spacing`` metres along a line, and its last vertex."""
    along = np.append(0.0, np.cumsum(_metres(lat, lon)))
    at = np.arange(0.0, along[-1], spacing)
    at = np.append(at, along[-1]) if along[-1] > at[-1] else at
    return np.interp(at, along, lat), np.interp(at, along, lon)


def joined(end: tuple[float, float], lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A line that begins at ``end`` and reaches its first vertex by a zig-zag around the middle."""
    y, x = (end[0] + lat[0]) / 2, (end[1] + lon[0]) / 2
    return np.concatenate([[end[0], y + ZIGZAG, y - ZIGZAG], lat]), np.concatenate([[end[1], x - ZIGZAG, x + ZIGZAG], lon])


def pace_of_hour(us: int, u: Draws) -> float:
    hour = datetime.datetime.fromtimestamp(us // 1_000_000, datetime.UTC).hour
    for low, high, factor in HOURS.values():
        if low <= hour < high:
            return factor * u(0.9, 1.1)
    return 1.0


def ticks(mode: str, total: float, stop_count: int, factor: float, hard_case: str | None, u: Draws) -> Iterator[tuple[float, float, float]]:
    """(seconds, metres along, speed) every five seconds, stops spread evenly along the leg, and the end five seconds on."""
    marks = [total * i / (stop_count + 1) for i in range(1, stop_count + 1)] if mode in STOP_S else []
    kind, change = HARD.get(hard_case or "", ("", 1.0))
    base = PACE[mode] * factor * (change if kind == mode else 1.0)
    low, high = RANGE[mode]
    t = at = last = 0.0
    passed, wait = 0, 0.0
    while at < total:
        if passed < len(marks) and at >= marks[passed]:
            a, b = STOP_S[mode]
            passed, wait = passed + 1, math.floor(u(a, b + 1))
        if wait > 0:
            yield t, at, 0.0
            wait, at = wait - TICK_S, min(total, at + 0.01)
        else:
            share = at / total
            if mode == "rail":
                swing = 0.4 + 0.65 * math.sin(share * math.pi) + u(-0.08, 0.08)
            else:
                swing = 0.72 + 0.22 * math.sin(share * math.pi * 4 + u(0.0, 0.8)) + u(-0.16, 0.16)
                if mode == "car" and share < 0.12 or share > 0.88:
                    swing *= 0.7
            v = max(0.0, base * swing)
            if mode == "car" and u(0, 1) < 0.04 or mode == "bus" and u(0, 1) < 0.06:
                v = 0.0
            v = max(low, min(high, min(v, last * 1.5) if last else v))
            yield t, at, v
            last, at = v, min(total, at + v * TICK_S)
        t += TICK_S
    yield t, total, 0.0


def move(legs: DataFrame, trips: DataFrame, seed: int) -> DataFrame:
    """The true points of journeys, in the columns of ``synthesis.move``; a leg is joined to the one before by a zig-zag."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out, clock, trip, end = [], int(part.start_us.iloc[0]), part.trip_id.iloc[0], None
        for leg in part.sort_values("leg").itertuples():
            lat, lon = (np.array([p[k] for p in leg.places], float) for k in ("lat", "lon"))
            lat, lon = resampled(lat, lon, SPACING[leg.mode])
            if end is not None:
                lat, lon = joined(end, lat, lon)
            along = np.append(0.0, np.cumsum(_metres(lat, lon)))
            if along[-1] <= 0:
                continue
            u = Draws(seed, trip, leg.leg)
            rows = list(ticks(leg.mode, float(along[-1]), int(leg.stop_count), pace_of_hour(clock, u), leg.hard_case, u))
            t, d, v = (np.array(x) for x in zip(*rows, strict=True))
            y, x = np.interp(d, along, lat), np.interp(d, along, lon)
            p, q, dl = np.radians(y[:-1]), np.radians(y[1:]), np.radians(np.diff(x))
            turn = np.degrees(np.arctan2(np.sin(dl) * np.cos(q), np.cos(p) * np.sin(q) - np.sin(p) * np.cos(q) * np.cos(dl))) % 360
            course = pd.Series(np.append(np.where(np.diff(d) > 0.02, turn, np.nan), np.nan)).ffill().fillna(0.0).to_numpy()
            us = clock + (t * 1e6).astype(np.int64)
            out.append(pd.DataFrame({"leg": leg.leg + 1, "mode": leg.mode, "us": us, "lat": y, "lon": x, "speed": v, "course": course, "joint": np.append(bool(out), np.zeros(len(t) - 1, bool))}))
            clock, end = int(us[-1]), (lat[-1], lon[-1])
        if not out:
            return pd.DataFrame(columns=[c.split()[0] for c in POINTS.split(", ")])
        whole = pd.concat(out, ignore_index=True)
        whole.insert(0, "idx", np.arange(len(whole)))
        whole.insert(0, "trip_id", trip)
        return whole

    both = legs.join(trips.select("trip_id", "start_us", "hard_case"), "trip_id")
    return both.groupBy("trip_id").applyInPandas(run, POINTS)
