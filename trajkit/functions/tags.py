"""Rules on the tags of map ways, as columns over a ``map<string, string>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of ways by who may use them, tags that close a way, default speeds in metres a second.
NEVER = ("construction", "proposed", "raceway", "corridor", "platform", "services", "rest_area")
ROADS = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "service", "road", "busway")
KINDS = {"car": ROADS, "walk": (*ROADS, "footway", "pedestrian", "path", "steps", "track"), "bike": (*ROADS, "cycleway", "path", "track")}
CLOSED = {"car": ("motor_vehicle", "motorcar"), "walk": ("foot",), "bike": ("bicycle",)}
ASKED = {"walk": ("foot", ("motorway", "motorway_link", "trunk", "trunk_link")), "bike": ("bicycle", ("trunk", "trunk_link", "footway", "pedestrian", "steps"))}
SPEEDS = {"car": 11.1, "walk": 1.35, "bike": 4.8}
TOP_CAR_MPS, MPH, SLACK = 33.3, 0.44704, 2.5


def tag(tags: Column, key: str) -> Column:
    """A tag's value without outer space, in lower case; null where it isn't there."""
    return F.lower(F.trim(F.try_element_at(tags, F.lit(key))))


def _any(tags: Column, key: str, *values: str) -> Column:
    return F.coalesce(tag(tags, key).isin(*values), F.lit(False))


def blocked(tags: Column, mode: str) -> Column:
    """Whether access is denied to all or to this mode."""
    out = _any(tags, "access", "no", "private")
    for key in CLOSED[mode]:
        out = out | _any(tags, key, "no", "private")
    return out


def allowed(tags: Column, mode: str) -> Column:
    """Whether the mode may use the way: by its kind, unless closed; some kinds need the mode's own permission."""
    kind = tag(tags, "highway")
    there = kind.isNotNull() & (kind != "") & ~kind.isin(*NEVER) & ~blocked(tags, mode)
    if mode == "car":
        return F.coalesce(there & kind.isin(*ROADS), F.lit(False))
    key, wary = ASKED[mode]
    asked = _any(tags, key, "yes", "designated")
    out = there & (kind.isin(*KINDS[mode]) | asked) & (~kind.isin(*wary) | asked)
    if mode == "bike":
        out = out & ~kind.isin("motorway", "motorway_link")
    return F.coalesce(out, F.lit(False))


def oneway(tags: Column, mode: str) -> Column:
    """1 along the way only, -1 against it only, 0 both; walkers and cyclists may be let off."""
    free = _any(tags, f"oneway:{mode}", "no", "false", "0") if mode != "car" else F.lit(False)
    along = _any(tags, "oneway", "yes", "true", "1") | _any(tags, "junction", "roundabout")
    return F.when(free, 0).when(along, 1).when(_any(tags, "oneway", "-1"), -1).otherwise(0)


def speed(tags: Column, mode: str) -> Column:
    """The signed speed in metres a second, capped by mode; the mode's default where there is none to read."""
    raw = tag(tags, "maxspeed")
    number = F.regexp_replace(raw, "[^0-9.]", "").try_cast("double")
    mps = F.when(raw.contains("mph"), number * F.lit(MPH)).otherwise(number / F.lit(3.6))
    cap = TOP_CAR_MPS if mode == "car" else SPEEDS[mode] * SLACK
    return F.when(mps > 0, F.least(mps, F.lit(cap))).otherwise(F.lit(SPEEDS[mode]))
