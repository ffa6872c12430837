"""Exact percentiles by group without holding a group's values in one task's memory."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distance in rank, as a share of a group, that the sketch's bounds keep from the percentile that they enclose.
SLACK, ACCURACY = 0.001, 10_000


def percentiles(rows: DataFrame, group: str, value: str, asked: dict[str, tuple[float, bool]]) -> DataFrame:
    """``group`` and a column for each asked percentile (share, interpolated or nearest rank) of the values that aren't null.

    A mergeable sketch gives two values around each percentile; rows below them are counted, and only those
    between them, some thousandths of a group, are ranked. Where the sketch missed, all rows of the group are
    ranked. Groups are few (modes, kinds of events): a row each comes to the driver.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    shares = sorted({min(1.0, max(0.0, q + s)) for q, _ in asked.values() for s in (-SLACK, SLACK)})
    first = own.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile_approx("v", shares, ACCURACY).alias("at")).collect()
    bounds = []
    for r in first:
        near = dict(zip(shares, r["at"], strict=True))
        for name, (q, cont) in asked.items():
            place = q * (r.n - 1) if cont else max(math.ceil(q * r.n) - 1, 0)
            k = math.floor(place)
            a, b = (near[min(1.0, max(0.0, q + s))] for s in (-SLACK, SLACK))
            bounds.append((r.g, name, k, min(k + 1, r.n - 1), float(place - k), a, b, r.lo, r.hi))
    kind = rows.schema[group].dataType.simpleString()
    schema = f"g {kind}, name string, k long, k1 long, part double, a double, b double, lo double, hi double"

    def ranked(wanted: list[tuple]) -> tuple[dict, list[tuple]]:
        """Values by (group, name, rank), and the wanted ones whose bounds don't enclose their ranks."""
        with_bounds = own.join(F.broadcast(spark.createDataFrame(wanted, schema)), "g")
        counts = {(r.g, r.name): (r.below, r.inside) for r in with_bounds.groupBy("g", "name").agg(F.count_if(F.col("v") < F.col("a")).alias("below"), F.count_if(F.col("v").between(F.col("a"), F.col("b"))).alias("inside")).collect()}
        good = [w for w in wanted if counts[w[0], w[1]][0] <= w[2] and w[3] < sum(counts[w[0], w[1]])]
        if not good:
            return {}, wanted
        below = spark.createDataFrame([(*w, counts[w[0], w[1]][0]) for w in good], schema + ", below long")
        inside = own.join(F.broadcast(below), "g").filter("v BETWEEN a AND b")
        at = F.row_number().over(Window.partitionBy("g", "name").orderBy("v")) - 1 + F.col("below")
        found = inside.withColumn("at", at).filter("at = k OR at = k1").select("g", "name", "at", "v").collect()
        return {(r.g, r.name, r["at"]): r.v for r in found}, [w for w in wanted if w not in good]

    values: dict = {}
    left = bounds
    if left:
        values, left = ranked(left)
    if left:  # all rows of these groups
        values |= ranked([(*w[:5], w[7], w[8], w[7], w[8]) for w in left])[0]
    out: dict = {}
    for g, name, k, k1, part, *_ in bounds:
        x, y = values[g, name, k], values[g, name, k1]
        out.setdefault(g, {})[name] = x + (y - x) * part
    return spark.createDataFrame([(g, *(x[n] for n in asked)) for g, x in out.items()], f"{group} {kind}, " + ", ".join(f"{n} double" for n in asked))
