"""Dense numbers for the rows of a table, and picks by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajkit.session import written


def numbered(rows: DataFrame, *keys: str, name: str = "no") -> DataFrame:
    """``rows`` with numbers 0, 1, 2, ... in the order of ``keys``, which must tell all rows apart.

    Rows are ranged over tasks and counted there; only a count a task comes to the driver.
    """
    spark = rows.sparkSession
    ranged = written(rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "numbered")
    counts, before, at = sorted(ranged.groupBy("_part").count().collect()), [], 0
    for part, n in counts:
        before.append((part, at))
        at += n
    starts = spark.createDataFrame(before, "_part int, _start long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1
    return ranged.join(F.broadcast(starts), "_part").withColumn(name, (place + F.col("_start")).cast("long")).drop("_part", "_start")


def cumulated(rows: DataFrame, weight: str, *keys: str, name: str = "start") -> DataFrame:
    """``rows`` with the sum of the whole ``weight`` of all rows before them in the order of ``keys``, which must tell all rows apart."""
    spark = rows.sparkSession
    ranged = written(rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "cumulated")
    sums, before, at = sorted(ranged.groupBy("_part").agg(F.sum(weight)).collect()), [], 0
    for part, n in sums:
        before.append((part, at))
        at += n
    starts = spark.createDataFrame(before, "_part int, _start long")
    upto = F.sum(weight).over(Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.join(F.broadcast(starts), "_part").withColumn(name, (upto - F.col(weight) + F.col("_start")).cast("long")).drop("_part", "_start")


def draw(*parts: Column | str | int) -> Column:
    """A number in (0, 1) that depends on the parts only, alike on any partitioning and in any engine with md5."""
    text = F.concat_ws("|", *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def normal(*parts: Column | str | int) -> Column:
    """A standard normal draw from two uniform ones."""
    return F.sqrt(-2 * F.log(draw(*parts, F.lit("a")))) * F.cos(2 * F.pi() * draw(*parts, F.lit("b")))


def weighted(weights: dict[str, float], *parts: Column | str | int) -> Column:
    """One of the names, by weight, drawn from the parts."""
    u, total, at = draw(*parts), sum(weights.values()), 0.0
    out = F.lit(list(weights)[-1])
    for name, end in reversed([(n, (at := at + w) / total) for n, w in weights.items()]):
        out = F.when(u < end, name).otherwise(out)
    return out


def sampled(rows: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """``n`` rows picked by a hash of their keys, the same on any partitioning."""
    return rows.orderBy(draw(F.lit(seed), *keys), *keys).limit(n)
