"""Local time-step levels of faces: characteristic length, binning and smoothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.cluster import cut
from tessera.operators.topology import dense_ids


def shortest_side(half: DataFrame, nodes: DataFrame) -> DataFrame:
    """eid, length: an element's shortest side; 1 where it has none or no length."""
    a = nodes.select(F.col("id").alias("na"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = nodes.select(F.col("id").alias("nb"), F.col("x").alias("bx"), F.col("y").alias("by"))
    least = half.join(a, "na").join(b, "nb").groupBy("eid").agg(F.min(F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))).alias("m"))
    return least.select("eid", F.when(F.col("m") > 0, F.col("m")).otherwise(1.0).alias("length"))


def ranked(lengths: DataFrame) -> tuple[DataFrame, int]:
    """(lengths with rank from 0 by (length, eid), number of rows)."""
    return dense_ids(lengths, ["length", "eid"], "rank", first=0), lengths.count()


def quantile_levels(lengths: DataFrame, cap: int) -> DataFrame:
    """eid, level = min(cap, floor(rank * (cap + 1) / n))."""
    order, n = ranked(lengths)
    return order.select("eid", F.least(F.lit(cap), F.floor(F.col("rank") * (cap + 1) / max(n, 1))).cast("int").alias("level"))


def relative_steps(lengths: DataFrame, cap: int, binning: str) -> DataFrame:
    """eid, dt in 2**-cap .. 1: linear in the length, or geometric between the lengths at 5 and 95 % of the order."""
    least = 2.0**-cap
    x = F.greatest("length", F.lit(1e-12))
    if binning == "linear":
        top = lengths.agg(F.max(x).alias("top"))
        return lengths.crossJoin(F.broadcast(top)).select("eid", F.greatest(F.lit(least), F.least(F.lit(1.0), x / F.col("top"))).alias("dt"))
    if binning != "log":
        raise ValueError(f"unknown binning: {binning}")
    order, n = ranked(lengths)
    lo_at, hi_at = int(0.05 * max(n - 1, 0)), int(0.95 * max(n - 1, 0))
    ends = order.where(F.col("rank").isin(lo_at, hi_at)).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    ends = ends.select("lo", F.when(F.col("hi") <= F.col("lo") * (1 + 1e-12), F.col("lo") * 1.000001).otherwise(F.col("hi")).alias("hi"))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.ln(x) - F.ln("lo")) / (F.ln("hi") - F.ln("lo"))))
    return lengths.crossJoin(F.broadcast(ends)).select("eid", (least * F.pow(F.lit(1 / least), t)).alias("dt"))


def step_levels(steps: DataFrame, cap: int) -> DataFrame:
    """eid, level: the largest k with 2**(k - cap) <= dt."""
    hit = [F.when(F.lit(2.0 ** (k - cap)) <= F.col("dt") * (1 + 1e-12), k) for k in range(cap, -1, -1)]
    return steps.select("eid", F.coalesce(*hit, F.lit(0)).cast("int").alias("level"))


def smoothed(levels: DataFrame, pairs: DataFrame, cap: int) -> DataFrame:
    """Levels lowered until neighbours differ by one at most: min over faces of level + distance, so cap rounds do."""
    both = cut(pairs.select(F.col("e0").alias("eid"), F.col("e1").alias("other")).unionByName(pairs.select(F.col("e1").alias("eid"), F.col("e0").alias("other"))))
    now = levels
    for _ in range(max(cap, 0)):
        around = both.join(now.select(F.col("eid").alias("other"), "level"), "other").groupBy("eid").agg((F.min("level") + 1).alias("most"))
        now = cut(now.join(around, "eid", "left").select("eid", F.least("level", F.coalesce("most", F.col("level"))).cast("int").alias("level")))
    return now


def weighted_median(df: DataFrame, value: str, weight: str, by: str) -> DataFrame:
    """by, median: the first value whose cumulative weight reaches half of the group's."""
    order = Window.partitionBy(by).orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
    run = df.withColumn("run", F.sum(weight).over(order)).withColumn("all", F.sum(weight).over(Window.partitionBy(by)))
    return run.where(F.col("run") >= F.col("all") / 2).groupBy(by).agg(F.min(value).alias("median"))
