"""Size fields on a grid: lookups, clamped updates, smoothing and the refinement step. Every update is a new DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut


def uniform(spark, nx: int, ny: int, value: float, floor: float) -> DataFrame:
    """iy, ix, value, floor, attempts of a new field."""
    i = spark.range(nx * ny)
    return i.select(F.floor(F.col("id") / nx).alias("iy"), (F.col("id") % nx).alias("ix"), F.greatest(F.lit(value), F.lit(floor)).alias("value"), F.lit(floor).alias("floor"), F.lit(0).alias("attempts"))


def nearest(x: Column, low: float, spacing: float, n: int) -> Column:
    """Index of the nearest grid line: halves go to the even one, and the ends take what lies beyond."""
    return F.least(F.greatest(F.rint((x - low) / spacing), F.lit(0.0)), F.lit(n - 1.0)).cast("long")


def looked_up(field: DataFrame, points: DataFrame, most_attempts: int) -> DataFrame:
    """points (iy, ix, ...) with value, at_floor and refinable."""
    t = points.join(field, ["iy", "ix"])
    floor = F.col("value") <= F.col("floor") + 1e-9
    return t.withColumn("at_floor", floor).withColumn("refinable", (F.col("attempts") < most_attempts) & ~floor).drop("floor", "attempts")


def applied(field: DataFrame, wanted: DataFrame, ceiling: float, larger: bool = False, count: bool = True) -> DataFrame:
    """field after wanted sizes (iy, ix, size), clamped; each cell takes its smallest (or largest) one if that is a change.

    Smaller sizes count an attempt once for each changed cell.
    """
    pick = F.max("size") if larger else F.min("size")
    best = wanted.groupBy("iy", "ix").agg(pick.alias("size"))
    clamped = F.when(F.col("size").isNotNull(), F.least(F.greatest("size", "floor"), F.lit(ceiling)))  # greatest skips nulls
    t = field.join(best, ["iy", "ix"], "left").withColumn("size", clamped)
    change = F.col("size").isNotNull() & ((F.col("size") > F.col("value") + 1e-9) if larger else (F.col("size") < F.col("value") - 1e-9))
    tries = F.col("attempts") + F.when(change & F.lit(count and not larger), 1).otherwise(0)
    return t.select("iy", "ix", F.when(change, F.col("size")).otherwise(F.col("value")).alias("value"), "floor", tries.cast("int").alias("attempts"))


def lowered_floor(field: DataFrame, wanted: DataFrame, hard_floor: float) -> DataFrame:
    least = wanted.groupBy("iy", "ix").agg(F.greatest(F.min("size"), F.lit(hard_floor)).alias("size"))
    return field.join(least, ["iy", "ix"], "left").select("iy", "ix", "value", F.least("floor", F.coalesce("size", "floor")).alias("floor"), "attempts")


def raised_floor(field: DataFrame, points: DataFrame, value: float, reach: int) -> DataFrame:
    """A floor of at least value within ``reach`` cells of points (iy, ix), and values up to their floor."""
    steps = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1) if dy * dy + dx * dx <= reach * reach]
    around = points.select("iy", "ix").distinct().select(F.explode(F.array(*[F.struct((F.col("iy") + dy).alias("iy"), (F.col("ix") + dx).alias("ix")) for dy, dx in steps])).alias("p")).select("p.iy", "p.ix").distinct().withColumn("hit", F.lit(True))
    t = field.join(around, ["iy", "ix"], "left").withColumn("floor", F.when(F.col("hit"), F.greatest(F.col("floor"), F.lit(value))).otherwise(F.col("floor")))
    return t.select("iy", "ix", F.greatest("value", "floor").alias("value"), "floor", "attempts")


def smoothed(field: DataFrame, step: float, rounds: int) -> DataFrame:
    """Values lowered to at most a 4-neighbour's plus step, never below the floor, for up to ``rounds`` rounds.

    A round is one shuffle: each cell sends its value + step to its neighbours. Rounds end when nothing changes.
    """
    now = field
    for i in range(rounds):
        sent = now.select(F.explode(F.array(*[F.struct((F.col("iy") + dy).alias("iy"), (F.col("ix") + dx).alias("ix"), (F.col("value") + (step if dy or dx else 0.0)).alias("v"), (F.col("floor") if not (dy or dx) else F.lit(None).cast("double")).alias("floor"), (F.col("attempts") if not (dy or dx) else F.lit(None).cast("int")).alias("attempts")) for dy, dx in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))])).alias("s")).select("s.*")
        own = sent.groupBy("iy", "ix").agg(F.min("v").alias("v"), F.max("floor").alias("floor"), F.max("attempts").alias("attempts"), F.max(F.when(F.col("floor").isNotNull(), F.col("v"))).alias("old")).where("floor is not null")
        nxt = cut(own.select("iy", "ix", F.greatest("v", "floor").alias("value"), "floor", "attempts", "old"))
        changed = nxt.where(F.abs(F.col("value") - F.col("old")) > 1e-6).limit(1).count()
        now = nxt.drop("old")
        if not changed:
            break
    return now


def stats(field: DataFrame) -> DataFrame:
    return field.agg(F.min("value").alias("least"), F.median("value").alias("median"), F.max("value").alias("most"), F.avg((F.col("value") <= F.col("floor") + 1e-9).cast("double")).alias("at_floor"))


def refined(field: DataFrame, marked: DataFrame, factor: float, most_attempts: int, step: float, ceiling: float, rounds: int = 50) -> DataFrame:
    """One refinement: shrink refinable cells under marked elements (iy, ix, size) by factor, clamp, smooth."""
    open_cells = looked_up(field, marked, most_attempts).where("refinable").select("iy", "ix", (F.col("size") * factor).alias("size"))
    return smoothed(applied(field, open_cells, ceiling), step, rounds)
