"""Raster operators on (row, col, z) tables: sliding extremes, top-hat relief, closing, blobs and crossing numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RING = ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))


def sliding(df: DataFrame, value: str, size: int, smallest: bool) -> DataFrame:
    """value replaced by its smallest or largest in a square of size x size, which is taken along rows, then columns.

    Beyond the edge the nearest pixel counts, which doesn't change an extreme, so the window just ends there. Rows and
    columns are partitions of their own; windows go by pixel numbers, so an absent pixel shifts nothing.
    """
    half = size // 2
    f = F.min if smallest else F.max
    for by, along in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(by).orderBy(along).rangeBetween(-half, half)
        df = df.withColumn(value, f(value).over(w))
    return df


def top_hat(dem: DataFrame, size: int) -> DataFrame:
    """row, col, z, relief: how far a pixel stands above what a square of ``size`` pixels leaves. Missing z count as the lowest."""
    lowest = dem.agg(F.min("z").alias("low"))
    t = dem.crossJoin(F.broadcast(lowest)).select("row", "col", F.coalesce("z", "low").alias("z"))
    opened = sliding(sliding(t.withColumn("o", F.col("z")), "o", size, True), "o", size, False)
    return opened.select("row", "col", "z", (F.col("z") - F.col("o")).alias("relief"))


def relief_mask(dem: DataFrame, size: int, flat_size: int, low: float, high: float, flat: float) -> DataFrame:
    """row, col, mask: relief between low and high where the ground around varies by flat at most."""
    t = top_hat(dem, size).withColumn("a", F.col("z") - F.col("relief")).withColumn("b", F.col("z") - F.col("relief"))
    t = sliding(sliding(t, "a", flat_size, False), "b", flat_size, True)
    return t.select("row", "col", (F.col("relief").between(low, high) & (F.col("a") - F.col("b") <= flat)).alias("mask"))


def closed(mask: DataFrame, times: int) -> DataFrame:
    """Binary closing by a 3 x 3 square: ``times`` dilations, then erosions; outside the raster nothing is set, so its rim closes to nothing."""
    t = mask.withColumn("v", F.col("mask").cast("int"))
    for _ in range(times):
        t = sliding(t, "v", 3, False)
    ends = t.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))
    for _ in range(times):
        t = sliding(t, "v", 3, True)
    rim = (F.col("row") - F.col("r0") < times) | (F.col("r1") - F.col("row") < times) | (F.col("col") - F.col("c0") < times) | (F.col("c1") - F.col("col") < times)
    return t.crossJoin(F.broadcast(ends)).select("row", "col", ((F.col("v") == 1) & ~rim).alias("mask"))


def around(mask: DataFrame) -> DataFrame:
    """Set pixels with on0..on7: whether each neighbour, clockwise from above, is set. One shuffle."""
    on = mask.where("mask").select("row", "col")
    sent = on.select(F.explode(F.array(F.struct("row", "col", F.lit(-1).alias("k")), *[F.struct((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.lit(k).alias("k")) for k, (dr, dc) in enumerate(RING)])).alias("s")).select("s.*")
    got = sent.groupBy("row", "col").agg(F.max(F.col("k") == -1).alias("self"), *[F.max(F.col("k") == k).alias(f"on{k}") for k in range(8)])
    return got.where("self").drop("self")


def crossing_numbers(mask: DataFrame) -> DataFrame:
    """row, col, crossings: changes from unset to set once round a set pixel; 1 at ends, 2 along lines, 3 and up at forks."""
    t = around(mask)
    change: list[Column] = [(F.col(f"on{k}") & ~F.col(f"on{(k - 1) % 8}")).cast("int") for k in range(8)]
    total = change[0]
    for x in change[1:]:
        total = total + x
    return t.select("row", "col", total.alias("crossings"))


TILE = 256


def blobs(mask: DataFrame) -> DataFrame:
    """row, col, blob: 8-connected parts of the set pixels, named by their smallest row * 2**32 + col.

    Tiles of 256 x 256 pixels, with their neighbours' first row and columns, are labelled in kernels; what is left are
    links between tiles' labels, whose connected components name the blobs. No step grows with a blob's width.
    """
    from tessera.cluster import cut, ship
    from tessera.components import connected_components, local_labels

    ship(mask.sparkSession)
    key = F.col("row").cast("long") * (1 << 32) + F.col("col").cast("long")
    on = mask.where("mask").select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), key.alias("id"))
    tile = lambda c, d: F.floor((F.col(c) + d) / TILE).cast("long")
    places = F.array_distinct(F.array(*[F.struct(tile("row", dr).alias("tr"), tile("col", dc).alias("tc")) for dr in (0, 1, -1) for dc in (0, 1, -1)]))
    shared = on.select("*", F.explode(places).alias("t")).select("id", "t.tr", "t.tc", ((F.col("t.tr") == tile("row", 0)) & (F.col("t.tc") == tile("col", 0))).alias("own"))

    def run(table: pa.Table) -> pa.Table:
        ids, own = np.sort(table.column("id").to_numpy()), None
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        own = table.column("own").to_numpy(zero_copy_only=False)[order]
        a, b = [ids], [ids]
        for dr, dc in ((0, 1), (1, -1), (1, 0), (1, 1)):
            other = ids + dr * (1 << 32) + dc
            at = np.minimum(np.searchsorted(ids, other), len(ids) - 1)
            hit = ids[at] == other
            a.append(ids[hit])
            b.append(other[hit])
        nodes, label = local_labels(np.concatenate(a), np.concatenate(b))
        return pa.table({"id": nodes, "label": label, "own": own})

    found = cut(shared.groupBy("tr", "tc").applyInArrow(run, "id long, label long, own boolean"))
    links = found.where("not own").select("id", F.col("label").alias("b")).join(found.where("own").select("id", F.col("label").alias("a")), "id").where("a <> b").select("a", "b").distinct()
    joined = connected_components(links).select(F.col("id").alias("label"), "component")
    named = found.where("own").join(joined, "label", "left").select("id", F.coalesce("component", "label").alias("blob"))
    return named.select(F.shiftright("id", 32).alias("row"), F.col("id").bitwiseAND(F.lit((1 << 32) - 1)).alias("col"), "blob")


def large_blobs(mask: DataFrame, least: int) -> DataFrame:
    """The pixels of blobs of at least ``least`` pixels: row, col, blob."""
    t = blobs(mask)
    sizes = t.groupBy("blob").count().where(F.col("count") >= least).select("blob")
    return t.join(sizes, "blob", "left_semi").select("row", "col", "blob")
