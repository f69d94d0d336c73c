"""Rasters as pixel tables (row, col, value): windows, sampling, labelling by elements, code areas, synthetic terrain."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.operators import spatial
from tessera.operators.quality import either, ring

# Heights outside are missing, the least pixel size, and what an undeclared missing code is.
LOWEST, HIGHEST, LEAST_PIXEL, USUAL_MISSING = -1000.0, 9000.0, 0.5, 255
# Fixed values of the WGS84 ellipsoid: semi-major axis and flattening.
WGS84 = (6378137.0, 1 / 298.257223563)


@dataclass(frozen=True)
class Raster:
    """A north-up grid: left x, upper y, pixel size, rows and columns."""

    x0: float
    y1: float
    px: float
    height: int
    width: int

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(self.y1) - y) / self.px).cast("long")

    def col(self, x: Column) -> Column:
        return F.floor((x - self.x0) / self.px).cast("long")

    def centre(self, row: Column, col: Column) -> tuple[Column, Column]:
        return self.x0 + (col + 0.5) * self.px, self.y1 - (row + 0.5) * self.px

    def window(self, box: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
        """(row0, row1, col0, col1) that cover a box, ends exclusive."""
        xlo, ylo, xhi, yhi = box
        return (
            max(0, math.floor((self.y1 - yhi) / self.px)), min(self.height, math.ceil((self.y1 - ylo) / self.px) + 1),
            max(0, math.floor((xlo - self.x0) / self.px)), min(self.width, math.ceil((xhi - self.x0) / self.px) + 1),
        )


def windowed(pixels: DataFrame, grid: Raster, box: tuple[float, float, float, float], pad: float = 0.0) -> DataFrame:
    """Pixels that cover a padded box: a range of rows and columns, which reaches a Parquet scan's statistics."""
    r0, r1, c0, c1 = grid.window((box[0] - pad, box[1] - pad, box[2] + pad, box[3] + pad))
    return pixels.where(F.col("row").between(r0, r1 - 1) & F.col("col").between(c0, c1 - 1))


def heights(pixels: DataFrame, missing: float | None = None) -> DataFrame:
    """row, col, z with null for heights that are missing, not finite or out of range."""
    z = F.col("z").cast("double")
    ok = z.between(LOWEST, HIGHEST) & ~F.isnan(z)
    if missing is not None:
        ok = ok & (z != missing)
    return pixels.select("row", "col", F.when(ok, z).alias("z"))


def sampled(points: DataFrame, pixels: DataFrame, grid: Raster, x: str = "x", y: str = "y") -> DataFrame:
    """points with z of the pixel that holds each; null outside."""
    at = points.withColumns({"row": grid.row(F.col(y)), "col": grid.col(F.col(x))})
    return at.join(pixels.select("row", "col", F.col("z").alias("z")), ["row", "col"], "left").drop("row", "col")


def resampled(pixels: DataFrame, source: Raster, target: Raster) -> DataFrame:
    """row, col, z on another grid of the same system, bilinear between pixel centres; null where one of the four is."""
    r = F.explode(F.sequence(F.lit(0), F.lit(target.height - 1))).alias("row")
    spark = pixels.sparkSession
    cells = spark.range(1).select(r).select("row", F.explode(F.sequence(F.lit(0), F.lit(target.width - 1))).alias("col"))
    x, y = target.centre(F.col("row"), F.col("col"))
    u, v = (x - source.x0) / source.px - 0.5, (F.lit(source.y1) - y) / source.px - 0.5
    at = cells.withColumns({"u": u, "v": v}).withColumns({"c": F.floor("u"), "r": F.floor("v")})
    four = at.select("row", "col", "u", "v", "c", "r", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("o")).select("*", (F.col("r") + F.col("o.i")).alias("sr"), (F.col("c") + F.col("o.j")).alias("sc"))
    w = (1 - F.abs(F.col("u") - F.col("sc"))) * (1 - F.abs(F.col("v") - F.col("sr")))
    both = four.withColumn("w", w).where("w > 0").join(pixels.select(F.col("row").alias("sr"), F.col("col").alias("sc"), "z"), ["sr", "sc"], "left")
    return both.groupBy("row", "col").agg(F.when(F.count_if(F.col("z").isNull()) == 0, F.sum(F.col("w") * F.col("z"))).alias("z"))


def labelled(pixels: DataFrame, grid: Raster, geom: DataFrame, cell: float) -> DataFrame:
    """pixels (row, col, ...) with eid of the element that holds the centre, the largest on shared sides; others go."""
    x, y = grid.centre(F.col("row"), F.col("col"))
    at = pixels.withColumns({"px": x, "py": y}).withColumns({"gx": F.floor(F.col("px") / cell).cast("long"), "gy": F.floor(F.col("py") / cell).cast("long")})
    p = (F.col("px"), F.col("py"))
    near = at.join(spatial.gridded(spatial.boxes(geom), cell), ["gx", "gy"])
    inside = near.where(either(g.inside_convex(p, ring(3)), g.inside_convex(p, ring(4))))
    return inside.groupBy("row", "col").agg(F.max("eid").alias("eid")).join(pixels, ["row", "col"])


def terrain_samples(pixels: DataFrame, grid: Raster, geom: DataFrame, centres: DataFrame, cell: float) -> DataFrame:
    """eid, dx, dy from the element's centre, z of every pixel with a height inside an element."""
    x, y = grid.centre(F.col("row"), F.col("col"))
    return labelled(heights(pixels).where("z is not null"), grid, geom, cell).join(centres, "eid").select("eid", (x - F.col("cx")).alias("dx"), (y - F.col("cy")).alias("dy"), "z")


def gradients(pixels: DataFrame, grid: Raster) -> DataFrame:
    """row, col, gx, gy: central differences, one-sided at the grid's edge; null beside a missing height."""
    sent = pixels.select(F.explode(F.array(*[F.struct((F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"), F.lit(n).alias("n"), F.col("z").alias("z")) for n, dr, dc in (("o", 0, 0), ("e", 0, -1), ("w", 0, 1), ("n", 1, 0), ("s", -1, 0))])).alias("t")).select("t.*")
    t = sent.groupBy("row", "col").agg(*[F.max(F.when(F.col("n") == n, F.col("z"))).alias(n) for n in "oewns"], F.max((F.col("n") == "o").cast("int")).alias("own")).where("own = 1")
    col, row = F.col("col"), F.col("row")
    east, west = F.when(col == grid.width - 1, F.col("o")).otherwise(F.col("e")), F.when(col == 0, F.col("o")).otherwise(F.col("w"))
    north, south = F.when(row == 0, F.col("o")).otherwise(F.col("n")), F.when(row == grid.height - 1, F.col("o")).otherwise(F.col("s"))
    wide = F.when((col == 0) | (col == grid.width - 1), grid.px).otherwise(2 * grid.px)
    high = F.when((row == 0) | (row == grid.height - 1), grid.px).otherwise(2 * grid.px)
    return t.select("row", "col", ((east - west) / wide).alias("gx"), ((north - south) / high).alias("gy"))


def pixel_area(px: float, py: float, latitude: float | None = None, unit: float = 1.0) -> float:
    """Square metres of a pixel: of a projected grid, or of one in degrees around a latitude on the WGS84 ellipsoid."""
    if latitude is None:
        return abs(px) * abs(py) * unit * unit
    a, f = WGS84
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def zone(lat: float) -> float:
        s = math.sin(math.radians(lat))
        return s / (1 - e2 * s * s) / 2 + math.atanh(e * s) / (2 * e)

    return abs(a * a * (1 - e2) * (zone(latitude + abs(py) / 2) - zone(latitude - abs(py) / 2)) * math.radians(abs(px)))


def touched_codes(pixels: DataFrame, grid: Raster, geom: DataFrame, cell: float, missing: float | None = None) -> DataFrame:
    """eid, code of every pixel that an element touches; a pixel on a border counts for each element.

    A raster without a declared missing code has 255 for it.
    """
    code = F.rint(F.col("code").cast("double"))
    valid = pixels.where(F.col("code").isNotNull() & ~F.isnan(F.col("code").cast("double")) & (code != (USUAL_MISSING if missing is None else missing)))
    x0, y1 = grid.x0 + F.col("col") * grid.px, grid.y1 - F.col("row") * grid.px
    boxes = valid.select((F.col("row") * grid.width + F.col("col")).alias("pid"), x0.alias("bx0"), (y1 - grid.px).alias("by0"), (x0 + grid.px).alias("bx1"), y1.alias("by1"), code.cast("int").alias("code"))
    return spatial.touched(boxes, geom, cell).join(boxes.select("pid", "code"), "pid").select("eid", "code")


def code_areas(pixels: DataFrame, grid: Raster, geom: DataFrame, codes: list[int], cell: float, area: float | None = None, missing: float | None = None) -> DataFrame:
    """eid, code, area: pixels touched times a pixel's area, for the listed codes."""
    found = touched_codes(pixels, grid, geom, cell, missing).where(F.col("code").isin(codes))
    return found.groupBy("eid", "code").agg((F.count("*") * (grid.px * grid.px if area is None else area)).alias("area"))


def synthetic(spark: SparkSession, grid: Raster, ridge_y: float) -> DataFrame:
    """row, col, z of a tilted plane with a ridge along ridge_y and an undulation."""
    cells = spark.range(grid.height).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid.width - 1).cast("long"))).alias("col"))
    x, y = grid.centre(F.col("row"), F.col("col"))
    dx, dy = x - grid.x0, y - (grid.y1 - grid.height * grid.px)
    ridge = 3.0 * F.exp(-F.pow((y - ridge_y) / 20.0, F.lit(2.0)))
    z = 100.0 + 0.002 * dx + 0.001 * dy + ridge + 0.4 * F.sin(dx / 150.0) * F.cos(dy / 180.0)
    return cells.select("row", "col", z.cast("float").alias("z"))


def read_ascii(spark: SparkSession, path: str) -> tuple[DataFrame, Raster]:
    """(pixels, grid) of an ESRI ASCII grid: six header lines, then a line of numbers for each row."""
    head = {k.lower(): float(v) for k, v in (line.split()[:2] for line in spark.read.text(path).limit(6).toPandas()["value"])}
    n_rows, n_cols, px = int(head["nrows"]), int(head["ncols"]), head["cellsize"]
    left = head.get("xllcorner", head.get("xllcenter", 0.0) - (0.0 if "xllcorner" in head else px / 2))
    low = head.get("yllcorner", head.get("yllcenter", 0.0) - (0.0 if "yllcorner" in head else px / 2))
    grid = Raster(left, low + n_rows * px, px, n_rows, n_cols)
    missing = head.get("nodata_value")

    def rows(batches):
        for pdf in batches:
            lines = [np.array(b.decode().split(), float) for b in pdf["content"]]
            for b in lines:
                z = b.reshape(n_rows, n_cols)
                r, c = np.indices(z.shape)
                yield pd.DataFrame({"row": r.ravel(), "col": c.ravel(), "z": z.ravel()})

    body = spark.read.format("binaryFile").load(path).select(F.expr("substring(content, 1, length(content))").alias("content"))

    def strip(batches):
        for pdf in batches:
            yield pdf.assign(content=[b"\n".join(b.splitlines()[6:]) for b in pdf["content"]])

    pixels = body.mapInPandas(strip, "content binary").mapInPandas(rows, "row long, col long, z double")
    return heights(pixels, missing), grid
