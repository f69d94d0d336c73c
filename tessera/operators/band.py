"""The boundary quad band: rings resampled, offset inwards and closed, one kernel call for each polygon.

What concerns single vertices is also given as columns over ring tables (ring, i, x, y), so that it stays in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.sources.layers import POINTS

# The longest mitre, and the area below which a closing triangle is no area.
LONGEST_MITRE, NO_AREA = 3.0, 1e-6


def around(df: DataFrame, n: Column) -> DataFrame:
    """Ring vertices with px, py and qx, qy, the ones before and after; n is the ring's size."""
    w = Window.partitionBy("ring").orderBy("i")
    whole = Window.partitionBy("ring").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pick = lambda c, f, end: F.coalesce(f(c).over(w), end(c).over(whole))
    return df.withColumns({"px": pick("x", F.lag, F.last), "py": pick("y", F.lag, F.last), "qx": pick("x", F.lead, F.first), "qy": pick("y", F.lead, F.first)})


def turn_angles(rings: DataFrame) -> DataFrame:
    """ring, i, turn: the absolute change of heading at a vertex, in radians."""
    t = around(rings, F.lit(None))
    d = F.atan2(F.col("qy") - F.col("y"), F.col("qx") - F.col("x")) - F.atan2(F.col("y") - F.col("py"), F.col("x") - F.col("px"))
    return t.select("ring", "i", F.abs(F.pmod(d + np.pi, F.lit(2 * np.pi)) - np.pi).alias("turn"))


def mitres(rings: DataFrame) -> DataFrame:
    """ring, i, dx, dy, scale: the unit bisector of the left normals and how far along it a width of 1 reaches."""
    t = around(rings, F.lit(None))
    x, y = F.col("x"), F.col("y")

    def normal(ux: Column, uy: Column) -> tuple[Column, Column]:
        size = F.hypot(ux, uy)
        size = F.when(size == 0, 1.0).otherwise(size)
        return -uy / size, ux / size

    (ax, ay), (bx, by) = normal(x - F.col("px"), y - F.col("py")), normal(F.col("qx") - x, F.col("qy") - y)
    t = t.withColumns({"ax": ax, "ay": ay, "bx": bx, "by": by}).withColumn("m", F.hypot(F.col("ax") + F.col("bx"), F.col("ay") + F.col("by")))
    spike = F.col("m") < 1e-9
    t = t.withColumns({"dx": F.when(spike, F.col("bx")).otherwise((F.col("ax") + F.col("bx")) / F.col("m")), "dy": F.when(spike, F.col("by")).otherwise((F.col("ay") + F.col("by")) / F.col("m"))})
    half = F.greatest(F.lit(1e-3), F.least(F.lit(1.0), F.col("dx") * F.col("bx") + F.col("dy") * F.col("by")))
    return t.select("ring", "i", "dx", "dy", F.least(1 / half, F.lit(LONGEST_MITRE)).alias("scale"))


def sharp_corners(rings: DataFrame, least_area: float, most_degrees: float) -> DataFrame:
    """ring, i, area of vertices whose interior angle is small and whose corner triangle is too small."""
    t = around(rings, F.lit(None))
    ux, uy, vx, vy = F.col("px") - F.col("x"), F.col("py") - F.col("y"), F.col("qx") - F.col("x"), F.col("qy") - F.col("y")
    cross = ux * vy - uy * vx
    angle = F.atan2(-cross, ux * vx + uy * vy)
    angle = F.when(angle < 0, angle + 2 * np.pi).otherwise(angle)
    return t.where((angle < np.radians(most_degrees)) & (F.abs(cross) / 2 < least_area)).select("ring", "i", (F.abs(cross) / 2).alias("area"))


def resampled(rings: DataFrame, spacing: float) -> DataFrame:
    """ring, i, x, y: max(4, rint(length / spacing)) points at even distances along each ring, from its first vertex."""
    t = around(rings, F.lit(None)).withColumn("len", F.hypot(F.col("qx") - F.col("x"), F.col("qy") - F.col("y")))
    w = Window.partitionBy("ring").orderBy("i")
    t = t.withColumn("start", F.sum("len").over(w) - F.col("len"))
    total = t.groupBy("ring").agg(F.sum("len").alias("total")).withColumn("n", F.greatest(F.lit(4), F.rint(F.col("total") / spacing).cast("int")))
    t = t.join(total, "ring").withColumn("step", F.col("total") / F.col("n"))
    first = F.ceil(F.col("start") / F.col("step") - 1e-12).cast("int")
    last = F.ceil((F.col("start") + F.col("len")) / F.col("step") - 1e-12).cast("int") - 1
    pts = t.where((F.col("len") > 0) & (first <= last)).withColumn("k", F.explode(F.sequence(first, F.least(last, F.col("n") - 1))))
    s = (F.col("k") * F.col("step") - F.col("start")) / F.col("len")
    return pts.where("k < n").select("ring", F.col("k").alias("i"), (F.col("x") + s * (F.col("qx") - F.col("x"))).alias("x"), (F.col("y") + s * (F.col("qy") - F.col("y"))).alias("y"))


def shoelace(xy: np.ndarray) -> float:
    x, y = xy[:, 0], xy[:, 1]
    return 0.5 * float(x @ np.roll(y, -1) - y @ np.roll(x, -1))


def even_points(xy: np.ndarray, spacing: float) -> np.ndarray:
    closed = np.concatenate([xy, xy[:1]])
    at = np.concatenate([[0.0], np.cumsum(np.hypot(*np.diff(closed, axis=0).T))])
    n = max(4, int(np.rint(at[-1] / spacing)))
    d = at[-1] * np.arange(n) / n
    return np.column_stack([np.interp(d, at, closed[:, 0]), np.interp(d, at, closed[:, 1])])


def offsets(xy: np.ndarray) -> np.ndarray:
    """For each vertex what a width of 1 moves it inwards."""
    along = np.roll(xy, -1, axis=0) - xy
    size = np.hypot(*along.T)
    normal = np.column_stack([-along[:, 1], along[:, 0]]) / np.where(size == 0, 1, size)[:, None]
    both = normal + np.roll(normal, 1, axis=0)
    size = np.hypot(*both.T)
    unit = np.where((size < 1e-9)[:, None], normal, both / np.where(size < 1e-9, 1, size)[:, None])
    half = np.clip((unit * normal).sum(axis=1), 1e-3, 1)
    return unit * np.minimum(1 / half, LONGEST_MITRE)[:, None]


def crossing_vertices(xy: np.ndarray) -> np.ndarray:
    """Which vertices belong to sides that meet a side that isn't their neighbour."""
    n = len(xy)
    a, b = xy, np.roll(xy, -1, axis=0)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    bad = np.zeros(n, bool)
    order = np.argsort(lo[:, 0], kind="stable")
    reach = np.searchsorted(lo[order, 0], hi[order, 0], side="right")

    def side(o, d, p):
        return np.sign((d[..., 0] - o[..., 0]) * (p[..., 1] - o[..., 1]) - (d[..., 1] - o[..., 1]) * (p[..., 0] - o[..., 0]))

    for k, i in enumerate(order):
        j = order[k + 1 : reach[k]]
        j = j[(lo[j, 1] <= hi[i, 1]) & (hi[j, 1] >= lo[i, 1]) & (j != (i + 1) % n) & (i != (j + 1) % n)]
        if not len(j):
            continue
        s1, s2, s3, s4 = side(a[i], b[i], a[j]), side(a[i], b[i], b[j]), side(a[j], b[j], a[i]), side(a[j], b[j], b[i])
        within = lambda o, d, p: ((p >= np.minimum(o, d)) & (p <= np.maximum(o, d))).all(axis=-1)
        touch = ((s1 == 0) & within(a[i], b[i], a[j])) | ((s2 == 0) & within(a[i], b[i], b[j])) | ((s3 == 0) & within(a[j], b[j], a[i])) | ((s4 == 0) & within(a[j], b[j], b[i]))
        hit = j[((s1 * s2 < 0) & (s3 * s4 < 0)) | touch]
        if len(hit):
            bad[[i, (i + 1) % n]] = True
            bad[hit] = bad[(hit + 1) % n] = True
    return bad


def flat_cells(outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Which vertices belong to quads without area or whose sides cross."""
    n = len(outer)
    p, q, r, s = outer, np.roll(outer, -1, axis=0), np.roll(inner, -1, axis=0), inner
    cross = lambda u, v: u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
    area = 0.5 * (cross(p, q) + cross(q, r) + cross(r, s) + cross(s, p))

    def meet(a, b, c, d):
        return (np.sign(cross(b - a, c - a)) * np.sign(cross(b - a, d - a)) < 0) & (np.sign(cross(d - c, a - c)) * np.sign(cross(d - c, b - c)) < 0)

    bad = (area <= 0) | meet(p, q, r, s) | meet(q, r, s, p)
    return bad | np.roll(bad, 1) if n else bad


@dataclass
class Ring:
    """One ring's band: outer and inner vertices, their widths, segments without a cell, vertices of width zero."""

    outer: np.ndarray
    inner: np.ndarray
    widths: np.ndarray
    failed: np.ndarray
    skipped: np.ndarray = field(default=None)  # type: ignore[assignment]
    flat: np.ndarray = field(default=None)  # type: ignore[assignment]

    def __post_init__(self) -> None:
        n = len(self.outer)
        self.skipped = np.zeros(n, bool) if self.skipped is None else self.skipped
        self.flat = np.zeros(n, bool) if self.flat is None else self.flat

    def landed(self) -> np.ndarray:
        return np.where(self.flat[:, None], self.outer, self.inner)

    def quads(self) -> np.ndarray:
        return ~self.skipped & ~self.flat & ~np.roll(self.flat, -1)

    def areas(self) -> np.ndarray:
        """Of each segment's cell; a side of no width makes it a triangle."""
        inner = self.landed()
        p, q, r, s = self.outer, np.roll(self.outer, -1, axis=0), np.roll(inner, -1, axis=0), inner
        cross = lambda u, v: u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
        return 0.5 * (cross(p, q) + cross(q, r) + cross(r, s) + cross(s, p))

    def land(self) -> None:
        """Vertices between a skipped and a kept segment get no width; segments that lose both ends are skipped too."""
        while True:
            self.flat = self.skipped != np.roll(self.skipped, 1)
            dead = ~self.skipped & self.flat & np.roll(self.flat, -1)
            if not dead.any() or (self.skipped | dead).all():
                return
            self.skipped |= dead

    def close(self, passes: int = 8) -> None:
        """Lands the band's ends; a closing triangle without area goes, and the end moves on."""
        for _ in range(passes):
            if not self.skipped.any() or self.skipped.all():
                self.flat[:] = False
                return
            self.land()
            small = ~self.skipped & ~self.quads() & (self.areas() < NO_AREA)
            if not small.any():
                return
            self.skipped |= small

    def drop_failed(self, passes: int = 8) -> None:
        """Skips the segments at failed vertices, then quads between two skipped segments, and closes the ends."""
        self.skipped |= self.failed | np.roll(self.failed, -1)
        for _ in range(passes):
            lone = self.quads() & np.roll(self.skipped, 1) & np.roll(self.skipped, -1)
            if not lone.any():
                break
            self.skipped |= lone
        self.close()

    def walk(self) -> list[tuple[str, int]]:
        """The way around the interior: inner and outer segments, and down and up where the band has a step."""
        n = len(self.outer)
        if not self.skipped.any() or self.skipped.all():
            return [("outer" if self.skipped.all() else "inner", i) for i in range(n)]
        start = int(np.flatnonzero(~self.skipped)[0])
        out: list[tuple[str, int]] = []
        for k in range(n):
            i = (start + k) % n
            was, now = self.skipped[(i - 1) % n] and k > 0, self.skipped[i]
            if was != now and not self.flat[i]:
                out.append(("down" if now else "up", i))
            out.append(("outer" if now else "inner", i))
        if self.skipped[(start - 1) % n] and not self.flat[start]:
            out.append(("up", start))
        return out

    def interior(self) -> np.ndarray:
        inner = self.landed()
        return np.array([inner[i] if kind in ("inner", "down") else self.outer[i] for kind, i in self.walk()])


def ring_band(xy: np.ndarray, width: float, least_share: float = 0.25, passes: int = 12) -> Ring:
    """A band around one ring; where it would cross itself its width shrinks by 0.7, down to a share of the width."""
    step, widths = offsets(xy), np.full(len(xy), float(width))
    inner = xy + widths[:, None] * step
    bad = crossing_vertices(inner) | flat_cells(xy, inner)
    for _ in range(passes):
        shrink = bad & (widths > width * least_share)
        if not shrink.any():
            break
        widths = np.where(shrink, np.maximum(widths * 0.7, width * least_share), widths)
        inner = xy + widths[:, None] * step
        bad = crossing_vertices(inner) | flat_cells(xy, inner)
    return Ring(xy, inner, widths, bad)


def cut_corners(xy: np.ndarray, width: float, least_area: float, most_cut: float, corner_degrees: float = 120.0, **how) -> tuple[np.ndarray, int, float]:
    """(ring, vertices dropped, largest shift): vertices go where quads or corners are too small and the cut is small enough."""
    dropped, shift = 0, 0.0
    band = ring_band(xy, width, **how)
    while len(xy) > 8 and not band.failed.any():
        n = len(xy)
        small = np.flatnonzero(band.areas() < least_area)
        if len(small):
            v, w = xy - np.roll(xy, 1, axis=0), np.roll(xy, -1, axis=0) - xy
            turn = np.abs(np.mod(np.arctan2(w[:, 1], w[:, 0]) - np.arctan2(v[:, 1], v[:, 0]) + np.pi, 2 * np.pi) - np.pi)
            worst = int(small[np.argmin(band.areas()[small])])
            options = sorted((worst, (worst + 1) % n), key=lambda k: -turn[k])
        else:
            u, v = np.roll(band.inner, 1, axis=0) - band.inner, np.roll(band.inner, -1, axis=0) - band.inner
            cross, dot = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0], (u * v).sum(axis=1)
            angle = np.mod(np.arctan2(-cross, dot), 2 * np.pi)
            options = np.flatnonzero((angle < np.radians(corner_degrees)) & (np.abs(cross) / 2 < least_area)).tolist()
        for k in options:
            a, d = xy[k - 1], xy[(k + 1) % n] - xy[k - 1]
            t = np.clip((xy[k] - a) @ d / max(d @ d, 1e-300), 0, 1)
            far = float(np.hypot(*(xy[k] - a - t * d)))
            if far <= most_cut:
                xy, dropped, shift = np.delete(xy, k, axis=0), dropped + 1, max(shift, far)
                band = ring_band(xy, width, **how)
                break
        else:
            break
    return xy, dropped, shift


CELLS = "polygon long, ring int, i int, kind string, x double, y double, ix double, iy double, width double, area double, corner_cuts int, largest_cut double"


def polygon_bands(domain: DataFrame, spacing: float, width: float = 0.0, *, least_area: float = 0.0, most_cut: float = 0.0, least_share: float = 0.25, passes: int = 12) -> DataFrame:
    """A row for each segment of each ring of polygons (polygon, ring, holes): its start, its inner point, width, kind, area.

    Ring 0 is the outline, counter-clockwise; holes run clockwise. kind is quad, closing (a triangle) or skipped; without
    a width there is no band and all are skipped.
    """
    ship(domain.sparkSession)

    def one(polygon: int, k: int, pts) -> pd.DataFrame:
        xy = even_points(np.array([(p["x"], p["y"]) for p in pts], float), spacing)
        if (shoelace(xy) < 0) != (k > 0):
            xy = xy[::-1]
        cuts, shift = 0, 0.0
        if width > 0 and least_area > 0 and most_cut > 0:
            xy, cuts, shift = cut_corners(xy, width, least_area, most_cut, least_share=least_share, passes=passes)
        if width > 0:
            band = ring_band(xy, width, least_share, passes)
            band.drop_failed()
        else:
            band = Ring(xy, xy.copy(), np.zeros(len(xy)), np.zeros(len(xy), bool), np.ones(len(xy), bool))
        inner, quads = band.landed(), band.quads()
        kind = np.where(band.skipped, "skipped", np.where(quads, "quad", "closing"))
        return pd.DataFrame({"polygon": polygon, "ring": k, "i": np.arange(len(xy)), "kind": kind, "x": xy[:, 0], "y": xy[:, 1], "ix": inner[:, 0], "iy": inner[:, 1], "width": band.widths, "area": np.where(band.skipped, 0.0, band.areas()), "corner_cuts": cuts, "largest_cut": shift})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                for k, pts in enumerate([r.ring, *(r.holes if r.holes is not None else [])]):
                    if len(pts) > 2:
                        yield one(r.polygon, k, pts)

    return domain.select("polygon", "ring", "holes").mapInPandas(run, CELLS)


def interior_walk(cells: DataFrame) -> DataFrame:
    """polygon, ring, seq, step, i, x, y: the interior's boundary in order, from polygon_bands' rows."""
    ship(cells.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        outer, inner = pdf[["x", "y"]].to_numpy(), pdf[["ix", "iy"]].to_numpy()
        skipped = (pdf["kind"] == "skipped").to_numpy()
        flat = (skipped != np.roll(skipped, 1)) & (outer == inner).all(axis=1)
        ring = Ring(outer, inner, pdf["width"].to_numpy(), np.zeros(len(outer), bool), skipped, flat)
        steps = ring.walk()
        at = ring.interior()
        return pd.DataFrame({"polygon": pdf["polygon"].iloc[0], "ring": pdf["ring"].iloc[0], "seq": np.arange(len(steps)), "step": [s for s, _ in steps], "i": [i for _, i in steps], "x": at[:, 0], "y": at[:, 1]})

    return cells.groupBy("polygon", "ring").applyInPandas(run, "polygon long, ring int, seq long, step string, i long, x double, y double")


def report(cells: DataFrame, least_area: float, by: list[str] = ["polygon"]) -> DataFrame:  # noqa: B006
    """Quads and skipped segments by polygon: count, skipped, area_min, area_median, area_max, below_min."""
    quad = F.when(F.col("kind") == "quad", F.col("area"))
    return cells.groupBy(*by).agg(
        F.count(quad).alias("count"), F.count_if(F.col("kind") == "skipped").alias("skipped"), F.min(quad).alias("area_min"), F.median(quad).alias("area_median"), F.max(quad).alias("area_max"),
        F.count_if(quad < least_area).alias("below_min"),
    )


def report_all(cells: DataFrame, least_area: float) -> DataFrame:
    """One row over all polygons; the median is that of the polygons' medians."""
    one = report(cells, least_area)
    cuts = cells.groupBy("polygon").agg(F.max("corner_cuts").alias("cuts"), F.max("largest_cut").alias("shift"))
    t = one.join(cuts, "polygon")
    return t.agg(F.sum("count").alias("count"), F.sum("skipped").alias("skipped"), F.sum("below_min").alias("below_min"), F.min("area_min").alias("area_min"), F.max("area_max").alias("area_max"), F.median("area_median").alias("area_median"), F.sum("cuts").alias("corner_cuts"), F.max("shift").alias("corner_cut_max_m"))


def surfaces(cells: DataFrame) -> DataFrame:
    """polygon, ring, pts: the resampled outlines and holes."""
    ring = F.transform(F.array_sort(F.collect_list(F.struct("i", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return cells.groupBy("polygon", "ring").agg(ring.cast(POINTS).alias("pts"))
