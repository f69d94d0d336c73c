"""Spatial joins as equi-joins on grid cells with an exact predicate after: no theta join, no nested loop."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.functions import geometry as g
from tessera.operators.quality import either, ring


def boxes(geom: DataFrame) -> DataFrame:
    """geom with xlo, xhi, ylo, yhi."""
    ends = lambda f, a: f(*[F.col(f"{a}{i}") for i in range(4)])  # noqa: E731  nulls are skipped
    return geom.withColumns({"xlo": ends(F.least, "x"), "xhi": ends(F.greatest, "x"), "ylo": ends(F.least, "y"), "yhi": ends(F.greatest, "y")})


def gridded(df: DataFrame, cell: float) -> DataFrame:
    """A row for each grid cell (gx, gy) that a box meets."""
    return df.withColumn("gx", F.explode(g.grid_cells(F.col("xlo"), F.col("xhi"), cell))).withColumn("gy", F.explode(g.grid_cells(F.col("ylo"), F.col("yhi"), cell)))


def points_in_elements(points: DataFrame, geom: DataFrame, cell: float) -> DataFrame:
    """points (pid, px, py) with eid: the element that holds each, the largest eid on shared sides; null outside all."""
    at = points.withColumn("gx", F.floor(F.col("px") / cell).cast("long")).withColumn("gy", F.floor(F.col("py") / cell).cast("long"))
    near = at.join(gridded(boxes(geom), cell), ["gx", "gy"])
    p = (F.col("px"), F.col("py"))
    inside = near.where(either(g.inside_convex(p, ring(3)), g.inside_convex(p, ring(4))))
    return points.join(inside.groupBy("pid").agg(F.max("eid").alias("eid")), "pid", "left")


def _apart(axes, ring_points, xlo, ylo, xhi, yhi):
    """Whether some axis keeps a ring and a box apart."""
    out = F.lit(False)
    for ax, ay in axes:
        mine = [x * ax + y * ay for x, y in ring_points]
        other = [x * ax + y * ay for x in (xlo, xhi) for y in (ylo, yhi)]
        out = out | (F.least(*mine) > F.greatest(*other)) | (F.greatest(*mine) < F.least(*other))
    return out


def touched(pixels: DataFrame, geom: DataFrame, cell: float) -> DataFrame:
    """(pid, eid) of boxes (pid, bx0, by0, bx1, by1) and the convex elements that they touch; a box may touch many."""
    b = pixels.withColumns({"xlo": F.col("bx0"), "xhi": F.col("bx1"), "ylo": F.col("by0"), "yhi": F.col("by1")})
    near = gridded(b, cell).select("pid", "bx0", "by0", "bx1", "by1", "gx", "gy").join(gridded(boxes(geom), cell), ["gx", "gy"])
    box = (F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"))

    def hit(n: int):
        pts = ring(n)
        axes = [(F.lit(1.0), F.lit(0.0)), (F.lit(0.0), F.lit(1.0))] + [(pts[i][1] - pts[(i + 1) % n][1], pts[(i + 1) % n][0] - pts[i][0]) for i in range(n)]
        return ~_apart(axes, pts, *box)

    return near.where(either(hit(3), hit(4))).select("pid", "eid").distinct()


def clipped(subject: np.ndarray, n: np.ndarray, convex: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of many polygons inside one convex counter-clockwise polygon each: (vertices, counts).

    subject is (rows, most vertices, 2) with counts n, convex (rows, 4, 2) with counts m. A polygon that isn't convex may
    come back with sides that run to and fro, which have no area.
    """
    rows = np.arange(len(subject))
    for k in range(convex.shape[1]):
        live = k < m
        a, b = convex[:, k], convex[rows, np.where(k + 1 < m, k + 1, 0)]
        width = subject.shape[1]
        d = b - a
        side = d[:, None, 0] * (subject[:, :, 1] - a[:, None, 1]) - d[:, None, 1] * (subject[:, :, 0] - a[:, None, 0])
        at = np.arange(width)
        nxt = np.where(at[None, :] + 1 < n[:, None], at[None, :] + 1, 0)
        q, t = np.take_along_axis(subject, nxt[:, :, None], 1), np.take_along_axis(side, nxt, 1)
        held = at[None, :] < n[:, None]
        keep, cross = held & ((side >= 0) | ~live[:, None]), held & (side * t < 0) & live[:, None]
        u = np.where(cross, side / np.where(cross, side - t, 1), 0)
        both = np.stack([subject, subject + u[:, :, None] * (q - subject)], axis=2).reshape(len(subject), 2 * width, 2)
        mask = np.stack([keep, cross], axis=2).reshape(len(subject), 2 * width)
        order = np.argsort(~mask, axis=1, kind="stable")
        n = mask.sum(axis=1)
        subject = np.take_along_axis(both, order[:, : max(1, int(n.max(initial=1))), None], 1)
    return subject, n


def areas_of(polygon: np.ndarray, n: np.ndarray) -> np.ndarray:
    at = np.arange(polygon.shape[1])
    nxt = np.take_along_axis(polygon, np.where(at[None, :] + 1 < n[:, None], at[None, :] + 1, 0)[:, :, None], 1)
    cross = polygon[:, :, 0] * nxt[:, :, 1] - polygon[:, :, 1] * nxt[:, :, 0]
    return np.where(at[None, :] < n[:, None], cross, 0).sum(axis=1) / 2


def outline(polygons: list[np.ndarray]) -> tuple[float, float]:
    """(area, boundary length) of the union of some counter-clockwise polygons.

    Sides are cut where they meet others; a piece is on the boundary if no other polygon holds its middle. Pieces that
    coincide count once if they run the same way and not at all if they run against each other.
    """
    side = [np.column_stack([p, np.roll(p, -1, axis=0), np.full(len(p), i)]) for i, p in enumerate(polygons)]
    e = np.concatenate(side)
    e = e[np.hypot(e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]) > 1e-9]
    if not len(e):
        return 0.0, 0.0
    a, d, owner = e[:, :2], e[:, 2:4] - e[:, :2], e[:, 4].astype(int)
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    den = cross(d[:, None], d[None])
    rel = a[None] - a[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(rel, d[None]) / den, cross(rel, d[:, None]) / den
    square = (d**2).sum(axis=1)
    pieces, group = [], []
    for i in range(len(e)):
        cuts = t[i][(den[i] != 0) & (t[i] > 0) & (t[i] < 1) & (u[i] >= -1e-12) & (u[i] <= 1 + 1e-12)]
        flat = np.flatnonzero((den[i] == 0) & (np.abs(cross(rel[i], d[i])) <= 1e-9 * square[i]))  # on the same line
        ends = np.concatenate([a[flat], a[flat] + d[flat]])
        along = ((ends - a[i]) @ d[i]) / square[i]
        at = np.unique(np.concatenate([[0.0, 1.0], cuts, along[(along > 0) & (along < 1)]]))
        at = at[np.concatenate([[True], np.diff(at) > 1e-12])]
        pieces.append(np.column_stack([a[i] + at[:-1, None] * d[i], a[i] + at[1:, None] * d[i]]))
        group.append(np.full(len(at) - 1, owner[i]))
    p, g = np.concatenate(pieces), np.concatenate(group)
    mid = (p[:, :2] + p[:, 2:]) / 2
    free = np.ones(len(p), bool)
    for i, poly in enumerate(polygons):
        q = np.roll(poly, -1, axis=0)
        spans = (poly[None, :, 1] > mid[:, None, 1]) != (q[None, :, 1] > mid[:, None, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            x = poly[:, 0] + (mid[:, None, 1] - poly[:, 1]) * (q[:, 0] - poly[:, 0]) / (q[:, 1] - poly[:, 1])
        inside = (spans & (mid[:, None, 0] < x)).sum(axis=1) % 2 == 1
        rel, way = mid[:, None] - poly[None], (q - poly)[None]
        size = (way**2).sum(axis=2)
        s = np.clip((rel * way).sum(axis=2) / np.where(size > 0, size, 1), 0, 1)
        on = (((rel - s[:, :, None] * way) ** 2).sum(axis=2) < 1e-14 * np.maximum(size, 1)).any(axis=1)
        free &= ~(inside & ~on & (g != i))
    key = np.rint(p * 1e6).astype(np.int64)
    seen: dict[tuple, int] = {}
    for k in np.flatnonzero(free):
        seen.setdefault(tuple(key[k]), k)
    kept = [k for way, k in seen.items() if (way[2], way[3], way[0], way[1]) not in seen]
    p = p[kept]
    return float(cross(p[:, :2], p[:, 2:]).sum() / 2), float(np.hypot(*(p[:, 2:] - p[:, :2]).T).sum())


def rings_of(footprints: DataFrame) -> DataFrame:
    """footprints with pts: as they are, or their box (bx0, by0, bx1, by1)."""
    if "pts" in footprints.columns:
        return footprints
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return footprints.withColumn("pts", F.array(corner("bx0", "by0"), corner("bx1", "by0"), corner("bx1", "by1"), corner("bx0", "by1")))


def overlaps(geom: DataFrame, footprints: DataFrame, cell: float, fields: tuple[str, ...] = ()) -> DataFrame:
    """eid, pid, *fields, area, pts: each polygon's part in each convex element that its box touches, counter-clockwise."""
    ship(geom.sparkSession)
    hits = touched(footprints, geom, cell).join(rings_of(footprints).select("pid", "pts", *fields), "pid").join(geom, "eid")

    def run(batches):
        for pdf in batches:
            n = np.array([len(p) for p in pdf["pts"]])
            subject = np.zeros((len(pdf), max(3, int(n.max(initial=3))), 2))
            for i, pts in enumerate(pdf["pts"]):
                xy = np.array([(q["x"], q["y"]) for q in pts]).reshape(-1, 2)
                twice = xy[:, 0] @ np.roll(xy[:, 1], -1) - xy[:, 1] @ np.roll(xy[:, 0], -1) if len(xy) else 0
                subject[i, : len(xy)] = xy if twice >= 0 else xy[::-1]
            convex = np.stack([np.stack([pdf[f"{a}{i}"].to_numpy(float, na_value=0.0) for a in "xy"], axis=1) for i in range(4)], axis=1)
            part, m = clipped(subject, n, np.nan_to_num(convex), pdf["kind"].to_numpy())
            area = areas_of(part, m)
            keep = area > 0
            out = pdf.loc[keep, ["eid", "pid", *fields]].assign(area=area[keep])
            yield out.assign(pts=[part[i, : m[i]].ravel().tolist() for i in np.flatnonzero(keep)])

    types = {f.name: f.dataType.simpleString() for f in footprints.schema}
    return hits.mapInPandas(run, f"eid long, pid {types['pid']}, " + "".join(f"{f} {types[f]}, " for f in fields) + "area double, pts array<double>")


def building_cover(geom: DataFrame, areas: DataFrame, footprints: DataFrame, cell: float, most: float = 0.95) -> DataFrame:
    """eid, ratio, perimeter: an element's overlap with the union of footprints, and that union's boundary length in it.

    footprints: pid, bx0, by0, bx1, by1 and pts for polygons that aren't boxes. Parts are clipped a batch at a time; only
    the few parts of one element meet in a kernel for their union.
    """
    parts = overlaps(geom, footprints, cell).join(areas.select("eid", F.col("area").alias("whole")), "eid")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        area, length = outline([np.array(p).reshape(-1, 2) for p in rows["pts"]])
        whole = rows["whole"].iloc[0]
        return pd.DataFrame({"eid": [rows["eid"].iloc[0]], "ratio": [min(area / whole, most) if whole > 0 else 0.0], "perimeter": [length]})

    return parts.groupBy("eid").applyInPandas(run, "eid long, ratio double, perimeter double")


def weighted_cover(geom: DataFrame, areas: DataFrame, patches: DataFrame, cell: float, fields: tuple[str, ...], most: float = 0.95) -> DataFrame:
    """eid, chi and the area-weighted mean of each field over patches (pid, bx0, by0, bx1, by1, maybe pts).

    Overlaps count once for each patch, and a missing field adds nothing to its sum but keeps its area.
    """
    parts = overlaps(geom, patches, cell, fields).withColumnRenamed("area", "w")
    finite = lambda f: F.when(F.col(f).isNull() | F.isnan(f), 0.0).otherwise(F.col(f) * F.col("w"))
    total = parts.groupBy("eid").agg(F.sum("w").alias("w"), *[(F.sum(finite(f)) / F.sum("w")).alias(f) for f in fields])
    chi = F.when(F.col("area") > 0, F.least(F.col("w") / F.col("area"), F.lit(most))).otherwise(0.0)
    return total.join(areas.select("eid", "area"), "eid").select("eid", chi.alias("chi"), *fields)
