"""Geometry as column expressions, so that it stays in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]


def c(x: str | Column | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def distance(p: Point, q: Point) -> Column:
    return F.hypot(q[0] - p[0], q[1] - p[1])


def signed_area(ring: list[Point]) -> Column:
    """Shoelace; positive for counter-clockwise rings."""
    n = len(ring)
    return reduce(lambda a, b: a + b, [cross(*ring[i], *ring[(i + 1) % n]) for i in range(n)]) / 2


def interior_angles(ring: list[Point]) -> list[Column]:
    """Degrees in 0..360 at each vertex of a counter-clockwise ring."""
    n, out = len(ring), []
    for i in range(n):
        (px, py), (x, y), (qx, qy) = ring[i - 1], ring[i], ring[(i + 1) % n]
        ux, uy, vx, vy = px - x, py - y, qx - x, qy - y
        turn = F.degrees(F.atan2(cross(vx, vy, ux, uy), ux * vx + uy * vy))
        out.append(F.when(turn < 0, turn + 360).otherwise(turn))
    return out


def side_lengths(ring: list[Point]) -> list[Column]:
    return [distance(ring[i], ring[(i + 1) % len(ring)]) for i in range(len(ring))]


def corner_jacobians(ring: list[Point]) -> list[Column]:
    """Cross product of the sides at each corner over the product of their lengths; 0 at a side without length."""
    n, out = len(ring), []
    for i in range(n):
        (px, py), (x, y), (qx, qy) = ring[i - 1], ring[i], ring[(i + 1) % n]
        size = F.hypot(x - px, y - py) * F.hypot(qx - x, qy - y)
        out.append(F.when(size > 0, cross(x - px, y - py, qx - x, qy - y) / size).otherwise(0.0))
    return out


def point_segment_distance(p: Point, a: Point, b: Point) -> Column:
    dx, dy = b[0] - a[0], b[1] - a[1]
    square = dx * dx + dy * dy
    t = F.when(square > 0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / square).otherwise(0.0)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def inside_convex(p: Point, ring: list[Point]) -> Column:
    """Whether p is on the left of, or on, every side of a counter-clockwise convex ring."""
    n = len(ring)
    return reduce(lambda a, b: a & b, [cross(ring[(i + 1) % n][0] - ring[i][0], ring[(i + 1) % n][1] - ring[i][1], p[0] - ring[i][0], p[1] - ring[i][1]) >= 0 for i in range(n)])


def segments_cross(a: Point, b: Point, p: Point, q: Point) -> Column:
    """Whether two segments share a point (collinear overlaps included)."""

    def side(o: Point, d: Point, x: Point) -> Column:
        return F.signum(cross(d[0] - o[0], d[1] - o[1], x[0] - o[0], x[1] - o[1]))

    def within(o: Point, d: Point, x: Point) -> Column:
        return x[0].between(F.least(o[0], d[0]), F.greatest(o[0], d[0])) & x[1].between(F.least(o[1], d[1]), F.greatest(o[1], d[1]))

    s1, s2, s3, s4 = side(a, b, p), side(a, b, q), side(p, q, a), side(p, q, b)
    touch = ((s1 == 0) & within(a, b, p)) | ((s2 == 0) & within(a, b, q)) | ((s3 == 0) & within(p, q, a)) | ((s4 == 0) & within(p, q, b))
    return ((s1 * s2 < 0) & (s3 * s4 < 0)) | touch


def segment_distance(a: Point, b: Point, p: Point, q: Point) -> Column:
    ends = F.least(point_segment_distance(a, p, q), point_segment_distance(b, p, q), point_segment_distance(p, a, b), point_segment_distance(q, a, b))
    return F.when(segments_cross(a, b, p, q), 0.0).otherwise(ends)


def grid_cells(lo: Column, hi: Column, size: float) -> Column:
    """Indices of the grid cells that an interval meets."""
    return F.sequence(F.floor(lo / size).cast("long"), F.floor(hi / size).cast("long"))
