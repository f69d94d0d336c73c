"""One block's mesh in a kernel: merging, collapsing, opening and bisecting cells until area, shape and ratio rules hold.

A block is the unit that the mesh comes in; blocks are repaired in parallel and don't touch each other's cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.operators.quality import Limits

Edge = tuple[int, int]
Point = tuple[float, float]


def edge(a: int, b: int) -> Edge:
    return (a, b) if a < b else (b, a)


def sides(cell: tuple[int, ...]) -> list[Edge]:
    return [(cell[i], cell[(i + 1) % len(cell)]) for i in range(len(cell))]


def signed_area(pts: list[Point]) -> float:
    return 0.5 * sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, pts[1:] + pts[:1], strict=True))


def lengths(pts: list[Point]) -> list[float]:
    return [math.dist(p, q) for p, q in zip(pts, pts[1:] + pts[:1], strict=True)]


def corner_angles(pts: list[Point]) -> list[float]:
    out = []
    for i, (x, y) in enumerate(pts):
        (px, py), (qx, qy) = pts[i - 1], pts[(i + 1) % len(pts)]
        t = math.degrees(math.atan2((qx - x) * (py - y) - (qy - y) * (px - x), (px - x) * (qx - x) + (py - y) * (qy - y)))
        out.append(t + 360 if t < 0 else t)
    return out


def jacobian(pts: list[Point]) -> float:
    """The least corner's cross product over its sides' lengths."""
    out = []
    for i, (x, y) in enumerate(pts):
        (px, py), (qx, qy) = pts[i - 1], pts[(i + 1) % len(pts)]
        size = math.dist((x, y), (px, py)) * math.dist((x, y), (qx, qy))
        out.append(((x - px) * (qy - y) - (y - py) * (qx - x)) / size if size else 0.0)
    return min(out)


def good_triangle(pts: list[Point], rules: Limits) -> bool:
    area = abs(signed_area(pts))
    a, b, c = lengths(pts)
    s, product = (a + b + c) / 2, a * b * c
    if area < rules.min_area or area == 0 or product == 0:
        return False
    return min(corner_angles(pts)) >= rules.triangle_min_angle and 8 * area * area / (s * product) >= rules.triangle_radius_ratio and product * s / (8 * area * area) <= rules.triangle_aspect


def good_quad(pts: list[Point], rules: Limits, relaxed: bool) -> float | None:
    """Its Jacobian if it is convex, large enough and (unless relaxed) well shaped."""
    j = jacobian(pts)
    if j <= 0 or abs(signed_area(pts)) < rules.min_area:
        return None
    if not relaxed:
        angles, size = corner_angles(pts), lengths(pts)
        if max(size) > rules.quad_aspect * min(size) or min(angles) < rules.quad_min_angle or max(angles) > rules.quad_max_angle or j < rules.quad_jacobian:
            return None
    return j


@dataclass
class Done:
    """What a repair did and refused."""

    merged_pairs: int = 0
    relaxed_merges: int = 0
    collapsed_edges: int = 0
    split_quads: int = 0
    split_band_quads: int = 0
    split_band_quads_ratio: int = 0
    split_coarse: int = 0
    rejected_nonconvex: int = 0
    remaining_undersized: int = 0
    sacrificed_constraints: int = 0


@dataclass
class Patch:
    """Cells by number with their surface, nodes, and the index from sides and nodes to cells."""

    points: dict[int, Point]
    cells: dict[int, tuple[int, ...]]
    surface: dict[int, int]
    band: set[int]  # surfaces of the boundary band
    marked: set[Edge]  # constrained sides
    done: Done = field(default_factory=Done)

    def __post_init__(self) -> None:
        self.by_side: dict[Edge, set[int]] = {}
        self.by_node: dict[int, set[int]] = {}
        for c, nodes in self.cells.items():
            self._link(c, nodes)
        self.next_cell = max(self.cells, default=-1) + 1
        self.next_node = max(self.points, default=-1) + 1

    def _link(self, c: int, nodes: tuple[int, ...]) -> None:
        for a, b in sides(nodes):
            self.by_side.setdefault(edge(a, b), set()).add(c)
        for n in nodes:
            self.by_node.setdefault(n, set()).add(c)

    def drop(self, c: int) -> None:
        nodes = self.cells.pop(c)
        for a, b in sides(nodes):
            held = self.by_side[edge(a, b)]
            held.discard(c)
            if not held:
                del self.by_side[edge(a, b)]
        for n in nodes:
            self.by_node[n].discard(c)

    def add(self, nodes: tuple[int, ...], surface: int) -> int:
        c = self.next_cell
        self.next_cell += 1
        self.cells[c], self.surface[c] = nodes, surface
        self._link(c, nodes)
        return c

    def ring(self, nodes: Iterable[int]) -> list[Point]:
        return [self.points[n] for n in nodes]

    def area(self, c: int) -> float:
        return signed_area(self.ring(self.cells[c]))

    def size(self, c: int) -> float:
        a = abs(self.area(c))
        return math.sqrt(4 * a / math.sqrt(3)) if len(self.cells[c]) == 3 else math.sqrt(a)

    def in_band(self, c: int) -> bool:
        return self.surface[c] in self.band

    def rim(self) -> set[int]:
        """Nodes of sides that one cell alone holds."""
        return {n for e, held in self.by_side.items() if len(held) == 1 for n in e}

    def spared(self, c: int, rim: set[int]) -> bool:
        """Whether the cell touches the boundary, or is in the band: its area may be small."""
        return self.in_band(c) or any(a in rim and b in rim for a, b in sides(self.cells[c]))

    def small(self, least: float) -> list[int]:
        """Undersized triangles off the boundary, smallest first."""
        rim = self.rim()
        found = [(abs(self.area(c)), c) for c, nodes in self.cells.items() if len(nodes) == 3 and abs(self.area(c)) < least]
        return [c for _, c in sorted(found) if not self.spared(c, rim)]

    def undersized(self, least: float) -> int:
        rim = self.rim()
        return sum(abs(self.area(c)) < least and not self.spared(c, rim) for c in list(self.cells))

    # merging

    def merge(self, rules: Limits, relaxed: bool, free: bool) -> int:
        """Undersized triangles joined with the neighbour that makes the best quad; over constrained sides only if free."""
        pairs = 0
        for c in self.small(rules.min_area):
            if c not in self.cells:
                continue
            best: tuple[float, int, tuple[int, ...]] | None = None
            nodes = self.cells[c]
            for k in range(3):
                a, b, apex = nodes[k], nodes[(k + 1) % 3], nodes[(k + 2) % 3]
                if not free and edge(a, b) in self.marked:
                    continue
                for o in sorted(self.by_side[edge(a, b)] - {c}):
                    rest = [n for n in self.cells[o] if n not in (a, b)]
                    if len(self.cells[o]) != 3 or len(rest) != 1:
                        continue
                    quad = (apex, a, rest[0], b)
                    if jacobian(self.ring(quad)) <= 0:
                        self.done.rejected_nonconvex += 1
                        continue
                    j = good_quad(self.ring(quad), rules, relaxed)
                    if j is not None and (best is None or j > best[0]):
                        best = (j, o, quad)
            if best is not None:
                surface = self.surface[c]
                self.drop(c)
                self.drop(best[1])
                self.add(best[2], surface)
                pairs += 1
        self.done.merged_pairs += pairs
        self.done.relaxed_merges += pairs if relaxed else 0
        self.done.remaining_undersized = self.undersized(rules.min_area)
        return pairs

    # collapsing

    def _around(self, nodes: Iterable[int], least: float) -> tuple[int, float]:
        areas = [abs(self.area(c)) for c in set().union(*(self.by_node.get(n, set()) for n in nodes))]
        return sum(a < least for a in areas), min(areas, default=math.inf)

    def _collapsed(self, keep: int, gone: int, at: Point, least: float) -> tuple[int, float] | None:
        """How the cells around would be after a collapse, or nothing if one would turn over or become concave."""
        areas = []
        for c in self.by_node[keep] | self.by_node[gone]:
            nodes = tuple(dict.fromkeys(keep if n == gone else n for n in self.cells[c]))
            if len(nodes) < 3:
                continue
            pts = [at if n == keep else self.points[n] for n in nodes]
            if signed_area(pts) <= 0 or (len(nodes) == 4 and jacobian(pts) <= 0):
                return None
            areas.append(signed_area(pts))
        return sum(a < least for a in areas), min(areas, default=math.inf)

    def collapse(self, rules: Limits, free: bool, most: int | None = None) -> int:
        """Shortest sides of undersized triangles collapsed while that helps; each one takes a cell away, so it ends.

        Boundary nodes never move, nodes of constrained sides only if free.
        """
        n = 0
        pinned = self.rim() | (set() if free else {x for e in self.marked for x in e})
        while most is None or n < most:
            step = next(self._steps(rules.min_area, pinned), None)
            if step is None:
                break
            keep, gone, at = step
            self.points[keep] = at
            for c in sorted(self.by_node[gone]):
                nodes, surface = tuple(dict.fromkeys(keep if x == gone else x for x in self.cells[c])), self.surface[c]
                self.drop(c)
                if len(nodes) >= 3:
                    self.add(nodes, surface)
            n += 1
        self.done.collapsed_edges += n
        self.done.remaining_undersized = self.undersized(rules.min_area)
        return n

    def _steps(self, least: float, pinned: set[int]):
        for c in self.small(least):
            for a, b in sorted(sides(self.cells[c]), key=lambda s: math.dist(self.points[s[0]], self.points[s[1]])):
                p, q = self.points[a], self.points[b]
                if a in pinned and b in pinned:
                    continue
                options = [(a, b, p)] if a in pinned else [(b, a, q)] if b in pinned else [(a, b, ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)), (a, b, p), (b, a, q)]
                bad, low = self._around((a, b), least)
                for option in options:
                    after = self._collapsed(*option, least)
                    if after is not None and (after[0] < bad or (after[0] == bad and after[1] > low * (1 + 1e-9))):
                        yield option

    # opening quads

    def halves(self, c: int, least: float) -> list[tuple[int, ...]] | None:
        """The two triangles of the better diagonal, if both are large enough."""
        a, b, d, e = self.cells[c]
        best: tuple[float, list[tuple[int, ...]]] | None = None
        for pair in ([(a, b, d), (a, d, e)], [(a, b, e), (b, d, e)]):
            low = min(abs(signed_area(self.ring(t))) for t in pair)
            if low > 0 and low >= least and (best is None or low > best[0]):
                best = (low, pair)
        return best and best[1]

    def open(self, quads: Iterable[int], least: float) -> int:
        n = 0
        for c in quads:
            pair = self.halves(c, least)
            if pair is not None:
                surface = self.surface[c]
                self.drop(c)
                for t in pair:
                    self.add(t, surface)
                n += 1
        return n

    def open_around_small(self, rules: Limits, with_band: bool) -> int:
        """One neighbouring quad of each undersized triangle back into triangles."""
        chosen: dict[int, None] = {}
        for c in sorted(c for c, nodes in self.cells.items() if len(nodes) == 3 and abs(self.area(c)) < rules.min_area):
            near = (o for a, b in sides(self.cells[c]) for o in sorted(self.by_side[edge(a, b)]) if len(self.cells[o]) == 4 and (with_band or not self.in_band(o)))
            first = next(near, None)
            if first is not None:
                chosen[first] = None
        return self.open(chosen, rules.min_area)

    # neighbour ratio

    def coarse(self, ratio: float) -> set[int]:
        """Larger cells of pairs whose sizes are too far apart."""
        size = {c: self.size(c) for c in self.cells}
        out = set()
        for held in self.by_side.values():
            if len(held) == 2:
                a, b = sorted(held, key=lambda c: (-size[c], c))
                if size[a] > ratio * max(size[b], 1e-12):
                    out.add(a)
        return out

    def open_band(self, rules: Limits) -> int:
        return self.open(sorted(c for c in self.coarse(rules.neighbour_ratio) if len(self.cells[c]) == 4 and self.in_band(c)), rules.min_area)

    def open_for_coarse(self, rules: Limits, coarse: Iterable[int]) -> int:
        """Of each coarse triangle the largest neighbouring quad whose halves pass, unless it is too fine already."""
        chosen: dict[int, None] = {}
        for c in sorted(coarse):
            best, best_size = None, 0.0
            for a, b in sides(self.cells[c]):
                for o in self.by_side[edge(a, b)]:
                    if len(self.cells[o]) != 4 or self.in_band(o):
                        continue
                    s = self.size(o)
                    pair = self.halves(o, 0.0)
                    if s * rules.neighbour_ratio >= self.size(c) and s > best_size and pair is not None and all(good_triangle(self.ring(t), rules) for t in pair):
                        best, best_size = o, s
            if best is not None:
                chosen[best] = None
        return self.open(chosen, 0.0)

    def bisect(self, rules: Limits, picked: Iterable[int]) -> tuple[int, bool]:
        """(cells cut, whether a quad was in the way): the longest side that can be, at its middle, with the cell across."""
        touched: set[int] = set()
        n, blocked = 0, False
        for c in sorted(picked, key=lambda c: (-abs(self.area(c)), c)):
            if c in touched or c not in self.cells:
                continue
            nodes = self.cells[c]
            order = sorted(range(3), key=lambda k: -math.dist(self.points[nodes[k]], self.points[nodes[(k + 1) % 3]]))
            for k in order:
                a, b, apex = nodes[k], nodes[(k + 1) % 3], nodes[(k + 2) % 3]
                held = self.by_side[edge(a, b)] - {c}
                if any(len(self.cells[o]) == 4 for o in held):
                    blocked = True
                    continue
                other = min(held, default=None)
                if other is not None and (other in touched or self.in_band(other)):
                    continue
                (ax, ay), (bx, by) = self.points[a], self.points[b]
                m = self.next_node
                self.points[m] = ((ax + bx) / 2, (ay + by) / 2)
                new = [(c, (a, m, apex)), (c, (m, b, apex))]
                if other is not None:
                    far = next(x for x in self.cells[other] if x not in (a, b))
                    new += [(other, (b, m, far)), (other, (m, a, far))]
                if not all(good_triangle(self.ring(t), rules) for _, t in new):
                    del self.points[m]
                    continue
                self.next_node += 1
                surface = {o: self.surface[o] for o, _ in new}
                for o in surface:
                    self.drop(o)
                touched |= {self.add(t, surface[o]) for o, t in new} | set(surface)
                if edge(a, b) in self.marked:
                    self.marked.discard(edge(a, b))
                    self.marked |= {edge(a, m), edge(m, b)}
                n += 1
                break
        return n, blocked

    def split_coarse(self, rules: Limits, passes: int = 8) -> int:
        total = 0
        for _ in range(passes):
            picked = {c for c in self.coarse(rules.neighbour_ratio) if len(self.cells[c]) == 3 and not self.in_band(c)}
            if not picked:
                break
            n, blocked = self.bisect(rules, picked)
            total += n
            if not n and not (blocked and self.open_for_coarse(rules, picked)):
                break
        return total

    # all of it

    def live(self) -> int:
        return sum(e in self.by_side for e in self.marked)

    def repair(self, rules: Limits, passes: int = 5, triangles_only: bool = False) -> Done:
        """Strict merges, relaxed ones and collapses until nothing is undersized; then constraints, then the band give way.

        In the end coarse band quads and coarse triangles are split until neighbours' sizes agree.
        """
        done = self.done
        done.remaining_undersized = self.undersized(rules.min_area)
        before = self.live()
        for free in (False, True):
            for _ in range(passes):
                moves = done.merged_pairs + done.collapsed_edges
                for relaxed in () if triangles_only else ((True,) if free else (False, True)):
                    for _ in range(passes):
                        if not self.merge(rules, relaxed, free):
                            break
                if done.remaining_undersized:
                    self.collapse(rules, free)
                if not done.remaining_undersized:
                    break
                if done.merged_pairs + done.collapsed_edges == moves:
                    opened = self.open_around_small(rules, with_band=free)
                    done.split_quads += opened
                    done.split_band_quads += opened if free else 0
                    if not opened:
                        break
            if not done.remaining_undersized:
                break
        done.sacrificed_constraints = before - self.live()
        done.split_band_quads_ratio = self.open_band(rules)
        done.split_quads += done.split_band_quads_ratio
        done.split_coarse = self.split_coarse(rules)
        return done


COUNTS = tuple(Done.__dataclass_fields__)
ROWS = "block long, kind int, id long, n0 long, n1 long, n2 long, n3 long, x double, y double, surface int, what string, n long"


def repaired(elem: DataFrame, nodes: DataFrame, constrained: DataFrame, rules: Limits, band: tuple[int, ...] = (), triangles_only: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(elements, nodes, constrained sides, counts) of repaired blocks.

    elem: block, eid, surface, n0..n3; nodes: block, id, x, y; constrained: block, lo, hi. Each block is repaired by one
    kernel call; cells and nodes that a repair adds are numbered beyond the block's own. counts: block, what, n.
    """
    ship(elem.sparkSession)
    none = lambda t: F.lit(None).cast(t)
    parts = (
        elem.select("block", F.lit(0).alias("what"), F.col("eid").alias("id"), "n0", "n1", "n2", "n3", none("double").alias("x"), none("double").alias("y"), "surface"),
        nodes.select("block", F.lit(1).alias("what"), "id", *[none("long").alias(f"n{i}") for i in range(4)], "x", "y", none("int").alias("surface")),
        constrained.select("block", F.lit(2).alias("what"), F.lit(0).cast("long").alias("id"), F.col("lo").alias("n0"), F.col("hi").alias("n1"), none("long").alias("n2"), none("long").alias("n3"), none("double").alias("x"), none("double").alias("y"), none("int").alias("surface")),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = pdf["block"].iloc[0]
        cells, pts, lines = (pdf[pdf["what"] == k] for k in range(3))
        shape = {int(r.id): tuple(int(v) for v in (r.n0, r.n1, r.n2, r.n3) if not pd.isna(v)) for r in cells.itertuples()}
        patch = Patch(
            {int(r.id): (r.x, r.y) for r in pts.itertuples()}, shape, {int(r.id): int(r.surface) for r in cells.itertuples()}, set(band), {edge(int(r.n0), int(r.n1)) for r in lines.itertuples()}
        )
        done = patch.repair(rules, triangles_only=triangles_only)
        used = {n for c in patch.cells.values() for n in c}
        rows = [(block, 0, c, *nodes, *([None] * (4 - len(nodes))), None, None, patch.surface[c], None, None) for c, nodes in sorted(patch.cells.items())]
        rows += [(block, 1, n, None, None, None, None, *patch.points[n], None, None, None) for n in sorted(used)]
        rows += [(block, 2, 0, a, b, None, None, None, None, None, None, None) for a, b in sorted(patch.marked)]
        rows += [(block, 3, 0, None, None, None, None, None, None, None, k, getattr(done, k)) for k in COUNTS]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")])
        return out.astype({c: "Int64" for c in ("n0", "n1", "n2", "n3", "n")} | {"surface": "Int32", "x": float, "y": float})

    from tessera.cluster import cut

    every = cut(parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("block").applyInPandas(run, ROWS))
    kind = F.when(F.col("n3").isNull(), 3).otherwise(4).alias("kind")
    return (
        every.where("kind = 0").select("block", F.col("id").alias("eid"), kind, "n0", "n1", "n2", "n3", "surface"),
        every.where("kind = 1").select("block", "id", "x", "y"),
        every.where("kind = 2").select("block", F.col("n0").alias("lo"), F.col("n1").alias("hi")),
        every.where("kind = 3").select("block", "what", "n"),
    )


def as_arrays(patch: Patch) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """(points by rising number, cells in rising number of the points' places)."""
    order = sorted(patch.points)
    place = {n: i for i, n in enumerate(order)}
    return np.array([patch.points[n] for n in order]), [tuple(place[n] for n in patch.cells[c]) for c in sorted(patch.cells)]
