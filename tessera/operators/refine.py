"""The refinement loop's decisions: convergence, what can't be resolved, reference lines, initial size fields, logs."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality, sizefield

# Fixed value: elements up to this much above the least area are at the floor.
AT_FLOOR = 1.05
TERRAIN = ("bad_rmse", "bad_spread", "bad_samples")


@dataclass(frozen=True)
class Grid:
    """A size field's grid: first x and y, spacing, columns and rows."""

    x0: float
    y0: float
    spacing: float
    nx: int
    ny: int

    @classmethod
    def around(cls, xlo: float, ylo: float, xhi: float, yhi: float, spacing: float, pad: float) -> Grid:
        """A grid over a box widened by pad on every side."""
        return cls(xlo - pad, ylo - pad, spacing, math.ceil((xhi - xlo + 2 * pad) / spacing) + 1, math.ceil((yhi - ylo + 2 * pad) / spacing) + 1)

    def cells(self, points: DataFrame, x: str, y: str) -> DataFrame:
        """points with iy, ix of the nearest grid point."""
        return points.withColumns({"iy": sizefield.nearest(F.col(y), self.y0, self.spacing, self.ny), "ix": sizefield.nearest(F.col(x), self.x0, self.spacing, self.nx)})


def bounds(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: xlo, ylo, xhi, yhi."""
    return points.agg(F.min(x).alias("xlo"), F.min(y).alias("ylo"), F.max(x).alias("xhi"), F.max(y).alias("yhi"))


def densified(lines: DataFrame, step: float) -> DataFrame:
    """line, seq, x, y: points along polylines (line, pts) at most step apart, with all vertices."""
    n = F.size("pts")
    pairs = F.zip_with(F.slice("pts", 1, n - 1), F.slice("pts", 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    piece = lines.where(n > 1).select("line", F.posexplode(pairs).alias("i", "s")).select("line", "i", F.col("s.a").alias("a"), F.col("s.b").alias("b"))
    parts = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")) / step).cast("int"))
    first = F.when(F.col("i") == 0, 0).otherwise(1)
    at = piece.withColumn("m", parts).withColumn("k", F.explode(F.sequence(first, F.col("m"))))
    t = F.col("k") / F.col("m")
    along = lambda c: (F.col(f"a.{c}") + t * (F.col(f"b.{c}") - F.col(f"a.{c}"))).alias(c)
    out = at.select("line", F.struct("i", "k").alias("seq"), along("x"), along("y"))
    return out.select("line", "seq.i", "seq.k", "x", "y")


def layer_size(layer: Column, levee: float, road: float) -> Column:
    """The target size of a reference layer by its name."""
    name = F.lower(layer)
    return F.when(name.contains("levee") | name.contains("embankment"), levee).otherwise(road)


def with_references(field: DataFrame, lines: DataFrame, grid: Grid, levee: float, road: float, least: float, most: float, step: float, rounds: int = 200, count: bool = False) -> DataFrame:
    """The field lowered along reference lines (line, layer, pts) inside the domain, and smoothed."""
    points = densified(lines, max(grid.spacing * 0.5, 1.0)).join(lines.select("line", "layer"), "line")
    size = F.least(F.greatest(layer_size(F.col("layer"), levee, road), F.lit(least)), F.lit(most))
    wanted = grid.cells(points, "x", "y").select("iy", "ix", size.alias("size"))
    return sizefield.smoothed(sizefield.applied(field, wanted, most, count=count), step, rounds)


def initial(spark, grid: Grid, least: float, most: float, step: float, interface: DataFrame | None = None, interface_floor: float = 0.0, interface_reach: float = 0.0, lines: DataFrame | None = None, line_floor: float = 0.0, rounds: int = 200) -> DataFrame:
    """A new field of the largest size, with raised floors along interface points (x, y) and lines (line, pts)."""
    field = sizefield.uniform(spark, grid.nx, grid.ny, most, least)
    if interface is not None:
        field = sizefield.raised_floor(field, grid.cells(interface, "x", "y"), interface_floor, int(interface_reach // grid.spacing))
    if lines is not None:
        field = sizefield.raised_floor(field, grid.cells(densified(lines, grid.spacing), "x", "y"), line_floor, int(line_floor // grid.spacing))
    return sizefield.smoothed(field.withColumn("attempts", F.lit(0)), step, rounds)


def marked(q: DataFrame, bad: DataFrame, terrain_bad: DataFrame | None, coarse: DataFrame, least_area: float, band: DataFrame | None = None) -> DataFrame:
    """eid, area, size and whether an element breaks a shape rule other than its area, breaks a terrain rule, is the coarse
    side of a pair (with the target size), is at the area floor, is in the band, and how many terrain rules it breaks."""
    shape = F.greatest(*[F.col(v).cast("int") for v in quality.VIOLATIONS if v != "area_below_min"]) == 1
    t = q.select("eid", "kind", "area", "size").join(bad, "eid").join(coarse.select("eid", "target"), "eid", "left")
    if terrain_bad is not None:
        rules = [F.coalesce(F.col(r), F.lit(False)).cast("int") for r in TERRAIN]
        t = t.join(terrain_bad.withColumnRenamed("face", "eid") if "eid" not in terrain_bad.columns else terrain_bad, "eid", "left").withColumn("terrain", sum(rules[1:], rules[0]))
    else:
        t = t.withColumns({r: F.lit(False) for r in TERRAIN}).withColumn("terrain", F.lit(0))
    t = t.join(band.select("eid", F.lit(True).alias("band")), "eid", "left") if band is not None else t.withColumn("band", F.lit(None).cast("boolean"))
    return t.withColumns({"shape": shape, "coarse": F.col("target").isNotNull(), "floored": F.col("area") <= least_area * AT_FLOOR, "band": F.coalesce("band", F.lit(False))})


def convergence(marks: DataFrame) -> DataFrame:
    """One row: violations of each rule, those blocked by the area floor or the band, what is unresolved, and whether none is."""
    counts = {f"viol_{v}": F.count_if(v) for v in quality.VIOLATIONS} | {f"terrain_viol_{r}": F.count_if(F.coalesce(r, F.lit(False))) for r in TERRAIN} | {"viol_neighbor_ratio": F.count_if("coarse")}
    blocked = F.sum(F.when(F.col("floored"), F.col("terrain")).otherwise(0)) + F.count_if(F.col("coarse") & (F.col("floored") | F.col("band")))
    t = marks.agg(*[v.alias(k) for k, v in counts.items()], blocked.alias("blocked_by_area_floor"))
    every = [F.col(k) for k in counts]
    return t.withColumn("unresolved", sum(every[1:], every[0]) - F.col("blocked_by_area_floor")).withColumn("converged", F.col("unresolved") <= 0)


def unresolvable(marks: DataFrame, field: DataFrame, at: DataFrame, most_attempts: int) -> DataFrame:
    """One row: violating elements at the area floor, out of attempts, and still open; coarse ones at the size floor or in the band.

    at: eid, iy, ix of the element's cell in the size field.
    """
    t = marks.join(sizefield.looked_up(field, at.select("eid", "iy", "ix"), most_attempts).select("eid", "at_floor", "refinable"), "eid")
    bad, out = F.col("shape") | (F.col("terrain") > 0), ~F.col("refinable")
    return t.agg(
        F.count_if(bad & F.col("floored")).alias("unresolvable_area_floor"), F.count_if(bad & ~F.col("floored") & out).alias("unresolvable_refine_limit"), F.count_if(bad & ~F.col("floored") & ~out).alias("resolvable_remaining"),
        F.count_if(F.col("coarse") & F.col("at_floor")).alias("neighbor_ratio_at_size_floor"), F.count_if(F.col("coarse") & F.col("band")).alias("neighbor_ratio_at_band"),
    )


def refinement(marks: DataFrame, field: DataFrame, at: DataFrame, touching: DataFrame, *, least_area: float, factor: float, most_attempts: int, least: float, most: float, step: float, rounds: int = 200) -> tuple[DataFrame, DataFrame]:
    """(the next field, one row with n_refined and n_coarsened).

    Elements that break a rule and aren't at the floor ask for factor times their size where their cell may still be
    refined; coarse sides of pairs ask for at most that and lower the cell's floor first. Undersized elements off the
    boundary ask for a larger size. Then sizes are smoothed.
    """
    t = marks.join(at.select("eid", "iy", "ix"), "eid")
    open_ = sizefield.looked_up(field, t.where((F.col("shape") | (F.col("terrain") > 0)) & ~F.col("floored")).select("eid", "iy", "ix", "size"), most_attempts).where("refinable").select("eid", "iy", "ix", (F.col("size") * factor).alias("size"))
    balance = t.where(F.col("coarse") & ~F.col("floored") & ~F.col("band")).select("eid", "iy", "ix", F.least("target", F.col("size") * factor).alias("size"))
    lowered = sizefield.lowered_floor(field, balance, least)
    wanted = open_.unionByName(balance).groupBy("eid", "iy", "ix").agg(F.min("size").alias("size"))
    smaller = sizefield.applied(lowered, wanted, most)
    grow = t.where(F.col("area") < least_area).join(touching.select("eid"), "eid", "left_anti").select("eid", "iy", "ix", F.greatest(F.col("size") / factor, F.lit(math.sqrt(4 * least_area / math.sqrt(3)))).alias("size"))
    larger = sizefield.applied(smaller, grow, most, larger=True)
    clamped = larger.withColumn("value", F.least(F.greatest("value", "floor"), F.lit(most)))
    counts = wanted.agg(F.count("*").alias("n_refined")).crossJoin(grow.agg(F.count("*").alias("n_coarsened")))
    return sizefield.smoothed(clamped, step, rounds), counts


def stalled(log: DataFrame, least_gain: float = 0.02) -> DataFrame:
    """log (iteration, measure) with stalled: whether the measure is not at least that share below the step before."""
    from pyspark.sql import Window

    before = F.lag("measure").over(Window.orderBy("iteration"))  # a row for each step of one run
    return log.withColumn("stalled", F.coalesce(F.col("measure") >= before * (1 - least_gain), F.lit(False)))


def view_cells(field: DataFrame, grid: Grid) -> DataFrame:
    """x0, x1, y0, y1 and the four corner values v00, v10, v11, v01 of every cell between grid points."""
    steps = (("v00", 0, 0), ("v10", 0, 1), ("v11", 1, 1), ("v01", 1, 0))
    sent = field.select(F.explode(F.array(*[F.struct((F.col("iy") - dy).alias("iy"), (F.col("ix") - dx).alias("ix"), F.lit(n).alias("c"), F.col("value").alias("v")) for n, dy, dx in steps])).alias("s")).select("s.*")
    whole = sent.groupBy("iy", "ix").agg(*[F.max(F.when(F.col("c") == n, F.col("v"))).alias(n) for n, _, _ in steps]).where(" and ".join(f"{n} is not null" for n, _, _ in steps))
    x, y = grid.x0 + F.col("ix") * grid.spacing, grid.y0 + F.col("iy") * grid.spacing
    return whole.select(x.alias("x0"), (x + grid.spacing).alias("x1"), y.alias("y0"), (y + grid.spacing).alias("y1"), *[n for n, _, _ in steps])


def step_row(iteration: int, summary: DataFrame, counts: DataFrame, converged: DataFrame, marks: DataFrame) -> DataFrame:
    """One log row of a refinement step."""
    floor = marks.agg(F.count_if("floored").alias("n_at_area_floor"))
    head = summary.select("n_elements", "n_triangles", "n_quads", "area_min").crossJoin(counts).crossJoin(floor)
    return head.crossJoin(converged.drop("unresolved", "converged")).select(F.lit(iteration).alias("iteration"), "*")
