"""Element shape: areas, angles, aspect, Jacobians, size, violations, neighbour ratios and their summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import spread
from tessera.functions import geometry as g
from tessera.operators import topology



@dataclass(frozen=True)
class Limits:
    min_area: float = 900.0
    triangle_min_angle: float = 25.0
    triangle_radius_ratio: float = 0.5
    triangle_aspect: float = 2.0
    quad_min_angle: float = 60.0
    quad_max_angle: float = 120.0
    quad_aspect: float = 2.0
    quad_jacobian: float = 0.85
    neighbour_ratio: float = 1.3


def corners(elem: DataFrame, nodes: DataFrame) -> DataFrame:
    """Elements with x0, y0 .. x3, y3 beside their node ids. One shuffle by node, one by element."""
    long = elem.select("eid", "kind", F.posexplode(F.array("n0", "n1", "n2", "n3")).alias("k", "id")).where("id is not null")
    placed = long.join(spread(nodes.select("id", "x", "y")), "id")
    pick = [F.max(F.when(F.col("k") == i, F.col(a))).alias(f"{a}{i}") for i in range(4) for a in ("x", "y")]
    return placed.groupBy("eid", "kind").agg(*pick)


def ring(n: int) -> list[g.Point]:
    return [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(n)]


def either(three, four):
    return F.when(F.col("kind") == 3, three).otherwise(four)


def centroids(geom: DataFrame) -> DataFrame:
    """eid, cx, cy: the mean of an element's vertices."""
    mean = lambda a, n: sum((F.col(f"{a}{i}") for i in range(1, n)), F.col(f"{a}0")) / n
    return geom.select("eid", either(mean("x", 3), mean("x", 4)).alias("cx"), either(mean("y", 3), mean("y", 4)).alias("cy"))


def oriented(elem: DataFrame, geom: DataFrame) -> DataFrame:
    """Elements with their nodes reversed where they run clockwise."""
    area = either(g.signed_area(ring(3)), g.signed_area(ring(4)))
    turned = geom.select("eid", (area < 0).alias("turn"))
    back = {f"n{i}": F.when(F.col("turn"), either(F.col(f"n{2 - i}") if i < 3 else F.lit(None), F.col(f"n{3 - i}"))).otherwise(F.col(f"n{i}")) for i in range(4)}
    return elem.join(turned, "eid").select("eid", "kind", *[x.cast("long").alias(k) for k, x in back.items()])


def quality(geom: DataFrame) -> DataFrame:
    """eid, kind, area, min_angle, max_angle, aspect, radius_ratio, scaled_jacobian, convex, size.

    radius_ratio is null for quads, scaled_jacobian for triangles; an aspect without bound is infinite.
    """
    t, q = ring(3), ring(4)
    area3, area4 = F.abs(g.signed_area(t)), F.abs(g.signed_area(q))
    a, b, e = g.side_lengths(t)
    half, product = (a + b + e) / 2, a * b * e
    infinite = F.lit(float("inf"))
    ratio = F.when(half * product > 0, 8 * area3 * area3 / (half * product)).otherwise(0.0)
    aspect3 = F.when((area3 > 0) & (half > 0), product / (4 * area3) / (2 * area3 / half)).otherwise(infinite)
    sides = g.side_lengths(q)
    aspect4 = F.when(F.least(*sides) > 0, F.greatest(*sides) / F.least(*sides)).otherwise(infinite)
    jacobian = F.least(*g.corner_jacobians(q))
    angles3, angles4 = g.interior_angles(t), g.interior_angles(q)
    out = geom.select(
        "eid", "kind", either(area3, area4).alias("area"),
        either(F.least(*angles3), F.least(*angles4)).alias("min_angle"), either(F.greatest(*angles3), F.greatest(*angles4)).alias("max_angle"),
        either(aspect3, aspect4).alias("aspect"), F.when(F.col("kind") == 3, ratio).alias("radius_ratio"),
        F.when(F.col("kind") == 4, jacobian).alias("scaled_jacobian"), either(F.lit(True), jacobian > 0).alias("convex"),
    )
    return out.withColumn("size", either(F.sqrt(4 * F.col("area") / F.sqrt(F.lit(3.0))), F.sqrt("area")))


VIOLATIONS = ("area_below_min", "tri_min_angle", "tri_radius_ratio", "tri_aspect", "quad_nonconvex", "quad_min_angle", "quad_max_angle", "quad_aspect", "quad_jacobian")


def violations(q: DataFrame, touching: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """eid and a boolean for each rule. Elements that touch the boundary may be smaller than min_area."""
    spared = touching.select("eid", F.lit(True).alias("spared"))
    tri, quad = F.col("kind") == 3, F.col("kind") == 4
    rules = (
        (F.col("area") < limits.min_area) & F.col("spared").isNull(), tri & (F.col("min_angle") < limits.triangle_min_angle), tri & (F.col("radius_ratio") < limits.triangle_radius_ratio),
        tri & (F.col("aspect") > limits.triangle_aspect), quad & ~F.col("convex"), quad & (F.col("min_angle") < limits.quad_min_angle), quad & (F.col("max_angle") > limits.quad_max_angle),
        quad & (F.col("aspect") > limits.quad_aspect), quad & (F.col("scaled_jacobian") < limits.quad_jacobian),
    )
    return q.join(spared, "eid", "left").select("eid", *[F.coalesce(r, F.lit(False)).alias(n) for r, n in zip(rules, VIOLATIONS, strict=True)])


def summary(q: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: counts by kind, areas, violations of each rule and of any."""
    any_rule = F.greatest(*[F.col(n).cast("int") for n in VIOLATIONS])
    both = q.select("eid", "kind", "area").join(bad, "eid")
    return both.agg(
        F.count("*").alias("n_elements"), F.count_if(F.col("kind") == 3).alias("n_triangles"), F.count_if(F.col("kind") == 4).alias("n_quads"),
        F.min("area").alias("area_min"), F.median("area").alias("area_median"), F.max("area").alias("area_max"), (F.sum("area") / 1e6).alias("area_total_km2"),
        *[F.count_if(F.col(n)).alias(f"viol_{n}") for n in VIOLATIONS], F.sum(any_rule).alias("viol_any"), F.avg(any_rule.cast("double")).alias("viol_any_ratio"),
    )


def size_ratios(pairs: DataFrame, q: DataFrame) -> DataFrame:
    """big, small, s_big, s_small, ratio of each adjacent pair, compared by size; of equal sizes e0 is the big one."""
    one = q.select(F.col("eid").alias("e0"), F.col("size").alias("s0"))
    two = q.select(F.col("eid").alias("e1"), F.col("size").alias("s1"))
    both = pairs.join(one, "e0").join(two, "e1")
    first = F.col("s0") >= F.col("s1")
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    out = both.select(pick("e0", "e1").alias("big"), pick("e1", "e0").alias("small"), F.greatest("s0", "s1").alias("s_big"), F.least("s0", "s1").alias("s_small"))
    return out.withColumn("ratio", F.col("s_big") / F.greatest("s_small", F.lit(1e-12)))


def ratio_stats(ratios: DataFrame, limit: float) -> DataFrame:
    return ratios.agg(F.count("*").alias("pairs"), F.median("ratio").alias("ratio_median"), F.percentile("ratio", 0.99).alias("ratio_p99"), F.max("ratio").alias("ratio_max"), F.count_if(F.col("ratio") > limit).alias("over"))


def ratio_targets(ratios: DataFrame, limit: float) -> DataFrame:
    """eid, target: coarse sides of pairs over the limit and the size that settles the strictest of them."""
    return ratios.where(F.col("ratio") > limit).groupBy(F.col("big").alias("eid")).agg(F.min(F.col("s_small") * limit).alias("target"))


def level_histogram(q: DataFrame, pairs: DataFrame, base: float) -> DataFrame:
    """difference, pairs: levels are floor(log2(size / base)); how far neighbours are apart."""
    level = q.select("eid", F.floor(F.log2(F.col("size") / base)).alias("level"))
    both = pairs.join(level.select(F.col("eid").alias("e0"), F.col("level").alias("l0")), "e0").join(level.select(F.col("eid").alias("e1"), F.col("level").alias("l1")), "e1")
    return both.groupBy(F.abs(F.col("l0") - F.col("l1")).alias("difference")).agg(F.count("*").alias("pairs"))


def mesh(elem: DataFrame, nodes: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(half-edges, quality, violations) of a mesh."""
    half = topology.half_edges(elem)
    q = quality(corners(elem, nodes))
    return half, q, violations(q, topology.boundary_touching(half), limits)
