"""Mesh repair as tables: splitting quads, scoring and choosing merges. What rewrites a mesh step by step is in patch.py.

Scoring is relational; choosing which candidates to apply is greedy and order-dependent, so it runs in kernels that hold
whole groups of linked candidates.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import cut, partitions, ship, spread
from tessera.functions import geometry as g
from tessera.components import connected_components
from tessera.operators import topology
from tessera.operators.quality import Limits


def split_quads(geom: DataFrame, elem: DataFrame, least_area: float) -> DataFrame:
    """Two triangles for each quad, along the diagonal with the larger smallest area: eid, part, n0, n1, n2, area.

    Quads whose better diagonal leaves a triangle under least_area are refused. Equal diagonals give n0-n2.
    """
    p = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
    area = lambda i, j, k: g.signed_area([p[i], p[j], p[k]])
    one, two = F.least(area(0, 1, 2), area(0, 2, 3)), F.least(area(0, 1, 3), area(1, 2, 3))
    t = elem.where("kind = 4").join(geom.drop("kind"), "eid").withColumns({"one": one, "two": two}).where(F.greatest("one", "two") >= least_area)
    piece = lambda part, i, j, k: F.struct(F.lit(part).alias("part"), F.col(f"n{i}").alias("n0"), F.col(f"n{j}").alias("n1"), F.col(f"n{k}").alias("n2"), area(i, j, k).alias("area"))
    pieces = F.when(F.col("one") >= F.col("two"), F.array(piece(0, 0, 1, 2), piece(1, 0, 2, 3))).otherwise(F.array(piece(0, 0, 1, 3), piece(1, 1, 2, 3)))
    return t.select("eid", F.explode(pieces).alias("s")).select("eid", "s.*")


def merge_candidates(elem: DataFrame, half: DataFrame, geom: DataFrame, constrained: DataFrame, rules: Limits, relaxed: bool = False) -> DataFrame:
    """Pairs of triangles that would make a good quad: small, other, small_area, area, jacobian, q0..q3 counter-clockwise.

    small is under the least area and doesn't touch the boundary, and other shares an unconstrained side (lo, hi not in
    constrained). The quad must be convex and large enough and, unless relaxed, keep the rules of quads' shape.
    """
    tri = geom.where("kind = 3").withColumn("area", F.abs(g.signed_area([(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(3)]))).select("eid", "area")
    ids = elem.where("kind = 3").select("eid", "n0", "n1", "n2")
    sides = topology.neighbours(half).where("neighbour >= 0").withColumns({"lo": F.least("na", "nb"), "hi": F.greatest("na", "nb")}).join(spread(constrained.select("lo", "hi")), ["lo", "hi"], "left_anti")
    inner = tri.where(F.col("area") < rules.min_area).join(spread(topology.boundary_touching(half).select("eid")), "eid", "left_anti")
    small = sides.join(spread(inner), "eid").join(spread(ids), "eid")
    off = lambda c: (F.col(c) != F.col("na")) & (F.col(c) != F.col("nb"))
    apex = F.when(off("m0"), F.col("m0")).when(off("m1"), F.col("m1")).otherwise(F.col("m2"))
    across = ids.select(F.col("eid").alias("neighbour"), F.col("n0").alias("m0"), F.col("n1").alias("m1"), F.col("n2").alias("m2"))
    mine = F.when(F.col("k") == 0, F.col("n2")).when(F.col("k") == 1, F.col("n0")).otherwise(F.col("n1"))
    quads = small.join(spread(across), "neighbour").select(F.col("eid").alias("small"), F.col("neighbour").alias("other"), F.col("area").alias("small_area"), mine.alias("q0"), F.col("na").alias("q1"), apex.alias("q2"), F.col("nb").alias("q3"))
    at = elem.select("eid", F.posexplode(F.array("n0", "n1", "n2")).alias("i", "id")).join(spread(geom), "eid")
    pick = lambda a: F.when(F.col("i") == 0, F.col(f"{a}0")).when(F.col("i") == 1, F.col(f"{a}1")).otherwise(F.col(f"{a}2")).alias(a)
    place = at.select("id", pick("x"), pick("y")).dropDuplicates(["id"])
    for i in range(4):
        quads = quads.join(spread(place.select(F.col("id").alias(f"q{i}"), F.col("x").alias(f"x{i}"), F.col("y").alias(f"y{i}"))), f"q{i}")
    ring = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
    sizes, angles = g.side_lengths(ring), g.interior_angles(ring)
    t = quads.withColumns({"jacobian": F.least(*g.corner_jacobians(ring)), "area": g.signed_area(ring), "aspect": F.greatest(*sizes) / F.least(*sizes), "low": F.least(*angles), "high": F.greatest(*angles)})
    good = (F.col("jacobian") > 0) & (F.col("area") >= rules.min_area)
    if not relaxed:
        good = good & (F.col("aspect") <= rules.quad_aspect) & (F.col("low") >= rules.quad_min_angle) & (F.col("high") <= rules.quad_max_angle) & (F.col("jacobian") >= rules.quad_jacobian)
    return t.where(good).select("small", "other", "small_area", "area", "jacobian", "q0", "q1", "q2", "q3")


def greedy_merges(candidates: DataFrame, *, per_task: int = 20_000) -> DataFrame:
    """The candidates applied: smallest triangle first, each with its best free partner (largest jacobian, then number).

    block is the smallest number among the triangles that candidates link to a pair's own. Choices in one block don't
    touch another, so kernels of about ``per_task`` pairs in whole blocks give what one pass over the whole mesh would.
    """
    ship(candidates.sparkSession)
    held = cut(candidates)
    both = held.join(spread(connected_components(held, "small", "other").select(F.col("id").alias("small"), F.col("component").alias("block"))), "small")
    tasks = max(partitions(held.sparkSession), held.count() // per_task)
    both = both.select("other", "small", *[c for c in both.columns if c not in ("other", "small")])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["small_area", "small", "jacobian", "other"], ascending=[True, True, False, True], ignore_index=True)
        used: set[int] = set()
        keep = []
        for i, (a, b) in enumerate(zip(pdf["small"], pdf["other"], strict=True)):
            if a not in used and b not in used:
                used |= {a, b}
                keep.append(i)
        return pdf.iloc[keep]

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema)
    return both.groupBy(F.pmod(F.xxhash64("block"), F.lit(tasks))).applyInPandas(run, fields)
