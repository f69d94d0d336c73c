"""Whole domains from blocks: meshes side by side, summaries over blocks, the report's lines, several meshes compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import quality, terrain

# Up to these shares of violating elements a report calls shapes good or fair, and the ground nearly or partly met.
GOOD_SHAPE, FAIR_SHAPE, GOOD_GROUND, FAIR_GROUND = 0.01, 0.05, 0.05, 0.5


def side_by_side(elem: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One mesh of blocks' meshes: (elements, nodes) numbered on over the blocks, whose nodes stay apart.

    elem: block (from 0), eid, n0..n3, more; nodes: block, id, x, y, more. Numbers within a block are dense from 0.
    """
    def shifts(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy("block").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))  # a row for each block
        return F.broadcast(n.select("block", F.coalesce(before, F.lit(0)).alias(name)))

    e = elem.join(shifts(elem, "e__"), "block").join(shifts(nodes, "n__"), "block")
    corners = {f"n{i}": F.col(f"n{i}") + F.col("n__") for i in range(4)}
    out = e.withColumns({"eid": F.col("eid") + F.col("e__"), **corners}).withColumn("block", (F.col("block") + 1).cast("int")).drop("e__", "n__")
    return out, nodes.join(shifts(nodes, "n__"), "block").withColumn("id", F.col("id") + F.col("n__")).withColumn("block", (F.col("block") + 1).cast("int")).drop("n__")


SUMS = ("n_elements", "n_triangles", "n_quads", "area_total_km2", "viol_area_below_min", "viol_any", "terrain_viol_any", "band_quad_count", "viol_neighbor_ratio")


def over_blocks(summaries: DataFrame) -> DataFrame:
    """One row over blocks' summaries: sums, extremes, area-weighted means, the lower area-weighted median of medians."""
    have = set(summaries.columns)
    some = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in have else F.lit(0)
    w = Window.orderBy("area_median").rowsBetween(Window.unboundedPreceding, 0)  # a row for each block
    ranked = summaries.withColumn("upto__", F.sum("area_total_km2").over(w)).withColumn("all__", F.sum("area_total_km2").over(Window.partitionBy(F.lit(0))))
    mean = lambda c: F.when(F.sum("area_total_km2") > 0, F.sum(some(c) * F.col("area_total_km2")) / F.sum("area_total_km2")).otherwise(0.0)
    t = ranked.agg(
        *[F.sum(some(c)).alias(c) for c in SUMS], F.min("area_min").alias("area_min"), F.max("area_max").alias("area_max"),
        F.min(F.when(F.col("upto__") >= F.col("all__") / 2, F.col("area_median"))).alias("area_median"),
        mean("rmse_area_weighted").alias("rmse_area_weighted"), mean("spread_area_weighted").alias("spread_area_weighted"), F.max(some("n_iterations")).alias("n_iterations"),
    )
    n = F.greatest(F.col("n_elements"), F.lit(1))
    return t.withColumns({"viol_any_ratio": F.col("viol_any") / n, "terrain_viol_any_ratio": F.col("terrain_viol_any") / n})


def mesh_summary(elem: DataFrame, nodes: DataFrame, shape: quality.Limits, samples: DataFrame | None = None, gradients: DataFrame | None = None, ground: terrain.Limits = terrain.Limits(), by: str | None = None) -> DataFrame:
    """One row (or one for each value of a column of elem): shape, neighbours and, with samples (eid, dx, dy, z), the ground."""
    from tessera.operators import topology

    half, q, bad = quality.mesh(elem, nodes, shape)
    any_rule = F.greatest(*[F.col(n).cast("int") for n in quality.VIOLATIONS])
    ratios = quality.size_ratios(topology.adjacency(half), q)
    coarse = quality.ratio_targets(ratios, shape.neighbour_ratio)
    worst = ratios.groupBy(F.col("big").alias("eid")).agg(F.max("ratio").alias("ratio"))
    t = q.select("eid", "kind", "area").join(bad, "eid").join(coarse.select("eid", "target"), "eid", "left").join(worst, "eid", "left")
    keys = [by] if by else []
    if by:
        t = t.join(elem.select("eid", by), "eid")
    t = t.withColumn("any__", any_rule)
    more = []
    if samples is not None:
        fit = terrain.plane_fit(samples, "eid")
        spread = terrain.slope_spread(gradients, ground.flat_slope, "eid") if gradients is not None else fit.select("eid", F.lit(0.0).alias("spread"))
        wrong = terrain.violations(fit, spread, ground, "eid")
        t = t.join(fit.select("eid", "rmse").join(spread, "eid").join(wrong, "eid"), "eid", "left")
        more = [(F.sum(F.col("rmse") * F.col("area")) / F.sum("area")).alias("rmse_area_weighted"), (F.sum(F.col("spread") * F.col("area")) / F.sum("area")).alias("spread_area_weighted"), F.count_if(F.col("bad_rmse") | F.col("bad_spread") | F.col("bad_samples")).alias("terrain_viol_any")]
    return t.groupBy(*keys).agg(
        F.count("*").alias("n_elements"), F.count_if(F.col("kind") == 3).alias("n_triangles"), F.count_if(F.col("kind") == 4).alias("n_quads"), F.min("area").alias("area_min"), F.median("area").alias("area_median"),
        F.max("area").alias("area_max"), (F.sum("area") / 1e6).alias("area_total_km2"), F.count_if("area_below_min").alias("viol_area_below_min"), F.sum("any__").alias("viol_any"), F.avg("any__").alias("viol_any_ratio"),
        F.count("target").alias("viol_neighbor_ratio"), F.max("ratio").alias("neighbor_ratio_max"), *more,
    )


def report_lines(s: dict, shape: quality.Limits, ground: terrain.Limits) -> list[str]:
    """The lines that a run ends with; nothing for a mesh without elements."""
    n = int(s.get("n_elements") or 0)
    if n <= 0:
        return []
    ok = lambda good, text="check": "OK" if good else text
    share = s["viol_any_ratio"] if s.get("viol_any_ratio") is not None else s.get("viol_any", 0) / n
    out = [f"elements: {n:,} ({int(s.get('n_triangles', 0)):,} triangles, {int(s.get('n_quads', 0)):,} quads)"]
    if s.get("area_total_km2") is not None:
        out.append(f"area: {s['area_total_km2']:.3f} km2 ({n / s['area_total_km2'] if s['area_total_km2'] > 0 else 0:,.0f} elements a km2)")
    if s.get("area_min") is not None:
        out.append(f"element area: {s['area_min']:.0f} to {s['area_max']:.0f} m2, median {s.get('area_median', float('nan')):.0f}")
    small = int(s.get("viol_area_below_min") or 0)
    out.append(f"below {shape.min_area:.0f} m2: {small}, {ok(small == 0)}")
    out.append(f"shape: {int(s.get('viol_any') or 0)} ({100 * share:.2f} %), {ok(share < GOOD_SHAPE)}")
    coarse = int(s.get("viol_neighbor_ratio") or 0)
    worst = f", largest {s['neighbor_ratio_max']:.2f}" if s.get("neighbor_ratio_max") is not None else ""
    out.append(f"neighbour ratio over {shape.neighbour_ratio:.1f}: {coarse}{worst}, {ok(coarse == 0)}")
    if s.get("band_quad_count") is not None:
        out.append(f"boundary quads: {int(s['band_quad_count']):,}")
    rmse, spread, tv = s.get("rmse_area_weighted"), s.get("spread_area_weighted"), s.get("terrain_viol_any")
    if rmse is not None:
        out.append(f"plane fit: {rmse:.3f} m by area, limit {ground.rmse_max}, {ok(rmse <= ground.rmse_max)}")
    if spread is not None:
        out.append(f"slope direction: {spread:.1f} degrees by area, limit {ground.spread_max}, {ok(spread <= ground.spread_max)}")
    part = None if tv is None else s.get("terrain_viol_any_ratio", tv / n)
    if tv is not None:
        out.append(f"ground rules: {int(tv):,} elements ({100 * part:.1f} %)")
    if s.get("n_iterations") is not None:
        out.append(f"iterations: {int(s['n_iterations'])}")
    verdict = ["no element is too small" if small == 0 else "some elements are too small", "shapes are good" if share < GOOD_SHAPE else "shapes are fair" if share < FAIR_SHAPE else "shapes need a look"]
    if rmse is not None:
        verdict.append("heights are within the limit" if rmse <= ground.rmse_max else "heights are beyond the limit")
    if part is not None:
        verdict.append("the ground is nearly met everywhere" if part < GOOD_GROUND else "the ground is partly met" if part < FAIR_GROUND else "the ground is mostly not met")
    return [*out, "in all: " + "; ".join(verdict)]


def bank_lines(sections: DataFrame, gap: float, least: int = 3) -> DataFrame:
    """river, part, bank, pts: both banks' lines through cross-sections (river, kp, lx, ly, rx, ry), cut at gaps in kp.

    A line needs ``least`` places; sections without a finite place are left out of their bank's line.
    """
    from tessera.operators import special

    t = special.sessions(sections, "river", "kp", gap)
    sides = F.array(*[F.struct(F.lit(b).alias("bank"), F.col(x).alias("x"), F.col(y).alias("y")) for b, x, y in (("left", "lx", "ly"), ("right", "rx", "ry"))])
    flat = t.select("river", "part", "kp", F.explode(sides).alias("s")).select("river", "part", "kp", "s.bank", "s.x", "s.y")
    known = flat.where("x is not null and y is not null and not isnan(x) and not isnan(y) and abs(x) < double('inf') and abs(y) < double('inf')")
    pts = F.transform(F.array_sort(F.collect_list(F.struct("kp", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return known.groupBy("river", "part", "bank").agg(pts.alias("pts")).where(F.size("pts") >= least)


def compared(meshes: dict[str, DataFrame]) -> DataFrame:
    """Summaries of several meshes in one table, by name."""
    out = None
    for name, row in meshes.items():
        named = row.select(F.lit(name).alias("mesh"), "*")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out
