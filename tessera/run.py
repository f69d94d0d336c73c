"""Runs: a domain meshed, repaired, measured, refined until its rules hold, and exported; blocks side by side.

A mesher is any function (domain, field, grid) -> (elements, nodes, constrained sides) over all blocks at once; the one
here lays a regular grid of triangles. The block (a polygon's number) is a column, so blocks run in parallel as rows do.
"""

from __future__ import annotations

import argparse
import json
import math
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.cluster import cut
from tessera.operators import blocks, dem, export, lines, ordering, patch, quality, refine, tables, terrain, topology
from tessera.settings import Settings, load
from tessera.sources import container, csvs, layers

Mesher = Callable[[DataFrame, DataFrame, refine.Grid], tuple[DataFrame, DataFrame, DataFrame]]


@contextmanager
def stage(name: str, log: Callable[[str], None] = print) -> Iterator[None]:
    """Logs how long a stage took."""
    began = time.perf_counter()
    yield
    log(f"{name}: {time.perf_counter() - began:.1f} s")


def regular(size: float) -> Mesher:
    """A mesher of right triangles: the cells of a grid of ``size`` whose centre a polygon holds, cut in two."""

    def mesh(domain: DataFrame, field_: DataFrame, grid: refine.Grid) -> tuple[DataFrame, DataFrame, DataFrame]:
        side = domain.select(F.col("polygon").alias("block"), F.explode(F.concat(F.array("ring"), F.col("holes"))).alias("r"))
        n = F.size("r")
        side = side.select("block", F.explode(F.zip_with("r", F.concat(F.slice("r", 2, n - 1), F.slice("r", 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))).alias("s")).select("block", F.col("s.p.x").alias("px"), F.col("s.p.y").alias("py"), F.col("s.q.x").alias("qx"), F.col("s.q.y").alias("qy"))
        # a row of centres meets each side once; inside is between odd and even crossings
        low, high = F.least("py", "qy"), F.greatest("py", "qy")
        row = F.explode(F.sequence(F.ceil(low / size - 0.5).cast("long"), F.floor(high / size - 0.5).cast("long")))
        at = side.where((F.col("py") != F.col("qy")) & (F.ceil(low / size - 0.5) <= F.floor(high / size - 0.5))).withColumn("r", row).withColumn("cy", (F.col("r") + 0.5) * size)
        met = at.where(((F.col("py") > F.col("cy")) != (F.col("qy") > F.col("cy")))).withColumn("x", F.col("px") + (F.col("cy") - F.col("py")) * (F.col("qx") - F.col("px")) / (F.col("qy") - F.col("py")))
        spans = met.groupBy("block", "r").agg(F.array_sort(F.collect_list("x")).alias("xs"))
        pair = spans.select("block", "r", F.posexplode("xs").alias("k", "x0"), "xs").where("k % 2 = 0").withColumn("x1", F.expr("get(xs, k + 1)")).where("x1 is not null")
        first, last = F.ceil(F.col("x0") / size - 0.5).cast("long"), (F.ceil(F.col("x1") / size - 0.5) - 1).cast("long")
        cells = pair.where(first <= last).select("block", "r", F.explode(F.sequence(first, last)).alias("c"))
        # corners are told by row and column until they are numbered, within their block and from 0
        corner = lambda dr, dc: F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c"))
        tri = F.array(*[F.struct(F.lit(k).alias("k"), a.alias("a"), b.alias("b"), c.alias("c")) for k, a, b, c in ((0, corner(0, 0), corner(0, 1), corner(1, 1)), (1, corner(0, 0), corner(1, 1), corner(1, 0)))])
        t = cells.select("block", "r", "c", F.explode(tri).alias("t")).select("block", F.col("r").alias("row"), F.col("c").alias("col"), "t.k", "t.a", "t.b", F.col("t.c").alias("d"))
        t = layers.numbered(t, ["row", "col", "k"], "eid")
        points = t.select("block", F.explode(F.array("a", "b", "d")).alias("p")).distinct().select("block", "p.r", "p.c", "p")
        points = cut(layers.numbered(points, ["r", "c"], "id"))
        for i, name in enumerate(("a", "b", "d")):
            t = t.join(points.select("block", F.col("p").alias(name), F.col("id").cast("long").alias(f"n{i}")), ["block", name])
        elem = t.select("block", F.col("eid").cast("long").alias("eid"), F.lit(0).alias("surface"), "n0", "n1", "n2", F.lit(None).cast("long").alias("n3"))
        nodes = points.select("block", F.col("id").cast("long").alias("id"), (F.col("c") * size).alias("x"), (F.col("r") * size).alias("y"))
        return cut(elem), nodes, t.sparkSession.createDataFrame([], "block long, lo long, hi long")

    return mesh


@dataclass
class Result:
    """A finished mesh with its tables and log."""

    elem: DataFrame
    nodes: DataFrame
    quality: DataFrame
    fit: DataFrame | None
    spread: DataFrame | None
    log: list[dict] = field(default_factory=list)
    summary: dict = field(default_factory=dict)


def measured(s: Settings, elem: DataFrame, nodes: DataFrame, pixels: DataFrame | None, grid: dem.Raster | None, cell: float) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """(quality, violations, plane fits, spreads, ground violations) of one mesh."""
    _, q, bad = quality.mesh(elem, nodes, s.shape())
    if pixels is None or grid is None:
        return q, bad, None, None, None
    geom = quality.corners(elem, nodes)
    samples = cut(dem.terrain_samples(pixels, grid, geom, quality.centroids(geom), cell))
    fit = terrain.plane_fit(samples, "eid")
    slope = dem.labelled(dem.gradients(pixels, grid), grid, geom, cell).select("eid", "gx", "gy")
    spread = terrain.slope_spread(slope, s.ground().flat_slope, "eid")
    return q, bad, fit, spread, terrain.violations(fit, spread, s.ground(), "eid")


def iterate(s: Settings, domain: DataFrame, mesher: Mesher, pixels: DataFrame | None = None, grid: dem.Raster | None = None, references: DataFrame | None = None, log: Callable[[str], None] = print) -> Result:
    """Meshes, repairs and measures; refines the size field and goes on until rules hold, nothing changes, two steps
    after the third gain less than two hundredths, or the steps run out."""
    m = s["mesh"]
    spark = domain.sparkSession
    box = refine.bounds(domain.select(F.explode("ring").alias("p")).select("p.x", "p.y")).collect()[0]
    field_grid = refine.Grid.around(box.xlo, box.ylo, box.xhi, box.yhi, m["size_field_grid"], 4 * m["size_field_grid"])
    step = (m["max_neighbor_size_ratio"] - 1) * m["size_field_grid"]
    size = refine.initial(spark, field_grid, m["global_min_size"], m["global_max_size"], step)
    steps: list[dict] = []
    before, stall = None, 0
    cell = 2 * m["global_max_size"]
    while True:
        i = len(steps) + 1
        elem, nodes, marked = mesher(domain, size, field_grid)
        elem, nodes, _, _ = patch.repaired(elem, nodes, marked, s.shape(), triangles_only=m["triangles_only"])
        elem, nodes = joined(elem, nodes)
        q, bad, fit, spread, wrong = measured(s, elem, nodes, pixels, grid, cell)
        half = topology.half_edges(elem)
        coarse = quality.ratio_targets(quality.size_ratios(topology.adjacency(half), q), s.shape().neighbour_ratio)
        marks = cut(refine.marked(q, bad, wrong, coarse, m["min_element_area"]))
        verdict = refine.convergence(marks).collect()[0]
        measure = tuple(q.select("eid", "area").join(t, "eid").agg(F.sum(F.col(c) * F.col("area")) / F.sum("area")).collect()[0][0] or 0.0 for t, c in ((fit, "rmse"), (spread, "spread"))) if fit is not None else None
        stall = stall + 1 if measure and before and all(a >= 0.98 * b for a, b in zip(measure, before, strict=True)) else 0
        before = measure
        counts = {"n_refined": 0, "n_coarsened": 0}
        last = verdict.converged or i >= m["max_iterations"]
        if not last:
            centres = field_grid.cells(quality.centroids(quality.corners(elem, nodes)), "cx", "cy").select("eid", "iy", "ix")
            size, n = refine.refinement(marks, size, centres, topology.boundary_touching(half), least_area=m["min_element_area"], factor=m["refinement_factor"], most_attempts=m["max_refine_attempts"], least=m["global_min_size"], most=m["global_max_size"], step=step)
            counts = n.collect()[0].asDict()
            if references is not None:
                size = refine.with_references(size, references, field_grid, m["levee_target_size"], m["road_target_size"], m["global_min_size"], m["global_max_size"], step)
            size = cut(size)
        steps.append({"iteration": i, **quality.summary(q, bad).select("n_elements", "n_triangles", "n_quads", "area_min").collect()[0].asDict(), **counts, **verdict.asDict()})
        log(json.dumps(steps[-1]))
        if last or not (counts["n_refined"] or counts["n_coarsened"]) or (stall >= 2 and i >= 3):
            break
    row = quality.summary(q, bad).join(quality.ratio_stats(quality.size_ratios(topology.adjacency(half), q), s.shape().neighbour_ratio)).collect()[0].asDict()
    if measure:
        row |= {"rmse_area_weighted": measure[0], "spread_area_weighted": measure[1]}
    return Result(elem, nodes, q, fit, spread, steps, row | {"n_iterations": len(steps), "viol_neighbor_ratio": verdict.viol_neighbor_ratio, "neighbor_ratio_max": row["ratio_max"]})


def joined(elem: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired blocks as one mesh with dense numbers from 0: triangles first within a block, blocks one after the other."""
    cells = topology.dense_ids(elem, ["block", "kind", "eid"], "e")
    place = cut(topology.dense_ids(nodes, ["block", "id"], "n").select("block", "id", (F.col("n") - 1).alias("new"), "x", "y"))
    for i in range(4):
        cells = cells.join(place.select("block", F.col("id").alias(f"n{i}"), F.col("new").alias(f"m{i}")), ["block", f"n{i}"], "left")
    out = cells.select((F.col("e") - 1).alias("eid"), "kind", "surface", (F.col("block") + 1).cast("int").alias("block"), *[F.col(f"m{i}").alias(f"n{i}") for i in range(4)])
    return cut(out), place.select(F.col("new").alias("id"), "x", "y")


def exported(s: Settings, r: Result, folder: str, pixels: DataFrame | None = None, grid: dem.Raster | None = None, attributes: dict[str, DataFrame] | None = None) -> None:
    """All tables of a run below a folder: elements, nodes, connectivity, faces, edges, summary, log and the container."""
    attributes = attributes or {}
    spark = r.elem.sparkSession
    half = topology.half_edges(r.elem)
    centres = quality.centroids(quality.corners(r.elem, r.nodes))
    ids = topology.line_ids(half)
    heights = dem.sampled(r.nodes, pixels, grid).select("id", "z") if pixels is not None and grid is not None else None
    empty = spark.createDataFrame([], "eid long, code int, area double")
    cover = attributes.get("buildings", spark.createDataFrame([], "eid long, ratio double, perimeter double"))
    ground = r.fit.select("eid", F.col("mean_z").alias("elevation")) if r.fit is not None else spark.createDataFrame([], "eid long, elevation double")
    z = export.own_elevation(r.nodes, heights)
    q = r.quality.join(r.elem.select("eid", "block"), "eid")
    csvs.write_csv(export.element_rows(r.quality, centres), f"{folder}/elements.csv")
    csvs.write_csv(export.node_rows(r.nodes.join(z, "id")), f"{folder}/nodes.csv")
    csvs.write_csv(export.connectivity_rows(r.elem), f"{folder}/connectivity.csv")
    csvs.write_csv(export.face_rows(q, centres, ground, cover, attributes.get("land", empty), attributes.get("soil", empty), export.wkt(r.elem, r.nodes)), f"{folder}/{s['output']['gpkg_csv']['face_csv']}")
    csvs.write_csv(export.edge_rows(half, r.nodes, ids, z), f"{folder}/{s['output']['gpkg_csv']['edge_csv']}")
    spark.createDataFrame([(json.dumps(r.summary, default=float),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/summary.json")
    spark.createDataFrame([(json.dumps(x, default=float),) for x in r.log], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/iterations.json")
    faces = tables.face_edges(half, ids).join(q.select("eid", "area", "block"), "eid").join(centres, "eid").join(ground, "eid", "left")
    part = lambda df: df.withColumn("mesh", F.lit(0).cast("long"))
    full = faces.select(F.col("eid").alias("id"), F.lit(0).alias("dummy"), F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("area").alias("A"), F.coalesce(export.finite(F.col("elevation")), F.lit(0.0)).alias("z_bed"), F.size("edge_ids").alias("n_sides"), "edge_ids", "block").withColumn("id", F.col("id") + 1)
    edges = tables.normalised_edges(half, r.nodes.join(z, "id"))
    none = spark.createDataFrame([], "ln long, kind int, fr double")
    froude = tables.boundary_froude(edges, none, none.select("ln"), tables.usual_froude(s["input"]["special_edges"]["default_fr"], s["output"]["default_fr"]))
    edges = edges.join(froude, "ln").withColumnRenamed("ln", "id")
    points = r.nodes.join(z, "id").withColumn("id", F.col("id") + 1)
    files = container.packed(part(edges), part(points), part(full), {k: part(v) for k, v in attributes.items() if k in container.COUNTED})
    container.write(files, folder, s["output"]["cell_bin"]["filename"] or "mesh.bin")


def run(spark: SparkSession, s: Settings, mesher: Mesher | None = None, log: Callable[[str], None] = print) -> Result:
    """The whole run of a settings file: every polygon of the domain is a block."""
    with stage("sources", log):
        found = layers.domain(layers.read_layer(spark, s.resolve(s["input"]["domain"])), s["input"]["domain_min_area"], s["input"]["polygon_filter"])
        domain = cut(layers.oriented(found))
        pixels, grid = dem.read_ascii(spark, s.resolve(s["input"]["dem"]))
        pixels = cut(pixels)
        references = layers.line_layers(spark, {k: s.resolve(v) for k, v in s["input"]["reference_layers"].items()}, optional=True) if s["features"]["reference_layers_for_size_field"] else None
        given = layers.line_layers(spark, {k: s.resolve(v) for k, v in s["input"]["breaklines"].items()})
        if given is not None:
            given = lines.tidied(given.select("line", "layer", F.lit(False).alias("strict"), "pts"), s.spacing(), s.least_length(), s["mesh"]["breakline_processing"]["simplify_tolerance"])
            log(f"breaklines: {given.count()}")
    with stage("mesh", log):
        r = iterate(s, domain, mesher or regular(s["mesh"]["global_min_size"]), pixels, grid, references, log)
    with stage("export", log):
        exported(s, r, s.resolve(s["output"]["directory"]), pixels, grid)
    for line in blocks.report_lines(r.summary, s.shape(), s.ground()):
        log(line)
    return r


def block_workers(asked: int, cpus: int) -> int:
    """How many blocks a single machine runs at once."""
    return max(1, min(asked, cpus - 2, 8))


def least_spacing(area: float) -> float:
    return math.sqrt(4 * area / math.sqrt(3))


def reordered(edges: DataFrame, faces: DataFrame) -> DataFrame:
    """(old, new) face order of small bandwidth over neighbouring faces; edges: face_left, face_right; faces: id."""
    pairs = edges.where("face_right > 0").select(F.col("face_left").alias("e0"), F.col("face_right").alias("e1"))
    part = ordering.components(pairs, faces.select(F.col("id").alias("face")))
    found = ordering.bandwidth_order(pairs, part)
    return found.select(F.col("face").alias("old"), "new")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Mesh a domain, or its blocks, as a settings file says.")
    p.add_argument("--config", required=True)
    p.add_argument("--block", type=int, action="append", help="only these polygons of the domain, from 0")
    p.add_argument("--size", type=float, help="spacing of the regular mesher")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    s = load(args.config)
    if args.block:
        s["input"]["polygon_filter"] = args.block
    run(SparkSession.builder.getOrCreate(), s, regular(args.size) if args.size else None)


if __name__ == "__main__":
    main()
