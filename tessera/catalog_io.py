"""Queries of exports, refinement, rasters, breaklines, bands, renumbering and file formats."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import catalog as base
from tessera import catalog_more as more
from tessera import catalog_spatial as spatial
from tessera.catalog import BAD, CELL, GEOM, MESH, SHAPE, TOUCH, chain, query, rounded
from tessera.cluster import drop_cut, shared_dir, spread
from tessera.operators import band, dem, embankment, export, lines, quality, refine, remap, topology
from tessera.sources import cellbin, container, csvs, layers, msh
from tessera.sources import fixtures as fx

LINES = more._LINES
VERT = "vert AS (SELECT s_suppkey::BIGINT line, i::INT i, (s_suppkey * 97 % 2000 + i * 45 + s_suppkey * (i + 3) % 23)::DOUBLE x, (s_suppkey * 61 % 3000 + s_suppkey * (i * i + 1) % 57)::DOUBLE y FROM supplier, range(0, 5) t(i))"
PIECE = "piece AS (SELECT line, i, x ax, y ay, lead(x) OVER w bx, lead(y) OVER w by_ FROM vert WINDOW w AS (PARTITION BY line ORDER BY i)), sg AS (SELECT *, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) len, coalesce(sum(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)) OVER (PARTITION BY line ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) st FROM piece WHERE bx IS NOT NULL), tot AS (SELECT line, sum(len) total FROM sg GROUP BY line)"
RINGS = "ringv AS (SELECT s_suppkey::BIGINT ring, i::INT i, (s_suppkey * 89 % 2000 + dx * (1 + s_suppkey % 4) + s_suppkey * (i + 1) % 13)::DOUBLE x, (s_suppkey * 71 % 3000 + dy * (1 + s_suppkey % 4) + s_suppkey * (i + 2) % 11)::DOUBLE y FROM supplier, (VALUES (0, 60, 0), (1, 30, 50), (2, -25, 45), (3, -60, 5), (4, -35, -50), (5, 28, -55)) c(i, dx, dy))"
AROUND = "ar AS (SELECT a.ring, a.i, a.x, a.y, p.x px, p.y py, q.x qx, q.y qy FROM ringv a JOIN ringv p ON p.ring = a.ring AND p.i = (a.i + 5) % 6 JOIN ringv q ON q.ring = a.ring AND q.i = (a.i + 1) % 6)"
RASTER = dem.Raster(0.0, 12000.0, 10.0, 1200, 220)
PIX = "pix AS (SELECT (l_partkey * 13 % 1200)::BIGINT \"row\", (l_suppkey * 7 % 220)::BIGINT col, max(l_quantity)::DOUBLE z, max(l_linenumber)::INT code FROM lineitem GROUP BY 1, 2)"


def pixels(spark, sf_dir) -> DataFrame:
    t = fx.table(spark, sf_dir, "lineitem")
    return t.groupBy((F.col("l_partkey") * 13 % 1200).cast("long").alias("row"), (F.col("l_suppkey") * 7 % 220).cast("long").alias("col")).agg(F.max("l_quantity").cast("double").alias("z"), F.max("l_linenumber").cast("int").alias("code"))


def shapes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return export.shapes(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir))


def scratch(spark, name: str) -> str:
    """A folder of its own in the shared folder, for queries that write and read a format."""
    return f"{shared_dir(spark).rstrip('/')}/tessera-formats-{name}-{uuid.uuid4().hex}"


# exports


@query(chain(*MESH) + "SELECT id node_id, x, y, (id * 7 % 13)::DOUBLE z FROM node")
def export_nodes(spark, sf_dir):
    return export.node_rows(more.nodes_z(spark, sf_dir))


@query(chain(CELL, base.ELEM) + "SELECT eid element_id, kind n_nodes, n0, n1, n2, coalesce(n3, -1) n3 FROM elem")
def export_connectivity(spark, sf_dir):
    return export.connectivity_rows(fx.elements(spark, sf_dir))


@query(chain(*SHAPE, GEOM) + """SELECT q.eid element_id, CASE q.kind WHEN 3 THEN 'triangle' ELSE 'quad' END kind, round((x0 + x1 + x2 + coalesce(x3, 0)) / q.kind, 6) centroid_x, round((y0 + y1 + y2 + coalesce(y3, 0)) / q.kind, 6) centroid_y,
  round(area, 4) area, round(min_angle, 6) min_angle_deg, round(max_angle, 6) max_angle_deg, round(aspect, 6) aspect_ratio, round(radius_ratio, 6) radius_ratio, round(scaled_jacobian, 6) scaled_jacobian, convex is_convex FROM quality q JOIN geom USING (eid)""")
def export_elements(spark, sf_dir):
    return rounded(export.element_rows(*shapes(spark, sf_dir)))


@query(chain(*MESH, LINES) + """SELECT eid + 1 "CN", CASE WHEN uses = 2 AND e0 <> e1 THEN 0 ELSE 1 END "ID", ln "LN", na + 1 "StartNode", nb + 1 "EndNode", x xcoord, y ycoord, n.id + 1 node_id, (n.id * 7 % 13)::DOUBLE merge1_mn, ((na * 7 % 13) + (nb * 7 % 13)) / 2.0::DOUBLE merge2_mn
  FROM (SELECT *, unnest([na, nb]) v FROM half) h JOIN line ON lo = least(na, nb) AND hi = greatest(na, nb) JOIN node n ON n.id = v""")
def export_edges(spark, sf_dir):
    half, nodes = base.mesh_half(spark, sf_dir), more.nodes_z(spark, sf_dir)
    return export.edge_rows(half, nodes, topology.line_ids(half), export.own_elevation(nodes, None))


def land(spark, sf_dir) -> DataFrame:
    t = fx.table(spark, sf_dir, "lineitem")
    return t.groupBy((F.col("l_orderkey") * 2).cast("long").alias("eid"), (F.col("l_linenumber") * 10).cast("int").alias("code")).agg((F.count("*") * 4.0).alias("area"))


def faces(spark, sf_dir) -> DataFrame:
    q, centres = shapes(spark, sf_dir)
    q = export.block_ids(q.select("eid", "area"), fx.blocks(spark, sf_dir).select((F.col("face") * 2).alias("eid"), "block"))
    some = q.where("eid % 3 = 0").select("eid", (F.col("eid") % 5 / 4.0).alias("ratio"), (F.col("eid") % 90).cast("double").alias("perimeter"))
    height = q.select("eid", F.when(F.col("eid") % 11 == 0, float("nan")).otherwise((F.col("eid") % 70).cast("double")).alias("elevation"))
    soil = land(spark, sf_dir).select("eid", (F.col("code") / 10).cast("int").alias("code"), (F.col("area") * 2).alias("area"))
    return export.face_rows(q, centres, height, some, land(spark, sf_dir), soil)


_CODES = ", ".join(f"coalesce(sum(area) FILTER (code = {k}), 0)::DOUBLE \"{k}\"" for k in export.LANDUSE_CODES) + ", " + ", ".join(f"coalesce(sum(area * 2) FILTER (code = {10 * k}), 0)::DOUBLE soil_{k}_area" for k in export.SOIL_CODES)
_ALL = ", ".join(f"coalesce(\"{k}\", 0)::DOUBLE \"{k}\"" for k in export.LANDUSE_CODES) + ", " + ", ".join(f"coalesce(soil_{k}_area, 0)::DOUBLE soil_{k}_area" for k in export.SOIL_CODES)
_LAND = "land AS (SELECT 2 * l_orderkey::BIGINT eid, l_linenumber * 10 code, count(*) * 4.0 area FROM lineitem GROUP BY 1, 2)"


@query(chain(*SHAPE, GEOM, _LAND, f"wide AS (SELECT eid, {_CODES} FROM land GROUP BY eid)") + f"""SELECT eid + 1 "CN", CASE WHEN eid % 2 = 0 THEN n_regionkey + 1 ELSE 1 END::INT block, round(share * area, 6) bill_area, round(area, 4) area, round(least(share, 0.95), 6) ratio, CASE WHEN eid % 11 = 0 THEN 0 ELSE eid % 70 END::DOUBLE "_median",
  round((x0 + x1 + x2 + coalesce(x3, 0)) / g.kind, 6) xcoord, round((y0 + y1 + y2 + coalesce(y3, 0)) / g.kind, 6) ycoord, 0 "CalMesh", CASE WHEN eid % 3 = 0 THEN eid % 90 ELSE 0 END::DOUBLE bill_perimeter, {_ALL}
  FROM (SELECT *, CASE WHEN eid % 3 = 0 THEN eid % 5 / 4.0 ELSE 0 END::DOUBLE share FROM quality) q JOIN geom g USING (eid) JOIN cell ON f = eid // 2 JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN wide USING (eid)""")
def export_faces(spark, sf_dir):
    return rounded(faces(spark, sf_dir))


@query(chain(_LAND) + "SELECT eid, code _majority FROM land QUALIFY row_number() OVER (PARTITION BY eid ORDER BY area DESC, code) = 1")
def export_majority(spark, sf_dir):
    return export.land_majority(land(spark, sf_dir))


@query("SELECT p_partkey::INT edge_id, CASE p_partkey % 7 WHEN 3 THEN '3' WHEN 0 THEN 'NONE' WHEN 1 THEN 'ROAD' WHEN 2 THEN 'CULVERT' WHEN 4 THEN 'Q' WHEN 5 THEN 'W' WHEN 6 THEN 'WALL' END kind, p_size::DOUBLE zc, p_size / 2.0::DOUBLE \"H\", 1.5::DOUBLE z_road, 0 qgroup, 0::DOUBLE \"B\", p_size / 100.0::DOUBLE fr FROM part")
def special_edge_rows(spark, sf_dir):
    return export.special_rows(specials(spark, sf_dir, lambda k: k % 7))


def specials(spark, sf_dir, kind) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    return fx.table(spark, sf_dir, "part").select(k.cast("int").alias("edge_id"), kind(k).cast("int").alias("kind"), s.cast("double").alias("zc"), (s / 2).alias("H"), F.lit(1.5).alias("z_road"), F.lit(0).alias("qgroup"), (s / 100).alias("fr"))


@query("SELECT p_partkey::INT edge_id, [1, 2, 4, 5, 6, 7][(p_partkey % 6 + 1)::INT]::INT kind, p_size::DOUBLE zc, p_size / 2.0::DOUBLE \"H\", 1.5::DOUBLE z_road, 0 qgroup, 0::DOUBLE \"B\", p_size / 100.0::DOUBLE fr FROM part")
def special_edge_csv(spark, sf_dir):
    """Written as CSV and read again."""
    path = scratch(spark, "special")
    known = F.array(*[F.lit(k) for k in (1, 2, 4, 5, 6, 7)])
    csvs.write_special_edges(specials(spark, sf_dir, lambda k: F.get(known, (k % 6).cast("int"))), path)
    return csvs.read_special_edges(spark, path)


@query("SELECT s_suppkey::INT edge_id, (s_suppkey % 9)::INT river_link, s_suppkey / 4.0::DOUBLE kp, (s_suppkey % 2 + 1)::INT bank FROM supplier")
def couple_csv(spark, sf_dir):
    path = scratch(spark, "couple")
    k = F.col("s_suppkey")
    csvs.write_couples(fx.table(spark, sf_dir, "supplier").select(k.cast("int").alias("edge_id"), (k % 9).cast("int").alias("river_link"), (k / 4).alias("kp"), (k % 2 + 1).cast("int").alias("bank")), path)
    return csvs.read_couples(spark, path)


@query(chain(*SHAPE) + "SELECT eid + 1 face_id, (eid % 5 / 4.0)::DOUBLE chi, (eid % 3)::DOUBLE perimeter FROM quality WHERE eid % 5 > 0 OR eid % 3 > 0")
def building_rows(spark, sf_dir):
    e = F.col("eid")
    return export.building_sparse(shapes(spark, sf_dir)[0].select("eid", (e % 5 / 4.0).alias("ratio"), (e % 3).cast("double").alias("perimeter")))


# file formats


@query(chain(*MESH) + "SELECT e.eid, kind, n0::BIGINT n0, n1, n2, n3, kind - 2 surface FROM elem e")
def mesh_file(spark, sf_dir):
    """Written as .msh and read again; cells and nodes are numbered densely in the file, so numbers are told by their rank."""
    path = scratch(spark, "msh")
    elem = fx.elements(spark, sf_dir)
    kept = topology.dense_ids(elem, ["kind", "eid"], "r")
    node = topology.dense_ids(fx.nodes(spark, sf_dir), ["id"], "m").select("id", (F.col("m") - 1).alias("new"), "x", "y")
    dense = kept.select((F.col("r") - 1).alias("eid"), "kind", (F.col("kind") - 2).alias("surface"), *[f"n{i}" for i in range(4)])
    for i in range(4):
        dense = dense.join(node.select(F.col("id").alias(f"n{i}"), F.col("new").alias(f"m{i}")), f"n{i}", "left").drop(f"n{i}").withColumnRenamed(f"m{i}", f"n{i}")
    msh.write(dense, node.select(F.col("new").alias("id"), "x", "y"), path)
    cells, _ = msh.read(spark, path)
    back = cells.join(kept.select((F.col("r") - 1).alias("eid"), F.col("eid").alias("old")), "eid").drop("eid").withColumnRenamed("old", "eid")
    for i in range(4):
        back = back.join(node.select(F.col("new").alias(f"n{i}"), F.col("id").alias(f"o{i}")), f"n{i}", "left").drop(f"n{i}").withColumnRenamed(f"o{i}", f"n{i}")
    return back.select("eid", "kind", "n0", "n1", "n2", "n3", "surface")


def cell_file(spark, sf_dir) -> DataFrame:
    half, nodes = base.mesh_half(spark, sf_dir), more.nodes_z(spark, sf_dir)
    q, centres = shapes(spark, sf_dir)
    table = q.select("eid", "kind", F.col("area").alias("A")).join(spread(centres), "eid")
    side = cellbin.side_rows(half, nodes, table.select("eid", F.col("cx").alias("x"), F.col("cy").alias("y"), "A"), topology.line_ids(half))
    none = lambda n: F.array(*[F.lit(0.0)] * n)
    e = F.col("eid")
    face = table.select(F.lit(0).cast("long").alias("mesh"), "eid", (e + 1).cast("int").alias("cn"), F.col("kind").alias("n_edge"), F.col("cx").alias("x"), F.col("cy").alias("y"), "A", (e % 70).cast("double").alias("z_bed"), (e % 5 / 10.0).alias("ratio"), F.lit(0.0).alias("perimeter"), none(13).alias("land"), none(17).alias("soil"), F.lit(0).alias("dummy"))
    return cellbin.packed(face, side.withColumn("mesh", F.lit(0).cast("long")))


def cell_container(spark, sf_dir) -> DataFrame:
    files = cell_file(spark, sf_dir)
    made = cellbin.converted(files)
    drop_cut(files)
    return made


@query(chain(*MESH, LINES, more._NORMAL) + "SELECT ln::INT id, v1::INT v1, v2::INT v2, face_left::INT face_left, face_right::INT face_right, z_crest::DOUBLE z_crest FROM normal")
def cell_file_edges(spark, sf_dir):
    """The cell file written, converted to a container and read again."""
    return container.unpacked(cell_container(spark, sf_dir), "edge", "mesh").select("id", "v1", "v2", "face_left", "face_right", "z_crest")


@query(chain(*SHAPE) + "SELECT (eid + 1)::INT face_id, (eid % 5 / 10.0)::DOUBLE chi, 0::DOUBLE perimeter FROM quality WHERE eid % 5 > 0")
def cell_file_buildings(spark, sf_dir):
    return container.unpacked(cell_container(spark, sf_dir), "building", "mesh").select("face_id", "chi", "perimeter")


@query("SELECT p_partkey::INT edge_id, (p_partkey % 8)::INT kind, CASE WHEN p_size % 4 > 0 THEN p_size END::DOUBLE zc, p_size / 2.0::DOUBLE \"H\", 1.5::DOUBLE z_road, 0 qgroup, 0.25::DOUBLE \"B\" FROM part")
def container_special_edges(spark, sf_dir):
    """Attribute rows through a container and its work files; a missing number comes back as NaN, here as null."""
    rows = specials(spark, sf_dir, lambda k: k % 8).withColumns({"B": F.lit(0.25), "mesh": F.lit(1).cast("long"), "zc": F.when(F.col("zc") % 4 > 0, F.col("zc"))})
    one = spark.range(1).select(F.lit(1).cast("long").alias("mesh"), F.lit(1).alias("id"))
    nodes = one.select("*", *[F.lit(0.0).alias(c) for c in "xyz"])
    edges = one.select("*", F.lit(1).alias("v1"), F.lit(1).alias("v2"), F.lit(1).alias("face_left"), F.lit(0).alias("face_right"), F.lit(0.0).alias("z_crest"), F.lit(0.0).alias("fr"))
    face = one.select("*", F.lit(0).alias("dummy"), *[F.lit(0.0).alias(c) for c in ("x", "y", "A", "z_bed")], F.lit(1).alias("n_sides"), F.array(F.lit(1)).alias("edge_ids"), F.lit(1).alias("block"))
    files = container.joined(container.sections(container.packed(edges, nodes, face, {"special": rows})))
    return container.unpacked(files, "special", "mesh").select("edge_id", "kind", F.when(~F.isnan("zc"), F.col("zc")).alias("zc"), "H", "z_road", "qgroup", "B")


# refinement


def marks(spark, sf_dir) -> DataFrame:
    elem = fx.elements(spark, sf_dir)
    half, q, bad = quality.mesh(elem, fx.nodes(spark, sf_dir))
    coarse = quality.ratio_targets(quality.size_ratios(topology.adjacency(half), q), quality.Limits().neighbour_ratio)
    terrain_bad = base.terrain_of(spark, sf_dir)[1].select((F.col("face") * 2).alias("eid"), *refine.TERRAIN)
    return refine.marked(q, bad, terrain_bad, coarse, 900.0, elem.where("eid % 50 = 0").select("eid"))


_PAIRS = "ratio AS (SELECT CASE WHEN a.size >= b.size THEN e0 ELSE e1 END big, least(a.size, b.size) s, greatest(a.size, b.size) / least(a.size, b.size) r FROM edge JOIN quality a ON a.eid = e0 JOIN quality b ON b.eid = e1 WHERE uses = 2), coarse AS (SELECT big eid, min(s * 1.3) target FROM ratio WHERE r > 1.3 GROUP BY big)"
_MARK = """mk AS (SELECT q.eid, area, size, tri_min_angle OR tri_radius_ratio OR tri_aspect OR quad_nonconvex OR quad_min_angle OR quad_max_angle OR quad_aspect OR quad_jacobian shape, coalesce(bad_rmse::INT + bad_spread::INT + bad_samples::INT, 0) terrain, target IS NOT NULL coarse, target, area <= 945 floored, q.eid % 50 = 0 band,
  coalesce(bad_rmse, false) t1, coalesce(bad_spread, false) t2, coalesce(bad_samples, false) t3, area_below_min FROM quality q JOIN bad USING (eid) LEFT JOIN tbad ON face * 2 = q.eid LEFT JOIN coarse USING (eid))"""
_MARKS = (*SHAPE, TOUCH, BAD, base.SAMPLE, base.MOMENT, base.SPREAD, base.TBAD, _PAIRS, _MARK)
_RULES = ", ".join(f"count(*) FILTER (WHERE b.{v}) viol_{v}" for v in quality.VIOLATIONS)
_TOTAL = " + ".join([f"viol_{v}" for v in quality.VIOLATIONS] + [f"terrain_viol_{r}" for r in refine.TERRAIN] + ["viol_neighbor_ratio"])


@query(chain(*_MARKS) + f"""SELECT *, {_TOTAL} - blocked_by_area_floor unresolved, {_TOTAL} - blocked_by_area_floor <= 0 converged FROM (SELECT {_RULES}, count(*) FILTER (WHERE t1) terrain_viol_bad_rmse, count(*) FILTER (WHERE t2) terrain_viol_bad_spread, count(*) FILTER (WHERE t3) terrain_viol_bad_samples,
  count(*) FILTER (WHERE coarse) viol_neighbor_ratio, (sum(CASE WHEN floored THEN terrain ELSE 0 END) + count(*) FILTER (WHERE coarse AND (floored OR band)))::BIGINT blocked_by_area_floor FROM mk JOIN bad b USING (eid))""")
def refinement_convergence(spark, sf_dir):
    return refine.convergence(marks(spark, sf_dir))


def cell_of(spark, sf_dir) -> DataFrame:
    half_id = F.floor(F.col("eid") / 2)
    return fx.elements(spark, sf_dir).select("eid", ((half_id - half_id % 50) / 50).cast("long").alias("iy"), (half_id % 50).cast("long").alias("ix"))


_FIELD = "fld AS (SELECT r iy, c ix, (20 + f * 31 % 97)::DOUBLE value, (5 + f * 13 % 11)::DOUBLE floor_, (f % 4)::INT attempts FROM cell)"


@query(chain(*_MARKS, _FIELD) + """SELECT count(*) FILTER (WHERE bd AND floored) unresolvable_area_floor, count(*) FILTER (WHERE bd AND NOT floored AND NOT ok) unresolvable_refine_limit, count(*) FILTER (WHERE bd AND NOT floored AND ok) resolvable_remaining, count(*) FILTER (WHERE coarse AND low) neighbor_ratio_at_size_floor, count(*) FILTER (WHERE coarse AND band) neighbor_ratio_at_band
  FROM (SELECT *, shape OR terrain > 0 bd, value <= floor_ + 1e-9 low, attempts < 3 AND value > floor_ + 1e-9 ok FROM mk JOIN fld ON iy = eid // 2 // 50 AND ix = eid // 2 % 50)""")
def refinement_unresolvable(spark, sf_dir):
    return refine.unresolvable(marks(spark, sf_dir), fx.grid(spark, sf_dir), cell_of(spark, sf_dir), 3)


@query(chain(*_MARKS, _FIELD) + """SELECT (SELECT count(*) FROM mk JOIN fld ON iy = eid // 2 // 50 AND ix = eid // 2 % 50 WHERE ((shape OR terrain > 0) AND NOT floored AND attempts < 3 AND value > floor_ + 1e-9) OR (coarse AND NOT floored AND NOT band)) n_refined,
  (SELECT count(*) FROM mk WHERE area < 900 AND eid NOT IN (FROM touch)) n_coarsened""")
def refinement_counts(spark, sf_dir):
    half = base.mesh_half(spark, sf_dir)
    _, counts = refine.refinement(marks(spark, sf_dir), fx.grid(spark, sf_dir), cell_of(spark, sf_dir), topology.boundary_touching(half), least_area=900.0, factor=0.7, most_attempts=3, least=5.0, most=150.0, step=20.0, rounds=1)
    return counts


@query("SELECT c_custkey iteration, c_acctbal::DOUBLE measure, coalesce(c_acctbal >= lag(c_acctbal) OVER (ORDER BY c_custkey) * 0.98, false) stalled FROM customer WHERE c_nationkey = 3")
def refinement_stalled(spark, sf_dir):
    return refine.stalled(fx.table(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("iteration"), F.col("c_acctbal").cast("double").alias("measure")))


GRID = refine.Grid(0.0, 0.0, 40.0, 50, 400)


@query(chain(CELL, _FIELD) + "SELECT a.ix * 40.0::DOUBLE x0, a.ix * 40.0 + 40::DOUBLE x1, a.iy * 40.0::DOUBLE y0, a.iy * 40.0 + 40::DOUBLE y1, a.value v00, b.value v10, c.value v11, d.value v01 FROM fld a JOIN fld b ON b.iy = a.iy AND b.ix = a.ix + 1 JOIN fld c ON c.iy = a.iy + 1 AND c.ix = a.ix + 1 JOIN fld d ON d.iy = a.iy + 1 AND d.ix = a.ix")
def size_field_view(spark, sf_dir):
    return refine.view_cells(fx.grid(spark, sf_dir), GRID)


@query(chain(VERT, PIECE) + "SELECT line, i, k::INT k, round(ax + k * 1.0 / m * (bx - ax), 6) x, round(ay + k * 1.0 / m * (by_ - ay), 6) y FROM (SELECT *, greatest(1, ceil(len / 20))::INT m FROM sg), range(0, 60) t(k) WHERE k <= m AND (k > 0 OR i = 0)")
def densified_lines(spark, sf_dir):
    return rounded(refine.densified(fx.lines(spark, sf_dir), 20.0))


@query(chain(CELL, VERT, PIECE, _FIELD, """hit AS (SELECT least(greatest(round_even(y / 40, 0), 0), 399)::BIGINT iy, least(greatest(round_even(x / 40, 0), 0), 49)::BIGINT ix, min(least(greatest(CASE WHEN line % 3 = 0 THEN 12 ELSE 30 END, 5), 150))::DOUBLE size
  FROM (SELECT line, ax + k * 1.0 / m * (bx - ax) x, ay + k * 1.0 / m * (by_ - ay) y FROM (SELECT *, greatest(1, ceil(len / 20))::INT m FROM sg), range(0, 60) t(k) WHERE k <= m AND (k > 0 OR i = 0)) GROUP BY 1, 2)""")
  + "SELECT iy, ix, CASE WHEN size IS NOT NULL AND least(greatest(size, floor_), 150) < value - 1e-9 THEN least(greatest(size, floor_), 150) ELSE value END::DOUBLE value, floor_ AS floor, attempts FROM fld LEFT JOIN hit USING (iy, ix)")
def reference_sizes(spark, sf_dir):
    return refine.with_references(fx.grid(spark, sf_dir), fx.lines(spark, sf_dir), GRID, 12.0, 30.0, 5.0, 150.0, 20.0, rounds=0)


# rasters


@query(chain(*MESH, PIX) + "SELECT id, x, y, z FROM node LEFT JOIN pix ON \"row\" = floor((12000 - y) / 10) AND col = floor(x / 10)")
def raster_samples(spark, sf_dir):
    return dem.sampled(fx.nodes(spark, sf_dir), pixels(spark, sf_dir).select("row", "col", "z"), RASTER)


_CENTRE = "pc AS (SELECT *, (col + 0.5) * 10 px, 12000 - (\"row\" + 0.5) * 10 py FROM pix)"


@query(chain(*MESH, GEOM, spatial._RING, PIX, _CENTRE) + f"SELECT \"row\", col, max(eid) eid, z, code FROM pc JOIN ringed ON px BETWEEN xlo AND xhi AND py BETWEEN ylo AND yhi AND {spatial._INSIDE} GROUP BY \"row\", col, z, code")
def raster_labels(spark, sf_dir):
    return dem.labelled(pixels(spark, sf_dir), RASTER, spatial.geometry(spark, sf_dir), 40.0)


@query(chain(*MESH, GEOM, spatial._RING, PIX, "bx AS (SELECT code, col * 10.0 bx0, col * 10.0 + 10 bx1, 12000 - \"row\" * 10.0 - 10 by0, 12000 - \"row\" * 10.0 by1 FROM pix)") + f"SELECT eid, code, count(*) * 100.0::DOUBLE area FROM bx JOIN ringed ON {spatial._TOUCH} WHERE code <= 5 GROUP BY eid, code")
def raster_code_areas(spark, sf_dir):
    return dem.code_areas(pixels(spark, sf_dir), RASTER, spatial.geometry(spark, sf_dir), [1, 2, 3, 4, 5], 40.0)


@query(chain(PIX) + "SELECT \"row\", col, z, code FROM pix WHERE \"row\" BETWEEN 689 AND 751 AND col BETWEEN 10 AND 70")
def raster_window(spark, sf_dir):
    return dem.windowed(pixels(spark, sf_dir), RASTER, (150.0, 4540.0, 650.0, 5060.0), 50.0)


@query(chain(CELL, spatial._RASTER) + """SELECT a."row", a.col, round((CASE WHEN a.col = 49 THEN a.z ELSE e.z END - CASE WHEN a.col = 0 THEN a.z ELSE w.z END) / CASE WHEN a.col IN (0, 49) THEN 10 ELSE 20 END, 6) gx, round((CASE WHEN a."row" = 0 THEN a.z ELSE n.z END - CASE WHEN a."row" = 99999 THEN a.z ELSE s.z END) / CASE WHEN a."row" IN (0, 99999) THEN 10 ELSE 20 END, 6) gy
  FROM dem a LEFT JOIN dem e ON e."row" = a."row" AND e.col = a.col + 1 LEFT JOIN dem w ON w."row" = a."row" AND w.col = a.col - 1 LEFT JOIN dem n ON n."row" = a."row" - 1 AND n.col = a.col LEFT JOIN dem s ON s."row" = a."row" + 1 AND s.col = a.col""")
def raster_gradients(spark, sf_dir):
    return rounded(dem.gradients(spatial.dem(spark, sf_dir), dem.Raster(0.0, 1000000.0, 10.0, 100000, 50)))


@query("SELECT r::BIGINT \"row\", c::BIGINT col, round((100 + 0.002 * (5 * (c + 0.5)) + 0.001 * (5 * (80 - r - 0.5)) + 3 * exp(-((((800 - (r + 0.5) * 5) - 500) / 20) ** 2)) + 0.4 * sin(5 * (c + 0.5) / 150) * cos((400 - (r + 0.5) * 5) / 180))::FLOAT::DOUBLE, 2) z FROM range(0, 80) a(r), range(0, 60) b(c)")
def synthetic_terrain(spark, sf_dir):
    t = dem.synthetic(spark, dem.Raster(100.0, 800.0, 5.0, 80, 60), 500.0)
    return t.select("row", "col", F.round(F.col("z").cast("double"), 2).alias("z"))


@query(None)
def embankment_lines(spark, sf_dir):
    """Ridges of a larger synthetic terrain."""
    grid = dem.Raster(0.0, 800.0, 5.0, 160, 240)
    found = embankment.detected(dem.synthetic(spark, grid, 400.0).withColumn("z", F.col("z").cast("double")), grid, embankment.Rules())
    return rounded(found.select("blob", "path", F.size("pts").alias("n_pts"), "length", "relief_median", "relief_max"))


# breaklines

_STATION = "stn AS (SELECT line, k, k * 10.0 pos, least(k * 10.0, total) at_ FROM tot, range(0, 200) t(k) WHERE k < ceil((total + 10) / 10)), spot AS (SELECT s.*, ax + CASE WHEN len > 0 THEN (at_ - st) / len ELSE 0 END * (bx - ax) x, ay + CASE WHEN len > 0 THEN (at_ - st) / len ELSE 0 END * (by_ - ay) y FROM stn s JOIN sg USING (line) QUALIFY row_number() OVER (PARTITION BY s.line, k ORDER BY CASE WHEN at_ >= st THEN 0 ELSE 1 END, sg.i DESC) = 1)"


@query(chain(VERT, PIECE, _STATION) + "SELECT line, k::INT k, pos::DOUBLE pos, round(x, 6) x, round(y, 6) y FROM spot")
def line_stations(spark, sf_dir):
    return rounded(lines.stations(fx.lines(spark, sf_dir), 10.0))


_CROWD = "crowd AS (SELECT DISTINCT p.line, k FROM spot p JOIN (SELECT line other, ax, ay, bx, by_ FROM sg) o ON other <> line AND x BETWEEN least(ax, bx) - 28 AND greatest(ax, bx) + 28 AND y BETWEEN least(ay, by_) - 28 AND greatest(ay, by_) + 28 AND " + spatial._dist("x", "y") + " <= 28 WHERE line % 7 <> 0)"


@query(chain(VERT, PIECE, _STATION, _CROWD) + "SELECT line, k::INT k, pos::DOUBLE pos, c.k IS NOT NULL crowded FROM spot s LEFT JOIN crowd c USING (line, k) WHERE line % 7 <> 0")
def line_crowding(spark, sf_dir):
    return lines.crowded_stations(fx.lines(spark, sf_dir), 28.0, 10.0, 64.0)


@query(chain(VERT) + "SELECT count(*) n FROM vert a JOIN vert b ON a.line < b.line AND abs(a.x - b.x) <= 20 AND abs(a.y - b.y) <= 20 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 20")
def close_vertices(spark, sf_dir):
    return lines.close_vertex_pairs(fx.lines(spark, sf_dir), 20.0)


@query(chain(VERT, PIECE, _STATION, _CROWD, """isle AS (SELECT line, pos, k - row_number() OVER (PARTITION BY line ORDER BY k) g FROM crowd JOIN stn USING (line, k)), runs AS (SELECT line, min(pos) a, max(pos) b FROM isle GROUP BY line, g HAVING max(pos) - min(pos) >= 20),
  dr AS (SELECT line, CASE WHEN a <= 38 THEN 0 ELSE a END s, CASE WHEN b >= total - 38 THEN total ELSE b END e FROM runs JOIN tot USING (line)), al AS (SELECT * FROM dr UNION ALL SELECT line, total, total FROM tot), rm AS (SELECT line, s, coalesce(max(e) OVER (PARTITION BY line ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) f FROM al)""") + "SELECT line, round(f, 6)::DOUBLE AS start, round(s, 6)::DOUBLE AS \"end\" FROM rm WHERE s > f")
def uncrowded_intervals(spark, sf_dir):
    return rounded(lines.uncrowded(fx.lines(spark, sf_dir), 28.0, 64.0))


@query(None)
def trimmed_lines(spark, sf_dir):
    return rounded(lines.trimmed(fx.lines(spark, sf_dir), 12.0, 64.0))


@query(None)
def prepared_lines(spark, sf_dir):
    """Thinned, uncrowded, trimmed and tidied again: what a mesher would be given."""
    t = lines.tidied(fx.lines(spark, sf_dir), 15.0, 30.0, 1.0)
    t = lines.pieces(t, lines.uncrowded(t, 28.0, 64.0))
    t = topology.dense_ids(t, ["line", "pts"], "n").select(F.col("n").alias("line"), "layer", "strict", "pts")
    t = lines.tidied(lines.pieces(t, lines.trimmed(t, 12.0, 64.0)), 15.0, 30.0)
    return rounded(t.select("line", "layer", "strict", F.size("pts").alias("n_vertices"), layers.line_length(F.col("pts")).alias("length")))


@query(chain(*MESH) + "SELECT 'mesh' layer, round(sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)), 3) length, round(sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)), 3) covered FROM edge JOIN node a ON a.id = lo JOIN node b ON b.id = hi WHERE (lo + hi) % 17 = 0")
def line_coverage(spark, sf_dir):
    """Lines made of every 17th mesh edge are covered whole."""
    n = fx.nodes(spark, sf_dir)
    at = lambda which, i: n.select(F.col("id").alias(which), F.col("x").alias(f"x{i}"), F.col("y").alias(f"y{i}"))
    edges = base.line_ids(spark, sf_dir).join(at("lo", 1), "lo").join(at("hi", 2), "hi")
    some = edges.where("(lo + hi) % 17 = 0").select(F.col("ln").alias("line"), F.lit("mesh").alias("layer"), F.lit(False).alias("strict"), F.array(*[F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)]).alias("pts"))
    found = lines.coverage(some, edges.select("x1", "y1", "x2", "y2"), 0.01, 64.0)
    return found.select("layer", F.round("length", 3).alias("length"), F.round("covered", 3).alias("covered"))


# bands


@query(chain(RINGS, AROUND) + "SELECT ring, i, round(abs((d + pi()) - 2 * pi() * floor((d + pi()) / (2 * pi())) - pi()), 6) turn FROM (SELECT *, atan2(qy - y, qx - x) - atan2(y - py, x - px) d FROM ar)")
def ring_turns(spark, sf_dir):
    return rounded(band.turn_angles(fx.rings(spark, sf_dir)))


@query(chain(RINGS, AROUND, "nm AS (SELECT *, -(y - py) / sqrt((x - px) ** 2 + (y - py) ** 2) ax, (x - px) / sqrt((x - px) ** 2 + (y - py) ** 2) ay, -(qy - y) / sqrt((qx - x) ** 2 + (qy - y) ** 2) bx, (qx - x) / sqrt((qx - x) ** 2 + (qy - y) ** 2) by_ FROM ar)", "un AS (SELECT *, (ax + bx) / sqrt((ax + bx) ** 2 + (ay + by_) ** 2) dx, (ay + by_) / sqrt((ax + bx) ** 2 + (ay + by_) ** 2) dy FROM nm)")
  + "SELECT ring, i, round(dx, 6) dx, round(dy, 6) dy, round(least(1 / greatest(0.001, least(1, dx * bx + dy * by_)), 3), 6) scale FROM un")
def ring_mitres(spark, sf_dir):
    return rounded(band.mitres(fx.rings(spark, sf_dir)))


@query(chain(RINGS, AROUND, "cr AS (SELECT *, (px - x) * (qy - y) - (py - y) * (qx - x) c, (px - x) * (qx - x) + (py - y) * (qy - y) d FROM ar)") + "SELECT ring, i, abs(c) / 2 area FROM cr WHERE CASE WHEN atan2(-c, d) < 0 THEN atan2(-c, d) + 2 * pi() ELSE atan2(-c, d) END < radians(125) AND abs(c) / 2 < 3000")
def ring_corners(spark, sf_dir):
    return band.sharp_corners(fx.rings(spark, sf_dir), 3000.0, 125.0)


_EVEN = "rs AS (SELECT *, sqrt((qx - x) ** 2 + (qy - y) ** 2) len, coalesce(sum(sqrt((qx - x) ** 2 + (qy - y) ** 2)) OVER (PARTITION BY ring ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) st FROM ar), rt AS (SELECT ring, sum(len) total, greatest(4, round_even(sum(len) / 25, 0))::INT n FROM rs GROUP BY ring)"


@query(chain(RINGS, AROUND, _EVEN) + "SELECT ring, k::INT i, round(x + (k * total / n - st) / len * (qx - x), 5) x, round(y + (k * total / n - st) / len * (qy - y), 5) y FROM rt JOIN rs USING (ring), range(0, 200) t(k) WHERE k < n AND k * total / n >= st - 1e-9 AND k * total / n < st + len - 1e-9")
def ring_points(spark, sf_dir):
    return rounded(band.resampled(fx.rings(spark, sf_dir), 25.0), 5, four=())


@query(None)
def band_cells(spark, sf_dir):
    return rounded(band.polygon_bands(fx.polygons(spark, sf_dir), 25.0, 15.0))


@query(None)
def band_report(spark, sf_dir):
    return rounded(band.report_all(band.polygon_bands(fx.polygons(spark, sf_dir), 25.0, 15.0), 300.0))


@query(None)
def band_walk(spark, sf_dir):
    return rounded(band.interior_walk(band.polygon_bands(fx.polygons(spark, sf_dir), 25.0, 40.0)))


# layers


@query(chain(RINGS, AROUND) + "SELECT row_number() OVER (ORDER BY ring) - 1 polygon, round(sum(x * qy - y * qx) / 2, 4) area FROM ar GROUP BY ring HAVING sum(x * qy - y * qx) / 2 >= 30000")
def domain_polygons(spark, sf_dir):
    parts = F.array(F.struct("ring", "holes"))
    layer = fx.polygons(spark, sf_dir).select(F.col("polygon").alias("at"), parts.alias("parts"))
    return rounded(layers.domain(layer, 30000.0).select("polygon", "area"))


@query(None)
def clipped_lines(spark, sf_dir):
    """Lines' pieces inside some polygons that don't overlap."""
    seg = lines.segments(fx.lines(spark, sf_dir)).select("line", "i", "ax", "ay", "bx", "by")
    return rounded(layers.clipped_segments(seg, fx.polygons(spark, sf_dir).where("polygon % 10 = 1"), 100.0))


# renumbering


@query(chain(*MESH[:4], "c AS (SELECT lo, hi FROM edge WHERE (lo + hi) % 11 = 0 UNION ALL SELECT id, id + 7919 FROM (SELECT DISTINCT na id FROM half) WHERE id % 13 = 0)") + "SELECT count(*) constrained, count(e.lo) live FROM c LEFT JOIN edge e USING (lo, hi)")
def live_constraints(spark, sf_dir):
    half = base.mesh_half(spark, sf_dir)
    some = topology.edges(half).where("(lo + hi) % 11 = 0").select("lo", "hi")
    none = fx.nodes(spark, sf_dir).where("id % 13 = 0").select(F.col("id").alias("lo"), (F.col("id") + 7919).alias("hi"))
    return remap.live_constraints(half, some.unionByName(none))


_TURNED = (*MESH[:4], LINES, more._NORMAL, "face AS (SELECT DISTINCT eid + 1 old FROM half), fo AS (SELECT old, row_number() OVER (ORDER BY old DESC) \"new\" FROM face), pl AS (SELECT ln, v1, v2, a.new face_left, coalesce(b.new, 0) face_right FROM normal JOIN fo a ON a.old = face_left LEFT JOIN fo b ON b.old = face_right)", "vo AS (SELECT vertex, row_number() OVER (ORDER BY f, vertex) \"new\" FROM (SELECT vertex, min(least(face_left, CASE WHEN face_right > 0 THEN face_right END)) f FROM (SELECT *, unnest([v1, v2]) vertex FROM pl) GROUP BY vertex)), eo AS (SELECT ln, row_number() OVER (ORDER BY CASE face_right WHEN 0 THEN face_left ELSE least(face_left, face_right) END, CASE face_right WHEN 0 THEN 0 ELSE greatest(face_left, face_right) END, ln) \"new\" FROM pl)")


@query(chain(*_TURNED) + "SELECT e.new ln, a.new v1, b.new v2, face_left, face_right FROM pl JOIN eo e USING (ln) JOIN vo a ON a.vertex = v1 JOIN vo b ON b.vertex = v2")
def renumbered_mesh(spark, sf_dir):
    return turned(spark, sf_dir)["edge"].select("ln", "v1", "v2", "face_left", "face_right")


def turned(spark, sf_dir) -> dict[str, DataFrame]:
    half = base.mesh_half(spark, sf_dir)
    ids = more.tables.face_edges(half, base.line_ids(spark, sf_dir)).select((F.col("eid") + 1).alias("id"), "edge_ids")
    order = topology.dense_ids(ids.select(F.col("id").alias("old"), (-F.col("id")).alias("k")), ["k"], "new").select("old", "new")
    nodes = fx.nodes(spark, sf_dir).withColumn("id", F.col("id") + 1)
    return remap.mesh(nodes, more.normal_edges(spark, sf_dir).drop("z_crest"), ids, order)


@query(chain(*_TURNED) + "SELECT fo.new id, string_agg(eo.new::VARCHAR, ',' ORDER BY k) edge_ids FROM half JOIN line ON lo = least(na, nb) AND hi = greatest(na, nb) JOIN eo ON eo.ln = line.ln JOIN fo ON fo.old = eid + 1 GROUP BY fo.new")
def renumbered_faces(spark, sf_dir):
    return turned(spark, sf_dir)["face"].select("id", F.array_join(F.transform("edge_ids", lambda x: x.cast("string")), ",").alias("edge_ids"))


# repair


@query(None)
def repaired_blocks(spark, sf_dir):
    """Strips of twenty rows of the mesh, each repaired on its own."""
    from tessera.operators import patch

    row = lambda e: F.floor(F.floor(e / 2) / 1000)
    elem = fx.elements(spark, sf_dir).select(row(F.col("eid")).alias("block"), "eid", F.lit(0).alias("surface"), "n0", "n1", "n2", "n3")
    nodes = elem.select("block", F.explode(F.array("n0", "n1", "n2", "n3")).alias("id")).where("id is not null").distinct().join(fx.nodes(spark, sf_dir), "id").select("block", "id", "x", "y")
    none = spark.createDataFrame([], "block long, lo long, hi long")
    rules = quality.Limits(min_area=700.0, triangle_min_angle=20.0, triangle_radius_ratio=0.3, triangle_aspect=4.0, quad_min_angle=20.0, quad_max_angle=160.0, quad_aspect=3.0, quad_jacobian=0.3, neighbour_ratio=2.0)
    return patch.repaired(elem, nodes, none, rules)[3]
