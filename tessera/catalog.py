"""Every query over the driver's tables, with the SQL it is held against.

Queries apply an operator to the mesh of sources/fixtures.py. Doubles are rounded (areas and RMSE to 4 places, others to
6), integer sums are BIGINT, and what doesn't apply is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality, terrain, topology
from tessera.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query; count_if in its SQL becomes a filtered count, which is a BIGINT."""
    sql = sql and re.sub(r"count_if\(((?:[^()]|\([^()]*\))*)\)", r"count(*) FILTER (WHERE \1)", sql)

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = (f, sql)
        return f

    return add


def r4(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _rounded(c: str, places: int) -> Column:
    """The double itself rounded, as SQL does, not its shortest decimal text, which may be a tie that the double isn't."""
    scaled = F.round(F.col(c) * 10.0**places, 0) / 10.0**places
    return F.when(F.abs(scaled) < float("inf"), scaled).otherwise(F.col(c)).alias(c)


def rounded(df: DataFrame, places: int = 6, four: tuple[str, ...] = ("area", "rmse")) -> DataFrame:
    """All doubles rounded; infinities stay."""
    return df.select(*[_rounded(c, 4 if c in four else places) if t == "double" else F.col(c) for c, t in df.dtypes])


def chain(*parts: str) -> str:
    """WITH clause of named tables; a part is 'name AS (...)'."""
    return "WITH " + ",\n".join(parts) + "\n"


# Tables that the oracles share.
CELL = "cell AS (SELECT o_orderkey::BIGINT f, (o_orderkey - o_orderkey % 50) // 50 r, o_orderkey % 50 c, o_orderstatus = 'F' tri, o_custkey FROM orders)"
ELEM = """elem AS (SELECT 2 * f eid, 4 kind, r * 51 + c n0, r * 51 + c + 1 n1, (r + 1) * 51 + c + 1 n2, (r + 1) * 51 + c n3 FROM cell WHERE NOT tri
  UNION ALL SELECT 2 * f, 3, r * 51 + c, r * 51 + c + 1, (r + 1) * 51 + c + 1, NULL FROM cell WHERE tri
  UNION ALL SELECT 2 * f + 1, 3, r * 51 + c, (r + 1) * 51 + c + 1, (r + 1) * 51 + c, NULL FROM cell WHERE tri)"""
HALF = """half AS (SELECT eid, 0 k, n0 na, n1 nb FROM elem UNION ALL SELECT eid, 1, n1, n2 FROM elem
  UNION ALL SELECT eid, 2, n2, CASE kind WHEN 3 THEN n0 ELSE n3 END FROM elem UNION ALL SELECT eid, 3, n3, n0 FROM elem WHERE kind = 4)"""
EDGE = "edge AS (SELECT least(na, nb) lo, greatest(na, nb) hi, count(*) uses, min(eid) e0, max(eid) e1 FROM half GROUP BY 1, 2)"
NODE = "node AS (SELECT id, (40 * (id % 51) + id * 7919 % 17 - 8)::DOUBLE x, (40 * ((id - id % 51) // 51) + id * 104729 % 19 - 9)::DOUBLE y FROM (SELECT DISTINCT na id FROM half))"
GEOM = """geom AS (SELECT eid, kind, a.x x0, a.y y0, b.x x1, b.y y1, c.x x2, c.y y2, d.x x3, d.y y3
  FROM elem JOIN node a ON a.id = n0 JOIN node b ON b.id = n1 JOIN node c ON c.id = n2 LEFT JOIN node d ON d.id = n3)"""
SIDES = """side AS (SELECT h.eid, e.kind, h.k, a.x, a.y, b.x qx, b.y qy, p.x px, p.y py FROM half h JOIN elem e USING (eid)
  JOIN half q ON q.eid = h.eid AND q.k = (h.k + e.kind - 1) % e.kind JOIN node a ON a.id = h.na JOIN node b ON b.id = h.nb JOIN node p ON p.id = q.na)"""
MEASURE = """measure AS (SELECT eid, kind, abs(sum(x * qy - y * qx)) / 2 area, min(ang) min_angle, max(ang) max_angle, min(len) lmin, max(len) lmax, sum(len) / 2 s, exp(sum(ln(len))) p, min(jac) jac
  FROM (SELECT *, sqrt((qx - x) ** 2 + (qy - y) ** 2) len, CASE WHEN t < 0 THEN t + 360 ELSE t END ang,
      ((x - px) * (qy - y) - (y - py) * (qx - x)) / (sqrt((x - px) ** 2 + (y - py) ** 2) * sqrt((qx - x) ** 2 + (qy - y) ** 2)) jac
    FROM (SELECT *, degrees(atan2((qx - x) * (py - y) - (qy - y) * (px - x), (px - x) * (qx - x) + (py - y) * (qy - y))) t FROM side)) GROUP BY eid, kind)"""
QUALITY = """quality AS (SELECT eid, kind, area, min_angle, max_angle, CASE kind WHEN 3 THEN p / (4 * area) / (2 * area / s) ELSE lmax / lmin END aspect,
  CASE kind WHEN 3 THEN 8 * area * area / (s * p) END radius_ratio, CASE kind WHEN 4 THEN jac END scaled_jacobian, kind = 3 OR jac > 0 convex,
  CASE kind WHEN 3 THEN sqrt(4 * area / sqrt(3)) ELSE sqrt(area) END size FROM measure)"""
TOUCH = """bnode AS (SELECT DISTINCT unnest([lo, hi]) id FROM edge WHERE uses = 1),
touch AS (SELECT DISTINCT eid FROM half WHERE na IN (FROM bnode) AND nb IN (FROM bnode))"""
BAD = """bad AS (SELECT q.eid, area < 900 AND t.eid IS NULL area_below_min, kind = 3 AND min_angle < 25 tri_min_angle, coalesce(kind = 3 AND radius_ratio < 0.5, false) tri_radius_ratio,
  kind = 3 AND aspect > 2 tri_aspect, kind = 4 AND NOT convex quad_nonconvex, kind = 4 AND min_angle < 60 quad_min_angle, kind = 4 AND max_angle > 120 quad_max_angle,
  kind = 4 AND aspect > 2 quad_aspect, coalesce(kind = 4 AND scaled_jacobian < 0.85, false) quad_jacobian FROM quality q LEFT JOIN touch t USING (eid))"""
MESH = (CELL, ELEM, HALF, EDGE, NODE)
SHAPE = (*MESH, SIDES, MEASURE, QUALITY)
SAMPLE = "sample AS (SELECT l_orderkey::BIGINT face, (l_partkey % 41 - 20)::DOUBLE dx, (l_suppkey * 7 % 41 - 20)::DOUBLE dy, l_quantity::DOUBLE z FROM lineitem)"


def mesh_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.half_edges(fx.elements(spark, sf_dir))


def mesh_quality_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(quality.corners(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir)))


@query(chain(*MESH[:3]) + "SELECT eid, k, na, nb FROM half")
def half_edges(spark, sf_dir):
    return mesh_half(spark, sf_dir)


@query(chain(*MESH[:4]) + "SELECT lo, hi, uses FROM edge")
def undirected_edges(spark, sf_dir):
    return topology.edges(mesh_half(spark, sf_dir))


@query(chain(*MESH[:4]) + "SELECT e0, e1 FROM edge WHERE uses = 2")
def element_adjacency(spark, sf_dir):
    return topology.adjacency(mesh_half(spark, sf_dir))


@query(chain(*MESH[:4]) + "SELECT eid, k, na, nb, CASE WHEN uses = 2 AND e0 <> e1 THEN CASE eid WHEN e0 THEN e1 ELSE e0 END ELSE -1 END neighbour FROM half JOIN edge ON lo = least(na, nb) AND hi = greatest(na, nb)")
def half_edge_neighbours(spark, sf_dir):
    return topology.neighbours(mesh_half(spark, sf_dir))


@query(chain(*MESH[:4], TOUCH) + "SELECT id FROM bnode")
def boundary_nodes(spark, sf_dir):
    return topology.boundary_nodes(mesh_half(spark, sf_dir))


@query(chain(*MESH[:4], TOUCH) + "SELECT eid FROM touch")
def boundary_touching_elements(spark, sf_dir):
    return topology.boundary_touching(mesh_half(spark, sf_dir))


@query(chain(*MESH) + "SELECT id, row_number() OVER (ORDER BY id) - 1 new_id, x, y FROM node")
def used_nodes(spark, sf_dir):
    return topology.used_nodes(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir)).select("id", "new_id", "x", "y")


@query(chain(*MESH[:4]) + "SELECT lo, hi, row_number() OVER (ORDER BY lo, hi) ln FROM edge")
def line_ids(spark, sf_dir):
    return topology.line_ids(mesh_half(spark, sf_dir)).select("lo", "hi", "ln")


@query(chain(*MESH, GEOM) + "SELECT eid, CASE kind WHEN 3 THEN (x0 + x1 + x2) / 3 ELSE (x0 + x1 + x2 + x3) / 4 END cx, CASE kind WHEN 3 THEN (y0 + y1 + y2) / 3 ELSE (y0 + y1 + y2 + y3) / 4 END cy FROM geom".replace("SELECT eid,", "SELECT eid, round(").replace(" END cx, CASE", " END, 6) cx, round(CASE").replace(" END cy", " END, 6) cy"))
def element_centroids(spark, sf_dir):
    return rounded(quality.centroids(quality.corners(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir))))


@query(chain(*SHAPE) + "SELECT eid, kind, round(area, 4) area, round(min_angle, 6) min_angle, round(max_angle, 6) max_angle, round(aspect, 6) aspect, round(radius_ratio, 6) radius_ratio, round(scaled_jacobian, 6) scaled_jacobian, convex, round(size, 6) size FROM quality")
def element_quality(spark, sf_dir):
    return rounded(mesh_quality_of(spark, sf_dir))


@query(chain(*SHAPE, TOUCH, BAD) + "SELECT * FROM bad")
def quality_violations(spark, sf_dir):
    return quality.mesh(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir))[2]


_COUNTS = ", ".join(f"count_if({n}) viol_{n}" for n in quality.VIOLATIONS)
_ANY = " OR ".join(quality.VIOLATIONS)


@query(chain(*SHAPE, TOUCH, BAD) + f"SELECT count(*) n_elements, count_if(kind = 3) n_triangles, count_if(kind = 4) n_quads, round(min(area), 4) area_min, round(median(area), 4) area_median, round(max(area), 4) area_max, round(sum(area) / 1e6, 6) area_total_km2, {_COUNTS}, count_if({_ANY}) viol_any, round(avg(({_ANY})::INT), 6) viol_any_ratio FROM quality JOIN bad USING (eid)")
def mesh_summary(spark, sf_dir):
    _, q, bad = quality.mesh(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir))
    return rounded(quality.summary(q, bad), four=("area_min", "area_median", "area_max"))


RATIO = """ratio AS (SELECT CASE WHEN a.size >= b.size THEN e0 ELSE e1 END big, CASE WHEN a.size >= b.size THEN e1 ELSE e0 END small, least(a.size, b.size) s_small,
  greatest(a.size, b.size) / greatest(least(a.size, b.size), 1e-12) ratio FROM edge JOIN quality a ON a.eid = e0 JOIN quality b ON b.eid = e1 WHERE uses = 2)"""


def ratios(spark, sf_dir):
    return quality.size_ratios(topology.adjacency(mesh_half(spark, sf_dir)), mesh_quality_of(spark, sf_dir))


@query(chain(*SHAPE, RATIO) + "SELECT count(*) pairs, round(median(ratio), 6) ratio_median, round(quantile_cont(ratio, 0.99), 6) ratio_p99, round(max(ratio), 6) ratio_max, count_if(ratio > 1.3) \"over\" FROM ratio")
def neighbour_ratio_stats(spark, sf_dir):
    return rounded(quality.ratio_stats(ratios(spark, sf_dir), 1.3))


@query(chain(*SHAPE, RATIO) + "SELECT big eid, round(min(s_small * 1.3), 6) target FROM ratio WHERE ratio > 1.3 GROUP BY big")
def neighbour_ratio_targets(spark, sf_dir):
    return rounded(quality.ratio_targets(ratios(spark, sf_dir), 1.3))


@query(chain(*SHAPE) + "SELECT abs(floor(log2(a.size / 25)) - floor(log2(b.size / 25)))::BIGINT difference, count(*) pairs FROM edge JOIN quality a ON a.eid = e0 JOIN quality b ON b.eid = e1 WHERE uses = 2 GROUP BY 1")
def level_differences(spark, sf_dir):
    return quality.level_histogram(mesh_quality_of(spark, sf_dir), topology.adjacency(mesh_half(spark, sf_dir)), 25.0)


MOMENT = """moment AS (SELECT face, count(*) n, sum(z) sz, sum(dx) sx, sum(dy) sy, sum(dx * dx) sxx, sum(dy * dy) syy, sum(dx * dy) sxy, sum(dx * z) sxz, sum(dy * z) syz, sum(z * z) szz FROM sample GROUP BY face),
det AS (SELECT *, sxx * (syy * n - sy * sy) - sxy * (sxy * n - sy * sx) + sx * (sxy * sy - syy * sx) det FROM moment),
solved AS (SELECT *, n >= 3 AND abs(det) > 1e-9 * greatest(sxx * syy, 1e-12) * n ok FROM det),
coef AS (SELECT *, CASE WHEN ok THEN (sxz * (syy * n - sy * sy) - sxy * (syz * n - sy * sz) + sx * (syz * sy - syy * sz)) / det ELSE 0 END a,
  CASE WHEN ok THEN (sxx * (syz * n - sz * sy) - sxz * (sxy * n - sy * sx) + sx * (sxy * sz - syz * sx)) / det ELSE 0 END b,
  CASE WHEN ok THEN (sxx * (syy * sz - sy * syz) - sxy * (sxy * sz - syz * sx) + sxz * (sxy * sy - syy * sx)) / det ELSE sz / n END c FROM solved),
fit AS (SELECT face, n, a, b, c, sqrt(greatest(szz - 2 * (a * sxz + b * syz + c * sz) + a * a * sxx + b * b * syy + n * c * c + 2 * (a * b * sxy + a * c * sx + b * c * sy), 0) / n) rmse,
  CASE WHEN ok THEN sqrt(a * a + b * b) ELSE 0 END slope, ok solvable, sz / n mean_z FROM coef)"""


@query(chain(SAMPLE, MOMENT) + "SELECT face, n, round(a, 6) a, round(b, 6) b, round(c, 6) c, round(rmse, 4) rmse, round(slope, 6) slope, solvable, round(mean_z, 6) mean_z FROM fit")
def terrain_plane_fit(spark, sf_dir):
    return rounded(terrain.plane_fit(fx.samples(spark, sf_dir)))


@query(chain(SAMPLE) + "SELECT face, round(median(z), 6) elevation FROM sample GROUP BY face")
def terrain_median_elevation(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    return rounded(terrain.elevation(s, s, "median"))


@query(chain(SAMPLE) + "SELECT face, z elevation FROM (SELECT face, z, row_number() OVER (PARTITION BY face ORDER BY dx * dx + dy * dy, dx, dy, z) i FROM sample) WHERE i = 1")
def terrain_nearest_elevation(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    return terrain.elevation(s, s, "nearest")


def gradients(spark, sf_dir):
    return fx.samples(spark, sf_dir).select("face", (F.col("dx") / 10).alias("gx"), ((F.col("dy") + F.col("z") / 7) / 10).alias("gy"))


SPREAD = """steep AS (SELECT face, sqrt(gx * gx + gy * gy) w, atan2(gy, gx) t FROM (SELECT face, dx / 10 gx, (dy + z / 7) / 10 gy FROM sample)),
turn AS (SELECT face, count_if(w > 0.2) n, sum(w) FILTER (w > 0.2) w, sum(w * cos(t)) FILTER (w > 0.2) c, sum(w * sin(t)) FILTER (w > 0.2) s FROM steep GROUP BY face),
spread AS (SELECT face, CASE WHEN n >= 2 AND w > 0 THEN degrees(sqrt(-2 * ln(greatest(1e-12, least(1, sqrt(c * c + s * s) / w))))) ELSE 0 END spread FROM turn)"""
TBAD = "tbad AS (SELECT face, rmse > 12 bad_rmse, slope > 0.2 AND spread > 60 bad_spread, n < 3 bad_samples FROM fit JOIN spread USING (face))"


@query(chain(SAMPLE, SPREAD) + "SELECT face, round(spread, 4) spread FROM spread")
def slope_direction_spread(spark, sf_dir):
    return rounded(terrain.slope_spread(gradients(spark, sf_dir), 0.2), four=("spread",))


def terrain_of(spark, sf_dir):
    fit = terrain.plane_fit(fx.samples(spark, sf_dir))
    return fit, terrain.violations(fit, terrain.slope_spread(gradients(spark, sf_dir), 0.2))


@query(chain(SAMPLE, MOMENT, SPREAD, TBAD) + "SELECT * FROM tbad")
def terrain_violations(spark, sf_dir):
    return terrain_of(spark, sf_dir)[1]


@query(chain(*SHAPE, SAMPLE, MOMENT, SPREAD, TBAD) + """SELECT count(*) faces, min(n) samples_min, median(n)::DOUBLE samples_median, round(median(rmse), 4) rmse_median, round(quantile_cont(rmse, 0.95), 4) rmse_p95, round(max(rmse), 4) rmse_max,
  round(sum(rmse * area) / sum(area), 4) rmse_area_weighted, round(sum(CASE WHEN bad_rmse OR bad_spread OR bad_samples THEN area ELSE 0 END) / sum(area), 6) viol_area_ratio,
  count_if(bad_rmse) viol_rmse, count_if(bad_spread) viol_spread, count_if(bad_samples) viol_samples, count_if(bad_rmse OR bad_spread OR bad_samples) viol_any FROM fit JOIN tbad USING (face) JOIN quality ON eid = 2 * face""")
def terrain_summary(spark, sf_dir):
    fit, bad = terrain_of(spark, sf_dir)
    area = mesh_quality_of(spark, sf_dir).where("eid % 2 = 0").select((F.col("eid") / 2).cast("long").alias("face"), "area")
    return rounded(terrain.summary(fit, bad, area), four=("rmse_median", "rmse_p95", "rmse_max", "rmse_area_weighted"))


@query(chain(*MESH[:3], SAMPLE) + "SELECT na id, round(avg(e), 6) z FROM half JOIN (SELECT face, avg(z) e FROM sample GROUP BY face) ON eid = 2 * face GROUP BY na")
def node_incident_elevation(spark, sf_dir):
    fit = terrain.plane_fit(fx.samples(spark, sf_dir))
    return rounded(terrain.incident_elevation(mesh_half(spark, sf_dir), fit.select((F.col("face") * 2).alias("eid"), F.col("mean_z").alias("elevation"))))


@query(chain(*MESH, SAMPLE) + """SELECT id, round(coalesce(s.z, i.z, 0), 6) z FROM node LEFT JOIN (SELECT face id, max(z) z FROM sample WHERE dx > 15 GROUP BY face) s USING (id)
  LEFT JOIN (SELECT na id, avg(e) z FROM half JOIN (SELECT face, avg(z) e FROM sample GROUP BY face) ON eid = 2 * face GROUP BY na) i USING (id)""")
def node_elevation(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    around = node_incident_elevation(spark, sf_dir)
    sampled = s.where("dx > 15").groupBy(F.col("face").alias("id")).agg(F.max("z").alias("z"))
    return rounded(terrain.vertex_elevation(fx.nodes(spark, sf_dir).withColumn("z", F.lit(0.0)), sampled, around))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh_summary(spark, sf_dir)


def _load() -> None:
    from tessera import catalog_more  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
