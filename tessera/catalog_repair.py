"""Queries of mesh repair, streams and the binary container."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import catalog as base
from tessera import catalog_more as more
from tessera import catalog_spatial as spatial
from tessera.catalog import GEOM, MESH, TOUCH, chain, query, rounded
from tessera.operators import quality, repair, tables
from tessera.sources import container
from tessera.sources import fixtures as fx
from tessera.streaming import rain_windows


def _area(*i: int) -> str:
    return "(" + " + ".join(f"x{a} * y{b} - x{b} * y{a}" for a, b in zip(i, i[1:] + i[:1], strict=True)) + ") / 2"


_DIAGONAL = f"dg AS (SELECT e.*, {_area(0, 1, 2)} a0, {_area(0, 2, 3)} a1, {_area(0, 1, 3)} b0, {_area(1, 2, 3)} b1 FROM elem e JOIN geom USING (eid) WHERE e.kind = 4)"


@query(chain(*MESH, GEOM, _DIAGONAL) + """SELECT eid, part, n0, n1, n2, round(area, 4) area FROM (
  SELECT eid, 0 part, n0, n1, n2, a0 area FROM dg WHERE least(a0, a1) >= least(b0, b1) AND least(a0, a1) >= 700 UNION ALL SELECT eid, 1, n0, n2, n3, a1 FROM dg WHERE least(a0, a1) >= least(b0, b1) AND least(a0, a1) >= 700
  UNION ALL SELECT eid, 0, n0, n1, n3, b0 FROM dg WHERE least(a0, a1) < least(b0, b1) AND least(b0, b1) >= 700 UNION ALL SELECT eid, 1, n1, n2, n3, b1 FROM dg WHERE least(a0, a1) < least(b0, b1) AND least(b0, b1) >= 700)""")
def split_quads(spark, sf_dir):
    return rounded(repair.split_quads(spatial.geometry(spark, sf_dir), fx.elements(spark, sf_dir), 700.0))


RULES = quality.Limits(min_area=950.0, quad_min_angle=40.0, quad_max_angle=140.0, quad_aspect=3.0, quad_jacobian=0.5)


def candidates(spark, sf_dir):
    elem = fx.elements(spark, sf_dir)
    constrained = more.topology.edges(base.mesh_half(spark, sf_dir)).where("(lo + hi) % 11 = 0").select("lo", "hi")
    return repair.merge_candidates(elem, base.mesh_half(spark, sf_dir), quality.corners(elem, fx.nodes(spark, sf_dir)), constrained, RULES)


_AT = ", ".join(f"n{i}.x x{i}, n{i}.y y{i}" for i in range(4))
_LEN = [f"sqrt((x{i} - x{(i + 1) % 4}) ** 2 + (y{i} - y{(i + 1) % 4}) ** 2)" for i in range(4)]
_TURN = [f"degrees(atan2((x{(i + 1) % 4} - x{i}) * (y{i - 1 if i else 3} - y{i}) - (y{(i + 1) % 4} - y{i}) * (x{i - 1 if i else 3} - x{i}), (x{i - 1 if i else 3} - x{i}) * (x{(i + 1) % 4} - x{i}) + (y{i - 1 if i else 3} - y{i}) * (y{(i + 1) % 4} - y{i})))" for i in range(4)]
_FULL = [f"CASE WHEN {t} < 0 THEN {t} + 360 ELSE {t} END" for t in _TURN]
_JAC = [f"((x{i} - x{i - 1 if i else 3}) * (y{(i + 1) % 4} - y{i}) - (y{i} - y{i - 1 if i else 3}) * (x{(i + 1) % 4} - x{i})) / ({_LEN[i - 1 if i else 3]} * {_LEN[i]})" for i in range(4)]
_CAND = f"""tri AS (SELECT eid, abs({_area(0, 1, 2)}) area FROM geom WHERE kind = 3), sm AS (SELECT * FROM tri WHERE area < 950 AND eid NOT IN (FROM touch)),
qd AS (SELECT sm.eid small, o.eid other, sm.area small_area, list_extract([e.n2, e.n0, e.n1], h.k + 1) q0, h.na q1, list_extract(list_filter([o.n0, o.n1, o.n2], lambda n: n <> h.na AND n <> h.nb), 1) q2, h.nb q3
  FROM sm JOIN half h USING (eid) JOIN elem e USING (eid) JOIN edge g ON g.lo = least(na, nb) AND g.hi = greatest(na, nb) AND uses = 2 JOIN elem o ON o.eid = CASE h.eid WHEN e0 THEN e1 ELSE e0 END AND o.kind = 3 WHERE (g.lo + g.hi) % 11 <> 0),
qp AS (SELECT qd.*, {_AT} FROM qd JOIN node n0 ON n0.id = q0 JOIN node n1 ON n1.id = q1 JOIN node n2 ON n2.id = q2 JOIN node n3 ON n3.id = q3),
cand AS (SELECT small, other, small_area, {_area(0, 1, 2, 3)} area, least({', '.join(_JAC)}) jacobian, q0, q1, q2, q3 FROM qp WHERE least({', '.join(_JAC)}) >= 0.5 AND {_area(0, 1, 2, 3)} >= 950 AND greatest({', '.join(_LEN)}) <= 3 * least({', '.join(_LEN)}) AND least({', '.join(_FULL)}) >= 40 AND greatest({', '.join(_FULL)}) <= 140)"""


@query(chain(*MESH, GEOM, TOUCH, _CAND) + "SELECT small, other, round(small_area, 4) small_area, round(area, 4) area, round(jacobian, 6) jacobian, q0, q1, q2, q3 FROM cand")
def merge_candidates(spark, sf_dir):
    return rounded(candidates(spark, sf_dir), four=("area", "small_area"))


@query("WITH RECURSIVE " + chain(*MESH, GEOM, TOUCH, _CAND)[5:].rstrip() + """, ranked AS (SELECT *, row_number() OVER (ORDER BY small_area, small, jacobian DESC, other) k FROM cand),
pick AS (SELECT 0::BIGINT k, []::BIGINT[] used, []::BIGINT[] kept UNION ALL SELECT p.k + 1, CASE WHEN list_contains(used, small) OR list_contains(used, other) THEN used ELSE list_concat(used, [small, other]) END, CASE WHEN list_contains(used, small) OR list_contains(used, other) THEN kept ELSE list_append(kept, r.k) END FROM pick p JOIN ranked r ON r.k = p.k + 1)
SELECT small, other, round(small_area, 4) small_area, round(area, 4) area, round(jacobian, 6) jacobian, q0, q1, q2, q3 FROM ranked WHERE k IN (SELECT unnest(kept) FROM pick WHERE k = (SELECT max(k) FROM ranked))""")
def greedy_merges(spark, sf_dir):
    return rounded(repair.greedy_merges(candidates(spark, sf_dir)).drop("block"), four=("area", "small_area"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts::TIMESTAMP) AS start, user_id face, round(sum(value), 6) total, max(value) peak, count(*) n FROM events GROUP BY ALL")
def rain_hours(spark, sf_dir):
    t = fx.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("t"), F.col("user_id").alias("face"), F.col("value").alias("v"))
    return rounded(rain_windows(t)).withColumn("start", F.col("start").cast("timestamp_ntz"))


def containers(spark, sf_dir):
    """One container for each fifth of the mesh."""
    half = base.mesh_half(spark, sf_dir)
    part = F.floor(F.col("id") / 5000).alias("mesh")
    nodes = more.nodes_z(spark, sf_dir).select(part, "id", "x", "y", "z")
    edges = more.normal_edges(spark, sf_dir).select(F.col("ln").alias("id"), "v1", "v2", "face_left", "face_right", "z_crest", F.lit(0.0).alias("fr"))
    ids = tables.face_edges(half, base.line_ids(spark, sf_dir))
    shape = base.mesh_quality_of(spark, sf_dir).select("eid", "area")
    centre = quality.centroids(quality.corners(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir)))
    faces = ids.join(shape, "eid").join(centre, "eid").select(F.col("eid").alias("id"), F.lit(0).alias("dummy"), F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("area").alias("A"), F.lit(0.0).alias("z_bed"), F.size("edge_ids").alias("n_sides"), "edge_ids", F.lit(1).alias("block"))
    split = lambda df: df.withColumn("mesh", part)
    return container.packed(split(edges), nodes, split(faces))


@query(chain(*MESH) + "SELECT id::INT id, x, y, (id * 7 % 13)::DOUBLE z FROM node")
def container_nodes(spark, sf_dir):
    return container.unpacked(containers(spark, sf_dir), "node", "mesh").select("id", "x", "y", "z")


@query(chain(*MESH[:4], more._LINES, more._NORMAL) + "SELECT ln::INT id, v1::INT v1, v2::INT v2, face_left::INT face_left, face_right::INT face_right, z_crest::DOUBLE z_crest FROM normal")
def container_edges(spark, sf_dir):
    return container.unpacked(containers(spark, sf_dir), "edge", "mesh").select("id", "v1", "v2", "face_left", "face_right", "z_crest")
