"""Queries of spatial joins, special edges, orders, rasters and series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import catalog as base
from tessera import catalog_more as more
from tessera.catalog import CELL, GEOM, MESH, chain, query, rounded
from tessera.operators import ordering, quality, raster, spatial, special
from tessera.sources import fixtures as fx

SIDE = 40.0


def geometry(spark, sf_dir) -> DataFrame:
    return quality.corners(fx.elements(spark, sf_dir), fx.nodes(spark, sf_dir))


_RING = """ringed AS (SELECT eid, kind, least(x0, x1, x2, x3) xlo, greatest(x0, x1, x2, x3) xhi, least(y0, y1, y2, y3) ylo, greatest(y0, y1, y2, y3) yhi, x0, y0, x1, y1, x2, y2, x3, y3, coalesce(x3, x0) xe, coalesce(y3, y0) ye FROM geom)"""
_POINT = "pt AS (SELECT l_orderkey * 10 + l_linenumber pid, (l_partkey * 31 % 2100)::DOUBLE px, (l_suppkey * 53 % 400)::DOUBLE py FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1)"
_INSIDE = " AND ".join(f"({b}x - {a}x) * (py - {a}y) - ({b}y - {a}y) * (px - {a}x) >= 0" for a, b in (("p0", "p1"), ("p1", "p2"))) + " AND (xe - x2) * (py - y2) - (ye - y2) * (px - x2) >= 0 AND (kind = 3 OR (x0 - x3) * (py - y3) - (y0 - y3) * (px - x3) >= 0)"
_INSIDE = _INSIDE.replace("p0x", "x0").replace("p0y", "y0").replace("p1x", "x1").replace("p1y", "y1").replace("p2x", "x2").replace("p2y", "y2")


def points(spark, sf_dir) -> DataFrame:
    t = fx.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid"), (F.col("l_partkey") * 31 % 2100).cast("double").alias("px"), (F.col("l_suppkey") * 53 % 400).cast("double").alias("py"), "l_partkey", "l_suppkey")
    return t.groupBy("pid").agg(F.min_by(F.struct("px", "py"), F.struct("l_partkey", "l_suppkey")).alias("p")).select("pid", "p.px", "p.py")


@query(chain(*MESH, GEOM, _RING, _POINT) + f"SELECT pid, px, py, max(eid) eid FROM pt LEFT JOIN ringed ON px BETWEEN xlo AND xhi AND py BETWEEN ylo AND yhi AND {_INSIDE} GROUP BY ALL")
def points_in_elements(spark, sf_dir):
    return spatial.points_in_elements(points(spark, sf_dir), geometry(spark, sf_dir), SIDE)


_BOX = "bx AS (SELECT s_suppkey pid, (s_suppkey * 97 % 2000)::DOUBLE bx0, (s_suppkey * 61 % 6000)::DOUBLE by0, bx0 + 7 + s_suppkey % 60 bx1, by0 + 5 + s_suppkey % 45 by1 FROM supplier)"


def footprints(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    t = fx.table(spark, sf_dir, "supplier").select(k.alias("pid"), (k * 97 % 2000).cast("double").alias("bx0"), (k * 61 % 6000).cast("double").alias("by0"))
    k = F.col("pid")
    return t.withColumns({"bx1": F.col("bx0") + 7 + k % 60, "by1": F.col("by0") + 5 + k % 45})


def _axis(i: str, j: str) -> str:
    """Whether the normal of side i-j keeps the ring and the box apart (the ring lies on its left)."""
    ax, ay = f"(y{i} - y{j})", f"(x{j} - x{i})"
    dots = [f"({ax} * {x} + {ay} * {y})" for x in ("bx0", "bx1") for y in ("by0", "by1")]
    return f"greatest({', '.join(dots)}) < {ax} * x{i} + {ay} * y{i}"


_TOUCH = f"bx1 >= xlo AND bx0 <= xhi AND by1 >= ylo AND by0 <= yhi AND NOT ({_axis('0', '1')} OR {_axis('1', '2')} OR CASE kind WHEN 3 THEN {_axis('2', '0')} ELSE {_axis('2', '3')} OR {_axis('3', '0')} END)"


@query(chain(*MESH, GEOM, _RING, _BOX) + f"SELECT pid, eid FROM bx JOIN ringed ON {_TOUCH}")
def boxes_touching_elements(spark, sf_dir):
    return spatial.touched(footprints(spark, sf_dir), geometry(spark, sf_dir), SIDE)


@query(None)
def building_cover(spark, sf_dir):
    return rounded(spatial.building_cover(geometry(spark, sf_dir), base.mesh_quality_of(spark, sf_dir), footprints(spark, sf_dir), SIDE))


@query(None)
def vegetation_cover(spark, sf_dir):
    k = F.col("pid")
    patches = footprints(spark, sf_dir).withColumns({"cd": F.when(k % 7 == 0, None).otherwise((k % 5).cast("double")), "a": (k % 11 / 10).cast("double"), "hv": (k % 9).cast("double")})
    return rounded(spatial.weighted_cover(geometry(spark, sf_dir), base.mesh_quality_of(spark, sf_dir), patches, SIDE, ("cd", "a", "hv")))


_SEG = "seg AS (SELECT p_partkey feature, (p_partkey * 389 % 2000)::DOUBLE ax, (p_partkey * 577 % 6000)::DOUBLE ay, ax + p_partkey % 83 - 41 bx, ay + p_partkey % 71 - 35 by_, p_partkey % 4 priority FROM part)"


def features(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    t = fx.table(spark, sf_dir, "part").select(k.alias("feature"), (k * 389 % 2000).cast("double").alias("ax"), (k * 577 % 6000).cast("double").alias("ay"), (k % 4).alias("priority"))
    k = F.col("feature")
    return t.withColumns({"bx": F.col("ax") + k % 83 - 41, "by": F.col("ay") + k % 71 - 35})


def _dist(px: str, py: str, a: str = "ax", b: str = "ay", c: str = "bx", d: str = "by_") -> str:
    t = f"greatest(0, least(1, CASE WHEN ({c} - {a}) ** 2 + ({d} - {b}) ** 2 > 0 THEN (({px} - {a}) * ({c} - {a}) + ({py} - {b}) * ({d} - {b})) / (({c} - {a}) ** 2 + ({d} - {b}) ** 2) ELSE 0 END))"
    return f"sqrt(({px} - {a} - {t} * ({c} - {a})) ** 2 + ({py} - {b} - {t} * ({d} - {b})) ** 2)"


_LINE = "ln AS (SELECT row_number() OVER (ORDER BY lo, hi) ln, a.x x1, a.y y1, b.x x2, b.y y2, (a.x + b.x) / 2 mx, (a.y + b.y) / 2 my FROM edge JOIN node a ON a.id = lo JOIN node b ON b.id = hi)"


@query(chain(*MESH, _LINE, _SEG) + f"""SELECT ln, feature FROM (SELECT ln, feature, row_number() OVER (PARTITION BY ln ORDER BY priority DESC, d, feature) i FROM (SELECT ln, feature, priority, {_dist('mx', 'my')} d, {_dist('x1', 'y1')} d1, {_dist('x2', 'y2')} d2
  FROM ln JOIN seg ON mx BETWEEN least(ax, bx) - 15 AND greatest(ax, bx) + 15 AND my BETWEEN least(ay, by_) - 15 AND greatest(ay, by_) + 15) WHERE d <= 15 AND d1 <= 15 AND d2 <= 15) WHERE i = 1""")
def special_edge_match(spark, sf_dir):
    lines = base.line_ids(spark, sf_dir)
    n = fx.nodes(spark, sf_dir)
    edges = lines.join(n.select(F.col("id").alias("lo"), F.col("x").alias("x1"), F.col("y").alias("y1")), "lo").join(n.select(F.col("id").alias("hi"), F.col("x").alias("x2"), F.col("y").alias("y2")), "hi")
    return special.match(edges.select("ln", "x1", "y1", "x2", "y2"), features(spark, sf_dir), 15.0, 64.0)


_PAIR = """pr AS (SELECT a.feature i, b.feature j, a.ax, a.ay, a.bx, a.by_, b.ax cx, b.ay cy, b.bx dx, b.by_ dy FROM seg a JOIN seg b ON a.feature < b.feature AND least(a.ax, a.bx) - 50 <= greatest(b.ax, b.bx) AND least(b.ax, b.bx) - 50 <= greatest(a.ax, a.bx) AND least(a.ay, a.by_) - 50 <= greatest(b.ay, b.by_) AND least(b.ay, b.by_) - 50 <= greatest(a.ay, a.by_)),
sd AS (SELECT *, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) s1, (bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax) s2, (dx - cx) * (ay - cy) - (dy - cy) * (ax - cx) s3, (dx - cx) * (by_ - cy) - (dy - cy) * (bx - cx) s4, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) len,
  (cx - ax) * (bx - ax) + (cy - ay) * (by_ - ay) pc, (dx - ax) * (bx - ax) + (dy - ay) * (by_ - ay) pd FROM pr),
re AS (SELECT i, j, CASE WHEN s1 = 0 AND s2 = 0 AND least(len, greatest(pc, pd) / len) - greatest(0, least(pc, pd) / len) > 0.001 THEN 'overlap' WHEN gap = 0 THEN 'cross' ELSE 'gap' END relation, gap FROM (SELECT *, CASE WHEN s1 * s2 < 0 AND s3 * s4 < 0 THEN 0 ELSE least(@1, @2, @3, @4) END gap FROM sd))"""
for _k, _v in (("@1", _dist("ax", "ay", "cx", "cy", "dx", "dy")), ("@2", _dist("bx", "by_", "cx", "cy", "dx", "dy")), ("@3", _dist("cx", "cy")), ("@4", _dist("dx", "dy"))):
    _PAIR = _PAIR.replace(_k, _v)


def crossing_features(spark, sf_dir) -> DataFrame:
    """The segments, and for every fifth one the same shifted along itself by half, which overlaps it."""
    f = features(spark, sf_dir)
    on = f.where("feature % 5 = 0").select((F.col("feature") + 1000000).alias("feature"), ((F.col("ax") + F.col("bx")) / 2).alias("ax"), ((F.col("ay") + F.col("by")) / 2).alias("ay"), "priority", (F.col("bx") * 1.5 - F.col("ax") / 2).alias("bx"), (F.col("by") * 1.5 - F.col("ay") / 2).alias("by"))
    return f.unionByName(on)


_SEGS = "seg0 AS (SELECT p_partkey::BIGINT feature, (p_partkey * 389 % 2000)::DOUBLE ax, (p_partkey * 577 % 6000)::DOUBLE ay, ax + p_partkey % 83 - 41 bx, ay + p_partkey % 71 - 35 by_ FROM part), seg AS (SELECT * FROM seg0 UNION ALL SELECT feature + 1000000, (ax + bx) / 2, (ay + by_) / 2, bx * 1.5 - ax / 2, by_ * 1.5 - ay / 2 FROM seg0 WHERE feature % 5 = 0)"


@query(chain(_SEGS, _PAIR) + "SELECT i, j, relation, round(gap, 6) gap FROM re WHERE gap < 30 AND relation <> 'cross'")
def special_edge_conflicts(spark, sf_dir):
    return rounded(special.close_pairs(crossing_features(spark, sf_dir), 30.0, 128.0))


@query(chain(_SEGS, _PAIR) + """SELECT count(*) FILTER (WHERE relation = 'cross') "cross", count(*) FILTER (WHERE relation = 'overlap') overlap, count(*) FILTER (WHERE relation = 'gap' AND gap < 10) gap_lt_10, count(*) FILTER (WHERE relation = 'gap' AND gap >= 10 AND gap < 30) gap_10_clearance,
  count(*) FILTER (WHERE relation = 'gap' AND gap >= 30 AND gap < 50) gap_clearance_50, round(min(gap) FILTER (WHERE relation = 'gap'), 6) shortest, (SELECT count(*) FROM seg) n, ((SELECT count(*) FROM seg) * ((SELECT count(*) FROM seg) - 1) // 2 - count(*))::BIGINT gap_ge_50 FROM re WHERE gap < 50""")
def special_edge_report(spark, sf_dir):
    return rounded(special.proximity(crossing_features(spark, sf_dir), 30.0, 128.0))


@query("WITH RECURSIVE " + chain(_SEGS, _PAIR)[5:].rstrip() + """, cf AS MATERIALIZED (SELECT i, j FROM re WHERE gap < 30 AND relation <> 'cross'), both_ AS MATERIALIZED (SELECT i, j FROM cf UNION ALL SELECT j, i FROM cf),
ranked AS MATERIALIZED (SELECT feature, row_number() OVER (ORDER BY sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) DESC, feature) k FROM seg WHERE feature IN (SELECT i FROM both_)),
foe AS MATERIALIZED (SELECT r.k, list(q.k) foes FROM ranked r JOIN both_ ON i = r.feature JOIN ranked q ON q.feature = j GROUP BY r.k),
pick AS (SELECT 0::BIGINT k, []::BIGINT[] kept UNION ALL SELECT p.k + 1, CASE WHEN list_has_any(p.kept, f.foes) THEN p.kept ELSE list_append(p.kept, f.k) END FROM pick p JOIN foe f ON f.k = p.k + 1)
SELECT feature FROM seg WHERE feature NOT IN (SELECT i FROM both_) UNION ALL SELECT feature FROM ranked WHERE k IN (SELECT unnest(kept) FROM pick WHERE k = (SELECT max(k) FROM ranked))""")
def special_edge_picks(spark, sf_dir):
    return special.clear_features(crossing_features(spark, sf_dir), 30.0, 128.0)


@query("SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 4 WHEN 5 THEN 5 WHEN 6 THEN 6 WHEN 7 THEN 7 END::INT kind FROM part")
def special_edge_kinds(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("ROAD", " weir ", "culvart", "暗渠", "discharge", "ＷＬ", "wal", "Froude", "both")])
    t = fx.table(spark, sf_dir, "part").select("p_partkey", F.element_at(names, (F.col("p_partkey") % 9 + 1).cast("int")).alias("name"))
    return special.kinds(t, "name").select("p_partkey", "kind")


_HEIGHT = "h AS (SELECT p_partkey ln, (p_size % 30)::DOUBLE z_crest, CASE WHEN p_size % 3 > 0 THEN p_size / 4.0 END::DOUBLE zc, CASE WHEN p_size % 4 > 1 THEN p_size / 5.0 END::DOUBLE z_road, CASE WHEN p_size % 5 > 0 THEN 1.5 END::DOUBLE H, CASE WHEN p_size % 2 = 0 THEN 'relative' ELSE 'absolute' END z_mode, p_partkey % 3 kind, CASE WHEN p_partkey % 7 = 0 THEN 0.5 END::DOUBLE cover FROM part)"


@query(chain(_HEIGHT) + """SELECT ln, round(c, 6) zc, round(CASE WHEN kind = 2 AND cover IS NOT NULL THEN c + coalesce(H, 0) + cover WHEN z_mode = 'relative' THEN z_crest + coalesce(z_road, zc, 0) ELSE coalesce(z_road, c) END, 6) z_road, coalesce(H, 0)::DOUBLE "H"
  FROM (SELECT *, CASE z_mode WHEN 'relative' THEN z_crest + coalesce(zc, 0) ELSE coalesce(zc, z_crest) END c FROM h)""")
def special_edge_heights(spark, sf_dir):
    s, k = F.col("p_size"), F.col("p_partkey")
    t = fx.table(spark, sf_dir, "part").select(
        k.alias("ln"), (s % 30).cast("double").alias("z_crest"), F.when(s % 3 > 0, s / 4).cast("double").alias("zc"), F.when(s % 4 > 1, s / 5).cast("double").alias("z_road"),
        F.when(s % 5 > 0, F.lit(1.5)).alias("H"), F.when(s % 2 == 0, "relative").otherwise("absolute").alias("z_mode"), (k % 3).alias("kind"), F.when(k % 7 == 0, F.lit(0.5)).alias("cover"),
    )
    return rounded(special.heights(t).select("ln", "zc", "z_road", "H"))


@query("""WITH s AS (SELECT c_nationkey line, c_custkey k, c_custkey * 10.0::DOUBLE pos FROM customer WHERE c_acctbal > 2000),
i AS (SELECT *, k - row_number() OVER (PARTITION BY line ORDER BY k) isle FROM s) SELECT line, min(pos) start, max(pos) "end" FROM i GROUP BY line, isle HAVING max(pos) - min(pos) >= 0""")
def crowded_runs(spark, sf_dir):
    t = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("line"), F.col("c_custkey").alias("k"), (F.col("c_custkey") * 10.0).cast("double").alias("pos"), (F.col("c_acctbal") > 2000).alias("crowded"))
    return special.runs(t, 0.0)


_DROP = "d AS (SELECT c_nationkey line, (c_custkey * 7 % 5000)::DOUBLE s, (c_custkey * 7 % 5000 + c_custkey % 90)::DOUBLE e FROM customer)"


@query(chain(_DROP, "a AS (SELECT * FROM d UNION ALL SELECT n_nationkey, 5200, 5200 FROM nation)", "r AS (SELECT line, s, coalesce(max(e) OVER (PARTITION BY line ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) f FROM a)") + "SELECT line, f AS start, s AS \"end\" FROM r WHERE s > f")
def keep_intervals(spark, sf_dir):
    k = F.col("c_custkey")
    dropped = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("line"), (k * 7 % 5000).cast("double").alias("start"), (k * 7 % 5000 + k % 90).cast("double").alias("end"))
    lines = fx.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("line"), F.lit(5200.0).alias("length"))
    return special.remaining(lines, dropped)


@query("""WITH t AS (SELECT c_nationkey code, c_custkey, (c_custkey * 13 % 9973 / 10.0)::DOUBLE kp FROM customer), g AS (SELECT *, CASE WHEN kp - lag(kp) OVER (PARTITION BY code ORDER BY kp) > 20 THEN 1 ELSE 0 END step FROM t)
SELECT code, c_custkey, kp, sum(step) OVER (PARTITION BY code ORDER BY kp)::BIGINT part FROM g""")
def river_sessions(spark, sf_dir):
    k = F.col("c_custkey")
    t = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("code"), "c_custkey", (k * 13 % 9973 / 10).cast("double").alias("kp"))
    return special.sessions(t, "code", "kp", 20.0)


_EDGES = (*MESH[:4], more._LINES, more._NORMAL)


@query(chain(*_EDGES) + "SELECT vertex, row_number() OVER (ORDER BY f, vertex) new FROM (SELECT vertex, min(least(face_left, CASE WHEN face_right > 0 THEN face_right END)) f FROM (SELECT *, unnest([v1, v2]) vertex FROM normal) GROUP BY vertex)")
def vertex_order(spark, sf_dir):
    return ordering.vertex_order(more.normal_edges(spark, sf_dir))


@query(chain(*_EDGES) + "SELECT ln, row_number() OVER (ORDER BY CASE face_right WHEN 0 THEN face_left ELSE least(face_left, face_right) END, CASE face_right WHEN 0 THEN 0 ELSE greatest(face_left, face_right) END, ln) new FROM normal")
def edge_order(spark, sf_dir):
    return ordering.edge_order(more.normal_edges(spark, sf_dir))


@query(chain(*_EDGES) + "SELECT round(avg(abs(face_left - face_right)), 6) face_distance, round(avg(step), 6) left_step FROM (SELECT *, abs(face_left - lag(face_left) OVER (ORDER BY ln)) step FROM normal WHERE face_right > 0)")
def edge_locality(spark, sf_dir):
    return rounded(ordering.locality(more.normal_edges(spark, sf_dir)))


@query(chain(*_EDGES, "ord AS (SELECT vertex, row_number() OVER (ORDER BY f, vertex) new FROM (SELECT vertex, min(least(face_left, CASE WHEN face_right > 0 THEN face_right END)) f FROM (SELECT *, unnest([v1, v2]) vertex FROM normal) GROUP BY vertex))") + "SELECT ln, o.new v1, p.new v2 FROM normal JOIN ord o ON o.vertex = v1 JOIN ord p ON p.vertex = v2")
def renumbered_edges(spark, sf_dir):
    edges = more.normal_edges(spark, sf_dir)
    order = ordering.vertex_order(edges)
    return ordering.remapped(ordering.remapped(edges.select("ln", "v1", "v2"), "v1", order, "vertex"), "v2", order, "vertex")


@query(None)
def bandwidth_order(spark, sf_dir):
    from tessera.operators import topology

    cells = fx.blocks(spark, sf_dir).select(F.col("face").alias("cell"), "block")
    faces = fx.elements(spark, sf_dir).select(F.col("eid").alias("face"), F.floor(F.col("eid") / 2).alias("cell")).join(cells, "cell").select("face", F.col("block").alias("component"))
    pairs = topology.adjacency(base.mesh_half(spark, sf_dir))
    same = pairs.join(faces.withColumnsRenamed({"face": "e0", "component": "c0"}), "e0").join(faces.withColumnsRenamed({"face": "e1", "component": "c1"}), "e1").where("c0 = c1")
    part = ordering.components(same.select("e0", "e1"), faces.select("face"))
    return ordering.bandwidth_order(same.select("e0", "e1"), part)


_RASTER = "dem AS (SELECT r::BIGINT \"row\", c::BIGINT col, (f * 37 % 23 + (r * 7 + c * 3) % 29)::DOUBLE z FROM cell)"


def dem(spark, sf_dir) -> DataFrame:
    f, r, c = F.col("f"), F.col("r"), F.col("c")
    return fx.cells(spark, sf_dir).select(r.alias("row"), c.alias("col"), (f * 37 % 23 + (r * 7 + c * 3) % 29).cast("double").alias("z"))


def _slide(name: str, of: str, f: str, half: int) -> str:
    return f"{name}0 AS (SELECT \"row\", col, {f}(v) OVER (PARTITION BY \"row\" ORDER BY col ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) v FROM {of}), {name} AS (SELECT \"row\", col, {f}(v) OVER (PARTITION BY col ORDER BY \"row\" ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) v FROM {name}0)"


_HAT = ("src AS (SELECT \"row\", col, z v FROM dem)", _slide("ero", "src", "min", 2), _slide("opn", "ero", "max", 2))


@query(chain(CELL, _RASTER, *_HAT) + "SELECT \"row\", col, z, z - v relief FROM dem JOIN opn USING (\"row\", col)")
def top_hat(spark, sf_dir):
    return raster.top_hat(dem(spark, sf_dir), 5)


_MASK = "msk AS (SELECT \"row\", col FROM dem WHERE z > 24)"


def mask(spark, sf_dir) -> DataFrame:
    return dem(spark, sf_dir).select("row", "col", (F.col("z") > 24).alias("mask"))


_NEAR = ", ".join(f"bool_or(n.\"row\" = m.\"row\" + {dr} AND n.col = m.col + {dc})::INT o{k}" for k, (dr, dc) in enumerate(raster.RING))
_TURN = " + ".join(f"(o{k} = 1 AND o{(k - 1) % 8} = 0)::INT" for k in range(8))


@query(chain(CELL, _RASTER, _MASK, f"nb AS (SELECT m.\"row\", m.col, {_NEAR} FROM msk m JOIN msk n ON n.\"row\" BETWEEN m.\"row\" - 1 AND m.\"row\" + 1 AND n.col BETWEEN m.col - 1 AND m.col + 1 GROUP BY 1, 2)") + f"SELECT \"row\", col, {_TURN} crossings FROM nb")
def crossing_numbers(spark, sf_dir):
    return raster.crossing_numbers(mask(spark, sf_dir))


@query(chain(CELL, _RASTER, "src AS (SELECT \"row\", col, (z > 24)::INT v FROM dem)", _slide("da", "src", "max", 1), _slide("db", "da", "max", 1), _slide("ea", "db", "min", 1), _slide("eb", "ea", "min", 1), "fr AS (SELECT max(\"row\") mr FROM dem)") + "SELECT \"row\", col, v = 1 AND \"row\" >= 2 AND mr - \"row\" >= 2 AND col >= 2 AND 49 - col >= 2 mask FROM eb, fr")
def closed_mask(spark, sf_dir):
    return raster.closed(mask(spark, sf_dir), 2)


@query(None)  # recursive SQL takes minutes on a whole table; tests hold it against small masks
def mask_blobs(spark, sf_dir):
    return raster.blobs(mask(spark, sf_dir))


@query("""WITH p AS (SELECT user_id AS face, dense_rank() OVER (ORDER BY user_id * 7919 % 100003, user_id) new FROM (SELECT DISTINCT user_id FROM events)) SELECT ts AS t, p.new face, round(sum(value), 6) v FROM events JOIN p ON face = user_id GROUP BY ALL""")
def permuted_rain(spark, sf_dir):
    from tessera.operators.topology import dense_ids

    t = fx.table(spark, sf_dir, "events").select(F.col("ts").alias("t"), F.col("user_id").alias("face"), F.col("value").alias("v"))
    faces = t.select(F.col("face").alias("old")).distinct().withColumn("k", F.col("old") * 7919 % 100003)
    order = dense_ids(faces, ["k", "old"], "new").select("old", "new")
    return rounded(ordering.permuted_series(t, order.withColumnRenamed("old", "face")).groupBy("t", "face").agg(F.sum("v").alias("v")))

