"""Normalised node, edge and face tables, export rows, and the attributes that hang on faces and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.cluster import spread
from tessera.operators import topology

# Kinds of special edges, their priority where lines compete, and those that stay closed.
KINDS = {"NONE": 0, "ROAD": 1, "CULVERT": 2, "Q": 4, "W": 5, "WALL": 6, "FROUDE": 7}
DEFAULT_FROUDE = 0.35


def normalised_edges(half: DataFrame, nodes: DataFrame) -> DataFrame:
    """ln, v1, v2, face_left, face_right, z_crest of every edge, all numbered from 1.

    The first side in (eid, k) order gives direction and left face; the other face is right, 0 on the boundary or where
    more than two sides meet. z_crest is the mean of the ends' z.
    """
    seq = F.struct("eid", "k", "na", "nb")
    folded = topology.keyed(half).groupBy("lo", "hi").agg(F.min(seq).alias("a"), F.max(seq).alias("b"), F.count("*").alias("n"))
    numbered = topology.dense_ids(folded, ["lo", "hi"], "ln")
    right = F.when((F.col("n") == 2) & (F.col("a.eid") != F.col("b.eid")), F.col("b.eid") + 1).otherwise(F.lit(0))
    z = nodes.select(F.col("id").alias("v"), "z")
    flat = numbered.select("ln", F.col("a.na").alias("va"), F.col("a.nb").alias("vb"), (F.col("a.eid") + 1).alias("face_left"), right.cast("long").alias("face_right"))
    out = flat.join(z.withColumnsRenamed({"v": "va", "z": "za"}), "va").join(z.withColumnsRenamed({"v": "vb", "z": "zb"}), "vb")
    return out.select("ln", (F.col("va") + 1).alias("v1"), (F.col("vb") + 1).alias("v2"), "face_left", "face_right", ((F.col("za") + F.col("zb")) / 2).alias("z_crest"))


def face_edges(half: DataFrame, lines: DataFrame) -> DataFrame:
    """eid, edge_ids: the edges of a face in the order of its sides; lines has lo, hi, ln."""
    sides = topology.keyed(half).join(lines, ["lo", "hi"]).groupBy("eid").agg(F.array_sort(F.collect_list(F.struct("k", "ln"))).alias("s"))
    return sides.select("eid", F.transform("s", lambda s: s["ln"]).alias("edge_ids"))


def edge_rows(half: DataFrame, nodes: DataFrame, lines: DataFrame) -> DataFrame:
    """Two export rows for each side, its start and its end: cn, id (1 on the boundary), ln, start, end, node, x, y."""
    near = topology.neighbours(half)
    sides = topology.keyed(near).join(lines, ["lo", "hi"])
    ends = sides.select((F.col("eid") + 1).alias("cn"), F.when(F.col("neighbour") < 0, 1).otherwise(0).alias("id"), "ln", F.col("na").alias("start"), F.col("nb").alias("end"), F.explode(F.array("na", "nb")).alias("node"))
    return ends.join(nodes.select(F.col("id").alias("node"), "x", "y"), "node").select("cn", "id", "ln", "start", "end", "node", "x", "y")


def majority(areas: DataFrame, key: str = "face") -> DataFrame:
    """key, code with the largest area; ties to the smaller code, 0 where no area is positive."""
    best = F.max(F.struct("area", F.negative("code").alias("c")))
    return areas.groupBy(key).agg(best.alias("m")).select(key, F.when(F.col("m.area") > 0, F.negative(F.col("m.c"))).otherwise(F.lit(0)).alias("code"))


def code_areas(pixels: DataFrame, codes: list[int], pixel_area: float, key: str = "face") -> DataFrame:
    """key, code, area of the listed codes, in long form."""
    return pixels.where(F.col("code").isin(codes)).groupBy(key, "code").agg((F.sum("weight") * pixel_area).alias("area"))


def wide_areas(areas: DataFrame, codes: list[int], key: str = "face") -> DataFrame:
    """key and a column for each code, 0 where it is absent."""
    return areas.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("code") == c, F.col("area"))), F.lit(0.0)).alias(f"c{c}") for c in codes])


def sparse_areas(wide: DataFrame, codes: list[int], least: float, key: str = "face") -> DataFrame:
    """The long form of wide_areas' columns above least."""
    return wide.unpivot(key, [f"c{c}" for c in codes], "name", "area").where(F.col("area") > least).select(key, F.substring("name", 2, 9).cast("int").alias("code"), "area")


def distance_weights(own: Column, other: Column) -> tuple[Column, Column, Column]:
    """(self, adjacent, face) inverse-distance weights; other is null on the boundary."""
    tiny = 1e-10
    both = (own > tiny) & (other > tiny)
    mine = F.when(other.isNull(), 1.0).when(both, other / (own + other)).when(own <= tiny, 1.0).otherwise(0.0)
    face = F.when(own > tiny, 1 / (own + 1)).otherwise(1.0)
    return mine, F.when(other.isNull(), 0.0).otherwise(1 - mine), face


def side_weights(half: DataFrame, nodes: DataFrame, centres: DataFrame) -> DataFrame:
    """eid, k, w_self, w_adj, w_face from the distances of both elements' centres to the side's middle."""
    a = nodes.select(F.col("id").alias("na"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = nodes.select(F.col("id").alias("nb"), F.col("x").alias("bx"), F.col("y").alias("by"))
    t = topology.neighbours(half).join(a, "na").join(b, "nb").join(centres, "eid")
    t = t.join(centres.withColumnsRenamed({"eid": "neighbour", "cx": "ox", "cy": "oy"}), "neighbour", "left")
    mx, my = (F.col("ax") + F.col("bx")) / 2, (F.col("ay") + F.col("by")) / 2
    own, other = F.hypot(F.col("cx") - mx, F.col("cy") - my), F.hypot(F.col("ox") - mx, F.col("oy") - my)
    w = distance_weights(own, other)
    return t.select("eid", "k", *[x.alias(n) for x, n in zip(w, ("w_self", "w_adj", "w_face"), strict=True)])


def boundary_froude(edges: DataFrame, special: DataFrame, couple: DataFrame, default: float) -> DataFrame:
    """ln, fr: special lines' numbers, then the edge's own fr, then the default on open outer edges; at most 1.

    Of several special rows of one edge the last number (by ``seq`` if there is one, else by number) holds. Edges of a
    kind other than FROUDE or NONE, and coupled edges, are closed and never get the default. FROUDE lines without a
    number get the default, or 0.35.
    """
    fallback = default if default > 0 else DEFAULT_FROUDE
    closed = F.col("kind").isin([KINDS[k] for k in ("ROAD", "CULVERT", "Q", "W", "WALL")])
    value = F.when((F.col("kind") == KINDS["FROUDE"]) & (F.col("fr") <= 0), fallback).otherwise(F.col("fr"))
    given = F.when(~closed & (value > 0), F.struct(F.col("seq") if "seq" in special.columns else F.lit(0), F.least(value, F.lit(1.0)).alias("v")))
    known = special.groupBy("ln").agg(F.max(closed).alias("closed"), F.max(given).alias("given"))
    own = edges.select("ln", "face_right", (F.col("fr") if "fr" in edges.columns else F.lit(0.0)).alias("own"))
    t = own.join(known, "ln", "left").join(couple.select("ln", F.lit(True).alias("coupled")).distinct(), "ln", "left")
    set_ = F.coalesce(F.col("given.v"), F.col("own"), F.lit(0.0))
    is_open = ~F.coalesce("closed", F.lit(False)) & F.col("coupled").isNull() & (F.col("face_right") == 0) & F.lit(default > 0)
    return t.select("ln", F.when(is_open & (set_ <= 0), min(default, 1.0)).otherwise(set_).alias("fr"))


def usual_froude(special_default: float | None, output_default: float | None) -> float:
    """The default of special edges if positive, else that of the output, within 0 and 1."""
    within = [min(1.0, max(0.0, x or 0.0)) for x in (special_default, output_default)]
    return within[0] if within[0] > 0 else within[1]


def _offsets(faces: DataFrame) -> DataFrame:
    """block, off: the largest cn of the blocks before, added up."""
    most = faces.groupBy("block").agg(F.max("cn").alias("most"))
    before = F.sum("most").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))  # a row for each block
    return F.broadcast(most.withColumn("off", F.coalesce(before, F.lit(0))).select("block", "off"))


def merged_faces(faces: DataFrame) -> DataFrame:
    """The faces of merged_blocks, which need no edge rows."""
    return faces.join(_offsets(faces), "block").select("block", (F.col("cn") + F.col("off")).alias("cn"))


def merged_blocks(faces: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One mesh of several blocks' exports: (faces, edge rows).

    faces: block, cn. rows: block, cn, ln, node, start, end, x, y (two for each block, cn, ln). cn go up by the largest
    cn of the blocks before; nodes at the same place to 4 decimals become one, numbered from 1 by their first row in
    (block, cn, ln, node) order; edges are numbered by their first row, and id is 0 where two cells meet, else 1. An edge
    of more than two cells is an error, and so are missing numbers and an edge of a cell without exactly two rows.
    """
    missing = F.greatest(*[(F.col(c).isNull() | (F.isnan(c) if c in ("x", "y") else F.lit(False))).cast("int") for c in ("cn", "ln", "node", "start", "end", "x", "y")]) == 1
    rows = rows.withColumn("cn", F.when(missing, F.raise_error(F.lit("an edge row without a number")).cast(rows.schema["cn"].dataType)).otherwise(F.col("cn")))
    offset, out_faces = _offsets(faces), merged_faces(faces)
    seq = F.struct("block", "cn", "ln", "node")
    placed = rows.withColumn("px", F.rint(F.col("x") * 1e4).cast("long")).withColumn("py", F.rint(F.col("y") * 1e4).cast("long"))
    where = topology.dense_ids(placed.groupBy("px", "py").agg(F.min(seq).alias("seq")), ["seq"], "nid").select("px", "py", "nid")
    local = placed.select("block", "node", "px", "py").distinct().join(spread(where), ["px", "py"]).groupBy("block", "node").agg(F.min("nid").alias("nid"))
    t = rows.join(offset, "block").withColumn("gcn", F.col("cn") + F.col("off"))
    for name in ("node", "start", "end"):
        t = t.join(spread(local.select("block", F.col("node").alias(name), F.col("nid").alias(f"g_{name}"))), ["block", name])
    t = t.withColumn("lo", F.least("g_start", "g_end")).withColumn("hi", F.greatest("g_start", "g_end"))
    pairs = t.groupBy("lo", "hi", "gcn").agg(F.min(seq).alias("seq"), F.count("*").alias("n"))
    twos = F.when(F.col("n") != 2, F.raise_error(F.lit("an edge of a cell without exactly two rows")).cast("long")).otherwise(F.col("gcn"))
    lines = topology.dense_ids(pairs.groupBy("lo", "hi").agg(F.min("seq").alias("seq"), F.count(twos).alias("cells")), ["seq"], "gln").select("lo", "hi", "gln", "cells")
    cells = F.when(F.col("cells") > 2, F.raise_error(F.lit("an edge of more than two cells"))).otherwise(F.when(F.col("cells") == 2, 0).otherwise(1))
    return out_faces, t.join(spread(lines), ["lo", "hi"]).select(F.col("gcn").alias("cn"), F.col("gln").alias("ln"), F.col("g_node").alias("node"), F.col("g_start").alias("start"), F.col("g_end").alias("end"), "x", "y", cells.cast("int").alias("id"))


def block_summary(t: DataFrame) -> DataFrame:
    """block, faces, area, smallest, rmse (area-weighted) of rows with block, area, rmse."""
    return t.groupBy("block").agg(F.count("*").alias("faces"), F.sum("area").alias("area"), F.min("area").alias("smallest"), (F.sum(F.col("rmse") * F.col("area")) / F.sum("area")).alias("rmse"))
