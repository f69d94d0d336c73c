"""Export rows: faces, edges, elements, nodes, connectivity, special edges, couplings, summaries and iteration logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality, topology
from tessera.operators.tables import KINDS

# Land-use codes in the order of their columns, soil classes, the largest building ratio and what stands
# for an aspect without bound.
LANDUSE_CODES = (10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 110, 140, 160)
SOIL_CODES = tuple(range(1, 18))
LARGEST_RATIO = 0.95
UNBOUNDED_ASPECT = 1e6


def finite(c: Column) -> Column:
    """The number, or null where it is NaN or without bound."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def wkt(elem: DataFrame, nodes: DataFrame) -> DataFrame:
    """eid, wkt: each element's closed ring."""
    corner = elem.select("eid", F.posexplode(F.array("n0", "n1", "n2", "n3")).alias("k", "id")).where("id is not null").join(nodes.select("id", "x", "y"), "id")
    ring = F.transform(F.array_sort(F.collect_list(F.struct("k", "x", "y"))), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    rings = corner.groupBy("eid").agg(ring.alias("r"))
    return rings.select("eid", F.concat(F.lit("POLYGON (("), F.array_join(F.concat("r", F.slice("r", 1, 1)), ", "), F.lit("))")).alias("wkt"))


def block_ids(faces: DataFrame, blocks: DataFrame | None = None, only: list[int] | None = None) -> DataFrame:
    """faces (eid) with block, from 1: the given one (eid, block), else the single polygon that was asked for, else 1."""
    usual = only[0] + 1 if only is not None and len(only) == 1 else 1
    if blocks is None:
        return faces.withColumn("block", F.lit(usual))
    return faces.join(blocks.select("eid", F.col("block").alias("given__")), "eid", "left").withColumn("block", F.coalesce("given__", F.lit(usual)).cast("int")).drop("given__")


def block_of_folder(name: Column) -> Column:
    """Block number from 1 of a folder block_NNN; 1 where the name has no number."""
    return F.coalesce((F.regexp_extract(name, r"^block_(\d+)$", 1).try_cast("int") + 1), F.lit(1))


def own_elevation(nodes: DataFrame, sampled: DataFrame | None) -> DataFrame:
    """id, z: the sample at a node, else the node's own z where any node has one, else 0."""
    own = nodes.select("id", F.coalesce(finite(F.col("z")), F.lit(0.0)).alias("own")) if "z" in nodes.columns else nodes.select("id", F.lit(0.0).alias("own"))
    if sampled is None:
        return own.withColumnRenamed("own", "z")
    return own.join(sampled.select("id", finite(F.col("z")).alias("s")), "id", "left").select("id", F.coalesce("s", "own").alias("z"))


def face_rows(q: DataFrame, centres: DataFrame, elevation: DataFrame, cover: DataFrame, land: DataFrame, soil: DataFrame, shapes: DataFrame | None = None) -> DataFrame:
    """A row for each face of the solver's face table.

    q: eid, area, block. elevation: eid, elevation. cover: eid, ratio, perimeter. land and soil: eid, code, area, in long
    form; the listed codes become columns. Missing attributes are 0.
    """
    wide = q.select("eid", "area", "block").join(centres, "eid").join(elevation.select("eid", "elevation"), "eid", "left").join(cover.select("eid", "ratio", "perimeter"), "eid", "left")
    for table, codes, name in ((land, LANDUSE_CODES, lambda k: f"{k}"), (soil, SOIL_CODES, lambda k: f"soil_{k}_area")):
        columns = [F.sum(F.when(F.col("code") == k, F.col("area")).otherwise(0.0)).alias(name(k)) for k in codes]
        wide = wide.join(table.groupBy("eid").agg(*columns), "eid", "left")
    if shapes is not None:
        wide = wide.join(shapes, "eid", "left")
    bill = F.coalesce("ratio", F.lit(0.0)) * F.col("area")
    ratio = F.when(F.col("area") > 0, F.least(bill / F.col("area"), F.lit(LARGEST_RATIO))).otherwise(0.0)
    return wide.select(
        (F.col("eid") + 1).alias("CN"), "block", bill.alias("bill_area"), "area", ratio.alias("ratio"), F.coalesce(finite(F.col("elevation")), F.lit(0.0)).alias("_median"),
        F.col("cx").alias("xcoord"), F.col("cy").alias("ycoord"), F.lit(0).alias("CalMesh"), F.coalesce("perimeter", F.lit(0.0)).alias("bill_perimeter"), *(["wkt"] if shapes is not None else []),
        *[F.coalesce(F.col(f"`{k}`"), F.lit(0.0)).alias(f"{k}") for k in LANDUSE_CODES], *[F.coalesce(f"soil_{k}_area", F.lit(0.0)).alias(f"soil_{k}_area") for k in SOIL_CODES],
    )


def land_majority(land: DataFrame) -> DataFrame:
    """eid, _majority: the land-use code of the largest area, the first listed one on ties, 0 without any area."""
    place = F.create_map(*[x for i, k in enumerate(LANDUSE_CODES) for x in (F.lit(k), F.lit(i))])
    listed = land.where(F.col("code").isin(list(LANDUSE_CODES)))
    best = F.max(F.struct("area", F.negative(place[F.col("code")]).alias("first"), "code"))
    return listed.groupBy("eid").agg(best.alias("m")).select("eid", F.when(F.col("m.area") > 0, F.col("m.code")).otherwise(0).alias("_majority"))


def edge_rows(half: DataFrame, nodes: DataFrame, lines: DataFrame, z: DataFrame) -> DataFrame:
    """Two rows for each side, its start and its end, with the node's height and the mean height of both ends."""
    at = nodes.select("id", "x", "y").join(z.select("id", "z"), "id")
    sides = topology.keyed(topology.neighbours(half)).join(lines, ["lo", "hi"])
    end = lambda which: at.select(F.col("id").alias(which), F.struct("id", "x", "y", "z").alias(f"p_{which}"))
    both = sides.join(end("na"), "na").join(end("nb"), "nb")
    rows = both.select(
        (F.col("eid") + 1).alias("CN"), F.when(F.col("neighbour") < 0, 1).otherwise(0).alias("ID"), F.col("ln").alias("LN"), (F.col("na") + 1).alias("StartNode"), (F.col("nb") + 1).alias("EndNode"),
        ((F.col("p_na.z") + F.col("p_nb.z")) / 2).alias("merge2_mn"), F.explode(F.array("p_na", "p_nb")).alias("p"),
    )
    return rows.select("CN", "ID", "LN", "StartNode", "EndNode", F.col("p.x").alias("xcoord"), F.col("p.y").alias("ycoord"), (F.col("p.id") + 1).alias("node_id"), F.col("p.z").alias("merge1_mn"), "merge2_mn")


def edge_lines(half: DataFrame, nodes: DataFrame, lines: DataFrame) -> DataFrame:
    """CN, LineID, ID, wkt: one line for each side of a face."""
    at = nodes.select("id", F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string")).alias("p"))
    sides = topology.keyed(topology.neighbours(half)).join(lines, ["lo", "hi"])
    both = sides.join(at.withColumnsRenamed({"id": "na", "p": "pa"}), "na").join(at.withColumnsRenamed({"id": "nb", "p": "pb"}), "nb")
    text = F.concat(F.lit("LINESTRING ("), "pa", F.lit(", "), "pb", F.lit(")"))
    return both.select((F.col("eid") + 1).alias("CN"), F.col("ln").alias("LineID"), F.when(F.col("neighbour") < 0, 1).otherwise(0).alias("ID"), text.alias("wkt"))


def element_rows(q: DataFrame, centres: DataFrame) -> DataFrame:
    aspect = F.when(F.col("aspect") == float("inf"), UNBOUNDED_ASPECT).otherwise(F.coalesce("aspect", F.lit(0.0)))
    return q.join(centres, "eid").select(
        F.col("eid").alias("element_id"), F.when(F.col("kind") == 3, "triangle").otherwise("quad").alias("kind"), F.col("cx").alias("centroid_x"), F.col("cy").alias("centroid_y"), "area",
        F.col("min_angle").alias("min_angle_deg"), F.col("max_angle").alias("max_angle_deg"), aspect.alias("aspect_ratio"), "radius_ratio", "scaled_jacobian", F.col("convex").alias("is_convex"),
    )


def node_rows(nodes: DataFrame) -> DataFrame:
    z = F.coalesce(F.col("z"), F.lit(0.0)) if "z" in nodes.columns else F.lit(0.0)
    return nodes.select(F.col("id").alias("node_id"), "x", "y", z.alias("z"))


def connectivity_rows(elem: DataFrame) -> DataFrame:
    return elem.select(F.col("eid").alias("element_id"), F.col("kind").alias("n_nodes"), "n0", "n1", "n2", F.coalesce("n3", F.lit(-1)).alias("n3"))


def special_rows(special: DataFrame) -> DataFrame:
    """The special-edge table with kinds by name; a number without a name stays a number, missing B and fr are 0."""
    names = F.create_map(*[x for name, k in KINDS.items() for x in (F.lit(k), F.lit(name))])
    zero = lambda c: (F.coalesce(F.col(c), F.lit(0.0)) if c in special.columns else F.lit(0.0)).alias(c)
    return special.select("edge_id", F.coalesce(F.try_element_at(names, F.col("kind")), F.col("kind").cast("string")).alias("kind"), "zc", "H", "z_road", "qgroup", zero("B"), zero("fr"))


def building_sparse(cover: DataFrame, least: float = 0.0) -> DataFrame:
    """Faces with a ratio or a perimeter: face_id (from 1), chi, perimeter."""
    return cover.where((F.col("ratio") > least) | (F.col("perimeter") > least)).select((F.col("eid") + 1).alias("face_id"), F.col("ratio").alias("chi"), "perimeter")


def vegetation_sparse(cover: DataFrame, least: float = 0.0) -> DataFrame:
    """Faces with a vegetated share or density: face_id (from 1), chi, a, hv, cd."""
    return cover.where((F.col("chi") > least) | (F.col("a") > least)).select((F.col("eid") + 1).alias("face_id"), "chi", "a", "hv", "cd")


def cell_attributes(faces: DataFrame, land: DataFrame | None, soil: DataFrame | None, buildings: DataFrame | None, vegetation: DataFrame | None) -> DataFrame:
    """eid and all attributes of a face, 0 where an input or a face's share of it is absent."""
    out = faces.select("eid")
    for table, codes, name in ((land, LANDUSE_CODES, "land"), (soil, SOIL_CODES, "soil")):
        if table is None:
            out = out.withColumns({f"{name}_{k}": F.lit(0.0) for k in codes})
            continue
        wide = table.groupBy("eid").agg(*[F.sum(F.when(F.col("code") == k, F.col("area")).otherwise(0.0)).alias(f"{name}_{k}") for k in codes])
        out = out.join(wide, "eid", "left")
    for table, names in ((buildings, ("ratio", "perimeter")), (vegetation, ("chi", "a", "hv", "cd"))):
        out = out.withColumns({c: F.lit(0.0) for c in names}) if table is None else out.join(table.select("eid", *names), "eid", "left")
    return out.select("eid", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in out.columns if c != "eid"])


def summary_json(row: DataFrame) -> DataFrame:
    """One row of text: the summary as JSON, absent values included."""
    return row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def shapes(elem: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quality, centres) that the export rows are made from."""
    geom = quality.corners(elem, nodes)
    return quality.quality(geom), quality.centroids(geom)
