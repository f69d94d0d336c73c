"""Mesh files as text: the ASCII .msh format of version 2.2 in and out, and .vtu out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the formats: element kinds by number of corners.
MSH_KINDS, VTK_KINDS = {2: 3, 3: 4}, {3: 5, 4: 9}


class MeshFileError(ValueError):
    """A mesh file without two-dimensional cells, or that can't be read."""


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(elements, nodes) of .msh files: eid from 0, triangles first, kind, n0..n3 and surface; id from 0, x, y, z.

    Lines are told apart by the section that they lie in: the last $ line before them in their file. Only the $ lines, a
    few, meet in one place; a file is read in splits, and a line's place is its split's start and its number there.
    """
    raw = spark.read.text(path).select("_metadata.file_path", F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("number")).alias("at"), F.regexp_replace("value", r"\r$", "").alias("line"))
    marks = raw.where("startswith(line, '$')").select("file_path", "at", F.trim("line").alias("section"))
    w = Window.partitionBy("file_path").orderBy("at")  # a row for each $ line
    spans = marks.withColumn("until", F.lead("at").over(w))
    inside = (F.col("at") > F.col("from")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    rows = raw.where("not startswith(line, '$') and trim(line) <> ''").join(F.broadcast(spans.withColumnsRenamed({"at": "from", "file_path": "of"})), (F.col("file_path") == F.col("of")) & inside)
    # words hang on the span too: the planner may test them on pairs of a line and another section
    words = lambda section: rows.withColumn("p", F.when((F.col("section") == section) & inside, F.split(F.trim("line"), r"\s+")))
    num = lambda i, t="long": F.get("p", F.lit(i)).cast(t)
    nodes = words("$Nodes").where("size(p) = 4").select(num(0).alias("tag"), num(1, "double").alias("x"), num(2, "double").alias("y"), num(3, "double").alias("z"))
    head = num(2).cast("int")
    cells = words("$Elements").where("size(p) > 3").select(num(0).alias("tag"), num(1).alias("kind"), F.when(head > 1, num(4)).otherwise(F.lit(0)).cast("int").alias("surface"), F.expr("slice(p, int(p[2]) + 4, size(p))").alias("c")).where("kind in (2, 3)")
    return numbered(cells.select("tag", F.when(F.col("kind") == 2, 3).otherwise(4).alias("kind"), "surface", *[F.get("c", F.lit(i)).cast("long").alias(f"t{i}") for i in range(4)]), nodes)


def numbered(cells: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dense numbers from 0 for tagged cells (tag, kind, surface, t0..t3) and the nodes (tag, x, y, z) that they use."""
    from tessera.operators.topology import dense_ids

    if not cells.limit(1).count():
        raise MeshFileError("no triangles or quads")
    used = cells.select(F.explode(F.array("t0", "t1", "t2", "t3")).alias("tag")).where("tag is not null").distinct()
    at = dense_ids(nodes.join(used, "tag", "left_semi"), ["tag"], "n").withColumn("id", F.col("n") - 1)
    out = dense_ids(cells, ["kind", "tag"], "e").withColumn("eid", F.col("e") - 1)
    place = at.select("tag", "id")
    for i in range(4):
        out = out.join(place.select(F.col("tag").alias(f"t{i}"), F.col("id").alias(f"n{i}")), f"t{i}", "left")
    return out.select("eid", "kind", "surface", "n0", "n1", "n2", "n3"), at.select("id", "x", "y", "z")


def lines(elem: DataFrame, nodes: DataFrame) -> DataFrame:
    """part, seq, value: the lines of a .msh file, in the order of part and seq."""
    spark = elem.sparkSession
    n = {"nodes": nodes.count(), "cells": elem.count()}
    fixed = [(0, 0, "$MeshFormat"), (0, 1, "2.2 0 8"), (0, 2, "$EndMeshFormat"), (1, 0, "$Nodes"), (1, 1, str(n["nodes"])), (3, 0, "$EndNodes"), (4, 0, "$Elements"), (4, 1, str(n["cells"])), (6, 0, "$EndElements")]
    z = F.coalesce(F.col("z"), F.lit(0.0)) if "z" in nodes.columns else F.lit(0.0)
    points = nodes.select(F.lit(2).alias("part"), F.col("id").alias("seq"), F.concat_ws(" ", F.col("id") + 1, "x", "y", z).alias("value"))
    surface = F.col("surface") if "surface" in elem.columns else F.lit(1)
    cells = elem.select(F.lit(5).alias("part"), F.col("eid").alias("seq"), F.concat_ws(" ", F.col("eid") + 1, F.when(F.col("kind") == 3, 2).otherwise(3), F.lit(2), surface, surface, *[F.col(f"n{i}") + 1 for i in range(4)]).alias("value"))
    return spark.createDataFrame(fixed, "part int, seq long, value string").unionByName(points).unionByName(cells)


def write(elem: DataFrame, nodes: DataFrame, path: str) -> None:
    """A .msh file in one part."""
    lines(elem, nodes).orderBy("part", "seq").select("value").coalesce(1).write.mode("overwrite").text(path)


def vtu_lines(elem: DataFrame, nodes: DataFrame, data: DataFrame | None = None) -> DataFrame:
    """part, seq, value: the lines of a .vtu file; data has eid and a column for each cell array."""
    spark = elem.sparkSession
    arrays = [c for c in data.columns if c != "eid"] if data is not None else []
    n_nodes, n_cells = nodes.count(), elem.count()
    z = F.coalesce(F.col("z"), F.lit(0.0)) if "z" in nodes.columns else F.lit(0.0)
    open_ = lambda name, type_, more="": f'<DataArray type="{type_}" Name="{name}"{more} format="ascii">'
    fixed = [(0, '<VTKFile type="UnstructuredGrid" version="0.1" byte_order="LittleEndian"><UnstructuredGrid>'), (1, f'<Piece NumberOfPoints="{n_nodes}" NumberOfCells="{n_cells}"><Points>' + open_("Points", "Float64", ' NumberOfComponents="3"')), (3, "</DataArray></Points><Cells>" + open_("connectivity", "Int64")), (5, "</DataArray>" + open_("offsets", "Int64")), (7, "</DataArray>" + open_("types", "UInt8")), (9, "</DataArray></Cells><CellData>")]
    fixed += [x for i, c in enumerate(arrays) for x in ((10 + 3 * i, open_(c, "Float64")), (12 + 3 * i, "</DataArray>"))]
    fixed += [(10 + 3 * len(arrays), "</CellData></Piece></UnstructuredGrid></VTKFile>")]
    out = spark.createDataFrame([(p, 0, v) for p, v in fixed], "part int, seq long, value string")
    out = out.unionByName(nodes.select(F.lit(2).alias("part"), F.col("id").alias("seq"), F.concat_ws(" ", "x", "y", z).alias("value")))
    corners = F.concat_ws(" ", *[F.col(f"n{i}") for i in range(4)])
    triangles = elem.where("kind = 3").count()
    # triangles come first, so a cell's last corner follows from its number
    offset = F.when(F.col("kind") == 3, 3 * (F.col("eid") + 1)).otherwise(3 * triangles + 4 * (F.col("eid") + 1 - triangles))
    for part, value in ((4, corners), (6, offset.cast("string")), (8, F.when(F.col("kind") == 3, "5").otherwise("9"))):
        out = out.unionByName(elem.select(F.lit(part).alias("part"), F.col("eid").alias("seq"), value.alias("value")))
    for i, c in enumerate(arrays):
        out = out.unionByName(data.select(F.lit(11 + 3 * i).alias("part"), F.col("eid").alias("seq"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).cast("string").alias("value")))
    return out
