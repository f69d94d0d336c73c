"""Consistent renumbering of a packed mesh and all its attribute tables by permutations (old, new), ids from 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import ordering, topology


def inverse(order: DataFrame) -> DataFrame:
    """old and new exchanged."""
    return order.select(F.col("new").alias("old"), F.col("old").alias("new"))


def moved(df: DataFrame, column: str, order: DataFrame, zero: bool = True) -> DataFrame:
    """df with an id column through a permutation; 0 stays 0 if zero, any other id that it lacks is an error."""
    out = df.join(order.select(F.col("old").alias(column), F.col("new").alias("new__")), column, "left")
    wrong = F.raise_error(F.concat(F.lit(f"{column} out of range: "), F.col(column).cast("string"))).cast("long")
    fresh = F.when(F.col("new__").isNotNull(), F.col("new__"))
    fresh = fresh.when(F.col(column) == 0, F.lit(0)).otherwise(wrong) if zero else fresh.otherwise(wrong)
    return out.withColumn(column, fresh.cast(df.schema[column].dataType)).drop("new__").select(*df.columns)


def face_table(df: DataFrame, faces: DataFrame, column: str = "face_id") -> DataFrame:
    """Land use, soil, building or vegetation rows with renumbered faces."""
    return moved(df, column, faces, zero=False)


def edge_table(df: DataFrame, edges: DataFrame, column: str = "edge_id") -> DataFrame:
    """Special-edge or coupling rows with renumbered edges."""
    return moved(df, column, edges)


def mesh(nodes: DataFrame, edges: DataFrame, faces: DataFrame, face_order: DataFrame) -> dict[str, DataFrame]:
    """node, edge and face tables renumbered by a new face order, and the permutations: faces, edges, vertices.

    Vertices follow the first face that touches them, edges their lower and upper face. edges: ln, v1, v2, face_left,
    face_right and more; faces: id, edge_ids and more; face_order: old, new.
    """
    placed = moved(moved(edges, "face_left", face_order), "face_right", face_order)
    vertex = ordering.vertex_order(placed).select(F.col("vertex").alias("old"), "new")
    edge = ordering.edge_order(placed).select(F.col("ln").alias("old"), "new")
    out_edges = moved(moved(moved(placed, "v1", vertex), "v2", vertex), "ln", edge)
    ids = faces.select("id", F.posexplode("edge_ids").alias("k", "ln"))
    lists = moved(ids, "ln", edge).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "ln"))), lambda s: s["ln"]).alias("edge_ids"))
    out_faces = moved(faces.drop("edge_ids").join(lists, "id"), "id", face_order, zero=False)
    # a vertex that no edge holds keeps the end of the order
    return {"node": moved(nodes.join(vertex.select(F.col("old").alias("id")), "id", "left_semi"), "id", vertex, zero=False), "edge": out_edges, "face": out_faces, "faces": face_order, "edges": edge, "vertices": vertex}


def aligned(rows: DataFrame, centres: DataFrame, order: DataFrame, tolerance: float = 1e-3, column: str = "CN") -> DataFrame:
    """Export rows with renumbered cells, if their centres agree with the renumbered mesh's within tolerance, else an error.

    rows: CN, xcoord, ycoord and more, by old numbers; centres: id (new number), x, y.
    """
    at = centres.select(F.col("id").alias("new__"), F.col("x").alias("mx"), F.col("y").alias("my"))
    t = rows.join(order.select(F.col("old").alias(column), F.col("new").alias("new__")), column).join(at, "new__")
    far = F.greatest(F.abs(F.col("xcoord") - F.col("mx")), F.abs(F.col("ycoord") - F.col("my"))) > tolerance
    ok = F.when(far, F.raise_error(F.lit("a cell's centre isn't where the mesh has it")).cast("long")).otherwise(F.col("new__"))
    return t.withColumn(column, ok.cast(rows.schema[column].dataType)).select(*rows.columns)


def constrained_nodes(constrained: DataFrame) -> DataFrame:
    """id of the nodes on constrained edges (lo, hi)."""
    return constrained.select(F.explode(F.array("lo", "hi")).alias("id")).distinct()


def constrained_edges(curves: DataFrame) -> DataFrame:
    """Distinct undirected edges (lo, hi) of curve elements (na, nb); one whose ends are equal isn't an edge."""
    return curves.where("na <> nb").select(F.least("na", "nb").alias("lo"), F.greatest("na", "nb").alias("hi")).distinct()


def live_constraints(half: DataFrame, constrained: DataFrame) -> DataFrame:
    """One row: how many constrained edges there are and how many still are a side of some element."""
    held = constrained.select("lo", "hi").distinct().join(topology.edges(half).select("lo", "hi", F.lit(1).alias("live")), ["lo", "hi"], "left")
    return held.agg(F.count("*").alias("constrained"), F.count("live").alias("live"))


def band_elements(elem: DataFrame, roles: DataFrame) -> DataFrame:
    """eid of elements (eid, surface) whose surface's role (tag, role) is quad_boundary."""
    return elem.join(roles.where("role = 'quad_boundary'").select(F.col("tag").alias("surface")), "surface", "left_semi").select("eid")
