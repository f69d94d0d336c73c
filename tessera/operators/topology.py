"""Half-edges, edges, neighbours and boundaries. Two elements are neighbours if they share an edge, not a vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.cluster import cut, spread


def half_edges(elem: DataFrame) -> DataFrame:
    """eid, k, na, nb for each side of each element, in its order."""
    sides = F.when(F.col("kind") == 3, F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{k}").alias("na"), F.col(f"n{(k + 1) % 3}").alias("nb")) for k in range(3)]))
    sides = sides.otherwise(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{k}").alias("na"), F.col(f"n{(k + 1) % 4}").alias("nb")) for k in range(4)]))
    return elem.select("eid", F.explode(sides).alias("s")).select("eid", "s.k", "s.na", "s.nb")


def keyed(half: DataFrame) -> DataFrame:
    return half.withColumn("lo", F.least("na", "nb")).withColumn("hi", F.greatest("na", "nb"))


def edges(half: DataFrame) -> DataFrame:
    """lo, hi, uses: distinct undirected edges and how many sides lie on each."""
    return keyed(half).groupBy("lo", "hi").agg(F.count("*").alias("uses"))


def adjacency(half: DataFrame) -> DataFrame:
    """e0 < e1 of each edge used exactly twice; other uses are no adjacency."""
    pairs = keyed(half).groupBy("lo", "hi").agg(F.count("*").alias("n"), F.min("eid").alias("e0"), F.max("eid").alias("e1"))
    return pairs.where("n = 2").select("e0", "e1")


def neighbours(half: DataFrame) -> DataFrame:
    """half with neighbour: the other element of an edge of two sides and two elements, -1 for any other edge."""
    ends = keyed(half).groupBy("lo", "hi").agg(F.count("*").alias("n"), F.min("eid").alias("e0"), F.max("eid").alias("e1"))
    other = F.when((F.col("n") == 2) & (F.col("e0") != F.col("e1")), F.when(F.col("eid") == F.col("e0"), F.col("e1")).otherwise(F.col("e0"))).otherwise(F.lit(-1))
    return keyed(half).join(spread(ends), ["lo", "hi"]).select("eid", "k", "na", "nb", other.cast("long").alias("neighbour"))


def boundary_nodes(half: DataFrame) -> DataFrame:
    """id of nodes on an edge that one element alone uses."""
    return edges(half).where("uses = 1").select(F.explode(F.array("lo", "hi")).alias("id")).distinct()


def boundary_touching(half: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """eid of elements with a side whose both ends are boundary nodes, or in the band (eid)."""
    nodes = spread(boundary_nodes(half))
    found = half.join(nodes.withColumnRenamed("id", "na"), "na", "left_semi").join(nodes.withColumnRenamed("id", "nb"), "nb", "left_semi").select("eid")
    return (found if band is None else found.unionByName(band.select("eid"))).distinct()


def used_nodes(elem: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes that some element uses, renumbered from 0 in order of id: id, new_id, x, y."""
    used = elem.select(F.explode(F.array("n0", "n1", "n2", "n3")).alias("id")).where("id is not null").distinct()
    return dense_ids(nodes.join(used, "id", "left_semi"), ["id"], "new_id", first=0)


def dense_ids(df: DataFrame, keys: list[str], name: str, first: int = 1) -> DataFrame:
    """Adds consecutive numbers in the order of unique keys without bringing all rows into one task.

    Rows are dealt by range of the keys, numbered in their partition, and offset by the rows of the ranges before it;
    only one count a partition meets in one place.
    """
    placed = df.repartitionByRange(*[F.col(k) for k in keys]).withColumn("part__", F.spark_partition_id())
    placed = cut(placed)  # the ranges come from a sample: they must not be drawn again
    counts = placed.groupBy("part__").agg(F.count("*").alias("n__"))
    before = F.sum("n__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part__", F.coalesce(before, F.lit(0)).alias("off__"))
    rank = F.row_number().over(Window.partitionBy("part__").orderBy(*keys))
    return placed.join(F.broadcast(offsets), "part__").withColumn(name, (F.col("off__") + rank - 1 + first).cast("long")).drop("part__", "off__")


def line_ids(half: DataFrame) -> DataFrame:
    """lo, hi, ln: edges numbered from 1 in order of (lo, hi)."""
    return dense_ids(edges(half).select("lo", "hi"), ["lo", "hi"], "ln")
