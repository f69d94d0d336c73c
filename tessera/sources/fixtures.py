"""A surface mesh derived from the driver's tables by integer formulas: 50 cells a row, quads or pairs of triangles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f (cell), r, c (row and column), triangular, o_custkey."""
    f = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(f.cast("long").alias("f"), ((f - f % 50) / 50).cast("long").alias("r"), (f % 50).cast("long").alias("c"), (F.col("o_orderstatus") == "F").alias("triangular"), "o_custkey")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """eid, kind (3 or 4), n0..n3 counter-clockwise (n3 null for triangles)."""
    a = F.col("r") * 51 + F.col("c")
    d = (F.col("r") + 1) * 51 + F.col("c")
    b, e, none = a + 1, d + 1, F.lit(None).cast("long")
    quad = F.struct((F.col("f") * 2).alias("eid"), F.lit(4).alias("kind"), a.alias("n0"), b.alias("n1"), e.alias("n2"), d.alias("n3"))
    low = F.struct((F.col("f") * 2).alias("eid"), F.lit(3).alias("kind"), a.alias("n0"), b.alias("n1"), e.alias("n2"), none.alias("n3"))
    high = F.struct((F.col("f") * 2 + 1).alias("eid"), F.lit(3).alias("kind"), a.alias("n0"), e.alias("n1"), d.alias("n2"), none.alias("n3"))
    return cells(spark, sf_dir).select(F.explode(F.when(F.col("triangular"), F.array(low, high)).otherwise(F.array(quad))).alias("e")).select("e.*")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, x, y of every node that an element uses."""
    ids = elements(spark, sf_dir).select(F.explode(F.array("n0", "n1", "n2", "n3")).alias("id")).where("id is not null").distinct()
    i, j = F.col("id") % 51, (F.col("id") - F.col("id") % 51) / 51
    return ids.select("id", (40 * i + F.col("id") * 7919 % 17 - 8).cast("double").alias("x"), (40 * j + F.col("id") * 104729 % 19 - 9).cast("double").alias("y"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation samples: face, dx, dy from the face's centre, z."""
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.col("l_orderkey").cast("long").alias("face"), (F.col("l_partkey") % 41 - 20).cast("double").alias("dx"), (F.col("l_suppkey") * 7 % 41 - 20).cast("double").alias("dy"), F.col("l_quantity").cast("double").alias("z"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """face, block (from 1): the region of a cell's customer."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_regionkey").alias("region"))
    return cells(spark, sf_dir).join(customer, "o_custkey").join(F.broadcast(nation), "n").select(F.col("f").alias("face"), (F.col("region") + 1).cast("int").alias("block"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land-use pixels: face, code, weight 1."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("face"), F.col("l_linenumber").cast("int").alias("code"), F.lit(1.0).alias("weight"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size field: iy, ix, value, floor, attempts, one cell for each mesh cell."""
    f = F.col("f")
    return cells(spark, sf_dir).select(F.col("r").alias("iy"), F.col("c").alias("ix"), (20 + f * 31 % 97).cast("double").alias("value"), (5 + f * 13 % 11).cast("double").alias("floor"), (f % 4).cast("int").alias("attempts"))


def vertices(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """Polylines: line, i, x, y of ``n`` vertices for each supplier."""
    k, i = F.col("line"), F.col("i")
    t = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("line"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    return t.select("line", "i", (k * 97 % 2000 + i * 45 + k * (i + 3) % 23).cast("double").alias("x"), (k * 61 % 3000 + k * (i * i + 1) % 57).cast("double").alias("y"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as line, layer, strict, pts."""
    pts = F.transform(F.array_sort(F.collect_list(F.struct("i", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    t = vertices(spark, sf_dir).groupBy("line").agg(pts.alias("pts"))
    return t.select("line", F.when(F.col("line") % 3 == 0, "levees").otherwise("roads").alias("layer"), (F.col("line") % 7 == 0).alias("strict"), "pts")


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-cornered rings, counter-clockwise: ring, i, x, y."""
    corners = ((60, 0), (30, 50), (-25, 45), (-60, 5), (-35, -50), (28, -55))
    at = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("dx"), F.lit(y).alias("dy")) for i, (x, y) in enumerate(corners)])
    k = F.col("ring")
    t = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("ring"), F.explode(at).alias("p")).select("ring", "p.*")
    return t.select("ring", "i", (k * 89 % 2000 + F.col("dx") * (1 + k % 4) + k * (F.col("i") + 1) % 13).cast("double").alias("x"), (k * 71 % 3000 + F.col("dy") * (1 + k % 4) + k * (F.col("i") + 2) % 11).cast("double").alias("y"))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as polygon, ring, holes."""
    pts = F.transform(F.array_sort(F.collect_list(F.struct("i", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return rings(spark, sf_dir).groupBy(F.col("ring").alias("polygon")).agg(pts.alias("ring")).withColumn("holes", F.array().cast("array<array<struct<x:double,y:double>>>"))
