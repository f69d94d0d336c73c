"""CSV sources and sinks of the solver's tables, and work folders of section files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.operators import special
from tessera.operators.export import special_rows

SPECIAL = ("edge_id", "kind", "zc", "H", "z_road", "qgroup", "B", "fr")
COUPLE = ("edge_id", "river_link", "kp", "bank")


def write_csv(df: DataFrame, path: str, places: int | None = 6, one_file: bool = False) -> None:
    """Writes a table as CSV with a header, doubles with ``places`` decimals. Each partition is a file unless one_file."""
    if places is not None:
        df = df.select(*[F.format_string(f"%.{places}f", F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`") for f in df.schema])
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def text_table(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The named columns of a CSV as text, blank ones null; a file that is missing or empty is an empty table."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    blank = lambda c: F.when(F.trim(F.col(f"`{c}`")) != "", F.trim(F.col(f"`{c}`"))) if c in found.columns else F.lit(None).cast("string")
    return found.select(*[blank(c).alias(c) for c in columns]).where(" or ".join(f"`{c}` is not null" for c in columns))


def read_special_edges(spark: SparkSession, path: str) -> DataFrame:
    """edge_id, kind (number), zc, H, z_road, qgroup, B, fr; blank numbers are 0, an unknown kind is an error."""
    t = special.parsed_kinds(text_table(spark, path, SPECIAL).withColumn("kind", F.coalesce("kind", F.lit("NONE"))), "kind", "kind_no")
    num = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    return t.select(F.col("edge_id").cast("int").alias("edge_id"), F.col("kind_no").alias("kind"), num("zc"), num("H"), num("z_road"), F.coalesce(F.col("qgroup").cast("double"), F.lit(0.0)).cast("int").alias("qgroup"), num("B"), num("fr"))


def write_special_edges(table: DataFrame, path: str, one_file: bool = False) -> None:
    write_csv(special_rows(table), path, places=None, one_file=one_file)


def read_couples(spark: SparkSession, path: str) -> DataFrame:
    """edge_id, river_link, kp, bank (1 left, 2 right); a blank kp is 0, a blank bank left, an unknown one an error."""
    t = text_table(spark, path, COUPLE)
    return t.select(F.col("edge_id").cast("int").alias("edge_id"), F.col("river_link").cast("int").alias("river_link"), F.coalesce(F.col("kp").cast("double"), F.lit(0.0)).alias("kp"), special.bank(F.coalesce("bank", F.lit("1"))).alias("bank"))


def write_couples(table: DataFrame, path: str, one_file: bool = False) -> None:
    write_csv(table.select(*COUPLE), path, places=None, one_file=one_file)


def read_blocks(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of every block_*/<name> below a folder, with block from 1 by the folder's number."""
    from tessera.operators.export import block_of_folder

    found = spark.read.option("header", True).option("inferSchema", True).option("basePath", folder).csv(f"{folder}/block_*/{name}")
    folder_name = F.element_at(F.split(F.input_file_name(), "/"), -2 if name.endswith(".csv") else -3)
    return found.withColumn("block", block_of_folder(folder_name))


def append_log(steps: DataFrame, path: str) -> None:
    """Adds refinement steps to a log of one row each."""
    steps.write.mode("append").option("header", True).csv(path)


def file_hashes(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """name, hash: 16 bytes of SHA-256 of each named file of a folder; zeros for a missing or empty one."""
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    found = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.unhex(F.substring(F.sha2("content", 256), 1, 32)).alias("h"))
    zeros = F.unhex(F.lit("00" * 16))
    return wanted.join(found, "name", "left").select("name", F.when(F.coalesce("length", F.lit(0)) > 0, F.col("h")).otherwise(zeros).alias("hash"))


def log_schema(rules: list[str]) -> StructType:
    """Columns of a refinement log: the step's counts, then one for each rule."""
    return StructType([StructField(c, IntegerType()) for c in ("iteration", "n_elements", "n_triangles", "n_quads")] + [StructField(r, IntegerType()) for r in rules])
