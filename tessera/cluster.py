"""Session plumbing shared by every operator: shipping code, cutting lineage, sizing partitions."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so kernels import there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    folder = tempfile.mkdtemp(prefix="tessera-ship-")
    path = os.path.join(folder, "tessera_kernels.zip")
    Path(path).write_bytes(buf.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees. A local session without one (tests) gets one under /tmp; on a cluster it is an error."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        folder = "file:///tmp/checkpoints/tessera"
        sc.setCheckpointDir(folder)
    return folder


def cut_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Writes df to the shared folder as Parquet and reads it back: short lineage, no lost blocks.

    What a failed write leaves behind is removed; a whole one stays until drop_cut, as its readers are lazy. Tables of
    one path (of cut_path) are put together. group_rows: for long rows, as a reader holds up to 4096 rows of a row group;
    the bytes of a group don't bound them, as they count after compression.
    """
    spark = df.sparkSession
    path = path or cut_path(spark)
    options = {"compression": "zstd"} | ({"parquet.block.row.count.limit": str(group_rows)} if group_rows else {})
    try:
        df.write.mode("append").options(**options).parquet(path)
    except Exception:
        _remove(spark, path)
        raise
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_cut(df: DataFrame) -> None:
    """Removes a table made by cut() once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tessera-" in folder:
            _remove(spark, folder)


def spread(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the mesh: it is met by sort and merge, never by a table built in the driver."""
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now rather than at the next full collection."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
