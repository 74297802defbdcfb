"""Named snapshots of frames, and intermediate tables that cut a plan's lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Row groups of wide rows: at most 512 of them, and at most 16 MB as written.
WIDE = {"parquet.block.row.count.limit": 512, "parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 10}


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists in its Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with all below it in its Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set (a local test session) a folder in the warehouse is used; a cluster must name
    one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame, wide: bool = False) -> DataFrame:
    """The frame, written to the shared folder and read back.

    This cuts the lineage like ``df.checkpoint()``, so a lost executor costs no earlier step. As a
    table it also has a known size, by which later joins pick their strategy, and it carries no
    constraints of the plan that made it. The files stay until the folder is cleared, since the
    returned frame is read lazily.

    A reader decodes up to 4,096 rows of a row group at once, which is too much for ``wide`` rows of many kilobytes; their row
    groups are cut as ``WIDE`` says. (Bytes alone do not bound them: repeated values take few when written, all when read.)
    """
    path = f"{checkpoint_folder(df.sparkSession)}/postmill-{uuid.uuid4().hex}"
    df.write.options(**(WIDE if wide else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Checkpoints:
    """Frames saved by name as Parquet below one base path."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write the frame and return it as read back, so later steps do not recompute it."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def pull(self, name: str) -> DataFrame | None:
        """The named frame, or None."""
        return self.spark.read.parquet(self.path(name)) if path_exists(self.spark, self.path(name)) else None

    def pull_latest(self) -> DataFrame | None:
        """The frame that was saved last, or None when there is none."""
        if not path_exists(self.spark, self.base):
            return None
        base = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        entries = base.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(base)
        saved = [(e.getModificationTime(), e.getPath().getName()) for e in entries if e.isDirectory()]
        return self.pull(max(saved)[1]) if saved else None
