"""Written tables in the folder all executors share; they cut lineage and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset and all runs in this process, as in tests, a folder of our own.

    On a cluster each machine would have another such folder, so there it is an error to leave it unset.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loomstead-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


class Cuts:
    """Tables written by one operator run. ``drop`` frees one early; the rest go when the driver's JVM ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/loomstead/{label}-{uuid.uuid4().hex}"
        self.count = 0
        path, fs = _path(spark, self.base)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def cut(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write ``df`` and return the written table; ``.cut_path`` of the result names its folder."""
        self.count += 1
        name = f"{self.base}/{self.count:03d}-{label}"
        df.write.parquet(name)
        out = self.spark.read.schema(df.schema).parquet(name)
        out.cut_path = name
        return out

    def drop(self, df: DataFrame | None) -> None:
        name = getattr(df, "cut_path", None)
        if name:
            path, fs = _path(self.spark, name)
            fs.delete(path, True)
