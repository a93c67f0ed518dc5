"""Tables below a root folder: versioned snapshots, and tables that cut a run's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``; only a session in one process may name none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not root and master.startswith("local") and not master.startswith("local-cluster"):
        root = "file://" + tempfile.mkdtemp(prefix="docmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


class Work:
    """Tables of one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write and read back: what is written is computed once and outlives its executors."""
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        remove(self.spark, f"{self.path}/{name}")

    def clear(self) -> None:
        remove(self.spark, self.path)


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete snapshots below a folder, rising."""
    path, fs = _path(spark, root)
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[1:]) for n in found if n[:1] == "v" and n[1:].isdigit() and exists(spark, f"{root}/{n}/_SUCCESS"))


def snapshot(spark: SparkSession, root: str, schema: str | None = None, number: int | None = None) -> DataFrame | None:
    """A snapshot (the last by default); without one, an empty table of ``schema`` or None."""
    there = versions(spark, root)
    if number is not None:
        there = [n for n in there if n <= number]
    if there:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(f"{root}/v{there[-1]:09d}")
    return None if schema is None else spark.createDataFrame([], schema)


def commit(spark: SparkSession, root: str, df: DataFrame, number: int | None = None, keep: int = 2) -> int:
    """Write the next snapshot (or that of ``number``, again if it is there) and delete all but the last ``keep``."""
    there = versions(spark, root)
    number = (there[-1] + 1 if there else 0) if number is None else number
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/v{number:09d}")
    for old in versions(spark, root)[:-keep]:
        remove(spark, f"{root}/v{old:09d}")
    return number
