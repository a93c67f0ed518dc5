"""What the operators share: the shared folder, written tables, graph components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java and RE2 character class.
SPACE = r"[\x20\x09-\x0D]"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; only a session in one process may name none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        root = "file://" + tempfile.mkdtemp(prefix="docmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when the action ends: what they made is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Workspace:
    """A folder for one run of one operator, below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write a table and read it back: lineage ends here, and lost executors cost nothing that is written."""
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_dropped(self.spark):
            writer.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def _keyed(docs: DataFrame, key: Column) -> tuple[DataFrame, list[str]]:
    """``docs`` with its id as a string (empty for null) and a key, under names that it does not have."""
    prefix = "_own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    names = [f"{prefix}_id", f"{prefix}_key"]
    return docs.withColumns({names[0]: F.coalesce(docs["doc_id"].cast("long").cast("string"), F.lit("")), names[1]: key}), names


def _named(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(F.coalesce(F.col("_id").cast("string"), F.lit("")).alias(names[0]), F.col("_key").alias(names[1])).distinct()


def kept_once(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """One row of ``docs`` for each id and key (``_id``, ``_key``) of ``kept``, with their own columns only.

    Both steps, the join and the choice among equal rows, stand on one partitioning of ``docs``.
    """
    marked, names = _keyed(docs, key)
    return marked.join(_named(kept, names), names, "left_semi").dropDuplicates(names).select(*docs.columns)


def without(docs: DataFrame, dropped: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and key (``_id``, ``_key``) are not in ``dropped``, with their own columns only."""
    marked, names = _keyed(docs, key)
    return marked.join(_named(dropped, names), names, "left_anti").select(*docs.columns)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def components(ws: Workspace, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has long columns ``a`` and ``b``.  Returns ``node``, ``root`` for
    every node of an edge that is not itself the smallest of its component; the
    root is the smallest node.  Self loops and repeated edges are harmless; an
    empty input gives an empty result.  Both sides of every join are written
    tables, so that a node with very many edges is split at run time.
    """
    current = ws.write(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-0"
    )
    before = None
    for i in range(1, max_rounds + 1):
        both = current.union(current.select("b", "a"))
        least = ws.write(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), f"cc-large-{i}")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = ws.write(large.where("a <> b").distinct(), f"cc-half-{i}")
        low = ws.write(large.groupBy("a").agg(F.min("b").alias("m")), f"cc-small-{i}")
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after_df = ws.write(small.where("a <> b").distinct(), f"cc-{i}")
        now = after_df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        for name in (f"cc-{i - 1}", f"cc-large-{i}", f"cc-half-{i}", f"cc-small-{i}"):
            ws.drop(name)
        current = after_df
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
