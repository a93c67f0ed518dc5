"""Change classification and keyed merges, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def classify(items: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """Adds outcome (dropped, inserted, updated, unchanged) and reason to items(identifier, file_hash, size, ext, ..).

    A second sighting within the run is compared with the hash just seen; ``known``
    has identifier and file_hash of earlier runs.
    """
    reason = F.when(F.coalesce("size", F.lit(0)) == 0, "empty_body").when(F.col("ext").isNull(), "unsupported_content_type")
    marked = items.withColumn("reason", reason)
    run = W.partitionBy("identifier", F.col("reason").isNull()).orderBy(*order)
    seen = marked.withColumns({"_before": F.lag("file_hash").over(run), "_nth": F.row_number().over(run)})
    old = known.select("identifier", F.col("file_hash").alias("_known"), F.lit(True).alias("_hit"))
    joined = seen.join(old, "identifier", "left")
    existed = (F.col("_nth") > 1) | F.col("_hit").isNotNull()
    same = F.when(F.col("_nth") > 1, F.col("_before")).otherwise(F.col("_known")).eqNullSafe(F.col("file_hash"))
    outcome = F.when(F.col("reason").isNotNull(), "dropped").when(~existed, "inserted").when(same, "unchanged").otherwise("updated")
    return joined.withColumn("outcome", outcome).drop("_before", "_nth", "_known", "_hit")


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row of every key."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_rank = 1").drop("_rank")


def merge(target: DataFrame, source: DataFrame, key: str, insert_only: tuple[str, ...] = ()) -> DataFrame:
    """Source rows replace target rows of the same key; ``insert_only`` columns keep the target's value."""
    s, t = source.alias("s"), target.alias("t")
    hit = F.col(f"s.{key}").isNotNull()
    pick = lambda c: F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")) if c in insert_only or c == key else F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*[pick(c).alias(c) for c in target.columns])
