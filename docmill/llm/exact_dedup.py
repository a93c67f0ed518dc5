"""Exact dedup with a heavy-hitter split.

Frequent digests would make one reducer read a large share of all rows.  A
Misra-Gries summary per partition finds every digest that could be frequent;
their exact counts are verified with map-side aggregation, and the verified
winners (at most ``counters`` of them, a proven bound) are broadcast, so that
their rows are resolved where they are read.  The remaining digests, none of
which has more than ``2 / (counters + 1)`` of the rows, use an ordinary shuffle.

Defined cases: a null text counts as empty; a null ``doc_id`` sorts after every
number; of equal rows (same id and text) exactly one stays; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, Workspace, kept_once, load, text_or_empty


def normalised(df: DataFrame):
    """Runs of ASCII white space become one space."""
    return F.regexp_replace(text_or_empty(df), SPACE + "+", " ")


def text_digest(df: DataFrame):
    return F.unhex(F.sha2(normalised(df), 256))


def misra_gries(counts: dict, more: dict, counters: int) -> dict:
    """Merge exact counts into a summary and cut it to ``counters`` entries.

    The classical weighted decrement: subtract the (counters + 1)-th largest
    count from all and drop what is not positive.  An entry is never too high,
    and too low by at most total / (counters + 1).
    """
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {key: n - cut for key, n in counts.items() if n > cut}


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            kept = misra_gries(kept, dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)), counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], names=["digest", "low"])

    return run


def exact_dedup(spark: SparkSession, docs: DataFrame, counters: int = 1023) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest (binary) for every row of ``docs``."""
    ws = Workspace(spark, "exact-dedup")
    rows = ws.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(docs).alias("digest")).withColumn("row", F.monotonically_increasing_id()), "rows")
    total = rows.count()
    low = rows.select("digest").mapInArrow(_summaries(counters), "digest binary, low long").groupBy("digest").agg(F.sum("low").alias("low"))
    # lower bounds sum to at most the number of rows, so no more than counters + 1 digests pass
    able = ws.write(low.where(F.col("low") >= max(1, total // (counters + 1))).select("digest"), "able")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("o"), F.col("row"), F.col("doc_id"))
    winners = ws.write(
        rows.join(F.broadcast(able), "digest").groupBy("digest").agg(F.count("*").alias("group_size"), F.min(order).alias("first")).where(F.col("group_size") >= max(2, math.ceil(2 * total / (counters + 1)))),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), "digest").select("doc_id", "row", "digest", "group_size", "first")
    group = W.partitionBy("digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "doc_id", "row", "digest", F.count("*").over(group).alias("group_size"), F.min(order).over(group).alias("first")
    )
    return hot.union(rest).select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest")


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only."""
    kept = exact_dedup(spark, docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_key"))
    return kept_once(docs, kept, text_digest(docs))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, load(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLES = {
    "op8_exact_dedup": r"""
        with d as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256,
                   row_number() over (order by doc_id nulls last) as r
            from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
               r = first_value(r) over w as kept, text_sha256
        from d window w as (partition by text_sha256 order by r)
    """
}
