"""Whole runs over tables below a root: transform with its sinks, partition by partition, and the summary of logs."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..config import EngineConfig
from ..functions import text as tx
from ..operators import calendar, checks, summaries
from ..sources import events
from ..streaming import ingest
from . import transform as tr

log = logging.getLogger("docmill.runs")
LANDING_COLUMNS = ("identifier", "body", "body_id", "partition_date", "partition_end", "date", "bucket", "file_path", "file_hash", "content_type", "payload")


def run_transform(spark: SparkSession, root: str, start: date, end: date, body_ids: list[int] | None = None, now: datetime | None = None, config: EngineConfig = EngineConfig(), strict: bool = False) -> dict[str, int]:
    """Transform a range of landing partitions into the tables below ``root``; counts of outcomes and ``found``.

    Metadata are snapshots, contents and texts are appended under their keys, and events
    are appended as JSON lines.  A failed write raises before the snapshots change.
    """
    names = config.body_names(body_ids)  # errors in the arguments come before anything is read
    if end < start:
        raise ValueError("end is before start")
    landing = storage.snapshot(spark, f"{root}/{config.landing_table}")
    if landing is None:
        raise ValueError(f"no landing table below {root}")
    if "payload" not in landing.columns and storage.exists(spark, f"{root}/{config.landing_bucket}"):
        landing = with_contents(landing, spark.read.parquet(f"{root}/{config.landing_bucket}"))
    if missing := checks.missing_columns(LANDING_COLUMNS, landing):
        raise ValueError(f"the landing table lacks {', '.join(missing)}")
    now = now or datetime.now()
    processed = storage.snapshot(spark, f"{root}/{config.processed_table}", tr.PROCESSED)
    quarantine = storage.snapshot(spark, f"{root}/{config.quarantine_table}", tr.QUARANTINE)
    rows = tr.in_range(landing, start, end, names, strict, config.partition_size)
    log.info("transform_started", extra={"event": "transform_started", "range_start": start, "range_end": end, "bodies": names, "transform_version": config.transform_version})
    result = tr.transform(spark, rows, processed, quarantine, now, config)
    write_contents(result, f"{root}/{config.processed_bucket}")
    after, held = tr.merged(processed, result), tr.settle(quarantine, result)
    storage.commit(spark, f"{root}/{config.processed_table}", after)
    storage.commit(spark, f"{root}/{config.quarantine_table}", held)
    result.events().write.mode("append").text(f"{root}/logs")
    counts = result.summary().where("body is null").first()
    stats = {c: int(counts[c]) if counts else 0 for c in summaries.TRANSFORM}
    stats["found"] = result.found
    result.work.clear()
    log.info("transform_summary", extra={"event": "transform_summary", **stats})
    return stats


def with_contents(landing: DataFrame, contents: DataFrame) -> DataFrame:
    """Landing rows with the payload that was appended under their key; null where there is none."""
    blobs = contents.select(F.col("key").alias("file_path"), "payload").dropDuplicates(["file_path"])
    return landing.join(blobs, "file_path", "left").select(*landing.columns, "payload")


def run_ingest(spark: SparkSession, root: str, items_path: str, start: date, end: date, body_ids: list[int] | None = None, now: datetime | None = None, config: EngineConfig = EngineConfig(), strict: bool = False) -> dict[str, int]:
    """Ingest the fetched items of a range of partitions as one batch; counts of outcomes over all partitions."""
    names = config.body_names(body_ids)
    items = tr.in_range(spark.read.parquet(items_path), start, end, names, strict, config.partition_size)
    summary = ingest.ingest(spark, items, root, now or datetime.now(), config=config)
    counts = summary.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("found", *summaries.INGEST)]).first().asDict()
    log.info("storage_summary", extra={"event": "storage_summary", **counts})
    return counts


def write_contents(result: tr.TransformResult, path: str) -> None:
    """Append contents and their text siblings: key, hash, MIME type and bytes."""
    made = result.processed
    contents = made.select(F.col("file_path").alias("key"), F.col("file_hash").alias("hash"), F.col("content_type"), "payload")
    texts = made.where("text is not null").select(F.col("text_file_path").alias("key"), F.col("text_file_hash").alias("hash"), F.lit("text/plain").alias("content_type"), F.encode("text", "UTF-8").alias("payload"))
    mime = F.coalesce("content_type", tx.mime_type(F.element_at(F.split("key", r"\."), -1)))
    contents.union(texts).withColumn("content_type", F.lower(F.trim(F.split_part(mime, F.lit(";"), F.lit(1))))).write.mode("append").option("compression", "zstd").parquet(path)


def attempts(step: Callable[[], object], retries: int, seconds: float, sleep: Callable[[float], None] = time.sleep) -> object:
    """Run a step, again after a pause up to ``retries`` times if it raises."""
    for left in range(retries, -1, -1):
        try:
            return step()
        except Exception:
            if not left:
                raise
            log.warning("step_retried", extra={"event": "step_retried", "left": left}, exc_info=True)
            sleep(seconds)
    raise AssertionError("unreachable")


def materialise(spark: SparkSession, root: str, land: Callable[[str, int, date, date], None], start: date, end: date, body_ids: list[int] | None = None, config: EngineConfig = EngineConfig(), sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """For every partition and body: land it, then transform it; a partition with failed records raises after its retries.

    ``land(root, body_id, start, end)`` fills the landing table.  The grid is of dates and sources, not of data.
    """
    config.body_names(body_ids)
    bodies = {k: v for k, v in config.bodies.items() if body_ids is None or k in body_ids}
    done = []
    for p in calendar.grid(spark, bodies, max(start, config.first_partition), end, config.partition_size).orderBy("partition_date", "body_id").collect():
        attempts(lambda p=p: land(root, p.body_id, p.query_start, p.query_end), config.landing_retries, config.landing_retry_seconds, sleep)

        def settle(p=p) -> dict:
            stats = run_transform(spark, root, p.partition_date, p.query_end, [p.body_id], config=config)
            if stats["failed"]:
                raise RuntimeError(f"{stats['failed']} records of {p.body} at {p.partition_date} failed")
            return stats

        done.append({"body": p.body, "partition_date": p.partition_date.isoformat(), **attempts(settle, config.processed_retries, config.processed_retry_seconds, sleep)})
    return done


def summarise_logs(spark: SparkSession, label: str, *paths: str, wall_path: str | None = None) -> str:
    """Markdown of the numeric totals, throughput and records a body of event logs."""
    found = events.read_lines(spark, *paths)
    totals = {r.field: int(r.total) for r in events.numeric_totals(found).collect()}
    wall = (events.wall_seconds(spark, wall_path).first() if wall_path and storage.exists(spark, wall_path) else None) or events.wall_in_file_order(found).agg(F.sum("wall_seconds")).first()
    bodies = {r.body: r.n for r in events.stored_by_body(found).collect()}
    return summaries.markdown_summary(label, totals, wall[0] if wall else None, bodies)


def landing_from(frame: DataFrame, spark: SparkSession, root: str, config: EngineConfig = EngineConfig()) -> int:
    """Commit a landing table."""
    return storage.commit(spark, f"{root}/{config.landing_table}", frame)
