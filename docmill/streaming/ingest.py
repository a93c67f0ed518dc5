"""Landing as a stream of fetched items: classify every micro-batch, append contents, merge the narrow landing table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import storage
from ..config import EngineConfig
from ..functions import text as tx
from ..operators import changes, summaries


def prepared(items: DataFrame) -> DataFrame:
    """Canonical payload, hash, size and extension of fetched items."""
    canonical = tx.canonical_bytes(F.col("payload"))
    rows = items.withColumn("ext", tx.extension(F.col("content_type"))).withColumn("payload", F.when(F.col("ext") == "html", canonical).otherwise(F.col("payload")))
    return rows.withColumns({"file_hash": tx.content_hash(F.col("payload")), "size": F.octet_length("payload").cast("long")})


METADATA = "identifier string, title string, description string, date string, partition_date string, partition_end string, body string, body_id int, source_url string, doc_url string, content_type string, scraped_at string"
LANDING = METADATA + ", file_hash string, file_size bigint, bucket string, file_path string, last_seen_at timestamp, updated_at timestamp, first_scraped_at timestamp"
STORED = ("inserted", "updated", "unchanged")


def known_hashes(landing: DataFrame, start: date | None = None, end: date | None = None, body_ids: list[int] | None = None) -> DataFrame:
    """identifier and file_hash of the landing rows that a run can meet."""
    rows = landing
    if start is not None:
        rows = rows.where(F.col("partition_date") >= F.date_format(F.date_trunc("month", F.lit(start)), "yyyy-MM-dd"))
    if end is not None:
        rows = rows.where(F.col("partition_date") <= end.isoformat())
    return (rows if body_ids is None else rows.where(F.col("body_id").isin(body_ids))).select("identifier", "file_hash")


def ingest_batch(items: DataFrame, landing: DataFrame) -> DataFrame:
    """Items with their outcome against the landing table."""
    return changes.classify(prepared(items), landing.select("identifier", "file_hash"), ["scraped_at"])


def landing_after(landing: DataFrame, classified: DataFrame, now: datetime, bucket: str = "landing-zone") -> DataFrame:
    """The landing table (LANDING) after a batch: stored rows replace old ones, unchanged rows are seen again and nothing else."""
    stamp = F.lit(now).cast("timestamp")
    key = tx.landing_key(F.col("body"), F.col("partition_date"), F.col("identifier"), F.col("file_hash"), F.col("ext"))
    last = changes.latest(classified.where(F.col("outcome").isin(*STORED)), "identifier", [F.col("scraped_at").desc()])
    changed = classified.groupBy("identifier").agg(F.bool_or(F.col("outcome").isin("inserted", "updated")).alias("_changed"))
    rows = last.join(changed, "identifier").withColumns({"file_size": F.col("size"), "bucket": F.lit(bucket), "file_path": key, "last_seen_at": stamp, "updated_at": stamp, "first_scraped_at": stamp})
    new = changes.merge(landing, rows.where("_changed").select(*landing.columns), "identifier", ("first_scraped_at",))
    seen = rows.where("not _changed").select("identifier", F.col("last_seen_at").alias("_seen"))
    return new.join(seen, "identifier", "left").withColumn("last_seen_at", F.coalesce("_seen", "last_seen_at")).select(*landing.columns)


def batch_summary(classified: DataFrame) -> DataFrame:
    """Counts of a batch by body and partition, reconciled with what was found; rows without keys do not count."""
    keyed = classified.where("body is not null and partition_date is not null")
    found = keyed.groupBy("body", "partition_date").agg(F.count("*").alias("found"))
    return summaries.reconcile([summaries.outcome_counts(keyed, summaries.INGEST), found])


def ingest_events(classified: DataFrame, now: datetime) -> DataFrame:
    """One event a record, one summary a partition and one over all, as JSON lines in order of kind and key."""
    at = F.lit(now.strftime("%Y-%m-%dT%H:%M:%S.") + f"{now.microsecond // 1000:03d}+00:00")
    common = lambda e, lv="INFO": [at.alias("ts"), F.lit(lv).alias("level"), F.lit("docmill.ingest").alias("logger"), e.alias("msg"), e.alias("event")]
    stored = F.col("outcome").isin("inserted", "updated")
    event = F.when(stored, "record_stored").when(F.col("outcome") == "unchanged", "record_unchanged").otherwise("record_dropped")
    key = F.when(stored, tx.landing_key(F.col("body"), F.col("partition_date"), F.col("identifier"), F.col("file_hash"), F.col("ext")))
    change = F.when(F.col("outcome") == "inserted", "new").when(F.col("outcome") == "updated", "content_changed")
    records = classified.select(F.lit(0).alias("_kind"), "body", "partition_date", F.to_json(F.struct(*common(event), "identifier", key.alias("file_path"), F.when(F.col("outcome") != "dropped", F.col("file_hash")).alias("file_hash"), change.alias("change"), "reason", F.col("doc_url").alias("url"), "content_type", "body", "partition_date")).alias("value"))
    parts = batch_summary(classified)
    partitions = parts.select(F.lit(1).alias("_kind"), "body", "partition_date", F.to_json(F.struct(*common(F.lit("partition_summary")), *parts.columns)).alias("value"))
    totals = classified.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "updated", "unchanged", "dropped")])
    whole = totals.select(F.lit(2).alias("_kind"), F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("partition_date"), F.to_json(F.struct(*common(F.lit("storage_summary")), *totals.columns)).alias("value"))
    return records.union(partitions).union(whole).orderBy("_kind", "body", "partition_date", "value").select("value")


def ingest(spark: SparkSession, items: DataFrame, root: str, now: datetime, number: int | None = None, config: EngineConfig = EngineConfig()) -> DataFrame:
    """One batch into the tables below ``root``: contents and events are appended, only the narrow landing table is a snapshot; returns its summary.

    A batch of a ``number`` that ran before starts from the snapshot before it, so a replay gives the same.
    """
    table = f"{root}/{config.landing_table}"
    before = storage.snapshot(spark, table, LANDING, None if number is None else number - 1)
    work = storage.Work(spark, "ingest")
    known = [f.name for f in items.schema]
    whole = items.withColumns({c: F.lit(None).cast(t) for c, t in (x.split(" ") for x in METADATA.split(", ")) if c not in known})
    classified = work.write(ingest_batch(whole, before), "classified")
    stored = classified.where("outcome in ('inserted', 'updated')")
    key = tx.landing_key(F.col("body"), F.col("partition_date"), F.col("identifier"), F.col("file_hash"), F.col("ext"))
    batch, mode = ("all", "append") if number is None else (f"{number:09d}", "overwrite")
    stored.select(key.alias("key"), F.col("file_hash").alias("hash"), "content_type", "payload").write.mode(mode).parquet(f"{root}/{config.landing_bucket}/batch={batch}")
    storage.commit(spark, table, landing_after(before, classified, now, config.landing_bucket), number)
    ingest_events(classified.drop("payload"), now).write.mode(mode).text(f"{root}/logs/batch={batch}")
    summary = batch_summary(classified)
    counts = spark.createDataFrame(summary.collect(), summary.schema)  # a row a body and partition of the batch
    work.clear()
    return counts


def ingest_stream(spark: SparkSession, source: DataFrame, root: str, checkpoint: str, config: EngineConfig = EngineConfig(), now: datetime | None = None) -> StreamingQuery:
    """Run over all that is there, batch by batch; each batch ends with its summaries in the logs."""

    def write(batch: DataFrame, number: int) -> None:
        ingest(spark, batch, root, now or datetime.now(), number, config)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_urls(items: DataFrame, delay: str = "1 day") -> DataFrame:
    """A URL once, on streams within the delay of the event time."""
    return items.withWatermark("scraped_at", delay).dropDuplicatesWithinWatermark(["doc_url"]) if items.isStreaming else items.dropDuplicates(["doc_url"])
