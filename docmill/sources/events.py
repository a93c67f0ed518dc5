"""JSON event logs as relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTERS = ("found", "scraped", "inserted", "updated", "unchanged", "dropped", "failed", "row_parse_failed", "transformed", "passthrough", "quarantined")
EVENT = T.StructType(
    [T.StructField("ts", T.TimestampType()), *[T.StructField(c, T.StringType()) for c in ("level", "logger", "msg", "event", "reason", "identifier", "body")], T.StructField("body_id", T.IntegerType()), T.StructField("partition_date", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTERS]
    + [T.StructField("exc", T.StringType()), T.StructField("_corrupt_record", T.StringType())]
)


def read_events(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines with an explicit schema; lines that are no object are left out; ``file`` names the worker's log."""
    lines = spark.read.option("ignoreMissingFiles", "true").text(list(paths)).select(F.btrim("value", F.lit(" \t\r\n")).alias("value"), F.col("_metadata.file_name").alias("file"))
    parsed = lines.where(F.col("value").startswith("{")).select(F.from_json("value", EVENT, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("e"), "file")
    return parsed.where("e._corrupt_record is null").select("e.*", "file").drop("_corrupt_record")


def log_lines(rows: DataFrame) -> DataFrame:
    """One JSON object a row, times in ISO milliseconds."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"}).alias("value"))


def wall_seconds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").try_cast("double").alias("seconds"))


def event_span(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys).agg((F.max("ts").cast("double") - F.min("ts").cast("double")).alias("wall_seconds"))


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Log lines that are JSON objects, whatever their fields: value, file and pos (rising within a file); missing files are left out."""
    lines = spark.read.option("ignoreMissingFiles", "true").text(list(paths)).select(F.btrim("value", F.lit(" \t\r\n")).alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))
    objects = lines.where(F.col("value").startswith("{")).withColumn("fields", F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}))
    return objects.where(F.col("fields").isNotNull() & (F.size("fields") > 0))


def field(name: str) -> Column:
    return F.try_element_at("fields", F.lit(name))


def numeric_totals(lines: DataFrame, event: str = "partition_summary") -> DataFrame:
    """field, total: the sum, as whole numbers, of every numeric field that an event has, but not of body_id or of truth values."""
    pairs = lines.where(field("event") == event).select("value", F.explode("fields").alias("field", "text")).where("field <> 'body_id'")
    # a number in JSON stands without quotes, so a string that looks like one is none
    plain = F.regexp_like("value", F.concat(F.lit(r'"\Q'), "field", F.lit(r'\E"\s*:\s*-?[0-9]')))
    numbers = pairs.where(plain).select("field", F.expr("try_cast(text as double)").alias("x")).where("x is not null")
    return numbers.groupBy("field").agg(F.sum(F.col("x").cast("long")).alias("total"))


def stored_by_body(lines: DataFrame) -> DataFrame:
    """body, n of stored records, by falling number."""
    stored = lines.where(field("event") == "record_stored")
    return stored.groupBy(F.coalesce(field("body"), F.lit("?")).alias("body")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "body")


def wall_in_file_order(lines: DataFrame) -> DataFrame:
    """file, wall_seconds: from the first to the last time stamp as they stand in the file; null if either is unreadable."""
    stamped = lines.where(field("ts").isNotNull()).select("file", "pos", field("ts").alias("ts"))
    ends = stamped.groupBy("file").agg(F.min_by("ts", "pos").alias("a"), F.max_by("ts", "pos").alias("b"))
    seconds = lambda c: F.unix_micros(F.try_to_timestamp(c)) / 1e6
    return ends.select("file", (seconds(F.col("b")) - seconds(F.col("a"))).alias("wall_seconds"))


def by_worker(lines: DataFrame) -> DataFrame:
    """One row a log file: its records stored, summaries and wall seconds, for the split over workers."""
    counts = lines.groupBy("file").agg(F.count_if(field("event") == "record_stored").alias("stored"), F.count_if(field("event") == "partition_summary").alias("partitions"))
    return counts.join(wall_in_file_order(lines), "file", "left").withColumn("worker", F.regexp_extract("file", r"([^/]+)\.[^./]*$", 1)).select("worker", "stored", "partitions", "wall_seconds")


#: The events and what each carries beside ts, level, logger and msg.
EVENTS = {
    "partition_started": ("body", "body_id", "partition_date", "partition_end", "total_found", "url"), "document_link_followed": ("identifier", "wrapper_url", "document_url", "body", "partition_date"),
    "record_skipped": ("reason", "body", "partition_date", "url"), "total_count_unparseable": ("searchhead", "rows_on_page", "url"),
    "record_failed": ("reason", "identifier", "body", "partition_date", "row_index", "status", "url", "error", "error_message", "s3_code"), "hash_cache_prefetched": ("records", "range_start", "range_end"),
    "record_stored": ("identifier", "file_path", "file_hash", "change", "body", "partition_date"), "record_unchanged": ("identifier", "file_hash", "body", "partition_date", "skipped_download"),
    "record_dropped": ("reason", "identifier", "url", "content_type"), "partition_summary": ("body", "partition_date", *COUNTERS), "storage_summary": ("inserted", "updated", "unchanged", "dropped"),
    "transform_started": ("range_start", "range_end", "bodies", "transform_version"), "transform_summary": ("transformed", "passthrough", "unchanged", "quarantined", "failed"),
    "record_transformed": ("identifier", "file_path", "file_hash", "text_file_path", "kind", "size_before", "size_after", "text_size"), "record_quarantined": ("identifier", "reason", "body", "partition_date", "details"),
    "quarantine_write_failed": ("identifier", "error"), "text_sibling_upload_failed": ("identifier", "error"),
}


def event_view(lines: DataFrame, event: str) -> DataFrame:
    """The lines of one event as a relation of its own columns (strings; counters as whole numbers)."""
    if event not in EVENTS:
        raise ValueError(f"unknown event {event!r}")
    typed = lambda c: field(c).try_cast("long").alias(c) if c in COUNTERS else field(c).alias(c)
    return lines.where(field("event") == event).select(F.try_to_timestamp(field("ts")).alias("ts"), *[field(c).alias(c) for c in ("level", "logger", "msg")], *[typed(c) for c in EVENTS[event]])
