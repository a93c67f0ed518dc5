"""Row validation with reasons; field errors hide record errors, size hides date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import decision_date

REQUIRED = ("identifier", "body", "body_id", "partition_date", "partition_end", "bucket", "file_path", "file_hash", "file_size", "content_type")
IDENTIFIER, SHA, ISO = r"^[A-Z0-9][A-Z0-9\-/.]{1,60}$", r"^[0-9a-f]{64}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def errors(min_content_bytes: int = 1024) -> Column:
    """array<string> of 'field:type', empty for a valid row."""
    shape = lambda c, p: F.when(F.col(c).isNotNull() & ~F.regexp_like(c, F.lit(p)), f"{c}:shape")
    fields = [F.when(F.col(c).isNull(), f"{c}:missing") for c in REQUIRED]
    fields += [F.when(F.col("body_id").isNotNull() & F.col("body_id").try_cast("int").isNull(), "body_id:type")]
    fields += [shape("identifier", IDENTIFIER), shape("file_hash", SHA), shape("partition_date", ISO), shape("partition_end", ISO)]
    found = F.array_compact(F.array(*fields))
    end = F.try_to_date("partition_end", "yyyy-MM-dd")
    record = F.when(F.col("file_size") < min_content_bytes, F.array(F.lit("record:too_small"))).when(decision_date(F.col("date")) > end, F.array(F.lit("record:date_after_partition")))
    return F.when(F.size(found) > 0, found).otherwise(F.coalesce(record, F.array().cast("array<string>")))


def quarantine_rows(landing: DataFrame, reason: Column, details: Column, now: Column) -> DataFrame:
    keep = ["identifier", "body", "body_id", "partition_date", "partition_end"]
    renamed = [F.col("bucket").alias("landing_bucket"), F.col("file_path").alias("landing_file_path"), F.col("file_hash").alias("landing_file_hash")]
    return landing.select(*keep, *renamed, "content_type", reason.alias("quarantine_reason"), details.alias("quarantine_details"), now.alias("last_quarantined_at"), now.alias("first_quarantined_at"))
