"""Landing to processed and quarantine: every page is parsed once, and the decisions fall in a fixed order.

failed (incomplete metadata), unchanged (source hash and version: no payload is read),
failed (no payload, no content), quarantined, unchanged (output hash), transformed or
passed through.  What is decided is one written table, of which the outputs are filters.
An identifier seen again in one run is compared with the sighting before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import dom
from ..functions import text as tx
from ..operators import changes, summaries, validation
from ..storage import Work

STRUCTURED = (
    "struct<decision_type: string, chair: string, adjudicating_officer: string, division_members: array<struct<role: string, name: string>>, parties: struct<complainant: string, respondent: string, representatives: array<string>>, "
    "hearing_date: string, signature_date: string, signatory: string, acts_cited: array<string>, monetary_amounts_eur: array<double>>"
)
PROCESSED = (
    "identifier string, body string, body_id int, partition_date string, partition_end string, date string, bucket string, file_path string, file_hash string, file_size bigint, content_type string, "
    f"text_file_path string, text_file_hash string, text_size bigint, structured {STRUCTURED}, source_url string, doc_url string, source_bucket string, source_file_path string, source_file_hash string, "
    "transform_version int, title string, description string, last_transformed_at timestamp, updated_at timestamp, first_transformed_at timestamp"
)
QUARANTINE = (
    "identifier string, body string, body_id int, partition_date string, partition_end string, landing_bucket string, landing_file_path string, landing_file_hash string, content_type string, "
    "quarantine_reason string, quarantine_details array<string>, last_quarantined_at timestamp, first_quarantined_at timestamp"
)
KEY = ("identifier", "file_path", "file_hash")


def in_range(landing: DataFrame, start: date, end: date, names: list[str] | None = None, strict: bool = False, size: str = "monthly") -> DataFrame:
    """Rows of the buckets of a date range; a start within a bucket includes it unless ``strict``."""
    if end < start:
        raise ValueError("end is before start")
    unit = {"monthly": "month", "weekly": "week", "daily": "day"}[size]
    low = F.lit(start.isoformat()) if strict else F.date_format(F.date_trunc(unit, F.lit(start)), "yyyy-MM-dd")
    rows = landing.where((F.col("partition_date") >= low) & (F.col("partition_date") <= end.isoformat()))
    return rows if names is None else rows.where(F.col("body").isin(names))


def scan(landing: DataFrame, *args, **options) -> DataFrame:
    """``in_range`` in order of partition and identifier, for those who look at the rows."""
    return in_range(landing, *args, **options).orderBy("partition_date", "identifier")


def with_payloads(spark: SparkSession, landing: DataFrame, root: str) -> DataFrame:
    """Landing rows with the bytes of the files that ``file_path`` names below ``root``; null where there is none."""
    base = root.rstrip("/") + "/"
    blobs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.substring_index("path", base.split(":", 1)[-1].lstrip("/"), -1)
    return landing.join(blobs.select(path.alias("file_path"), F.col("content").alias("payload")), "file_path", "left")


def structured_fields() -> Column:
    """The ten fields from a page struct ``page``: tree results and column functions over its texts."""
    body = F.coalesce("page.body_text", F.lit(""))
    hearing = F.get(F.filter(F.transform("page.hearing_tails", tx.any_date), lambda d: d.isNotNull()), F.lit(0))
    signed = F.try_element_at(F.filter(F.transform("page.tables", tx.last_short_date), lambda d: d.isNotNull()), F.lit(-1))
    return F.struct(
        tx.decision_type(F.col("page.subject"), body).alias("decision_type"), tx.chair(F.col("page.division_members")).alias("chair"), tx.adjudicating_officer(body).alias("adjudicating_officer"),
        F.col("page.division_members").alias("division_members"), F.col("page.parties").alias("parties"), hearing.cast("string").alias("hearing_date"), signed.cast("string").alias("signature_date"),
        F.col("page.signatory").alias("signatory"), tx.acts_cited(body).alias("acts_cited"), tx.money_amounts(body).alias("monetary_amounts_eur"),
    )


def _reader(selectors: tuple[str, ...]):
    """(payload, identifier, ext) to a page: HTML is parsed, PDF gives its text, all else nothing."""

    @F.pandas_udf(dom.PAGE)
    def read(payload: pd.Series, title: pd.Series, ext: pd.Series) -> pd.DataFrame:
        def one(p, t, e):
            return dom.read_page(p, t, selectors) if e == "html" else dom.EMPTY_PAGE | {"text": dom.pdf_text(p) if e == "pdf" else None}

        return pd.DataFrame([one(*x) for x in zip(payload, title, ext, strict=True)], columns=list(dom.EMPTY_PAGE))

    return read


def early_decisions(landing: DataFrame, processed: DataFrame, config: EngineConfig) -> DataFrame:
    """Landing rows without payload, with ``early``: failed, unchanged or repeat (the sighting before has the same source); null where the payload is needed."""
    existing = processed.select("identifier", F.col("file_hash").alias("old_hash"), F.col("source_file_hash").alias("old_source"), F.col("transform_version").alias("old_version"))
    rows = landing.select(*[c for c in landing.columns if c != "payload"]).withColumn("ext", tx.extension(F.col("content_type")))
    seen = W.partitionBy("identifier").orderBy("partition_date", "file_path", "file_hash")
    named = rows.where("identifier is not null").join(existing, "identifier", "left").withColumns({"sighting": F.row_number().over(seen), "before": F.lag("file_hash").over(seen)})
    unnamed = rows.where("identifier is null").withColumns({"old_hash": F.lit(None).cast("string"), "old_source": F.lit(None).cast("string"), "old_version": F.lit(None).cast("int"), "sighting": F.lit(1), "before": F.lit(None).cast("string")})
    incomplete = F.col("identifier").isNull() | F.col("file_path").isNull() | F.col("ext").isNull()
    repeat = (F.col("sighting") > 1) & F.col("before").eqNullSafe(F.col("file_hash"))
    fast = (F.col("sighting") == 1) & F.coalesce((F.col("old_source") == F.col("file_hash")) & (F.col("old_version") == config.transform_version), F.lit(False))
    return named.unionByName(unnamed).withColumn("early", F.when(incomplete, "failed").when(repeat, "repeat").when(fast, "unchanged"))


@dataclass
class TransformResult:
    """Views of the table of decisions."""

    decided: DataFrame
    now: datetime
    config: EngineConfig
    work: Work
    found: int  # landing rows, counted while they were first read

    @property
    def processed(self) -> DataFrame:
        """Rows to merge into processed by identifier, with ``payload`` and ``text``; of several sightings the last."""
        rows = self.decided.where("outcome in ('transformed', 'passthrough') and last_written")
        stamp = F.lit(self.now).cast("timestamp")
        name = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
        made = {
            "source_file_hash": F.col("file_hash"), "source_file_path": F.col("file_path"), "source_bucket": F.col("bucket"), "file_hash": F.col("out_hash"), "file_size": F.col("out_size"),
            "file_path": tx.processed_key(F.col("body"), F.col("identifier"), F.col("ext")), "bucket": F.lit(self.config.processed_bucket), "body_id": F.col("body_id").cast("int"),
            "text_file_path": F.when(F.col("text").isNotNull(), tx.processed_key(F.col("body"), F.col("identifier"), F.lit("txt"))), "text_file_hash": F.sha2(F.encode("text", "UTF-8"), 256),
            "text_size": F.octet_length("text").cast("long"), "transform_version": F.lit(self.config.transform_version), "last_transformed_at": stamp, "updated_at": stamp, "first_transformed_at": stamp,
            **{c: name(c) for c in ("source_url", "doc_url", "title", "description")},
        }
        columns = [x.split(" ", 1)[0] for x in PROCESSED.replace(STRUCTURED, "struct").split(", ")]
        return rows.withColumns(made).select(*columns, F.col("out").alias("payload"), "text")

    @property
    def touched(self) -> DataFrame:
        """Unchanged rows: identifier, last_transformed_at and, where the payload was read, the source hash and version to note."""
        rows = self.decided.where("outcome = 'unchanged' and last_valid")
        slow = lambda c: F.when(F.col("early").isNull(), c)
        return rows.select("identifier", F.lit(self.now).cast("timestamp").alias("last_transformed_at"), slow(F.col("file_hash")).alias("source_file_hash"), slow(F.lit(self.config.transform_version)).alias("transform_version"))

    @property
    def quarantine(self) -> DataFrame:
        rows = self.decided.where("outcome = 'quarantined' and last_sighting").withColumn("body_id", F.col("body_id").cast("int"))
        return validation.quarantine_rows(rows, F.col("reason"), F.col("errors"), F.lit(self.now).cast("timestamp"))

    @property
    def outcomes(self) -> DataFrame:
        """identifier, body, partition_date (? for null), outcome, reason and message of every landing row."""
        return self.decided.select("identifier", *[F.coalesce(c, F.lit("?")).alias(c) for c in ("body", "partition_date")], "outcome", "reason", tx.truncated(F.col("message")).alias("message"))

    def summary(self, total: bool = True) -> DataFrame:
        return summaries.outcome_counts(self.outcomes, summaries.TRANSFORM, total=total).orderBy("body", "partition_date")

    def events(self) -> DataFrame:
        """One event a record, one summary a partition and one over all, as JSON lines in order of kind and key."""
        at = F.date_format(F.lit(self.now).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'")
        kinds = {"transformed": "record_transformed", "passthrough": "record_transformed", "unchanged": "record_unchanged", "quarantined": "record_quarantined", "failed": "record_failed"}
        event = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("outcome"))
        level = F.when(F.col("outcome") == "failed", "ERROR").when(F.col("outcome") == "quarantined", "WARNING").otherwise("INFO")
        common = lambda e, lv: [at.alias("ts"), lv.alias("level"), F.lit("docmill.transform").alias("logger"), e.alias("msg"), e.alias("event")]
        done = F.col("outcome").isin("transformed", "passthrough")
        records = self.decided.select(
            F.lit(0).alias("_kind"), "body", "partition_date", F.to_json(F.struct(
                *common(event, level), "identifier", "body", "partition_date", "reason", tx.truncated(F.col("message")).alias("error_message"), F.when(F.col("outcome") == "quarantined", F.col("errors")).alias("details"),
                F.when(F.col("outcome") == "unchanged", F.col("early").isNotNull()).alias("skipped_download"), F.coalesce("out_hash", F.when(F.col("outcome") == "unchanged", F.col("old_hash"))).alias("file_hash"),
                F.when(done, F.col("outcome")).alias("kind"), F.when(done, F.col("in_size")).alias("size_before"), F.when(done, F.col("out_size")).alias("size_after"), F.when(done, F.octet_length("text")).alias("text_size"),
            )).alias("value"),
        )
        totals = summaries.outcome_counts(self.outcomes, summaries.TRANSFORM, total=True)
        kind = F.when(F.col("body").isNull(), "transform_summary").otherwise("partition_summary")
        sums = totals.select(F.when(F.col("body").isNull(), 2).otherwise(1).alias("_kind"), "body", "partition_date", F.to_json(F.struct(*common(kind, F.lit("INFO")), "body", "partition_date", *summaries.TRANSFORM)).alias("value"))
        return records.union(sums).orderBy("_kind", "body", "partition_date", "value").select("value")


def _html() -> Column:
    return F.col("ext") == "html"


def _valid() -> Column:
    return F.col("problem").isNull() & (F.coalesce(F.size("errors"), F.lit(0)) <= 0) & (F.coalesce("early", F.lit("")) != "failed")


def _outcome() -> Column:
    return (
        F.when((F.col("early") == "failed") | F.col("problem").isNotNull(), "failed").when(F.size("errors") > 0, "quarantined").when(F.col("early").isin("unchanged", "repeat") | (F.col("old_hash") == F.col("out_hash")), "unchanged")
        .when(_html(), "transformed").otherwise("passthrough")
    )


def transform(spark: SparkSession, landing: DataFrame, processed: DataFrame, quarantine: DataFrame, now: datetime, config: EngineConfig = EngineConfig()) -> TransformResult:
    """Decide every landing row; ``processed`` has one row an identifier, ``quarantine`` is settled by ``settle``."""
    work = Work(spark, "transform")
    count = Observation("landing")
    early = work.write(early_decisions(landing, processed, config).observe(count, F.count(F.lit(1)).alias("found")), "early")
    needed = early.where("early is null")
    payloads = landing.select(*KEY, "payload")
    if early.where("sighting > 1").isEmpty():
        rows = needed.join(payloads, [needed[c].eqNullSafe(payloads[c]) if c == "file_hash" else needed[c] == payloads[c] for c in KEY], "left").drop(*[payloads[c] for c in KEY])
    else:  # equal rows of the landing have one payload
        once = payloads.groupBy(*KEY).agg(F.first("payload", ignorenulls=True).alias("payload"))
        rows = needed.join(once, [needed[c].eqNullSafe(once[c]) if c == "file_hash" else needed[c] == once[c] for c in KEY], "left").drop(*[once[c] for c in KEY])
    sent = F.when(F.col("ext").isin("html", "pdf"), F.col("payload"))
    parsed = rows.withColumn("page", _reader(config.selectors)(sent, F.col("identifier"), F.col("ext")))
    missing = F.col("payload").isNull()
    parsed = parsed.withColumns(
        {
            "out": F.when(_html(), F.col("page.clean")).otherwise(F.col("payload")), "text": F.col("page.text"), "problem": F.when(missing, "landing_download_failed").when(_html(), F.col("page.error")),
            "message": F.when(missing, F.concat(F.lit("no payload at "), F.col("file_path"))).otherwise(F.col("page.message")), "in_size": F.octet_length("payload").cast("long"),
            "structured": F.when(_html() & F.col("page.error").isNull() & ~missing, structured_fields()).cast(STRUCTURED),
        }
    ).drop("page", "payload")
    parsed = parsed.withColumns({"out_hash": F.sha2("out", 256), "out_size": F.octet_length("out").cast("long")})
    shown = parsed.withColumns({"source": F.struct("file_hash", "file_path", "bucket"), "file_hash": F.col("out_hash"), "file_size": F.col("out_size"), "file_path": F.coalesce(tx.processed_key(F.col("body"), F.col("identifier"), F.col("ext")), F.col("file_path"))})
    # a null body has no key, but is reported as its own error
    checked = shown.withColumn("errors", F.when(F.col("problem").isNull(), validation.errors(config.min_content_bytes)))
    checked = checked.withColumns({"file_hash": F.col("source.file_hash"), "file_path": F.col("source.file_path")}).drop("source", "file_size")
    made = work.write(checked, "parsed")
    skipped = early.where("early is not null")
    made = made.unionByName(skipped, allowMissingColumns=True)
    if early.where("sighting > 1").isEmpty():
        made = made.withColumns({"outcome": _outcome(), "last_sighting": F.lit(True), "last_valid": _valid(), "last_written": F.lit(True)})
    else:
        made = _after_the_first(made)
    reason = F.coalesce("problem", F.when(F.col("early") == "failed", "incomplete_landing_metadata"), F.when(F.size("errors") > 0, "schema_validation_failed"))
    detail = F.when(F.col("early") == "failed", F.concat_ws(" ", F.lit("content type"), F.coalesce("content_type", F.lit("missing")), F.lit("at"), F.coalesce("file_path", F.lit("no path"))))
    decided = made.withColumns({"reason": reason, "message": F.coalesce("message", detail)})
    table = work.write(decided, "decided", "outcome")
    for name in ("early", "parsed"):
        work.drop(name)
    return TransformResult(table, now, config, work, count.get["found"])


def _after_the_first(made: DataFrame) -> DataFrame:
    """Further sightings see the state that the one before left; a repeated source takes over what was found for it."""
    order, whole = W.partitionBy("identifier").orderBy("sighting"), W.partitionBy("identifier")
    found = ("problem", "message", "errors", "out_hash")
    said = F.last(F.when(F.coalesce("early", F.lit("")) != "repeat", F.struct(*found)), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    repeat = F.col("early") == "repeat"
    several = made.where("identifier is not null").withColumn("said", said).withColumns({c: F.when(repeat, F.col(f"said.{c}")).otherwise(F.col(c)) for c in found}).drop("said").withColumn("good", _valid())
    state = F.last(F.when(F.col("good"), F.coalesce("out_hash", "old_hash")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    several = several.withColumn("old_hash", F.coalesce(state, "old_hash")).withColumn("outcome", _outcome())
    last = lambda c: F.col("sighting") == F.max(F.when(c, F.col("sighting"))).over(whole)
    several = several.withColumns({"last_sighting": last(F.lit(True)), "last_valid": F.coalesce(last(F.col("good")), F.lit(False)), "last_written": F.coalesce(last(F.col("outcome").isin("transformed", "passthrough")), F.lit(False))})
    rest = made.where("identifier is null").withColumns({"outcome": _outcome(), "last_sighting": F.lit(True), "last_valid": F.lit(False), "last_written": F.lit(False)})
    return several.drop("good").unionByName(rest)


def settle(quarantine: DataFrame, result: TransformResult) -> DataFrame:
    """The quarantine after a run: valid identifiers leave it, new failures replace old rows."""
    good = result.decided.where("last_valid").select("identifier").distinct()
    kept = quarantine.join(good, "identifier", "left_anti")
    return changes.merge(kept, result.quarantine.select(*quarantine.columns), "identifier", ("first_quarantined_at",))


def merged(processed: DataFrame, result: TransformResult) -> DataFrame:
    """Processed after a run: new rows replace old ones, touches note what was seen, quarantined identifiers leave."""
    rows = changes.merge(processed, result.processed.select(*processed.columns), "identifier", ("first_transformed_at",))
    marks = result.touched.select("identifier", *[F.col(c).alias(f"_{c}") for c in ("last_transformed_at", "source_file_hash", "transform_version")])
    rows = rows.join(marks, "identifier", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in ("last_transformed_at", "source_file_hash", "transform_version")})
    return rows.join(result.quarantine.select("identifier"), "identifier", "left_anti").select(*processed.columns)
