"""Calendar partitions: bucket key and clipped query window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def partitions(spark: SparkSession, start: date, end: date, size: str = "monthly") -> DataFrame:
    """partition_date, query_start, query_end; empty if end is before start."""
    unit, step, last = {"monthly": ("month", "1 month", "last_day(p)"), "weekly": ("week", "7 day", "date_add(p, 6)"), "daily": ("day", "1 day", "p")}.get(size) or (None, None, None)
    if unit is None:
        raise ValueError(f"unknown partition size {size!r}")
    if end < start:
        return spark.createDataFrame([], "partition_date date, query_start date, query_end date")
    first = "s" if unit == "day" else f"trunc(s, '{unit}')"
    span = spark.range(1).select(F.lit(start).cast("date").alias("s"), F.lit(end).cast("date").alias("e"))
    each = span.select("s", "e", F.expr(f"explode(sequence({first}, e, interval {step})) as p"))
    return each.select(F.col("p").alias("partition_date"), F.greatest("p", "s").alias("query_start"), F.expr(f"least({last}, e)").alias("query_end"))


def grid(spark: SparkSession, bodies: dict[int, str], start: date, end: date, size: str = "monthly") -> DataFrame:
    """Every partition of every body; both sides are small generated relations."""
    names = spark.createDataFrame(list(bodies.items()), "body_id int, body string")
    return names.crossJoin(partitions(spark, start, end, size))
