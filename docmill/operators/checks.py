"""Checks of tables: unique keys, columns that must be there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that several rows have, with their number; null keys do not count.  Empty where the key is unique."""
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in key]).isNotNull()).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def missing_columns(required: tuple[str, ...], df: DataFrame) -> list[str]:
    """Required columns that a table lacks, in the order required."""
    return [c for c in required if c not in df.columns]
