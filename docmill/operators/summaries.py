"""Reconciliation counts and throughput."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INGEST = ("inserted", "updated", "unchanged", "dropped", "failed")
TRANSFORM = ("transformed", "passthrough", "unchanged", "quarantined", "failed")


def outcome_counts(rows: DataFrame, outcomes: tuple[str, ...], keys: tuple[str, ...] = ("body", "partition_date"), total: bool = False) -> DataFrame:
    """One count a kind of outcome, by keys; with ``total`` also over all (null keys)."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in outcomes]
    if total:
        return rows.groupingSets([[F.col(k) for k in keys], []], *keys).agg(*counts)
    return rows.groupBy(*keys).agg(*counts)


def reconcile(parts: list[DataFrame], keys: tuple[str, ...] = ("body", "partition_date")) -> DataFrame:
    """Counters of several relations on common keys, missing ones 0, and the gap between found and accounted for."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in stacked.columns if c not in keys]
    summed = stacked.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    value = lambda c: F.col(c) if c in names else F.lit(0)
    scraped = value("inserted") + value("updated") + value("unchanged")
    failed = value("failed") + value("http_failed")
    return summed.withColumns({"scraped": scraped, "gap": value("found") - (scraped + failed + value("row_parse_failed") + value("dropped") + value("skipped"))})


def per_minute(n: Column, seconds: Column) -> Column:
    return F.round(n * 60 / F.nullif(seconds, F.lit(0)), 1)


def markdown_summary(label: str, totals: dict[str, int], seconds: float | None, per_body: dict[str, int] | None = None) -> str:
    """A run's collected totals as Markdown; an unknown or zero wall time gives ``?`` for the rate, bodies come by falling count, then name."""
    scraped = totals.get("scraped", 0)
    rate = f"{scraped * 60 / seconds:.1f}" if seconds else "?"
    wall = "?" if seconds is None else f"{seconds:.3f}"
    counts = ", ".join(f"{k}={v}" for k, v in sorted(totals.items()) if v)
    lines = [f"# {label}", "", "| wall (s) | records/min | counts |", "|-|-|-|", f"| {wall} | {rate} | {counts} |"]
    if per_body:
        lines += ["", "| body | records |", "|-|-|", *(f"| {k} | {v} |" for k, v in sorted(per_body.items(), key=lambda x: (-x[1], x[0])))]
    return "\n".join(lines) + "\n"
