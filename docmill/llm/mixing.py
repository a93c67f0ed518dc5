"""Soft-membership mixing of domains to target weights.

Domains are classes of a labelled table.  A softmax classifier over hashed words
is fitted on the driver from a bounded sample of labelled documents
(``max_labelled`` rows, those with the smallest hashes); it gives every document
posteriors p of the domains.  Nonnegative rates r then minimise the squared
distance between the expected token totals ``sum r * tokens * p`` and the targets
by projected gradient descent: every step is one aggregation of the totals and of
the small curvature matrix over the documents whose rate is inside its bounds, and
moves a rate by the preconditioned gradient along its posteriors, projected to
[0, max_rate].  A document's rate follows from its posteriors and the steps so far,
so no rate is ever stored or collected.

Targets that no rates reach (a total above what ``max_rate`` allows, a domain without
documents) leave the nearest rates and a residual above ``tolerance``: it is a column of
the result, and ``mixed`` warns of it.  ``domain_totals`` gives targets that are reachable by
construction: shares of each domain's documents, expressed as expected token totals.

Rates become whole copies: the integer part, and one more where a hash of the
document is below the fraction.

Defined cases: a null text has no tokens and the posteriors of an empty text; a
null ``doc_id`` is hashed as such; unlabelled ids and labels without a document do
not train; with no usable labels posteriors are uniform; equal rows get equal
rates; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, load, text_or_empty, without

DOMAINS = ("good", "poor", "toxic")
WIDTH = 1 << 15
MAX_LABELLED = 4000
SYMBOLS = re.compile(rb"[#*$%&|<>!]")
CAPITALS = re.compile(rb"[A-Z]")


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns, values (unit length) and number of words of a text."""
    words = text.split()
    n = len(words)
    lower = text.lower().split()
    columns, counts = np.unique(np.fromiter(map(zlib.crc32, lower), np.int64, n) & (WIDTH - 1), return_counts=True)
    size = max(1, len(text))
    shape = np.sqrt([len(SYMBOLS.findall(text)) / size, len(CAPITALS.findall(text)) / size, 1 - len(set(lower)) / max(1, n), min(1.0, n / 50)])
    values = np.concatenate((np.sqrt(counts / max(1, n)), shape))
    return np.concatenate((columns, WIDTH + np.arange(4))), values, n


def _blocks(rows: list[tuple[np.ndarray, np.ndarray]], entries: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive rows with about ``entries`` values each, a bias after each row's: places of the rows, columns, values and sizes."""
    at = held = 0
    for i, (columns, _) in enumerate(rows):
        held += len(columns) + 1
        if held >= entries or i + 1 == len(rows):
            part = rows[at : i + 1]
            ends = np.array([WIDTH + 4], np.int32), np.array([1], np.float32)
            yield slice(at, i + 1), *(np.concatenate([x for row in part for x in (row[j], ends[j])]) for j in (0, 1)), np.array([len(c) + 1 for c, _ in part])
            at, held = i + 1, 0


def fit_softmax(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, rounds: int = 120, ridge: float = 1e-5, entries: int = 1 << 15) -> np.ndarray:
    """Weights (features and bias, classes), by full-batch Adam on the regularised likelihood; products are made for ``entries`` values at a time."""
    weights = np.zeros((WIDTH + 5, classes))
    if not rows:
        return weights
    blocks = list(_blocks(rows, entries))
    truth = np.eye(classes)[labels]
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        sums = np.zeros((classes, len(weights)))
        for own, columns, values, sizes in blocks:
            columns, values = columns.astype(np.intp), values.astype(float)
            score = np.add.reduceat(weights[columns] * values[:, None], np.cumsum(sizes) - sizes)
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = np.repeat(p - truth[own], sizes, 0) * values[:, None] / len(rows)
            for k in range(classes):
                np.add.at(sums[k], columns, error[:, k])
        grad = sums.T + ridge * weights
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        weights -= 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return weights


def train_classifier(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """toxic beats quality; rows with a null label do not count."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), domain.alias("domain")).where("domain is not null and _id is not null").groupBy("_id").agg(F.max("domain").alias("domain"))
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty(docs).alias("text"))
    # the sample is chosen by id, and only then are texts fetched
    chosen = known.join(own.select("_id").distinct(), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = [pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()), pa.array([f[1].astype("<f4").tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["domain", "columns", "values"])

    rows = own.join(F.broadcast(chosen), "_id").select("domain", "text").mapInArrow(run, "domain int, columns binary, values binary").collect()
    rows.sort(key=lambda r: (r.domain, bytes(r["columns"]), bytes(r["values"])))
    return fit_softmax([(np.frombuffer(r["columns"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows], np.array([r.domain for r in rows], np.int64), len(DOMAINS))


def posteriors(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, text_key, tokens (words) and p0, p1, .. of every row."""
    weights = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = np.zeros((batch.num_rows, weights.shape[1])), np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                columns, values, n[i] = features(text)
                score = values @ weights[columns] + weights[-1]
                p[i] = np.exp(score - score.max())
            p /= p.sum(1, keepdims=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), *[pa.array(np.ascontiguousarray(c)) for c in p.T]], names=["doc_id", "text_key", "tokens", *[f"p{k}" for k in range(p.shape[1])]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty(docs)).alias("text_key"), text_or_empty(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, tokens long, " + ", ".join(f"p{k} double" for k in range(weights.shape[1])))


def _rate(steps: list[np.ndarray], max_rate: float | None) -> Column:
    rate = F.lit(1.0)
    for step in steps:
        rate = F.greatest(F.lit(0.0), rate - sum((F.col(f"p{k}") * float(u) for k, u in enumerate(step)), F.lit(0.0)))
        if max_rate is not None:
            rate = F.least(F.lit(float(max_rate)), rate)
    return rate


def token_totals(members: DataFrame) -> np.ndarray:
    """Expected tokens of each domain over all documents."""
    got = members.agg(*[F.sum(F.col("tokens") * F.col(f"p{i}")) for i in range(len(DOMAINS))]).first()
    return np.array([float(x or 0.0) for x in got])


def domain_totals(members: DataFrame, keep: dict[str, float]) -> np.ndarray:
    """Expected token totals if of the documents most likely of domain d the share ``keep[d]`` stayed."""
    k = range(len(DOMAINS))
    likely = F.array_position(F.array(*[F.col(f"p{i}") for i in k]), F.greatest(*[F.col(f"p{i}") for i in k])) - 1
    share = F.element_at(F.array(*[F.lit(float(keep[d])) for d in DOMAINS]), (likely + 1).cast("int"))
    return token_totals(members.withColumn("tokens", F.col("tokens") * share))


def _round_sums(steps: list[np.ndarray], max_rate: float | None):
    """One row a task: tokens, expected tokens of each domain at the rates, and the curvature over the documents inside their bounds (all before the first step)."""
    k = len(DOMAINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = []
        for batch in batches:
            tokens, *p = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rate = np.ones(len(tokens))
            for step in steps:  # as _rate
                rate = np.maximum(0.0, rate - sum((p[i] * float(u) for i, u in enumerate(step)), 0.0))
                if max_rate is not None:
                    rate = np.minimum(float(max_rate), rate)
            inside = (rate > 0) & (rate < (np.inf if max_rate is None else max_rate)) if steps else np.ones(len(tokens), bool)
            held = np.where(inside, tokens, 0)
            sums.append([tokens.sum(), *((tokens * rate * p[i]).sum() for i in range(k)), *((held * p[i] * p[j]).sum() for i in range(k) for j in range(k))])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(sums, 0).tolist()], pa.list_(pa.float64()))], names=["sums"])

    return run


def fit_rates(members: DataFrame, target: np.ndarray, max_rate: float | None = None, rounds: int = 40, tolerance: float = 1e-5) -> tuple[Column, float]:
    """The rate as an expression over tokens and p0.. of ``members`` and the residual: the largest difference from the targeted token totals, as a share of all tokens.

    A round's steps are data of one plan: as expressions each round would be a longer plan, compiled anew on the driver.
    """
    k = len(DOMAINS)
    own = members.select("tokens", *[f"p{i}" for i in range(k)])
    steps: list[np.ndarray] = []
    best, residual = (float("inf"), 0, 0.0), 0.0  # squared distance, steps, residual
    for turn in range(rounds + 1):
        got = own.mapInArrow(_round_sums(steps, max_rate), "sums array<double>").collect()
        n, *sums = map(math.fsum, zip(*(r.sums for r in got), strict=True)) if got else [0.0]
        if not n:
            break
        error = np.array(sums[:k]) / n - target / n
        residual = float(np.abs(error).max())
        best = min(best, (float(error @ error), len(steps), residual))
        if residual < tolerance or turn == rounds:
            break
        curve = np.array(sums[k:]).reshape(k, k) / n
        steps.append(np.linalg.solve(curve + np.eye(k) * (1e-3 + 1e-2 * np.trace(curve) / k), error))
    return _rate(steps[: best[1]], max_rate), best[2]


def _members(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    return Workspace(spark, "mixing").write(posteriors(docs, train_classifier(docs, labels, max_labelled)), "members")


def _rated(members: DataFrame, rate: Column, residual: float) -> DataFrame:
    share = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << 30)) / float(1 << 30)
    rated = members.withColumn("rate", rate)
    copies = (F.floor("rate") + (share < F.col("rate") - F.floor("rate")).cast("int")).cast("long")
    return rated.select("doc_id", "text_key", "tokens", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate", copies.alias("copies"), F.lit(residual).alias("residual"))


def mixing_rates(spark: SparkSession, docs: DataFrame, labels: DataFrame, weights: dict[str, float], total: float = 1.0, max_rate: float | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text_key, tokens, p_<domain>.., rate, copies and residual for every row of ``docs``; ``total`` is a share of all tokens."""
    members = _members(spark, docs, labels, max_labelled)
    target = np.array([weights[d] for d in DOMAINS]) / sum(weights.values()) * total * token_totals(members).sum()
    return _rated(members, *fit_rates(members, target, max_rate))


def mixed(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep: dict[str, float], max_labelled: int = MAX_LABELLED, tolerance: float = 1e-3) -> DataFrame:
    """``docs`` thinned to the token totals that ``keep`` (a share of each domain's documents) stands for, with their own columns only."""
    members = _members(spark, docs, labels, max_labelled)
    rate, residual = fit_rates(members, domain_totals(members, keep), 1.0)
    if residual > tolerance:
        warnings.warn(f"mixing targets are not reached: the residual is {residual:.2g} of all tokens", stacklevel=2)
    ws = Workspace(spark, "mixing-dropped")
    dropped = ws.write(_rated(members, rate, residual).where("copies = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "dropped")
    return without(docs, dropped, F.xxhash64(text_or_empty(docs)))


#: Targets of the query: expected token shares of the domains.
QUERY_WEIGHTS = {"good": 0.85, "poor": 0.12, "toxic": 0.03}


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), QUERY_WEIGHTS).drop("text_key")


QUERIES = {"op3_soft_mixing": op3_soft_mixing}
ORACLES: dict[str, str] = {}
