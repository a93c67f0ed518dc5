"""SimHash near-dedup over deletion-variant signatures.

A 64-bit fingerprint is cut into three segments.  Two fingerprints that differ in
at most four bits differ in at most one bit of some segment, so they share one of
that segment's variants in which one bit is deleted.  Every distinct fingerprint
is indexed under its 64 one-wildcard variants, an equality join finds those that
share a variant, and the join condition verifies the distance.  A pair that
shares many variants is reported at one of them only, chosen by the pair itself.

Rows with the same fingerprint are one vertex, so copies are never expanded into
pairs.  A variant with more than ``bucket`` distinct fingerprints leaves the join:
its members are dealt into blocks, every pair of blocks is compared by vector
instructions, and each comparison reports only a spanning forest of its links,
which preserves the components.

Defined cases: a null text counts as empty, and has fingerprint zero, linked like
any other; a null ``doc_id`` is no smallest id (a component of nulls alone has a
null id); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, components, load, text_or_empty

SEGMENTS = ((0, 21), (21, 21), (42, 22))
BITS = 4


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; ASCII letters count in lower case."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):  # bits of a long text are counted in blocks
        ones += np.unpackbits(hashes[part : part + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits((ones * 2 > len(hashes)).astype(np.uint8)).view(">u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """doc_id, text_key (hash of the text, to know the row again), fp (as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x, words_per_shingle) for x in batch.column(2).cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty(docs)).alias("text_key"), text_or_empty(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _variants(fps: DataFrame) -> DataFrame:
    """key, fp: the key holds segment, deleted position and the segment without that bit."""
    keys = []
    for s, (offset, width) in enumerate(SEGMENTS):
        part = F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << width) - 1))
        keys += [part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << p))).bitwiseOR(F.lit((s * 32 + p) << 32)) for p in range(width)]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _linked(bits: int) -> str:
    """SQL condition on a, b and key: close enough, and this key is the one that reports the pair."""
    x, seg, pos = "(a ^ b)", "shiftright(key, 37)", "cast(shiftright(key, 32) & 31 as int)"
    cases = []
    for s, (offset, width) in enumerate(SEGMENTS):
        part = f"(shiftrightunsigned({x}, {offset}) & {(1 << width) - 1}L)"
        own = f"({seg} = {s} and {part} = case when {part} = 0 then 0L else shiftleft(1L, {pos}) end and ({part} <> 0 or {pos} = 0))"
        cases.append(f"when bit_count({part}) <= 1 then {own}")
    return f"bit_count({x}) <= {bits} and case {' '.join(cases)} else false end"


def _forest(a: np.ndarray, b: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that connect what the links between the rows of a and b connect; at most len(a) + len(b)."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= bits
    top = np.iinfo(np.int64).max
    left, right = np.arange(len(a)), np.full(len(b), top)
    while True:
        new_right = np.where(near, left[:, None], top).min(0)
        new_left = np.minimum(left, np.where(near, new_right[None, :], top).min(1))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    edges = [(int(a[i]), int(a[j])) for i, j in enumerate(left) if i != j]
    return edges + [(int(a[j]), int(b[i])) for i, j in enumerate(right) if j != top and a[j] != b[i]]


def _hot_links(members: DataFrame, hot: DataFrame, block: int, bits: int) -> DataFrame:
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["fp"].to_numpy()
        first = own[rows["blk"].to_numpy() == key[1]].view(np.uint64)
        second = first if key[1] == key[2] else own[rows["blk"].to_numpy() == key[2]].view(np.uint64)
        edges = np.array(_forest(first, second, bits), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    dealt = members.join(hot, "key").withColumn("blk", F.pmod(F.xxhash64("fp"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", "fp", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))
    return dealt.groupBy("key", "lo", "hi").applyInPandas(compare, "a long, b long")


def near_links(ws: Workspace, fps: DataFrame, bits: int = BITS, bucket: int = 4096, block: int = 1024) -> DataFrame:
    """Links a, b between distinct fingerprints (all of them, but for spanning forests inside crowded variants)."""
    variants = _variants(fps)
    hot = ws.write(variants.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "hot")
    crowded = not hot.isEmpty()
    if crowded:
        variants = variants.join(hot.select("key"), "key", "left_anti")
    left, right = variants.select("key", F.col("fp").alias("a")), variants.select("key", F.col("fp").alias("b"))
    # the planner takes the exploded keys for as small as their fingerprints and would send all of them through the driver
    left = left.hint("merge")
    # a pair reported at a crowded key by its own choice is found there; at others the condition is the same
    links = left.join(right, "key").where(f"a < b and {_linked(bits)}").select("a", "b")
    if crowded:
        links = links.union(_hot_links(_variants(fps), hot, block, bits))
    return ws.write(links, "links")


def near_groups(spark: SparkSession, docs: DataFrame, words_per_shingle: int = 4, bits: int = BITS, bucket: int = 4096, block: int = 1024) -> DataFrame:
    """doc_id, text_key, fp, component_id for every row of ``docs``."""
    ws = Workspace(spark, "simhash")
    rows = ws.write(fingerprints(docs, words_per_shingle), "rows")
    distinct = ws.write(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(ws, near_links(ws, distinct.select("fp"), bits, bucket, block))
    rooted = ws.write(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    least = ws.write(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    named = ws.write(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "component_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark, load(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash_near_dedup": op9_simhash_near_dedup}
ORACLES: dict[str, str] = {}
