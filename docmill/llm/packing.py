"""Packing along a space-filling curve.

A document's vector is its bag of token ids, hashed to ``HASHED`` counts, of unit
length, under a fixed pseudo-random projection into a few dimensions.  Coordinates
are centred and scaled by their mean and deviation over all documents, become
integers through the normal distribution function, and give a Hilbert key; documents
are range-sorted by that key, and every range is cut, in curve order, into sequences
of ``length`` tokens.  Neighbours on the curve, which are close in content, so share
sequences.  The end of a range is cut into sequences whose lengths are powers of two,
which need no padding.

The range sort breaks ties by a hash of the id, the id and a row number, so that
equal keys (copies) are dealt over several ranges.

Defined cases: a null text is empty (its only id is the end id); a null
``doc_id`` stays null and is packed like any other; a coordinate in which all
documents agree stays in the middle of its axis; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, load, text_or_empty
from .encoding import END_ID, Ragged, encoder, slices, vocabulary_path

LENGTH = 2048
HASHED, DIMENSIONS, BITS, SEED = 1024, 4, 12, 20_240


def projections(n_counts: int, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """A fixed random direction for every hashed count."""
    return np.random.default_rng(seed).standard_normal((n_counts, dimensions)).astype(np.float32)


def vectors(docs: Ragged, table: np.ndarray, block: int = 512) -> np.ndarray:
    """Projected unit vectors of hashed counts, a row a document."""
    out = np.zeros((len(docs.sizes), table.shape[1]), np.float32)
    starts = docs.ends - docs.sizes
    for lo in range(0, len(out), block):
        sizes = docs.sizes[lo : lo + block]
        own = docs.ids[starts[lo] : docs.ends[lo + len(sizes) - 1]] & (HASHED - 1)
        counts = np.bincount(np.repeat(np.arange(len(sizes)) * HASHED, sizes) + own, minlength=len(sizes) * HASHED).reshape(-1, HASHED).astype(np.float32)
        out[lo : lo + block] = counts @ table / np.sqrt(np.maximum((counts * counts).sum(1, keepdims=True), 1))
    return out


def grid(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Coordinates in [0, 2**bits) through the normal distribution function."""
    share = np.fromiter(map(math.erf, (points.ravel() / math.sqrt(2)).tolist()), np.float64, points.size).reshape(points.shape) / 2 + 0.5
    return np.minimum((1 << bits) - 1, (share * (1 << bits)).astype(np.int64))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of grid points (a row each) on the Hilbert curve (the transpose algorithm of Skilling, 2004)."""
    x = [np.array(c, np.int64) for c in points.T]
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            up = x[i] & q > 0
            t = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(up, low, t)
            x[i] = x[i] ^ t if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ t) >> b & 1)
    return key


def _encode(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        table, narrow = projections(HASHED), own.tokenizer.get_vocab_size() + 1 <= 65536
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                docs = own.encode_slice(texts, END_ID)
                raw, width = (docs.ids.astype("<u2").tobytes(), 2) if narrow else (docs.ids.astype("<u4").tobytes(), 4)
                blobs = [pack(raw[(e - n) * width : e * width]) for e, n in zip(docs.ends.tolist(), docs.sizes.tolist(), strict=True)]
                points = vectors(docs, table).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(docs.sizes, pa.int64()), pa.array(blobs, pa.binary()), *[pa.array(np.ascontiguousarray(c)) for c in points.T]],
                    names=["doc_id", "n", "ids", *[f"v{i}" for i in range(DIMENSIONS)]],
                )
                at += len(texts)

    return run


def curve_key(encoded: DataFrame) -> Column:
    """The Hilbert key of v0.., centred and scaled over all rows."""
    names = [f"v{i}" for i in range(DIMENSIONS)]
    got = encoded.agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
    centre = np.array([x or 0.0 for x in got[:DIMENSIONS]])
    scale = np.array([x if x and x > 1e-12 else 1.0 for x in got[DIMENSIONS:]])

    def key(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_keys(grid((np.stack(columns, 1) - centre) / scale)))

    return F.pandas_udf(key, "long")(*names)


def sequence_room(left: int, length: int) -> int:
    """Length of the next sequence when ``left`` tokens remain in a range: full, or the largest power of two."""
    return length if left >= length else 1 << (left.bit_length() - 1)


def _pack(length: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        sequence, rows = TaskContext.get().partitionId() << 36, []
        held: list[tuple] = []  # documents, with less than one sequence's tokens, that wait for more
        waiting = 0

        def emit(room: int) -> None:
            nonlocal sequence, waiting, held
            offset = 0
            while offset < room:
                doc_id, start, ids, total = held[0]
                take = min(room - offset, len(ids) // 4)
                rows.append((doc_id, start, take, zlib.crc32(ids[: take * 4]), total, sequence, offset))
                offset += take
                if take * 4 == len(ids):
                    held.pop(0)
                else:
                    held[0] = (doc_id, start + take, ids[take * 4 :], total)
            waiting -= room
            sequence += 1

        def flush() -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = unpack(blob)
                held.append((doc_id, 0, memoryview(raw if wide else np.frombuffer(raw, "<u2").astype("<u4").tobytes()), n))
                waiting += n
                while waiting >= length:
                    emit(length)
                if len(rows) > 20_000:
                    yield flush()
        while waiting:
            emit(sequence_room(waiting, length))
        yield flush()

    return run


def pack_documents(spark: SparkSession, docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, partitions: int | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    vocabulary = vocabulary or vocabulary_path()
    ws = Workspace(spark, "packing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    encoded = ws.write(rows.mapInArrow(_encode(vocabulary), "doc_id long, n long, ids binary, " + ", ".join(f"v{i} double" for i in range(DIMENSIONS))), "encoded")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("curve"), F.xxhash64("doc_id"), F.col("doc_id"), F.col("row")]
    keyed = encoded.withColumn("curve", curve_key(encoded)).select("doc_id", "n", "ids", "curve", F.monotonically_increasing_id().alias("row"))
    along = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    wide = encoder(vocabulary).tokenizer.get_vocab_size() + 1 > 65536
    return along.select("doc_id", "n", "ids").mapInArrow(_pack(length, wide), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op4_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, load(spark, sf_dir, "documents"))


QUERIES = {"op4_curve_packing": op4_curve_packing}
ORACLES: dict[str, str] = {}
