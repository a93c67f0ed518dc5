"""Token-id files: every document compressed on its own with a shared dictionary.

A zstandard dictionary is trained on the serialized id arrays of a bounded sample
of documents and stored beside the shards.  Documents are range-partitioned by
id; each task encodes its range and writes one shard:

    magic "DMTOK1\\0\\0", sha-256 of the dictionary (32 bytes),
    one zstandard frame a document (ids, little-endian unsigned 32-bit),
    index: for every document id, frame offset, frame length, number of ids
           (four little-endian 64-bit integers),
    offset of the index, number of documents (two 64-bit integers).

A reader finds a document by the index and decompresses that frame alone.
Shards are written to the shared store through its file-system URI.  A task
writes under a name of its own and reports it; only reported names count, so
retried and speculative tasks leave unread files at worst.

Defined cases: a null text is empty (its ids are the end id alone); a null
``doc_id`` comes before every number; equal ids stand next to each other, ordered
by a hash of their texts; an empty table gives no shards and an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, load, text_or_empty
from .encoding import END_ID, WordEncoder, encoder, slices, vocabulary_path

MAGIC = b"DMTOK1\0\0"
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("n", "<i8")])
NO_ID = -(2**63)
#: Bound of the dictionary's sample: so many documents, of at most so many bytes of text each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 65536, 65536


def store(uri: str):
    """File system and path of a URI; a path without a scheme is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def read_bytes(uri: str) -> bytes:
    system, path = store(uri)
    with system.open_input_file(path) as f:
        return f.readall()


def write_bytes(uri: str, data: bytes) -> None:
    system, path = store(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as f:
        f.write(data)


def train_dictionary(spark: SparkSession, docs: DataFrame, vocabulary: str) -> bytes:
    """From about ``SAMPLE_DOCS`` documents, one for each chosen hash of an id; too little text for training gives a raw dictionary of it.

    The share of hashes is set by the number of rows, so that no task sends or sorts texts that are not in the sample.
    """
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    able = docs.select(F.xxhash64(docs["doc_id"].cast("long")).alias("h"), text_or_empty(docs).alias("text"))
    able = able.where((F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40))) & (F.octet_length("text") <= SAMPLE_BYTES) & (F.octet_length("text") > 0))
    chosen = able.groupBy("h").agg(F.min("text").alias("text")).limit(2 * SAMPLE_DOCS).collect()
    own = encoder(vocabulary)
    sample = [own.encode(r.text.encode()) for r in sorted(chosen, key=lambda r: r.h)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[-DICTIONARY_BYTES:] or b"\0" * 8


class ShardReader:
    """Random access to one shard: reads the index, then single frames."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = store(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        if self.file.read_at(8, 0) != MAGIC or self.file.read_at(32, 8) != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri}: not a shard of this dictionary")
        at, n = struct.unpack("<qq", self.file.read_at(16, size - 16))
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, at), INDEX)
        self.unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress

    def ids(self, place: int) -> bytes:
        _, offset, length, n = self.index[place].item()
        return self.unpack(self.file.read_at(length, offset), max_output_size=n * 4)

    def find(self, doc_id: int) -> list[int]:
        """Places of a document; the index is sorted by id."""
        lo, hi = np.searchsorted(self.index["doc_id"], [doc_id, doc_id + 1])
        return list(range(int(lo), int(hi)))

    def close(self) -> None:
        self.file.close()


def encoded(own: WordEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """doc_id and serialized ids, with the end id, of each row (doc_id, text)."""
    for batch in batches:
        at = 0
        for texts in slices(batch.column(1)):
            docs = own.encode_slice(texts, END_ID)
            raw = docs.ids.astype("<u4").tobytes()
            spans = zip(docs.ends.tolist(), docs.sizes.tolist(), strict=True)
            yield from zip(batch.column(0).slice(at, len(texts)).to_pylist(), (raw[(e - n) * 4 : e * 4] for e, n in spans), strict=True)
            at += len(texts)


def _shard_writer(root: str, vocabulary: str, dictionary: bytes, level: int):
    digest = hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        uri = f"{root}/shards/{task.partitionId():06d}-{task.taskAttemptId()}.dmtok"
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
        own, index, out, at, total = encoder(vocabulary), [], None, 40, 0
        try:
            for doc_id, ids in encoded(own, batches):
                if out is None:
                    system, path = store(uri)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(path)
                    out.write(MAGIC + digest)
                frame = pack(ids)
                out.write(frame)
                index.append((NO_ID if doc_id is None else doc_id, at, len(frame), len(ids) // 4))
                at += len(frame)
                total += len(ids) // 4
            if out is not None:
                out.write(np.array(index, INDEX).tobytes() + struct.pack("<qq", at, len(index)))
        finally:
            if out is not None:
                out.close()
        if index:
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "uri": [uri], "n_docs": [len(index)], "n_tokens": [total]})

    return run


def write_token_files(spark: SparkSession, docs: DataFrame, root: str, vocabulary: str | None = None, level: int = 3, partitions: int | None = None) -> tuple[DataFrame, bytes]:
    """Write shards below ``root``; returns the manifest (part, uri, n_docs, n_tokens) and the dictionary."""
    vocabulary = vocabulary or vocabulary_path()
    dictionary = train_dictionary(spark, docs, vocabulary)
    write_bytes(f"{root}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict", dictionary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    made = ranged.mapInArrow(_shard_writer(root, vocabulary, dictionary, level), "part long, uri string, n_docs long, n_tokens long")
    made.write.parquet(f"{root}/manifest")
    return spark.read.schema(made.schema).parquet(f"{root}/manifest"), dictionary


def read_token_files(spark: SparkSession, manifest: DataFrame, dictionary: bytes) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(uri, dictionary)
                for lo in range(0, len(shard.index), 5000):
                    part = shard.index[lo : lo + 5000]
                    ids = [shard.ids(lo + i) for i in range(len(part))]
                    if any(len(x) != 4 * n for x, n in zip(ids, part["n"].tolist(), strict=True)):
                        raise ValueError(f"{uri}: a frame's length differs from its index")
                    starts = first + np.concatenate(([0], np.cumsum(part["n"])[:-1]))
                    first += int(part["n"].sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part["doc_id"], mask=part["doc_id"] == NO_ID), pa.array(starts, pa.int64()), pa.array(part["n"].copy()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                shard.close()

    # the manifest has one row a shard: few, and summed in order
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.select("uri", before.alias("first"))
    return shards.repartition(max(1, manifest.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "token-files")
    manifest, dictionary = write_token_files(spark, load(spark, sf_dir, "documents"), ws.path)
    return read_token_files(spark, manifest, dictionary)


QUERIES = {"op10_token_files": op10_token_files}
ORACLES: dict[str, str] = {}
