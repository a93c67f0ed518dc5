"""Katz backoff language model of order three over words, trained and evaluated in partitioned tables.

An n-gram (h, w) seen in training has probability s(h) d(c) c / C(h), with Good-Turing
discounts d for small counts; an unseen w backs off to alpha(h) P(w | shorter h), where
alpha(h) is the mass that h leaves over the shorter context's mass of the words not seen
after h, so that every context sums to one exactly.  Words are discounted alike and back
off to one unknown token, which takes what is left.  An unseen context backs off with
weight one.  Every text starts after two end tokens.  Where the counts of counts admit no
Good-Turing discounts, absolute discounts n1 / (n1 + 2 n2) are taken (a half if those are
missing).

At scale nothing is collected but counts of counts and figures of a bounded number of
contexts.  Documents become chunks of at most ``CHUNK_TOKENS`` tokens (a longer document
is several pieces); a chunk sends its distinct trigrams, as packed arrays, to buckets, and
a bucket answers each chunk with counts and with sums over contexts, which do not depend
on the discounts; the chunk then evaluates its own tokens.  Pair counts are the trigram
counts' sums over the first word, so one exchange serves both orders: a trigram goes to
the bucket of its middle word h.  Hot words, with over 1 / (4 buckets) of all tokens, would
fill a bucket: their trigrams are dealt by the first two words, after an exchange of their
own has counted their pairs, and those of hot pairs by all three words.  Sums of hot
contexts (at most 4 words and 8 pairs a bucket) are added up on the driver.  A bucket is
held in memory whole; there are so many that one has about ``BUCKET_TOKENS`` tokens.

The counts stay written in tables partitioned by order and bucket; ``lookup`` reads them.

Defined cases: a null text is empty (one end token); a null ``doc_id`` counts as the empty
string for the held-out remainder (held out); equal rows are counted and scored each; with
no training tokens every token is the unknown one (probability one); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, load, text_or_empty
from .encoding import slices, tokens

K = 5
CHUNK_TOKENS = 2_000_000  # below 2**21, so that three numbers of a chunk's words fit 63 bits
CHUNK_BYTES = 8 << 20  # documents that make a chunk, if none is longer
BUCKET_TOKENS = 1_000_000
END = ""  # no word is empty


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers (in as few bytes as the largest needs) or floats, by byte planes."""
    head, body = [len(arrays)], []
    for a in arrays:
        width = 8 if a.dtype.kind == "f" else next(w for w in (1, 2, 4, 8) if int(a.max(initial=0)) < 1 << 8 * w)
        raw = a.astype("<f8" if a.dtype.kind == "f" else f"<u{width}")
        head += [len(a), width, int(a.dtype.kind == "f")]
        body.append(np.ascontiguousarray(raw.view(np.uint8).reshape(-1, width).T).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def _unpack(blob: bytes, wide: bool = True) -> list[np.ndarray]:
    """int64 or float64 arrays; if not ``wide``, unsigned integers of as few bytes as were packed."""
    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    out, at = [], 8 * (1 + 3 * n)
    for size, width, real in np.frombuffer(raw, "<i8", 3 * n, 8).reshape(-1, 3).tolist():
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        own = np.ascontiguousarray(planes.T).view("<f8" if real else f"<u{width}").ravel()
        out.append(own.astype(np.int64) if wide and not real else own)
        at += size * width
    return out


def _pack_words(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("\n".join(words).encode())


def _unpack_words(blob: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(bytes(blob)).decode().split("\n")


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of a rising array, its first value before them."""
    return np.diff(x, prepend=0)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Places where any of the columns differs from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def discounts(n: list[int]) -> np.ndarray:
    """d(0) .. d(K) from the counts of counts n[1] .. n[K + 1]; larger counts are not discounted."""
    d = np.ones(K + 1)
    if all(n[r] > 0 for r in range(1, K + 2)):
        a = (K + 1) * n[K + 1] / n[1]
        if a < 1:
            for r in range(1, K + 1):
                d[r] = ((r + 1) * n[r + 1] / (n[r] * r) - a) / (1 - a)
            if ((d[1:] > 0) & (d[1:] <= 1)).all():
                return d
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.array([1.0, *[(r - cut) / r for r in range(1, K + 1)]])


class Unigrams:
    """P(w) by a word's count; count 0 is the unknown token."""

    def __init__(self, n_of: list[int], total: int):
        self.total, self.d = total, discounts(n_of)
        seen = sum(n_of[r] * r * self.d[r] for r in range(1, K + 1)) + (total - sum(n_of[r] * r for r in range(1, K + 1)))
        left = 1 - seen / total if total else 1.0
        self.unknown = left if left > 1e-12 else 1 / (total + 1)
        self.scale = (1 - self.unknown) / (seen / total) if total else 0.0

    def p(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(count))
        return np.where(count > 0, self.scale * self.d[np.where(count > K, 0, count)] * count / self.total, self.unknown)


class Contexts:
    """What contexts give to their seen words and leave to the others, from their sums and discounts.

    ``sums`` has a row a context: how many words follow r = 1 .. K times, and the sum of larger counts.
    """

    def __init__(self, sums: np.ndarray, d: np.ndarray):
        r = np.arange(1, K + 1)
        self.d, self.size = d, sums[:, :K] @ r + sums[:, K]
        kept = np.divide(sums[:, :K] @ (r * d[1:]) + sums[:, K], self.size, out=np.ones(len(sums)), where=self.size > 0)
        self.left = np.where(1 - kept > 1e-12, 1 - kept, 1 / (self.size + 1))
        self.unit = np.divide((1 - self.left) / kept, self.size, out=np.zeros(len(sums)), where=self.size > 0)

    def p(self, of: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Probability of words seen ``count`` > 0 times after contexts ``of``."""
        return self.unit[of] * self.d[np.where(count > K, 0, count)] * count

    def mass(self, sums: np.ndarray) -> np.ndarray:
        """Sum of probabilities over words whose counts in each context have the sums given."""
        return self.unit * (sums[:, :K] @ (np.arange(1, K + 1) * self.d[1:]) + sums[:, K])

    def alpha(self, mass: np.ndarray) -> np.ndarray:
        """Backoff weights, from the shorter contexts' mass of the words seen."""
        return np.where(self.size > 0, self.left / np.maximum(1 - mass, 1e-300), 1.0)


def count_sums(count: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """``sums`` of ``n`` contexts, from counts and their contexts."""
    sums = np.zeros((n, K + 1), np.int32 if count.sum() < 1 << 31 else np.int64)
    for r in range(1, K + 1):
        sums[:, r - 1] = np.bincount(of[count == r], minlength=n)
    sums[:, K] = np.bincount(of, np.where(count > K, count, 0), n)
    return sums


CHUNK = {"chunk": pa.int64(), "rows": pa.list_(pa.int64()), "doc_ids": pa.list_(pa.int64()), "nulls": pa.list_(pa.bool_()), "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int64()), "leads": pa.list_(pa.int64()), "tokens": pa.binary(), "words": pa.binary(), "counts": pa.binary()}
ENCODED = "chunk long, rows array<long>, doc_ids array<long>, nulls array<boolean>, held array<boolean>, sizes array<long>, leads array<long>, tokens binary, words binary, counts binary"
STATE = "chunk long, rows array<long>, doc_ids array<long>, nulls array<boolean>, held array<boolean>, sizes array<long>, leads array<long>, end int, tokens binary, ids binary, counts binary, hot binary"
SENT = {"bucket": pa.int32(), "chunk": pa.int64(), "blob": pa.binary()}
ANSWER = {"kind": pa.string(), "order": pa.int32(), "part": pa.int32(), "bucket": pa.int32(), "chunk": pa.int64(), "blob": pa.binary(), "r": pa.int32(), "n": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "sums": pa.list_(pa.float64())}
SENT_DDL = "bucket int, chunk long, blob binary"
ANSWER_DDL = "kind string, order int, part int, bucket int, chunk long, blob binary, r int, n long, h1 long, h2 long, sums array<double>"


def _batch(rows: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()], names=list(kinds))


def _answers(rows: list[dict]) -> pa.RecordBatch:
    return _batch([{"order": 0, "part": -1} | r for r in rows], ANSWER)


def _encode(most: int):
    """Chunks: pieces of documents, numbers of their words, the words and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for made, row in enumerate(_made_chunks(batches, most)):
            yield _batch([{"chunk": (part << 32) + made} | row], CHUNK)

    return run


def _made_chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict]:
    for batch in batches:
        at = 0
        for texts in slices(batch.column(2), CHUNK_BYTES):
            rows, ids = (batch.column(i).slice(at, len(texts)).to_pylist() for i in (0, 1))
            at += len(texts)
            words, places, counts = tokens(texts)
            numbers = np.insert(places + 1, np.cumsum(counts), 0)  # number 0 ends a text
            held = [zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d in ids]
            for own, pieces in _chunks(numbers, counts + 1, most):
                if len(pieces) == len(texts) and pieces[-1][1] == counts[-1] + 1 and "" not in words:  # all of them: every number occurs
                    seen, local = np.arange(len(words) + 1), own
                else:
                    seen, local = np.unique(np.append(0, own), return_inverse=True)  # the end token is number 0 even where none stands
                    local = local[1:]
                train = np.concatenate([np.arange(n) >= lead if not held[i] else np.zeros(n, bool) for i, n, lead in pieces])
                yield {
                    "rows": [rows[i] for i, *_ in pieces], "doc_ids": [ids[i] or 0 for i, *_ in pieces], "nulls": [ids[i] is None for i, *_ in pieces], "held": [held[i] for i, *_ in pieces],
                    "sizes": [n for _, n, _ in pieces], "leads": [x for *_, x in pieces], "tokens": _pack(local),
                    "words": _pack_words([words[i - 1] if i else END for i in seen.tolist()]), "counts": _pack(np.bincount(local[train], minlength=len(seen))),
                }


def _chunks(tokens: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Runs of at most ``most`` new tokens: the tokens and the pieces (text, tokens, how many of them lead: they are context, repeated from the piece before)."""
    pieces, run, size, at = [], [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        done = 0
        while done < n:
            if size >= most:
                yield np.concatenate(run), pieces
                pieces, run, size = [], [], 0
            take, lead = min(n - done, most - size), min(2, done)
            run.append(tokens[at + done - lead : at + done + take])
            pieces.append((i, take + lead, lead))
            size, done = size + take, done + take
        at += n
    if pieces:
        yield np.concatenate(run), pieces


def _send_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = _unpack_words(blob)
                (count,) = _unpack(counts)
                to = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
                order = np.argsort(to, kind="stable")
                rows = []
                for at in np.split(order, _starts(to[order])[1:]):
                    text = np.frombuffer(_pack_words([words[i] for i in at.tolist()]), np.uint8)
                    rows.append({"bucket": int(to[at[0]]), "chunk": chunk, "blob": _pack(at, count[at], text)})
                yield _batch(rows, SENT)

    return run


def _histogram(order: int, counts: np.ndarray) -> list[dict]:
    """Counts of counts up to K + 1, the total (r = -1) and the number of entries (r = 0)."""
    known = counts[counts > 0]
    found = [{"kind": "s", "h1": order, "r": r, "n": int((known == r).sum())} for r in range(1, K + 2)]
    return [*found, {"kind": "s", "h1": order, "r": -1, "n": int(known.sum())}, {"kind": "s", "h1": order, "r": 0, "n": len(known)}]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Each bucket's chunks and blobs; rows come sorted by bucket."""
    now, sent = None, []
    for batch in batches:
        for bucket, chunk, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != now:
                if sent:
                    yield now, sent
                now, sent = bucket, []
            sent.append((chunk, blob))
    if sent:
        yield now, sent


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, sent in _buckets(batches):
            ids: dict[str, int] = {}
            places, parts = [], []
            for chunk, blob in sent:
                local, count, text = _unpack(blob)
                words = _unpack_words(text.astype(np.uint8).tobytes())
                places.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
                parts.append((chunk, local, count))
            total = np.zeros(len(ids), np.int64)
            for at, (_, _, count) in zip(places, parts, strict=True):
                total[at] += count  # a chunk sends a word once
            yield _answers([{"kind": "u", "chunk": chunk, "bucket": bucket, "blob": _pack(local, at * buckets + bucket, total[at])} for at, (chunk, local, _) in zip(places, parts, strict=True)])
            text = np.frombuffer(_pack_words(list(ids)), np.uint8)
            yield _answers([*_histogram(1, total), {"kind": "t", "order": 1, "part": bucket, "r": buckets, "n": len(ids), "blob": _pack(total, text)}])

    return run


def _known(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Chunks with global ids and training counts of their words, which are numbered anew by global id."""
    out = []
    for row in left.to_dict("records"):
        (tokens,) = _unpack(row["tokens"])
        n = int(tokens.max()) + 1
        ids, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for blob in right["blob"]:
            local, own, count = _unpack(blob)
            ids[local], counts[local] = own, count
        order = np.argsort(ids)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        out.append(row | {"end": int(rank[0]), "tokens": _pack(rank[tokens]), "ids": _pack(_steps(ids[order])), "counts": _pack(counts[order]), "hot": None})
    return pd.DataFrame(out)


class Grams:
    """A chunk's tokens with the two before each; the leading tokens of a piece are context only."""

    def __init__(self, row: dict, order: int):
        (tokens,), (steps,), (self.counts,) = (_unpack(row[c]) for c in ("tokens", "ids", "counts"))
        self.ids, end = np.cumsum(steps), row["end"]
        sizes, leads = np.array(row["sizes"], np.int64), np.array(row["leads"], np.int64)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = place >= np.repeat(leads, sizes)
        self.train = ~np.repeat(np.array(row["held"], bool), sizes)[own]
        self.tokens, self.sizes = tokens[own], sizes - leads
        self.h1 = np.where(place > 0, np.roll(tokens, 1), end)[own]
        self.h2 = np.where(place > 1, np.roll(tokens, 2), end)[own] if order > 2 else np.full(len(self.tokens), end)

    def hot_pairs(self, hot: int, buckets: int):
        """Distinct pairs (h1, w) of hot h1 and their training counts, by h1 and w; their buckets and the sending order."""
        at = np.flatnonzero((self.counts >= hot)[self.h1])
        pair, seen = _counted(self.h1[at] << 21 | self.tokens[at], self.train[at])
        h1, w = pair >> 21, pair & 0x1FFFFF
        to = (_mix(_mix(self.ids)[h1] ^ _mix(self.ids + 1)[w]) % np.uint64(buckets)).astype(np.int64)
        return h1, w, seen, to, np.argsort(to, kind="stable")


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (below 2**63) in order, and how many of each count."""
    both = np.sort(keys.astype(np.uint64) << np.uint64(1) | train.astype(np.uint64))
    starts = _starts(both >> np.uint64(1))
    seen = np.add.reduceat((both & np.uint64(1)).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    return (both[starts] >> np.uint64(1)).astype(np.int64), seen


class Chunk:
    """One chunk's distinct trigrams in sending order and, if asked for, where its tokens find them."""

    def __init__(self, row: dict, buckets: int, hot: int, hot_pairs: set[tuple[int, int]], order: int, places: bool = False):
        grams = Grams(row, order)
        self.ids, self.counts, self.tokens, self.sizes = grams.ids, grams.counts, grams.tokens, grams.sizes
        key = grams.h1 << 42 | grams.h2 << 21 | grams.tokens
        if places:
            trigram, where = np.unique(key, return_inverse=True)
            seen = np.bincount(where[grams.train], minlength=len(trigram))
        else:
            trigram, seen = _counted(key, grams.train)
        h1, h2, w = trigram >> 42, trigram >> 21 & 0x1FFFFF, trigram & 0x1FFFFF
        self.is_hot = self.counts >= hot
        hot1 = self.is_hot[h1]
        mixed = _mix(self.ids)[h1]
        mixed[hot1] = _mix(mixed[hot1] ^ _mix(self.ids + 1)[h2[hot1]] * np.uint64(3))
        pair = np.zeros(len(trigram), bool)
        if hot_pairs:
            both = np.flatnonzero(hot1 & self.is_hot[h2])
            pair[both] = [x in hot_pairs for x in zip(self.ids[h1[both]].tolist(), self.ids[h2[both]].tolist(), strict=True)]
            mixed[pair] = _mix(mixed[pair] ^ _mix(self.ids + 2)[w[pair]])
        to = (mixed % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        sort = np.argsort(to, kind="stable")  # inside a bucket by global ids, as the words' numbers are
        self.h1, self.h2, self.w, self.seen, self.pair, self.to = h1[sort], h2[sort], w[sort], seen[sort], pair[sort], to[sort].astype(np.int64)
        if places:
            back = np.empty(len(sort), np.int64)
            back[sort] = np.arange(len(sort))
            self.place = back[where]

    def parts(self) -> list[np.ndarray]:
        """Places of each bucket's trigrams."""
        return np.split(np.arange(len(self.to)), _starts(self.to)[1:]) if len(self.to) else []

    def pair_counts(self, blob: bytes) -> np.ndarray:
        """Training count of every trigram's pair (h1, w) where h1 is hot, else 0; ``blob`` has those pairs' counts by h1 and w."""
        (count,) = _unpack(blob)
        at = np.flatnonzero(self.is_hot[self.h1])
        _, where = np.unique(self.h1[at] << 21 | self.w[at], return_inverse=True)
        low = np.zeros(len(self.h1), np.int64)
        low[at] = count[where]
        return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _send_hot(buckets: int, hot: int, order: int):
    """Pairs of hot words; and pairs of two hot words whose share of the chunk makes them able to be hot (row chunk -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Grams(row, order)
            h1, w, seen, to, sort = own.hot_pairs(hot, buckets)
            h1, w, seen, to = h1[sort], w[sort], seen[sort], to[sort]
            rows = []
            for at in np.split(np.arange(len(to)), _starts(to)[1:]) if len(to) else []:
                starts = _starts(h1[at])
                words, local = np.unique(w[at], return_inverse=True)
                blob = _pack(_steps(own.ids[h1[at][starts]]), _sizes(starts, len(at)), _steps(own.ids[words]), own.counts[words], local, seen[at])
                rows.append({"bucket": int(to[at[0]]), "chunk": row["chunk"], "blob": blob})
            is_hot = own.counts >= hot
            both = np.flatnonzero(is_hot[own.h1] & is_hot[own.h2])
            pair, n = _counted(own.h1[both] << 21 | own.h2[both], own.train[both])
            able = n * 8 * buckets >= max(1, len(own.tokens))
            a, b = own.ids[pair[able] >> 21], own.ids[pair[able] & 0x1FFFFF]
            to = (_mix(a ^ b << 1) % np.uint64(buckets)).astype(np.int64)
            rows += [{"bucket": t, "chunk": -1, "blob": _pack(np.array([x, y, m]))} for t, x, y, m in zip(to.tolist(), a.tolist(), b.tolist(), n[able].tolist(), strict=True)]
            if rows:
                yield _batch(rows, SENT)

    return run


def _dense(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct values of several arrays, and each array as places there."""
    values, where = np.unique(np.concatenate(parts), return_inverse=True)
    return values, np.split(where, np.cumsum([len(p) for p in parts])[:-1])


def _count_hot(unigrams: Unigrams, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, sent in _buckets(batches):
            able: dict[tuple[int, int], int] = {}
            for chunk, blob in sent:
                if chunk < 0:
                    (x,) = _unpack(blob)
                    able[x[0].item(), x[1].item()] = able.get((x[0].item(), x[1].item()), 0) + x[2].item()
            rows = [{"kind": "p", "h1": a, "h2": b, "n": n} for (a, b), n in able.items() if n >= least]
            sent = [x for x in sent if x[0] >= 0]
            if not sent:
                yield _answers(rows)
                continue
            parts = [_unpack(blob) for _, blob in sent]
            ctx, a = _dense([np.cumsum(p[0]) for p in parts])
            words, b = _dense([np.cumsum(p[2]) for p in parts])
            known = np.zeros(len(words), np.int64)
            for p, at in zip(parts, b, strict=True):
                known[at] = p[3]
            key = np.concatenate([np.repeat(x, p[1]) << 32 | y[p[4]] for p, x, y in zip(parts, a, b, strict=True)])
            pair, place = np.unique(key, return_inverse=True)
            total = np.bincount(place, np.concatenate([p[5] for p in parts]), len(pair)).astype(np.int64)
            of, w = pair >> 32, pair & 0xFFFFFFFF
            sums, mass = count_sums(total, of, len(ctx)), np.bincount(of, np.where(total > 0, unigrams.p(known[w]), 0), len(ctx))
            answers = [{"kind": "u", "chunk": chunk, "bucket": bucket, "blob": _pack(total[x])} for (chunk, _), x in zip(sent, np.split(place, np.cumsum([len(p[5]) for p in parts])[:-1]), strict=True)]
            rows += [{"kind": "h", "h1": h, "sums": [*map(float, s), m]} for h, s, m in zip(ctx.tolist(), sums.tolist(), mass.tolist(), strict=True)]
            yield _answers([*rows, *answers, *_histogram(2, total), _table(2, bucket, total, ctx[of], None, words[w])])

    return run


def _table(order: int, bucket: int, total: np.ndarray, h1: np.ndarray, h2: np.ndarray | None, w: np.ndarray) -> dict:
    """A bucket's n-grams seen in training, sorted by middle (or only) context word, first word and last word."""
    at = np.flatnonzero(total > 0)
    columns = [_steps(h1[at]), *([] if h2 is None else [h2[at]]), w[at], total[at]]
    return {"kind": "t", "order": order, "part": bucket, "n": len(at), "blob": _pack(*columns)}


def _with_hot(buckets: int, hot: int, order: int):
    """Chunks with the training counts of their hot words' pairs, by the pair's words."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.to_dict("records"):
            *_, to, sort = Grams(row, order).hot_pairs(hot, buckets)
            to, count = to[sort], np.zeros(len(to), np.int64)
            for bucket, blob in right[["bucket", "blob"]].itertuples(index=False):
                lo, hi = np.searchsorted(to, [bucket, bucket + 1])
                (count[sort[lo:hi]],) = _unpack(blob)
            out.append(row | {"hot": _pack(count)})
        return pd.DataFrame(out)

    return run


def _send_trigrams(buckets: int, hot: int, hot_pairs: set, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Chunk(row, buckets, hot, hot_pairs, order)
            low = own.pair_counts(row["hot"])
            rows = []
            for at in own.parts():
                h1, h2 = own.h1[at], own.h2[at]
                context, first = _starts(h1, h2), _starts(h1)
                words, local = np.unique(own.w[at], return_inverse=True)
                is_hot = own.is_hot[h1]
                blob = _pack(
                    _steps(own.ids[h1[first]]), np.diff(np.append(np.searchsorted(context, first), len(context))), own.is_hot[h1[first]].astype(np.uint8),
                    own.ids[h2[context]], _sizes(context, len(at)), own.pair[at][context].astype(np.uint8),
                    _steps(own.ids[words]), own.counts[words], local, own.seen[at], low[at][is_hot],
                )
                rows.append({"bucket": int(own.to[at[0]]), "chunk": row["chunk"], "blob": blob})
                if len(rows) >= 64:
                    yield _batch(rows, SENT)
                    rows = []
            if rows:
                yield _batch(rows, SENT)

    return run


def _count_trigrams(unigrams: Unigrams, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, sent in _buckets(batches):
            yield from _count_bucket(bucket, sent, unigrams, order)

    return run


def _count_bucket(bucket: int, sent: list[tuple[int, bytes]], unigrams: Unigrams, order: int) -> Iterator[pa.RecordBatch]:
    parts = [_unpack(blob, wide=False) for _, blob in sent]
    first, a = _dense([np.cumsum(p[0], dtype=np.int64) for p in parts])
    second, b = _dense([p[3].astype(np.int64) for p in parts])
    words, w = _dense([np.cumsum(p[6], dtype=np.int64) for p in parts])
    known, is_hot = np.zeros(len(words), np.int64), np.zeros(len(first), bool)
    for p, x, y in zip(parts, a, w, strict=True):
        is_hot[x], known[y] = p[2] > 0, p[7]
    wb, ww = (max(1, int(len(x) - 1).bit_length()) for x in (second, words))
    if wb + ww + max(1, int(len(first) - 1).bit_length()) > 63:
        raise ValueError("a bucket's words do not fit its keys: more buckets are needed")
    sizes = [len(p[8]) for p in parts]
    key, at = np.empty(sum(sizes), np.int64), 0
    for p, x, y, z in zip(parts, a, b, w, strict=True):
        key[at : at + len(p[8])] = np.repeat(np.repeat(x, p[1]) << wb | y, p[4]) << ww | z[p[8]]
        at += len(p[8])
    del a, b, w
    sort = np.argsort(key, kind="stable").astype(np.uint32)  # sorted runs
    key = key[sort]
    starts = _starts(key)
    distinct = key[starts]
    del key
    place = np.empty(len(sort), np.uint32)
    place[sort] = np.repeat(np.arange(len(starts), dtype=np.uint32), _sizes(starts, len(sort)))
    total = np.add.reduceat(np.concatenate([p[9] for p in parts])[sort], starts, dtype=np.int64)
    del sort, starts
    h1, word = (distinct >> (wb + ww)).astype(np.int32), (distinct & ((1 << ww) - 1)).astype(np.int32)
    # counts of pairs: sums over the second word; those of hot words came with the trigrams
    pair, of_pair = np.unique(distinct >> (wb + ww) << ww | word, return_inverse=True)
    of_pair = of_pair.astype(np.uint32)
    pair_total = np.bincount(of_pair, total, len(pair)).astype(np.int64)
    pair_h1, pair_w = (pair >> ww).astype(np.int32), (pair & ((1 << ww) - 1)).astype(np.int32)
    pair_hot = is_hot[pair_h1]
    del pair
    low, at = pair_total[of_pair], 0
    del of_pair
    for p, n in zip(parts, sizes, strict=True):
        item = np.repeat(np.repeat(p[2] > 0, p[1]), p[4])
        low[place[at : at + n][item]] = p[10]
        at += n
    # contexts of two words, and of one word that is not hot
    context_at = _starts(distinct >> ww)
    context = np.repeat(np.arange(len(context_at), dtype=np.int32), _sizes(context_at, len(distinct)))
    sums, seen = count_sums(total, context, len(context_at)), total > 0
    lower = count_sums(low[seen], context[seen], len(context_at))
    cold = ~pair_hot
    sums2 = count_sums(pair_total[cold], pair_h1[cold], len(first))
    mass = np.bincount(pair_h1[cold], np.where(pair_total[cold] > 0, unigrams.p(known[pair_w[cold]]), 0), len(first))
    at, hot_contexts = 0, set()
    for (chunk, _), p in zip(sent, parts, strict=True):
        own = place[at : at + len(p[8])]
        at += len(own)
        begin = np.cumsum(p[4], dtype=np.int64) - p[4]
        ctx, c = context[own[begin]], total[own]
        hot_contexts.update(ctx[p[5] > 0].tolist())
        need = c == 0 if order > 2 else np.ones(len(c), bool)
        by_context = np.logical_or.reduceat(need, begin)
        begin1 = np.cumsum(p[1], dtype=np.int64) - p[1]
        by_first = np.logical_or.reduceat(by_context, begin1) & (p[2] == 0)
        asked = h1[own[begin[begin1]]][by_first]
        blob = _pack(c, sums[ctx].ravel(), lower[ctx[by_context]].ravel(), low[own[need]], sums2[asked].ravel(), mass[asked])
        yield _answers([{"kind": "u", "bucket": bucket, "chunk": chunk, "blob": blob}])
    rows = []
    for i in hot_contexts:
        x = distinct[context_at[i]]
        rows.append({"kind": "h", "h1": int(first[x >> (wb + ww)]), "h2": int(second[x >> ww & ((1 << wb) - 1)]), "sums": [*map(float, sums[i]), *map(float, lower[i])]})
    tables = [_table(2, bucket, pair_total[cold], first[pair_h1[cold]], None, words[pair_w[cold]])]
    if order > 2:
        tables.append(_table(3, bucket, total, first[h1], second[distinct >> ww & ((1 << wb) - 1)], words[word]))
    yield _answers([*rows, *_histogram(3, total), *_histogram(2, pair_total[cold]), *tables])


def _score(buckets: int, hot: int, hot_pairs: dict, hot_words: dict, unigrams: Unigrams, d2: np.ndarray, d3: np.ndarray, n_tokens: int, n_words: int, order: int):
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.to_dict("records"):
            own = Chunk(row, buckets, hot, set(hot_pairs), order, places=True)
            n = len(own.h1)
            context, first = _starts(own.to, own.h1, own.h2), _starts(own.to, own.h1)
            of = np.repeat(np.arange(len(context)), _sizes(context, n))
            of1 = np.repeat(np.arange(len(first)), _sizes(first, n))
            c, low = np.zeros(n, np.int64), np.zeros(n, np.int64)
            kind = np.int32 if n_tokens < 1 << 31 else np.int64
            sums, lower = (np.zeros((len(context), K + 1), kind) for _ in "12")
            sums2, mass1 = np.zeros((len(first), K + 1), kind), np.zeros(len(first))
            of_context = of1[context]
            cold = ~own.is_hot[own.h1[first]]
            for bucket, blob in right[["bucket", "blob"]].itertuples(index=False):
                lo, hi = np.searchsorted(own.to, [bucket, bucket + 1])
                count, s, m, l, s2, m1 = _unpack(blob)
                at, at1 = slice(*np.searchsorted(context, [lo, hi])), slice(*np.searchsorted(first, [lo, hi]))
                c[lo:hi], sums[at] = count, s.reshape(-1, K + 1)
                need = count == 0 if order > 2 else np.ones(len(count), bool)
                by_context = np.logical_or.reduceat(need, context[at] - lo)
                by_first = np.logical_or.reduceat(by_context, np.searchsorted(context[at], first[at1])) & cold[at1]
                lower[np.arange(at.start, at.stop)[by_context]] = m.reshape(-1, K + 1)
                low[lo + np.flatnonzero(need)] = l
                asked = np.arange(at1.start, at1.stop)[by_first]
                sums2[asked], mass1[asked] = s2.reshape(-1, K + 1), m1
            for i in np.flatnonzero(~cold):
                *s, mass1[i] = hot_words[int(own.ids[own.h1[first[i]]])]
                sums2[i] = s
            for i in np.flatnonzero(own.pair[context]):
                x = hot_pairs[int(own.ids[own.h1[context[i]]]), int(own.ids[own.h2[context[i]]])]
                sums[i], lower[i] = x[: K + 1], x[K + 1 :]
            two, p1 = Contexts(sums2, d2), unigrams.p(own.counts)
            p = np.where(low > 0, two.p(of1, low), two.alpha(mass1)[of1] * p1[own.w])
            if order > 2:
                three = Contexts(sums, d3)
                unit = two.unit[of_context] * (lower[:, :K] @ (np.arange(1, K + 1) * d2[1:]) + lower[:, K])
                p = np.where(c > 0, three.p(of, c), three.alpha(unit)[of] * p)
            base = np.log10((own.counts + 0.1) / (n_tokens + 0.1 * (n_words + 1)))[own.tokens]
            starts = np.cumsum(own.sizes) - own.sizes
            add = lambda x: np.add.reduceat(x, starts)  # noqa: B023,E731
            columns = [row["rows"], pd.arrays.IntegerArray(np.array(row["doc_ids"], np.int64), np.array(row["nulls"], bool)), row["held"], own.sizes, add((own.counts > 0)[own.tokens].astype(np.int64)), add(base), add(np.log10(p)[own.place])]
            out.append(pd.DataFrame(dict(zip(names, columns, strict=True))))
        return pd.concat(out)

    return run


def _stats(answers: DataFrame) -> dict[int, tuple[list[int], int, int]]:
    """Per order: counts of counts, the sum of counts, the number of n-grams."""
    got = {(r.h1, r.r): r.n for r in answers.where("kind = 's'").groupBy("h1", "r").agg(F.sum("n").alias("n")).collect()}
    return {n: ([0, *[got.get((n, r), 0) for r in range(1, K + 2)]], got.get((n, -1), 0), got.get((n, 0), 0)) for n in (1, 2, 3)}


def _hot_sums(answers: DataFrame, n: int) -> dict:
    """Sums of hot contexts over the buckets that hold a part."""
    rows = answers.where("kind = 'h'").groupBy("h1", "h2").agg(*[F.sum(F.col("sums")[i]) for i in range(n)]).collect()
    return {r[0] if r[1] is None else (r[0], r[1]): list(r[2:]) for r in rows}


def katz_scores(spark: SparkSession, docs: DataFrame, order: int = 3, buckets: int | None = None, hot: int | None = None, chunk_tokens: int = CHUNK_TOKENS, ws: Workspace | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``; ``order`` is 2 or 3.

    ``hot``: tokens from which a word counts as hot (by default a quarter of a bucket, and 1000 at least).  The tables stay in ``ws``.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    ws = ws or Workspace(spark, "katz")
    p = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    chunks = ws.write(rows.mapInArrow(_encode(chunk_tokens), ENCODED), "chunks")

    def dealt(sent: DataFrame, n: int) -> DataFrame:
        return sent.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")

    words = dealt(chunks.select("chunk", "words", "counts").mapInArrow(_send_words(p), SENT_DDL), p)
    unigram_table = ws.write(words.mapInArrow(_count_words(p), ANSWER_DDL), "words", ["kind", "order", "part"])
    n_of, total, n_words = _stats(unigram_table)[1]
    model = Unigrams(n_of, total)
    known = unigram_table.where("kind = 'u'").select("chunk", "blob")
    left = chunks.select("chunk", "rows", "doc_ids", "nulls", "held", "sizes", "leads", "tokens")
    state = ws.write(left.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(_known, STATE), "state")
    ws.drop("chunks")
    ws.drop("words/kind=u")
    n = buckets or max(p, total // BUCKET_TOKENS)
    hot = hot or max(1000, total // (4 * n))
    first = dealt(state.mapInArrow(_send_hot(n, hot, order), SENT_DDL), n)
    pairs = ws.write(first.mapInArrow(_count_hot(model, max(1, total // (8 * n))), ANSWER_DDL), "pairs", ["kind", "order", "part"])
    hot_words = _hot_sums(pairs, K + 2)
    able = {(r.h1, r.h2) for r in pairs.where("kind = 'p'").collect()} if order > 2 else set()  # at most 8 a bucket
    joined = state.groupBy("chunk").cogroup(pairs.where("kind = 'u'").select("chunk", "bucket", "blob").groupBy("chunk"))
    ready = ws.write(joined.applyInPandas(_with_hot(n, hot, order), STATE), "ready")
    ws.drop("state")
    ws.drop("pairs/kind=u")
    sent = dealt(ready.mapInArrow(_send_trigrams(n, hot, able, order), SENT_DDL), n)
    trigrams = ws.write(sent.mapInArrow(_count_trigrams(model, order), ANSWER_DDL), "trigrams", ["kind", "order", "part"])
    stats, more = _stats(trigrams), _stats(pairs)
    d2 = discounts([a + b for a, b in zip(stats[2][0], more[2][0], strict=True)])
    score = _score(n, hot, _hot_sums(trigrams, 2 * (K + 1)), hot_words, model, d2, discounts(stats[3][0]), total, n_words, order)
    both = ready.groupBy("chunk").cogroup(trigrams.where("kind = 'u'").select("chunk", "bucket", "blob").groupBy("chunk"))
    pieces = both.applyInPandas(score, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    whole = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def lookup(spark: SparkSession, path: str, order: int) -> DataFrame:
    """The n-grams of a model's tables below ``path`` as rows: h2, h1, w (word ids; order 1: word) and count."""
    folders = {1: ["words"], 2: ["pairs", "trigrams"], 3: ["trigrams"]}[order]
    found = [spark.read.option("basePath", f"{path}/{f}").schema(ANSWER_DDL).parquet(f"{path}/{f}").where(f"kind = 't' and order = {order}") for f in folders]
    table = found[0] if len(found) == 1 else found[0].union(found[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buckets, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns = _unpack(blob)
                if order == 1:  # a word's id is its place in its bucket and the bucket
                    words = _unpack_words(columns[1].astype(np.uint8).tobytes())
                    own = [None, None, np.arange(len(words)) * buckets + part, columns[0], words]
                else:
                    own = [None if order == 2 else columns[1], np.cumsum(columns[0]), columns[-2], columns[-1], None]
                n = len(own[3])
                yield pa.RecordBatch.from_arrays([pa.nulls(n, k) if x is None else pa.array(x, k) for x, k in zip(own, (*[pa.int64()] * 4, pa.string()), strict=True)], names=["h2", "h1", "w", "count", "word"])

    return table.select("part", "r", "blob").mapInArrow(run, "h2 long, h1 long, w long, count long, word string")


def op1_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(spark, load(spark, sf_dir, "documents"))


QUERIES = {"op1_katz_score": op1_katz_score}
ORACLES: dict[str, str] = {}
