"""Secret scans through encoded layers.

Three kinds of secrets are found by fixed patterns in the text as it stands (the
base spans).  A worklist then unwraps encodings: URL escapes and Unicode escapes
are undone over the whole layer, base64 runs are decoded on their own, and gzip,
zlib, bzip2, xz and zstandard streams are decompressed, all their members and frames,
wherever they stand in a layer (raw deflate, which has no mark, where a base64 run is
one).  Bytes become layers of text: UTF-8, or else one character a byte, so that what
they hold is unwrapped further whatever it is; and UTF-16 where every other byte is zero.
Every layer that is new is scanned and unwrapped again, until nothing new
appears; a layer seen before at the same place is a cycle and is dropped.  Each
layer maps its characters to the characters of its parent, so a finding in any
depth is reported as a span of the original text.  Time is in proportion to the layers.

A decompressed layer is read up to ``MAX_LAYER`` bytes, a bound on memory
against compression bombs; ``n_cut`` counts the layers that were longer.

Defined cases: a null text is empty and has no spans; a null ``doc_id`` stays
null; equal rows are scanned each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a maximal run shorter than 18 characters holds no longer one
HEX = re.compile(r"[0-9a-f]{16,}")
#: A whole token, up to white space, that holds an escape.
URL_ESCAPES = re.compile(r"(?<![!-~])(?:[!-$&-~]++|%(?![0-9A-Fa-f]{2}))*+(?:%[0-9A-Fa-f]{2}(?:[!-$&-~]++|%(?![0-9A-Fa-f]{2}))*+)++")
URL_ONE = re.compile(r"%([0-9A-Fa-f]{2})|.", re.DOTALL)
UNICODE_ESCAPES = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
UNICODE_ONE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*(?:\r?\n[A-Za-z0-9+/_-]{1,15}(?==))?={0,2}")
#: How streams begin, a character a byte: gzip, zlib, bzip2, xz, zstandard and its frames to skip.
STREAM = re.compile("\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9]|\xfd7zXZ\0|(?=\\(\xb5/\xfd)|[P-_]\\*M\x18")
STREAM_HINTS = ("\x1f\x8b", "x\x01", "x^", "x\x9c", "x\xda", "BZh", "\xfd7z", "\xb5/\xfd", "*M\x18")
BYTES = re.compile("[\0-\xff]+")
MAX_LAYER = 1 << 28
STEP, ZSTD_STEP = 1 << 16, 1024  # a zstandard stream takes no bound on what it makes, so it is fed little

Span = tuple[int, int]
Mapper = Callable[[int, int], Span]


def find(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _pieces(text: str, runs: re.Pattern, decode: Callable[[re.Match], list[tuple[str, int, int]]]) -> tuple[str, Mapper] | None:
    """Replace every run by its decoded characters, each with the span it came from."""
    out: list[str] = []
    marks: list[tuple[int, int, int]] = []  # place in the layer, place in the parent, width there (0: plain characters follow)
    at = size = 0
    for m in runs.finditer(text):
        marks.append((size, at, 0))
        out.append(text[at : m.start()])
        size += m.start() - at
        for chars, start, end in decode(m):
            marks.append((size, start, end - start))
            out.append(chars)
            size += len(chars)
        at = m.end()
    if not out:
        return None
    marks.append((size, at, 0))
    out.append(text[at:])
    places = [x[0] for x in marks]

    def up(start: int, end: int) -> Span:
        where = lambda i: marks[bisect_right(places, i) - 1]
        place, parent, width = where(start)
        first = parent if width else parent + start - place
        place, parent, width = where(end - 1)
        return first, parent + width if width else parent + end - place

    return "".join(out), up


def _url(m: re.Match) -> list[tuple[str, int, int]]:
    """Characters of one token; if its bytes are no UTF-8, each is a character."""
    marks = [(int(x[1], 16) if x[1] else ord(x[0]), x.start(), x.end()) for x in URL_ONE.finditer(m[0])]
    raw, found, i = bytes(x[0] for x in marks), [], 0
    text = _utf8(raw)
    for char in raw.decode("latin-1") if text is None else text:
        width = 1 if text is None else len(char.encode())
        found.append((char, m.start() + marks[i][1], m.start() + marks[i + width - 1][2]))
        i += width
    return found


def _unicode(m: re.Match) -> list[tuple[str, int, int]]:
    found: list[tuple[str, int, int]] = []
    for x in UNICODE_ONE.finditer(m[0]):
        code = int(x[5]) if x[5] else int(x[1] or x[2] or x[3] or x[4] or x[6], 16)
        char = chr(code) if code < 0x110000 else "\ufffd"
        if found and "\udc00" <= char <= "\udfff" and "\ud800" <= found[-1][0] <= "\udbff":
            last = found.pop()
            char, start = chr(0x10000 + ((ord(last[0]) - 0xD800) << 10) + ord(char) - 0xDC00), last[1]
        else:
            start = m.start() + x.start()
        found.append((char, start, m.start() + x.end()))
    return found


def _stream(data: memoryview) -> tuple[object, int] | None:
    """A decompressor for the stream at the start and the bytes to feed it at once, or None and the length of a frame to skip."""
    start = bytes(data[:8])
    if start[:2] == b"\x1f\x8b" or start[:1] == b"x" and len(start) > 1 and int.from_bytes(start[:2]) % 31 == 0:
        return zlib.decompressobj(47), STEP  # gzip or zlib by the header
    if start[:3] == b"BZh":
        return bz2.BZ2Decompressor(), STEP
    if start[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor(), STEP
    if start[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj(), ZSTD_STEP
    if len(start) == 8 and 0x50 <= start[0] <= 0x5F and start[1:4] == b"\x2a\x4d\x18":
        return None, 8 + int.from_bytes(start[4:8], "little")
    return None


def _member(stream: object, data: memoryview, room: int, step: int) -> tuple[bytes, int]:
    """Content, up to ``room`` bytes and a little more, and consumed bytes of one member or frame; a broken one gives what came before the fault."""
    out, size, at = [], 0, 0
    while at < len(data) and not stream.eof and size < room:
        part = data[at : at + step]
        at += len(part)
        try:
            if step == ZSTD_STEP:
                out.append(stream.decompress(part))
            else:
                out.append(stream.decompress(part, room - size))
                while size + len(out[-1]) < room and not stream.eof and (rest := getattr(stream, "unconsumed_tail", b"")):
                    size += len(out[-1])
                    out.append(stream.decompress(rest, room - size))
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
            return b"".join(out), 0
        size += len(out[-1])
    return b"".join(out), at - len(stream.unused_data) if stream.eof else at


def inflate(data: bytes | memoryview, room: int | None = None) -> tuple[bytes, int, bool] | None:
    """The content of a compressed stream, of all its members and frames, how many bytes it takes, and whether it was cut; None if it is none."""
    data, room = memoryview(data), room or MAX_LAYER
    out: list[bytes] = []
    size = at = 0
    while at < len(data) and size < room and (found := _stream(data[at:])) is not None:
        stream, step = found
        if stream is None:
            out.append(b"")
            at += step
            continue
        content, taken = _member(stream, data[at:], room - size, step)
        if not taken and not content:
            break
        out.append(content)
        size += len(content)
        if not taken:
            at = len(data)
            break
        at += taken
        while at < len(data) and data[at] == 0:  # padding between members
            at += 1
    return (b"".join(out)[:room], min(at, len(data)), size >= room) if out else None


def _deflated(data: bytes) -> tuple[bytes, bool] | None:
    """The content of a raw deflate stream that ends where the data end."""
    stream = zlib.decompressobj(-15)
    try:
        content = stream.decompress(data, MAX_LAYER)
    except zlib.error:
        return None
    cut = len(content) >= MAX_LAYER
    return (content, cut) if content and (cut or stream.eof and not stream.unused_data) else None


def _utf8(data: bytes) -> str | None:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


def readings(data: bytes) -> Iterator[tuple[str, np.ndarray | None]]:
    """Texts that bytes may be, each with the end of every character in bytes (None: a character a byte)."""
    text = _utf8(data)
    if text is None:
        yield data.decode("latin-1"), None
    elif text.isascii():
        yield text, None
    else:
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        yield text, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
    if len(data) >= 4 and 0 in data:
        zero = np.frombuffer(data, np.uint8) == 0
        for name, at in (("utf-16-le", 1), ("utf-16-be", 0)):
            if zero[at::2].mean() > 0.5 > zero[1 - at :: 2].mean():
                wide = data[: len(data) & ~1].decode(name, "replace")
                code = np.frombuffer(wide.encode("utf-32-le"), "<u4")
                yield wide, np.cumsum(2 + 2 * (code > 0xFFFF))


def _of_bytes(data: bytes, up: Mapper) -> Iterator[tuple[str, Mapper]]:
    """Layers of bytes, whose spans map by ``up``."""
    for text, ends in readings(data):
        if ends is None:
            yield text, up
        else:
            yield text, lambda s, e, ends=ends: up(int(ends[s - 1]) if s else 0, int(ends[e - 1]) if e else 0)


def _unbase64(run: str) -> bytes | None:
    bare = run.rstrip("=")
    if "-" in bare or "_" in bare:
        bare = bare.replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return binascii.a2b_base64(bare + "=" * (-len(bare) % 4))
    except binascii.Error:
        return None


def _base64_layers(text: str, cut: list[int]) -> Iterator[tuple[str, Mapper]]:
    for m in BASE64.finditer(text):
        whole = [(m.start(), m[0])]
        if "\n" in m[0]:
            parts, at = [], m.start()
            for line in m[0].split("\n"):
                parts.append((at, line.rstrip("\r")))
                at += len(line) + 1
            whole += parts  # the run's lines may hold more on their own
        for start, run in whole:
            kept = [i for i, c in enumerate(run) if c not in "\r\n"] if "\n" in run else None
            raw = _unbase64(run if kept is None else "".join(run[i] for i in kept))
            if not raw:
                continue

            def up(s: int, e: int, start=start, run=run, kept=kept) -> Span:
                a, b = s * 4 // 3, min(len(run) if kept is None else len(kept), -(-e * 4 // 3))
                return (start + a, start + b) if kept is None else (start + kept[a], start + kept[b - 1] + 1)

            yield from _of_bytes(raw, up)
            if _utf8(raw) is None and (found := _deflated(raw)):
                cut.append(int(found[1]))
                yield from _of_bytes(found[0], lambda s, e, whole=up(0, len(raw)): whole)


def _stream_layers(text: str, cut: list[int]) -> Iterator[tuple[str, Mapper]]:
    """What streams hold that stand in a text, a character a byte."""
    for run in BYTES.finditer(text):
        data, at = None, 0
        while m := STREAM.search(run[0], at):
            data = memoryview(run[0].encode("latin-1")) if data is None else data
            at = m.start() + 1
            if found := inflate(data[m.start() :]):
                content, taken, short = found
                cut.append(int(short))
                start, at = run.start() + m.start(), max(at, m.start() + taken)
                yield from _of_bytes(content, lambda s, e, start=start, end=run.start() + at: (start, end))


def layers(text: str, cut: list[int] | None = None) -> Iterator[tuple[str, Mapper]]:
    """The layers directly below one text; ``cut`` gets a 1 for each that is longer than ``MAX_LAYER``."""
    cut = [] if cut is None else cut
    if "%" in text and (found := _pieces(text, URL_ESCAPES, _url)):
        yield found
    if ("\\" in text or "&#" in text) and (found := _pieces(text, UNICODE_ESCAPES, _unicode)):
        yield found
    yield from _base64_layers(text, cut)
    if any(x in text for x in STREAM_HINTS):
        yield from _stream_layers(text, cut)


def _order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans and all spans of one text, in order, and how many layers were cut."""
    base, cut = find(text), []
    every = set(base)
    seen = {(_mark(text), 0, len(text))}
    work: list[tuple[str, list[Mapper]]] = [(text, [])]
    while work:
        parent, chain = work.pop()
        for layer, up in layers(parent, cut):
            if not layer:
                continue
            own = [*chain, up]
            key = (_mark(layer), *_to_root(own, 0, len(layer)))
            if key in seen:  # nothing new at this place: a cycle, or two ways to one layer
                continue
            seen.add(key)
            every.update((kind, *_to_root(own, start, end)) for kind, start, end in find(layer))
            work.append((layer, own))
    return sorted(base, key=_order), sorted(every, key=_order), sum(cut)


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _to_root(chain: list[Mapper], start: int, end: int) -> Span:
    for up in reversed(chain):
        start, end = up(start, end)
    return start, end


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans, arrays of (kind, start, end) in code points of the text, and n_cut."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for batch in batches:
            both = [scan(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([named(x[0]) for x in both], kind), pa.array([named(x[1]) for x in both], kind), pa.array([x[2] for x in both], pa.int64())], names=["doc_id", "base", "spans", "n_cut"])

    item = "array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(run, f"doc_id long, base {item}, spans {item}, n_cut long")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(load(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), "n_cut")


QUERIES = {"op2_secret_scan": op2_secret_scan}
ORACLES: dict[str, str] = {}
