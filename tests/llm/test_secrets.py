"""Secrets in layers against a plain scanner and nestings whose spans are known by construction."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import urllib.parse
import zlib

import zstandard

from docmill.llm import secrets
from shared import corpus

SECRET = "password=abcdefghijklmnop"
ZSTD = zstandard.ZstdCompressor().compress


def raw_deflate(data):
    stream = zlib.compressobj(wbits=-15)
    return stream.compress(data) + stream.flush()


PACKS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": ZSTD}


def b64(data):
    return base64.b64encode(data).decode()


def test_base_spans_equal_a_plain_scanner(spark):
    rng = random.Random(51)
    parts = ["password", "PASSWD", "api_key", "Token", '"', "'", " ", ":", "=", "AKIA", "abcdef0123456789", "ABCDEFGH12345678", "xyz", "é", "ſecret", "\n", "/+._-", "deadbeef", "%41", "\\u0041"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(600)]

    def plain(text):
        found, i = [], 0
        keys = ["password", "passwd", "secret", "token", "api_key", "apikey"]
        fold = "".join(c.lower() if c.isascii() else c for c in text)
        value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
        while i < len(text):
            key = next((k for k in keys if fold.startswith(k, i)), None)
            best = None
            if key:
                at = i + len(key)
                for quote in (1, 0):
                    j = at
                    if quote and not (j < len(text) and text[j] in "\"'"):
                        continue
                    j += quote
                    while j < len(text) and text[j] == " ":
                        j += 1
                    if j < len(text) and text[j] in ":=":
                        j += 1
                        while j < len(text) and text[j] == " ":
                            j += 1
                        if j < len(text) and text[j] in "\"'":
                            j += 1
                        k = j
                        while k < len(text) and text[k] in value:
                            k += 1
                        if k > j:
                            best = (j, k)
                            break
            if best:
                if best[1] - best[0] >= 12:
                    found.append(("assign", i, best[1]))
                i = best[1]
            else:
                i += 1
        for kind, start, members, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 18), ("hex", "", set("0123456789abcdef"), 16)):
            i = 0
            while i < len(text):
                k = i + len(start)
                if text.startswith(start, i):
                    while k < len(text) and text[k] in members:
                        k += 1
                if k > i + len(start):
                    if k - i >= least:
                        found.append((kind, i, k))
                    i = k
                else:
                    i += 1
        return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0]), x[2]))

    for text in texts:
        base, every, _ = secrets.scan(text)
        assert base == plain(text), repr(text)
        assert set(base) <= set(every)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/secrets-test/documents.parquet")
    for r in secrets.op2_secret_scan(spark, path.removesuffix("/documents.parquet")).collect():
        own = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in own).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, *_ in own) for x in ("assign", "access", "hex"))


def nested(rng, depth):
    """A text that holds SECRET under ``depth`` encodings, and where the secret's place is in it."""
    text = "".join(rng.choices("klmnopq rst", k=rng.randint(0, 9))) + " " + SECRET + " é"[: rng.randint(0, 2)]
    start = text.index(SECRET)
    end = start + len(SECRET)
    for _ in range(depth):
        kind = rng.choice(["url", "url all", "unicode", "entity", "base64", *PACKS, "utf16", "deflate", "url bytes", "escaped bytes"])
        before = "".join(rng.choices("uvw ", k=rng.randint(0, 6))) + " "
        if kind in ("url", "url all", "unicode", "entity"):
            if kind == "url":
                pieces = [urllib.parse.quote(c, safe="") for c in text]
            elif kind == "url all":
                pieces = ["".join(f"%{b:02X}" for b in c.encode()) for c in text]
            elif kind == "unicode":
                pieces = [f"\\u{ord(c):04x}" for c in text]
            else:
                pieces = [f"&#{ord(c)};" for c in text]
            at = [len(before)]
            for x in pieces:
                at.append(at[-1] + len(x))
            text, start, end = before + "".join(pieces) + " x", at[start], at[end]
        elif kind == "base64":
            first, last = len(text[:start].encode()), len(text[:end].encode())
            run = b64(text.encode())
            text, start, end = before + run + " x", len(before) + first * 4 // 3, len(before) - (-last * 4 // 3)
        elif kind == "utf16":
            run = b64(text.encode("utf-16-le"))
            text, start, end = before + run + " x", len(before) + 2 * start * 4 // 3, len(before) - (-2 * end * 4 // 3)
        else:
            if kind in PACKS:
                run = b64(PACKS[kind](text.encode()))
            elif kind == "deflate":
                run = b64(raw_deflate(text.encode()))
            else:
                data = rng.choice(list(PACKS.values()))(text.encode())
                run = urllib.parse.quote(data, safe="") if kind == "url bytes" else "".join(f"\\x{b:02x}" for b in data)
            text, start, end = before + run + " x", len(before), len(before) + len(run.rstrip("="))
    return text, start, end


def test_random_nestings_are_unwrapped_to_their_spans():
    rng = random.Random(52)
    lost = []
    for i in range(1500):
        depth = rng.randint(1, 4)
        text, start, end = nested(rng, depth)
        spans = [(s, e) for k, s, e in secrets.scan(text)[1] if k == "assign"]
        if (start, end) not in spans:
            lost.append((text[:120], start, end, spans))
    assert not lost, (len(lost), str(lost[:2])[:600])


def test_streams_members_and_odd_bytes():
    noise = bytes(random.Random(1).choices(b"abcdefgh xyz", k=300))
    secret = SECRET.encode()
    hidden = {f"{a} of {b}": f(g(secret)) for a, f in PACKS.items() for b, g in PACKS.items()}
    hidden |= {f"second of {a}": f(noise) + f(secret) for a, f in PACKS.items() if a != "zlib"}
    hidden |= {"third": gzip.compress(zlib.compress(bz2.compress(secret))), "mixed": ZSTD(noise) + gzip.compress(secret), "skipped frame": ZSTD(noise) + b"\x50\x2a\x4d\x18\x02\0\0\0ab" + ZSTD(secret)}
    hidden |= {"padded": lzma.compress(noise) + bytes(4) + lzma.compress(secret), "broken after": gzip.compress(secret) + gzip.compress(noise)[:12] + b"\xff" * 20}
    hidden |= {f"control {c}": b"first line " + bytes([c]) + secret for c in (0, 1, 12, 127)} | {"control in gzip": gzip.compress(b"a\0" + secret)}
    hidden |= {"latin-1": "caf\xe9 ".encode("latin-1") + secret, "latin-1 in gzip": gzip.compress(b"\xe9\xff " + secret), "utf-16 big": SECRET.encode("utf-16-be"), "after other bytes": b"\x01\x02\xff" + gzip.compress(secret)}
    lost = []
    for name, data in hidden.items():
        run = b64(data)
        if not any(k == "assign" and 6 <= s < e <= 6 + len(run) for k, s, e in secrets.scan(f"start {run} end")[1]):
            lost.append(name)
    assert lost == []


def test_cycles_bombs_and_long_layers_end(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_LAYER", 10_000)
    bomb = b64(gzip.compress(SECRET.encode() + b" " * 200_000))
    _, every, cut = secrets.scan(bomb)
    assert cut >= 1 and any(k == "assign" for k, *_ in every)
    monkeypatch.undo()
    started = time.process_time()
    for text in ("é" * 200_000 + b64(("é" * 200_000 + SECRET).encode()), "%41" * 200_000, "x^" * 300_000, "%" * 300_000, "abc%" * 200_000, "\\x41" * 100_000, "A" * 1_000_000, "\x1f\x8b\x08" * 50_000):
        secrets.scan(text)
    assert time.process_time() - started < 60


def test_patterns_and_empty_rows(spark, docs, empty):
    assert secrets.scan(f"{SECRET} AKIA" + "A" * 13 + " AKIA" + "B" * 14 + " deadbeefdeadbee deadbeefdeadbeef")[0] == [("assign", 0, 25), ("access", 44, 62), ("hex", 79, 95)]
    assert secrets.scan("ſecret=abcdefghijklmnop toKen : 'short'") == ([], [], 0)
    assert secrets.secret_spans(docs).count() == len(corpus()) and secrets.secret_spans(empty).count() == 0
    assert not re.search("[^0-9]", str(secrets.secret_spans(docs).agg({"n_cut": "sum"}).first()[0]))
