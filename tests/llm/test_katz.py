"""The language model against a plain version, with and without hot words and pairs."""

import random
import pytest

from docmill.llm import katz
from docmill.llm.common import Workspace
from plain_katz import plain_scores
from shared import corpus, words


def katz_corpus():
    """The corpus, and texts in which a few words and pairs hold most tokens."""
    rng = random.Random(14)
    return [*corpus(), *((1000 + i, " ".join(rng.choice(["of the", "of the", "of a", words(rng, 1)]) for _ in range(rng.randint(1, 300)))) for i in range(40))]


@pytest.mark.parametrize(("order", "buckets", "hot", "chunk"), [(3, None, None, 2_000_000), (3, 7, 40, 900), (3, 1, 5, 50), (2, 4, 30, 700)])
def test_katz_equals_plain(spark, empty, order, buckets, hot, chunk):
    expected, p, counts = plain_scores(katz_corpus(), order)
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in katz_corpus()], "doc_id long, text string, row string, chunk string")
    ws = Workspace(spark, "test")
    got = katz.katz_scores(spark, docs, order, buckets, hot, chunk, ws).collect()
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for r, e in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert r[:5] == e[:5] and r[5:] == pytest.approx(e[5:], rel=1e-9)
    names = {r.w: r.word.encode() for r in katz.lookup(spark, ws.path, 1).collect()}
    for n in range(1, order + 1):
        found = {tuple(names[x] for x in (r.h2, r.h1, r.w) if x is not None): r["count"] for r in katz.lookup(spark, ws.path, n).collect()}
        assert {g: c for g, c in found.items() if c} == dict(counts[n])
    if hot == 40:
        hot_pairs = spark.read.parquet(f"{ws.path}/trigrams").where("kind = 'h'").select("h1", "h2").distinct().count()
        assert hot_pairs > 0
    assert katz.katz_scores(spark, empty).count() == 0


def test_katz_sums_to_one():
    _, p, counts = plain_scores(katz_corpus())
    for history in ((b"", b""), (b"of", b"the"), (b"never", b"the"), (b"never", b"seen")):
        assert sum(p(history, w) for (w,) in counts[1]) + p(history, b"unknown word") == pytest.approx(1)
