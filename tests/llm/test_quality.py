"""Robust outliers against a plain version of the estimate."""

import math
import random

import numpy as np
import pytest

from docmill.llm import quality
from docmill.llm.quality import ACCURACY, PRIOR, RESOLUTION, REWEIGHT, SETTLED, STEPS, SUPPORT, X, chi_square_above, chi_square_tail, consistency
from shared import corpus, words

P = len(X)


def low(a, share):
    a = np.sort(a, axis=0)
    return a[max(1, math.ceil(share * len(a))) - 1]


def level(rows):
    middle = low(rows, 0.5)
    return len(rows), middle, np.maximum(1.4826 * low(np.abs(rows - middle), 0.5), RESOLUTION)


def plain_estimates(rows):
    """{(lang, source): (centre, covariance, median words, rows)} from (lang, source, words, vector)."""
    factor, found = consistency(SUPPORT), {}
    _, all_m, all_s = level(np.array([r[3] for r in rows]))
    for lang in {r[0] for r in rows}:
        n, m, s = level(np.array([r[3] for r in rows if r[0] == lang]))
        prior_m, prior_v = (n * m + PRIOR * all_m) / (n + PRIOR), (n * s**2 + PRIOR * all_s**2) / (n + PRIOR)
        for source in {r[1] for r in rows if r[0] == lang}:
            own = [r for r in rows if r[:2] == (lang, source)]
            x = np.array([r[3] for r in own])
            n, m, s = level(x)
            z, share = (x - m) / s, PRIOR / (n + PRIOR)

            def regular(mean, cov):
                k = (1 - share) * cov + share * np.diag(prior_v) + np.diag(np.square(RESOLUTION))
                return (1 - share) * mean + share * prior_m, k, np.linalg.slogdet(k)[1] / 2

            def distances(centre, k):
                return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(k), x - centre)

            def fit(core, factor):
                return regular(core.mean(0), np.cov(core.T, bias=True).reshape(P, P) * factor if len(core) > 1 else np.zeros((P, P)))

            def step(start):
                d = distances(*start[:2])
                return fit(x[d <= low(d, SUPPORT)], factor)

            def by_scores(u):
                c = u.T @ u
                d = np.sqrt(np.maximum(np.diag(c), 1e-12))
                c = c / np.outer(d, d)
                np.fill_diagonal(c, 1)
                return regular(m, c * np.outer(s, s))

            norm = (z * z).sum(1)
            half = z[norm <= chi_square_above(0.5, P)]
            mean, cov = (half.mean(0), np.cov(half.T, bias=True).reshape(P, P)) if len(half) else (np.zeros(P), np.zeros((P, P)))
            starts = [regular(m, np.diag(s**2)), by_scores(np.tanh(z)), by_scores(z / np.sqrt(np.maximum(norm, 1e-12))[:, None]), by_scores(np.clip(z, -2, 2)), regular(m + s * mean, cov * factor * np.outer(s, s))]
            now = min((step(step(x)) for x in starts), key=lambda e: e[2])
            for _ in range(STEPS - 2):
                before, now = now[2], step(now)
                if abs(now[2] - before) < SETTLED:
                    break
            inside = x[distances(*now[:2]) <= chi_square_above(1 - REWEIGHT, P)]
            now = fit(inside, consistency(REWEIGHT)) if len(inside) else now
            found[lang, source] = (*now[:2], low(np.array([r[2] for r in own]), 0.5), n)
    return found


def rows_of_groups():
    rng = random.Random(31)
    rows = []
    for g, (lang, source, n) in enumerate([("en", "a", 60), ("en", "b", 25), ("fr", "a", 9), (None, None, 3), ("fr", None, 1)]):
        for i in range(n):
            text = words(rng, rng.randint(55, 250))
            if i % 9 == 4:
                text = " ".join(w + "#$%"[: rng.randint(1, 3)] for w in text.split())
            elif i % 9 == 7:
                text = text.upper()
            elif i % 9 == 8:
                text = " ".join(rng.choice("abcde") * rng.randint(8, 20) for _ in range(80)) + " " + " ".join(text.split()[:40])
            rows.append((100 * g + i, text, lang, source))
    return rows + [(900, "too short", "en", "a"), (901, None, "en", "b"), (902, rows[0][1], "en", "a")]


def test_verdicts_equal_plain(spark):
    rows = rows_of_groups()
    got = quality.quality_verdicts(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    vectors = {r.doc_id: r for r in quality.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    passed = [(lang, source, vectors[d].n_words, np.array([vectors[d][c] for c in X])) for d, _, lang, source in rows if not vectors[d].base_failed]
    estimates = plain_estimates(passed)
    limit = chi_square_above(quality.TAIL, P)
    verdicts = {True: 0, False: 0}
    for r in got:
        lang, source = next(x[2:] for x in rows if x[0] == r.doc_id)
        if r.base_failed:
            assert not r.kept
            continue
        centre, k, middle, n = estimates[lang, source]
        off = np.array([vectors[r.doc_id][c] for c in X]) - centre
        d = off @ np.linalg.solve(k, off) * min(1, r.n_words / middle)
        assert r.distance2 == pytest.approx(d, rel=1e-6) and r.kept == (d <= limit * (1 + P * (P + 1) / n))
        verdicts[r.kept] += 1
    assert min(verdicts.values()) >= 5 and len(rows) < ACCURACY


def test_the_estimate_decides(spark):
    """Starts alone would judge otherwise: the verdicts come from the concentrated estimate."""
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([0] * P, np.eye(P) * 0.01 + 0.09, 300)
    odd = np.tile([0.5, -0.5, 0.5, -0.5, 0.5, -0.5], (30, 1)) + rng.normal(0, 0.02, (30, P))  # within the marginals, against the correlation
    rows = [("en", "s", 100, x) for x in np.vstack([clean, odd])]
    centre, k, *_ = plain_estimates(rows)["en", "s"]
    _, m, s = level(np.vstack([clean, odd]))
    far = lambda c, v: np.einsum("ij,jk,ik->i", odd - c, np.linalg.inv(v), odd - c)
    limit = chi_square_above(quality.TAIL, P) * (1 + P * (P + 1) / len(rows))
    assert (far(centre, k) > limit).all() and (far(m, np.diag(s**2)) < limit).all()


def test_chi_square_quantiles():
    assert chi_square_above(0.001, 6) == pytest.approx(22.457744, abs=1e-5) and chi_square_above(0.05, 8) == pytest.approx(15.507313, abs=1e-5)
    assert chi_square_tail(chi_square_above(0.3, 6), 6) == pytest.approx(0.3)


def test_groups_of_one_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, words long, pair string"
    alone = spark.createDataFrame([(1, corpus()[0][1] + " x" * 10, None, None, 1, "p")], schema)
    assert quality.quality_verdicts(spark, alone).count() == 1
    assert quality.quality_verdicts(spark, alone.limit(0)).count() == 0
    assert quality.quality_filtered(spark, alone.limit(0)).columns == alone.columns


def test_stage_keeps_and_drops_equal_rows_of_two_groups_by_their_own_verdicts(spark):
    rng = np.random.default_rng(12)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(n - 2, n + 3))) for _ in range(120))
    rows = [(i, text(5), "en", "s") for i in range(200)] + [(200 + i, text(25), "xx", "s") for i in range(200)]
    rows.append((250, rows[250][1], "en", "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = [(r.doc_id, r.lang) for r in quality.quality_filtered(spark, docs).collect()]
    assert [x for x in kept if x[0] == 250] == [(250, "xx")]
    verdicts = quality.quality_verdicts(spark, docs).where("kept").count()
    assert len(kept) == verdicts > 350
