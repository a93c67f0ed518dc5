"""Quality rules with robust multivariate outliers, in DataFrame and SQL functions only.

Fixed rules fail very short and very repetitive texts.  Beyond them, each text
has a vector of transformed statistics: log of the mean word length, square roots of
the shares of short words and of capitals, log distinct words over log words, square
roots of the shares of symbols and of repeated words.  For every language and source
a minimum-covariance-determinant estimate is fitted over the rows that the fixed rules
pass: from five starts (medians and median deviations alone, and with the correlations of tanh
scores, spatial signs, clipped scores and the central half) concentration steps keep the
share ``support`` of rows with the smallest Mahalanobis distance and refit mean and
covariance on them; after two steps the start with the smallest determinant goes on until
no determinant changes, and a last fit takes all rows within the quantile ``REWEIGHT``.
A text is rejected when its squared distance exceeds the chi-square quantile that a share
``tail`` of normal rows exceeds, times 1 + p (p + 1) / n for p statistics and n rows, since an
estimate from few rows is itself uncertain.  Statistics of short texts vary more, in
proportion to 1 / words: below its group's median length the distance counts by words
over median.

Estimates are regularised alike at every size: a group of n rows weighs n against
``PRIOR`` rows at its language's medians and median deviations (and a language against
all rows), so a small group leans on its language.  Every variance has the square of
``RESOLUTION`` added, the step of a statistic that a reader would not notice: it is small
beside the variances of the first four, and all there is where most rows agree, as they do
in having no symbols and no repeated words.

At scale: statistics are written once as a few numbers a row; medians and thresholds are
quantile sketches and fits are sums, all of them partial aggregations, so a group of any
size never meets in one task.  Group parameters are written tables, joined by Spark's
choice (it broadcasts them only under its size threshold).

Defined cases: a null text has no words (it fails the fixed rules); null
language and source are values of their own; equal rows are judged alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Workspace, load, text_or_empty

X = ("x0", "x1", "x2", "x3", "x4", "x5")
D = range(len(X))
CELLS = [(i, j) for i in D for j in range(i + 1)]
#: The step of each statistic that does not count.
RESOLUTION = (0.005, 0.005, 0.003, 0.003, 0.05, 0.10)
SUPPORT, REWEIGHT, TAIL, PRIOR = 0.75, 0.975, 1e-5, 20
STEPS, SETTLED = 30, 1e-3
ACCURACY = 10_000


def chi_square_tail(x: float, degrees: int) -> float:
    """Share of a chi-square distribution of even degrees above ``x``."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_above(share: float, degrees: int) -> float:
    """The quantile that ``share`` exceeds."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_tail(mid, degrees) > share else (lo, mid)
    return hi


def consistency(support: float, degrees: int = len(X)) -> float:
    """Factor from the covariance of the central ``support`` of a normal distribution to the whole's."""
    return support / (1 - chi_square_tail(chi_square_above(1 - support, degrees), degrees + 2))



def text_statistics(docs: DataFrame, whole: bool = False) -> DataFrame:
    """The columns of ``docs``' key and group, the contract's statistics and the vector x0..x5; with ``whole`` the row of ``docs`` too, as ``own``."""
    own = ["own"] if whole else []
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(F.lit("pair "), F.to_json(F.struct(F.col("lang").cast("string").alias("l"), F.col("source").cast("string").alias("s")))).alias("pair"),
        F.concat(F.lit("lang "), F.to_json(F.struct(F.col("lang").cast("string").alias("l")))).alias("lang_key"),
        text_or_empty(docs).alias("t"),
        *[F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(c) for c in own],
    )
    words = base.withColumns(
        {
            "w": F.expr(rf"filter(split(t, r'{SPACE}+'), x -> x <> '')"),
            "lines": F.expr(rf"filter(split(t, r'\n'), x -> x rlike r'[^\x20\x09-\x0D]')"),
            "text_key": F.xxhash64("t"),
        }
    )
    counted = words.select(
        *own, "doc_id", "pair", "lang_key", "text_key",
        F.size("w").cast("long").alias("n_words"),
        (F.length("t") - F.length(F.regexp_replace("t", f"[^\\x20\\x09-\\x0D]+", ""))).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.expr("size(filter(w, x -> length(x) <= 3))").alias("n_short"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.expr("case when size(w) < 3 then cast(array() as array<bigint>) else transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) end").alias("h"),
    )
    # windows found again: sort (hash, place), keep places with an equal neighbour, add up what they cover
    ordered = "sort_array(transform(h, (x, i) -> struct(x, i)))"
    again = "filter(transform(sequence(0, size(s) - 1), j -> if((j > 0 and s[j].x = s[greatest(j - 1, 0)].x) or (j < size(s) - 1 and s[j].x = s[least(j + 1, size(s) - 1)].x), s[j].i, -1)), p -> p >= 0)"
    covered = "aggregate(sort_array(q), struct(0L as n, 0 as e), (a, p) -> struct(a.n + p + 3 - greatest(a.e, p) as n, p + 3 as e), a -> a.n)"
    sorted_ = counted.withColumn("s", F.expr(f"case when size(array_distinct(h)) < size(h) then {ordered} end")).drop("h")
    places = sorted_.withColumn("q", F.expr(f"case when s is not null then {again} end")).drop("s")
    stats = places.withColumn("n_repeat_words", F.expr(f"case when q is null then 0L else {covered} end")).drop("q")
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return stats.withColumns(
        {
            "x0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            "x1": F.sqrt(F.col("n_short") / n),
            "x2": F.sqrt(F.col("n_upper") / chars),
            "x3": F.log(F.greatest(F.col("n_distinct"), F.lit(2))) / F.log(F.greatest(F.col("n_words"), F.lit(2))),
            "x4": F.sqrt(F.col("n_symbols") / chars),
            "x5": F.sqrt(F.col("n_repeat_words") / n),
            "base_failed": (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
        }
    )


def _small(ws: Workspace, params: DataFrame, name: str) -> DataFrame:
    """Write a table of a row a group into few files: Spark decides by their size whether it broadcasts it."""
    return ws.write(params.coalesce(4), name)


def _medians(rows: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """Lower medians by sketches."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), *[F.percentile_approx(c, 0.5, ACCURACY).alias(name) for name, c in columns.items()])


def group_bases(ws: Workspace, fit_on: DataFrame) -> DataFrame:
    """pair, n, words (median), medians m, deviations s, and the prior: centre l and variances t of the language."""
    levels = fit_on.select(F.explode(F.array("pair", "lang_key", F.lit("all"))).alias("key"), "n_words", *X)
    middle = _small(ws, _medians(levels, "key", {"words": F.col("n_words"), **{f"m{i}": F.col(x) for i, x in enumerate(X)}}), "medians")
    spread = _medians(levels.join(middle.drop("n", "words"), "key"), "key", {f"s{i}": F.abs(F.col(x) - F.col(f"m{i}")) for i, x in enumerate(X)})
    scaled = [F.greatest(F.col(f"s{i}") * 1.4826, F.lit(RESOLUTION[i])).alias(f"s{i}") for i in D]
    level = _small(ws, middle.join(spread.select("key", *scaled), "key"), "levels")
    named = lambda own, prefix: level.select(F.col("key").alias(own), *[F.col(c).alias(prefix + c) for c in level.columns if c != "key"])
    pairs = fit_on.select("pair", "lang_key").distinct().withColumn("all_key", F.lit("all"))
    joined = pairs.join(named("pair", ""), "pair").join(named("lang_key", "l_"), "lang_key").join(named("all_key", "a_"), "all_key")
    lean = lambda own, other: (F.col("l_n") * own + PRIOR * other) / (F.col("l_n") + PRIOR)
    centre = [lean(F.col(f"l_m{i}"), F.col(f"a_m{i}")).alias(f"l{i}") for i in D]
    target = [lean(F.col(f"l_s{i}") * F.col(f"l_s{i}"), F.col(f"a_s{i}") * F.col(f"a_s{i}")).alias(f"t{i}") for i in D]
    return _small(ws, joined.select("pair", "n", "words", *[f"m{i}" for i in D], *[f"s{i}" for i in D], *centre, *target), "bases")


def _moments(rows: DataFrame, keys: list[str], u: list[Column]) -> DataFrame:
    """Count, sums u and sums of products w of each group."""
    named = rows.select(*keys, *[c.alias(f"u{i}") for i, c in enumerate(u)])
    return named.groupBy(*keys).agg(F.count("*").alias("core"), *[F.sum(f"u{i}").alias(f"u{i}") for i in D], *[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"w{i}{j}") for i, j in CELLS])


def _parameters(sums: DataFrame, mean: list[Column], cell: dict[tuple[int, int], Column], *more: str) -> DataFrame:
    """pair, start, the regularised centre c, Cholesky factor k and log determinant; ``sums`` has the bases' columns."""
    prior = F.lit(float(PRIOR)) / (F.col("n") + PRIOR)
    out = sums.select(
        "pair", "start", *more, *[(mean[i] * (1 - prior) + F.col(f"l{i}") * prior).alias(f"c{i}") for i in D],
        *[(cell[i, j] * (1 - prior) + (F.col(f"t{i}") * prior + RESOLUTION[i] ** 2 if i == j else F.lit(0.0))).alias(f"v{i}{j}") for i, j in CELLS],
    )
    for i, j in CELLS:
        rest = F.col(f"v{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"k{i}{k}") * F.col(f"k{j}{k}")
        out = out.withColumn(f"k{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"k{j}{j}"))
    determinant = sum((F.log(f"k{i}{i}") for i in D[1:]), F.log("k00"))
    return out.select("pair", "start", *[f"c{i}" for i in D], *[f"k{i}{j}" for i, j in CELLS], determinant.alias("determinant"), *more)


def _starts(ws: Workspace, fit_on: DataFrame, bases: DataFrame, factor: float) -> DataFrame:
    """The five starts of every pair."""
    scores = fit_on.join(bases, "pair").select("pair", *[((F.col(x) - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, x in enumerate(X)])
    z = [F.col(f"z{i}") for i in D]
    norm = sum((c * c for c in z[1:]), z[0] * z[0])
    half = F.lit(chi_square_above(0.5, len(X)))
    kinds = {
        1: [F.tanh(c) for c in z],
        2: [c / F.sqrt(F.greatest(norm, F.lit(1e-12))) for c in z],
        3: [F.greatest(F.lit(-2.0), F.least(F.lit(2.0), c)) for c in z],
        4: [F.when(norm <= half, c) for c in z],
    }
    every = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *[c.alias(f"z{i}") for i, c in enumerate(u)]) for k, u in kinds.items()]))
    each = scores.select("pair", every.alias("e")).select("pair", "e.*").where("z0 is not null")
    sums = _small(ws, _moments(each, ["pair", "start"], z), "scores")
    known = bases.withColumn("start", F.explode(F.array(*map(F.lit, range(5))))).join(sums, ["pair", "start"], "left")
    core = F.greatest(F.coalesce("core", F.lit(0)), F.lit(1))
    is_half = F.col("start") == 4
    inner = [F.coalesce(F.col(f"u{i}") / core, F.lit(0.0)) for i in D]
    mean = [F.col(f"m{i}") + F.when(is_half, inner[i] * F.col(f"s{i}")).otherwise(0.0) for i in D]
    cell = {}
    for i, j in CELLS:
        product = F.coalesce(F.col(f"w{i}{j}"), F.lit(0.0))
        alike = F.lit(1.0) if i == j else F.when(F.col("start") == 0, 0.0).otherwise(product / F.sqrt(F.greatest(F.col(f"w{i}{i}"), F.lit(1e-12)) * F.greatest(F.col(f"w{j}{j}"), F.lit(1e-12))))
        cell[i, j] = F.when(is_half, (product / core - inner[i] * inner[j]) * factor).otherwise(F.coalesce(alike, F.lit(0.0))) * F.col(f"s{i}") * F.col(f"s{j}")
    return _small(ws, _parameters(known, mean, cell), "start")


def _with_distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance by forward substitution, in steps, so that no term is expanded more than once."""
    for i, x in enumerate(X):
        rest = F.col(x) - F.col(f"c{i}")
        for j in range(i):
            rest = rest - F.col(f"k{i}{j}") * F.col(f"y{j}")
        df = df.withColumn(f"y{i}", rest / F.col(f"k{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in D[1:]), F.col("y0") * F.col("y0")))


def _refit(ws: Workspace, fit_on: DataFrame, bases: DataFrame, params: DataFrame, limit: DataFrame | float, factor: float, name: str) -> DataFrame:
    """Parameters from the rows within the limit of every pair and start; ``old`` is the determinant before."""
    tops = params.withColumn("top", F.lit(limit)) if isinstance(limit, float) else params.join(limit, ["pair", "start"])
    # written, so that Spark knows its size when it plans the join with the rows
    limited = _small(ws, tops.join(bases.drop("words", *[f"s{i}" for i in D]), "pair").withColumnRenamed("determinant", "old"), f"limited-{name}")
    near = _with_distance(fit_on.join(limited, "pair")).where("d2 <= top")
    sums = _moments(near, ["pair", "start"], [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)])
    sums = sums.join(limited.select("pair", "start", "n", "old", *[f"{c}{i}" for c in "mlt" for i in D]), ["pair", "start"])
    inner = [F.col(f"u{i}") / F.col("core") for i in D]
    mean = [F.col(f"m{i}") + inner[i] for i in D]
    cell = {(i, j): (F.col(f"w{i}{j}") / F.col("core") - inner[i] * inner[j]) * factor for i, j in CELLS}
    return _small(ws, _parameters(sums, mean, cell, "old"), f"fit-{name}")


def _concentrated(ws: Workspace, fit_on: DataFrame, bases: DataFrame, params: DataFrame, support: float, step: int) -> DataFrame:
    """One concentration step of every pair and start."""
    far = _with_distance(fit_on.join(params, "pair"))
    limit = far.groupBy("pair", "start").agg(F.percentile_approx("d2", support, ACCURACY).alias("top"))
    return _refit(ws, fit_on, bases, params, limit, consistency(support), str(step))


def robust_estimates(ws: Workspace, stats: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """pair, n, words (median), centre and Cholesky factor of each group's estimate; from rows that pass the fixed rules."""
    fit_on = stats.where("not base_failed").select("pair", "lang_key", "n_words", *X)
    bases = group_bases(ws, fit_on)
    params = _starts(ws, fit_on, bases, consistency(support))
    settled = params.limit(0).select("pair", "start", *[c for c in params.columns if c not in ("pair", "start")])
    for step in range(steps):
        params = _concentrated(ws, fit_on, bases, params.drop("old"), support, step)
        if step == 1:
            best = params.groupBy("pair").agg(F.min(F.struct("determinant", "start")).alias("best"))
            params = _small(ws, params.join(best, "pair").where("start = best.start").drop("best"), "best")
        if step > 1:
            moving = F.abs(F.col("determinant") - F.col("old")) >= SETTLED
            settled = settled.union(params.where(~moving).select(*settled.columns))
            params = params.where(moving)
            if params.isEmpty():
                break
    raw = _small(ws, settled.union(params.select(*settled.columns)), "raw").drop("old")
    last = _refit(ws, fit_on, bases, raw, chi_square_above(1 - REWEIGHT, len(X)), consistency(REWEIGHT), "last")
    # a group whose rows are all outside keeps the raw estimate
    lone = raw.join(last.select("pair"), "pair", "left_anti")
    return _small(ws, last.drop("old").unionByName(lone).drop("start", "determinant").join(bases.select("pair", "n", "words"), "pair"), "estimates")


def quality_verdicts(spark: SparkSession, docs: DataFrame, tail: float = TAIL, whole: bool = False) -> DataFrame:
    """doc_id, text_key, the statistics, base_failed, distance2 and kept for every row; with ``whole`` the row itself too, as ``own``."""
    ws = Workspace(spark, "quality")
    stats = ws.write(text_statistics(docs, whole), "stats")
    judged = _with_distance(stats.join(robust_estimates(ws, stats), "pair", "left"))
    distance = F.col("d2") * F.least(F.lit(1.0), F.col("n_words") / F.col("words"))
    limit = chi_square_above(tail, len(X)) * (1 + len(X) * (len(X) + 1) / F.col("n"))
    return judged.select(
        *["own"] * whole, "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance2"),
        F.when(F.col("base_failed"), False).otherwise(distance <= limit).alias("kept"),
    )


def quality_filtered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only; each has its own verdict beside it, so no text is shuffled to find it."""
    return quality_verdicts(spark, docs, whole=True).where("coalesce(kept, true)").select("own.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(spark, load(spark, sf_dir, "documents")).drop("text_key")


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES: dict[str, str] = {}
