"""Rows that the corpus tests share."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, row string, fp string"
SPACES = re.compile("[\x20\x09-\x0d]+")


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(1, 400))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(200 + i, rows[i][1].replace(" ", " \t", 3)) for i in range(5)]
    rows += [(300 + i, rows[i][1] + " zz") for i in range(20, 30)]
    rows += [(None, rows[3][1]), (None, None), (400, None), (401, ""), (402, " \n"), (5, rows[5][1]), (5, "another text"), (403, "é" * 20_000 + " x" * 3000), (404, "of " * 200)]
    return rows
