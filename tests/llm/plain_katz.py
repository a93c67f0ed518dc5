"""The language model said plainly, over dictionaries, for comparison."""

import math
import zlib
from collections import Counter, defaultdict

from docmill.llm.katz import K, discounts


def plain_scores(docs, order=3):
    """Rows of scores, the model's probability of a word after a history (nearest word last), and the counts by order."""
    texts = [(d, [*(t or "").encode().lower().split(), b""]) for d, t in docs]
    held = {i: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0 for i, (d, _) in enumerate(texts)}
    counts = {n: Counter() for n in range(1, order + 1)}
    for i, (_, words) in enumerate(texts):
        if not held[i]:
            padded = [b""] * (order - 1) + words
            for n in counts:
                counts[n].update(tuple(padded[k - n + 1 : k + 1]) for k in range(order - 1, len(padded)))
    uni = counts[1]
    total = sum(uni.values())
    d = {n: discounts([0, *[sum(1 for c in own.values() if c == r) for r in range(1, K + 2)]]) for n, own in counts.items()}
    cut = lambda n, c: c if c > K else d[n][c] * c
    seen = sum(cut(1, c) for c in uni.values())
    unknown = 1 - seen / total
    unknown, scale = (unknown, 1) if unknown > 1e-12 else (1 / (total + 1), (1 - 1 / (total + 1)) / (seen / total))
    after = {n: defaultdict(dict) for n in range(2, order + 1)}
    for n in after:
        for gram, c in counts[n].items():
            after[n][gram[:-1]][gram[-1]] = c
    known = {}

    def p(history, w):
        if not history:
            return scale * cut(1, uni[(w,)]) / total if uni[(w,)] else unknown
        n, own = len(history) + 1, after[len(history) + 1].get(history)
        if own is None:
            return p(history[1:], w)
        if history not in known:
            size = sum(own.values())
            kept = sum(cut(n, c) for c in own.values()) / size
            beta = 1 - kept if 1 - kept > 1e-12 else 1 / (size + 1)
            known[history] = size, kept, beta, beta / (1 - sum(p(history[1:], x) for x in own))
        size, kept, beta, alpha = known[history]
        return (1 - beta) / kept * cut(n, own[w]) / size if w in own else alpha * p(history[1:], w)

    rows = []
    for i, (doc, words) in enumerate(texts):
        padded = [b""] * (order - 1) + words
        base = sum(math.log10((uni[(w,)] + 0.1) / (total + 0.1 * (len(uni) + 1))) for w in words)
        score = sum(math.log10(p(tuple(padded[k - order + 1 : k]), padded[k])) for k in range(order - 1, len(padded)))
        rows.append((doc, held[i], len(words), sum(1 for w in words if uni[(w,)]), total, base, score))
    return rows, p, counts
