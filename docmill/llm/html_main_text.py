"""Main text of web pages, by differencing against the nearest URLs.

A page is cut into text lines, one a block, each with the zone it stands in.
Navigation, forms, scripts and other furniture that the markup names is left out
while cutting.  Pages of a host are then ordered by URL path; a page is paired
with its nearest neighbours, the two before and the two after it, their lines are
aligned by longest common subsequence, and shared lines are deleted as template text.
The zone is a weight: one neighbour that shares a line deletes it (two for lines under
``SHORT`` words, in which pages agree by chance); inside an element that the markup names
as the article it takes all of them and ``ARTICLE_WEIGHT`` at least, and short lines stay.  A neighbour is a copy, and no evidence, if
either page has nothing of its own beside the shared lines or if what the two have of
their own is alike (half of the distinct words).  At last the named article, where it is
the larger part of what is left, stands for the page.

At scale: only keys are sampled for range boundaries; every task holds one range
of the ordered pages.  The two last pages before and the two first after a range
are sent to it (their keys come from one small aggregation), so pairing
does not depend on where a range ends.  Cutting takes time in proportion to the page.

Defined cases: null html gives an empty text; a null or relative URL belongs to
the host ""; equal rows are handled each and are copies of each other; a page without
neighbours keeps its lines; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load

#: Elements whose text is never main text.
FURNITURE = frozenset("nav footer aside form script style noscript template head title select option button textarea iframe object svg canvas audio video dialog menu input label datalist".split())
#: Words in class or id that mark furniture and reader comments.
MARKED = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo|promotions?|banner\w*|cookies?|consent|notices?|gdpr|sidebar\w*|side|menu\w*|nav\w*|breadcrumbs?|pagination|pager|"
    r"comments?|commentlist|disqus|replies|respond|social|share|sharing|related|recommend\w*|newsletter|subscribe|signup|login|popup|modal|overlay|footer|masthead|toolbar|widgets?|skip",
    re.IGNORECASE,
)
#: Words beside them that say where or what kind of box it is.
BOX = frozenset("area bar block body bottom box button buttons container content foot form global head holder icon icons inner item items left link links list main outer page panel post posts right row section site slot stories text title top unit wrap wrapper".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body".split())
#: An opening tag closes these when they stand open.
SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: What may begin markup; a tag's end is looked for by ``_tag_end``.
OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
TAG_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
WHITE = re.compile(r"\s+")
PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")

OUTSIDE, FREE, ARTICLE = 0, 1, 2
ARTICLE_WEIGHT, NEIGHBOURS, ALIKE, SHORT = 3, 2, 0.5, 3
Line = tuple[int, str]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if "=" in raw else {}


def marked(names: str) -> bool:
    """Whether a class or id names furniture: a whole name, or a compound in which at least half of the words do that name no box."""
    for name in names.split():
        parts = [x for x in PARTS.split(name) if x and not x.isdigit()]
        hits = sum(MARKED.fullmatch(x) is not None for x in parts)
        if hits and 2 * hits >= sum(x.lower() not in BOX for x in parts):
            return True
    return False


class _Markup:
    """Finds tags and comments; every character is looked at a bounded number of times."""

    def __init__(self, html: str):
        self.html, self.last, self.plain = html, html.rfind(">"), False

    def next(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """Start and end of the next markup, an element's name ("" for comments), its attributes, and whether it is an end tag."""
        while m := OPENING.search(self.html, at):
            if m[0] == "<!--":
                end = self.html.find("-->", m.end())
                return m.start(), len(self.html) if end < 0 else end + 3, "", "", False
            if m.end() > self.last + 1:
                return None  # nothing closes any more
            end = self._tag_end(m.end())
            return m.start(), end, (m[2] or "").lower(), self.html[m.end() : end - 1], bool(m[1])
        return None

    def _tag_end(self, at: int) -> int:
        if not self.plain:
            if m := TAG_REST.match(self.html, at):
                return m.end()
            self.plain = True  # a quote stays open: from here on quotes mean nothing
        end = self.html.find(">", at)
        return end + 1 if end >= 0 else len(self.html)


class _Stack:
    """Open elements with their zones; the last place of each name is known."""

    def __init__(self):
        self.items: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, zone: int) -> None:
        self.places.setdefault(name, []).append(len(self.items))
        if name in BLOCKS:
            self.blocks.append(len(self.items))
        self.items.append((name, zone))

    def cut(self, i: int) -> None:
        while len(self.items) > i:
            name, _ = self.items.pop()
            self.places[name].pop()
            if name in BLOCKS:
                self.blocks.pop()

    def last(self, names: tuple[str, ...]) -> int:
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def opened(self, names: tuple[str, ...], stops: tuple[str, ...] = ()) -> int | None:
        """Place of the innermost element of ``names`` if none of ``stops`` stands inside it."""
        i = self.last(names)
        return None if i < 0 or i < self.last(stops) else i


def cut_lines(html: str) -> list[Line]:
    """(zone, text) of every block in page order; zone is ARTICLE inside article or main elements, else FREE."""
    found: list[Line] = []
    text: list[str] = []
    stack, markup = _Stack(), _Markup(html)
    zone, at = FREE, 0

    def close_block() -> None:
        if text:
            line = WHITE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if line and zone != OUTSIDE:
                found.append((zone, line))

    def pop_to(i: int) -> None:
        nonlocal zone
        close_block()
        stack.cut(i)
        zone = stack.items[-1][1] if stack.items else FREE

    while m := markup.next(at):
        start, end, name, raw, closing = m
        if start > at and zone != OUTSIDE:
            text.append(html[at:start])
        at = end
        if not name:
            continue
        if closing:
            i = stack.opened((name,))
            if name == "p" and i is None:
                close_block()
            elif i is not None:
                if name in BLOCKS or name in FURNITURE or stack.items[i][1] != zone:
                    pop_to(i)
                elif not stack.blocks or stack.blocks[-1] < i:  # an inline end tag closes no block that opened since
                    stack.cut(i)
            continue
        if name == "br":
            if zone != OUTSIDE:
                text.append(" ")
            continue
        if name in CLOSES_P:
            if (i := stack.opened(("p",), ("td", "th", "li", "dd", "button", "object"))) is not None:
                pop_to(i)
            close_block()
        if name in SAME and (i := stack.opened(SAME[name], STOPS[name])) is not None:
            pop_to(i)
        if name in RAW:
            close = RAW_END[name].search(html, at)
            at = close.end() if close else len(html)
            continue
        if name in VOID or raw.endswith("/") and name not in BLOCKS:
            continue
        inner = zone
        if name in FURNITURE or (name == "header" and zone != ARTICLE):
            inner = OUTSIDE
        elif zone != OUTSIDE:
            own = _attributes(raw)
            if (name not in ("html", "body", "main") and any(marked(own[k]) for k in ("class", "id") if k in own)) or own.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert") or "hidden" in own or own.get("aria-hidden") == "true":
                inner = OUTSIDE
            elif name in ("article", "main") or own.get("role") in ("main", "article") or own.get("itemprop") == "articleBody":
                inner = ARTICLE
        if inner != zone:
            close_block()
            zone = inner
        stack.push(name, inner)
    if at < len(html) and zone != OUTSIDE:
        text.append(html[at:])
    close_block()
    return found


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence (Hunt and Szymanski)."""
    where: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    ends: list[int] = []
    links: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def _own_words(lines: list[str], shared: set[int]) -> set[str]:
    return {w for i, x in enumerate(lines) if i not in shared for w in x.split()}


def shared_lines(own: list[str], other: list[str]) -> set[int] | None:
    """Places of the lines that two pages share; None if one is a copy of the other."""
    common = common_lines(own, other)
    if len(common) == len(own) or len(common) == len(other):
        return None
    shared, theirs = set(common), set(common_lines(other, own))
    a, b = _own_words(own, shared), _own_words(other, theirs)
    return None if len(a & b) >= ALIKE * len(a | b) else shared


def _needed(zone: int, line: str, able: int) -> int:
    """Neighbours that must share a line for its deletion, of ``able`` that are no copies."""
    short = len(line.split()) < SHORT
    if zone == ARTICLE:
        return able + 1 if short else max(ARTICLE_WEIGHT, able)
    return min(2, able) if short else 1


def without_template(own: list[Line], others: list[list[Line]]) -> tuple[list[Line], int]:
    """The lines that stay beside the neighbours' lines, and how many were deleted as shared."""
    lines, support, able = [x for _, x in own], [0] * len(own), 0
    for other in others:
        shared = shared_lines(lines, [x for _, x in other])
        if shared is not None:
            able += 1
            for i in shared:
                support[i] += 1
    left = [x for x, n in zip(own, support, strict=True) if not n or n < _needed(*x, able)]
    size = lambda zone: sum(len(x) for z, x in left if z == zone)
    if size(ARTICLE) and size(ARTICLE) >= size(FREE):
        return [x for x in left if x[0] == ARTICLE], len(own) - len(left)
    return left, len(own) - len(left)


def _keys(pages: DataFrame) -> DataFrame:
    """page_id, url, html with the order of pages: host, path, page id and a hash of the rest."""
    url = F.coalesce(pages["url"].cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    tie = F.xxhash64(url, F.coalesce(pages["html"].cast("string"), F.lit("")))
    key = F.struct(host.alias("h"), path.alias("p"), F.coalesce(pages["page_id"].cast("long"), F.lit(-(2**63))).alias("i"), tie.alias("t"))
    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"), key.alias("key"))


def _edges(starts: list[tuple]):
    """The smallest and largest keys that a task sees of every range."""
    kind = pa.struct([("h", pa.string()), ("p", pa.string()), ("i", pa.int64()), ("t", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, set[tuple]] = {}
        for batch in batches:
            for key in batch.column(0).to_pylist():
                k = tuple(key.values())
                held = ends.setdefault(bisect_right(starts, k), set())
                held.add(k)
                if len(held) > 64:
                    outer = sorted(held)
                    held.clear()
                    held.update(outer[:NEIGHBOURS] + outer[-NEIGHBOURS:])
        rows = [(part, dict(zip("hpit", k, strict=True))) for part, held in ends.items() for k in {*sorted(held)[:NEIGHBOURS], *sorted(held)[-NEIGHBOURS:]}]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind)], names=["part", "key"])

    return run


def guests(ends: list[tuple[int, tuple]]) -> dict[tuple, set[int]]:
    """Which other ranges see a page: those to which it is one of the last before or of the first after."""
    seen: dict[tuple, set[int]] = {}
    ends = sorted(ends)
    keys, parts = [k for _, k in ends], [p for p, _ in ends]
    for part in set(parts):
        lo, hi = bisect_left(parts, part), bisect_right(parts, part)
        for k in keys[max(0, lo - NEIGHBOURS) : lo] + keys[hi : hi + NEIGHBOURS]:
            seen.setdefault(k, set()).add(part)
    return seen


def _parse(starts: list[tuple], seen: dict[tuple, set[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows = []
            for page_id, url, html, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k = (key["h"], key["p"], key["i"], key["t"])
                lines = cut_lines(html)
                part = bisect_right(starts, k)
                blob = pack("\n".join(f"{z}{x}" for z, x in lines).encode("utf-8", "surrogatepass"))
                rows.append((part, False, page_id, url, *k, blob))
                rows += [(to, True, page_id, url, *k, blob) for to in seen.get(k, ())]
            names = ["part", "guest", "page_id", "url", "h", "p", "i", "t", "lines"]
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress

    def rows() -> Iterator[tuple | None]:
        for batch in batches:
            for part, guest, page_id, url, host, path, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "page_id", "url", "h", "p", "lines")), strict=True):
                text = unpack(blob).decode("utf-8", "surrogatepass")
                yield (part, guest, page_id, url, host, path, [(int(x[0]), x[1:]) for x in text.split("\n")] if text else [])

    made: list[tuple] = []
    window: list[tuple | None] = [None] * (2 * NEIGHBOURS + 1)
    for row in chain(rows(), [None] * NEIGHBOURS):
        window = [*window[1:], row]
        own = window[NEIGHBOURS]
        if own is not None and not own[1]:
            near = [x[6] for i, x in enumerate(window) if i != NEIGHBOURS and x is not None and x[0] == own[0] and x[4] == own[4]]
            left, deleted = without_template(own[6], near)
            text = "\n".join(x for _, x in left)
            made.append((own[2], own[3], text, len(text), deleted))
        if len(made) >= 500:
            yield _texts(made)
            made = []
    yield _texts(made)


def _texts(made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["page_id", "url", "text", "n_chars", "n_shared"])


def main_text(spark: SparkSession, pages: DataFrame, partitions: int | None = None, sample_per_range: int = 16) -> DataFrame:
    """page_id, url, text, n_chars and n_shared (lines deleted as shared) for every row of ``pages``."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keys(pages)
    # range boundaries from the keys with the smallest hashes: their number follows the number of ranges
    sample = keyed.select("key").orderBy(F.xxhash64("key"), "key").limit(n * sample_per_range).collect()
    ordered = sorted({tuple(r.key) for r in sample})
    starts = [ordered[i * len(ordered) // n] for i in range(1, n)] if len(ordered) > n else ordered[1:]
    found = keyed.select("key").mapInArrow(_edges(starts), "part int, key struct<h: string, p: string, i: bigint, t: bigint>")
    found = found.distinct()
    nth = lambda order: F.row_number().over(W.partitionBy("part").orderBy(order))
    outer = [found.withColumn("nth", nth(order)).where(F.col("nth") <= NEIGHBOURS).drop("nth") for order in (F.asc("key"), F.desc("key"))]
    seen = guests([(r.part, tuple(r.key)) for r in outer[0].union(outer[1]).distinct().collect()])
    parsed = keyed.mapInArrow(_parse(starts, seen), "part int, guest boolean, page_id long, url string, h string, p string, i long, t long, lines binary")
    dealt = parsed.repartitionById(len(starts) + 1, F.col("part")).sortWithinPartitions("part", "h", "p", "i", "t")
    return dealt.mapInArrow(_difference, "page_id long, url string, text string, n_chars long, n_shared long")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, load(spark, sf_dir, "pages"))


QUERIES = {"op6_main_text": op6_main_text}
ORACLES: dict[str, str] = {}
