"""One parse of a page: cleaned subtree, plain text and the fields that need the tree."""

from __future__ import annotations

import html as entities
import io
import re
import unicodedata
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

from . import text as text_patterns

# Names and labels that the pages' producers use.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style noscript".split())
CLOSED_BY = {"p": frozenset("p div table ul ol h1 h2 h3 h4 h5 h6 section article footer header nav form".split()), "li": frozenset(["li"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "tr": frozenset(["tr"]), "option": frozenset(["option"])}
LABELS = ("PARTIES", "DIVISION", "SUBJECT", "BACKGROUND", "DECISION")
HEARING = re.compile(r"(?:hearing\s+(?:took\s+place|was\s+held|convened)|held\s+a\s+hearing)[^.]{0,80}?on\s+(?:the\s+)?", re.IGNORECASE)
REPRESENTED = re.compile(text_patterns.REPRESENTED)
REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")
#: Lines beside a signature that are no name.
NOT_SIGNATORIES = ("cc", "chairman", "deputy chairman", "signed on behalf of the labour court")


class Node:
    def __init__(self, name: str, attrs: dict[str, str], parent: "Node | None"):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator["Node"]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def texts(self) -> Iterator[str]:
        todo: list = [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                yield node
            else:
                todo += reversed(node.children)

    def text(self, joiner: str = " ") -> str:
        return joiner.join(x for x in (t.strip() for t in self.texts()) if x)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def markup(self) -> str:
        """The children as HTML; nesting of any depth."""
        out: list[str] = []
        todo: list = list(reversed(self.children))
        while todo:
            item = todo.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(entities.escape(item, quote=False))
            else:
                attrs = "".join(f' {k}="{entities.escape(v)}"' for k, v in item.attrs.items())
                if item.name in VOID:
                    out.append(f"<{item.name}{attrs}/>")
                else:
                    out.append(f"<{item.name}{attrs}>")
                    todo.append((f"</{item.name}>",))
                    todo += reversed(item.children)
        return "".join(out)


class _Builder(HTMLParser):
    """Tags to a tree, with the implied end tags that real pages rely on; comments vanish."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.at.name in CLOSED_BY and tag in CLOSED_BY[self.at.name]:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(markup: str) -> Node:
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


def closed_references(markup: str) -> str:
    """Markup in which only known references that end in a semicolon are read as such: the ``&`` of any other is text."""
    return REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", markup)


def select(root: Node, selector: str) -> Node | None:
    """First match of ``name`` or ``name.class``."""
    name, _, cls = selector.partition(".")
    return next((n for n in root.walk() if n.name == name and (not cls or n.has_class(cls))), None)


def prune(root: Node) -> None:
    for node in list(root.walk()):
        node.children = [c for c in node.children if isinstance(c, str) or not (c.name in DROPPED or (c.name == "a" and c.has_class("return-to-search")))]
    for node in list(root.walk()):
        node.children = [c for c in node.children if isinstance(c, str) or not (c.name == "p" and not c.text() and not any(isinstance(x, Node) for x in c.children))]


def plain_text(root: Node) -> str:
    text = unicodedata.normalize("NFC", root.text("\n"))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def _label_hosts(root: Node) -> dict[str, Node]:
    hosts: dict[str, Node] = {}
    for span in root.walk():
        label = span.text().upper().rstrip(":").strip() if span.name == "span" and span.has_class("c3") else ""
        if label in LABELS and label not in hosts:
            host, climbed = span, 0
            while host.parent is not None and host.name not in ("p", "div", "td") and climbed < 4:
                host, climbed = host.parent, climbed + 1
            hosts[label] = host
    return hosts


def _following(host: Node | None) -> list[Node]:
    if host is None or host.parent is None:
        return []
    siblings = [c for c in host.parent.children if isinstance(c, Node)]
    return siblings[siblings.index(host) + 1 :]


def _subject(host: Node | None, hosts: dict[str, Node]) -> str:
    found = []
    for node in _following(host):
        if any(h is node or any(x is h for x in node.walk()) for h in hosts.values()):
            break
        found.append(node.text())
    return " ".join(x for x in found if x)


def _parties(host: Node | None) -> dict:
    lines: list[str] = []
    for block in _following(host):
        if block.name in ("div", "p", "table"):
            lines = list(dict.fromkeys(x for x in (n.text() for n in block.walk() if n.name in ("p", "b", "strong")) if x))
            break
    sides: list[list[str]] = [[], []]
    side, found = 0, []
    for line in lines:
        if line.upper() == "AND" or line.upper().startswith("AND "):
            side = 1
            continue
        found += [m.strip() for m in REPRESENTED.findall(line)]
        if name := REPRESENTED.sub("", line).strip(" ()"):
            sides[side].append(name)
    return {"complainant": " ".join(sides[0]) or None, "respondent": " ".join(sides[1]) or None, "representatives": list(dict.fromkeys(found))}


def _division(host: Node | None) -> list[dict]:
    table = next((n for n in _following(host) if n.name == "table"), None)
    members = []
    for row in table.walk() if table else ():
        cells = [c for c in row.children if isinstance(c, Node) and c.name == "td"] if row.name == "tr" else []
        if len(cells) >= 2 and (role := cells[0].text().rstrip(":").strip()) and (name := cells[1].text()):
            members.append({"role": role, "name": name})
    return members


def _signatory(tables: list[Node]) -> str | None:
    for table in reversed(tables):
        if "signed on behalf" not in table.text().lower():
            continue
        for node in table.walk():
            name = node.text() if node.name in ("b", "strong") else ""
            if len(name) >= 3 and "_" not in name and name.lower() not in NOT_SIGNATORIES:
                return name
    return None


EMPTY_PAGE = {"clean": None, "text": None, "body_text": None, "error": None, "message": None, "subject": "", "parties": {"complainant": None, "respondent": None, "representatives": []}, "division_members": [], "tables": [], "signatory": None, "hearing_tails": []}


def read_page(payload: bytes | None, title: str | None, selectors: tuple[str, ...], closed_only: bool = False) -> dict:
    """Everything that the tree gives; ``error`` (content_not_found, page_unreadable) is set instead of raising.

    Browsers also decode some references without their semicolon (``&amp`` at a cut end); ``closed_only`` keeps those as text.
    """
    try:
        return _read_page(payload, title, selectors, closed_only)
    except (ValueError, RecursionError, AssertionError) as fault:  # what markup can provoke in a parser; a bad page fails alone
        return EMPTY_PAGE | {"error": "page_unreadable", "message": f"{type(fault).__name__}: {fault}"[:200]}


def _read_page(payload: bytes | None, title: str | None, selectors: tuple[str, ...], closed_only: bool) -> dict:
    markup = (payload or b"").decode("utf-8", "replace")
    root = parse(closed_references(markup) if closed_only else markup)
    found = next((n for n in (select(root, s) for s in selectors) if n is not None), None)
    if found is None:
        return EMPTY_PAGE | {"error": "content_not_found", "message": f"no element matches {', '.join(selectors)}"}
    prune(found)
    head = entities.escape(title or "", quote=True).replace("&#x27;", "'")
    clean = f'<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>{head}</title></head><body>{found.markup()}</body></html>'
    whole = parse(clean)
    hosts, body = _label_hosts(whole), whole.text()
    tables = [n for n in whole.walk() if n.name == "table"]
    return EMPTY_PAGE | {
        "clean": clean.encode(), "text": plain_text(whole), "body_text": body, "subject": _subject(hosts.get("SUBJECT"), hosts), "parties": _parties(hosts.get("PARTIES")),
        "division_members": _division(hosts.get("DIVISION")), "tables": [t.text() for t in tables], "signatory": _signatory(tables), "hearing_tails": [body[m.end() : m.end() + 60] for m in HEARING.finditer(body)],
    }


PAGE = (
    "struct<clean: binary, text: string, body_text: string, error: string, message: string, subject: string, parties: struct<complainant: string, respondent: string, representatives: array<string>>, "
    "division_members: array<struct<role: string, name: string>>, tables: array<string>, signatory: string, hearing_tails: array<string>>"
)


def page_reader(selectors: tuple[str, ...] = ("div.col-sm-9", "div.content"), closed_only: bool = False):
    """Arrow UDF (payload, title) -> PAGE; evaluate it below a filter, never inside a CASE."""

    @F.pandas_udf(PAGE)
    def read(payload: pd.Series, title: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(p, t, selectors, closed_only) for p, t in zip(payload, title, strict=True)])

    return read


try:
    from pypdf import PdfReader
except ImportError:  # an optional parser
    PdfReader = None


def pdf_text(payload: bytes | None, reader=None) -> str | None:
    """Text of a PDF in NFC, pages that fail left out; null without a parser, for unreadable and for empty files."""
    reader = reader or PdfReader
    if reader is None:
        return None
    try:
        pages = list(reader(io.BytesIO(payload or b"")).pages)
    except Exception:  # noqa: BLE001  files of any kind
        return None
    texts = []
    for page in pages:
        try:
            texts.append(page.extract_text() or "")
        except Exception:  # noqa: BLE001  a page that fails is left out
            continue
    text = unicodedata.normalize("NFC", "\n\n".join(x for x in texts if x.strip()))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip() or None
