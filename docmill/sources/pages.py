"""Listing pages, links and the documents that pages wrap."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dom import Node, parse
from ..functions.text import is_document_link

LISTING = "array<struct<identifier: string, title: string, href: string, description: string, date: string, error: string>>"


def listing_rows(html: str | None, base_url: str | None) -> list[dict]:
    """Rows of a search page (li.each-item); a bad row has ``error`` set and fails alone."""
    rows = []
    for item in (n for n in parse(html or "").walk() if n.name == "li" and n.has_class("each-item")):
        try:
            rows.append(_listing_row(item, base_url))
        except (AttributeError, ValueError) as fault:  # a bad row fails alone
            rows.append({"identifier": None, "title": None, "href": None, "description": None, "date": None, "error": f"row_parse_failed: {type(fault).__name__}"})
    return rows


def _joined(base: str | None, href: str) -> str | None:
    try:
        return urljoin(base or "", href)
    except ValueError:  # no URL
        return None


def _listing_row(item: Node, base_url: str | None) -> dict:
    by = lambda name, cls: next((n for n in item.walk() if n.name == name and n.has_class(cls)), None)
    title = by("h2", "title")
    link = next((n for n in title.walk() if n.name == "a"), None) if title else None
    ref, text, day = by("span", "refNO"), by("p", "description"), by("span", "date")
    name = re.sub(r"\s+", "", (ref.text() if ref else "") or (link.text() if link else ""))
    href = link.attrs.get("href") if link else None
    error = None if name and href else "missing_identifier_or_href"
    return {"identifier": name or None, "title": link.text() if link else None, "href": _joined(base_url, href) if href else None, "description": text.text() if text else None, "date": day.text() if day else None, "error": error}


def listing(html: str, base_url: str) -> Column:
    """listing_rows of two columns."""

    def of(pages: pd.Series, urls: pd.Series) -> pd.Series:
        return pd.Series([listing_rows(h, b) for h, b in zip(pages, urls, strict=True)])

    return F.pandas_udf(of, LISTING)(html, base_url)


def links(html: str, base_url: str) -> Column:
    """Absolute links of a page in order, of its content where that is marked."""

    def one(h: str, b: str) -> list[str]:
        try:
            root = parse(h or "")
        except (ValueError, AssertionError):  # a page that is no markup has no links
            return []
        zone = next((n for n in root.walk() if n.name == "div" and (n.has_class("col-sm-9") or n.has_class("content"))), root)
        found = (_joined(b, n.attrs["href"]) for n in zone.walk() if n.name == "a" and n.attrs.get("href"))
        return [x for x in found if x is not None]

    def of(pages: pd.Series, urls: pd.Series) -> pd.Series:
        return pd.Series([one(h, b) for h, b in zip(pages, urls, strict=True)])

    return F.pandas_udf(of, "array<string>")(html, base_url)


def document_link(page_links: Column) -> Column:
    """The first link to a document, null without one."""
    return F.get(F.filter(page_links, is_document_link), F.lit(0))


def routed(fetches: DataFrame, documents: DataFrame) -> DataFrame:
    """Fetched pages with what they stand for: a page that links a document is replaced by the document, once.

    ``fetches``: identifier, doc_url, content_type, payload, ``links`` and ``is_document_fetch``;
    ``documents``: url, content_type, payload.  A wrapper whose document is not there keeps a null payload.
    """
    link = F.when(~F.coalesce("is_document_fetch", F.lit(False)), document_link(F.col("links")))
    pages = fetches.withColumn("document_url", link)
    found = documents.select(F.col("url").alias("document_url"), F.col("content_type").alias("_type"), F.col("payload").alias("_payload"))
    both = pages.join(found, "document_url", "left")
    wrapper = F.col("document_url").isNotNull()
    return both.withColumns(
        {"wrapper_url": F.when(wrapper, F.col("doc_url")), "doc_url": F.coalesce("document_url", "doc_url"), "content_type": F.when(wrapper, F.col("_type")).otherwise(F.col("content_type")), "payload": F.when(wrapper, F.col("_payload")).otherwise(F.col("payload"))}
    ).drop("_type", "_payload", "links", "document_url")
