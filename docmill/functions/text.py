"""Column functions on text, dates and keys; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal those of the data's producers.  Digits are spelled [0-9]: amounts and
# dates are cast by the JVM, which reads ASCII digits only, so a wider class would find what no cast accepts.
VOLATILE_COMMENTS = (r"(?s)<!--\s*Elapsed time:[^>]*?-->", r"(?s)<!--\s*cached or not being index\.aspx page\s*-->")
EXTENSIONS = {
    "text/html": "html",
    "application/pdf": "pdf",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
}
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DECISION_KEYWORDS = {"appeal": "Appeal", "enforcement": "Enforcement", "industrial relations": "Industrial Relations Referral", "complaint": "Complaint"}
ACT = r"([A-Z][A-Za-z'()\- ,&]{2,80}?Acts?\s+(?:19|20)[0-9]{2}(?:\s+to\s+(?:19|20)[0-9]{2})?)"
MONEY = r"€\s*([0-9]{1,3}(?:[,\s][0-9]{3})*(?:\.[0-9]+)?)"
REPRESENTED = r"(?i)\(\s*REPRESENTED\s+BY\s+([^)]+?)\s*\)"
SHORT_DATE = r"\b([0-9]{1,2}[/\-][0-9]{1,2}[/\-][0-9]{4})\b"
OFFICER = (r"Adjudication\s+Officer\s*[:\-]\s*([A-Z][A-Za-z' .\-]{2,80}?)(?=[.\s]|$)", r"Adjudicator\s*[:\-]\s*([A-Z][A-Za-z' .\-]{2,80}?)(?=[.\s]|$)")


def canonical_bytes(payload: Column, patterns: tuple[str, ...] = VOLATILE_COMMENTS) -> Column:
    """Bytes without volatile comments; Latin-1 maps every byte to one character and back."""
    text = F.decode(payload, "ISO-8859-1")
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return F.encode(text, "ISO-8859-1")


def content_hash(payload: Column) -> Column:
    return F.sha2(payload, 256)


def body_slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def extension(content_type: Column) -> Column:
    """html, pdf, doc or docx, else null."""
    key = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), key)


def mime_type(ext: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in EXTENSIONS.items() for x in (v, k)]), ext), F.lit("application/octet-stream"))


def landing_key(body: Column, partition_date: Column, identifier: Column, file_hash: Column, ext: Column) -> Column:
    return F.concat(body_slug(body), F.lit("/"), F.substring(partition_date, 1, 7), F.lit("/"), identifier, F.lit("-"), F.substring(file_hash, 1, 12), F.lit("."), ext)


def processed_key(body: Column, identifier: Column, ext: Column) -> Column:
    return F.concat(body_slug(body), F.lit("/"), identifier, F.lit("."), ext)


def identifier(reference: Column, title: Column) -> Column:
    """The trimmed reference, or the title where it is empty, without any white space."""
    return F.regexp_replace(F.coalesce(F.nullif(F.trim(reference), F.lit("")), title), r"(?U)\s+", "")


def joined_description(parts: Column) -> Column:
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), " ")


def escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def normalised_text(text: Column) -> Column:
    """One space for runs of blanks, at most one empty line, trimmed (Unicode NFC is applied where the DOM is read)."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def first_of_each(values: Column, key=lambda x: x) -> Column:
    """Order-preserving distinct under ``key``."""
    keys = F.transform(values, key)
    return F.filter(values, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def acts_cited(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit("(?U)" + ACT), F.lit(1)), lambda a: F.regexp_replace(F.btrim(F.regexp_replace(a, r"(?U)\s+", " "), F.lit(" ,;:")), r"(?i)^(?:under the|of the|the) ", ""))
    return first_of_each(F.filter(found, lambda a: F.length(a) >= 8), F.lower)


def money_amounts(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?U)" + MONEY), F.lit(1))
    return F.array_distinct(F.transform(found, lambda a: F.regexp_replace(a, r"(?U)[,\s]", "").try_cast("double")))


def representatives(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(REPRESENTED), F.lit(1)), lambda x: F.trim(x)))


def without_representatives(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, REPRESENTED, ""), F.lit(" ()"))


def decision_type(subject: Column, body: Column) -> Column:
    def of(text: Column) -> Column:
        out = None
        for word, name in DECISION_KEYWORDS.items():
            hit = F.contains(F.lower(text), F.lit(word))
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out

    return F.coalesce(of(subject), of(body))


def adjudicating_officer(text: Column) -> Column:
    found = [F.nullif(F.btrim(F.regexp_extract(text, p, 1), F.lit(" .,")), F.lit("")) for p in OFFICER]
    return F.coalesce(*found)


def chair(members: Column) -> Column:
    is_chair = lambda m: F.lower(m["role"]).isin("chairman", "chairperson", "chair", "deputy chairman")
    return F.get(F.filter(members, is_chair), F.lit(0))["name"]


def short_dates(text: Column) -> Column:
    """Valid D/M/YYYY or D-M-YYYY dates in order."""
    found = F.regexp_extract_all(text, F.lit(SHORT_DATE), F.lit(1))
    return F.filter(F.transform(found, lambda d: F.try_to_date(F.replace(d, F.lit("-"), F.lit("/")), "d/M/y")), lambda d: d.isNotNull())


def last_short_date(text: Column) -> Column:
    return F.try_element_at(short_dates(text), F.lit(-1))


def any_date(text: Column) -> Column:
    """The first long date ('23rd of June 2026'; null if it is no date), else the first short one if valid."""
    long = rf"(?i)\b([0-9]{{1,2}})(?:st|nd|rd|th)?\s+(?:of\s+)?({'|'.join(MONTHS)})\s+([0-9]{{4}})\b"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(text, long, 2)))
    parsed = F.try_to_date(F.concat_ws("/", F.regexp_extract(text, long, 1), month, F.regexp_extract(text, long, 3)), "d/M/y")
    short = F.try_to_date(F.replace(F.regexp_extract(text, SHORT_DATE, 1), F.lit("-"), F.lit("/")), "d/M/y")
    return F.when(F.regexp_like(text, F.lit(long)), parsed).otherwise(short)


def decision_date(value: Column) -> Column:
    """D/M/YYYY, else YYYY-MM-DD, else null; invalid dates are null."""
    site = F.when(F.regexp_like(value, F.lit(r"^\s*[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\s*$")), F.trim(value))
    iso = F.when(F.regexp_like(value, F.lit(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$")), F.trim(value))
    return F.coalesce(F.try_to_date(site, "d/M/y"), F.try_to_date(iso, "yyyy-MM-dd"))


def wall_clock(seconds: Column) -> Column:
    """mm:ss.ss, or ? where unknown."""
    return F.when(seconds.isNull(), "?").otherwise(F.format_string("%02d:%05.2f", F.floor(seconds / 60).cast("int"), seconds - F.floor(seconds / 60) * 60))


def counts_cell(counts: Column) -> Column:
    """Sorted k=v of a map, zeros left out."""
    entries = F.filter(F.array_sort(F.map_entries(counts)), lambda e: e["value"] != 0)
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")


def search_url(base: str, body_id: Column, start: Column, end: Column, page: Column) -> Column:
    return F.format_string(base + "?decisions=1&body=%d&pageNumber=%d&from=%s&to=%s", body_id, page, F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))


def with_page(url: Column, page: Column) -> Column:
    return F.regexp_replace(url, F.lit(r"pageNumber=\d+"), F.concat(F.lit("pageNumber="), page.cast("string")))


def total_results(text: Column, rows_on_page: Column) -> Column:
    return F.coalesce(F.regexp_extract(text, r"(?i)of\s+([0-9]+)\s+results", 1).try_cast("int"), rows_on_page)


def further_pages(total: Column, size: int = 10) -> Column:
    """Page numbers after the first."""
    return F.when(total > size, F.sequence(F.lit(2), F.ceil(total / size).cast("int"))).otherwise(F.array().cast("array<int>"))


def is_document_link(href: Column) -> Column:
    path = F.lower(F.split_part(F.split_part(href, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)))
    return F.regexp_like(path, F.lit(r"\.(pdf|doc|docx)$"))


#: Statuses worth another attempt, as the data's producers answer them.
RETRY_STATUSES = (403, 408, 429, 500, 502, 503, 504, 520, 521, 522, 523, 524)


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRY_STATUSES)


def failure_reason(error_class: Column) -> Column:
    """A stable label for the class of a store's error; null stays null."""
    return F.when(error_class.isNull(), None).when(error_class.isin("S3Error", "MinioException"), "minio_write_failed").when(error_class.endswith("PyMongoError") | error_class.isin("BulkWriteError", "DuplicateKeyError"), "mongo_write_failed").otherwise("pipeline_exception")


def truncated(message: Column, length: int = 200) -> Column:
    return F.substring(message, 1, length)


def aggregate_concurrency(target: Column, workers: Column) -> Column:
    return F.round(target * workers, 1)


def items_on_page(html: Column) -> Column:
    """Lines of a listing page that open an item (the count by which page sizes are probed)."""
    lines = F.split(html, "\n")
    return F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(r'<li[^>]*class="[^"]*each-item[^"]*"')))).cast("long")
