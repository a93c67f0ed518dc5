"""The engine against the facts that its contract states, on small fixtures."""

from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from docmill.config import EngineConfig
from docmill.functions import dom
from docmill.functions import text as tx
from docmill.operators import calendar, changes, validation
from docmill.plans import ORACLES, QUERIES
from docmill.plans import transform as tr
from docmill.sources import events, pages
from docmill.streaming import ingest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

PAGE = """<html><head><script>Google Tag Manager</script></head><body><nav>menu</nav><div class="row"><div class="col-sm-9"><h1 class="page-title">ABC1234</h1><!-- c --><p></p>
<a class="return-to-search" href="/">back</a><div class="content"><p><strong><span class="c3">PARTIES:</span></strong></p><div><p><b>NORTH PIER BAKERY LIMITED (REPRESENTED BY ACME)</b></p><p>AND</p><p><b>SAM GREY</b></p></div>
<p><span class="c3">DIVISION:</span></p><table><tr><td>Chairman:</td><td>Ms Quill</td></tr><tr><td>Member:</td><td>Ms X</td></tr></table>
<p><span class="c3">SUBJECT:</span></p><p>Appeal of a decision</p><p>The hearing took place on 23rd of June 2026. The sum is €26,000. 1: Workplace Relations Act 2015; the Terms of Employment (Information) Act 1994.
<table><tr><td>Signed on behalf of the Labour Court</td></tr><tr><td><b>Robin Quill</b></td></tr><tr><td>13/07/2026</td></tr></table></div></div></div><footer>google-analytics</footer></body></html>"""


def rounded(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(rounded, value)) if isinstance(value, list) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(ORACLES[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(rounded(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("size", ["monthly", "weekly", "daily"])
def test_windows_tile_the_range(spark, size):
    rows = sorted((r.query_start, r.query_end) for r in calendar.partitions(spark, date(2024, 1, 15), date(2024, 3, 10), size).collect())
    assert (rows[0][0], rows[-1][1]) == (date(2024, 1, 15), date(2024, 3, 10))
    assert all((b[0] - a[1]).days == 1 for a, b in zip(rows, rows[1:]))
    assert calendar.partitions(spark, date(2024, 2, 1), date(2024, 1, 1), size).isEmpty()


def test_settings():
    assert EngineConfig.from_env({"SCRAPER_PARTITION_SIZE": "weekly", "TRANSFORM_MIN_CONTENT_BYTES": ""}).partition_size == "weekly"
    with pytest.raises(ValueError):
        EngineConfig(partition_size="hourly")
    with pytest.raises(ValueError):
        EngineConfig().body_names([99])


def test_volatile_comments_do_not_change_the_hash(spark):
    base = b"<html>Decision text A</html>"
    variants = [base, base + b"<!-- Elapsed time: 0.0625034 -->", base + b"<!-- Elapsed time: 0.0501129 --><!-- cached or not being index.aspx page -->", base.replace(b"A", b"B"), b"%PDF-1.7\n\x00\x01\xff"]
    got = spark.createDataFrame([(bytearray(v),) for v in variants], "p binary").select(tx.canonical_bytes(F.col("p")).alias("c")).collect()
    assert [bytes(r.c) for r in got] == [base, base, base, variants[3], variants[4]]


def landing(spark, rows):
    schema = "identifier string, body string, body_id int, partition_date string, partition_end string, date string, bucket string, file_path string, file_hash string, content_type string, title string, payload binary"
    return spark.createDataFrame(rows, schema)


def row(name, payload, hash_="a" * 64, body="Labour Court", day="13/07/2026", kind="text/html"):
    return (name, body, 3, "2026-07-01", "2026-07-31", day, "landing", f"k/{name}", hash_, kind, name, payload)


def state_of(spark, result, schema=tr.PROCESSED):
    return spark.createDataFrame(tr.merged(spark.createDataFrame([], schema), result).collect(), schema)


def test_transform_cold_warm_changed_and_quarantine(spark):
    page = bytearray(PAGE.encode() + b" " * 10)
    big = bytearray(PAGE.replace("ABC1234</h1>", "ABC1234</h1>" + "<p>word</p>" * 300).encode())
    deep = bytearray(("<div class='content'>" + "<div>" * 6000 + "x").encode())
    first = landing(spark, [row("ABC1234", big), row("SMALL", bytearray(b'<div class="content">x</div>')), row("NONE", bytearray(b"<p>x</p>")), row("PDF", bytearray(b"%PDF" + b"x" * 2000), kind="application/pdf"), row("LATE", big, day="15/09/2026"), row("NOBODY", big, body=None), row("IMG", page, kind="image/png"), row("GONE", None), row("DEEP", deep), row(None, big)])
    empty_p, empty_q = spark.createDataFrame([], tr.PROCESSED), spark.createDataFrame([], tr.QUARANTINE)
    now = datetime(2026, 8, 1)
    cold = tr.transform(spark, first, empty_p, empty_q, now)
    assert {r.identifier: (r.outcome, r.reason) for r in cold.outcomes.collect()} == {
        "ABC1234": ("transformed", None), "SMALL": ("quarantined", "schema_validation_failed"), "NONE": ("failed", "content_not_found"), "PDF": ("passthrough", None), "LATE": ("quarantined", "schema_validation_failed"),
        "NOBODY": ("quarantined", "schema_validation_failed"), "IMG": ("failed", "incomplete_landing_metadata"), "GONE": ("failed", "landing_download_failed"), "DEEP": ("transformed", None), None: ("failed", "incomplete_landing_metadata"),
    }
    fields = cold.processed.where("identifier = 'ABC1234'").first().structured
    assert (fields.decision_type, fields.chair, fields.signatory, fields.hearing_date, fields.signature_date) == ("Appeal", "Ms Quill", "Robin Quill", "2026-06-23", "2026-07-13")
    assert 26000.0 in fields.monetary_amounts_eur and fields.parties.respondent == "SAM GREY" and fields.parties.representatives == ["ACME"]
    assert [a.lower() for a in fields.acts_cited] == ["workplace relations act 2015", "terms of employment (information) act 1994"]
    text = cold.processed.where("identifier = 'ABC1234'").first().text
    assert "NORTH PIER" in text and "Google" not in text and "menu" not in text
    held = spark.createDataFrame(tr.settle(empty_q, cold).collect(), tr.QUARANTINE)
    assert {r.identifier for r in held.collect()} == {"SMALL", "LATE", "NOBODY"}
    state = state_of(spark, cold)
    assert {r.identifier for r in state.collect()} == {"ABC1234", "PDF", "DEEP"}
    later = datetime(2026, 8, 2)
    warm = tr.transform(spark, first.where("identifier in ('ABC1234', 'PDF')"), state, held, later)
    assert {r.outcome for r in warm.outcomes.collect()} == {"unchanged"} and warm.processed.isEmpty()
    after = {r.identifier: r for r in tr.merged(state, warm).collect()}
    assert after["PDF"].last_transformed_at == later and after["PDF"].first_transformed_at == now and after["DEEP"].last_transformed_at == now
    bumped = tr.transform(spark, first.where("identifier = 'ABC1234'"), state, held, later, EngineConfig(transform_version=3))
    assert [r.outcome for r in bumped.outcomes.collect()] == ["unchanged"] and bumped.touched.first().transform_version == 3
    mended = tr.transform(spark, landing(spark, [row("LATE", big)]), state, held, now)
    assert {r.identifier for r in tr.settle(held, mended).collect()} == {"SMALL", "NOBODY"}
    broken = tr.transform(spark, landing(spark, [row("PDF", bytearray(b"x"), hash_="b" * 64, kind="application/pdf")]), state, held, later)
    assert {r.identifier for r in tr.merged(state, broken).collect()} == {"ABC1234", "DEEP"}  # one place only
    assert sum(r.asDict()["transformed"] for r in cold.summary(total=False).collect()) == 2
    import json

    lines = [json.loads(r.value) for r in cold.events().collect()]
    assert [x["event"] for x in lines].count("record_failed") == 4 and lines[-1]["event"] == "transform_summary" and lines[-1]["failed"] == 4


def test_a_second_sighting_sees_the_first(spark):
    one, two = (bytearray(PAGE.replace("ABC1234</h1>", "ABC1234</h1>" + f"<p>{w}</p>" * 300).encode()) for w in ("one", "two"))
    same = bytearray(bytes(two) + b"<!-- outside -->")
    rows = [("a", one, "2026-07-01"), ("b", two, "2026-07-02"), ("b", two, "2026-07-03"), ("c", same, "2026-07-04"), ("d", bytearray(b"x"), "2026-07-05"), ("d", bytearray(b"x"), "2026-07-06")]
    made = landing(spark, [("ABC1234", "Labour Court", 3, day, "2026-07-31", "13/07/2026", "landing", f"k/{h}{day}", h * 64, "text/html", "t", p) for h, p, day in rows])
    result = tr.transform(spark, made, spark.createDataFrame([], tr.PROCESSED), spark.createDataFrame([], tr.QUARANTINE), datetime(2026, 8, 1))
    assert [r.outcome for r in result.outcomes.orderBy("partition_date").collect()] == ["transformed", "transformed", "unchanged", "unchanged", "failed", "failed"]
    assert len(state_of(spark, result).collect()) == 1


@pytest.fixture
def root_logger():
    import logging

    root = logging.getLogger()
    before = list(root.handlers), root.level
    yield root
    root.handlers[:], root.level = before


def test_runs_sinks_and_exit_codes(spark, tmp_path, root_logger):
    import json

    from docmill import __main__ as cli
    from docmill import storage
    from docmill.plans import runs

    root = f"file://{tmp_path}/tables"
    big = bytearray(PAGE.replace("ABC1234</h1>", "ABC1234</h1>" + "<p>word</p>" * 300).encode())
    runs.landing_from(landing(spark, [row("ABC1234", big), row("PDF", bytearray(b"%PDF" + b"x" * 2000), kind="application/pdf"), row("LATE", big, day="15/09/2026")]), spark, root)
    args = ["transform", "--root", root, "--start-date", "2026-07-15", "--end-date", "2026-07-31"]
    assert cli.main(args, spark) == 0
    assert cli.main([*args, "--strict", "--bodies", "3"], spark) == 0  # nothing in range
    assert cli.main([*args, "--bodies", "99"], spark) == 1
    assert cli.main([*args[:5], "--end-date", "2026-01-01"][:0] + ["transform", "--root", root, "--start-date", "2026-07-15", "--end-date", "2026-01-01"], spark) == 1
    with pytest.raises(SystemExit):
        cli.main(["transform", "--root", root, "--start-date", "20260715", "--end-date", "2026-07-31"], spark)
    done = storage.snapshot(spark, f"{root}/processed_metadata")
    assert {r.identifier for r in done.collect()} == {"ABC1234", "PDF"} and set(done.columns) == {f.name for f in spark.createDataFrame([], tr.PROCESSED).schema}
    contents = {r.key: r for r in spark.read.parquet(f"{root}/processed").collect()}
    assert set(contents) == {"labour_court/ABC1234.html", "labour_court/ABC1234.txt", "labour_court/PDF.pdf"} and contents["labour_court/ABC1234.txt"].content_type == "text/plain"
    runs.landing_from(landing(spark, [row("ABC1234", big), row("GONE", None)]), spark, root)
    assert cli.main(args, spark) == 2
    logs = [json.loads(r.value) for r in spark.read.text(f"{root}/logs").collect()]
    assert [x["reason"] for x in logs if x["event"] == "record_failed"] == ["landing_download_failed"] and {x["event"] for x in logs} >= {"partition_summary", "transform_summary", "record_unchanged", "record_quarantined"}
    text = runs.summarise_logs(spark, "run", f"{root}/logs")
    assert "failed=" in text and "transformed=" in text
    calls = []
    with pytest.raises(RuntimeError):
        runs.materialise(spark, root, lambda *a: calls.append(a), date(2026, 7, 1), date(2026, 7, 31), [3], sleep=calls.append)
    assert [c for c in calls if not isinstance(c, tuple)] == [15, 15]  # the pauses before its retries
    runs.landing_from(landing(spark, [row("ABC1234", big)]), spark, root)
    assert [x["unchanged"] for x in runs.materialise(spark, root, lambda *a: None, date(2026, 7, 1), date(2026, 7, 31), [3])] == [1]


def test_ingest_then_transform_from_the_command_line(spark, tmp_path, root_logger):
    from docmill import __main__ as cli
    from docmill import storage

    root = f"file://{tmp_path}/tables"
    big = bytearray(PAGE.replace("ABC1234</h1>", "ABC1234</h1>" + "<p>word</p>" * 300).encode())
    items = [("ABC1234", "2026-07-01", 3, "Labour Court", big), ("OLD1", "2025-01-01", 3, "Labour Court", big), ("NONE1", "2026-07-01", 3, "Labour Court", None)]
    spark.createDataFrame([(i, d, "2026-07-31", "13/07/2026", b, n, "text/html", "1", p) for i, d, b, n, p in items], "identifier string, partition_date string, partition_end string, date string, body_id int, body string, content_type string, scraped_at string, payload binary").write.parquet(f"{tmp_path}/items")
    span = ["--root", root, "--start-date", "2026-07-10", "--end-date", "2026-07-31", "--bodies", "3"]
    assert cli.main(["ingest", "--items", f"{tmp_path}/items", *span], spark) == 0
    rows = storage.snapshot(spark, f"{root}/landing_metadata")
    assert [r.identifier for r in rows.collect()] == ["ABC1234"] and "payload" not in rows.columns
    assert cli.main(["transform", *span], spark) == 0
    assert [r.identifier for r in storage.snapshot(spark, f"{root}/processed_metadata").collect()] == ["ABC1234"]


def test_payloads_by_path(spark, tmp_path):
    (tmp_path / "blobs/lc").mkdir(parents=True)
    (tmp_path / "blobs/lc/A.html").write_bytes(b"abc")
    rows = spark.createDataFrame([("A", "lc/A.html"), ("B", "lc/B.html")], "identifier string, file_path string")
    assert {r.identifier: r.payload and bytes(r.payload) for r in tr.with_payloads(spark, rows, f"file://{tmp_path}/blobs").collect()} == {"A": b"abc", "B": None}


def test_field_errors_hide_record_errors(spark):
    base = {"identifier": "ABC1234", "body": "Labour Court", "body_id": "3", "partition_date": "2026-07-01", "partition_end": "2026-07-31", "date": "13/07/2026", "bucket": "b", "file_path": "p", "file_hash": "a" * 64, "file_size": 8192, "content_type": "text/html"}
    cases = [({}, []), ({"identifier": "oops bad<>"}, ["identifier:shape"]), ({"identifier": ""}, ["identifier:shape"]), ({"file_hash": "not-a-sha256"}, ["file_hash:shape"]), ({"partition_date": "01/01/2026"}, ["partition_date:shape"]), ({"file_size": 42}, ["record:too_small"]), ({"date": "15/09/2026"}, ["record:date_after_partition"]), ({"file_size": 42, "body": None, "body_id": "x"}, ["body:missing", "body_id:type"])]
    columns = list(base)
    df = spark.createDataFrame([tuple((base | c)[k] for k in columns) for c, _ in cases], "identifier string, body string, body_id string, partition_date string, partition_end string, date string, bucket string, file_path string, file_hash string, file_size long, content_type string")
    assert [r.e for r in df.select(validation.errors().alias("e")).collect()] == [e for _, e in cases]


def test_pages_without_content_and_bad_pdfs():
    assert dom.read_page(b"<html><body></body></html>", "X", ("div.content",))["error"] == "content_not_found"
    assert dom.pdf_text(b"") is None and dom.pdf_text(b"not a pdf") is None

    class Page:
        def __init__(self, text):
            self.text = text

        def extract_text(self):
            if self.text is None:
                raise KeyError("font")
            return self.text

    class Reader:
        def __init__(self, _):
            self.pages = [Page("one  e\u0301"), Page(None), Page(" "), Page("two")]

    assert dom.pdf_text(b"x", Reader) == "one \u00e9\n\ntwo"
    assert dom.read_page(PAGE.encode(), "T", ("div.col-sm-9",)) == dom.read_page(PAGE.encode(), "T", ("div.col-sm-9",))


def test_listing_rows_and_links(spark):
    html = '<div class="searchhead">Showing 1 to 10 of 23 results</div><li class="each-item clearfix"><h2 class="title"><a href="/a/b.html">T 1</a></h2><span class="refNO">IR - SC - 00003431</span><p class="description"> x <b>y</b></p><span class="date">1/2/2024</span></li><li class="each-item"><h2 class="title">no link</h2></li>'
    got = spark.createDataFrame([(html, "https://example.org/s/")], "h string, u string").select(pages.listing("h", "u").alias("r"), pages.links("h", "u").alias("l")).first()
    assert got.r[0].identifier == "IR-SC-00003431" and got.r[0].href == "https://example.org/a/b.html" and got.r[0].description == "x y"
    assert got.r[1].error == "missing_identifier_or_href" and got.l == ["https://example.org/a/b.html"]
    bad = '<div class="content"><a href="http://[bad">x</a><a href="/f/A.PDF?x=1">y</a><a href="/g.docx">z</a></div><li class="each-item"><h2 class="title"><a href="http://[bad">T</a></h2><span class="refNO">R</span></li>'
    got = spark.createDataFrame([(bad, "https://example.org/s/")], "h string, u string").select(pages.listing("h", "u").alias("r"), pages.links("h", "u").alias("l")).first()
    assert got.r[0].identifier == "R" and got.r[0].href is None and got.l == ["https://example.org/f/A.PDF?x=1", "https://example.org/g.docx"]


def test_wrapper_pages_are_replaced_by_their_document(spark):
    fetches = spark.createDataFrame([("A", "u/a", "text/html", bytearray(b"a"), ["u/x.html", "u/d.pdf?1", "u/e.doc"], False), ("B", "u/b", "text/html", bytearray(b"b"), ["u/x.html"], False), ("C", "u/d.pdf", "text/html", bytearray(b"c"), ["u/d.pdf"], True), ("D", "u/c", "text/html", bytearray(b"d"), ["u/none.pdf"], None)], "identifier string, doc_url string, content_type string, payload binary, links array<string>, is_document_fetch boolean")
    documents = spark.createDataFrame([("u/d.pdf?1", "application/pdf", bytearray(b"%PDF"))], "url string, content_type string, payload binary")
    got = {r.identifier: (r.doc_url, r.wrapper_url, r.content_type, r.payload and bytes(r.payload)) for r in pages.routed(fetches, documents).collect()}
    assert got == {"A": ("u/d.pdf?1", "u/a", "application/pdf", b"%PDF"), "B": ("u/b", None, "text/html", b"b"), "C": ("u/d.pdf", None, "text/html", b"c"), "D": ("u/none.pdf", "u/c", None, None)}


def test_event_logs_skip_what_is_no_object(spark, tmp_path):
    (tmp_path / "parallel_1.jsonl").write_text('{"event": "partition_summary", "found": 3, "x": 1.9, "ok": true, "body_id": 3, "name": "7", "ts": "2024-01-01T00:00:00.000+00:00"}\nnot json\n  {"event": "record_stored", "body": "b", "ts": "2024-01-01T00:01:00.500+00:00"}\n{broken\n')
    (tmp_path / "parallel_2.jsonl").write_text('{"event": "partition_summary", "found": 4, "scraped": 2, "ts": "2024-01-01T00:05:00.000+00:00"}\n{"event": "record_stored", "ts": "2024-01-01T00:04:00.000+00:00"}\n')
    got = events.read_events(spark, str(tmp_path / "parallel_1.jsonl"))
    assert got.count() == 2 and got.agg(F.sum("found")).first()[0] == 3
    assert events.event_span(got).first()[0] == 60.5
    lines = events.read_lines(spark, str(tmp_path / "parallel_*.jsonl"))
    assert {r.field: r.total for r in events.numeric_totals(lines).collect()} == {"found": 7, "x": 1, "scraped": 2}
    assert [(r.body, r.n) for r in events.stored_by_body(lines).collect()] == [("?", 1), ("b", 1)]
    assert {r.worker: (r.stored, r.partitions, r.wall_seconds) for r in events.by_worker(lines).collect()} == {"parallel_1": (1, 1, 60.5), "parallel_2": (1, 1, -60.0)}
    view = events.event_view(lines, "partition_summary")
    assert sorted(r.found for r in view.collect()) == [3, 4] and "identifier" not in view.columns
    with pytest.raises(ValueError):
        events.event_view(lines, "nothing")
    for name in events.EVENTS:
        assert events.event_view(lines, name).count() >= 0
    from docmill.sources.events import wall_seconds

    (tmp_path / "w").write_text("12.5\n")
    assert wall_seconds(spark, str(tmp_path / "w")).first()[0] == 12.5


def test_classes_within_a_run_and_stream(spark, tmp_path):
    items = [("A", "text/html", "x", "1"), ("A", "text/html", "y", "2"), ("A", "text/html", "y", "3"), ("B", "image/png", "x", "1"), ("C", "text/html", "", "1")]
    schema = "identifier string, content_type string, payload binary, scraped_at string, body string, partition_date string"
    df = spark.createDataFrame([(i, c, bytearray(p.encode()), s, "Labour Court", "2024-01-01") for i, c, p, s in items], schema)
    known = spark.createDataFrame([], "identifier string, file_hash string")
    got = sorted((r.identifier, r.scraped_at, r.outcome, r.reason) for r in ingest.ingest_batch(df, known).collect())
    assert got == [("A", "1", "inserted", None), ("A", "2", "updated", None), ("A", "3", "unchanged", None), ("B", "1", "dropped", "unsupported_content_type"), ("C", "1", "dropped", "empty_body")]
    df.write.parquet(f"{tmp_path}/in")
    root, at = f"file://{tmp_path}/tables", datetime(2024, 2, 1)
    for _ in range(2):  # a second run finds nothing new
        source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        ingest.ingest_stream(spark, source, root, f"{tmp_path}/ck", now=at).awaitTermination()
    from docmill import storage

    state = storage.snapshot(spark, f"{root}/landing_metadata").collect()
    assert [(r.identifier, r.file_size, r.file_path[:24], r.first_scraped_at) for r in state] == [("A", 1, "labour_court/2024-01/A-a", at)]
    assert sorted(bytes(r.payload) for r in spark.read.parquet(f"{root}/landing-zone").collect()) == [b"x", b"y"]
    lines = events.read_lines(spark, f"{root}/logs/*")
    assert sorted((r.identifier, r.change) for r in events.event_view(lines, "record_stored").collect()) == [("A", "content_changed"), ("A", "new")]
    assert sorted((r.identifier, r.reason) for r in events.event_view(lines, "record_dropped").collect()) == [("B", "unsupported_content_type"), ("C", "empty_body")]
    assert [(r.inserted, r.dropped) for r in events.event_view(lines, "storage_summary").collect()] == [(1, 2)]
    log = events.event_view(lines, "partition_summary").first()
    assert (log.found, log.inserted, log.updated, log.unchanged, log.dropped) == (5, 1, 1, 1, 2)
    later = datetime(2024, 2, 3)
    seen = spark.createDataFrame([("A", "text/html", bytearray(b"y"), "4", "Labour Court", "2024-01-01")], schema)
    summary = ingest.ingest(spark, seen, root, later, 1).first()
    assert (summary.unchanged, summary.gap) == (1, 0)
    state = storage.snapshot(spark, f"{root}/landing_metadata").first()
    assert (state.last_seen_at, state.updated_at) == (later, at)
    assert ingest.known_hashes(storage.snapshot(spark, f"{root}/landing_metadata"), date(2024, 1, 20), date(2024, 1, 31), [1]).count() == 0
    assert ingest.known_hashes(storage.snapshot(spark, f"{root}/landing_metadata"), date(2024, 1, 20), date(2024, 1, 31)).count() == 1
    urls = spark.createDataFrame([("u", "1"), ("u", "2"), ("v", "1")], "doc_url string, scraped_at string")
    assert ingest.distinct_urls(urls).count() == 2


def test_settings_files_logs_and_checks(spark, tmp_path):
    import io
    import json
    import logging

    from docmill import logs
    from docmill.config import env_file, id_list
    from docmill.operators import checks

    (tmp_path / ".env").write_text("# comment\nexport SCRAPER_PARTITION_SIZE='daily'\nSCRAPER_RETRY_TIMES=7\nDAGSTER_PARTITION_START_DATE=2021-02-03\nMONGO_LANDING_COLLECTION=\n")
    config = EngineConfig.from_env({"SCRAPER_RETRY_TIMES": "9"}, str(tmp_path / ".env"))
    assert (config.partition_size, config.retry_times, config.first_partition, config.landing_table) == ("daily", 9, date(2021, 2, 3), "landing_metadata")
    assert EngineConfig.from_env({"SCRAPER_BODIES": "3:Labour Court| 5:X y"}).bodies == {3: "Labour Court", 5: "X y"}
    assert id_list("3, 15376,") == [3, 15376] and id_list("") is None and env_file(str(tmp_path / "none")) == {}
    root, before, out = logging.getLogger(), list(logging.getLogger().handlers), io.StringIO()
    level = root.level
    try:
        logs.log_as_json("info", out)
        logs.log_as_json("INFO", out)
        logging.getLogger("x").info("record_stored", extra={"event": "record_stored", "identifier": "é", "day": date(2024, 1, 1)})
        try:
            raise ValueError("no")
        except ValueError:
            logging.getLogger("x").exception("bad")
    finally:
        root.handlers[:] = before
        root.setLevel(level)
    lines = [json.loads(x) for x in out.getvalue().splitlines()]
    assert [(x["msg"], x["level"], x.get("identifier"), x.get("day")) for x in lines] == [("record_stored", "INFO", "é", "2024-01-01"), ("bad", "ERROR", None, None)]
    assert "ValueError: no" in lines[1]["exc"] and lines[0]["ts"].endswith("+00:00") and "é" in out.getvalue()
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert [tuple(r) for r in checks.repeated_keys(df, "k").collect()] == [("a", 2)] and checks.missing_columns(("v", "w", "k"), df) == ["w"]
    row = spark.createDataFrame([("S3Error", 503, "x" * 400)], "e string, s int, m string").select(tx.failure_reason(F.col("e")).alias("a"), tx.is_retryable(F.col("s")).alias("b"), F.length(tx.truncated(F.col("m"))).alias("c"), tx.aggregate_concurrency(F.lit(0.8), F.lit(5)).alias("d"), tx.wall_clock(F.lit(202.189)).alias("w")).first()
    assert tuple(row) == ("minio_write_failed", True, 200, 4.0, "03:22.19")


def test_merge_keeps_insert_only_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, first int")
    new = spark.createDataFrame([(2, "B", 9), (3, None, 9)], "k int, v string, first int")
    assert sorted(map(tuple, changes.merge(old, new, "k", ("first",)).collect())) == [(1, "a", 1), (2, "B", 1), (3, None, 9)]


def test_text_functions_in_odd_cases(spark):
    df = spark.createDataFrame([([" a ", "", "b c "], "Adjudication Officer: Pat O'Neill .", "x 3rd of July 2024 y", "31/02/2024")], "p array<string>, o string, d string, s string")
    row = df.select(tx.joined_description(F.col("p")).alias("a"), tx.adjudicating_officer(F.col("o")).alias("b"), tx.any_date(F.col("d")).alias("c"), tx.any_date(F.col("s")).alias("d"), tx.mime_type(F.lit("pdf")).alias("e"), tx.mime_type(F.lit("xyz")).alias("f"), tx.wall_clock(F.lit(None).cast("double")).alias("g")).first()
    assert tuple(row) == ("a b c", "Pat", date(2024, 7, 3), None, "application/pdf", "application/octet-stream", "?")


def test_scan_and_range_errors(spark):
    rows = spark.createDataFrame([("B", "x", "2024-01-01"), ("A", "x", "2024-01-01"), ("C", "y", "2023-12-01"), ("D", "x", "2024-03-01")], "identifier string, body string, partition_date string")
    assert [r.identifier for r in tr.scan(rows, date(2024, 1, 15), date(2024, 2, 1)).collect()] == ["A", "B"]
    assert tr.scan(rows, date(2024, 1, 15), date(2024, 2, 1), strict=True).count() == 0
    assert [r.identifier for r in tr.scan(rows, date(2023, 1, 1), date(2024, 12, 1), ["x"]).collect()] == ["A", "B", "D"]
    with pytest.raises(ValueError):
        tr.in_range(rows, date(2024, 2, 1), date(2024, 1, 1))


def test_markdown_summary():
    from docmill.operators.summaries import markdown_summary

    text = markdown_summary("run", {"scraped": 30, "failed": 0, "found": 31}, 60.0, {"b": 1, "a": 1, "c": 28})
    assert "| 60.000 | 30.0 | found=31, scraped=30 |" in text
    assert text.index("| c | 28 |") < text.index("| a | 1 |") < text.index("| b | 1 |")
    assert "| ? | ? |  |" in markdown_summary("none", {}, None)


def test_clean_dom_reads_cut_references_as_its_sql_does(spark, tmp_path):
    cut = ["one &amp", "two &lt", "x &am", "&&amp;amp", "&ampfoo; &#x27;", "a &quot;b&quot; &#x2", "&amp; &lt;i&gt;"]
    rows = [(i, f"<html><body><article><h1>{x}</h1><p>{x} end</p></article></body></html>") for i, x in enumerate(cut)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    expected = {r[0]: r[1] for r in con.execute(ORACLES["html_clean_dom"]).fetchall()}
    assert {r.page_id: r.text for r in QUERIES["html_clean_dom"](spark, str(tmp_path)).collect()} == expected
    assert expected[0] == "0\none &amp\none &amp end"
    assert dom.read_page(rows[0][1].encode(), "0", ("article",))["text"] == "0\none &\none & end"  # the engine reads as browsers do
