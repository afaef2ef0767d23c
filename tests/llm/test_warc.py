"""Derivatives of responses: against SQL, by standard digests, and there and back."""

import base64
import hashlib

import duckdb
from faultline.llm import queries, warc


def digest(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_query_against_sql(spark, sf):
    df = queries.queries()["op7_warc_derivatives"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(queries.OP7_SQL)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
    for r in df.limit(40).collect():
        assert r.block_digest == digest(r.block) and r.length == len(r.block.encode())


def test_text_and_metadata(spark):
    html = (
        '<!DOCTYPE html><html lang="de"><head><title>A &amp; B\n C</title><style>p{}</style></head><body><!-- no --><p>One<br>two'
        ' <b>three</b></p>\n\n<script>var x = "</p>";</script><a href="/x">link &lt;x&gt;</a><div>&nbsp;end</div><!-- open'
    )
    rows = warc.derive(warc.responses(spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")))
    block = {r.type: r.block for r in rows.collect()}
    assert block["conversion"] == "One\ntwo three\nlink <x>\nend"
    assert block["metadata"].split("\r\n") == [
        "status: 200",
        "content-type: text/html; charset=UTF-8",
        "title: A &amp; B C",
        "language: de",
        "outlink: /x",
    ]


def test_links_back_to_responses_read_from_records(spark):
    body = "<html><body><p>Hi</p></body></html>\r\n"
    http = "HTTP/1.1 404 Not Found\r\ncontent-type: text/html\r\nServer: x\r\n\r\n"
    record = (
        "WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://h/p\r\n"
        f"WARC-Date: 2024-01-02T03:04:05Z\r\nContent-Length: 1\r\n\r\n{http}{body}\r\n\r\n"
    )
    other = record.replace("warc-type: response", "WARC-Type: request")
    df = spark.createDataFrame([(record.encode(),), (other.encode(),)], "content binary")
    rows = warc.parsed(df).withColumn("page_id", warc.F.lit(1))
    found = {r.type: r for r in warc.derive(rows).collect()}
    for r in found.values():
        assert (r.refers_to, r.uri, r.date) == ("<urn:uuid:1>", "http://h/p", "2024-01-02T03:04:05Z")
        assert r.source_digest == digest(body) and r.source_headers == http
    assert found["metadata"].block.startswith("status: 404\r\ncontent-type: text/html")
    assert found["conversion"].block == "Hi"
    derived = warc.derive(rows)
    data = {bytes(r.b) for r in derived.select(warc.serialised(derived).alias("b")).collect()}
    assert all(d.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"WARC-Refers-To: <urn:uuid:1>\r\n" in d for d in data)


def test_edges(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>"), (2, "u", "<p>"), (3, "u", "<!--" * 100_000 + "<script>" * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS type", "2 AS block", "3 AS uri", "4 AS headers")
    got = warc.derive(warc.responses(df)).collect()
    assert len(got) == 2 * len(rows)
    assert all(r.block == "" and r.length == 0 for r in got if r.type == "conversion")
    assert warc.derive(warc.responses(df.limit(0))).count() == 0


def test_text_after_open_heads_and_in_scripts(spark):
    """A head without its end tag ends at the body; what looks like a comment in a script is none."""
    pages = {
        "<html><head><meta charset=x><title>T</title><body><p>One</p></body></html>": "One",
        "<head><title>Use <b> here</title><script>1 < 2</script><link rel=x><p>Two": "Two",
        "<head><title>T</title></head><body><script>var x = '<!--';</script>Three</body>": "Three",
        "<HEAD><TITLE>T</TITLE><STYLE>p{}</STYLE></HEAD>Four<!-- <script> --> five": "Four five",
        "<p>Six</p><svg><title>seven</title></svg><header>eight</header>": "Six\nseven\neight",
        "<head><title>T</title>": "",
        "<head><title>T</title>Nine <b>ten</b>": "Nine ten",
        "<head><title>T</head><body>Eleven": "Eleven",
        "<title>" * 50_000 + "<svg>" * 50_000: "",
    }
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.derive(warc.responses(df)).collect() if r.type == "conversion"}
    assert [got[i].block for i in range(len(pages))] == list(pages.values())
    assert all(r.length == len(r.block) and r.block_digest == digest(r.block) for r in got.values())
