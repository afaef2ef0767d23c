"""WARC derivatives: metadata and plain-text conversion records of response records.

A response becomes two more records that point to it with WARC-Refers-To: one of
type ``metadata`` with what was read from its headers and markup, and one of type
``conversion`` with its text. Ids are name-based, so the same response always gets
the same records; digests are SHA-1 in base 32, as archives write them. All of it is
Spark expressions, row by row: no shuffle, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, fresh

VERSION = "WARC/1.1"
#: The date of records whose response has none.
EPOCH = "1970-01-01T00:00:00Z"
RESPONSE_TYPE, METADATA_TYPE, TEXT_TYPE = "application/http;msgtype=response", "application/warc-fields", "text/plain"

# Markup elements whose content is no text, elements that end a line,
# and the named character references that are resolved (the ampersand last).
SILENT = ("script", "style", "noscript", "template", "head")
#: Of these a head is told by what stands in it, as its end tag may be left out.
_RAW = "|".join(t for t in SILENT if t != "head")
BLOCKS = (
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main nav ol p pre section table td th tr ul"
).split()
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "))

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _sha1(value: Column) -> Column:
    """``sha1:`` and the 32 signs of base 32."""

    def base32(digest: Column) -> Column:
        bits = F.concat(*(F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 2), 40, "0") for i in range(4)))
        return bound(bits, signs)

    def signs(bits: Column) -> Column:
        def sign(i: Column) -> Column:
            place = F.conv(F.substring(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int")
            return F.substring(F.lit(_BASE32), place + 1, F.lit(1))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), sign), "")

    return F.concat(F.lit("sha1:"), bound(F.sha1(value), base32))


def _id(*parts: Column) -> Column:
    """A name-based urn:uuid (version 8, of the MD5 of the parts)."""
    h = F.md5(F.concat_ws("|", *parts))
    cuts = (h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("8"), h.substr(14, 3)), F.concat(F.lit("8"), h.substr(18, 3)), h.substr(21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def responses(pages: DataFrame, date: str = EPOCH) -> DataFrame:
    """Response records (record_id, uri, date, headers, payload) of crawled (url, html) rows.

    The header block is the least that a server must have sent; a null url is an
    empty one and a null html a response without a body.
    """
    uri, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    headers = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
    )
    named = pages.select("*", uri.alias(fresh(pages, "_uri")), html.alias(fresh(pages, "_html")))
    uri, html = (F.col(fresh(pages, c)) for c in ("_uri", "_html"))
    return named.select(
        F.col("page_id").cast("long").alias("page_id"),
        _id(F.lit("response"), F.col("page_id").cast("string"), uri, F.md5(html)).alias("record_id"),
        uri.alias("uri"),
        F.lit(date).alias("date"),
        headers.alias("headers"),
        html.alias("payload"),
    )


def text_of(html: Column) -> Column:
    """Plain text of markup: silent elements and tags go, blocks end lines, references are resolved.

    A comment or silent element that isn't closed reaches to the end. Of them the one
    that begins first counts, so signs of another inside it mean nothing. A head may
    lack its end tag, so what goes is what it can hold: its tags, silent elements and
    the title; other text ends a head. An unclosed title ends with the head.
    """
    text = F.regexp_replace(html, rf"(?is)<!--.*?(?:-->|\z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\z)", "")
    # the title of a drawing is text
    title = r"<title\b[^>]*>.*?(?:</title\s*>|(?=</head\s*>|<body\b)|\z)"
    text = F.regexp_replace(text, rf"(?is)(<svg\b[^>]*>.*?(?:</svg\s*>|\z))|{title}", "$1")
    text = F.regexp_replace(text, rf"(?i)</?(?:{'|'.join(BLOCKS)})\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^<>]*>", "")
    for name, sign in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    text = F.replace(text, F.lit("&amp;"), F.lit("&"))
    text = F.regexp_replace(text, r"[ \t\r\f\x0B]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def _header(headers: Column, name: str) -> Column:
    """Value of a header field, empty if it has none."""
    return F.trim(F.regexp_extract(headers, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1))


def derive(responses: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records for each response: its metadata and its text.

    Columns: ``key``, type, record_id, refers_to, uri, date, content_type, length
    (bytes of the block), block_digest, source_digest (of the response's payload),
    source_headers (its HTTP header block) and block. Defined cases: an empty
    payload has an empty conversion block and a metadata record without a title;
    null fields count as empty; repeated responses have the same records again.
    """
    names = ("record_id", "uri", "date", "headers", "payload")
    rows = responses.select(F.col(key).alias("_key"), *(F.coalesce(c, F.lit("")).alias(c) for c in names))
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>([^<]*)", 1), r"\s+", " "))
    language = F.regexp_extract("payload", r"(?is)<html\b[^>]*\blang=[\"']?([A-Za-z-]+)", 1)
    links = F.regexp_extract_all("payload", F.lit(r"(?is)<a\b[^>]*\bhref=[\"']([^\"'<>]*)"), F.lit(1))
    status = F.regexp_extract("headers", r"^HTTP/\S+ (\d+)", 1)
    rows = rows.select(
        "*",
        F.array_join(
            F.array_compact(
                F.concat(
                    F.array(
                        F.concat(F.lit("status: "), status),
                        F.concat(F.lit("content-type: "), _header(F.col("headers"), "content-type")),
                        F.when(title != "", F.concat(F.lit("title: "), title)),
                        F.when(language != "", F.concat(F.lit("language: "), language)),
                    ),
                    F.transform(links, lambda x: F.concat(F.lit("outlink: "), x)),
                )
            ),
            "\r\n",
        ).alias("metadata"),
        text_of(F.col("payload")).alias("conversion"),
        _sha1(F.col("payload")).alias("source_digest"),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit(METADATA_TYPE).alias("content_type"), F.col("metadata").alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.lit(TEXT_TYPE).alias("content_type"), F.col("conversion").alias("block")),
    )
    rows = rows.select(
        "_key", F.inline(kinds), F.col("record_id").alias("refers_to"), "uri", "date", "source_digest", F.col("headers").alias("source_headers")
    )
    return rows.select(
        F.col("_key").alias(key),
        "type",
        _id(F.col("type"), F.col("refers_to")).alias("record_id"),
        "refers_to",
        "uri",
        "date",
        "content_type",
        F.octet_length("block").cast("long").alias("length"),
        _sha1(F.col("block")).alias("block_digest"),
        "source_digest",
        "source_headers",
        "block",
    )


def serialised(records: DataFrame) -> Column:
    """The bytes of each derived record, as a WARC file holds them one after the other."""
    fields = (
        ("WARC-Type", "type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Date", "date"),
        ("WARC-Target-URI", "uri"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Block-Digest", "block_digest"),
        ("WARC-Source-Digest", "source_digest"),
        ("Content-Type", "content_type"),
        ("Content-Length", "length"),
    )
    lines = [F.concat(F.lit(f"{name}: "), records[c].cast("string")) for name, c in fields]
    head = F.concat_ws("\r\n", F.lit(VERSION), *lines)
    return F.concat(head, F.lit("\r\n\r\n"), records["block"], F.lit("\r\n\r\n")).cast("binary")


def parsed(records: DataFrame, content: str = "content") -> DataFrame:
    """Response records (record_id, uri, date, headers, payload) of a column with the bytes of one WARC record each.

    Records of other types are left out; header names may come in any case.
    """
    text = F.decode(F.col(content), "UTF-8")
    parts = F.split(text, r"\r\n\r\n", 3)
    warc = F.get(parts, F.lit(0))
    rows = records.filter(F.lower(_header(warc, "WARC-Type")) == "response")
    return rows.select(
        _header(warc, "WARC-Record-ID").alias("record_id"),
        _header(warc, "WARC-Target-URI").alias("uri"),
        _header(warc, "WARC-Date").alias("date"),
        F.concat(F.get(parts, F.lit(1)), F.lit("\r\n\r\n")).alias("headers"),
        F.regexp_replace(F.coalesce(F.get(parts, F.lit(2)), F.lit("")), r"\r\n\r\n$", "").alias("payload"),
    )
