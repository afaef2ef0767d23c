"""Registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bitslices,
    collocations,
    decontaminate,
    hard_negatives,
    licenses,
    lines,
    minhash,
    mixing,
    pii,
    simhash,
    toxicity,
    training_order,
    warc,
)
from .common import documents, read

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def toxicity_chain(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Chain:
    """Low quality first, then toxic, as far as ``labels`` says."""
    labels = read(spark, sf, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.fit(docs, labels, ["low_quality", "toxic"])


@query
def op1_bit_sliced_top_k(spark: SparkSession, sf: str) -> DataFrame:
    rows = bitslices.quantised(read(spark, sf, "embeddings"), "vec_id", "embedding")
    return bitslices.top_k(rows, F.col("id") % 50 == 0, 5).withColumnRenamed("id", "vec_id")


@query
def op2_training_order(spark: SparkSession, sf: str) -> DataFrame:
    return training_order.training_order(documents(spark, sf))


@query
def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf), read(spark, sf, "benchmark")).drop("text_hash")


@query
def op4_pii(spark: SparkSession, sf: str) -> DataFrame:
    def place(kind, s):
        return F.concat_ws(":", kind, s["start"], s["end"])

    found = pii.find(documents(spark, sf))
    return found.select(
        "doc_id",
        *(F.size(k.name).cast("long").alias(f"n_{k.name}") for k in (*pii.BASE, *pii.ADDED)),
        F.sha2(pii.listed(pii.BASE, place), 256).alias("base_sha256"),
        pii.listed((*pii.BASE, *pii.ADDED), place).alias("spans"),
        pii.listed((*pii.BASE, *pii.ADDED), lambda kind, s: F.concat_ws(":", kind, s["start"], s["score"])).alias("scores"),
    )


@query
def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.duplicates(documents(spark, sf))


@query
def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, sf))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derive(warc.responses(read(spark, sf, "pages")))


@query
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity_chain(spark, docs, sf))


@query
def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf)).drop("text_hash")


@query
def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf)).drop("text_hash")


@query
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf))


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    other = F.col("vec_id") % 7 == 0
    label = F.when(other, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(read(spark, sf, "embeddings"), "vec_id", "embedding", label)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@query
def op13_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf))


#: Brute force over all pairs of a query and another row.
OP1_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score
FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
WHERE rank <= 5
"""


def _sql_sha1(x: str) -> str:
    sign = f"(CAST('0x' || substr(sha1({x}), 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31"
    return (
        f"'sha1:' || array_to_string(list_transform(range(32), lambda i: "
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ({sign}) AS BIGINT), 1)), '')"
    )


def _sql_id(*parts: str) -> str:
    h = f"md5(concat_ws('|', {', '.join(parts)}))"
    cuts = f"substr({h}, 1, 8), substr({h}, 9, 4), '8' || substr({h}, 14, 3), '8' || substr({h}, 18, 3), substr({h}, 21, 12)"
    return f"'<urn:uuid:' || concat_ws('-', {cuts}) || '>'"


def _sql_text(x: str) -> str:
    steps = [(r"(?s)<!--.*?(?:-->|\z)", "''")]
    steps += [(rf"(?is)<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)", "''") for t in warc.SILENT]
    steps += [(rf"(?i)</?(?:{'|'.join(warc.BLOCKS)})\b[^>]*>", "chr(10)"), ("<[^<>]*>", "''")]
    for pattern, by in steps:
        x = f"regexp_replace({x}, '{pattern}', {by}, 'g')"
    for name, sign in (*warc.REFERENCES, ("&amp;", "&")):
        x = "replace({}, '{}', '{}')".format(x, name, sign.replace("'", "''"))
    x = f"regexp_replace({x}, '[ \\t\\r\\f\\v]+', ' ', 'g')"
    return f"trim(regexp_replace({x}, ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"


#: The records of each page, written out field by field.
OP7_SQL = f"""
WITH pages_ AS (
    SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS payload, chr(13) || chr(10) AS eol FROM pages
),
responses AS (
    SELECT *, {_sql_id("'response'", "CAST(page_id AS VARCHAR)", "uri", "md5(payload)")} AS refers_to,
           'HTTP/1.1 200 OK' || eol || 'Content-Type: text/html; charset=UTF-8' || eol || 'Content-Length: '
               || strlen(payload) || eol || eol AS source_headers,
           trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>([^<]*)', 1), '\\s+', ' ', 'g')) AS title,
           regexp_extract(payload, '(?is)<html\\b[^>]*\\blang=["'']?([A-Za-z-]+)', 1) AS language,
           regexp_extract_all(payload, '(?is)<a\\b[^>]*\\bhref=["'']([^"''<>]*)', 1) AS links,
           {_sql_sha1("payload")} AS source_digest
    FROM pages_
),
records AS (
    SELECT *, 'metadata' AS type, '{warc.METADATA_TYPE}' AS content_type,
           array_to_string(list_concat(
               list_filter(['status: 200', 'content-type: text/html; charset=UTF-8',
                            CASE WHEN title <> '' THEN 'title: ' || title END,
                            CASE WHEN language <> '' THEN 'language: ' || language END], lambda x: x IS NOT NULL),
               list_transform(links, lambda x: 'outlink: ' || x)), chr(13) || chr(10)) AS block
    FROM responses
    UNION ALL
    SELECT *, 'conversion', '{warc.TEXT_TYPE}', {_sql_text("payload")} FROM responses
)
SELECT page_id, type, {_sql_id("type", "refers_to")} AS record_id, refers_to, uri, '{warc.EPOCH}' AS date, content_type,
       CAST(strlen(block) AS BIGINT) AS length, {_sql_sha1("block")} AS block_digest, source_digest, source_headers, block
FROM records
"""


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every phrase of one to four words is counted.
OP11_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_SQL_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
),
phrases AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size))
),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1)
),
scores AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score, k
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.head JOIN frequent y ON y.lang = c.lang AND y.phrase = c.tail
),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
    SELECT lang, array_to_string(w[i : i + n - 1], ' ') AS phrase, max(f) AS longer
    FROM (SELECT *, unnest(range(1, size - n + 2)) AS i
          FROM (SELECT *, unnest(range(2, size)) AS n FROM frequent WHERE size > 2))
    GROUP BY ALL
),
kept AS (
    SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept JOIN totals USING (lang))
WHERE rank <= 2000
"""

#: Brute force over all pairs of an anchor and another row.
OP12_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id,
           CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
           CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
    FROM scored WHERE alike QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_rank,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
WHERE 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""

#: Every two documents that share a shingle are compared, and links followed to their end.
OP13_SQL = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex({_SQL_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS s
    FROM worded
),
single AS (SELECT doc_id, hash(unnest(s)) AS x FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM single a JOIN single b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sets s ON s.doc_id = a JOIN sets t ON t.doc_id = b
    WHERE 100 * shared >= 85 * (len(s.s) + len(t.s) - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_bit_sliced_top_k": OP1_SQL,
        "op7_warc_derivatives": OP7_SQL,
        "op11_collocations": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_minhash": OP13_SQL,
    }
