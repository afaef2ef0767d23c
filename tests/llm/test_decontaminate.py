"""Leaks against a search for the items' words, and re-parameterised questions."""

import re

from faultline.llm import decontaminate, queries

QUESTION = "Yesterday Jim had 3 apples and gave 2 km of them to Sue before dinner, then Jim walked 3 miles home again."


def test_query_finds_every_passage(spark, sf, texts):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()

    def words(text):
        return f" {' '.join(re.findall(r'[^\W_]+', text.lower()))} "

    want = {(i, b.item_id) for i, t in texts.items() for b in items if words(b.text) in words(t)}
    rows = queries.queries()["op3_decontamination"](spark, sf).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows} == want


def test_other_numbers_and_names(spark):
    rows = [
        (1, "So. Yesterday Ann Lee had 12 apples and gave 5 km of them to Mary before dinner, then Ann Lee walked 12 miles home again."),
        (2, "Yesterday Ann had 7 apples and gave 9 km of them to Bob before dinner, then Zed walked 8 miles home again."),
        (3, "Something else that holds 3 apples and walked home again."),
        (4, QUESTION.upper()),
        (5, QUESTION.replace("dinner", "supper")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (2, None), (3, "too short")], "item_id long, text string")
    found = decontaminate.leaks(docs, bench).collect()
    # the copy in capitals is found by its plain lower-cased words
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (4, 1), (5, 1)]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [2, 3]


def test_canonical_form():
    one, slots = decontaminate.canonical("We saw Ann Lee run 5 km. Then 5 km more.")
    two, _ = decontaminate.canonical("We saw Bob run 12.5 miles. Then three hours more.")
    assert one.tolist() == two.tolist()
    assert [bool(s) for s in slots] == [False, False, True, False, True, True, False, True, True, False]


def test_edges(spark, edges, none):
    bench = spark.createDataFrame([(9, "one two three four five six seven"), (None, "word " * 8)], "item_id long, text string")
    found = decontaminate.leaks(edges, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 9), (2, 9), (None, 9), (6, None)}
    assert decontaminate.clean(edges, bench.limit(0)).count() == edges.count()
    assert decontaminate.leaks(none, bench).count() == 0
    kept = decontaminate.clean(edges, bench)
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} >= {3, 4, 5, 7}


def test_number_words_alone_are_no_template(spark, edges):
    """A window needs literal tokens, so lists of numbers don't match each other."""
    bench = spark.createDataFrame([(1, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "20 30 40 50 60 70 80 90 100 110 120 130 140 150 160")], "doc_id long, text string")
    assert decontaminate.leaks(docs, bench).count() == 0


def test_verbatim_copies(spark):
    """Copies of items that are nearly all numbers, hold names in other capitals, or are shorter than a window."""
    items = [
        (1, "What is 12 + 34 + 56 + 78 + 90 + 11?"),
        (2, "The next term of 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024 is"),
        (3, QUESTION),
        (4, "Capital of France?"),
        (5, "?!"),
    ]
    rows = [(10 * i + k, f"Something before it. {c} Something after it.") for i, t in items[:4] for k, c in enumerate((t, t.upper(), t.lower()))]
    others = [(1, "What is 13 + 35 + 57 + 79 + 91 + 12?"), (2, "The capital of Peru, and France"), (3, "of France? Capital"), (4, "?!")]
    docs = spark.createDataFrame(rows + others, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(d, d // 10) for d, _ in rows]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [1, 2, 3, 4]


def test_short_item_in_a_long_text(spark):
    """An item of one word is one match a document, however often the word stands there."""
    docs = spark.createDataFrame([(1, "word " * 200_000), (2, "words")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Word!")], "item_id long, text string")
    assert [(r.doc_id, r.coverage) for r in decontaminate.leaks(docs, bench).collect()] == [(1, 1.0)]


def test_known_tokens_are_only_looked_up(monkeypatch):
    """A text without a new token isn't searched for any; the tokens are the same."""
    tokens = decontaminate._Tokens()
    first = [x.tolist() for x in tokens("Two trains leave a_b at 12.5 km.")]
    learned = []
    monkeypatch.setattr(decontaminate._Tokens, "_learn", lambda self, new: learned.append(new))
    assert [x.tolist() for x in tokens("Two trains leave a_b at 12.5 km.")] == first
    assert learned == []
