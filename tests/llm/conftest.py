import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()

#: Rows every operator on documents has to take: nulls, empty and blank texts, a long one, repeats, ties.
EDGES = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, "one two three four five six seven", None),
    (None, "one two three four five six eight nine", "a"),
    (3, None, "b"),
    (4, "", "b"),
    (5, " \t\n ", None),
    (6, "word " * 200_000, "c"),
    (7, "x", "c"),
]
#: Columns that the operators use inside.
CLASHES = (
    "_text_hash _kept_id _hash _nth _copies _leak_id _rejected _gone _uri text_hash fp component_id node line root band"
    " size rate copies target words window pos place ids slot shard record n position shingles score rank at"
).split()


@pytest.fixture(scope="session")
def edges(spark):
    """Edge rows with extra columns whose names clash with inner ones."""
    df = spark.createDataFrame(EDGES, "doc_id long, text string, source string")
    return df.select("*", *(F.lit("kept").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def none(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
