"""Toxicity by a classifier chain of sparse linear models.

The categories are predicted one after the other. Each model is a logistic
regression with an L1 penalty on which words and word beginnings occur in the whole
text and on the log-odds that the models before it gave. In training those come out
of fold, so a later model sees its predecessors as they are on texts they were not
fitted on; the out-of-fold log-odds of each category also set its threshold, at the
best F1 among those that leave nearly all clean rows alone. Fitting takes a bounded
sample of labelled rows; scoring runs over all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import exp, fsum, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stage

#: Labelled rows that a chain is fitted on, at most; those of the least hashed doc_id.
SAMPLE_ROWS = 8192
FOLDS = 2
#: Features in fewer rows of the sample are left out.
MIN_ROWS = 3
#: Word beginnings of these lengths are features besides the words: they carry inflected forms.
PREFIXES = (4, 5)
L1 = 0.001
#: Features that come to the driver, at most: those of the largest gradients.
FEATURES = 1 << 15
STEPS = 100
#: Share of the clean rows of the sample that a threshold may reject, out of fold.
FALSE_ALARMS = 0.005
#: Log-odds are held within this distance of 0.
EDGE = 30.0
#: Occurrences of features summed together on the driver.
AT_ONCE = 1 << 18
#: Words remembered by a scoring task.
CACHE = 500_000

_WORDS = re.compile(r"\w+")


def _of_word(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


def _words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


@dataclass(frozen=True)
class Linear:
    intercept: float
    features: dict[str, float] = field(default_factory=dict)
    #: One weight per earlier category, on its log-odds.
    earlier: tuple[float, ...] = ()
    threshold: float = 0.0


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def scorer(self):
        """Function from a text to its log-odds, one per category in the chain's order."""
        used = set().union(*(m.features for m in self.models))
        known: dict[str, tuple[str, ...]] = {}

        def hits(word: str) -> tuple[str, ...]:
            found = known.get(word)
            if found is None:
                found = tuple(f for f in _of_word(word) if f in used)
                if len(known) < CACHE:
                    known[word] = found
            return found

        def score(text: str | None) -> list[float]:
            found = {f for w in _words(text) for f in hits(w)}
            odds: list[float] = []
            for m in self.models:
                z = fsum(m.features[f] for f in found & m.features.keys())
                z += m.intercept + sum(w * x for w, x in zip(m.earlier, odds))
                odds.append(max(-EDGE, min(EDGE, z)))
            return odds

        return score


def _summed(to: np.ndarray, values: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Sum of values[at] by ``to``, a bounded number at a time."""
    out = np.zeros(width)
    for i in range(0, len(to), AT_ONCE):
        out += np.bincount(to[i : i + AT_ONCE], values[at[i : i + AT_ONCE]], width)
    return out


def _fit(start: np.ndarray, col: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Weights (features, dense columns, intercept) by accelerated proximal gradient steps.

    Row i has the features col[start[i]:start[i + 1]]. Features whose gradient at
    the prior doesn't reach the penalty are left out.
    """
    n = len(y)
    col = col.astype(np.int32)
    out = np.zeros(width + dense.shape[1] + 1)
    share = (y.sum() + 0.5) / (n + 1)
    out[-1] = log(share / (1 - share))
    if not n or y.min() == y.max():  # nothing to tell apart: the prior alone
        return out
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(start))
    gradient = _summed(col, share - y, row, width) / n
    kept = np.flatnonzero(np.abs(gradient) > L1)
    number = np.full(width, -1, np.int32)
    number[kept] = np.arange(len(kept))
    among = number[col] >= 0
    row, col = row[among], number[col[among]]
    wide = np.hstack([dense, np.ones((n, 1))])

    def times(w):
        return _summed(row, w, col, n) + wide @ w[len(kept) :]

    def back(r):
        return np.concatenate([_summed(col, r, row, len(kept)), wide.T @ r])

    v = np.ones(len(kept) + wide.shape[1])
    for _ in range(12):  # the largest curvature, by power iteration
        v = back(times(v / np.linalg.norm(v)))
    step = 4 * n / (np.linalg.norm(v) * 1.05)
    w = np.zeros_like(v)
    w[-1] = out[-1]
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(times(ahead), -EDGE, EDGE)))
        new = ahead - step / n * back(p - y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * L1, 0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    out[kept] = w[: len(kept)]
    out[width:] = w[len(kept) :]
    return out


def _threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """Log-odds above which F1 is best, with few false alarms; 0 if there is nothing to choose by."""
    if not len(y) or y.min() == y.max():
        return 0.0
    order = np.argsort(-odds, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[np.arange(1, len(y) + 1) - hit > FALSE_ALARMS * (len(y) - y.sum())] = 0
    f1[:-1][odds[order][:-1] == odds[order][1:]] = 0  # no cut between equal rows
    at = int(f1.argmax())
    if not f1[at]:  # the highest row of all is a false alarm
        return max(0.0, float(odds[order[0]]))
    return float(odds[order[at : at + 2]].mean()) if at + 1 < len(y) else float(odds[order[at]]) - 1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sorted({f for w in _words(t.as_py()) for f in _of_word(w)}) for t in b.column("text")]
        names = [c for c in b.schema.names if c != "text"]
        arrays = [b.column(c) for c in names] + [pa.array(found, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, [*names, "features"])


def sample(docs: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, each category as a double, features): at most ``rows`` labelled documents.

    The ids come from the labels alone, by hash, so the choice is the same on
    every run; one row per id, the largest label of a repeated one. Rows without
    an id, or without any label, are not taken.
    """
    each = [F.max(F.col(c).cast("double")).alias(c) for c in categories]
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*each)
    known = known.filter(F.coalesce(*categories).isNotNull())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(chosen), "doc_id")  # bounded by ``rows``
    found = found.groupBy("doc_id", *categories).agg(F.min("text").alias("text"))
    schema = T.StructType([f for f in found.schema.fields if f.name != "text"])
    return found.mapInArrow(_features, schema.add("features", T.ArrayType(T.StringType())))


def _pulls(seen: pa.Table, categories: Sequence[str], fold: np.ndarray) -> np.ndarray:
    """Per row and training set, the row's part in the gradient of a feature that it has, at the prior.

    The training sets of a category are all its rows and those of all folds but one.
    """
    out = []
    for category in categories:
        y = seen.column(category).to_numpy().astype(float)
        for held in range(-1, FOLDS):
            mine = ~np.isnan(y) & (fold != held)
            share = (np.sum(y[mine]) + 0.5) / (mine.sum() + 1)
            out.append(np.where(mine, share - np.nan_to_num(y), 0) / max(1, mine.sum()))
    return np.array(out).T


def _columns(found: DataFrame, seen: pa.Table, pulls: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The features that a model may use, and (row, feature) numbers of where they occur.

    Features are counted on the executors. Only those with a gradient above the
    penalty come to the driver, FEATURES at most, and their occurrences as numbers.
    """
    spark = found.sparkSession
    rows = pa.table({"doc_id": seen.column("doc_id"), "row": pa.array(np.arange(len(seen), dtype=np.int32)), "_pull": pa.array(pulls.tolist(), pa.list_(pa.float64()))})
    wide = found.select("doc_id", "features").join(F.broadcast(spark.createDataFrame(rows)), "doc_id")
    each = wide.select("_pull", F.explode("features").alias("feature")).groupBy("feature")
    sums = [F.sum(F.get("_pull", F.lit(i))) for i in range(pulls.shape[1])]
    strength = reduce(F.greatest, [F.abs(s) for s in sums], F.lit(0.0)).alias("strength")
    strong = each.agg(F.count(F.lit(1)).alias("n"), strength).filter((F.col("n") >= MIN_ROWS) & (F.col("strength") > L1 * (1 - 1e-9)))
    names = sorted(r.feature for r in strong.orderBy(F.desc("strength"), "feature").limit(FEATURES).select("feature").toLocalIterator())
    numbers = spark.createDataFrame(pa.table({"feature": pa.array(names, pa.string()), "col": pa.array(np.arange(len(names), dtype=np.int32))}))
    pairs = wide.select("row", F.explode("features").alias("feature")).join(F.broadcast(numbers), "feature").select("row", "col").toArrow()
    row, col = (pairs.column(c).to_numpy() for c in ("row", "col"))
    order = np.argsort(row.astype(np.int64) * max(1, len(names)) + col)
    found = names, row[order], col[order]
    del pairs, row, col, order
    pa.default_memory_pool().release_unused()
    return found


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int = SAMPLE_ROWS) -> Chain:
    """A chain over ``categories`` (columns of 0 and 1 in ``labels``), in that order.

    A null label leaves its row out of that category alone. A category with one
    class or no rows gets its prior as a constant, with the threshold at even
    odds, so an empty table of labels rejects nothing.
    """
    found = stage(sample(docs, labels, categories, rows))
    seen = found.select("doc_id", *categories).toArrow().sort_by("doc_id").combine_chunks()
    fold = np.arange(len(seen)) % FOLDS
    names, row, col = _columns(found, seen, _pulls(seen, categories, fold)) if len(seen) else ([], *np.zeros((2, 0), np.int32))
    odds = np.zeros((len(seen), 0))
    models = []
    for category in categories:
        y = seen.column(category).to_numpy().astype(float)
        told = ~np.isnan(y)

        def train(at: np.ndarray, y=y, odds=odds) -> np.ndarray:
            mine = at[row]
            start = np.concatenate([[0], np.cumsum(np.bincount(row[mine], minlength=len(at))[at])])
            return _fit(start, col[mine], odds[at], y[at], len(names))

        held = np.zeros(len(seen))
        for k in range(FOLDS):
            w = train(told & (fold != k))
            z = _summed(row, w, col, len(seen)) + odds @ w[len(names) : -1] + w[-1]
            held[fold == k] = z[fold == k]
        held = np.clip(held, -EDGE, EDGE)
        w = train(told)
        used = np.flatnonzero(w[: len(names)])
        features = {names[i]: float(w[i]) for i in used}
        earlier = tuple(w[len(names) : -1].tolist())
        models.append(Linear(float(w[-1]), features, earlier, _threshold(held[told], y[told])))
        odds = np.column_stack([odds, held])
    return Chain(tuple(categories), tuple(models))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category>..., <category>...) for every row of ``docs``.

    p is the probability, the category 1 if its log-odds are above the chain's
    threshold. A null text counts as empty; repeated rows are scored alike.
    """
    names = [f"p_{c}" for c in chain.categories] + list(chain.categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = chain.scorer()
        for b in batches:
            found = [scorer(t.as_py()) for t in b.column("text")]
            columns = [pa.array([1 / (1 + exp(-f[i])) for f in found], pa.float64()) for i in range(len(chain.models))]
            columns += [
                pa.array([int(f[i] > m.threshold) for f in found], pa.int32()) for i, m in enumerate(chain.models)
            ]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *names])

    kinds = ["double"] * len(chain.models) + ["int"] * len(chain.models)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long" + "".join(f", `{n}` {k}" for n, k in zip(names, kinds)))


def accepted(docs: DataFrame, chain: Chain, category: str) -> DataFrame:
    """``docs`` without the rows that the chain puts into ``category``.

    Every other row stays as it is: nulls, empty texts, repeated rows, all columns.
    """
    at = chain.categories.index(category)

    def rejected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = chain.scorer()
        for texts in batches:
            yield pa.array([scorer(t.as_py())[at] > chain.models[at].threshold for t in texts], pa.bool_())

    flag = fresh(docs, "_rejected")
    return docs.withColumn(flag, F.arrow_udf(rejected, "boolean")("text")).filter(~F.col(flag)).drop(flag)
