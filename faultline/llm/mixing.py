"""Mixing sources to target weights by entropy balancing.

Rates, the expected copies of each document, should stay as close to one as the
token totals allow. With the Kullback-Leibler divergence weighed by tokens, the
closest rates are exponential tilts, exp of one dual variable for each constraint a
document is part of, and the dual is convex. It is solved by Newton steps that Spark
computes: a margin's constraints don't share documents, so its part of the Hessian
is diagonal, and margins take turns. Only one number per step, the largest residual,
reaches the driver. Documents enter as cells of equal margins, summed beforehand.

Rates are then rounded into whole copies: cells of one size are visited from the
largest size down, and each takes the number of copies that brings its source's
running total nearest to the exact one, so what is left in the end is about the
size of the source's smallest document.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, positions, stage, text_hash

#: A document is taken this often at most.
CAP = 3
#: Newton steps end at this relative residual, or after so many sweeps over the margins.
CLOSE, SWEEPS = 1e-10, 200
#: Rows of one source and size that are ranked in one group.
RANKED_ROWS = 1000


def words(text: str = "text") -> Column:
    """Number of words as cut by space and \\t to \\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _total(rate: Column, part: Column | None = None) -> Column:
    value = F.col("tokens") * rate
    return F.sum(value if part is None else F.when(part, value).otherwise(0.0))


def balance(cells: DataFrame, targets: Mapping[str, DataFrame], cap: float = CAP) -> DataFrame:
    """``cells`` (margin columns, tokens) with a column ``rate``.

    ``targets`` gives, by margin column, a frame of (that column, target): the
    tokens that the rows of each value should sum to once multiplied by their
    rate. Rates lie in (0, cap]. A value without tokens or without a positive
    target keeps a tilt of one. Targets that contradict each other are met as
    well as the last sweep left them.
    """
    duals = {c: f"_dual_{i}" for i, c in enumerate(targets)}
    state = stage(cells.select("*", *(F.lit(0.0).alias(d) for d in duals.values())))
    tilt = sum((F.col(d) for d in duals.values()), F.lit(0.0))
    rate = F.least(F.exp(tilt), F.lit(float(cap)))
    for _ in range(SWEEPS):
        worst = 0.0
        for column, dual in duals.items():
            sums = state.groupBy(column).agg(
                _total(rate).alias("_now"), _total(rate, F.exp(tilt) < cap).alias("_slope")
            )
            wanted = targets[column].withColumnRenamed(column, "_value")
            sums = sums.join(wanted, F.col(column).eqNullSafe(F.col("_value")))
            sums = sums.filter("_now > 0 and target > 0").withColumn("_gap", F.col("target") - F.col("_now"))
            newton = F.when(F.col("_slope") > 0, F.col("_gap") / F.col("_slope")).otherwise(F.signum("_gap") / 2)
            sums = sums.select(
                "_value",
                F.greatest(F.lit(-1.0), F.least(F.lit(1.0), newton)).alias("_step"),
                (F.abs("_gap") / F.col("target")).alias("_residual"),
            )
            moved = state.join(sums, F.col(column).eqNullSafe(F.col("_value")), "left")
            moved = moved.withColumn(dual, F.col(dual) + F.coalesce("_step", F.lit(0.0)))
            moved = stage(moved.drop("_value", "_step"))
            worst = max(worst, moved.agg(F.max("_residual")).first()[0] or 0.0)
            state = moved.drop("_residual")
        if worst < CLOSE:
            break
    return state.withColumn("rate", rate).drop(*duals.values())


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, tokens) with its target.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share
    the sum of all tokens by weight; none gets more than CAP times its own, and
    what is above is shared again. The level w * x that this comes to is raised
    until no further source stops; each round sums over all sources in Spark.
    """
    ranked = positions(sources, F.asc_nulls_last("source"))
    weighed = stage(ranked.withColumn("weight", (F.col("position") % 3 + 1).cast("double")).drop("position"))
    cap = F.col("tokens") * float(CAP)
    level, stopped = 0.0, -1
    while True:
        above = (F.col("weight") * level > cap) if stopped >= 0 else F.lit(False)
        full, free, weight, count = weighed.agg(
            F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum("tokens").cast("double"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.sum(above.cast("long")),
        ).first()
        if not weight or count == stopped:
            break
        stopped, level = count, (free - full) / weight
    return weighed.withColumn("target", F.least(F.col("weight") * level, cap))


def _round_cells(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies for the cells of one source: distinct sizes with their number of documents."""
    pdf = pdf.sort_values("size", ascending=False, kind="stable")
    due, took, out = 0.0, 0, []
    for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
        due += size * n * rate
        least, most = n * int(np.floor(rate)), n * min(CAP, int(np.ceil(rate)))
        copies = min(most, max(least, round((due - took) / size))) if size else round(n * rate)
        took += copies * size
        out.append(copies)
    return pdf[["source", "size", "n", "tokens", "target", "rate"]].assign(copies=np.array(out, np.int64))


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, source, size, source_size, target, rate, copies, taken.

    ``taken`` is copies * size. Defined cases: a null text has size 0 and takes no
    words; a null source is one source, the last; a null doc_id and repeated rows
    are rows like others; if all texts are empty, all targets are 0. Which
    documents of a source and size get the odd copy depends on a hash of id and
    text, so reruns agree whatever the partitions.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "source", words().alias("size")
    )
    rows = stage(rows)
    sizes = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"))
    wanted = stage(targets(sources))
    rates = balance(wanted.select("source", "tokens"), {"source": wanted.select("source", "target")})
    known = wanted.drop("weight").join(
        rates.select(F.col("source").alias("_source"), "rate"), F.col("source").eqNullSafe(F.col("_source"))
    )
    known = known.select(F.col("source").alias("_source"), "tokens", "target", "rate")
    cells = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    cells = stage(
        cells.groupBy("source").applyInPandas(
            _round_cells,
            "source string, size long, n long, tokens long, target double, rate double, copies long",
        )
    )
    return _deal(rows, cells)


def _deal(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Each cell's copies dealt to its rows: equal shares, and one more to the first of them by hash.

    A row's place in its cell is its place in a bucket of the cell plus the rows of
    the buckets before, so that no group of rows grows with the cell.
    """
    mine = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    each = cells.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "copies")
    each = each.select("*", F.ceil(F.col("n") / RANKED_ROWS).alias("_buckets"))
    place = F.xxhash64("doc_id", "text_hash")
    dealt = rows.join(each, mine).withColumn("_place", place).withColumn("bucket", F.pmod("_place", "_buckets"))
    dealt = stage(dealt.drop("_source", "_size", "_buckets"))
    cell = ["source", "size"]
    before = Window.partitionBy(*cell).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*cell, "bucket").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    starts = starts.withColumnsRenamed({"source": "_source", "size": "_size", "bucket": "_bucket"})
    inside = Window.partitionBy(*cell, "bucket").orderBy("_place", "doc_id", "text_hash")
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(starts, mine & (F.col("bucket") == F.col("_bucket"))).drop("_source", "_size", "_bucket")
    share = F.expr("copies div n") + (F.col("_start") + F.col("_rank") < F.col("copies") % F.col("n")).cast("long")
    ranked = ranked.select("doc_id", "text_hash", "source", "size", share.alias("copies"))
    about = cells.groupBy("source").agg(*(F.max(c).alias(c) for c in ("tokens", "target", "rate")))
    about = about.withColumnRenamed("source", "_source")
    ranked = ranked.join(about, F.col("source").eqNullSafe(F.col("_source")))
    return ranked.select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        F.col("tokens").alias("source_size"),
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns as they are."""
    names = ["_hash", "_nth", "_copies", "_k_id", "_k_hash", "_k_source", "_k_nth"]
    hash_, nth, copies, *key = (fresh(docs, n) for n in names)
    same = Window.partitionBy("doc_id", "text_hash", "source").orderBy("copies")
    plan = mix(docs).withColumn("nth", F.row_number().over(same)).filter("copies > 0")
    plan = plan.select(*(F.col(c).alias(k) for c, k in zip(("doc_id", "text_hash", "source", "nth"), key)), F.col("copies").alias(copies))
    same = Window.partitionBy(F.col("doc_id").cast("long"), hash_, "source").orderBy(hash_)
    rows = docs.withColumn(hash_, text_hash()).withColumn(nth, F.row_number().over(same))
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(key[0])) & F.col("source").eqNullSafe(F.col(key[2]))
    mine = mine & (F.col(hash_) == F.col(key[1])) & (F.col(nth) == F.col(key[3]))
    rows = rows.join(plan, mine).drop(hash_, nth, *key)
    return rows.withColumn(copies, F.explode(F.sequence(F.lit(1), copies))).drop(copies)
