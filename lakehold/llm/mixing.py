"""Mixing sources to target weights by entropy balancing.

Each source shall give a target number of words. Of all rates between 0 and ``most`` copies per
document that meet the target, entropy balancing takes those nearest (in Kullback-Leibler
divergence) to one copy each: ``rate = min(most, exp(lambda * size))``, one multiplier per source.
The multipliers solve the convex dual. Every Newton iteration is one Spark aggregation for all
sources over a histogram (source, size, documents); a bracket keeps each step safe. The iteration's
sums are of whole numbers, so they do not depend on the order of the rows, and reruns agree.

Rates are then rounded into copies: within blocks of about 500 documents of one source, largest
first, a document's fractional copy is taken when the words owed reach half its size. The words
owed pass from document to document, and what is left at the end goes to the document whose size
fits best, so a block misses its share by a few words only. Blocks are dealt by a hash of the document, so a source with a third of all rows is as many blocks as it needs.

Defined cases. Null text has size 0; such documents get one copy and count for nothing. A source
whose target is its ceiling takes every document ``most`` times; one whose target is 0 takes only
empty documents. The null source is a source, last in order. Repeated rows are documents of their
own. Empty tables give no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehold.llm._base import fresh
from lakehold.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK = 500
NEAR = 1e-6  # of a target: where the iteration ends
EXACT = 1e6  # units per word in the sums


def words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, total_share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, size) rows -> source, n, source_size, target.

    ``total_share`` of all sizes is shared by weight; targets stop at ``most`` times their source's
    size, and the excess is shared again among the others until none is above. Each round is one
    aggregation; the level (words per unit of weight) is an exact quotient of whole numbers.
    """
    by = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.lit(None).cast("long")
    for i, w in enumerate(weights):
        weight = F.when((F.row_number().over(order) - 1) % len(weights) == i, F.lit(w).cast("long")).otherwise(weight)
    by = materialise(by.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("ceiling")), "sources")
    level, full = 0.0, F.lit(False)
    while True:
        t = by.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("ceiling"))).alias("full"),
                   F.sum(F.when(~full, F.col("weight"))).alias("open"), F.count(F.when(full, 1)).alias("n")).first()
        if not t["all"] or not t["open"]:
            break
        level = (t["all"] * total_share - (t["full"] or 0)) / t["open"]
        # once full, always full: the level only rises
        full = F.col("weight") * F.lit(level) > F.col("ceiling")
        if by.agg(F.count(F.when(full, 1))).first()[0] == t["n"]:
            break
    return by.select("source", "n", "source_size", F.least(F.col("weight") * F.lit(float(level)), F.col("ceiling").cast("double")).alias("target"))


def balance(sizes: DataFrame, aims: DataFrame, most: int = 2, iterations: int = 60) -> DataFrame:
    """``aims`` (see ``targets``) with ``multiplier``: null where every document is taken ``most`` times.

    Sizes are scaled by the mean size of a source's words; the multiplier is for scaled sizes.
    """
    cells = materialise(sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "cells")
    squares = cells.groupBy("source").agg((F.sum(F.col("docs") * F.col("size") * F.col("size").cast("decimal(38,0)")).cast("double")
                                           / F.sum(F.col("docs") * F.col("size"))).alias("scale"))
    joined = lambda a, b: a.join(b.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    open_ = (F.col("target") < most * F.col("source_size")) & (F.col("target") > 0)
    state = materialise(joined(aims, squares).select(
        "*", F.when(open_, F.lit(0.0)).alias("multiplier"), F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"),
        (~F.coalesce(open_, F.lit(False))).alias("done")), "multipliers")
    for _ in range(iterations):
        x = F.col("size") / F.col("scale")
        rate = F.least(F.exp(F.col("multiplier") * x), F.lit(float(most)))
        slope = F.when(rate < most, rate * x).otherwise(F.lit(0.0))
        units = lambda c: F.sum(F.round(F.col("docs") * F.col("size") * c * EXACT).cast("decimal(38,0)")).cast("double") / EXACT
        open_now = state.where("not done").select("source", "scale", "multiplier")
        sums = cells.join(open_now.withColumnRenamed("source", "source_"),
                          F.col("source").eqNullSafe(F.col("source_"))).groupBy("source").agg(
            units(rate).alias("got"), units(slope).alias("slope"))
        m, miss = F.col("multiplier"), F.col("got") - F.col("target")
        lo, hi = F.when(miss < 0, m).otherwise(F.col("lo")), F.when(miss >= 0, m).otherwise(F.col("hi"))
        newton = m - miss / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > lo) & (newton < hi)
        # without a bracket on one side the step doubles outwards instead of halving 10^4
        middle = F.when(hi >= 1e4, F.greatest(2 * m, m + 1)).when(lo <= -1e4, F.least(2 * m, m - 1)).otherwise((lo + hi) / 2)
        near = F.abs(miss) <= NEAR * F.col("target")
        step = F.when(near, m).when(inside, newton).otherwise(middle)
        kept = [c for c in state.columns if c not in ("multiplier", "lo", "hi", "done")]
        state = materialise(joined(state, sums).select(
            *kept, F.when(F.col("done"), m).otherwise(step).alias("multiplier"),
            F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
            (F.col("done") | near | (hi - lo < 1e-12)).alias("done")), "multipliers")
        if state.where("not done").isEmpty():
            break
    return state.select("source", "n", "source_size", "target", "scale", F.round("multiplier", 9).alias("multiplier"))


def copies(sizes: DataFrame, most: int = 2, total_share: float = 1.5) -> DataFrame:
    """(doc_id, source, size) -> those, source_size, target, rate and copies (0 to ``most``)."""
    aims = balance(sizes, targets(sizes, total_share, most), most)
    rate = (F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("target") <= 0, F.lit(0.0))
            .when(F.col("multiplier").isNull(), F.lit(float(most)))
            .otherwise(F.least(F.round(F.exp(F.col("multiplier") * F.col("size") / F.col("scale")), 9), F.lit(float(most)))))
    rated = sizes.join(aims.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).select(
        "doc_id", "source", "size", "source_size", "target", rate.alias("rate"),
        F.pmod(F.xxhash64("doc_id", "size", F.lit(7)), F.ceil(F.col("n") / BLOCK)).alias("block"))

    def round_block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("doc_id", "ascending")])
        owed, taken = 0.0, []
        for size, rate in zip(rows.column("size").to_pylist(), rows.column("rate").to_pylist(), strict=True):
            whole = int(rate)
            owed += size * (rate - whole)
            extra = whole < most and rate > whole and 2 * owed >= size
            owed -= size * extra
            taken.append(whole + extra)
        # what is still owed, in blocks of few documents: one copy more or less of the document that fits best
        copies, size = np.array(taken), np.array(rows.column("size").to_pylist())
        while len(size):
            change = np.concatenate((np.where(copies < most, size, 0), np.where(copies > 0, -size, 0)))
            best = int(np.abs(owed - change).argmin())
            if abs(owed - change[best]) >= abs(owed) - 0.5:
                break
            owed -= change[best]
            copies[best % len(size)] += 1 if best < len(size) else -1
        taken = copies.tolist()
        return rows.drop_columns("block").append_column("copies", pa.array(taken, pa.int32()))

    return rated.groupBy("source", "block").applyInArrow(
        round_block, "doc_id long, source string, size long, source_size long, target double, rate double, copies int")


def mix(docs: DataFrame, most: int = 2, total_share: float = 1.5) -> DataFrame:
    """(doc_id, text, source) -> doc_id, size, source_size, target, taken."""
    sizes = materialise(docs.select("doc_id", F.col("source").cast("string").alias("source"), words().alias("size")), "sizes")
    return copies(sizes, most, total_share).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, most: int = 2, total_share: float = 1.5) -> DataFrame:
    """The documents, all columns kept, each as often as the mix takes it.

    Rows with equal id, source and size share what was taken of them evenly.
    """
    key, row, number = (fresh(docs, c) for c in ("key", "row", "number"))
    sized = lambda df: df.select("doc_id", F.col("source").cast("string").alias("source"), words().alias("size"))
    same = F.xxhash64("doc_id", "source", "size")
    taken = copies(materialise(sized(docs), "sizes"), most, total_share).groupBy(same.alias(key)).agg(
        F.sum("copies").alias("all_copies"), F.count(F.lit(1)).alias("rows")).select(
        key, F.struct("all_copies", "rows").alias(number))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", F.col("source").cast("string"), words()))
    n = F.floor(F.col(f"{number}.all_copies") / F.col(f"{number}.rows")) + (
        F.col(row) <= F.col(f"{number}.all_copies") % F.col(f"{number}.rows")).cast("long")
    return keyed.join(taken, key).withColumn(row, F.row_number().over(Window.partitionBy(key).orderBy(key))).withColumn(
        row, F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select(*docs.columns)
