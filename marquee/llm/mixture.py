"""Mixing sources to target weights: how often each document is taken so that every source meets its word budget.

Budgets follow the weights, but no source is taken more than ``most`` times; what it cannot take is shared out
again. Within a source whole passes come first. For the rest of the budget documents are counted by their
exact length, a share of every length is taken, and a bounded knapsack over the counts closes the gap. Which
documents of a length are taken is drawn by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free_name, prepare
from marquee.llm.ordinals import positions
from marquee.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3  # times that a source, and so a document, is taken at most
SEED = 13
WINDOW = 1 << 16  # words of taken documents that the knapsack may exchange
RANKED = 1 << 10  # documents of one length that are ranked together, on average


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, share: float = 1.0) -> DataFrame:
    """``sources`` (source, source_size) with number, weight and target.

    Sources are numbered by code point, null last, and weighted in turn. Together the targets are
    ``share`` of all sizes. A target stops at ``most`` times its source's size and the excess goes to the
    others by weight, until none is above. Only sums reach the driver, once per round.
    """
    at = positions(sources, (), (F.col("source").asc_nulls_last(),), "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    at = at.withColumn("weight", weight)
    cap = F.col("source_size") * F.lit(float(most))
    total = at.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per weight; it only rises, so a source once capped stays capped
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        capped, free = at.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        nearer = (total * share - (capped or 0.0)) / free
        if nearer <= level:
            break
        level = nearer
    return at.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> tuple[np.ndarray, int]:
    """Numbers of documents of each length whose sum lies nearest to ``budget``; of equal distance the lower.

    Bounded counts are split into powers of two. Per reachable sum the first bundle that reached it is kept,
    so the way back never uses a bundle twice. Ends as soon as the budget itself is reached.
    """
    chosen = np.zeros(len(lengths), np.int64)
    if not len(lengths) or budget <= 0:
        return chosen, 0
    top = min(2 * budget, budget + int(lengths.max()))  # sums above it are farther than none at all
    by = np.full(top + 1, -1, np.int64)
    by[0] = 0
    bundles: list[tuple[int, int]] = [(-1, 0)]
    for i in np.argsort(lengths, kind="stable").tolist():
        length = int(lengths[i])
        rest, pack = min(int(counts[i]), top // length), 1
        while rest > 0 and by[budget] < 0:
            pack = min(pack, rest)
            step = pack * length
            if step > top:
                break
            new = np.flatnonzero((by[: top + 1 - step] >= 0) & (by[step:] < 0)) + step
            by[new] = len(bundles)
            bundles.append((i, pack))
            rest, pack = rest - pack, pack * 2
    sums = np.flatnonzero(by >= 0)
    at = reached = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, pack = bundles[by[at]]
        chosen[i] += pack
        at -= pack * int(lengths[i])
    return chosen, reached


def fit(lengths: np.ndarray, counts: np.ndarray, target: float, most: int = MOST) -> tuple[int, np.ndarray]:
    """Whole passes over a source, and documents of each length taken once more, that come nearest to ``target`` words.

    The same share of every length is taken, then from the longest on one more where it fits, then what
    still fits. Last, short documents worth up to ``WINDOW`` words are given back and the knapsack spends them anew.
    """
    chosen = np.zeros(len(lengths), np.int64)
    size = int((lengths * counts).sum())
    want = min(round(target), most * size)
    if size == 0 or want <= 0:
        return 0, chosen
    passes, rest = divmod(want, size)
    if rest == 0:
        return passes, chosen
    order = np.argsort(-lengths, kind="stable")
    chosen = np.minimum(np.floor(counts * (rest / size * (1 - 1e-12))).astype(np.int64), counts)
    left = rest - int((chosen * lengths).sum())
    for once in (True, False):
        for i in order.tolist():
            length = int(lengths[i])
            if 0 < length <= left:
                more = min(int(counts[i] - chosen[i]), left // length, 1 if once else left)
                chosen[i] += more
                left -= more * length
    if left > 0:
        back = np.zeros(len(lengths), np.int64)
        given = 0
        for i in order[::-1].tolist():
            length = int(lengths[i])
            if length > 0:
                back[i] = min(int(chosen[i]), (WINDOW - given) // length)
                given += int(back[i]) * length
        small = np.flatnonzero((lengths > 0) & (lengths <= 2 * (left + given)) & (counts - chosen + back > 0))
        spent, reached = knapsack(lengths[small], (counts - chosen + back)[small], left + given)
        if abs(left + given - reached) < left:
            chosen -= back
            chosen[small] += spent
            left += given - reached
        above = np.flatnonzero(counts > chosen)
        above = above[lengths[above] > 0]
        if left > 0 and len(above):  # one document too many may be nearer than one too few
            i = above[np.argmin(lengths[above])]
            if int(lengths[i]) - left < left:
                chosen[i] += 1
    return passes, chosen


def mix(docs: DataFrame, carry: Sequence[str] = ("doc_id",), size: Column | None = None,
        weights: Sequence[float] = WEIGHTS, most: int = MOST, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: carried columns, size, source_size, target, taken.

    ``size`` is the number of words unless given. A null text has size 0; a null source is a source of its own,
    the last. Documents of size 0 are taken 0 words. A source's histogram of lengths is fitted by one task: with a total
    of n words it has at most sqrt(2 n) entries. Documents of one length are ranked in hash buckets that are
    counted first, so a length that a third of all rows share is no single group. Repeated rows tie in the draw;
    which of them is taken does not show, as they are equal. Result columns that a carried column is called like
    get a longer name. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    kept = docs.select(*carry)
    told = {}
    for stem in ("size", "source_size", "target", "taken"):
        told[stem] = free_name(kept, stem)
    source, length, draw = (free_name(kept, f"mix_{x}_") for x in ("source", "length", "draw"))
    rows = materialise(docs.select(
        *carry, F.col("source").cast("string").alias(source), (words(F.col("text")) if size is None else size.cast("long")).alias(length),
        F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in carry], "text").alias(draw)), "mix")
    lengths = rows.groupBy(F.col(source).alias("source"), F.col(length).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    lengths = materialise(lengths, "mix-lengths")
    sources = lengths.groupBy("source").agg(F.sum(F.col("length") * F.col("n")).alias("source_size"))
    sources = materialise(targets(sources, weights, most, share), "mix-sources")
    named = sources.select(F.col("source").alias("of"), "number", "source_size", "target")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        passes, chosen = fit(pdf.length.to_numpy(np.int64), pdf.n.to_numpy(np.int64), float(pdf.target.iloc[0]), most)
        return pdf[["source", "length", "n", "source_size", "target"]].assign(passes=passes, chosen=chosen)

    plan = lengths.join(named, F.col("source").eqNullSafe(F.col("of"))).groupBy("number").applyInPandas(
        fitted, "source string, length long, n long, source_size long, target double, passes long, chosen long")
    plan = materialise(plan.withColumnsRenamed({"source": "of", "length": "long"}), "mix-plan")
    here = F.col(source).eqNullSafe(F.col("of")) & (F.col(length) == F.col("long"))
    planned = rows.join(plan, here).withColumn("bucket", F.pmod(draw, (F.col("n") / RANKED).cast("long") + 1))
    whole = planned.where("chosen = 0")
    drawn = planned.where("chosen > 0")
    group = ["of", "long", "bucket"]
    counted = drawn.groupBy(*group).agg(F.count(F.lit(1)).alias("in_bucket"))
    before = Window.partitionBy("of", "long").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(F.col("of").alias("of_"), F.col("long").alias("long_"), F.col("bucket").alias("bucket_"),
                             F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("before"))
    drawn = drawn.join(counted, F.col("of").eqNullSafe(F.col("of_")) & (F.col("long") == F.col("long_")) & (F.col("bucket") == F.col("bucket_")))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(draw, *[F.col(c).cast("string") for c in carry])) + F.col("before")
    result = whole.withColumn("once", F.lit(0)).unionByName(
        drawn.withColumn("once", (rank <= F.col("chosen")).cast("int")).drop("of_", "long_", "bucket_", "before"))
    return result.select(*carry, F.col(length).alias(told["size"]), F.col("source_size").alias(told["source_size"]),
                         F.col("target").alias(told["target"]),
                         (F.col(length) * (F.col("passes") + F.col("once"))).alias(told["taken"]))
