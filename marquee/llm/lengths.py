"""Exact token length histogram: what every context limit keeps and cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import prepare
from marquee.session import materialise

SPAN = 1 << 12  # lengths of one range; ranges are summed first, so no window sees all lengths


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Rows (n_tokens) -> one row per length that occurs: n_docs. Null lengths are passed over."""
    return lengths.where("n_tokens IS NOT NULL").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def limit_report(histogram: DataFrame) -> DataFrame:
    """One row per length L of the histogram, read as a context limit.

    n_tokens (L), n_docs (documents of just that length), docs_up_to and tokens_up_to (documents
    that fit, their tokens), docs_over and tokens_over (those that do not), tokens_truncated (tokens
    left if every document is cut to L), share (part of the documents that fit, rounded to 9
    digits). Suffix sums run within ranges of lengths, shifted by the sums of the ranges above, so
    they stay exact and no task holds all lengths. An empty histogram gives an empty report.
    """
    prepare(histogram.sparkSession)
    held = materialise(histogram.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / SPAN).alias("span")), "histogram")
    spans = held.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    higher = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    shifts = spans.select(
        "span", F.coalesce(F.sum("d").over(higher), zero).alias("d_above"),
        F.coalesce(F.sum("t").over(higher), zero).alias("t_above"),
        F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    longer = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = held.join(shifts, "span").select(
        "n_tokens", "n_docs", "d_all", "t_all",
        (F.col("d_above") + F.coalesce(F.sum("n_docs").over(longer), zero)).alias("docs_over"),
        (F.col("t_above") + F.coalesce(F.sum("tokens").over(longer), zero)).alias("tokens_over"))
    return over.select(
        "n_tokens", "n_docs", (F.col("d_all") - F.col("docs_over")).alias("docs_up_to"),
        (F.col("t_all") - F.col("tokens_over")).alias("tokens_up_to"), "docs_over", "tokens_over",
        (F.col("t_all") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
        F.round((F.col("d_all") - F.col("docs_over")) / F.col("d_all"), 9).alias("share"))


def quantiles(report: DataFrame, shares: list[float]) -> DataFrame:
    """share -> the smallest length that at least so many of the documents do not exceed."""
    wanted = report.sparkSession.createDataFrame([(float(s),) for s in shares], "wanted double")
    tall = report.select("n_tokens", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("wanted"), "share")
    lengths = tall.where("share >= wanted").groupBy("wanted").agg(F.min("n_tokens").alias("n_tokens"))
    return wanted.join(lengths, "wanted", "left")
