"""Exact duplicates by content-defined chunk recipes. DataFrame functions only.

A text, lower-cased in A-Z, is cut where its own content says so: a chunk ends at the first
``[nrst] `` behind ``LEAST`` characters, or at ``MOST``. Every chunk gets an identifier, and the
identifiers are verified: the distinct chunk contents are brought together once, and no
identifier may name two of them. A document is then its ordered list of identifiers, and only
these lists are grouped and joined; long documents are never moved.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import free_name, prepare
from marquee.session import materialise

LEAST, MOST = 512, 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z to a-z, nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text in order; joined they give the text. The empty text has none."""
    cut = rf"(?s).{{{least - 2},{most - 2}}}?[nrst] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def digest(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def content(chunk: Column) -> Column:
    """The chunk as its own identifier: always right, but as long as the text."""
    return F.encode(chunk, "UTF-8")


def ambiguous(docs: DataFrame, identify: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that name more than one chunk content.

    Equal chunks collapse before the shuffle, so a chunk with any number of copies travels
    once per task.
    """
    pieces = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    contents = pieces.select(identify(F.col("chunk")).alias("id"), "chunk").distinct()
    return contents.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def exact_groups(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), identify: Callable[[Column], Column] = digest,
) -> DataFrame:
    """One row per row of ``docs``: the carried columns, keep_id, group_size, kept, text_sha256.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored unless carried. Texts are
    equal if they agree after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest doc_id stays; null ids come last, and of rows that repeat the largest id exactly
    one stays. An empty table gives an empty result. If ``identify`` turns out to be ambiguous,
    the chunk contents themselves serve as identifiers.
    """
    prepare(docs.sparkSession)
    if not ambiguous(docs, identify).isEmpty():
        identify = content
    row = free_name(docs, "row_")
    text = docs.select(*dict.fromkeys([*carry, "doc_id"]), normalised(F.col("text")).alias("norm_"))
    light = materialise(
        text.select(
            *[c for c in text.columns if c != "norm_"],
            F.transform(chunks(F.col("norm_")), identify).alias("recipe_"),
            F.sha2(F.col("norm_"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias(row),
        ),
        "recipes",
    )
    # Groups of two and more are stored, so that the join sees their size and can split a hot one.
    groups = materialise(
        light.groupBy(F.col("recipe_").alias("list_")).agg(
            F.count(F.lit(1)).alias("size_"), F.max(F.struct("doc_id", row)).alias("best_")).where("size_ > 1"),
        "groups")
    joined = light.join(groups, F.col("recipe_") == F.col("list_"), "left")
    grouped = F.col("size_").isNotNull()
    return joined.select(
        *[F.col(c) for c in carry],
        F.when(grouped, F.col("best_.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("size_", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col(row) == F.col(f"best_.{row}"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


OP7_SQL = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
