"""A training corpus from raw documents: quality, exact and near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept. Decisions are
made per stored row, so repeated ids, null ids and columns of any name pass through unharmed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, chunks, decontaminate, quality, shingles
from marquee.llm.common import free_name, numbered, table
from marquee.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; without labels to learn from all stay."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row that the exact deduplication keeps."""
    rows, row = numbered(docs, "copies")
    return _only(rows, row, chunks.exact_groups(rows, carry=(row,)).where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (Jaccard similarity of five-word shingles 0.8 or more, and what
    such links connect) the row with the smallest doc_id; null ids come last. Candidates are the groups of
    the SimHash operator and, for pairs beyond its 4 bits, min-hash cells; exact similarity decides."""
    rows, row = numbered(docs, "near")
    groups = shingles.similar_groups(rows, row)
    first = rows.select("doc_id", F.col(row).alias("at")).join(groups, F.col("at") == F.col("id_")).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at")).alias("first"))
    return _only(rows, row, first.select(F.col("first.at").alias(row)), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded and decoded again: per document its number of ids and the digests of both."""
    return bpe.token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("tokens", count_tokens),
]

# The classifier, fingerprints, edit distances and merges have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def _column(name: str) -> str:
    return f"`{name}`"


def _only(rows: DataFrame, row: str, kept: DataFrame, docs: DataFrame) -> DataFrame:
    name = free_name(rows, "kept_")
    wanted = kept.select(F.col(row).alias(name))
    return rows.join(wanted, F.col(row) == F.col(name), "left_semi").select(*map(_column, docs.columns))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
