"""The registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, bursttrie, chunks, decontaminate, hardneg, langid, lengths, mixture, private, quality, repeats, simhash, warc
from marquee.llm.common import table


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.personal_data(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive, folder = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.lookup(archive, folder, archive.captures).drop("url")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.exact_groups(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.limit_report(lengths.length_histogram(bpe.token_lengths(table(spark, sf_dir, "documents"))))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursttrie.trie(table(spark, sf_dir, "conversations"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1,
    "op2_pii": op2,
    "op3_language_id": op3,
    "op4_quality": op4,
    "op5_decontaminate": op5,
    "op6_warc": op6,
    "op7_exact_dedup": op7,
    "op8_token_lengths": op8,
    "op9_bpe": op9,
    "op10_substring_dedup": op10,
    "op11_hard_negatives": op11,
    "op12_prefix_trie": op12,
    "op13_mixture": op13,
}

ORACLES: dict[str, str] = {
    "op6_warc": warc.OP6_SQL,
    "op7_exact_dedup": chunks.OP7_SQL,
    "op10_substring_dedup": repeats.OP10_SQL,
}
