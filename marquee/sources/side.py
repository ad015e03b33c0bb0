"""The side table: numbers gathered per item from elsewhere, as text with gaps.

The raw form keeps every field as text, as a gathered file has it. ``parse`` applies the schema
contract: each field becomes a number, a gap (null) or a malformed field (null, counted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = ("item_id",)
TEXT = ("title", "kind", "note")  # columns 2, 3 and 6 of the table are no numbers
NUMBERS = ("votes", "score", "critic_score", "budget", "gross")
COLUMNS = ("item_id", "title", "kind", "votes", "score", "note", "critic_score", "budget", "gross")
GAPS = ("", "NA", "-")  # spellings of a missing field

# Column -> SQL over part; valid in Spark SQL and DuckDB alike (see FIXTURES.md for the item columns).
RAW = {
    "item_id": "p_partkey",
    "title": "p_name",
    "kind": "p_type",
    "votes": (
        "CASE WHEN p_partkey % 17 = 0 THEN 'NA' WHEN p_partkey % 41 = 0 THEN concat(CAST(p_partkey AS STRING), ' votes') "
        "ELSE CAST((p_partkey * 37) % 5003 AS STRING) END"
    ),
    "score": "CASE WHEN p_partkey % 19 = 0 THEN '' ELSE concat(' ', CAST((p_partkey * 7) % 10 AS STRING), '.5 ') END",
    "note": "CASE WHEN p_partkey % 3 = 0 THEN concat('see ', p_brand) END",
    "critic_score": "CASE WHEN p_partkey % 13 <> 0 THEN CAST((p_partkey * 7) % 10 * 10 + p_partkey % 5 AS STRING) END",
    "budget": "CASE WHEN p_partkey % 7 = 0 THEN '-' WHEN p_partkey % 43 = 0 THEN '1,5' ELSE CAST(p_size * 1000 AS STRING) END",
    "gross": "CASE WHEN p_partkey % 11 = 0 THEN 'NA' ELSE CAST(p_size * 1500 + p_partkey % 700 AS STRING) END",
}


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(*[F.expr(RAW[c]).alias(c) for c in COLUMNS])


def field(name: str) -> Column:
    """The field without blanks around it, null for a gap."""
    text = F.trim(name)
    return F.when(~text.isin(*GAPS), text)


def number(name: str) -> Column:
    """The field as a number; null for a gap and for a malformed field. Only plain decimals count, so no ``NaN`` or ``1e5``."""
    return F.when(field(name).rlike(r"^-?[0-9]+(\.[0-9]+)?$"), field(name).cast("double"))


def parse(raw: DataFrame) -> DataFrame:
    """All columns in order, those of ``NUMBERS`` as doubles."""
    return raw.select(*[number(c).alias(c) if c in NUMBERS else F.col(c) for c in COLUMNS])


def field_report(raw: DataFrame) -> DataFrame:
    """Per number column: rows, gaps and malformed fields. One aggregate of the table."""
    one = raw.agg(F.count("*").alias("n"), *[x for c in NUMBERS for x in (
        F.count_if(field(c).isNull()).alias(f"{c}_gaps"),
        F.count_if(field(c).isNotNull() & number(c).isNull()).alias(f"{c}_malformed"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n"), F.col(f"{c}_gaps").alias("gaps"),
                              F.col(f"{c}_malformed").alias("malformed")) for c in NUMBERS])
    return one.select(F.inline(rows))
