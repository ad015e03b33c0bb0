"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import configure, new_path, uri  # noqa: F401

# Rows and bytes of one Arrow batch: texts may be long, so a batch must stay small.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: bounded Arrow batches, adaptive plans."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def with_text(docs: DataFrame, carry: Sequence[str]) -> tuple[DataFrame, str]:
    """The carried columns with the text behind them, and the carried columns as a schema."""
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema.fields)
    return docs.select(*carry, F.col("text").alias(free_name(docs, "text_"))), carried


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """A stored copy of ``docs`` with a unique row number, and the name of that column.

    The number is written with the row, so it stays the same however often the
    table is read. Its upper bits count the stored parts. Texts are most of it, so it is packed well.
    """
    name = free_name(docs, "row_number_")
    rows = docs.withColumn(name, F.monotonically_increasing_id())
    path = new_path(docs.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path), name
