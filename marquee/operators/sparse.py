"""Products of the rows of a sparse matrix: blocks of rows against lists that tasks read in the shared folder.

The matrix is stored once, column by column, in chunks of a few megabytes without any further copy. A task forms the products of
one block of rows while it streams through the chunks, so nothing but the best of each row is shuffled. Blocks are
cut by the number of their products. The shared folder must be a store that ``pyarrow.fs`` knows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import forget, materialise, new_path, uri

PRODUCTS = 4_000_000  # products of a block of rows, 16 bytes each
LIST_CELLS = 1 << 17  # cells of a stored chunk, 12 bytes each
RANGES = 1 << 16      # ranges of rows whose products are counted
DIGITS = 9            # decimals of a sum


def ordered_codes(ids: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Stored ``ids`` with ``code``, 0.. in the order of ``column``, and their number; ids are distinct and not null."""
    spark = ids.sparkSession
    placed = materialise(
        ids.repartitionByRange(F.col(column)).sortWithinPartitions(column).withColumn("place_", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place_", 33)
    sizes = sorted(placed.groupBy(part.alias("part_")).agg(F.count("*").alias("n")).collect())  # a row per partition
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total - (p << 33)))
        total += n
    if total >= 1 << 31:
        raise ValueError(f"{total} rows do not fit 32-bit codes")
    shift = F.broadcast(spark.createDataFrame(before, "part_ long, shift_ long"))
    return placed.withColumn("part_", part).join(shift, "part_").withColumn(
        "code", (F.col("place_") + F.col("shift_")).cast("int")).drop("part_", "place_", "shift_"), total


def _pack(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """Rows (other, code, weight) sorted by ``other`` -> chunks of whole lists: starts of lists, codes, weights as bytes."""
    codes, weights, starts, held, last = [], [], [np.zeros(1, np.int64)], 0, None

    def chunk(c: np.ndarray, w: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (s, c, w)], ["starts", "codes", "weights"])

    for batch in batches:
        if not batch.num_rows:
            continue
        index = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        at = np.flatnonzero(index[1:] != index[:-1]) + 1
        if held and batch.column(0)[0].as_py() != last:
            at = np.append(0, at)
        last = batch.column(0)[-1].as_py()
        starts.append(held + at)
        codes.append(batch.column(1).to_numpy(zero_copy_only=False))
        weights.append(batch.column(2).to_numpy(zero_copy_only=False))
        held += batch.num_rows
        if held >= cells and (cut := np.concatenate(starts))[-1] > 0:
            c, w, end = np.concatenate(codes), np.concatenate(weights), cut[-1]  # the last list may go on
            yield chunk(c[:end], w[:end], cut[:-1])
            codes, weights, starts, held = [c[end:]], [w[end:]], [np.zeros(1, np.int64)], held - int(end)
    if held:
        yield chunk(np.concatenate(codes), np.concatenate(weights), np.concatenate(starts))


def store_lists(cells: DataFrame, path: str) -> None:
    """Write ``cells`` (other, code int, weight double), unique by other and code, as chunks of lists per ``other``.

    Null is a value of ``other`` like any other.
    """
    most = LIST_CELLS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pack(batches, most)

    ordered = cells.repartition(F.col("other")).sortWithinPartitions("other", "code")
    ordered.mapInArrow(pack, "starts binary, codes binary, weights binary").write.option("compression", "uncompressed").option(
        "parquet.enable.dictionary", "false").option("parquet.block.size", str(32 << 20)).parquet(path)
    forget(cells.sparkSession)


def _chunk(row: pa.RecordBatch, at: int = 0) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row.column(i)[at].as_buffer(), kind) for i, kind in zip(range(row.num_columns), (np.int64, np.int32, np.float64)))


def _read_lists(place: str) -> Iterator[tuple[np.ndarray, ...]]:
    where, path = fs.FileSystem.from_uri(place)
    for name in sorted(f.path for f in where.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet")):
        with where.open_input_file(name) as file:
            for row in pq.ParquetFile(file).iter_batches(batch_size=1, use_threads=False):
                yield _chunk(row)


def count_products(spark: SparkSession, path: str, total: int) -> tuple[list[float], int, int]:
    """Products per range of rows, the number of rows of a range, and the number of lists."""
    shift = max(0, (max(total, 1) - 1).bit_length() - RANGES.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                starts, codes = _chunk(batch, at)
                n = np.diff(np.append(starts, len(codes)))
                work = np.bincount(codes >> shift, weights=np.repeat(n, n))
                some = np.flatnonzero(work)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(some, -1)), pa.array(np.append(work[some], len(starts)).astype(np.float64))], ["part", "n"])

    sums = dict(spark.read.parquet(path).select("starts", "codes").mapInArrow(count, "part long, n double").groupBy("part").agg(F.sum("n")).collect())
    return [sums.get(i, 0.0) for i in range((max(total, 1) - 1 >> shift) + 1)], 1 << shift, int(sums.get(-1, 0))


def blocks_of(work: list[float], rows: int, total: int) -> list[tuple[int, int]]:
    """Ranges of codes with about ``PRODUCTS`` products, or one range where that has more."""
    out, first, held = [], 0, 0.0
    for i, n in enumerate(work):
        if held and held + n > PRODUCTS:
            out.append((first * rows, i * rows))
            first, held = i, 0.0
        held += n
    return out + [(first * rows, min(len(work) * rows, total))] if held else out


class _Sums:
    """Products by key, added up whenever many wait: what is held stays near the number of distinct keys."""

    def __init__(self, products: int):
        self.keys, self.values, self.held, self.limit = [], [], 0, products + products // 4

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values.append(values)
        self.held += len(keys)
        if self.held > self.limit:
            self.limit = max(self.limit, 2 * len(self.settle()[0]))

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        keys, values = np.concatenate([np.empty(0, np.int64), *self.keys]), np.concatenate([np.empty(0), *self.values])
        self.keys, self.values = [], []
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        values = np.add.reduceat(values[order], first) if len(keys) else values
        self.keys, self.values, self.held = [keys[first]], [values], len(first)
        return self.keys[0], values


def _multiply(sums: _Sums, starts: np.ndarray, codes: np.ndarray, weights: np.ndarray, low: int, high: int, total: int, most: int) -> None:
    """Add the products of the rows ``low`` .. ``high`` with all rows over the lists of one chunk, about ``most`` at a time."""
    mine = np.flatnonzero((codes >= low) & (codes < high))
    if not len(mine):
        return
    of = np.searchsorted(starts, mine, "right") - 1
    first = starts[of]
    n = np.append(starts[1:], len(codes))[of] - first
    step = np.cumsum(n) // most
    for s in range(int(step[0]), int(step[-1]) + 1):
        here = slice(*np.searchsorted(step, [s, s + 1]))
        size = n[here]
        x = np.repeat(mine[here], size)
        y = np.arange(len(x)) + np.repeat(first[here] - (np.cumsum(size) - size), size)
        apart = x != y  # a row's product with itself is left out
        x, y = x[apart], y[apart]
        sums.add((codes[x] - low).astype(np.int64) * total + codes[y], weights[x] * weights[y])


def _best(keys: np.ndarray, values: np.ndarray, low: int, total: int, k: int) -> pa.RecordBatch:
    """The ``k`` largest positive sums of each row, ties to the smaller code; keys are sorted."""
    score = np.rint(values * 10.0**DIGITS).astype(np.int64)
    keys, score = keys[score > 0], score[score > 0]
    row, code = keys // total, keys % total
    order = np.lexsort((-score, row))  # stable: codes stay in order
    row, code, score = row[order], code[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    kept = rank < k
    return pa.RecordBatch.from_arrays(
        [pa.array((row[kept] + low).astype(np.int32)), pa.array(code[kept].astype(np.int32)), pa.array(score[kept] / 10.0**DIGITS),
         pa.array((rank[kept] + 1).astype(np.int32))], ["code", "n_code", "similarity", "rank"])


def top_products(spark: SparkSession, path: str, blocks: list[tuple[int, int]], total: int, k: int) -> DataFrame:
    """For each row the ``k`` other rows with the largest positive products: code, n_code, similarity (nine decimals), rank."""
    place, most = uri(path), PRODUCTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0).to_pylist():
                low, high = blocks[b]
                sums = _Sums(most)
                for starts, codes, weights in _read_lists(place):
                    _multiply(sums, starts, codes, weights, low, high, total, most)
                yield _best(*sums.settle(), low, total, k)

    return spark.range(0, len(blocks), 1, max(1, len(blocks))).mapInArrow(run, "code int, n_code int, similarity double, rank int")
