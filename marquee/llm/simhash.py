"""Near duplicates by SimHash, found with a segment-popcount embedding.

A fingerprint of 64 bits becomes 32 counts: the set bits of each segment of two bits. The
Manhattan distance of two such vectors never exceeds the Hamming distance of the fingerprints.
The segments are dealt to three bands. If two fingerprints differ in at most four bits, some two
bands together hold at most two of the differences, so on their segments the vectors are within
Manhattan distance two, and then some grid point lies within one step of both. Every fingerprint
therefore enters its own grid cell and those one step away, for each choice of two bands, and
fingerprints that meet in a cell are compared exactly. Nothing linked is missed.

A cell never emits its pairs. A task walks breadth first from fingerprint to fingerprint and
takes every one it reaches out of the rest, so at most one link per fingerprint leaves a cell and
a dense cell costs little more than one pass. Cells above ``BLOCK`` are cut into pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marquee.llm.common import prepare, with_text
from marquee.llm.components import components
from marquee.session import materialise

WORDS, SEED, RADIUS = 4, 42, 4
BLOCK = 4096
PLACED = 1 << 15  # fingerprints whose cells one task lists
SLICE = 1 << 15  # shingles hashed at a time, so that a very long text needs little memory


def fingerprint(text: str | None) -> int:
    """64-bit fingerprint of the word shingles of a text; 0 if it has no words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    reach = min(WORDS, len(words)) - 1
    starts, ends = starts[: len(words) - reach], ends[reach:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SLICE):
        spans = zip(starts[at : at + SLICE].tolist(), ends[at : at + SLICE].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(x.as_py()) for x in batch.column(batch.num_columns - 1)), np.uint64, len(batch))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))],
                                         [*batch.schema.names[:-1], "print_"])


def popcounts(prints: np.ndarray) -> np.ndarray:
    """The counts of the 32 segments, two bits each, packed into one word."""
    return prints - ((prints >> np.uint64(1)) & np.uint64(0x5555555555555555))


def cells(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cell, index of the fingerprint): own cell and neighbours one step away, for each two bands."""
    counts, index = popcounts(prints), np.arange(len(prints))
    for left_out in range(3):
        kept = [s for s in range(32) if s % 3 != left_out]
        base = counts & np.uint64(sum(3 << 2 * s for s in kept))
        base |= np.uint64(3 << 2 * left_out)  # 3 is no count: it names the choice of bands
        yield base, index
        for s in kept:
            count, one = (base >> np.uint64(2 * s)) & np.uint64(3), np.uint64(1 << 2 * s)
            for fits, cell in ((count < 2, base + one), (count > 0, base - one)):
                yield cell[fits], index[fits]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for cell, index in cells(prints.view(np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(prints[index])], ["cell", "print_"])


def forest(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what is connected among ``prints`` by steps of at most ``radius`` bits."""
    links, rest = [], prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            found = rest[near]
            if len(found):
                rest = rest[~near]
                links.extend((int(here), int(x)) for x in found)
                queue.extend(found)
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, i, j): links within each group, one group in memory at a time."""
    def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
        ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    held, key = [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3)], 1)
        prints = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        links = []
        for rows, at in zip(np.split(prints, cuts), [0, *cuts.tolist()], strict=True):
            if not len(rows):
                continue
            if key is not None and tuple(keys[at]) != key:
                links += forest(np.concatenate(held))
                held = []
            key = tuple(keys[at])
            held.append(rows)
        if links:
            yield out(links)
    if held and (links := forest(np.concatenate(held))):
        yield out(links)


def near_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (print_) -> links (a, b) whose components are those of all close pairs."""
    long = lambda *names: StructType([StructField(n, LongType()) for n in names])
    # A fingerprint is few bytes but enters about a hundred cells, so rows, not bytes, set the number of tasks.
    parts = max(1, -(-prints.count() // PLACED))
    placed = prints.repartition(parts, "print_").mapInArrow(_cells, long("cell", "print_"))
    # Stored, so that the join sees how small it is and can split a hot cell.
    shared = materialise(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cells")
    blocks = F.ceil(F.col("n") / block)
    # A merge join at every size: work and shuffle then grow in proportion to the fingerprints.
    met = placed.join(shared.hint("merge"), "cell").select(
        "cell", "print_", F.pmod(F.xxhash64("print_"), blocks).alias("at"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("with"))
    pairs = met.select("cell", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"), "print_")
    dealt = pairs.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return dealt.mapInArrow(_links, long("a", "b"))


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_groups(docs: DataFrame, carry: Sequence[str] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: the carried columns, fingerprint, component_id, component_root.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored unless carried. Texts without
    words (null, empty, white space) have fingerprint zero and link like any other. component_id is
    the smallest doc_id reachable by links; null ids are passed over, and it is null if a component
    has no other; component_root, a fingerprint of the component, tells components apart even then. Rows that repeat an id or a text are kept. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    names = list(dict.fromkeys([*carry, "doc_id"]))
    source, carried = with_text(docs, names)
    prints = materialise(source.mapInArrow(_fingerprints, f"{carried}, print_ long"), "fingerprints")
    distinct = materialise(prints.groupBy("print_").agg(F.min("doc_id").alias("least_")), "prints")
    roots = components(near_links(distinct.select("print_"), block))
    labelled = distinct.join(roots, F.col("print_") == F.col("node"), "left").select(
        "print_", "least_", F.coalesce("root", "print_").alias("root_"))
    labelled = materialise(labelled, "labelled")
    least = labelled.groupBy("root_").agg(F.min("least_").alias("component_id"))
    classes = labelled.join(least, "root_").select(
        F.col("print_").alias("p_"), F.col("root_").alias("r_"), "component_id")
    return prints.join(classes, F.col("print_") == F.col("p_")).select(
        *[F.col(c) for c in carry], _hex("print_").alias("fingerprint"), "component_id", _hex("r_").alias("component_root"))
