"""Near duplicates by the Jaccard similarity of their sets of word shingles.

Candidates are the components of the SimHash operator: each is a cell, so whatever its fingerprints link
is compared. A similarity of 0.8 is often more than its 4 bits away, so candidates also meet by min-hashes:
``BANDS`` cells per set, each of ``ROWS`` minima. Two sets of similarity
0.8 miss each other in all 32 cells with probability (1 - 0.8 ** 4) ** 32 = 5e-8, more similar ones
more rarely. Every link is then decided by the exact similarity of the two sets of 64-bit shingle hashes.

Links leave in proportion to the texts, not to their pairs. Equal sets become one. Each member of a cell is
compared with the smallest one first. Only cells that this leaves in several components are opened:
a task walks breadth first through their sets, and large cells are cut into pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marquee.llm.common import prepare
from marquee.llm.components import components
from marquee.llm.simhash import near_groups
from marquee.session import materialise

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 32, 4
SEED = 42
BLOCK, BLOCK_BYTES = 2048, 8 << 20  # sets of one block of a cell
SPOKES = 256  # sets that one task at a time compares with the smallest of their cell
SLICE = 1 << 12  # shingles hashed at a time
NO_WORDS = hashlib.blake2b(b"", digest_size=16).hexdigest()  # digest of the empty set
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_LONGS = lambda *names: StructType([StructField(n, LongType()) for n in names])


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text; one of all words if there are fewer."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    reach = min(words, len(parts)) - 1
    spans = zip(starts[: len(parts) - reach].tolist(), ends[reach:].tolist(), strict=True)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(parts) - reach))


def bands(hashes: np.ndarray) -> list[int]:
    """The cells of a set, one for each band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        mixed = hashes[at : at + SLICE, None] * _FACTORS
        mixed ^= mixed >> np.uint64(29)
        mixed *= _FACTORS[::-1]
        np.minimum(least, mixed.min(0), out=least)
    return [xxhash.xxh64_intdigest(b.tobytes(), i) - (1 << 63) for i, b in enumerate(least.reshape(BANDS, ROWS))]


def _signed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(x.as_py(), words) for x in batch.column(1)]
        digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(map(bands, sets), pa.list_(pa.int64()))],
            ["id_", "digest", "cells"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(x.as_py(), words).tobytes() for x in batch.column(1)]
        sizes = pa.array(map(len, sets), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(sets, pa.binary())], ["id_", "size", "set_"])


def similarities(here: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of a set that is not empty to each of some others."""
    sizes = np.array([len(x) for x in sets])
    every = np.concatenate(sets)
    found = here[np.minimum(np.searchsorted(here, every), len(here) - 1)] == every
    shared = np.add.reduceat(np.append(found, False).astype(np.int64), np.cumsum(sizes) - sizes)
    return shared / (len(here) + sizes - shared)


def forest(members: list[tuple[int, np.ndarray]], least: float) -> list[tuple[int, int]]:
    """Links that connect what is connected among sets by steps of at least that similarity."""
    links, rest = [], members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest:
            name, here = queue.pop()
            near = similarities(here, [x for _, x in rest]) >= least
            if near.any():
                found = [x for x, y in zip(rest, near, strict=True) if y]
                rest = [x for x, y in zip(rest, near, strict=True) if not y]
                links.extend((name, x) for x, _ in found)
                queue.extend(found)
    return links


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])


def _compared(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, set of a, set of b): the pairs that are similar enough."""
    for batch in batches:
        a, b, left, right = batch.columns
        links = []
        for x, y, s, t in zip(a.to_pylist(), b.to_pylist(), left, right, strict=True):
            one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (s, t))
            if similarities(one, [other])[0] >= least:
                links.append((x, y))
        yield _batch(links)


def _links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, i, j): links within each group, one group in memory at a time."""
    held, key = [], None
    for batch in batches:
        links = []
        for cell, i, j, name, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (cell, i, j) != key:
                links += forest(held, least)
                held, key = [], (cell, i, j)
            held.append((name, np.frombuffer(one, np.uint64)))
        yield _batch(links)
    yield _batch(forest(held, least))


def similar_links(
    members: DataFrame, sets: DataFrame, least: float, block: int, block_bytes: int,
) -> DataFrame:
    """Members (cell, id_) and their sets (id_, size, set_) -> links (a, b) whose components are those of all similar pairs that share a cell."""
    firsts = members.groupBy("cell").agg(F.min("id_").alias("b"))
    pairs = materialise(members.join(firsts, "cell").where("id_ > b").select(F.col("id_").alias("a"), "b").distinct(), "pairs")
    # A first member may serve many: it is dealt to as many parts as its pairs need.
    dealt = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SPOKES).alias("parts"))
    part = F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")
    hubs = dealt.join(sets, F.col("b") == F.col("id_")).select(
        F.col("b").alias("hub"), F.col("set_").alias("right"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("spoke"))
    spokes = pairs.join(dealt, "b").select("a", "b", part).join(sets, F.col("a") == F.col("id_")).select("a", "b", "part", F.col("set_").alias("left"))
    met = spokes.join(hubs, (F.col("b") == F.col("hub")) & (F.col("part") == F.col("spoke"))).select("a", "b", "left", "right")
    linked = materialise(met.mapInArrow(partial(_compared, least=least), _LONGS("a", "b")), "links")

    roots = materialise(components(linked).select(F.col("node"), F.col("root")), "roots")
    labelled = members.join(roots, F.col("id_") == F.col("node"), "left").select("cell", "id_", F.coalesce("root", "id_").alias("root"))
    sized = labelled.join(sets.select(F.col("id_").alias("s_"), "size"), F.col("id_") == F.col("s_"))
    # Two members have been compared. Cells of the same members are opened once.
    split = sized.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("id_")).alias("x1"), F.bit_xor(F.xxhash64("id_", F.lit(1))).alias("x2"),
    ).where("n > 2 AND low < high")
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("bytes") / block_bytes)).alias("blocks")
    opened = materialise(split.groupBy("n", "bytes", "x1", "x2").agg(F.min("cell").alias("cell")).select("cell", blocks), "opened")
    left = members.join(opened, "cell").select(
        "cell", "id_", F.pmod(F.xxhash64("id_"), "blocks").alias("at"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    groups = left.join(sets.select("id_", "set_"), "id_").select("cell", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"), "id_", "set_")
    walked = groups.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return linked.unionAll(walked.mapInArrow(partial(_links, least=least), _LONGS("a", "b")))


def similar_groups(
    docs: DataFrame, key: str, words: int = WORDS, least: float = LEAST, block: int = BLOCK, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id_, root) for each row of ``docs``: its ``key``, a unique long, and the key of one row of its component.

    Candidates are the rows that ``near_groups`` groups by their fingerprints, and those that share a min-hash cell.
    Rows are linked whose sets of shingles of ``words`` words have a Jaccard similarity of ``least`` or more;
    case A-Z and the kind of ASCII white space do not matter. Texts without words (null, empty, white
    space) are equal to each other and similar to no other. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(key).alias("id_"), F.col("text").alias("text_"))
    signed = materialise(texts.mapInArrow(partial(_signed, words=words), "id_ long, digest binary, cells array<long>"), "signatures")
    same = materialise(signed.groupBy("digest").agg(F.min("id_").alias("first"), F.first("cells").alias("cells")), "sets")
    firsts = materialise(
        signed.select("id_", "digest").join(same.select(F.col("digest").alias("d_"), "first"), F.col("digest") == F.col("d_"))
        .select("id_", "first", (F.col("digest") == F.unhex(F.lit(NO_WORDS))).alias("wordless")), "firsts")
    # A set enters the components of all its rows: fingerprints count repeats, sets do not.
    printed = near_groups(texts.select(F.col("id_").alias("doc_id"), F.col("text_").alias("text")))
    close = firsts.where("NOT wordless").join(printed.select("doc_id", "component_id"), F.col("id_") == F.col("doc_id"))
    grouped = materialise(close.select(F.col("first").alias("id_"), F.col("component_id").alias("cell")).distinct(), "grouped")
    placed = same.select(F.col("first").alias("id_"), F.explode("cells").alias("cell")).unionAll(grouped)
    shared = materialise(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell"), "cells")
    members = materialise(placed.join(shared, "cell").select("cell", "id_"), "members")
    wanted = materialise(members.select(F.col("id_").alias("w_")).distinct(), "wanted")
    chosen = texts.join(wanted, F.col("id_") == F.col("w_"), "left_semi")
    sets = materialise(chosen.mapInArrow(partial(_sets, words=words), "id_ long, size long, set_ binary"), "shingles")
    roots = components(similar_links(members, sets, least, block, block_bytes))
    return firsts.join(roots, F.col("first") == F.col("node"), "left").select("id_", F.coalesce("root", "first").alias("root"))
