"""Benchmark decontamination by pigeonhole edit matching.

An item may appear in a document with up to ``budget`` edits. Cut into budget + 1 pieces, one of
its pieces must then appear unchanged. All pieces of a block of items go into one automaton that
reads each document once; around every hit the item is compared with Myers' bit-parallel edit
distance, whose start is free, so the verification is exact. Case and white space are normalised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare, uri, with_text
from marquee.session import new_path

CHARS_PER_EDIT = 16
BLOCK_CHARS = 4_000_000  # characters of items that one automaton holds


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int, per_edit: int = CHARS_PER_EDIT) -> int:
    """Edits allowed in an item of so many characters: one for each ``per_edit``."""
    return length // per_edit


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 adjoining pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def best_match(mask: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any substring of ``text``, and where the first such ends."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    get = mask.get
    for at, c in enumerate(text, 1):
        eq = get(c, 0)
        vertical = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = up << 1 & full  # the first row is zero: a match may start anywhere
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    def __init__(self, items: Sequence[tuple[int, str]], per_edit: int):
        """``items``: number and normalised text, not empty."""
        self.items = [(number, text, budget(len(text), per_edit)) for number, text in items]
        self.masks = [masks(text) for _, text, _ in self.items]
        self.backward = [masks(text[::-1]) for _, text, _ in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, errors) in enumerate(self.items):
            for at, piece in pieces(text, errors):
                places.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of the best match of each item found in normalised ``text``."""
        if not self.items:  # a block may be empty
            return []
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, at in where:
                starts.setdefault(i, set()).add(end + 1 - length - at)
        found = []
        for i, begins in starts.items():
            number, item, errors = self.items[i]
            best = None
            for low, high in self.stretches(sorted(begins), errors):
                low = max(0, low - errors)
                distance, end = best_match(self.masks[i], len(item), text[low : high + len(item) + errors])
                if distance <= errors and (best is None or distance < best[0]):
                    best = (distance, low + end)
            if best:
                distance, end = best
                low = max(0, end - len(item) - errors)
                _, back = best_match(self.backward[i], len(item), text[low:end][::-1])
                found.append((number, distance, end - back, end))
        return found

    @staticmethod
    def stretches(begins: list[int], errors: int) -> Iterator[tuple[int, int]]:
        """Presumed starts that lie within the edit budget of the next are verified in one go."""
        low = high = begins[0]
        for b in begins[1:]:
            if b > high + errors:
                yield low, high
                low = b
            high = b
        yield low, high


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[str]:
    """The items, stored in blocks of about ``block_chars`` in the shared folder; tells their folders.

    Tasks read a block there. The driver sees the number of blocks only.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text IS NOT NULL AND item_id IS NOT NULL").distinct()
    count = int(items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // block_chars) + 1
    folder = new_path(benchmark.sparkSession, "items")
    placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    placed.repartition("block").write.partitionBy("block").parquet(folder)
    return [uri(f"{folder}/block={k}") for k in range(count)]


def read_block(place: str) -> list[tuple[int, str]]:
    """Numbers and normalised texts of a stored block in fixed order, without those that are empty."""
    where, path = fs.FileSystem.from_uri(place)
    if where.get_file_info(path).type == fs.FileType.NotFound:
        return []
    read = pq.read_table(path, filesystem=where, columns=["item_id", "text"], partitioning=None)
    items = ((i, normal(t)) for i, t in zip(*(c.to_pylist() for c in read.columns), strict=True))
    return sorted(x for x in items if x[1])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, carry: Sequence[str] = ("doc_id",),
    per_edit: int = CHARS_PER_EDIT, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row for each document and benchmark item found in it: the carried columns, item_id,
    distance, match_start, match_end (characters of the normalised text, end exclusive).

    An item is found if some stretch of the document is within one edit for each ``per_edit``
    characters of the item; the row tells the best such stretch, the first of ties. Null and empty
    texts match nothing, nor do items whose id or text is null or empty. Items that share an id
    are matched separately. Repeated rows give repeated results; extra columns are ignored unless
    carried; if either table is empty, so is the result. The shared folder must be a store that
    ``pyarrow.fs`` knows.
    """
    prepare(docs.sparkSession)
    source, carried = with_text(docs, carry)
    schema = f"{carried}, item_id long, distance int, match_start int, match_end int"
    found = [source.mapInArrow(_kernel(place, per_edit), schema) for place in item_blocks(benchmark, block_chars)]
    return reduce(DataFrame.unionAll, found)


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, per_edit: int = CHARS_PER_EDIT, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which ``contaminated`` finds nothing: one pass, nothing is shuffled."""
    prepare(docs.sparkSession)
    for place in item_blocks(benchmark, block_chars):
        docs = docs.mapInArrow(_filter(place, per_edit), docs.schema)
    return docs


def _filter(place: str, per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(read_block(place), per_edit)
        for batch in batches:
            clean = [not matcher.find(normal(x.as_py())) for x in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run


def _kernel(place: str, per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(read_block(place), per_edit)
        for batch in batches:
            index, rows = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                found = matcher.find(normal(text.as_py()))
                index += [i] * len(found)
                rows += found
            if rows:
                number, distance, start, end = zip(*rows, strict=True)
                kept = batch.take(pa.array(index, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:-1], pa.array(number, pa.int64()), *(pa.array(x, pa.int32()) for x in (distance, start, end))],
                    [*batch.schema.names[:-1], "item_id", "distance", "match_start", "match_end"])
    return run
