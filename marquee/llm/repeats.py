"""Long repeated word spans, by compacting the repeated part of a de Bruijn graph.

A window is ``WINDOW`` consecutive words. The graph has the k-mers of all texts as its edges;
which of them repeat is what matters, and most do not, so edges are thinned first:

1. Of the k-mers in a window the one with the smallest hash is the window's anchor. Equal windows
   have equal anchors, so a window can only repeat if its anchor does. About one k-mer in fifteen
   is an anchor, and only anchors are shuffled.
2. The consecutive windows that share a repeated anchor form a path. Each path becomes one row with
   the digest of its whole text, read at its source coordinates. Paths of equal digest are the same
   nonbranching path; if there are two, all their windows repeat.
3. Where one anchor has several different paths (the ends of a shared passage), one path of each
   kind is opened at its source coordinates, and the digests of its single windows are joined.

Texts are stored once with a row number and never shuffled: the tables made on the way are laid out
by stored part, and the task that scans a part reads its own rows of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import free_name, numbered, prepare, uri
from marquee.session import materialise, new_path

WINDOW, KMER = 35, 8
PART_BITS = 33  # monotonically_increasing_id counts the rows of a part in its lower bits


class Text:
    """The words of a text, and of a text with a window its anchors."""

    def __init__(self, text: str | None, window: int, kmer: int):
        self.words = (text or "").encode().split()  # bytes: only ASCII white space separates
        self.window, self.kmer = window, kmer

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor's position for each window, and the hash of the k-mer at each position."""
        count = len(self.words) - self.window + 1
        if count <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        hashes = np.array(list(map(xxhash.xxh3_64_intdigest, self.words)), np.uint64)
        grams = np.zeros(len(hashes) - self.kmer + 1, np.uint64)
        for j in range(self.kmer):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(grams)]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        span, at, width = self.window - self.kmer + 1, np.arange(len(grams)), 1
        while width < span:  # the smallest of runs that double; the first one of equal hashes
            step = min(width, span - width)
            left, right = at[:-step], at[step:]
            at, width = np.where(grams[right] < grams[left], right, left), width + step
        return at, grams

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Words joined by one space, and where each starts and ends."""
        ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1) - 1
        return b" ".join(self.words), np.concatenate(([0], ends[:-1] + 1)), ends


def _mapped(docs: DataFrame, row: str, read: str | None, kernel, schema: str) -> DataFrame:
    """Scan row and text; give ``kernel`` each row number, text and its own rows of the table ``read``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(rows):
                continue
            side = side_rows(read, rows) if read else None
            yield from kernel(rows, batch.column(1), side)
    return docs.select(row, "text").mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _part(uri: str, part: int):
    where, path = fs.FileSystem.from_uri(f"{uri}/part={part}")
    if where.get_file_info(path).type != fs.FileType.Directory:
        return None
    return ds.dataset(path, filesystem=where, format="parquet")


def side_rows(uri: str, rows: np.ndarray) -> dict[int, list[dict]]:
    """From a table laid out by part and sorted by row: what belongs to ``rows``, by row number."""
    found: dict[int, list[dict]] = {}
    low = int(rows.min())
    for part in sorted({int(p) for p in np.unique(rows >> PART_BITS)}):
        if (data := _part(uri, part)) is not None:
            inside = (ds.field("row") >= low) & (ds.field("row") <= int(rows.max()))
            for x in data.to_table(filter=inside).to_pylist():
                found.setdefault(x["row"], []).append(x)
    return found


def by_part(table: DataFrame, label: str) -> str:
    """Store ``table`` (with a column row) for ``side_rows``; its folder as a URI."""
    path = new_path(table.sparkSession, label)
    laid = table.withColumn("part", F.shiftright("row", PART_BITS))
    laid.repartitionByRange("part", "row").sortWithinPartitions("part", "row").write.partitionBy("part").parquet(path)
    return uri(path)


def _batch(names: Sequence[str], columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], list(names))


def _anchor_kernel(window: int, kmer: int):
    def kernel(rows, texts, _):
        keys, owners = [], []
        for row, text in zip(rows.tolist(), texts, strict=True):
            at, grams = Text(text.as_py(), window, kmer).anchors()
            own = np.unique(at)
            keys.append(grams[own])
            owners.append(np.full(len(own), row))
        if keys:
            yield _batch(("row", "key"), (np.concatenate(owners), np.concatenate(keys).view(np.int64)))
    return kernel


def _path_kernel(window: int, kmer: int):
    def kernel(rows, texts, side):
        out = []
        for row, text in zip(rows.tolist(), texts, strict=True):
            if row not in side:
                continue
            words = Text(text.as_py(), window, kmer)
            at, grams = words.anchors()
            joined, starts, ends = words.joined()
            wanted = np.array([x["key"] for x in side[row]], np.int64).view(np.uint64)
            own = np.unique(at)
            for p in own[np.isin(grams[own], wanted)].tolist():
                a, b = int(np.searchsorted(at, p)), int(np.searchsorted(at, p, "right"))
                text_of = joined[starts[a] : ends[b + window - 2]]
                out.append((row, a, b - a, int(grams[p]), xxhash.xxh3_64_intdigest(text_of)))
        if out:
            row, first, count, key, path = zip(*out, strict=True)
            as_long = lambda x: np.array(x, np.uint64).view(np.int64)
            yield _batch(("row", "first", "count", "key", "path"), (
                np.array(row, np.int64), np.array(first, np.int32), np.array(count, np.int32), as_long(key), as_long(path)))
    return kernel


def _window_kernel(window: int):
    def kernel(rows, texts, side):
        out = []
        for row, text in zip(rows.tolist(), texts, strict=True):
            if row not in side:
                continue
            joined, starts, ends = Text(text.as_py(), window, 1).joined()
            for x in side[row]:
                for j in range(x["count"]):
                    s = x["first"] + j
                    out.append((x["key"], x["path"], j, xxhash.xxh3_64_intdigest(joined[starts[s] : ends[s + window - 1]])))
        if out:
            key, path, offset, digest = zip(*out, strict=True)
            yield _batch(("key", "path", "offset", "window"), (
                np.array(key, np.int64), np.array(path, np.int64), np.array(offset, np.int32),
                np.array(digest, np.uint64).view(np.int64)))
    return kernel


def _span_kernel(window: int):
    def kernel(rows, texts, side):
        spans, words_of, removed_of, kept_of = [], [], [], []
        for row, text in zip(rows.tolist(), texts, strict=True):
            words = (text.as_py() or "").encode().split()
            edge = np.zeros(len(words) + 1, np.int64)
            for x in side.get(row, ()):
                own = np.asarray(x["offsets"], np.int64) + x["first"]
                np.add.at(edge, own, 1)
                np.add.at(edge, own + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            bounds = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
            spans.append([{"start": int(a), "end": int(b)} for a, b in bounds])
            words_of.append(len(words))
            removed_of.append(int(gone.sum()))
            kept = words if not len(bounds) else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept_of.append(sha256(b" ".join(kept)).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield _batch(("row", "spans", "n_words", "n_removed", "kept_sha256"), (
            rows, pa.array(spans, kind), pa.array(words_of, pa.int64()), pa.array(removed_of, pa.int64()), kept_of))
    return kernel


def repeated_paths(docs: DataFrame, row: str, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Numbered docs -> (row, first, offsets): windows first + offset repeat somewhere else."""
    anchors = materialise(
        _mapped(docs, row, None, _anchor_kernel(window, kmer), "row long, key long"), "anchors")
    # Stored, so that the join sees its size and can split a hot anchor.
    shared = materialise(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared")
    marked = by_part(anchors.join(shared, "key", "left_semi").distinct(), "marked")
    paths = materialise(_mapped(docs, row, marked, _path_kernel(window, kmer),
                                "row long, first int, count int, key long, path long"), "paths")
    kinds = paths.groupBy("key", "path").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "count")).alias("source"))
    kinds = materialise(kinds, "kinds")
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    opened = kinds.join(several, "key", "left_semi").select(
        "source.row", "source.first", "source.count", "key", "path")
    windows = materialise(_mapped(docs, row, by_part(opened, "opened"), _window_kernel(window),
                                  "key long, path long, offset int, window long"), "windows")
    twice = windows.groupBy("key", "window").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    partly = windows.join(twice, ["key", "window"], "left_semi").groupBy("key", "path").agg(
        F.sort_array(F.collect_set("offset")).alias("some"))  # at most as many as a path has windows
    told = kinds.where("n > 1").select("key", "path", F.lit(None).cast("array<int>").alias("some")).unionAll(
        partly.join(kinds.where("n = 1"), ["key", "path"], "left_semi"))
    offsets: Column = F.coalesce("some", F.sequence(F.lit(0), F.col("count") - 1))
    return paths.join(told, ["key", "path"]).select("row", "first", offsets.alias("offsets"))


def repeated_spans(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), window: int = WINDOW, kmer: int = KMER,
) -> DataFrame:
    """One row per row of ``docs``: carried columns, spans (array of start, end words), n_words,
    n_removed, kept_sha256.

    Words are what ASCII white space separates, unchanged. A span is a maximal run of words covered
    by windows whose word sequence also starts elsewhere, in the same text or another. Texts with
    fewer words than a window keep all of them; null counts as a text without words. Repeated rows
    are copies of each other and lose their words in all places. An empty table gives an empty
    result. Ids may be null or tie, and extra columns are ignored unless carried.
    """
    if kmer > window:
        raise ValueError("a k-mer must fit a window")
    prepare(docs.sparkSession)
    source, row = numbered(docs.select(*dict.fromkeys([*carry, "text"])), "texts")
    told = by_part(repeated_paths(source, row, window, kmer), "told")
    kernel = _span_kernel(window)
    kept = [c for c in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            if not len(rows):
                continue
            for out in kernel(rows, batch.column(batch.num_columns - 1), side_rows(told, rows)):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *out.columns[1:]],
                                                 [*batch.schema.names[:-2], *out.schema.names[1:]])

    carried = source.select(*kept)
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)
    schema = f"{body}, spans array<struct<start: bigint, end: bigint>>, n_words long, n_removed long, kept_sha256 string"
    return source.select(*kept, row, "text").mapInArrow(run, schema)


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS word_seq
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w)
), hit AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY word_seq) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM hit)
), flat AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.p) AS body, count(*) AS n
  FROM flat f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.p = g.p WHERE g.p IS NULL GROUP BY f.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
