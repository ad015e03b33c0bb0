"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. Pages whose payloads are equal are written once as a
response; the others become revisit records that name it. The index sorts the captures by URL key
(host labels reversed, then the path) into compressed blocks, and a sparse directory keeps the
first and last key of every block. A lookup searches the directory by bisection, reads the byte
range of a block, searches the block, and then reads the byte range of each record.

All files lie in the shared folder. A task names its files uniquely and hands on their names and
places as rows, so what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import prepare, uri
from marquee.session import materialise, new_path

ARCHIVE_BYTES = 256 << 20  # an archive is closed behind the record that reaches this
BLOCK_LINES = 1000
LEAST_SALTS = 64  # at least so many tasks share the pages of one payload
DIRECTORY_ROWS = 10_000  # rows of the directory searched at a time
READ_BYTES = 4 << 20  # records that lie side by side are read together up to this
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, ``)``, rest without the fragment. Null has the empty key."""
    if not url:
        return ""
    host, rest = re.match(r"(?s)(?:[A-Za-z][A-Za-z0-9+.-]*:)?/{0,2}([^/?#]*)([^#]*)", url).groups()
    host = re.sub(r":[0-9]*$", "", host.rpartition("@")[2]).lower()
    return ",".join(reversed(host.split("."))) + ")" + (rest or "/")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_safe(text: str) -> str:
    """Control characters and blanks as percent escapes, so that a URL stays on its header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A record in its own gzip member. The HTTP head tells the full length, for a revisit too."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_safe(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parse(member: bytes) -> dict:
    """A record as written by ``record``; raises if its lengths or the digest of its payload disagree."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: ([0-9]+)", http)[1])
    if end != b"\r\n\r\n" or kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return {"page_id": _number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": _number(fields.get("WARC-Refers-To")),
            "payload": payload if kind == "response" else None}


@dataclass
class Archive:
    """Captures (a row per record), and the directory of the index blocks (a row per block)."""

    captures: DataFrame
    directory: DataFrame
    directory_uri: str


def _files(place: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(place)


def _rows(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    values = zip(*rows, strict=True) if rows else ([] for _ in columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values(), strict=True)], list(columns))


CAPTURE = {"key": pa.string(), "page_id": pa.int64(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()}
BLOCK = {"first": pa.string(), "last": pa.string(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()}
CAPTURE_SQL = "key string, page_id long, file string, offset long, length long"
PLACE = {"file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "keys": pa.list_(pa.string())}
PLACE_SQL = "file string, offset long, length long, keys array<string>"
BLOCK_SQL = "first string, last string, file string, offset long, length long"


def _archive_writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _files(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, keep_id, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    where.create_dir(base, recursive=True)
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                member = record(page_id, url, payload, keep_id, revisit)
                out.write(member)
                rows.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if rows:
                yield _rows(CAPTURE, rows)
        if out is not None:
            out.close()
    return run


def _block_writer(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _files(folder)
        name, at, out, held, told = f"{uuid.uuid4().hex}.cdx", 0, None, [], []

        def flush() -> None:
            nonlocal at, out
            if out is None:
                where.create_dir(base, recursive=True)
                out = where.open_output_stream(f"{base}/{name}", compression=None)
            packed = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
            out.write(packed)
            told.append((held[0][0], held[-1][0], name, at, len(packed)))
            at += len(packed)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) == lines:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        yield _rows(BLOCK, told)
    return run


def _decided(source: DataFrame, least_bytes: int) -> DataFrame:
    """Rows (page_id, url, html) with ``keep_id`` and ``revisit``.

    A payload's rows are dealt over salts that follow the page (the URL where it has no id), so a
    payload of a third of all pages is spread over as many tasks. Payloads are counted per salt, and
    a payload's decision goes only to the salts where it occurs.
    """
    salts = max(LEAST_SALTS, int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def salt(page_id, url):
        return F.pmod(F.xxhash64(page_id, F.when(page_id.isNull(), url)), F.lit(salts)).cast("int")

    payload = ["sha", "bytes"]
    source = source.withColumns({"sha": F.sha2("html", 256), "bytes": F.octet_length("html"),
                                 "salt": salt(F.col("page_id"), F.col("url"))})
    parts = source.where(F.col("bytes") >= least_bytes).groupBy(*payload, "salt").agg(
        F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy(*payload).agg(
        F.max("top").alias("keep_id"), F.sum("n").alias("n"), F.min("salt").alias("low"), F.collect_list("salt").alias("salts")
    ).where("n > 1").withColumn("keep_salt", F.when(F.col("keep_id").isNull(), F.col("low")).otherwise(
        salt(F.col("keep_id"), F.lit(None).cast("string"))))
    found = groups.select(*[F.col(c).alias(f"{c}_") for c in payload], "keep_id", "keep_salt", F.explode("salts").alias("salt_"))
    # One sort serves the numbering and the join: equal pages meet in one salt, its first row is the response.
    place = Window.partitionBy(*payload, "salt").orderBy(F.col("page_id").desc_nulls_last())
    known = source.withColumn("place", F.row_number().over(place)).join(
        found, F.expr("sha = sha_ AND bytes = bytes_ AND salt = salt_"), "left")
    first = F.col("page_id").eqNullSafe(F.col("keep_id")) & (F.col("salt") == F.col("keep_salt")) & (F.col("place") == 1)
    return known.select("page_id", "url", "html", "keep_id", (F.col("keep_salt").isNotNull() & ~first).alias("revisit"))


def write_archive(pages: DataFrame, least_bytes: int = 0, block_lines: int = BLOCK_LINES) -> tuple[Archive, str]:
    """Write a record per row of ``pages`` (page_id, url, html) and index them; also gives the folder.

    The payload is the html in UTF-8; null is empty. Of records with equal payloads of at least
    ``least_bytes`` bytes the one with the largest page_id is the response, the others are revisits
    of it; of rows that repeat the largest id with the same payload one is the response. Null ids
    come last. A null url has the empty key. Other columns are ignored; an empty table gives no record.
    Rows that repeat id and payload are numbered by one task.
    """
    spark = prepare(pages.sparkSession)
    folder = new_path(spark, "warc")
    known = _decided(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), least_bytes)
    written = known.select("page_id", "url", F.encode("html", "UTF-8").alias("payload"), "keep_id", "revisit")
    captures = materialise(written.mapInArrow(_archive_writer(uri(f"{folder}/archive")), CAPTURE_SQL), "captures")
    order = ("key", "page_id", "file", "offset")
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    path = f"{folder}/directory"
    ordered.mapInArrow(_block_writer(uri(f"{folder}/index"), block_lines), BLOCK_SQL).write.parquet(path)
    return Archive(captures, spark.read.schema(BLOCK_SQL).parquet(path), uri(path)), folder


@lru_cache(maxsize=2)
def _directory(uri: str) -> ds.Dataset:
    where, path = _files(uri)
    return ds.dataset(path, filesystem=where, format="parquet", schema=pa.schema(list(BLOCK.items())))


def _locator(directory_uri: str):
    """Sorted keys -> (block, those of the keys that it may hold): bisection in the sparse directory.

    The part of the directory that a batch of keys spans is read piece by piece, so a key that fills
    very many blocks needs no more memory than another.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            if not wanted:
                continue
            inside = (ds.field("last") >= wanted[0]) & (ds.field("first") <= wanted[-1])
            for piece in _directory(directory_uri).to_batches(filter=inside, batch_size=DIRECTORY_ROWS):
                blocks = sorted(zip(*(c.to_pylist() for c in piece.columns), strict=True))
                lasts, held = [b[1] for b in blocks], {}
                low = bisect.bisect_left(wanted, blocks[0][0]) if blocks else len(wanted)
                high = bisect.bisect_right(wanted, lasts[-1]) if blocks else 0
                for key in wanted[low:high]:
                    at = bisect.bisect_left(lasts, key)
                    while at < len(blocks) and blocks[at][0] <= key:
                        held.setdefault(at, []).append(key)
                        at += 1
                if held:
                    yield _rows(PLACE, [(*blocks[at][2:], keys) for at, keys in held.items()])
    return run


def _block_reader(index_uri: str):
    """(block, keys) sorted by place -> captures of the keys: one range read a block, then bisection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _files(index_uri)
        name, opened, block_at, block, keys, rows = None, None, None, [], [], []
        for batch in batches:
            for file, offset, length, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    name, opened = file, where.open_input_file(f"{base}/{file}")
                if block_at != (file, offset):
                    raw = zlib.decompress(opened.read_at(length, offset))
                    block = [json.loads(line) for line in raw.decode().split("\n")]
                    keys, block_at = [line[0] for line in block], (file, offset)
                for key in wanted:
                    rows += map(tuple, block[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)])
                if len(rows) >= 10_000:
                    yield _rows(CAPTURE, rows)
                    rows = []
        if rows:
            yield _rows(CAPTURE, rows)
    return run


RECORD = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
          "record_type": pa.string(), "refers_to": pa.int64()}
RECORD_SQL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _reader(archive_uri: str, with_payload: bool):
    """(file, offset, length) sorted -> records; neighbouring ranges of a file are read as one."""
    columns = RECORD | ({"payload": pa.binary()} if with_payload else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _files(archive_uri)
        name, file = None, None
        for batch in batches:
            ranges = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            i = 0
            while i < len(ranges):
                j, (own, start, length) = i + 1, ranges[i]
                end = start + length
                while j < len(ranges) and ranges[j][0] == own and ranges[j][1] == end and end - start < READ_BYTES:
                    end += ranges[j][2]
                    j += 1
                if own != name:
                    name, file = own, where.open_input_file(f"{base}/{own}")
                raw = file.read_at(end - start, start)
                found = (parse(raw[a - start : a - start + n]) for _, a, n in ranges[i:j])
                yield _rows(columns, [tuple(x[c] for c in columns) for x in found])
                i = j
    return run


def lookup(archive: Archive, folder: str, keys: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of all captures whose URL key is in ``keys`` (a column key; repeats and null keys are
    passed over). A damaged record raises an error."""
    wanted = keys.where("key IS NOT NULL").select("key").distinct()
    ordered = wanted.repartitionByRange("key").sortWithinPartitions("key")
    places = ordered.mapInArrow(_locator(archive.directory_uri), PLACE_SQL)
    # The blocks of one key go to many tasks, not to the task of the key.
    spread = places.repartition("file", "offset").sortWithinPartitions("file", "offset")
    found = spread.mapInArrow(_block_reader(uri(f"{folder}/index")), CAPTURE_SQL)
    ranges = found.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    kind = RECORD_SQL + (", payload binary" if with_payload else "")
    return ranges.mapInArrow(_reader(uri(f"{folder}/archive"), with_payload), kind)


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS keep_id, sha1(h) AS hx,
        row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS place FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
        ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
        [strpos('0123456789abcdef', substr(hx, i, 1))]), 'string_agg', '') AS bits FROM g)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN keep_id END AS refers_to
FROM b
"""
