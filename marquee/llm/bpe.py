"""Byte-level BPE: encoding, decoding and exact length counts from a rank file.

The rank file gives each byte string its rank, which is also its id. A text is cut by the
tokenizer's pattern; each word (match) is encoded on its own by folding the ranked merges over its
bytes. Words repeat, so texts are gathered up to a fixed number of characters and the fold runs over the distinct
words of what was gathered, all of them side by side. Nothing is kept from one gathering to the next. Decoding
concatenates the byte strings of the ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from marquee.llm.common import prepare, with_text

RANKS = "byte_bpe_multi_50k.tiktoken"
TOGETHER = 1 << 23  # characters that are gathered before their distinct words are encoded
PIECE = 1 << 16  # characters, or matches, of a text that are cut at a time
LONG_STRETCH = 256  # characters above which a stretch without a blank is cut into its words
LONG_WORD = 256  # bytes above which a word is folded alone, with a heap in place of steps over all words
CHUNK = 1 << 17  # stretches that are written out together


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


NEVER = np.iinfo(np.int32).max
_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd number near 2**64 / golden ratio


class Merges:
    """The rank file as arrays: ids of single bytes, whole words, and a hash table from a pair of ids to the id it becomes."""

    def __init__(self, path: str):
        rank = ranks(path)
        self.single = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        self.words = pa.array(list(rank), pa.binary())
        self.ids = np.array(list(rank.values()), np.int32)
        found = {}
        for word, number in rank.items():
            for cut in range(1, len(word)):
                left, right = rank.get(word[:cut]), rank.get(word[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = number
        self.pairs = found
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.becomes = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        keys = np.array(list(found), np.int64)
        values = np.array(list(found.values()), np.int32)
        at = self._slot(keys)
        while len(keys):  # all keys move on together until each has a slot of its own
            free = np.flatnonzero(self.key[at] == -1)
            self.key[at[free]] = keys[free]
            self.becomes[at[free]] = values[free]
            lost = self.key[at] != keys
            self.becomes[at[~lost]] = values[~lost]
            keys, values, at = keys[lost], values[lost], (at[lost] + 1) & self.mask
        both = np.arange(256)
        self.bytewise = self.score(np.repeat(self.single[both], 256), np.tile(self.single[both], 256))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def score(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of ids its rank, which is the id that it becomes, or NEVER."""
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        there = self.key[at]
        out = np.where(there == key, self.becomes[at], np.int32(NEVER))
        open_ = np.flatnonzero((there != key) & (there != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            there = self.key[at[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.becomes[at[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def fold_long(word: bytes, path: str) -> list[int]:
    """The same fold for one word of any length: pairs wait in a heap, merged tokens are linked to their neighbours."""
    known = merges(path)
    pairs, size = known.pairs, len(word)
    token = known.single[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(r, i) for i in range(size - 1) if (r := pairs.get(token[i] << 32 | token[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if token[i] < 0 or j >= size or pairs.get(token[i] << 32 | token[j]) != rank:
            continue  # one of the two has been merged meanwhile
        token[i], token[j] = rank, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < size and (r := pairs.get(token[a] << 32 | token[b])) is not None:
                heapq.heappush(heap, (r, a))
    return [t for t in token if t >= 0]


def fold(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``words`` (binary) one after another, and the number of ids of each.

    Again and again the adjacent pair of lowest rank of a word, the first of ties, is merged. All words advance together,
    one merge each per step, until none has a pair left.
    """
    known = merges(path)
    offset = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    length = np.diff(offset)
    whole = pc.index_in(words, value_set=known.words).fill_null(-1).to_numpy(zero_copy_only=False)
    at_once = np.flatnonzero(whole >= 0)
    done_owner, done_token = [at_once], [known.ids[whole[at_once]]]
    for i in np.flatnonzero((whole < 0) & (length > LONG_WORD)).tolist():
        ids = fold_long(data[offset[i] : offset[i + 1]].tobytes(), path)
        done_owner.append(np.full(len(ids), i))
        done_token.append(np.array(ids, np.int32))
    short = np.flatnonzero((whole < 0) & (length > 0) & (length <= LONG_WORD))
    owner = np.repeat(short.astype(np.int32), length[short])
    raw = ragged(data, offset[short], length[short])
    token = known.single[raw]
    rated = np.full(len(raw), NEVER, np.int32)
    rated[:-1] = np.where(owner[1:] == owner[:-1], known.bytewise[raw[:-1].astype(np.int32) << 8 | raw[1:]], np.int32(NEVER)) if len(raw) else []
    while len(token):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        size = np.diff(np.append(first, len(owner)))
        best = np.repeat(np.minimum.reduceat(rated, first), size)
        ended = best == NEVER
        if ended.any():
            done_owner.append(owner[ended])
            done_token.append(token[ended])
            token, owner, rated, best = token[~ended], owner[~ended], rated[~ended], best[~ended]
            if not len(token):
                break
        hit = np.flatnonzero(rated == best)
        hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]
        token[hit] = rated[hit]
        keep = np.ones(len(token), bool)
        keep[hit + 1] = False
        token, owner, rated = token[keep], owner[keep], rated[keep]
        hit = hit - np.arange(len(hit))  # one token to the left of each has gone for every earlier hit
        for at in (hit, hit[hit > 0] - 1):
            inner = at + 1 < len(token)
            inner[inner] = owner[at[inner]] == owner[at[inner] + 1]
            rated[at] = NEVER
            rated[at[inner]] = known.score(token[at[inner]], token[at[inner] + 1])
    owner, token = np.concatenate(done_owner), np.concatenate(done_token)
    return token[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def ragged(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches flat[at : at + size], one after another."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((at - end + size).astype(kind), size) + np.arange(total, dtype=kind)]


class Names:
    """For each id its bytes, and the id as text behind a comma, laid end to end."""

    def __init__(self, path: str):
        rank = ranks(path)
        count = max(rank.values()) + 1
        piece, listed = [b""] * count, [b""] * count
        for word, i in rank.items():
            piece[i], listed[i] = word, b",%d" % i
        self.piece, self.listed = piece, listed
        self.flat = [np.frombuffer(b"".join(x), np.uint8) for x in (listed, piece)]
        self.size = [np.array([len(y) for y in x], np.int64) for x in (listed, piece)]
        self.at = [np.cumsum(x) - x for x in self.size]


@lru_cache(maxsize=2)
def names(path: str) -> Names:
    return Names(path)


def decode(ids: Sequence[int], path: str) -> bytes:
    """The byte strings of the ids, concatenated."""
    piece = names(path).piece
    return b"".join([piece[i] for i in ids])


@lru_cache(maxsize=4)
def pattern(text: str) -> regex.Pattern:
    return regex.compile(text)


def stretches(text: str, cut: str) -> Iterator[tuple[list[str], int]]:
    """``text`` in stretches that the pattern cuts as it would cut them within the text, in lists of bounded length.

    From the number that comes with a list on, a blank belongs before each of its strings. With the usual pattern a match can begin
    with a blank but never hold one behind another character, so the text may be cut before each blank
    that has something else on both sides, and before every blank where no white space is doubled. Of very long texts
    with doubled white space, and with other patterns, the matches themselves are the stretches; so are those of
    long stretches, which seldom repeat as a whole.
    """
    if cut != public_tokenizers.PATTERN:
        yield from _matches(text, cut)
    elif not pattern(r"\s\s").search(text):
        for low in range(0, len(text), PIECE):
            # whole stretches only: from the first blank at or behind each limit to the next one
            start = 0 if low == 0 else text.find(" ", low)
            end = text.find(" ", low + PIECE)
            end = len(text) if end < 0 else end
            if 0 <= start < end:
                yield from _shortened(text[start:end].split(" ") if low == 0 else text[start + 1 : end].split(" "), int(low == 0), cut)
    elif len(text) <= 16 * PIECE:
        yield from _shortened(pattern(r"(?<=\S) (?=\S)").split(text), 1, cut)
    else:
        yield from _matches(text, cut)


def _shortened(parts: list[str], plain: int, cut: str) -> Iterator[tuple[list[str], int]]:
    if max(map(len, parts)) <= LONG_STRETCH:
        yield parts, plain
        return
    for i, part in enumerate(parts):
        own = part if i < plain else " " + part
        yield from _matches(own, cut) if len(part) > LONG_STRETCH else (([own], 1),)


def _matches(text: str, cut: str) -> Iterator[tuple[list[str], int]]:
    held = []
    for m in pattern(cut).finditer(text):
        held.append(m.group())
        if len(held) == PIECE:
            yield held, PIECE
            held = []
    if held:
        yield held, len(held)


class Encoder:
    """Gathers texts; ``told`` gets their ids in order: an array of ids and the ranges of it that belong to which text."""

    def __init__(self, path: str, cut: str, told: Callable[[np.ndarray, list[tuple]], None]):
        self.path, self.cut, self.told = path, cut, told
        self._clear()

    def _clear(self) -> None:
        self.size, self.parts, self.plain, self.owners = 0, [], [], []

    def take(self, text: str, doc) -> None:
        long = len(text) > TOGETHER
        self.size += 0 if long else len(text)
        for parts, plain in stretches(text, self.cut):
            if plain:
                self.plain.append((len(self.parts), len(self.parts) + plain))
            self.parts += parts
            self.owners.append((doc, len(self.parts)))
            self.size += sum(map(len, parts)) + len(parts) if long else 0
            if long and self.size >= TOGETHER:
                self.flush()

    def flush(self) -> None:
        """Encode what was gathered: distinct stretches, of these the distinct words, then all places."""
        if not self.parts:
            return
        coded = pa.array(self.parts, pa.string()).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64) * 2 + 1
        for start, stop in self.plain:
            code[start:stop] -= 1
        seen = np.zeros(2 * len(coded.dictionary), bool)
        seen[code] = True
        used = np.flatnonzero(seen)
        code = (np.cumsum(seen) - 1)[code]
        # A stretch of letters is one match, with or without a blank before it; the others are cut by the pattern.
        strings, blank = coded.dictionary.take(pa.array(used >> 1)), (used & 1).astype(bool)
        letters = np.zeros(len(used), bool) if self.cut != public_tokenizers.PATTERN else pc.utf8_is_alpha(strings).to_numpy(zero_copy_only=False)
        whole = pc.if_else(pa.array(blank[letters]), pc.binary_join_element_wise("", strings.filter(pa.array(letters)), " "), strings.filter(pa.array(letters)))
        find = pattern(self.cut).findall
        words, count = [], np.ones(len(used), np.int64)
        cut = []
        for s, b in zip(strings.filter(pa.array(~letters)).to_pylist(), blank[~letters].tolist(), strict=True):
            found = find(" " + s if b else s)
            words += found
            cut.append(len(found))
        count[~letters] = cut
        # The words of all stretches in order: those of letters stand behind the others, and are fetched from there.
        place = np.empty(int(count.sum()), np.int64)
        single = np.repeat(letters, count)
        place[single] = len(words) + np.arange(len(whole))
        place[~single] = np.arange(len(words))
        distinct = pa.chunked_array([pa.array(words, pa.string()), whole]).combine_chunks().dictionary_encode()
        ids, size = fold(distinct.dictionary.cast(pa.binary()), self.path)
        at, word = np.cumsum(size) - size, distinct.indices.to_numpy()[place]
        ids = ragged(ids, at[word], size[word])
        upto = np.concatenate([[0], np.cumsum(size[word])])
        border = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        at, size = upto[border[:-1]], upto[border[1:]] - upto[border[:-1]]
        owners, k = self.owners, 0
        for low in range(0, len(code), CHUNK):
            part = code[low : low + CHUNK]
            end = np.concatenate([[0], np.cumsum(size[part])])
            ranges, start = [], low
            while start < low + len(part):
                doc, stop = owners[k]
                k += stop <= low + len(part)
                stop = min(stop, low + len(part))
                ranges.append((doc, int(end[start - low]), int(end[stop - low])))
                start = stop
            self.told(ragged(ids, at[part], size[part]), ranges)
        self._clear()


class Digest:
    """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded bytes."""

    def __init__(self):
        self.count, self.ids, self.decoded = 0, sha256(), sha256()

    def columns(self) -> tuple[int, str, str]:
        return self.count, self.ids.hexdigest(), self.decoded.hexdigest()

    @staticmethod
    def teller(path: str) -> Callable[[np.ndarray, list[tuple]], None]:
        known = names(path)

        def told(ids: np.ndarray, ranges: list[tuple]) -> None:
            flat, upto = [], []
            for k in (0, 1):
                size = known.size[k][ids]
                flat.append(memoryview(ragged(known.flat[k], known.at[k][ids], size)))
                upto.append(np.concatenate([[0], np.cumsum(size)]))
            for doc, start, stop in ranges:
                if start < stop:
                    doc.ids.update(flat[0][upto[0][start] + (doc.count == 0) : upto[0][stop]])
                    doc.decoded.update(flat[1][upto[1][start] : upto[1][stop]])
                    doc.count += stop - start

        return told


class Count:
    """Number of ids."""

    def __init__(self):
        self.count = 0

    def columns(self) -> tuple[int]:
        return (self.count,)

    @staticmethod
    def teller(path: str) -> Callable[[np.ndarray, list[tuple]], None]:
        def told(ids: np.ndarray, ranges: list[tuple]) -> None:
            for doc, start, stop in ranges:
                doc.count += stop - start

        return told


class Ids:
    """The ids themselves."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def columns(self) -> tuple[np.ndarray]:
        return (np.concatenate([np.empty(0, np.int64), *self.parts]).astype(np.int32),)

    @staticmethod
    def teller(path: str) -> Callable[[np.ndarray, list[tuple]], None]:
        def told(ids: np.ndarray, ranges: list[tuple]) -> None:
            for doc, start, stop in ranges:
                doc.parts.append(ids[start:stop])

        return told


def encoded(texts: Iterable[str | None], path: str, cut: str, kind: type = Ids) -> list:
    """What ``kind`` keeps of each text."""
    encoder, docs = Encoder(path, cut, kind.teller(path)), []
    for text in texts:
        docs.append(kind())
        encoder.take(text or "", docs[-1])
        if encoder.size >= TOGETHER:
            encoder.flush()
    encoder.flush()
    return docs


def _kernel(path: str, cut: str, kind: type, fields: dict[str, pa.DataType]):
    """Batches with the text last -> without it, with ``fields`` behind. A batch waits until its texts are encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, waiting = Encoder(path, cut, kind.teller(path)), []

        def ready() -> Iterator[pa.RecordBatch]:
            encoder.flush()
            for carried, schema, docs in waiting:
                told = list(zip(*[d.columns() for d in docs], strict=True)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays([*carried, *[pa.array(v, t) for v, t in zip(told, fields.values(), strict=True)]], [*schema, *fields])
            waiting.clear()

        for batch in batches:
            docs = [kind() for _ in range(batch.num_rows)]
            for text, doc in zip(batch.column(batch.num_columns - 1), docs, strict=True):
                encoder.take(text.as_py() or "", doc)
            waiting.append((batch.columns[:-1], batch.schema.names[:-1], docs))
            if encoder.size >= TOGETHER or sum(len(w[2]) for w in waiting) >= 1 << 16:
                yield from ready()
        yield from ready()

    return run


def token_digests(docs: DataFrame, carry: Sequence[str] = ("doc_id",), path: str | None = None,
                  cut: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per row of ``docs``: carried columns, n_tokens, ids_sha256, decoded_sha256.

    Null counts as the empty text, which has no ids. Special tokens are ordinary text. Ids may be
    null or tie; extra columns are ignored unless carried; an empty table gives an empty result.
    Texts and words may be of any length; a worker holds about ``TOGETHER`` characters of them.
    """
    prepare(docs.sparkSession)
    source, carried = with_text(docs, carry)
    run = _kernel(path or public_tokenizers.path(RANKS), cut, Digest,
                  {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})
    return source.mapInArrow(run, f"{carried}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, carry: Sequence[str] = ("doc_id",), path: str | None = None,
           cut: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per row of ``docs``: carried columns and ids (array of int). Null text as in ``token_digests``."""
    prepare(docs.sparkSession)
    source, carried = with_text(docs, carry)
    return source.mapInArrow(_kernel(path or public_tokenizers.path(RANKS), cut, Ids, {"ids": pa.list_(pa.int32())}), f"{carried}, ids array<int>")


def decode_ids(encoded: DataFrame, carry: Sequence[str] = ("doc_id",), path: str | None = None) -> DataFrame:
    """Carried columns and bytes (binary) of a column ids; null ids give null."""
    prepare(encoded.sparkSession)
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if x.as_py() is None else decode(x.as_py(), path) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())],
                                             [*batch.schema.names[:-1], "bytes"])

    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*carry).schema.fields)
    return encoded.select(*carry, "ids").mapInArrow(run, f"{carried}, bytes binary")


def token_lengths(docs: DataFrame, path: str | None = None, cut: str = public_tokenizers.PATTERN) -> DataFrame:
    """One column n_tokens, a row per row of ``docs``. Null counts as the empty text, which has no ids."""
    prepare(docs.sparkSession)
    return docs.select("text").mapInArrow(_kernel(path or public_tokenizers.path(RANKS), cut, Count, {"n_tokens": pa.int64()}), "n_tokens long")
