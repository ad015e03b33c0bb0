"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased; every run of one to three of them is hashed to one of ``DIM`` places.
Document frequencies come from all training texts, as sums per task. The weights are trained with
follow-the-regularised-leader (FTRL-proximal) under an elastic-net penalty, whose first part leaves
most weights at zero: shards of a bounded sample, at most about ``PER_LANGUAGE`` documents of each
language, are passed through side by side, and the states are averaged after each round. Documents
of the sample kept out of training then set the temperature of the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare, with_text
from marquee.session import materialise

DIM_BITS = 15
DIM = 1 << DIM_BITS
PER_LANGUAGE = 1200
SHARDS, ROUNDS = 6, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
TEMPERATURES = tuple(round(float(t), 4) for t in np.geomspace(0.05, 4.0, 60))
UNKNOWN = "und"
_A = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of a text, ascending, and how often each occurs."""
    chars = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    total = np.zeros(DIM, np.int64)
    mixed = np.zeros(len(chars), np.uint64)
    for n in range(min(3, len(chars))):
        mixed = mixed[: len(chars) - n] + (chars[n:] + np.uint64(n + 1)) * _A[n]
        spread = mixed * _A[0]
        spread ^= spread >> np.uint64(31)
        total += np.bincount(((spread * _A[1]) >> np.uint64(64 - DIM_BITS)).astype(np.int64), minlength=DIM)
    places = np.flatnonzero(total)
    return places, total[places]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places, number = counts(text)
    values = np.log1p(number) * idf[places]
    norm = np.linalg.norm(values)
    return places, values / norm if norm else values


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.weights[:, places] @ values + self.bias


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that the accumulated state stands for; zero where the gradients stay below L1."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def learn(rows: list[tuple[int, np.ndarray, np.ndarray]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL over (label, places, values); the last place is the constant."""
    for label, places, values in rows:
        at = np.append(places, z.shape[1] - 1)
        x = np.append(values, 1.0)
        zs, ns = z[:, at], n[:, at]
        w = leader(zs, ns)
        error = softmax(w @ x)
        error[label] -= 1
        gradient = error[:, None] * x
        z[:, at] = zs + gradient - (np.sqrt(ns + gradient**2) - np.sqrt(ns)) / ALPHA * w
        n[:, at] = ns + gradient**2


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for x in batch.column(0):
            total[counts(x.as_py())[0]] += 1
            docs += 1
    if docs:
        places = np.append(np.flatnonzero(total), DIM)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(total[places[:-1]], docs))], ["place", "n"])


def _shard(z: np.ndarray, n: np.ndarray):
    """A pass of FTRL from the state (z, n) over one shard; gives the new state."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own_z, own_n = z.copy(), n.copy()
        ordered = rows.sort_values("order").itertuples()
        learn([(r.label, np.asarray(r.places), np.asarray(r.parts, float)) for r in ordered], own_z, own_n)
        return pd.DataFrame({"z": [own_z.astype(np.float32).tobytes()], "n": [own_n.astype(np.float32).tobytes()]})
    return run


def fit(train: DataFrame) -> Model | None:
    """Rows (doc_id, text, lang), none of them null -> model; None if there are none."""
    each = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(each)
    if not languages:
        return None
    sums = train.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    frequency = np.zeros(DIM + 1)
    for r in sums.collect():  # at most DIM + 1 rows
        frequency[r.place] = r.n
    idf = np.log((1 + frequency[DIM]) / (1 + frequency[:DIM]))

    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) / 1_000_000
    share = F.lit(0.0)
    for name, n in each.items():
        share = F.when(F.col("lang") == name, PER_LANGUAGE / n).otherwise(share)
    number = {name: i for i, name in enumerate(languages)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [vector(x.as_py(), idf) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([number[x.as_py()] for x in batch.column(2)], pa.int32()),
                 pa.array([p for p, _ in made], pa.list_(pa.int32())), pa.array([v for _, v in made], pa.list_(pa.float32()))],
                ["doc_id", "label", "places", "parts"])

    sample = train.where(draw < share).select("doc_id", "text", "lang")
    key = sample.schema["doc_id"].dataType.simpleString()
    stored = materialise(sample.mapInArrow(vectors, f"doc_id {key}, label int, places array<int>, parts array<float>"), "vectors")
    order = F.xxhash64("doc_id", F.lit(2))
    stored = stored.select("label", "places", "parts", order.alias("order"), F.pmod(order, F.lit(5)).alias("fold"),
                           F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SHARDS)).cast("int").alias("shard"))
    shape = (len(languages), DIM + 1)
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(ROUNDS):
        shard = _shard(z, n)
        states = stored.where("fold > 0").groupBy("shard").applyInPandas(shard, "z binary, n binary").collect()
        if not states:  # so few rows that all of them are kept for the temperature
            states = stored.groupBy("shard").applyInPandas(shard, "z binary, n binary").collect()
        z = np.mean([np.frombuffer(s.z, np.float32).reshape(shape) for s in states], axis=0, dtype=float)
        n = np.mean([np.frombuffer(s.n, np.float32).reshape(shape) for s in states], axis=0, dtype=float)
    w = leader(z, n)
    model = Model(languages, idf, w[:, :-1].astype(np.float32), w[:, -1])

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for label, places, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                logits = model.logits(np.asarray(places, int), np.asarray(parts))
                lost -= [np.log(max(softmax(logits / t)[label], 1e-12)) for t in TEMPERATURES]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lost))), pa.array(lost)], ["place", "lost"])

    kept = stored.where("fold = 0").select("label", "places", "parts")
    told = kept.mapInArrow(losses, "place long, lost double").groupBy("place").agg(F.sum("lost").alias("lost")).collect()
    best = min(told, key=lambda r: (round(r.lost, 9), r.place), default=None)
    if best is not None and any(r.lost for r in told):
        model.temperature = TEMPERATURES[best.place]
    return model


def languages(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the carried columns, held_out, lang_pred, score.

    Learned from text and non-null lang of documents whose crc32 of the id, modulo 3, is not 1; those
    with that remainder are held out. A prediction sees the text alone. It is ``und`` with score 0
    if the text is null or has no letter, or if there was nothing to learn from. Documents with a
    null id are neither held out nor learned from. Ids may repeat; extra columns are ignored unless
    carried; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    names = list(dict.fromkeys([*carry, "doc_id"]))
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    train = docs.where(remainder != 1).where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    model = fit(train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for x in batch.column(batch.num_columns - 1):
                text = x.as_py()
                if model is None or not has_letter(text):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                chances = softmax(model.logits(*vector(text, model.idf)) / model.temperature)
                found.append(model.languages[int(chances.argmax())])
                scores.append(float(chances.max()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], "lang_pred", "score"])

    source, carried = with_text(docs, names)
    told = source.mapInArrow(run, f"{carried}, lang_pred string, score double")
    return told.select(*carry, F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
