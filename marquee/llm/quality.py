"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a row of statistics. Cosines of random projections of the standardised statistics
approximate a Gaussian kernel, so ridge regression on them is a kernel method whose normal
equations are sums over rows: every task sums its rows and only sums of a fixed size reach the
driver. Sums are kept by fold, which gives out-of-fold scores for the choice of the penalty and
for the isotonic calibration without touching the texts again.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import prepare, with_text
from marquee.session import materialise

FEATURES, FOLDS, SEED = 192, 5, 20
PENALTIES = (0.03, 0.1, 0.3, 1.0, 3.0, 10.0, 30.0, 100.0)
BINS = 1000  # steps in which out-of-fold scores are counted for the calibration
THRESHOLD = 0.7
UNTAUGHT = 1.0  # every score if there is no label to learn from: nothing speaks against a text

# Classes of bytes: white space, A-Z, a-z, digits, . , ; : ! ?, other ASCII; the rest are letters of any script.
_SPACE, _UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[:128] = _SYMBOL
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
_CLASS[[ord(c) for c in ".,;:!?"]] = _MARK


def statistics(text: str | None) -> list[float]:
    """Shape statistics of a whole text; null and empty texts give a fixed row."""
    raw = (text or "").encode()
    kind = _CLASS[np.frombuffer(raw, np.uint8)]
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    size, count = max(1, len(raw)), max(1, len(words))
    each = np.bincount(kind, minlength=7)
    blank = np.concatenate(([True], kind == _SPACE, [True]))
    first, last = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:]) - 1
    length = last - first + 1
    tally = Counter(words)
    return [
        math.log1p(len(raw)),
        math.log1p(len(words)),
        float(length.mean()) if len(words) else 0.0,
        float(length.std()) if len(words) else 0.0,
        (each[_UPPER] + each[_LOWER] + each[_OTHER]) / size,
        each[_UPPER] / size,
        each[_DIGIT] / size,
        each[_SYMBOL] / count,
        each[_MARK] / count,
        raw.count(b"!") / count,
        raw.count(b"|") / count,
        raw.count(b".") / count,
        len(tally) / math.sqrt(count),
        len(tally) / count,
        max(tally.values(), default=0) / count,
        sum(map(eq, words, islice(words, 1, None))) / count,
        len(set(lines)) / max(1, len(lines)),
        math.log1p(len(lines)),
        math.log1p(len(words) / max(1, len(lines))),
        float(np.count_nonzero(kind[last] >= _MARK) - np.count_nonzero(kind[last] == _OTHER)) / count,
        float(np.count_nonzero(kind[first] == _UPPER)) / count,
        float(np.count_nonzero(length <= 3)) / count,
    ]


N_STATISTICS = len(statistics(""))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(x.as_py()) for x in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))],
                                         [*batch.schema.names[:-1], "stats_"])


def with_statistics(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    source, carried = with_text(docs, carry)
    return source.mapInArrow(_statistics, f"{carried}, stats_ array<double>")


@dataclass
class Model:
    """All a task needs to score: small arrays of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([waves, z / math.sqrt(z.shape[1]), np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features(stats) @ self.weights, self.knots, self.values)


def _sums(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per fold the normal equations of a task's rows, upper triangle: (fold, place, value)."""
    size = FEATURES + N_STATISTICS + 2
    total = np.zeros((FOLDS, size, size))
    for batch in batches:
        if not len(batch):
            continue
        stats = np.array(batch.column(0).to_pylist())
        folds = batch.column(1).to_numpy(zero_copy_only=False)
        rows = np.hstack([model.features(stats), batch.column(2).to_numpy(zero_copy_only=False)[:, None]])
        for fold in np.unique(folds):
            own = rows[folds == fold]
            total[fold] += own.T @ own
    upper = np.triu_indices(size)
    for fold in range(FOLDS):
        if total[fold, -1, -1] or total[fold].any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper[0]), fold)), pa.array(np.arange(len(upper[0]))), pa.array(total[fold][upper])],
                ["fold", "place", "value"])


def pool_adjacent(score: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic least squares on sorted scores: centre and value of each pooled block."""
    blocks: list[list[float]] = []  # weight, weighted target, weighted score
    for s, w, t in zip(score, weight, target, strict=True):
        blocks.append([w, w * t, w * s])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit(train: DataFrame) -> Model | None:
    """Rows (stats_, fold, label 0 or 1) -> model; None if there are none."""
    each = [F.element_at("stats_", i + 1) for i in range(N_STATISTICS)]
    one = train.agg(F.count(F.lit(1)), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    if not one[0]:
        return None
    mean = np.array(one[1 : 1 + N_STATISTICS], float)
    scale = np.array(one[1 + N_STATISTICS :], float)
    scale[scale < 1e-9] = 1.0
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((N_STATISTICS, FEATURES)) / math.sqrt(N_STATISTICS)
    model = Model(mean, scale, directions, random.uniform(0, 2 * math.pi, FEATURES), np.zeros(0), np.zeros(0), np.zeros(0))

    sums = train.mapInArrow(lambda b: _sums(model, b), "fold long, place long, value double")
    size = FEATURES + N_STATISTICS + 2
    upper = np.triu_indices(size)
    folds = np.zeros((FOLDS, size, size))
    for fold, place, value in sums.groupBy("fold", "place").agg(F.sum("value")).collect():  # of fixed number
        folds[fold][upper[0][place], upper[1][place]] = value
    folds += np.transpose(np.triu(folds, 1), (0, 2, 1))
    total = folds.sum(0)

    def solve(normal: np.ndarray, penalty: float) -> np.ndarray:
        ridge = np.eye(size - 1) * penalty
        ridge[-1, -1] = 1e-9  # the constant is free
        return np.linalg.solve(normal[:-1, :-1] + ridge, normal[:-1, -1])

    def error(penalty: float) -> float:
        lost = 0.0
        for own in folds:
            w = np.append(solve(total - own, penalty), -1.0)
            lost += w @ own @ w
        return lost

    filled = [own for own in folds if own.any()]
    penalty = min(PENALTIES, key=error) if len(filled) > 1 else 1.0
    model.weights = solve(total, penalty)
    apart = [solve(total - own, penalty) if len(filled) > 1 else model.weights for own in folds]

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = model.features(np.array(batch.column(0).to_pylist()))
            each = np.einsum("ij,ij->i", rows, np.array(apart)[batch.column(1).to_numpy(zero_copy_only=False)])
            yield pa.RecordBatch.from_arrays([pa.array(each), batch.column(2).cast(pa.float64())], ["raw", "label"])

    tally = train.mapInArrow(held_out, "raw double, label double").groupBy(
        F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("y")).orderBy("bin").collect()  # at most 3 * BINS + 1 rows
    knots, values = pool_adjacent(*(np.array(x, float) for x in zip(*((r.bin / BINS, r.n, r.y) for r in tally), strict=True)))
    # A slight slope within and beyond the blocks keeps the order of the raw scores.
    model.knots = np.concatenate(([-1.0], knots, [2.0]))
    model.values = np.clip(np.concatenate(([values[0] - 1e-3], values, [values[-1] + 1e-3])), 0, 1)
    return model


def _remainder() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))


def taught(stats: DataFrame, labels: DataFrame) -> Model | None:
    """A model from rows (doc_id, stats_) and the labels of those that are not held out."""
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id_")).agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    train = stats.where(_remainder() != 2).join(marks, F.col("doc_id") == F.col("id_")).select(
        "stats_", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), F.col("label").cast("double").alias("label"))
    return fit(materialise(train, "labelled"))


def _scores(model: Model | None, stats: list[list[float]]) -> np.ndarray:
    rows = np.array(stats, float).reshape(-1, N_STATISTICS)
    return np.full(len(rows), UNTAUGHT) if model is None else model.score(rows)


def quality_scores(docs: DataFrame, labels: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the carried columns, held_out, score, predicted.

    Labels are learned from documents whose crc32 of the id, modulo 4, is not 2; those with that
    remainder are held out. Only the text enters a score. Null and empty texts are scored by the
    statistics of the empty text. A null id is neither held out nor learned from. Ids that ``labels``
    marks both ways or not at all teach nothing; repeated labels count once. Without any label to
    learn from every score is ``UNTAUGHT``. Extra columns are ignored unless carried, under any name;
    one named like a result stands before it.
    """
    prepare(docs.sparkSession)
    # Carried columns go by number, so none can bear the name of a working column.
    names = {f"carried_{i}": c for i, c in enumerate(carry)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()], "doc_id", "text")
    stats = materialise(with_statistics(plain, [*names, "doc_id"]), "statistics")
    model = taught(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(model, batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*batch.schema.names[:-1], "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.drop("stats_").schema.fields)
    told = stats.mapInArrow(run, f"{schema}, score double")
    return told.select(
        *[F.col(n).alias(c) for n, c in names.items()], F.coalesce(_remainder() == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_scores`` predicts to be good: nothing but statistics is shuffled."""
    prepare(docs.sparkSession)
    model = taught(materialise(with_statistics(docs, ("doc_id",)), "statistics"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(model, [statistics(x.as_py()) for x in batch.column("text")])
            yield batch.filter(pa.array(score >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
