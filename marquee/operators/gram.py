"""Least squares from one pass: sums of products of all columns, kept apart by group and by which columns are missing.

Every formula, fold and penalty over the same columns is then a sub-block that the driver solves, p x p numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALIASED = 1e-9  # of its variance: what a column keeps beside earlier ones counts as nothing from here down
MOST = 2000  # columns: the driver holds and solves matrices of this size


@dataclass(frozen=True)
class Line:
    names: tuple[str, ...]
    intercept: float
    slopes: tuple[float, ...]

    def predict(self, columns: dict[str, Column]) -> Column:
        """Prediction from the columns by name: null where one is null."""
        out = F.lit(self.intercept)
        for name, slope in zip(self.names, self.slopes, strict=True):
            out = out + F.lit(slope) * columns[name].cast("double")
        return out


class Grams:
    """Sums of products of [1, columns, label] per (group, missing columns); columns are shifted by ``shift``."""

    def __init__(self, names: Sequence[str], shift: np.ndarray, sums: dict[tuple[int, str], np.ndarray]):
        self.names, self.shift, self.sums = tuple(names), shift, sums

    def of(self, names: Sequence[str], groups: set[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The matrix over the rows of ``groups`` that have all columns ``names``, and the shifts of these."""
        at = [self.names.index(n) for n in names]
        pick = [0, *[i + 1 for i in at], len(self.names) + 1]
        total = np.zeros((len(pick), len(pick)))
        for (group, missing), sums in self.sums.items():
            if (groups is None or group in groups) and missing[-1] == "0" and all(missing[i] == "0" for i in at):
                total += sums[np.ix_(pick, pick)]
        return total, self.shift[at]

    def fit(self, names: Sequence[str], groups: set[int] | None = None, penalty: float = 0.0) -> Line:
        """Least squares on the complete rows of ``groups``.

        A column that earlier ones explain completely gets the slope zero. A penalty acts on the squared slopes
        of columns and label scaled to unit variance.
        """
        total, shift = self.of(names, groups)
        n = total[0, 0]
        if n == 0:
            raise ValueError("no complete rows to fit on")
        mean = total[0, 1:] / n
        cov = total[1:, 1:] / n - np.outer(mean, mean)
        p = len(names)
        left, used = cov.copy(), []
        for i in range(p):
            if left[i, i] > ALIASED * max(cov[i, i], total[i + 1, i + 1] / n * 1e-12):
                used.append(i)
                left = left - np.outer(left[:, i], left[i, :]) / left[i, i]
        slope = np.zeros(p)
        if used:
            block = cov[np.ix_(used, used)]
            if penalty:
                block = block + penalty / np.sqrt(cov[p, p]) * np.diag(np.diag(block))
            slope[used] = np.linalg.solve(block, cov[used, p])
        return Line(tuple(names), float(mean[p] - slope @ (mean[:p] + shift)), tuple(float(s) for s in slope))

    def error(self, line: Line, groups: set[int] | None = None) -> tuple[int, float | None]:
        """Number of complete rows of ``groups`` and the root of the mean squared error of ``line`` on them."""
        total, shift = self.of(line.names, groups)
        n = int(total[0, 0])
        slopes = np.array(line.slopes)
        w = np.concatenate([[-(line.intercept + slopes @ shift)], -slopes, [1.0]])
        return n, float(np.sqrt(max(w @ total @ w, 0.0) / n)) if n else None


def grams(df: DataFrame, columns: dict[str, Column], label: Column, group: Column) -> Grams:
    """Sums of products over all rows of ``df``, from one pass behind one for the means.

    ``columns`` are numbers by name, ``group`` a small whole number. Each task sums its rows in blocks and sends one triangle for each
    group and set of missing columns that it met; these are added before they reach the driver.
    """
    names = list(columns)
    if len(names) > MOST:
        raise ValueError(f"{len(names)} columns, at most {MOST}")
    rows = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())], label.cast("double").alias("y"),
                     group.cast("long").alias("g"))
    means = rows.agg(*[F.avg(f"c{i}") for i in range(len(names))]).first()
    shift = np.array([m or 0.0 for m in means])
    i, j = np.triu_indices(len(names) + 2)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, bytes], np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]])
            missing = np.isnan(z[:, 1:])
            z[:, 1:-1] -= shift
            z[np.isnan(z)] = 0.0
            kinds, which = np.unique(np.column_stack([batch.column(batch.num_columns - 1).to_numpy(), missing]), axis=0, return_inverse=True)
            for k, kind in enumerate(kinds):
                part = z[which.ravel() == k]
                key = int(kind[0]), kind[1:].astype(np.uint8).tobytes()
                sums[key] = sums.get(key, 0.0) + part.T @ part
        for (g, missing), s in sums.items():
            told = "".join(map(str, missing))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(i), pa.int64()), pa.array([told] * len(i)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(s[i, j])],
                ["g", "missing", "i", "j", "s"])

    told = rows.where("g IS NOT NULL").mapInArrow(partial, "g long, missing string, i int, j int, s double")
    sums: dict[tuple[int, str], np.ndarray] = {}
    for r in told.groupBy("g", "missing", "i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        block = sums.setdefault((r.g, r.missing), np.zeros((len(names) + 2,) * 2))
        block[r.i, r.j] = block[r.j, r.i] = r.s
    return Grams(names, shift, sums)


def level_columns(name: str, levels: Sequence[str]) -> dict[str, Column]:
    """0/1 columns of a text column, the first level being the base; null for null and for other values."""
    known = F.col(name).isin(list(levels))
    return {f"{name}={v}": F.when(known, (F.col(name) == v).cast("int")) for v in levels[1:]}
