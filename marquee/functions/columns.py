"""Column expressions: bands, flags, keys and clamps. All run as native code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels and limits. "Avergae" is spelled as the data has it.
LENGTH_BANDS = (
    (50, "Less than 50"), (100, "50 to 100"), (150, "100 to 150"), (200, "150 to 200"),
)
LENGTH_ABOVE = "More than 200"
QUALITY_BANDS = ((3, "Poor"), (5, "Avergae"), (7, "Good"), (10, "Excellent"))
DAY_PARTS = (
    (6, "Late night (12AM - 6AM)", 5), (11, "Morning (6AM - 11AM)", 1),
    (16, "Afternoon (11AM - 4PM)", 2), (20, "Evening (4PM - 8PM)", 3),
    (24, "Night (8PM - 12AM)", 4),
)
OTHER_OCCUPATIONS = ("other", "none", "homemaker", "retired")
MISSING = "(Missing)"
UNKNOWN = "Unknown"


def _below(value: Column, steps: Sequence[tuple]) -> Column:
    """First step whose limit lies above ``value``; null when none does."""
    out = F
    for limit, label, *_ in steps:
        out = out.when(value < limit, label)
    return out


def length_band(length: Column, unknown: bool = False) -> Column:
    """Running-time band. Exactly 200 belongs to no band and stays null."""
    band = _below(length, LENGTH_BANDS).when(length > LENGTH_BANDS[-1][0], LENGTH_ABOVE)
    return band.when(length.isNull(), UNKNOWN) if unknown else band


def quality_band(score: Column) -> Column:
    """Score band; a missing score is ``Unknown``, exactly 10 stays null."""
    return _below(score, QUALITY_BANDS).when(score.isNull(), UNKNOWN)


def rating_hour(ts: Column) -> Column:
    return F.hour(ts)


def release_month(date: Column) -> Column:
    return F.month(date)


def explicit_missing(value: Column) -> Column:
    """Text form of ``value`` with missing as a level of its own."""
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def day_part(hour: Column) -> Column:
    return _below(hour, DAY_PARTS)


def day_part_order(hour: Column) -> Column:
    """Display position of the day part: morning first, late night last."""
    return _below(hour, [(limit, pos) for limit, _, pos in DAY_PARTS])


def occupation_class(occupation: Column) -> Column:
    return (
        F.when(occupation == "student", "Student")
        .when(occupation.isin(*OTHER_OCCUPATIONS), "Other")
        .otherwise("Professional")
    )


def genre_string(flags: Sequence[str], rating_count: Column | None = None) -> Column:
    """Names of the set flags in column order, blank separated; null if none is set.

    With ``rating_count`` the string also ends in ``genre_count`` for items rated
    exactly once, as the original long form does by accident.
    """
    parts = [F.when(F.col(g), g) for g in flags]
    if rating_count is not None:
        parts.append(F.when(rating_count == 1, "genre_count"))
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def primary_genre(flags: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(g), g) for g in flags])


def flags_as_int(flags: Sequence[str]) -> list[Column]:
    return [F.col(g).cast("int").alias(g) for g in flags]


def submission_key(user: Column, item: Column) -> Column:
    return F.concat_ws("_", user.cast("string"), item.cast("string"))


def clamp_rating(pred: Column, null_to: float | Column | None = 1.0) -> Column:
    """Limit a prediction to 1..5. ``null_to=None`` keeps a missing prediction; NaN is missing too."""
    pred = F.nanvl(pred.cast("double"), F.lit(None).cast("double"))
    # least() and greatest() skip nulls, so a plain pair would turn null into 5.
    clamped = F.when(pred.isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(5.0), pred)))
    if null_to is None:
        return clamped
    return F.coalesce(clamped, null_to if isinstance(null_to, Column) else F.lit(float(null_to)))


def any_null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def r6(value: Column) -> Column:
    """Six decimals: the precision of every stored mean, so it can serve as a key."""
    return F.round(value, 6)
