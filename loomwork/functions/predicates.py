"""Row classifiers as boolean Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Openings that mark a line as advice, not as something to do.
ADVICE_LABELS = ["note", "optional", "important", "tip", "warning", "recommended", "mandatory", "strategy", "reminder"]
ADVICE_OPENINGS = [
    "you (?:can|will|should|want|need|may|might|are|have)", "if you", "make sure", "feel free", "remember", "i would", "i personally", "here i", "keep in mind", "do not",
    "don't", "it is (?:recommended|worth|best)", "this is", "these are", r"max hits?\b", "at this point you",
]
SHOUT_CHARS = 15
ONE_PLACE = 64


def advice_pattern() -> str:
    labels, openings = "|".join(ADVICE_LABELS), "|".join(ADVICE_OPENINGS)
    return rf"(?i)^\s*[\^\[(]?\s*(?:(?:{labels})\b|{openings})"


def is_advice(c: Column) -> Column:
    """A label, the second person, a shouted line, or a line wholly in brackets."""
    return c.rlike(advice_pattern()) | c.rlike(rf"^[^a-z]{{{SHOUT_CHARS},}}") | c.rlike(r"^\s*[\[(].*[\])]\s*$")


def extent(points: Column) -> Column:
    """The larger side of the box around an array of (x, y, ...); null for no points."""
    side = lambda k: F.array_max(F.transform(points, lambda p: p[k])) - F.array_min(F.transform(points, lambda p: p[k]))
    return F.greatest(side(0), side(1))


def is_scattered(points: Column, limit: int = ONE_PLACE) -> Column:
    return F.coalesce(extent(points) > limit, F.lit(False))


def spread(rows: DataFrame, key: str, sides: list[str], limit: int = ONE_PLACE) -> DataFrame:
    """key, scattered: the same for points that are rows; only the ends of each side are kept."""
    return rows.groupBy(key).agg((F.greatest(*[F.max(s) - F.min(s) for s in sides]) > limit).alias("scattered"))
