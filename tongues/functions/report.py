"""Expressions that turn class probabilities into a readable detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Messages, levels and limits.
ERROR_UNTRAINED = "Model not trained"
ERROR_EMPTY = "Empty text provided"
ERROR_SHORT = "Text too short (minimum 3 characters)"
WARN_VERY_SHORT = "Text is very short. Accuracy may be reduced."
WARN_SHORT = "Text is short. For better accuracy, use longer text."
NOTE_MIXED = "Text shows characteristics of multiple languages"
LEVELS = ((95, "Excellent"), (85, "Very High"), (75, "High"), (60, "Medium"), (40, "Low"))
LOWEST_LEVEL = "Very Low"
MIXED_GAP = 15
MIN_CHARS = 3


def detect_guard(stripped: Column, trained: bool = True) -> Column:
    """Error message for texts that cannot be judged, null for the rest."""
    if not trained:
        return F.lit(ERROR_UNTRAINED)
    empty = F.coalesce(stripped, F.lit("")) == ""
    return F.when(empty, F.lit(ERROR_EMPTY)).when(F.length(stripped) < MIN_CHARS, F.lit(ERROR_SHORT))


def confidence_level(confidence: Column) -> Column:
    level = F
    for bound, name in LEVELS:
        level = level.when(confidence > bound, F.lit(name))
    return level.otherwise(F.lit(LOWEST_LEVEL))


def text_preview(text: Column, width: int) -> Column:
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def short_warning(text: Column) -> Column:
    length = F.length(text)
    return F.when(length < 10, F.lit(WARN_VERY_SHORT)).when(length < 25, F.lit(WARN_SHORT))


def _lookup(code: Column, table: dict[str, str], default: Column) -> Column:
    found = F
    for key, value in table.items():
        found = found.when(code == key, F.lit(value))
    return found.otherwise(default) if table else default


def language_name(code: Column, names: dict[str, str]) -> Column:
    return _lookup(code, names, code)


def language_family(code: Column, families: dict[str, str]) -> Column:
    return _lookup(code, families, F.lit("Unknown"))


def top_predictions(
    probabilities: Column,
    classes: Sequence[str],
    n: int,
    names: dict[str, str],
    families: dict[str, str],
) -> Column:
    """The ``n`` most probable classes, best first; equal probabilities in code order."""
    scored = F.array(
        *[
            F.struct((-F.get(probabilities, F.lit(i))).alias("minus"), F.lit(code).alias("code"))
            for i, code in enumerate(classes)
        ]
    )
    return F.transform(
        F.slice(F.array_sort(scored), 1, n),
        lambda s: F.struct(
            language_name(s["code"], names).alias("language"),
            s["code"].alias("code"),
            (-s["minus"] * 100).alias("confidence"),
            language_family(s["code"], families).alias("family"),
        ),
    )


def mixed_note(predictions: Column) -> Column:
    first = F.get(predictions, F.lit(0))["confidence"]
    second = F.get(predictions, F.lit(1))["confidence"]
    return F.when((F.size(predictions) > 1) & (first - second < MIXED_GAP), F.lit(NOTE_MIXED))
