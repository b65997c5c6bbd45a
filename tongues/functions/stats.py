"""The 18 statistical features of a text, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tongues.functions.text import count_chars, count_matches, count_phrase, digit_count, letter_count, word_count

# Character sets and word patterns that mark a language.
CHAR_SETS = {
    "accents_latin": "áéíóúàèìòùâêîôûäëïöü",
    "spanish_chars": "ñ¿¡",
    "french_chars": "çœæ",
    "german_chars": "ßäöü",
    "italian_chars": "àèéìòóù",
    "apostrophe": "'’",
}
WORD_PATTERNS = {
    "the_english": (" the ",),
    "und_german": (" und ",),
    "y_spanish": (" y ", " e "),
    "et_french": (" et ",),
    "e_italian": (" e ", " ed "),
}
PUNCTUATION = ".,;:!?"

BASIC = (
    "length",
    "word_count",
    "avg_word_length",
    "space_ratio",
    "digit_ratio",
    "uppercase_ratio",
    "punctuation_ratio",
)
CHARS = tuple(CHAR_SETS)
WORDS = tuple(WORD_PATTERNS)
ALL = BASIC + CHARS + WORDS


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def basic_features(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    length = F.length(text).cast("long")
    return {
        "length": length,
        "word_count": word_count(text),
        "avg_word_length": _ratio(letter_count(text), word_count(text)),
        "space_ratio": _ratio(count_chars(text, " "), length),
        "digit_ratio": _ratio(digit_count(text), length),
        "uppercase_ratio": _ratio(count_matches(text, r"\p{IsUppercase}"), length),
        "punctuation_ratio": _ratio(count_chars(text, PUNCTUATION), length),
    }


def char_features(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {name: count_chars(text, chars) for name, chars in CHAR_SETS.items()}


def word_features(text: Column) -> dict[str, Column]:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    out = {}
    for name, phrases in WORD_PATTERNS.items():
        total = count_phrase(lowered, phrases[0])
        for phrase in phrases[1:]:
            total = total + count_phrase(lowered, phrase)
        out[name] = total
    return out


def all_features(text: Column) -> dict[str, Column]:
    return {**basic_features(text), **char_features(text), **word_features(text)}
