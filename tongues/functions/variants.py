"""Surface variants of a sentence used to enlarge a small corpus.

Every function returns an array column; entries that do not apply are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tongues.functions.text import SPACES, normalize_ws

# Fixed values.
MIN_LENGTH = 10
PREFIXES = ("Note: ", "Important: ", "Remember: ", "FYI: ", "Tip: ")
END_MARKS = (".", "!", "?")
TYPOS = (
    ("the", "teh"),
    ("and", "adn"),
    ("that", "taht"),
    ("with", "withe"),
    ("this", "thsi"),
    ("have", "haev"),
    ("from", "form"),
)


def case_variants(text: Column) -> Column:
    return F.array(F.lower(text), F.upper(text))


def punctuation_variants(text: Column) -> Column:
    last = F.right(text, F.lit(1))
    body = F.left(text, F.length(text) - 1)
    return F.array(
        *[
            F.when(last.isin(*END_MARKS) & (last != mark), F.concat(body, F.lit(mark)))
            for mark in END_MARKS
        ]
    )


def prefix_variants(text: Column) -> Column:
    return F.array(*[F.concat(F.lit(prefix), text) for prefix in PREFIXES])


def spacing_variants(text: Column) -> Column:
    """First two words glued together; every gap doubled. Needs more than three words.

    White space is collapsed once and handed to a lambda: a plain column would be collapsed again at each of its uses.
    """
    space, none = F.lit(" "), F.lit("")

    def spaced(line: Column) -> Column:
        gaps = F.length(line) - F.length(F.replace(line, space, none))
        glued = F.overlay(line, none, F.instr(line, space), F.lit(1))
        return F.when(gaps >= 3, F.array(glued, F.replace(line, space, F.lit("  ")))).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(normalize_ws(text)), spaced), F.lit(0))


def typo_variants(text: Column) -> Column:
    """One variant per known word that stands between spaces; all its whole-word uses change."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.array(
        *[
            F.when(
                F.contains(padded, F.lit(f" {word} ")),
                F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}_]){word}(?![\p{{L}}\p{{N}}_])", typo),
            )
            for word, typo in TYPOS
        ]
    )


FAMILIES = {
    "case": case_variants,
    "punctuation": punctuation_variants,
    "prefix": prefix_variants,
    "spacing": spacing_variants,
    "typo": typo_variants,
}


def variants(text: Column, families: tuple[str, ...] = tuple(FAMILIES)) -> Column:
    """All variants of the chosen families; none for texts shorter than ten characters."""
    made = F.concat(*[FAMILIES[name](text) for name in families])
    return F.when(F.length(text) >= MIN_LENGTH, F.filter(made, lambda v: v.isNotNull())).otherwise(
        F.array().cast("array<string>")
    )


#: What variants add or drop: spaces and marks, the ``e`` of ``withe``, and the dot that capital ``\u0130`` has apart from its letter.
_GAPS, _ADDED = SPACES + "".join(END_MARKS), "e\u0307"
_TYPO_LETTERS = "".join(sorted({c for pair in TYPOS for word in pair for c in word.upper()} - {"E"}))
#: Letters whose numbers are a part of the key; they are frequent, and typos change their places alone.
_COUNTED = "AINORST"


def variant_key(text: Column) -> Column:
    """A number that a text has in common with all its variants, so that rows dealt out by it have equal variants together.

    It is the hash of what no variant changes: letters without case, white space, marks and prefixes, of which those that typos
    move are counted, and all others stand in order. Different texts may share a number. Capitals of a text and of its lower case
    may differ, so case is mapped three times, with a step between: Spark leaves out mappings that follow each other directly.
    The lambda is for a single evaluation, as in ``spacing_variants``.
    """
    bare = F.upper(F.translate(F.lower(F.translate(F.upper(text), _GAPS, "")), _ADDED, ""))
    heads = "|".join(prefix.strip().upper().replace("E", "") for prefix in PREFIXES)
    bare = F.regexp_replace(bare, f"^(?:{heads})+", "")

    def hashed(line: Column) -> Column:
        counts = [F.length(F.replace(line, F.lit(c), F.lit(""))) for c in _COUNTED]
        return F.xxhash64(F.translate(line, _TYPO_LETTERS, ""), F.length(line), *counts)

    return F.get(F.transform(F.array(bare), hashed), F.lit(0))
