"""Text expressions with the Unicode rules the corpus and the features rely on.

Java's ``\\s`` and ``\\d`` cover fewer code points than the rules ask for, so the
classes are spelled out. The same classes are valid in RE2, which the SQL checks use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 white-space code points.
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

NOT_WS = WS.replace("[", "[^", 1)

# Decimal digits, those newer than the Java tables, and digit-valued signs.
DIGIT = (
    r"[\p{Nd}\x{11f50}-\x{11f59}\x{16ac0}-\x{16ac9}\x{1e4f0}-\x{1e4f9}"
    r"\xb2\xb3\xb9\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}"
    r"\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}]"
)

#: The same classes as characters: ``translate`` replaces or drops them faster than a regular expression finds them.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
DIGITS = "".join(c for c in map(chr, range(0x110000)) if c.isdigit())

SENTENCE_END = r"(?<=[.!?])" + WS + "+"


def strip(text: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.regexp_replace(text, rf"^{WS}+|{WS}+\z", "")


def normalize_ws(text: Column) -> Column:
    """Collapse white-space runs to one space and trim."""
    return F.trim(F.regexp_replace(F.translate(text, SPACES, " " * len(SPACES)), " {2,}", " "))


def words(text: Column) -> Column:
    """White-space separated words, empty array for blank text."""
    return F.filter(F.split(text, WS + "+"), lambda w: w != "")


def letter_count(text: Column) -> Column:
    """Characters inside words."""
    return F.length(F.replace(normalize_ws(text), F.lit(" "), F.lit(""))).cast("long")


def word_count(text: Column) -> Column:
    """Words, from the same collapsed text as ``letter_count``.

    The sum has no branches, so the collapsed text is a common part that is computed once.
    """
    letters = letter_count(text)
    return (F.length(normalize_ws(text)) - letters + (letters > 0).cast("long")).cast("long")


def has_words(text: Column, n: int) -> Column:
    """At least ``n`` words; stops at the ``n``-th."""
    return text.rlike(rf"^{WS}*+(?:{NOT_WS}++{WS}++){{{n - 1}}}{NOT_WS}")


def count_matches(text: Column, char_class: str) -> Column:
    """How many characters of ``text`` fall in a one-character regex class."""
    return (F.length(text) - F.length(F.regexp_replace(text, char_class + "+", ""))).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def count_phrase(text: Column, phrase: str) -> Column:
    """Non-overlapping occurrences of ``phrase``, scanned from the left."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))
    return F.floor(removed / len(phrase)).cast("long")


def digit_count(text: Column) -> Column:
    return count_chars(text, DIGITS)


def has_url(text: Column) -> Column:
    lowered = F.lower(text)
    return F.contains(lowered, F.lit("http://")) | F.contains(lowered, F.lit("https://"))


def has_email(text: Column) -> Column:
    """An ``@`` with a dot somewhere after the last one."""
    return F.contains(text, F.lit("@")) & F.contains(F.substring_index(text, "@", -1), F.lit("."))


def capitalize_first(text: Column) -> Column:
    """Upper-case the first character when it is a letter (full mapping, so it may grow)."""
    upper = F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
    return F.when(text.rlike(r"^\p{L}"), upper).otherwise(text)
