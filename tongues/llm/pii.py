"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.native import let

#: Length of an account number by country, from the public IBAN registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
#: Code points on either side of a span in which context words count.
CONTEXT = 40
#: Spans of the added kinds need this score.
THRESHOLD = 70


def iban_pattern() -> str:
    """Account numbers of exactly the registered length, groups set off by single spaces or not."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = [f"(?:{'|'.join(c)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(by_length.items())]
    return f"(?:{'|'.join(forms)})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digits of the results summed: a multiple of ten."""
    places = F.split(F.reverse(digits), "")
    doubled = F.aggregate(
        places, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("i")),
        lambda s, d: F.struct(
            (s["sum"] + F.when(s["i"] % 2 == 0, d.cast("int")).otherwise(F.floor(d.cast("int") / 5).cast("int") + d.cast("int") * 2 % 10)).alias("sum"),
            (s["i"] + 1).alias("i"),
        ),
    )
    return doubled["sum"] % 10 == 0


def mod97(account: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35: one modulo 97."""
    compact = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, 5, 64), F.left(compact, F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda r, c: F.when(c >= "A", (r * 100 + F.ascii(c) - 55) % 97).otherwise((r * 10 + F.ascii(c) - 48) % 97),
    )
    return rest == 1


def _between(low: int, high: int, digits: Column) -> Column:
    return F.char_length(digits).between(low, high)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``pattern`` finds what the plain form of the rule finds, leftmost
    and non-overlapping, but in linear time: possessive repeats never back off, and the
    conditions before a match skip places inside a run that already failed."""

    name: str
    hint: str
    pattern: str
    base: int
    near: str
    bonus: int
    checked: int
    valid: object

    def score(self, context: Column) -> Column:
        """Points of the pattern, of the checksum, and of context words, at most 100."""
        points = F.lit(self.base + self.checked) + F.when(F.lower(context).rlike(self.near), self.bonus).otherwise(0)
        return F.least(points, F.lit(100))


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: The four kinds of the base rule, then those that the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         80, r"mail|contact|write", 10, 0, lambda m: F.lit(True)),
    Kind("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         50, r"\bip\b|address|host|server", 20, 20, lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")),
    Kind("card", "", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
         40, r"card|credit|visa|pay", 20, 40, lambda m: luhn(_digits(m))),
    Kind("phone", "+", r"\+[0-9][ ().0-9-]+[0-9]",
         60, r"phone|tel|call|fax|mobil", 20, 10, lambda m: _between(9, 15, _digits(m))),
    Kind("iban", "", rf"(?<![A-Za-z0-9_]){iban_pattern()}(?![A-Za-z0-9_])",
         40, r"iban|account|konto|bank", 10, 50, mod97),
    Kind("ssn", "-", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
         30, r"ssn|social security", 60, 0, lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$")),
)
_SPAN = "array<struct<start:int,kind:int,end:int,score:int>>"
_BLOCK = 64


def _running(steps: Column) -> Column:
    """Sums of all elements before each one, through sums of blocks, so that long arrays stay cheap."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))

    def add(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda a, x: a + x)

    def spread(sums: Column) -> Column:
        def block(b: Column) -> Column:
            own = F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))
            return let(F.struct(own.alias("own"), add(F.slice(sums, F.lit(1), b)).alias("before")), lambda v: F.transform(
                v["own"], lambda _, i: v["before"] + add(F.slice(v["own"], F.lit(1), i))))

        return F.flatten(F.transform(blocks, block))

    return let(F.transform(blocks, lambda b: add(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))), spread)


def spans_of(text: Column, number: int) -> Column:
    """Spans of one kind, in code points, with the end excluded.

    The pieces of text between matches give the positions: each match starts after the
    pieces and matches before it.
    """
    kind = KINDS[number]
    none = F.array().cast(_SPAN)

    def placed(matches: Column, pieces: Column) -> Column:
        steps = F.transform(matches, lambda m, i: F.char_length(pieces[i]) + F.char_length(m))

        def span(m: Column, i: Column, starts: Column) -> Column:
            start = starts[i] + F.char_length(pieces[i])
            context = F.concat(F.right(pieces[i], F.lit(CONTEXT)), F.lit(" "), F.left(pieces[i + 1], F.lit(CONTEXT)))
            score = kind.score(context)
            good = kind.valid(m) if kind.name in BASE else kind.valid(m) & (score >= THRESHOLD)
            return F.when(good, F.struct(
                start.alias("start"), F.lit(number).alias("kind"), (start + F.char_length(m)).alias("end"), score.alias("score")))

        return let(steps, lambda s: let(_running(s), lambda starts: F.filter(
            F.transform(matches, lambda m, i: span(m, i, starts)), lambda x: x.isNotNull())))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda matches: F.when(
        F.size(matches) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), lambda pieces: placed(matches, pieces))))
    return F.when(F.contains(text, F.lit(kind.hint)), found).otherwise(none) if kind.hint else found


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with ``personal``: an array of ``start, kind, end, score``, by start and then kind.

    Whole texts are read; a null text is empty. Kinds are positions in ``KINDS``. Base kinds
    always count, the others from a score of ``THRESHOLD``. Nothing is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("personal", F.array_sort(F.concat(*[spans_of(text, i) for i in range(len(KINDS))])))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, a digest of their spans, all spans, and their scores."""
    found = find_personal_data(docs.select("doc_id", "text")).select("doc_id", "personal")
    names = F.array(*[F.lit(k.name) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")

    def count(number: int) -> Column:
        return F.size(F.filter("personal", lambda s: s["kind"] == number)).cast("long")

    counts = [count(i).alias(f"n_{n}") for i, n in enumerate(BASE)]
    base = F.filter("personal", lambda s: s["kind"] < len(BASE))
    scores = F.array_join(F.transform("personal", lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("personal")).alias("spans"), scores.alias("scores"))
