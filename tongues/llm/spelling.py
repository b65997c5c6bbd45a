"""Spelling variants: pivotal bigrams of a word, looked up among the rarest bigrams of others, propose words one edit away."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.interim import Interim

#: Words have this many code points and occurrences at least; a form occurs this many times as often as the word.
SHORTEST, LEAST, TIMES = 5, 3, 2
#: One in so many words of a document loses a code point.
SPOILT = 97
#: Edits between near words, and code points of a gram.
EDITS, GRAM = 1, 2
#: Letters are a to z and U+00C0 to U+00FF, so there are 90 times 90 bigrams at most.
_RUN = re.compile("[a-zÀ-ÿ]+")
_FLUSH = 1 << 18

Gram = tuple[int, int]  # rank and position


def words_of(doc_id: str, text: str) -> Counter:
    """The words of a text with their uses: runs of letters, A to Z lower-cased, some without a code point.

    A run loses one when 97 divides the CRC-32 of ``doc_id``, a colon and the run; the same number names the place.
    """
    found: Counter = Counter()
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % SPOILT == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        found[run] += n
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words of ``SHORTEST`` code points that occur ``LEAST`` times; tasks add up their own uses before anything is moved.

    Null texts have no words; a null ``doc_id`` counts as the empty string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, n) for w, n in held.items() if len(w) >= SHORTEST]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(words_of(i, text.as_py()))
                if len(held) >= _FLUSH:
                    yield flush()
        yield flush()

    texts = docs.filter("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Grams from the one in fewest words on, ties in alphabetical order: one row for each pair of the 90 letters at most."""
    at = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.array_distinct(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(GRAM))))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {gram: rank for rank, (_, gram) in enumerate(sorted((r["n"], r["gram"]) for r in rows))}


def gram_prefix(word: str, ranks: dict[str, int], edits: int = EDITS) -> list[Gram]:
    """The grams that come first in rank, so many that ``edits`` cannot touch them all, with all that share the last rank."""
    grams = sorted((ranks[word[i:i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = grams[min(edits * GRAM, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last]


def pivots(prefix: Sequence[Gram], edits: int = EDITS) -> list[Gram]:
    """``edits + 1`` grams of the prefix that do not overlap, of the smallest sum of ranks, by dynamic programming over positions.

    An edit touches one of them at most, so a word within ``edits`` has one of them as it is. Ties go to the first in position.
    """
    grams = sorted(prefix, key=lambda g: g[1])
    # best[k][i]: rank sum and choice of k grams among the first i
    best: list[list[tuple | None]] = [[(0, ())] * (len(grams) + 1)]
    for _ in range(edits + 1):
        row: list[tuple | None] = [None]
        for i, gram in enumerate(grams):
            free = sum(other[1] + GRAM <= gram[1] for other in grams[:i])
            with_it = best[-1][free]
            options = [row[-1]] if row[-1] else []
            if with_it is not None:
                options.append((with_it[0] + gram[0], (*with_it[1], gram)))
            row.append(min(options, key=lambda o: o[0]) if options else None)
        best.append(row)
    found = best[-1][-1]
    if found is None:
        raise ValueError("a prefix of so many grams always has them without overlap")
    return list(found[1])


def _thirds(length: int) -> list[tuple[int, int]]:
    """Code points before and after each third of a word of ``length``."""
    cuts = [length * i // 3 for i in range(4)]
    return [(cuts[i], length - cuts[i + 1]) for i in range(3)]


def _key(gram: int, at: int, own: int, other: int, third: int, before: str, after: str) -> int:
    name = f"{gram} {at} {own} {other} {third} {before} {after}".encode()
    return xxhash.xxh64_intdigest(name) - (1 << 63)


def index_keys(word: str, prefix: Sequence[Gram]) -> set[int]:
    """Keys under which others find ``word``, for each gram of its prefix, each length that they may have, and each third in which the edit may be.

    What lies outside of that third of the other word stands in ``word`` as well, and is a part of the key, so that a frequent gram has many small lists.
    """
    size, found = len(word), set()
    for own in range(max(1, size - EDITS), size + EDITS + 1):
        for third, (before, after) in enumerate(_thirds(own)):
            if before + after <= size:
                parts = word[:before], word[size - after:]
                found.update(_key(gram, at, own, size, third, *parts) for gram, at in prefix)
    return found


def probe_keys(word: str, chosen: Sequence[Gram]) -> set[int]:
    """Keys under which ``word`` looks for others: a pivot stands where it does here, or is moved by the difference in length."""
    size, found = len(word), set()
    for third, (before, after) in enumerate(_thirds(size)):
        parts = word[:before], word[size - after:]
        for other in range(max(1, size - EDITS), size + EDITS + 1):
            for gram, at in chosen:
                found.update(_key(gram, at + moved, size, other, third, *parts) for moved in {0, other - size})
    return found


def _entries(words: DataFrame, ranks: dict[str, int], asking: bool) -> DataFrame:
    """``key, word, n, last`` of the index, or of the questions to it; ``last`` is the rank of the last gram of the prefix."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, last = [], [], []

            def flush(batch=batch):
                at = pa.array(rows, pa.int64())
                columns = [pa.array(keys, pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(last, pa.int32())]
                return pa.RecordBatch.from_arrays(columns, ["key", "word", "n", "last"])

            for i, word in enumerate(batch.column(0).to_pylist()):
                prefix = gram_prefix(word, shared.value)
                found = probe_keys(word, pivots(prefix)) if asking else index_keys(word, prefix)
                keys += found
                rows += [i] * len(found)
                last += [prefix[-1][0]] * len(found)
                if len(keys) >= _FLUSH:
                    yield flush()
                    rows, keys, last = [], [], []
            yield flush()

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long, last int")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n`` of every two words that differ by one code point inserted, deleted or replaced, in both directions.

    Of two near words, that whose prefix ends first in rank (ties: in alphabet) asks: a pivot of its own that the edit leaves alone is in the other's
    prefix, at the same place or moved by the difference in length. Candidates agree outside of the third that holds the
    edit as well; the edit distance decides.

    Spark takes the entries for about as large as the words' files, though each word has dozens, and would send the index whole
    through the driver. So all joins here are hinted to sort and merge: what is joined grows with the words.
    """
    ranks = gram_ranks(words)
    asking, index = _entries(words, ranks, True), _entries(words, ranks, False).toDF("key", "near", "near_n", "near_last")
    first = (F.col("last") < F.col("near_last")) | ((F.col("last") == F.col("near_last")) & (F.col("word") < F.col("near")))
    pairs = asking.join(index.hint("merge"), "key").filter(first & (F.levenshtein("word", "near", EDITS) == 1))
    pairs = pairs.select("word", "n", "near", "near_n").distinct()
    both = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def follow(forms: DataFrame, keep: Interim) -> DataFrame:
    """``word, root``: the last form reached from each word that has a ``form``.

    Pointers double with each round. A form occurs at least twice as often as its word, so chains have at most as many
    steps as a count has bits, and a handful of rounds is enough.
    """
    rounds, now = 0, keep("roots0", forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = now.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        rounds += 1
        then = keep(f"roots{rounds}", then)
        keep.drop(now.sparkSession, f"roots{rounds - 1}")
        now = then.drop("moved")
        if then.filter("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``, as ``word_counts`` has them.

    ``form`` is the near word that occurs most often (ties: the smallest in code-point order) if it occurs ``TIMES`` times as often as the word,
    else null; ``root`` is reached from the word over forms, and the word itself if it has none. Repeated rows count each; other
    columns are not read.
    """
    keep = Interim("spelling")
    words = keep("words", word_counts(docs))
    near = near_words(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = keep("near", near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    joined = words.join(near.hint("merge"), "word", "left").withColumn("_n", -F.col("best.less"))
    found: Column = F.col("_n") >= TIMES * F.col("n")
    rows = keep("forms", joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(found, F.col("best.form")).alias("form"), F.when(found, F.col("_n")).alias("form_n"),
    ))
    roots = follow(rows.filter("form IS NOT NULL"), keep)
    return rows.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
