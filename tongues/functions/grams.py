"""Character n-grams of one text: the row-level helper behind postings and vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np

WORD_CACHE = 100_000
GRAM_CACHE = 1_000_000  # n-grams of all remembered words
FOLD = 1 << 15  # words whose terms are worked on at a time
CACHED_LENGTH = 64
#: Texts, and code points of texts, whose terms are counted together.
SLICE_TEXTS, SLICE_CHARS = 2_000, 250_000


def word_grams(word: str, min_n: int, max_n: int) -> list[str]:
    """All n-grams of a word padded with one space on both sides."""
    padded = f" {word} "
    return [padded[i : i + n] for n in range(min_n, max_n + 1) for i in range(len(padded) - n + 1)]


def cached(lookup: Callable[[str], list]) -> Callable[[str], list]:
    """Remember the result for ordinary words; the memory is emptied when full."""
    memory: dict[str, list] = {}
    held = 0

    def get(word: str) -> list:
        nonlocal held
        found = memory.get(word)
        if found is None:
            found = lookup(word)
            if len(word) <= CACHED_LENGTH:
                if len(memory) >= WORD_CACHE or held >= GRAM_CACHE:
                    memory.clear()
                    held = 0
                memory[word] = found
                held += len(found)
        return found

    return get


def count_grams(text: str | None, grams: Callable[[str], list]) -> dict:
    """Uses of each n-gram (or whatever ``grams`` yields for a word) in a text."""
    uses: dict[str, int] = {}
    for word in (text or "").lower().split():
        uses[word] = uses.get(word, 0) + 1
    counts: dict = {}
    for word, times in uses.items():
        for gram in grams(word):
            counts[gram] = counts.get(gram, 0) + times
    return counts


def slices(texts: Sequence[str | None], most: int = SLICE_TEXTS, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that are small enough to be worked on at once; a long text is one of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (held + size > chars or i - start >= most):
            yield start, i
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts)


class TermCounter:
    """Uses of vocabulary terms in a batch of texts, as flat arrays; a word's terms are looked up once and remembered.

    The memory is a table of words that starts anew when it is full; words too long to remember are looked up each time.
    """

    def __init__(self, terms: Sequence[str], min_n: int, max_n: int):
        self.index = {term: i for i, term in enumerate(terms)}
        self.size, self.min_n, self.max_n = len(terms), min_n, max_n
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.terms: list[np.ndarray] = []

    def _place(self, word: str) -> int:
        self.terms.append(np.array([self.index[g] for g in word_grams(word, self.min_n, self.max_n) if g in self.index], dtype=np.int64))
        if len(word) <= CACHED_LENGTH:
            self.places[word] = len(self.terms) - 1
        return len(self.terms) - 1

    def count(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, term, uses)`` of every term that a text has, in order of row and term.

        Words are worked on ``FOLD`` at a time, so a long text needs little more memory than a short one.
        """
        parts, rows, found = [], [], []
        most = min(FOLD, WORD_CACHE)

        def fold() -> None:
            parts.append(self._fold(np.repeat(*np.array(rows).T), np.array(found)))
            rows.clear()
            found.clear()
            if len(self.terms) >= WORD_CACHE:
                self._forget()

        for row, text in enumerate(texts):
            words = (text or "").lower().split()
            for at in range(0, len(words), most):
                some = words[at:at + most]
                rows.append((row, len(some)))
                found += [self.places[w] if w in self.places else self._place(w) for w in some]
                if len(found) >= most:
                    fold()
        if found:
            fold()
        if not parts:
            return (np.empty(0, np.int64),) * 3
        keys, uses = parts[0] if len(parts) == 1 else _summed(*map(np.concatenate, zip(*parts)))
        return *np.divmod(keys, max(self.size, 1)), uses

    def _fold(self, row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``row * size + term`` with its uses, in order: equal words of a text are counted first, then equal terms of its words."""
        keys, uses = np.unique(row * len(self.terms) + word, return_counts=True)
        row, word = np.divmod(keys, len(self.terms))
        used, word = np.unique(word, return_inverse=True)
        lists = [self.terms[i] for i in used.tolist()]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat, starts, each = np.concatenate(lists), np.cumsum(sizes) - sizes, sizes[word]
        at = np.repeat(starts[word] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        return _summed(np.repeat(row, each) * max(self.size, 1) + flat[at], np.repeat(uses, each))


def _summed(keys: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sum of their uses."""
    if not len(keys):
        return keys, uses
    order = np.argsort(keys, kind="stable")
    keys, uses = keys[order], uses[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(uses, first)
