"""Parameters of the corpus build and of training."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CorpusConfig:
    max_sentences_per_language: int = 500
    max_pages_per_source: int = 3
    max_links_per_page: int = 20
    min_sentence_length: int = 20
    max_sentence_length: int = 200
    min_words: int = 4
    max_digit_share: float = 0.3


# What an interactive collection run uses instead of the library defaults.
QUICK_CORPUS = CorpusConfig(max_sentences_per_language=200, max_pages_per_source=2)


@dataclass(frozen=True)
class TopUpConfig:
    min_total: int = 100
    min_per_language: int = 50
    limit: int = 100


@dataclass(frozen=True)
class TrainConfig:
    max_per_class: int | None = 300
    min_n: int = 2
    max_n: int = 5
    max_features: int = 1500
    min_df: int = 2
    max_df: float = 0.9
    test_size: float = 0.2
    folds: int = 5
    trees: int = 150
    max_depth: int = 25
    min_leaf: int = 2
    seed: int = 42
    fit_on: str = "all"  # "all": vocabulary and idf see the test rows too; "train": they do not
    parallelism: int = 5  # forests fitted at the same time

    def __post_init__(self) -> None:
        if self.fit_on not in ("all", "train"):
            raise ValueError(f"fit_on must be 'all' or 'train', not {self.fit_on!r}")
