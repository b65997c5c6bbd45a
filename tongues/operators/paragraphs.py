"""HTML bodies to paragraphs and sentences. Each page is read on its own; nothing is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.config import CorpusConfig
from tongues.functions import html as H

DEFAULT = CorpusConfig()
FLUSH_CHARS = 8_000_000  # hand rows to Spark in slices of about this much text


def _read(pages: DataFrame, rules: DataFrame, keep, position: str, extract) -> DataFrame:
    fields = [pages.schema[name] for name in keep]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    columns = [*keep, position, "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for batch in batches:
            for *key, include, exclude, html in batch.itertuples(index=False, name=None):
                for pos, text in enumerate(extract(html, tuple(include), tuple(exclude))):
                    rows.append((*key, pos, text))
                    size += len(text)
                    if size > FLUSH_CHARS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    ruled = pages.join(F.broadcast(rules), "language").select(*keep, "include", "exclude", "html")
    return ruled.mapInPandas(run, f"{schema}, {position} long, text string")


def extract_paragraphs(pages: DataFrame, rules: DataFrame, keep=("page_id", "language")) -> DataFrame:
    """Text of every selected element outside excluded ones, selector by selector.

    Nested elements repeat their text, as each is selected in its own right.
    """
    return _read(pages, rules, list(keep), "para_pos", H.paragraphs)


def page_sentences(
    pages: DataFrame, rules: DataFrame, keep=("page_id", "language"), config: CorpusConfig = DEFAULT
) -> DataFrame:
    """Different raw sentences of a page: paragraphs split at their ends, repeats removed.

    Equal to splitting ``extract_paragraphs`` and keeping distinct sentences of usable
    length, but linear in the page when elements are nested.
    """
    limit = config.max_sentence_length

    def extract(html, include, exclude):
        return H.sentence_pieces(html, include, exclude, limit)

    return _read(pages, rules, list(keep), "sentence_pos", extract)
