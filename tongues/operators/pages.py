"""Pages to nested narrow records in one pass: what a page links to and the sentences that each rule finds in it.

Everything after this works on records; page bodies are read once and never move.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tongues.config import CorpusConfig
from tongues.functions import html as H
from tongues.operators.sentences import clean_sentences

DEFAULT = CorpusConfig()
MAX_RULES = 63  # a sentence's rules are bits of a long
FLUSH_CHARS = 8_000_000  # hand rows to Spark in slices of about this much text
_RECORD = "anchors string, links array<struct<href string, start int, size int>>, sentences array<struct<text string, rules long>>"


def rule_bits(rules: DataFrame) -> tuple[list[H.Rule], dict[str, int]]:
    """The different rules of the dimension, which has a row per configured language, and each language's place among them."""
    rows = rules.select("language", "include", "exclude").collect()
    named = {r["language"]: (tuple(r["include"]), tuple(r["exclude"])) for r in sorted(rows)}
    distinct = list(dict.fromkeys(named.values()))
    if len(distinct) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} different extraction rules")
    return distinct, {language: distinct.index(rule) for language, rule in named.items()}


def page_records(pages: DataFrame, rules: Sequence[H.Rule] = (), keep: Sequence[str] = ("page_id", "url"), config: CorpusConfig = DEFAULT) -> DataFrame:
    """``keep``, ``anchors``, ``links`` and ``sentences`` of every page: each is parsed once, for all ``rules``.

    A link has its ``href`` and the place of its text in ``anchors``. A sentence has the bits of the rules that
    select it; it is as on the page, white space collapsed, and not longer than a usable one. Rows leave in slices, so a batch of
    large pages is not held as a whole.
    """
    fields = [pages.schema[name] for name in keep]
    schema = T.StructType([*fields, *T._parse_datatype_string(_RECORD).fields])
    rules, limit = tuple(rules), config.max_sentence_length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selection = H.Selection(rules)
        for batch in batches:
            first, held, anchors, links, sentences = 0, 0, [], [], []

            def flush(upto, batch=batch):
                columns = [batch.column(i).slice(first, upto - first) for i in range(len(keep))]
                columns += [pa.array(anchors, pa.string()), _nested(links, _LINK), _nested(sentences, _SENTENCE)]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for row, html in enumerate(batch.column(len(keep))):
                text, found, pieces = H.read_page(html.as_py() or "", selection, limit)
                anchors.append(text)
                links.append(found)
                sentences.append(list(pieces.items()))
                held += len(text) + sum(map(len, pieces)) + 100 * len(found)
                if held >= FLUSH_CHARS:
                    yield flush(row + 1)
                    first, held, anchors, links, sentences = row + 1, 0, [], [], []
            if anchors:
                yield flush(batch.num_rows)

    return pages.select(*keep, "html").mapInArrow(run, schema)


_LINK = [("href", pa.string()), ("start", pa.int32()), ("size", pa.int32())]
_SENTENCE = [("text", pa.string()), ("rules", pa.int64())]


def _nested(rows: list[list[tuple]], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    """Rows of tuples as an array of structs each, column by column."""
    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    columns = zip(*(item for row in rows for item in row)) if offsets[-1] else [()] * len(fields)
    arrays = [pa.array(list(values), kind) for values, (_, kind) in zip(columns, fields)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, names=[n for n, _ in fields]))


def anchor(link: Column) -> Column:
    """Lower-cased text of a link of a record."""
    return F.lower(F.substring(F.col("anchors"), link["start"] + 1, link["size"]))


def rule_texts(bits: dict[str, int]) -> Column:
    """Of a record, the sentences that the rule of the row's ``language`` selects; none where it has no rule."""
    bit = F.lit(0).cast("long")
    for language, place in bits.items():
        bit = F.when(F.col("language") == language, F.lit(1 << place).cast("long")).otherwise(bit)
    return F.transform(F.filter("sentences", lambda s: s["rules"].bitwiseAND(bit) != 0), lambda s: s["text"])


def record_sentences(records: DataFrame, bits: dict[str, int], keep: Sequence[str] = ("page_id", "language"), config: CorpusConfig = DEFAULT) -> DataFrame:
    """Clean sentences of records for the ``language`` of each row, as ``(keep, text)``; languages without a rule have none."""
    return clean_sentences(records.select(*keep, F.explode(rule_texts(bits)).alias("text")), config)
