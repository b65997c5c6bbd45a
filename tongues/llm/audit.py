"""Filter interaction audit: count-weighted decision diagrams of failure masks, one per part, in every order of the filters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.interim import Interim

FILTERS = "ABCDE"
#: Least words, least share of distinct words and largest share of capitals in hundredths, and signs that no text may hold.
LEAST_WORDS, DISTINCT, CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"
_WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = ("n", "good", "toxic")

Weight = tuple[int, ...]


class Node:
    """A test of one filter: ``passed`` and ``failed`` lead on, to a node, a weight, or nothing where no document goes."""

    __slots__ = ("passed", "failed", "weight")

    def __init__(self, passed, failed):
        self.passed, self.failed = passed, failed
        self.weight = tuple(map(sum, zip(*(w for w in (weight_of(passed), weight_of(failed)) if w))))


def weight_of(node) -> Weight | None:
    return node.weight if isinstance(node, Node) else node


class Diagram:
    """Weights by failure mask as an ordered diagram with one level for each filter.

    Every path has all levels, so no weight is lost where both branches of a node are equal; nodes of equal branches are shared
    within a level. ``levels[i]`` holds the nodes that test the ``i``-th filter of ``order`` by their branches.
    """

    def __init__(self, masks: dict[int, Weight], filters: str = FILTERS):
        self.order = list(filters)
        self.levels: list[dict[tuple, Node]] = [{} for _ in filters]
        self.zero = (0,) * len(next(iter(masks.values()), WEIGHTS))
        self.shared: dict[Weight, Weight] = {}
        self.root = self._build(masks, 0, 0)

    def _build(self, masks: dict[int, Weight], level: int, mask: int):
        if level == len(self.order):
            found = masks.get(mask)
            return self.shared.setdefault(found, found) if found and any(found) else None
        return self._node(level, self._build(masks, level + 1, mask), self._build(masks, level + 1, mask | 1 << level))

    def _node(self, level: int, passed, failed) -> Node | None:
        if passed is None and failed is None:
            return None
        key = (id(passed), id(failed))
        if key not in self.levels[level]:
            self.levels[level][key] = Node(passed, failed)
        return self.levels[level][key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one.

        Only the nodes of these two levels change: those above keep their branches, as a node
        of the upper level stays the same function and the same object; those below are shared as before.
        """
        upper, self.levels[level], self.levels[level + 1] = list(self.levels[level].values()), {}, {}
        for node in upper:
            (pp, pf), (fp, ff) = ((b.passed, b.failed) if b is not None else (None, None) for b in (node.passed, node.failed))
            node.passed, node.failed = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.levels[level][id(node.passed), id(node.failed)] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> list[tuple[Weight, Weight]]:
        """What stays and what goes at each level of the path on which every filter is passed."""
        steps, at = [], self.root
        for _ in self.order:
            kept, gone = (at.passed, at.failed) if at is not None else (None, None)
            steps.append((weight_of(kept) or self.zero, weight_of(gone) or self.zero))
            at = kept
        return steps


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions whose swaps with the next one lead through all orders of ``n`` things, each once: the last thing
    walks through every order of the others, to and fro."""
    if n < 2:
        return
    walk = list(range(n - 2, -1, -1))
    inner = adjacent_swaps(n - 1)
    while True:
        yield from walk
        at = next(inner, None)
        if at is None:
            return
        yield at + (walk[0] != 0)
        walk = walk[::-1]


def audit_part(masks: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of every order and step, by order."""
    diagram = Diagram(masks, filters)
    fails = {f: sum(w[0] for m, w in masks.items() if m >> i & 1) for i, f in enumerate(filters)}
    alone = {f: masks.get(1 << i, diagram.zero)[0] for i, f in enumerate(filters)}
    share = dict.fromkeys(filters, 0)
    rows = []

    def read() -> None:
        order = "".join(diagram.order)
        for step, (kept, gone) in enumerate(diagram.all_pass()):
            f = order[step]
            share[f] += gone[0]
            rows.append((order, step + 1, kept[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], f))

    read()
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        read()
    return sorted((*row[:-1], share[row[-1]]) for row in rows)


def text_masks(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; the text is not null."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bits(w: Column) -> Column:
        fails = (
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)) < DISTINCT * F.size(w),
            100 * capitals > CAPITALS * F.char_length(text),
            text.rlike(SIGNS),
        )
        return reduce(Column.bitwiseOR, [F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(fails)])

    return F.transform(F.array(words), bits)[0]


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by source and set of filters that they fail, 32 rows a part at most.

    A null text is empty, a null source the empty string. A document fails E when a smaller ``doc_id`` has the same text; a null id is
    neither smaller than another nor has one a smaller id than it. A document is good or toxic when any of its labels says so; labels of
    null ids or of no document count nowhere. Texts are known by their SHA-256, so only narrow rows are shuffled. Copies of a text
    find its smallest id through partial minima, and the one that has it by a join on both, which has no hot key.
    """
    keep, spark = Interim("audit"), docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("doc"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text_masks(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("doc")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic"),
    )
    rows = keep("rows", rows.groupBy("doc", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")))
    named = rows.filter("doc IS NOT NULL").join(known, "doc", "left").select("doc", "part", "mask", "digest", "n", "good", "toxic")
    nameless = rows.filter("doc IS NULL").select("doc", "part", "mask", "digest", "n", F.lit(None).cast("long").alias("good"), F.lit(None).cast("long").alias("toxic"))
    rows = keep("labelled", named.unionByName(nameless))
    first = rows.filter("doc IS NOT NULL").groupBy("digest").agg(F.min("doc").alias("doc"))
    passing = rows.join(first, ["digest", "doc"], "left_semi").unionByName(rows.filter("doc IS NULL"), allowMissingColumns=True)

    def counted(some: DataFrame, bit: int, sign: int) -> DataFrame:
        weights = [F.sum(sign * F.col("n") * (F.lit(1) if w == "n" else F.coalesce(w, F.lit(0)))).alias(w) for w in WEIGHTS]
        return some.groupBy("part", F.col("mask").bitwiseOR(F.lit(bit)).alias("mask")).agg(*weights)

    # those that fail E are all less those that pass it
    late = 1 << FILTERS.index("E")
    counts = counted(passing, 0, 1).unionByName(counted(rows, late, 1)).unionByName(counted(passing, late, -1))
    counts = keep("masks", counts.groupBy("part", "mask").agg(*[F.sum(w).alias(w) for w in WEIGHTS]).filter("n > 0"))
    keep.drop(spark, "rows", "labelled")
    return counts


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
    "toxic_lost long, shapley long"
)


def audit_steps(masks: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from ``failure_masks``.

    A part's masks, 32 rows at most, become a diagram; each adjacent swap of two levels leads to another order, 120 in all, and
    the path on which all filters are passed tells what each step keeps and removes.
    """

    def run(table: pa.Table) -> pa.Table:
        columns = table.to_pydict()
        weights = zip(*(columns[w] for w in WEIGHTS))
        rows = audit_part({m: w for m, w in zip(columns["mask"], weights)})
        names = [f.split()[0] for f in STEPS.split(", ")]
        found = dict(zip(names[1:], map(list, zip(*rows))))
        kinds = dict.fromkeys(names, pa.int64()) | {"filter_order": pa.string(), "step": pa.int32()}
        part = pa.array(np.repeat(np.array([columns["part"][0]], dtype=object), len(rows)), pa.string())
        return pa.table({"part": part, **{k: pa.array(v, kinds[k]) for k, v in found.items()}})

    return masks.groupBy("part").applyInArrow(run, STEPS)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``: 600 rows for each source that a document has; none for no documents.

    Repeated rows count each; other columns are not read. See ``failure_masks`` for nulls.
    """
    return audit_steps(failure_masks(docs, labels))
