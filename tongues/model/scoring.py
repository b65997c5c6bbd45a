"""Calibrated probabilities of a batch of texts in one pass: features, every forest and every sigmoid.

MLlib scores row by row, one forest after another, so for each row all trees of all folds pass through the
processor's memory. Here a block of rows goes down all trees of all folds together, and the texts are read once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tongues.model.vectors import BatchFeatures, stat_columns
from tongues.sources.scratch import discard, scratch

Sigmoid = tuple[int, int, float, float]  # fold, class index, slope, intercept
BLOCK = 64  # rows that go down the trees together
TOP = 2  # levels of a tree whose nodes are all tested for all rows


@dataclass
class Forest:
    """The nodes of all trees of a forest. ``child`` has the left and the right child of node ``i`` at ``2 * i``
    and the next place; a leaf has no feature, ``-1``, and the share of each class in ``share``."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    share: np.ndarray

    @classmethod
    def read(cls, spark: SparkSession, directory: str) -> Forest:
        """From a saved MLlib forest; its nodes are bounded by the rows that it was fitted on, not by those it scores."""
        rows = spark.read.parquet(f"{directory}/data").select(
            "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.impurityStats",
            "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories",
        ).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()

        def column(name: str) -> np.ndarray:
            return rows[name].to_numpy()

        if (column("numCategories")[column("leftChild") >= 0] != -1).any():
            raise ValueError("a forest with categorical splits")
        tree = column("treeID")
        roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
        shift = roots[np.searchsorted(roots, np.arange(len(tree)), "right") - 1]
        if (column("id") + shift != np.arange(len(tree))).any():
            raise ValueError("nodes of a tree are not numbered one by one")
        leaf = column("leftChild") < 0
        feature = np.where(leaf, -1, column("featureIndex")).astype(np.int64)
        bounds = rows["leftCategoriesOrThreshold"].combine_chunks()
        first = bounds.offsets.to_numpy()[:-1]
        values = np.append(bounds.values.to_numpy(), 0.0)
        threshold = np.where(leaf, 0.0, values[np.where(leaf, len(values) - 1, first)])
        child = np.column_stack([column("leftChild") + shift, column("rightChild") + shift]).ravel()
        counts = np.array(rows["impurityStats"].to_pylist(), dtype=np.float64)
        total = counts.sum(1, keepdims=True)
        return cls(roots, feature, threshold, child, np.divide(counts, total, out=np.zeros_like(counts), where=total != 0))

    @classmethod
    def of(cls, spark: SparkSession, model: RandomForestClassificationModel) -> Forest:
        path = scratch(spark, "forest")
        model.write().save(path)
        try:
            return cls.read(spark, path)
        finally:
            discard(spark, path)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Class probabilities of dense rows: the mean of the trees' shares."""
        walked = Forests([self])
        blocks = [rows[at:at + BLOCK] for at in range(0, max(len(rows), 1), BLOCK)]
        return np.concatenate([walked.probabilities(np.ascontiguousarray(block.T))[0] for block in blocks])


class Forests:
    """Forests that are walked together. Leaves are their own children, so a walk may go on at a leaf.

    In the ``TOP`` first levels every node is tested for all rows, which takes whole columns of features; below, each row has its
    own node, and those that have come to a leaf are left out after every two steps.
    """

    def __init__(self, forests: Sequence[Forest]):
        shift = np.cumsum([0, *(len(f.feature) for f in forests)])[:-1]
        feature = np.concatenate([f.feature for f in forests])
        child = np.concatenate([f.child + at for f, at in zip(forests, shift)]).reshape(-1, 2)
        self.leaf = feature < 0
        child[self.leaf] = np.flatnonzero(self.leaf)[:, None]
        self.child = child.ravel().astype(np.int32)
        self.feature = np.where(self.leaf, 0, feature).astype(np.int32)  # times ``BLOCK`` it fits as well
        self.threshold = np.where(self.leaf, np.inf, np.concatenate([f.threshold for f in forests]))
        self.share = np.concatenate([f.share for f in forests])
        self.ends = np.cumsum([len(f.roots) for f in forests])[:-1]  # of the forests, among all trees
        nodes = np.concatenate([f.roots + at for f, at in zip(forests, shift)])[:, None]
        self.trees, self.top = len(nodes), []
        for _ in range(TOP):
            self.top.append([(self.feature[level], self.threshold[level][:, None]) for level in nodes.T])
            nodes = self.child[2 * nodes[:, :, None] + np.arange(2)].reshape(self.trees, -1)
        self.below = nodes.ravel()

    def leaves(self, columns: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree; ``columns`` has a row of numbers for each feature, of ``BLOCK`` texts at most."""
        n = columns.shape[1]
        turns: list[np.ndarray] = []
        at = np.zeros((self.trees, n), np.int32)
        for level in self.top:
            tests = [columns.take(feature, 0) > threshold for feature, threshold in level]
            for turn in turns:
                half = len(tests) // 2
                tests = [np.where(turn, right, left) for left, right in zip(tests[:half], tests[half:])]
            turns += tests
            at += at
            at += tests[0]
        at += np.arange(self.trees, dtype=np.int32)[:, None] << TOP
        found = self.below.take(at)
        flat, node = columns.ravel(), found.ravel()
        going = np.flatnonzero(~self.leaf.take(node))
        at, row = node.take(going), (going % n).astype(np.int32)
        while len(going):
            for _ in range(2):
                right = flat.take(self.feature.take(at) * n + row) > self.threshold.take(at)
                at = self.child.take(2 * at + right)
            node[going] = at
            still = np.flatnonzero(~self.leaf.take(at))
            going, at, row = going.take(still), at.take(still), row.take(still)
        return found

    def probabilities(self, columns: np.ndarray) -> np.ndarray:
        """Class probabilities by forest, row and class: the mean of the shares of a forest's trees."""
        shares = self.share.take(self.leaves(columns), 0)
        votes = np.stack([own.sum(0) for own in np.split(shares, self.ends)])
        total = votes.sum(2, keepdims=True)
        return np.divide(votes, total, out=votes, where=total > 0)


def calibrated(scores: Sequence[np.ndarray], sigmoids: Sequence[Sigmoid], k: int) -> np.ndarray:
    """Mean over folds of the normalised sigmoid outputs of each fold's class probabilities."""
    lines = {(fold, c): (slope, intercept) for fold, c, slope, intercept in sigmoids}
    total = 0.0
    for fold, score in enumerate(scores):
        member = np.zeros((len(score), k))
        for c in [1] if k == 2 else range(k):
            slope, intercept = lines[fold, c]
            with np.errstate(over="ignore"):
                member[:, c] = 1.0 / (1.0 + np.exp(-(score[:, c] * slope + intercept)))
        if k == 2:
            member[:, 0] = 1.0 - member[:, 1]
        else:
            sums = member.sum(1, keepdims=True)
            member = np.divide(member, sums, out=np.full_like(member, 1.0 / k), where=sums > 0)
        total = total + member
    return total / len(scores)


def score_texts(
    df: DataFrame,
    terms: Sequence[tuple[str, float]],
    forests: Sequence[Forest],
    sigmoids: Sequence[Sigmoid],
    classes: int,
    text: str = "text",
    output: str = "probabilities",
    min_n: int = 2,
    max_n: int = 5,
) -> DataFrame:
    """``df`` with the probability of each class. Row-local: no shuffle, same in a stream."""
    kept = [f for f in df.schema.fields if f.name != output]
    names, numbers = [f.name for f in kept], stat_columns(text)
    extra = len(numbers)
    schema = T.StructType([*kept, T.StructField(output, T.ArrayType(T.DoubleType()))])
    model = df.sparkSession.sparkContext.broadcast((list(terms), list(forests), list(sigmoids)))  # as large as the model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, trees, lines = model.value
        features, walked = BatchFeatures(vocabulary, min_n, max_n, extra), Forests(trees)
        dense = np.zeros((features.size, BLOCK))
        for batch in batches:
            for start, stop, row, place, value in features.slices(batch, names.index(text)):
                scores = np.empty((len(trees), stop - start, classes))
                for at in range(0, stop - start, BLOCK):
                    a, b = np.searchsorted(row, [at, at + BLOCK])
                    dense[place[a:b], row[a:b] - at] = value[a:b]
                    scores[:, at:at + BLOCK] = walked.probabilities(dense)[:, :stop - start - at]
                    dense[place[a:b], row[a:b] - at] = 0.0
                found = calibrated(scores, lines, classes)
                offsets = pa.array(np.arange(stop - start + 1) * classes, pa.int32())
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=schema.names)

    return df.withColumns(numbers).select(*names, *numbers).mapInArrow(run, schema)
