"""Nearest neighbours by largest inner product, with vantage-point trees in shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tongues.sources.scratch import stored

K = 20
#: Vectors in one tree, queries that pass through it at a time, and vectors in a leaf.
SHARD = 16_384
QUERIES = 1_024
LEAF = 256
#: A far branch is visited when the least distance that the triangle inequality leaves is within this
#: share of the k-th distance so far. One is exact; less visits fewer branches.
FACTOR = 1.0
_SLACK, _MOST = 1e-7, np.finfo(np.float64).max


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(vectors: np.ndarray, exponent: np.ndarray | int) -> np.ndarray:
    """``vectors`` by a power of two: exact, but for components that are nothing beside the largest."""
    return np.ldexp(vectors, -np.asarray(exponent))


def _exponents(vectors: np.ndarray) -> np.ndarray:
    """The exponent of each vector's largest component, so that scaled by it no square overflows, nor does the largest vanish."""
    return np.frexp(np.abs(vectors).max(1))[1]


class VPTree:
    """A tree over the rows of ``vectors``, which are in order of ``ids``.

    Largest inner product becomes smallest distance on the unit sphere: every vector is divided
    by the largest length in the tree and gets one more component that fills it up to length one. Lengths and distances are of vectors
    scaled by a power of two, so components of any finite size will do.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.exponent = int(_exponents(vectors).max())
        self.small = _scaled(self.vectors, self.exponent)
        self.largest = float(np.sqrt((self.small ** 2).sum(1)).max())
        scaled = self.small / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled ** 2).sum(1)))
        self.points = np.column_stack([scaled, rest])
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        vantage = self.points[rows[len(rows) // 2]]
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.points[rows] @ vantage)))
        inside = d <= np.median(d)
        if inside.all():  # copies of one vector
            inside = d < d.max()
            if not inside.any():
                return rows
        near, far = d[inside], d[~inside]
        return vantage, float(near.max()), float(far.min()), self._build(rows[inside]), self._build(rows[~inside])

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float):
        """``(query, row, score)`` arrays of the best ``k`` per query, its own id left out."""
        own = _exponents(vectors)
        small = _scaled(vectors, own[:, None])
        lengths = np.sqrt((small ** 2).sum(1))
        asked = np.column_stack([small / lengths[:, None], np.zeros(len(ids))])
        length = lengths * self.largest
        # scores are of the vectors as they are: what rounds to the k-th score or to zero may be as good
        shift = own + self.exponent
        blur = np.ldexp(float(vectors.shape[1]), np.minimum(-1074 - shift, 1000)) + _SLACK * length
        with np.errstate(over="ignore"):
            blur[~np.isfinite(np.ldexp(length * vectors.shape[1], shift))] = np.inf  # sums on the way may overflow whatever the whole is
        worst = np.full(len(ids), -np.inf)
        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]

        def least(who: np.ndarray) -> np.ndarray:
            """What a scaled inner product needs to reach the k-th score."""
            finite = np.clip(worst[who], -_MOST, _MOST)
            with np.errstate(over="ignore"):
                return np.where(worst[who] == -np.inf, -np.inf, np.ldexp(finite, -shift[who])) - blur[who]

        def offer(rows: np.ndarray, active: np.ndarray) -> None:
            # a fast product proposes; what can reach the best k is scored in order of components, so that
            # equal vectors score equal
            rough = small[active] @ self.small[rows].T
            rough[self.ids[rows][None, :] == ids[active][:, None]] = -np.inf
            bar = least(active)
            if len(rows) > k:
                bar = np.maximum(bar, -np.partition(-rough, k - 1, axis=1)[:, k - 1] - 2 * blur[active])
            q, c = np.nonzero((rough >= bar[:, None]) & (rough > -np.inf))
            found = np.zeros(len(q))
            with np.errstate(over="ignore", invalid="ignore"):
                for j in range(vectors.shape[1]):
                    found += vectors[active[q], j] * self.vectors[rows[c], j]
            good = found >= worst[active[q]]
            q, c, found = q[good], c[good], found[good]
            if not len(q):
                return
            touched = np.zeros(len(ids), bool)
            touched[active[np.unique(q)]] = True
            old = touched[best[0]]
            query = np.concatenate([best[0][old], active[q]])
            row = np.concatenate([best[1][old], rows[c]])
            score = np.concatenate([best[2][old], found])
            order = np.lexsort((row, -score, query))
            query, row, score = query[order], row[order], score[order]
            starts = np.searchsorted(query, query)
            rank = np.arange(len(query)) - starts
            full = query[rank == k - 1]
            worst[full] = score[rank == k - 1]
            keep = rank < k
            best[:] = [np.concatenate([b[~old], new[keep]]) for b, new in zip(best, (query, row, score))]

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                offer(node, active)
                return
            vantage, inner, outer, near, far = node
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (asked[active] @ vantage)))
            first = d <= (inner + outer) / 2
            visit(near, active[first])
            visit(far, active[~first])

            def open_(apart: np.ndarray, who: np.ndarray) -> np.ndarray:
                cosine = np.clip(least(who) / length[who], -1.0, 1.0)
                reach = np.where(least(who) > -np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine)), np.inf)
                return who[apart <= factor * reach + _SLACK]

            visit(far, open_(outer - d[first], active[first]))
            visit(near, open_(d[~first] - inner, active[~first]))

        visit(self.root, np.arange(len(ids)))
        return best


def _search(k: int, factor: float, block: int):
    """Of rows in order of shard and role, the best ``k`` of each query in each shard: its tree is built once, and queries pass through it in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        index: list[tuple[np.ndarray, np.ndarray]] = []
        asking: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal tree, index, asking, waiting
            if tree is None and index and asking:
                tree, index = VPTree(*map(np.concatenate, zip(*index))), []
            if tree is not None and asking:
                ids, vectors = map(np.concatenate, zip(*asking))
                for at in range(0, len(ids), block):
                    some = ids[at:at + block]
                    query, row, score = tree.search(some, vectors[at:at + block], k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(some[query]), pa.array(tree.ids[row]), pa.array(score)], ["query_id", "vec_id", "score"])
            asking, waiting = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            vectors = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
            cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
                if rows[a, 0] != shard:
                    yield from answer()
                    shard, tree, index = rows[a, 0], None, []
                (asking if rows[a, 1] else index).append((rows[a:b, 2], vectors[a:b]))
                if rows[a, 1] and (waiting := waiting + b - a) >= block:
                    yield from answer()
        yield from answer()

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = K, factor: float = FACTOR, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows where ``queries`` holds, the ``k`` rows with the largest inner product.

    ``vectors`` has ``vec_id`` and ``embedding``. Every row is in the index of its shard, shards hold about
    ``shard`` rows, and their number follows the count. A shard is shuffled once; its task builds one tree and passes all queries through
    it, ``block`` at a time, and returns its best ``k`` for each, of which the best ``k`` remain.
    Rows that are not ``usable``, have no id, or another number of components than most, take no part; a row that
    repeats id and vector counts once. Ties go to the smaller ``vec_id``. Components may have any finite size; a score is the inner product in
    double precision, so it may be zero or infinite where the true one is not, and ties are ties of scores.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), queries.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).dropDuplicates(["vec_id", "embedding"])
    rows = stored(rows.withColumn("size", F.size("embedding")), "vectors")
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.sort(F.desc("n"), "size").first()
    size, n = (most["size"], most["n"]) if most else (0, 0)
    shards = max(1, math.ceil(n / shard))
    rows = rows.filter(F.col("size") == size)
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    index = rows.select(home.alias("shard"), F.lit(0).alias("role"), "vec_id", "embedding")
    asked = rows.filter("asks").select(every.alias("shard"), F.lit(1).alias("role"), "vec_id", "embedding")
    tasks = index.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "role")
    found = tasks.mapInArrow(_search(k, factor, block), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
