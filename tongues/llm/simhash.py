"""Near duplicates by SimHash: fingerprints of shingles, linked through BK-trees."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.components import components
from tongues.llm.interim import Interim
from tongues.sources.scratch import stored

SEED = 42
#: Fingerprints link at this many differing bits or fewer.
RADIUS = 3
#: Fingerprints in one tree; larger buckets are split into several.
TREE = 2048
#: Similar texts: words of a shingle, 64-bit lanes of a fingerprint, and differing bits at which they are still candidates, which
#: a similarity of 0.8 stays within in 998 of 1,000 cases even for the smallest sets (four shingles and five).
SIMILAR_WORDS, LANES, SIMILAR_RADIUS = 5, 4, 68
#: Buckets of a text, and smallest hashes that must agree in one.
BANDS, ROWS = 9, 3
#: Texts are similar when their sets of shingles have at least this Jaccard similarity, as a fraction.
SIMILAR = (4, 5)
#: Candidates that leave a search at a time.
PAIRS = 1 << 16
#: Bytes of shingle sets in one shard of a bucket.
SHARD_BYTES = 1 << 24
LANE_NAMES = tuple(f"lane{i}" for i in range(LANES))
_SALTS = np.arange(1, LANES + BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_BLOCK, _SLICE = 1 << 16, 1 << 12
#: For a byte value, its bits from the highest down.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, in blocks; nothing when there are no words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    width = min(words, len(parts))
    total = len(parts) - width + 1
    first, last = starts[:total].tolist(), (starts + lengths)[width - 1:].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, total, _BLOCK):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[at:at + _BLOCK], last[at:at + _BLOCK])])
        yield np.frombuffer(hashes, dtype=">u8")


def _votes(hashes: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, from the highest down, how many of the big-endian ``hashes`` have it."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    sums = np.bincount((octets + np.arange(8) * 256).ravel(), minlength=2048).reshape(8, 256)
    return (sums @ _BITS).ravel()


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; 0 when there are no words.

    A to Z are lower-cased, words are split at ASCII blanks, repeated shingles count
    again, and a bit is set when it is set in more than half of the shingle hashes. Long
    texts are hashed in blocks of shingles.
    """
    votes, total = np.zeros(64, dtype=np.int64), 0
    for hashes in _shingle_hashes(text, words):
        votes += _votes(hashes)
        total += len(hashes)
    return int(np.packbits(2 * votes > total).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, twin, fp`` of every row, in Arrow batches; ``twin`` tells texts of a repeated ``doc_id`` apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps, pa.int64())], ["doc_id", "twin", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), twin().alias("twin"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, twin long, fp long")


def twin() -> Column:
    return F.xxhash64("text")


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.edges.append({})
        at, new = 0, len(self.values) - 1
        while at != new:
            d = (value ^ self.values[at]).bit_count()
            at = self.edges[at].setdefault(d, new)

    def near(self, value: int, radius: int) -> list[int]:
        """Values within the radius. A child at distance c from its parent can only lead there
        when c is within the radius of the parent's own distance."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(self.values[at])
            if edges := self.edges[at]:
                if len(edges) <= 2 * radius:
                    todo += [child for c, child in edges.items() if d - radius <= c <= d + radius]
                else:
                    todo += [edges[c] for c in range(d - radius, d + radius + 1) if c in edges]
        return found


def _spanning(own: list[int], asked: list[int], radius: int) -> list[tuple[int, int]]:
    """Links within ``radius`` among ``own``, or, if any are ``asked``, between those and ``own``;
    of these, as many as connect what the links connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = up = parent.setdefault(up, up)
            x = up
        return x

    links, tree = [], BKTree()

    def ask(value: int) -> None:
        for other in tree.near(value, radius):
            a, b = root(value), root(other)
            if a != b:
                parent[a] = b
                links.append((value, other))

    for value in own:
        if not asked:
            ask(value)
        tree.add(value)
    for value in asked:
        ask(value)
    return links


class _Bucket:
    """The nodes of one group: those in the tree, which are the first ``split``, and those that ask; if there are no others the first ask each other.

    Rows hold the node, its root and its lanes. ``pairs`` are the candidates, within ``radius`` and of unlike roots at that time.
    """

    def __init__(self, rows: np.ndarray, split: int, radius: int):
        self.nodes, self.roots = rows[:, 0].tolist(), rows[:, 1].tolist()
        self.values = [int.from_bytes(lanes.tobytes(), "little") for lanes in rows[:, 2:]]
        self.split, self.radius = split, radius
        self.parent = {r: r for r in self.roots}

    def root(self, i: int) -> int:
        x, parent = self.roots[i], self.parent
        while (up := parent[x]) != x:
            parent[x] = x = parent[up]
        return x

    def unite(self, i: int, j: int) -> None:
        self.parent[self.root(i)] = self.root(j)

    def pairs(self) -> Iterator[tuple[int, int]]:
        tree, holders = BKTree(), {}

        def ask(i: int) -> Iterator[tuple[int, int]]:
            for value in tree.near(self.values[i], self.radius):
                for j in holders[value]:
                    if self.root(i) != self.root(j):
                        yield i, j

        for i in range(self.split):
            if self.split == len(self.nodes):
                yield from ask(i)
            if self.values[i] not in holders:
                tree.add(self.values[i])
            holders.setdefault(self.values[i], []).append(i)
        for i in range(self.split, len(self.nodes)):
            yield from ask(i)

    def spanning(self) -> Iterator[tuple[int, int]]:
        """As many candidates as connect what all of them connect."""
        for i, j in self.pairs():
            self.unite(i, j)
            yield self.nodes[i], self.nodes[j]

    def touched(self) -> set[int]:
        """The nodes that are in a candidate."""
        return {self.nodes[k] for pair in self.pairs() for k in pair}

    def confirmed(self, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """Candidates whose shingle sets are similar, as many as connect what all of these connect."""
        for i, j in self.pairs():
            if _alike(sets[i], sets[j]):
                self.unite(i, j)
                yield self.nodes[i], self.nodes[j]


Group = tuple[np.ndarray, list[bytes] | None]


def _groups(batches: Iterator[pa.RecordBatch], numbers: int) -> Iterator[Group]:
    """Rows with equal first four columns, which come one after another: their first ``numbers`` columns, and the bytes in the next one, if any."""
    held: Group | None = None
    for batch in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:numbers]])
        more = batch.column(numbers).to_pylist() if batch.num_columns > numbers else None
        if held is not None:
            rows, more = np.concatenate([held[0], rows]), more if more is None else held[1] + more
        if not len(rows):
            continue
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(rows)]
        parts = [(rows[a:b], more if more is None else more[a:b]) for a, b in zip(edges, edges[1:])]
        yield from parts[:-1]
        held = parts[-1]
    if held is not None:
        yield held


def _asking(rows: np.ndarray) -> int | None:
    """Where the rows begin that ask; None if a group has no pairs."""
    split = int(np.searchsorted(rows[:, 4], 1))
    return None if len(rows) < 2 or (rows[0, 2] != rows[0, 3] and split in (0, len(rows))) else split


def _pairs(found: Iterable[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    found = iter(found)
    while some := list(islice(found, PAIRS)):
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*some)], ["a", "b"])


def _search(radius: int):
    """Links of fingerprints in each group; after the role come the fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _groups(batches, 6):
            if (split := _asking(rows)) is not None:
                nodes = rows[:, 5].tolist()
                yield from _pairs(_spanning(nodes[:split], nodes[split:], radius))

    return run


def _walk(radius: int, found: Callable[[_Bucket, list[np.ndarray]], Iterator[tuple[int, int]]]):
    """What ``found`` makes of each bucket that has pairs; after the role come node, root and lanes, and then the shingle set, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _groups(batches, 7 + LANES):
            if (split := _asking(rows)) is not None:
                yield from _pairs(found(_Bucket(rows[:, 5:], split, radius), [np.frombuffer(x, np.uint64) for x in sets or ()]))

    return run


def _touch(radius: int):
    """``band, value, fp`` of the nodes that are in a candidate in their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _groups(batches, 7 + LANES):
            if (split := _asking(rows)) is not None and (nodes := sorted(_Bucket(rows[:, 5:], split, radius).touched())):
                columns = [np.full(len(nodes), rows[0, 0]), np.full(len(nodes), rows[0, 1]), np.array(nodes)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["band", "value", "fp"])

    return run


def near_links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all that are within ``radius``.

    Fingerprints within ``radius`` agree in at least one of ``radius + 1`` bands of bits, so each one goes
    to one bucket per band. A bucket is split by hash into shards of about ``tree`` values; each pair of
    shards is a task's work on its own: a BK-tree of one shard, asked for the values of the other.
    Trees travel through the shuffle, not by broadcast, as nothing bounds their total size.
    A group holds two shards at most and yields fewer links than values.
    """
    bands = radius + 1
    width = 64 // bands
    mask = F.lit((1 << width) - 1).cast("long")
    banded = fps.select("fp", F.explode(F.array(*[F.lit(i) for i in range(bands)])).alias("band"))
    shift = F.expr(f"shiftrightunsigned(fp, band * {width})")
    placed = _placed(banded.select("fp", "band", shift.bitwiseAND(mask).alias("value")), [], tree, stored)
    return placed.mapInArrow(_search(radius), "a long, b long")


def _placed(banded: DataFrame, more: list[str], tree: int, keep, size: Column | None = None) -> DataFrame:
    """Rows of the buckets of equal ``band`` and ``value`` in order of bucket, pair of shards, role and ``fp``, with the columns ``more``.

    Buckets of a single root, if it is known, have no links and are left out. A bucket has a shard for each ``tree`` nodes and each
    ``SHARD_BYTES`` of ``size``.
    """
    unlike = [F.min("root") < F.max("root")] if "root" in more else []
    shards = F.ceil(F.count(F.lit(1)) / tree)
    if size is not None:
        shards = F.greatest(shards, F.ceil(F.sum(size) / SHARD_BYTES))
    sizes = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), shards.alias("shards"), *[u.alias("unlike") for u in unlike])
    sizes = sizes.filter("n > 1 and unlike" if unlike else "n > 1")
    sizes = keep(sizes.select("band", "value", "shards"), "bk-sizes")
    homed = banded.join(sizes, ["band", "value"]).withColumn("home", F.pmod(F.xxhash64("fp", "band"), "shards"))
    placed = homed.select("fp", *more, "band", "value", "home", F.explode(F.expr("sequence(0L, shards - 1)")).alias("other"))
    # of a pair of shards the lower one asks and the higher one is the tree; a shard paired with itself is the tree
    placed = placed.select(
        "band", "value", F.least("home", "other").alias("s"), F.greatest("home", "other").alias("t"),
        F.when(F.col("other") > F.col("home"), 1).otherwise(0).alias("role"), "fp", *more,
    )
    keys = ["band", "value", "s", "t"]
    return placed.repartition(*keys).sortWithinPartitions(*keys, "role", "fp")


def hex16(fp: Column) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """``doc_id, twin, fp, component_id`` for every row.

    ``component_id`` is the smallest ``doc_id`` that a row reaches over links, itself included. Null and
    wordless texts have fingerprint zero and are linked like any other; rows with equal
    fingerprints are one node, so copies cost nothing after the first count; null ids are
    passed over when the smallest is taken, and a group of null ids alone has a null one.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    return _grouped(rows, nodes, near_links(nodes.select("fp"), radius))


def _grouped(rows: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the smallest id, ``first`` in ``nodes``, that their ``fp`` reaches over ``links``."""
    roots = stored(components(links), "fingerprint-roots")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "fingerprint-rooted")
    first = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "fingerprint-first")
    named = stored(rooted.select("fp", "root").join(first, "root").select("fp", "component_id"), "fingerprint-named")
    return rows.join(named, "fp").select("doc_id", "twin", "fp", "component_id")


def shingle_set(text: str | None, words: int = SIMILAR_WORDS) -> np.ndarray:
    """The distinct hashes of the whole text's shingles, in order."""
    blocks = [np.unique(block.astype(np.uint64)) for block in _shingle_hashes(text, words)]
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, np.uint64)


def signature(text: str | None, words: int = SIMILAR_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A fingerprint of ``LANES`` times 64 bits, and one hash for each of ``BANDS`` buckets, both of the set of shingles.

    The lanes are fingerprints under different hash functions, in which each distinct shingle of the whole text counts
    once. A bucket's hash is of the smallest ``ROWS`` hashes of the set, each under a function of its own, so texts whose sets have the
    Jaccard similarity s share a bucket with probability s to the power of ``ROWS``. Without words all is zero.
    """
    return _signed(shingle_set(text, words))


def _signed(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    votes, total = np.zeros((LANES, 64), dtype=np.int64), len(shingles)
    lowest = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    if not total:
        return np.zeros(LANES, dtype=np.int64), np.zeros(BANDS, dtype=np.int64)
    for at in range(0, total, _SLICE):
        hashes = shingles[at:at + _SLICE]
        votes += np.array([_votes(h) for h in _mixed(hashes, _SALTS[:LANES]).astype(">u8")])
        lowest = np.minimum(lowest, _mixed(hashes, _SALTS[LANES:]).min(axis=1))
    lanes = np.packbits(2 * votes > total, axis=1).view(">i8").ravel().astype(np.int64)
    buckets = np.fromiter((xxhash.xxh64_intdigest(b.tobytes(), SEED) for b in lowest.reshape(BANDS, ROWS)), np.uint64, BANDS)
    return lanes, buckets.view(np.int64)


def _mixed(hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """For each of the ``salts`` another hash of each of the ``hashes``, by a multiplication, a fold and a multiplication."""
    x = (hashes ^ salts[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def signatures(docs: DataFrame, words: int = SIMILAR_WORDS) -> DataFrame:
    """``doc_id, twin, fp``, the lanes and ``buckets`` of every row; ``fp`` is a hash of the set of shingles, so that only equal sets share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, names = [], []
            for t in batch.column(2):
                shingles = shingle_set(t.as_py(), words)
                found.append(_signed(shingles))
                names.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED))
            lanes = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, LANES)
            buckets = np.array([f[1] for f in found], dtype=np.int64).ravel()
            offsets = pa.array(np.arange(0, len(buckets) + 1, BANDS), pa.int32())
            columns = [pa.array(np.array(names, dtype=np.uint64).view(np.int64)), *map(pa.array, np.ascontiguousarray(lanes.T)), pa.ListArray.from_arrays(offsets, pa.array(buckets))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "twin", "fp", *LANE_NAMES, "buckets"])

    rows = docs.select(F.col("doc_id").cast("long"), twin().alias("twin"), F.col("text").cast("string"))
    longs = ", ".join(f"{name} long" for name in LANE_NAMES)
    return rows.mapInArrow(run, f"doc_id long, twin long, fp long, {longs}, buckets array<long>")


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have the Jaccard similarity ``SIMILAR`` or more."""
    (above, below), least, most = SIMILAR, *sorted((len(a), len(b)))
    if least * below < most * above:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * below >= (least + most - shared) * above


def _sets(asked: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``fp, shingles``: the sets of the nodes ``asked``, each computed once, from the text with the node's ``twin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["fp", "shingles"])

    texts = docs.select(F.col("text").cast("string").alias("_text"), twin().alias("twin")).join(asked.select("fp", "twin"), "twin")
    return texts.select("fp", "_text").mapInArrow(run, "fp long, shingles binary").dropDuplicates(["fp"])


def _confirmed(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """``a, b, alike``: the pairs of nodes, and whether the shingle sets of their texts are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = ((np.frombuffer(x.as_py(), np.uint64) for x in batch.column(i)) for i in (2, 3))
            alike = pa.array([_alike(a, b) for a, b in zip(first, second)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], alike], ["a", "b", "alike"])

    both = pairs.join(shingles.toDF("a", "sa"), "a").join(shingles.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(compare, "a long, b long, alike boolean")


def similar_groups(docs: DataFrame, words: int = SIMILAR_WORDS, radius: int = SIMILAR_RADIUS) -> DataFrame:
    """``doc_id, twin, fp, component_id`` for every row, as ``simhash_groups``, but for texts that are merely similar.

    Texts of similarity 0.8 differ in a seventh of their fingerprint bits. No few bands of bits are
    free of so many differences, so the shards of the BK-trees are the buckets that ``signature`` names, and
    the trees yield candidates, which link only if the exact similarity of their shingle sets is ``SIMILAR`` or more.
    Of pairs at 0.8, buckets miss 0.2 % and the radius nearly none.
    Large groups have too many pairs to list, also of those that are not similar in the end. So at first only candidates that connect what all
    of them connect are confirmed. Where some fail, others may hold instead: the nodes that still have candidates among nodes they
    are not connected to are named, their shingle sets go to the buckets where that is so, and the trees are walked once more, where a candidate is
    confirmed or refuted at once and only confirmed ones that connect something leave the search.
    """
    spark, keep = docs.sparkSession, Interim("similar")
    rows = keep("signatures", signatures(docs, words))
    # texts of equal sets are one member
    members = keep("members", rows.select("fp", *LANE_NAMES, "buckets").distinct())
    nodes = keep("nodes", rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("twin").alias("twin")))
    lanes = ["root", *LANE_NAMES]

    def placed(rooted: DataFrame, name: str) -> DataFrame:
        banded = rooted.select("fp", *lanes, F.posexplode("buckets").alias("band", "value"))
        return _placed(banded, lanes, TREE, lambda sizes, _: keep(f"sizes-{name}", sizes))

    found = placed(members.withColumn("root", F.col("fp")), "first").mapInArrow(_walk(radius, lambda bucket, _: bucket.spanning()), "a long, b long")
    pairs = keep("pairs", found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    asked = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).distinct()
    sets = keep("sets", _sets(nodes.join(asked, "fp", "left_semi"), docs, words))
    tried = keep("tried", _confirmed(pairs, sets))
    keep.drop(spark, "sizes-first", "pairs", "sets")
    links = tried.filter("alike").select("a", "b")
    if not tried.filter(~F.col("alike")).isEmpty():
        roots = keep("roots", components(links))
        rooted = members.join(roots, members["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
        rooted = keep("rooted", rooted.drop("node"))
        pending = keep("pending", placed(rooted, "second").mapInArrow(_touch(radius), "band long, value long, fp long").distinct())
        sets = keep("more-sets", _sets(nodes.join(pending.select("fp").distinct(), "fp", "left_semi"), docs, words))
        shipped = pending.join(rooted.select("fp", *lanes), "fp").join(sets, "fp")
        ready = _placed(shipped, [*lanes, "shingles"], TREE, lambda sizes, _: keep("sizes-sets", sizes), F.octet_length("shingles"))
        links = links.union(keep("more", ready.mapInArrow(_walk(radius, lambda bucket, sets: bucket.confirmed(sets)), "a long, b long").distinct()))
        keep.drop(spark, "roots", "rooted", "sizes-second", "pending", "more-sets", "sizes-sets")
    found = _grouped(rows.select("doc_id", "twin", "fp"), nodes, links)
    keep.drop(spark, "members", "nodes", *(n for n in ("tried", "more") if n in keep.paths))
    return found


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, twin, component_id`` for every row: groups of texts that are linked by ``simhash_groups`` or by ``similar_groups``.

    A group of one kind is a node, and a row links the two that it is in, so whatever is connected by links of either kind is one group.
    """
    rows = simhash_groups(docs).select("doc_id", "twin", F.xxhash64(F.lit("bits"), "component_id").alias("a")).distinct()
    other = similar_groups(docs).select("doc_id", "twin", F.xxhash64(F.lit("sets"), "component_id").alias("b")).distinct()
    other = other.toDF("_id", "_twin", "b")
    both = rows.join(other, rows["doc_id"].eqNullSafe(other["_id"]) & rows["twin"].eqNullSafe(other["_twin"])).select("doc_id", "twin", "a", "b")
    both = stored(both, "near-both")
    roots = stored(components(both.select("a", "b").distinct()), "near-roots")
    rooted = both.join(roots, both["a"] == roots["node"]).select("doc_id", "twin", "root")
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(first, "root").select("doc_id", "twin", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stay when each of ``groups``, similar texts by default, keeps one: that of the smallest ``doc_id``.

    Among rows of that id one text stays, and among equal rows one; a group whose ids are all null
    is known by its null id and keeps one row of those.
    """
    groups = similar_groups(docs) if groups is None else groups
    groups = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.groupBy("component_id").agg(F.min("twin").alias("twin")).toDF("_id", "_kept")
    marked = docs.withColumn("_twin", twin())
    same = marked["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (marked["_twin"] == kept["_kept"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_twin"]).drop("_twin")
