"""Repeated passages across documents: enhanced suffix arrays of the places that share an anchor, and their interval trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.interim import Interim

#: Bytes of a repeat at least.
LENGTH = 50
#: Bytes of an anchor: of all such strings in a window of ``LENGTH`` bytes the one with the smallest hash names the window's bucket.
ANCHOR = 20
#: Starts of windows in one piece at most; a longer run of windows of one bucket becomes several pieces.
PIECE = 32
#: Different pieces of one bucket that meet in one suffix array; larger buckets are split by their strings of ``LENGTH`` bytes.
BUCKET = 4096
_BLOCK = 1 << 16
_ARRAY, _SLICE = 1 << 21, 1 << 22
_LAST = 9223372036854775807
_EMPTY = hashlib.sha256(b"").hexdigest()
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _rolled(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every string of ``width`` bytes: hashes of doubled widths, put together."""
    now = (data.astype(np.uint64) + np.uint64(1)) * _M1
    now ^= now >> np.uint64(29)
    found, size, step = None, 0, 1
    while True:
        if width & step:
            if found is None:
                found = now
            else:
                found = found[: len(now) - size] * _M3 + now[size:]
                found ^= found >> np.uint64(30)
            size += step
        if size == width:
            return found * _M1
        now = now[:-step] * _M2 + now[step:]
        now ^= now >> np.uint64(31)
        step *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span:]) if span < width else values


def window_runs(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket, start, count)`` of the runs of windows of ``length`` bytes that have the same bucket, in order.

    A window's bucket is the smallest hash of the anchors in it, so equal windows have equal buckets
    wherever they stand. Runs have ``PIECE`` windows at most; long texts are hashed in overlapping blocks.
    """
    data, total = np.frombuffer(text, np.uint8), len(text) - length + 1
    buckets = [_least(_rolled(data[at:min(at + _BLOCK, total) + length - 1], anchor), length - anchor + 1) for at in range(0, max(total, 0), _BLOCK)]
    if not buckets:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = np.concatenate(buckets)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.append(first, total))
    if (count > PIECE).any():
        parts = -(-count // PIECE)
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = np.repeat(first, parts) + at * PIECE, np.minimum(np.repeat(count, parts) - at * PIECE, PIECE)
    return least[first], first, count


def _doc() -> Column:
    """Documents by ascending ``doc_id``; null ids come last and count as one document."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(_doc().alias("doc"), F.xxhash64(text).alias("twin"), text.alias("text"))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``_SLICE`` bytes of text, as a text has a run for each 16 bytes or so; the texts are the third column."""
    for batch in batches:
        part = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)) // _SLICE
        cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket, doc, twin, at, role`` of every run.

    ``at`` holds start and count. Buckets that two texts of a slice share need no question: their runs
    have role 0; one row of role 1 without a text tells the others. The rest have role 2. Of copies of
    a text in one slice, that of the smallest document counts.
    """
    names = ["bucket", "doc", "twin", "at", "role"]
    for batch in _slices(batches):
        docs, twins = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        order = np.lexsort((docs, twins))
        if not len(order):
            continue
        own = order[np.concatenate([[True], twins[order][1:] != twins[order][:-1]])]
        found = []
        for i in own.tolist():
            bucket, start, count = window_runs(batch.column(2)[i].as_py().encode())
            found.append((bucket, start << 8 | count, np.full(len(bucket), i)))
        bucket, at, row = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(bucket, kind="stable")  # rows ascend within a bucket, up to the order of ``own``
        bucket, at, row = bucket[order], at[order], row[order]
        if not len(bucket):
            continue
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(edge, len(bucket)))
        shared = np.minimum.reduceat(row, edge) != np.maximum.reduceat(row, edge)
        role = np.repeat(np.where(shared, 0, 2), size)
        columns = [bucket, docs[row].view(np.uint64), twins[row].view(np.uint64), at.view(np.uint64), role.astype(np.uint64)]
        tell = bucket[edge[shared]]
        more = [tell, *[np.zeros(len(tell), np.uint64)] * 3, np.ones(len(tell), np.uint64)]
        yield pa.RecordBatch.from_arrays([_signed(np.concatenate(x)) for x in zip(columns, more)], names)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of ``bucket, role, twin, doc``, the runs of buckets that two texts have, of the smallest document of each text."""
    names = ["bucket", "doc", "twin", "at"]
    held: np.ndarray | None = None

    def of(rows: np.ndarray) -> pa.RecordBatch:
        bucket, doc, twin, at, role = rows.T
        new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        edge, group = np.flatnonzero(new), np.cumsum(new) - 1
        same = np.concatenate([[False], ~new[1:] & (twin[1:] == twin[:-1]) & (role[1:] == role[:-1])])
        texts = np.add.reduceat((~same & (role == 2)).astype(np.int64), edge)
        known = np.minimum.reduceat(role, edge) < 2
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
        keep = (known | (texts > 1))[group] & (role != 1) & (doc == doc[first])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[keep, i])) for i in range(4)], names)

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
        rows = rows if held is None else np.concatenate([held, rows])
        if len(rows):
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if last:
                yield of(rows[:last])
            held = rows[last:]
    if held is not None and len(held):
        yield of(held)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each run's windows."""
    names = ["bucket", "piece", "doc", "twin", "start"]
    for batch in batches:
        out = [[] for _ in names]
        for i in range(batch.num_rows):
            text, rows = batch.column(2)[i].as_py().encode(), batch.column(3)[i].values
            at = rows.field("at").to_numpy(zero_copy_only=False)
            start, stop = at >> 8, (at >> 8) + (at & 255) + LENGTH - 1
            out[0].append(rows.field("bucket").to_numpy(zero_copy_only=False))
            out[1] += [text[a:b] for a, b in zip(start.tolist(), stop.tolist())]
            for k in (0, 1):
                out[2 + k].append(np.full(len(at), batch.column(k)[i].as_py()))
            out[4].append(start)
            if len(out[1]) > _BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) if k == 1 else pa.array(np.concatenate(x)) for k, x in enumerate(out)], names)
                out = [[] for _ in names]
        if out[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) if k == 1 else pa.array(np.concatenate(x)) for k, x in enumerate(out)], names)


class SuffixArray:
    """The enhanced suffix array of some pieces, as far as suffixes have ``length`` bytes and share as many with another.

    Suffixes whose first ``length`` bytes stand once in the pieces are in no repeat and are left out. The others are ordered by those bytes' hash, then
    byte by byte, so that common prefixes of ``length`` bytes or more stand together as in the order of the alphabet.
    ``lcp[i]`` is what suffix ``i`` has in common with the one before it, 0 where that is less than ``length``.
    """

    def __init__(self, pieces: list[bytes], length: int = LENGTH):
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = -(-int(sizes.max()) // 8) * 8
        data = np.frombuffer(b"".join(pieces) + bytes(width), np.uint8)
        begin = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        piece = np.repeat(np.arange(len(pieces)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begin[piece] + offset
        name = _rolled(data, length)[at]
        order = np.argsort(name, kind="stable")
        name = name[order]
        new = np.concatenate([[True], name[1:] != name[:-1], [True]])
        order = order[~(new[:-1] & new[1:])]
        self.piece, self.offset, at = piece[order], offset[order], at[order]
        self.lcp = np.zeros(len(order), np.int64)
        self.left = np.where(self.offset > 0, data[at - 1].astype(np.int64), -2)
        if not len(order):
            return
        rest = sizes[self.piece] - self.offset
        suffixes = np.lib.stride_tricks.sliding_window_view(data, width)[at]
        suffixes[np.arange(width) >= rest[:, None]] = 0
        words = suffixes.view(">u8").astype(np.uint64)
        order = np.lexsort((rest, *words.T[::-1], name[~(new[:-1] & new[1:])]))
        self.piece, self.offset, self.left, rest, words = self.piece[order], self.offset[order], self.left[order], rest[order], words[order]
        differs = words[1:] != words[:-1]
        word = differs.argmax(1)
        odd = np.take_along_axis(words[1:] ^ words[:-1], word[:, None], 1)[:, 0]
        # leading zero bytes of the first word that differs
        zeros = (odd[:, None] < (np.uint64(1) << np.arange(56, 0, -8, dtype=np.uint64))).sum(1)
        common = np.where(differs.any(1), word * 8 + zeros, width)
        common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
        self.lcp[1:] = np.where(common >= length, common, 0)


class Intervals:
    """The tree of common-prefix intervals of a suffix array: nodes with ``length``, ``low``, ``high``, ``parent``, smallest ``owner`` and ``diverse``.

    One scan with a stack closes an interval when the common prefix becomes shorter. An interval is diverse when its
    suffixes are not all preceded by the same byte of their pieces: only then is the repeat maximal to the left.
    ``leaf`` is the deepest interval of each suffix, -1 for none.
    """

    def __init__(self, array: SuffixArray, owners: np.ndarray):
        lcp, left, owner = array.lcp.tolist(), array.left.tolist(), owners[array.piece].tolist()
        self.length, self.low, self.high, self.parent, self.owner, self.diverse = [], [], [], [], [], []
        self.leaf = [-1] * len(lcp)
        stack: list[list] = []  # length, low, smallest owner, left byte or -2 for several, nodes and leaves below

        def close(upto: int) -> list:
            size, low, least, byte, nodes, leaves = stack.pop()
            node = len(self.length)
            self.length.append(size)
            self.low.append(low)
            self.high.append(upto)
            self.parent.append(-1)
            self.owner.append(least)
            self.diverse.append(byte == -2)
            for child in nodes:
                self.parent[child] = node
            for leaf in leaves:
                self.leaf[leaf] = node
            return [node, least, byte]

        for i in range(1, len(lcp) + 1):
            size = lcp[i] if i < len(lcp) else 0
            low, last = i - 1, None
            pending = [i - 1] if not stack or size > stack[-1][0] else None
            if pending is None:  # suffix i - 1 belongs to the interval on top
                top = stack[-1]
                top[5].append(i - 1)
                top[2] = min(top[2], owner[i - 1])
                top[3] = top[3] if top[3] == left[i - 1] else -2
            while stack and size < stack[-1][0]:
                low = stack[-1][1]
                last = close(i - 1)
                if stack and size <= stack[-1][0]:
                    top = stack[-1]
                    top[4].append(last[0])
                    top[2] = min(top[2], last[1])
                    top[3] = top[3] if top[3] == last[2] else -2
                    last = None
            if size and (not stack or size > stack[-1][0]):
                if last is None:
                    stack.append([size, low, owner[i - 1], left[i - 1], [], [i - 1]])
                else:
                    stack.append([size, low, last[1], last[2], [last[0]], []])

    def covering(self, owners: np.ndarray, array: SuffixArray) -> np.ndarray:
        """For each suffix the longest diverse interval above it that a smaller document has, -1 for none."""
        if not self.length:
            return np.full(len(self.leaf), -1)
        best = [-1] * len(self.length)  # the nearest interval at or above a node with a smaller owner than its own
        for node in range(len(best) - 1, -1, -1):  # parents are closed after their children
            parent = self.parent[node]
            if parent >= 0:
                best[node] = parent if self.owner[parent] < self.owner[node] else best[parent]
        leaf, own = np.array(self.leaf), owners[array.piece]
        there = np.maximum(leaf, 0)
        found = np.where(np.array(self.owner)[there] < own, there, np.array(best)[there])
        found = np.where(leaf < 0, -1, found)
        return np.where((found >= 0) & np.array(self.diverse)[np.maximum(found, 0)], found, -1)


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of ``bucket`` in tables of about ``_ARRAY`` bytes of pieces that cut no bucket in two."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += batch.num_rows
        if total * (LENGTH + PIECE) >= _ARRAY:
            rows = pa.Table.from_batches(held)
            bucket = rows.column("bucket").to_numpy()
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield rows.slice(0, last).combine_chunks()
            held, total = rows.slice(last).combine_chunks().to_batches(), len(rows) - last
    if total:
        yield pa.Table.from_batches(held).combine_chunks()


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces in order of ``bucket``: ``bucket, code, first, size``, what each owner's piece loses to smaller documents."""
    for rows in _whole_buckets(batches):
        bucket, code, owner = (rows.column(n).to_numpy() for n in ("bucket", "code", "owner"))
        array = SuffixArray(rows.column("piece").to_pylist())
        tree = Intervals(array, owner)
        node = tree.covering(owner, array)
        hit = np.flatnonzero(node >= 0)
        at, size = array.piece[hit], np.array(tree.length, np.int64)[node[hit]] if len(hit) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[at], code[at], array.offset[hit], size)], ["bucket", "code", "first", "size"])


def _maximal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces in order of ``bucket``, with their number ``n`` of places: ``bucket, code, first, size, group`` of every place of every left-diverse interval in a piece.

    A piece that has several places and is in no interval as a whole is a group of its own.
    """
    names = ["bucket", "code", "first", "size", "group"]
    for rows in _whole_buckets(batches):
        bucket, code, n = (rows.column(c).to_numpy() for c in ("bucket", "code", "n"))
        pieces = rows.column("piece").to_pylist()
        array = SuffixArray(pieces)
        tree = Intervals(array, np.zeros(len(pieces), np.int64))
        alone = n > 1
        found: list[tuple[int, int, int, int]] = []
        for size, low, high, diverse in zip(tree.length, tree.low, tree.high, tree.diverse):
            members = list(zip(array.piece[low:high + 1].tolist(), array.offset[low:high + 1].tolist()))
            for piece, offset in members:
                alone[piece] &= offset > 0 or size < len(pieces[piece])
            if diverse:
                piece, offset = members[0]
                name = _name(pieces[piece][offset:offset + size])
                found += [(piece, offset, size, name) for piece, offset in members]
        found += [(i, 0, len(pieces[i]), _name(pieces[i])) for i in np.flatnonzero(alone).tolist()]
        if found:
            at, *rest = (np.array(x, np.int64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[at], code[at], *rest)], names)


def _name(repeat: bytes) -> int:
    """The hash that Spark gives to the same bytes."""
    return int.from_bytes(xxhash.xxh64_digest(repeat, 42), "big", signed=True)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of ``LENGTH`` bytes in each piece, with their place in it and the piece's third column."""
    names = ["bucket", "code", "value", "offset", "gram"]
    for batch in batches:
        pieces = batch.column(3).to_pylist()
        counts = np.fromiter((len(p) - LENGTH + 1 for p in pieces), np.int64, len(pieces))
        at = pa.array(np.repeat(np.arange(len(pieces)), counts))
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        grams = [p[i:i + LENGTH] for p in pieces for i in range(len(p) - LENGTH + 1)]
        yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(3)], pa.array(offset), pa.array(grams, pa.binary())], names)


def shared_runs(docs: DataFrame) -> DataFrame:
    """``bucket, doc, twin, at`` of the runs of windows whose bucket two different texts have; of copies of a text, the smallest document's."""
    found = _texts(docs).filter(F.octet_length("text") >= LENGTH).mapInArrow(
        _anchored, "bucket long, doc long, twin long, at long, role long"
    )
    # known runs of a bucket are dealt out by text, all else by bucket
    dealt = found.repartition(F.when(F.col("role") == 0, F.xxhash64("bucket", "twin")).otherwise(F.col("bucket")))
    dealt = dealt.sortWithinPartitions("bucket", "role", "twin", "doc")
    return dealt.mapInArrow(_shared, "bucket long, doc long, twin long, at long")


def repeat_pieces(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """``bucket, piece, doc, twin, start, code, size``: the bytes of the windows of ``shared_runs``, their hash and number."""
    wanted = shared.groupBy("doc", "twin").agg(F.collect_list(F.struct("bucket", "at")).alias("runs"))
    texts = _texts(docs).filter(F.octet_length("text") >= LENGTH).join(wanted, ["doc", "twin"])
    found = texts.select("doc", "twin", "text", "runs").mapInArrow(_pieces, "bucket long, piece binary, doc long, twin long, start long")
    return found.withColumn("code", F.xxhash64("piece")).withColumn("size", F.octet_length("piece").cast("long"))


def lost_ranges(pieces: DataFrame, keep: Interim) -> DataFrame:
    """``doc, twin, first, size``: ranges of bytes that a smaller document has as well, overlapping ones too.

    Equal pieces are one entry in the suffix array, that of the smallest document; in all others the whole
    piece is lost. Buckets of more than ``BUCKET`` different pieces, such as the edges of a passage that very many documents share, are
    split by their strings of ``LENGTH`` bytes, whose smallest document partial minima find.
    """
    keys = ["bucket", "code"]
    different = keep("different", pieces.groupBy(*keys, "piece").agg(F.min("doc").alias("owner")))
    sizes = different.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = keep("sized", different.join(sizes, "bucket"))
    small = sized.filter(F.col("n") <= BUCKET).select(*keys, "owner", "piece").repartition("bucket").sortWithinPartitions("bucket")
    found = small.mapInArrow(_repeats, "bucket long, code long, first long, size long")
    grams = sized.filter(F.col("n") > BUCKET).select(*keys, "owner", "piece").mapInArrow(
        _split, "bucket long, code long, value long, offset long, gram binary"
    ).withColumnRenamed("value", "owner")
    least = grams.groupBy("gram").agg(F.min("owner").alias("least"))
    hot = grams.join(least, "gram").filter("least < owner").select(*keys, F.col("offset").alias("first"), F.lit(LENGTH).cast("long").alias("size"))
    cuts = keep("cuts", found.unionByName(hot))
    owned = different.select(*keys, "owner")
    placed = pieces.select(*keys, "doc", "twin", "start")
    whole = pieces.select(*placed.columns, "size").join(owned, keys).filter("doc > owner").select("doc", "twin", F.col("start").alias("first"), "size")
    cut = placed.join(cuts.join(owned, keys).withColumnRenamed("owner", "doc"), [*keys, "doc"])
    return whole.unionByName(cut.select("doc", "twin", (F.col("start") + F.col("first")).alias("first"), "size"))


def repeat_groups(docs: DataFrame) -> DataFrame:
    """``group, size, doc_id, first``: every place of the maximal repeats of ``LENGTH`` bytes or more that two different texts share a window of.

    ``group`` is a hash of the repeated bytes, ``size`` their number, ``first`` where they begin in the document. Repeats are maximal as far as
    a run of windows of one bucket reaches: a longer one is a chain of groups that overlap. A repeat within another is a group too if it has more places, so the
    result may be much larger than the texts. In buckets of more than ``BUCKET`` pieces the groups are strings of ``LENGTH`` bytes. A text that is in
    several rows has its places in each of them; null texts have none.
    """
    spark, keep = docs.sparkSession, Interim("groups")
    pieces = keep("pieces", repeat_pieces(docs, keep("shared", shared_runs(docs))))
    keep.drop(spark, "shared")
    pieces = pieces.dropDuplicates(["bucket", "code", "twin", "start"])  # copies that met in no batch
    keys = ["bucket", "code"]
    different = keep("different", pieces.groupBy(*keys, "piece").agg(F.count(F.lit(1)).alias("n")))
    sized = different.join(different.groupBy("bucket").agg(F.count(F.lit(1)).alias("pieces")), "bucket")
    small = sized.filter(F.col("pieces") <= BUCKET).select(*keys, "n", "piece").repartition("bucket").sortWithinPartitions("bucket")
    found = small.mapInArrow(_maximal, "bucket long, code long, first long, size long, group long")
    grams = sized.filter(F.col("pieces") > BUCKET).select(*keys, "n", "piece").mapInArrow(
        _split, "bucket long, code long, value long, offset long, gram binary"
    )
    often = grams.groupBy("gram").agg(F.sum("value").alias("uses")).filter("uses > 1")
    hot = grams.join(often, "gram").select(*keys, F.col("offset").alias("first"), F.lit(LENGTH).cast("long").alias("size"), F.xxhash64("gram").alias("group"))
    places = found.unionByName(hot).join(pieces.select(*keys, "twin", "start"), keys)
    places = places.select("group", "size", "twin", (F.col("start") + F.col("first")).alias("first")).distinct()
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("twin"))
    return places.join(rows, "twin").select("group", "size", "doc_id", "first")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its lost ranges."""
    names = ["doc", "twin", "n_removed", "n_spans", "kept"]
    for batch in batches:
        out = [[] for _ in names[2:]]
        for i in range(batch.num_rows):
            text, rows = batch.column(2)[i].as_py().encode(), batch.column(3)[i].values
            first, size = (rows.field(f).to_numpy(zero_copy_only=False) for f in ("first", "size"))
            depth = np.zeros(len(text) + 1, np.int64)
            np.add.at(depth, first, 1)
            np.add.at(depth, first + size, -1)
            gone = np.cumsum(depth[:-1]) > 0
            out[0].append(int(gone.sum()))
            out[1].append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            out[2].append(np.frombuffer(text, np.uint8)[~gone].tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()))]], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``.

    Every byte goes that lies in a string of ``LENGTH`` bytes, in UTF-8, which also starts in a document of smaller ``doc_id``;
    strings are looked for in the texts as given. Null texts are empty; null ids come last and count as one document, as
    do rows of a repeated ``doc_id``, which keep each other's bytes. A text that a smaller document has as a whole is lost as a whole, without a search.
    Only buckets, places and the pieces around shared anchors are shuffled, and texts twice.
    """
    spark, keep = docs.sparkSession, Interim("suffixes")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = keep("rows", docs.select(
        "doc_id", _doc().alias("doc"), F.xxhash64(text).alias("twin"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"),
    ))
    shared = keep("shared", shared_runs(docs))
    pieces = keep("pieces", repeat_pieces(docs, shared))
    keep.drop(spark, "shared")
    ranges = lost_ranges(pieces, keep).groupBy("doc", "twin").agg(F.collect_list(F.struct("first", "size")).alias("ranges"))
    ranges = keep("ranges", ranges)
    keep.drop(spark, "pieces", "different", "sized", "cuts")
    cut = _texts(docs).join(ranges, ["doc", "twin"]).select("doc", "twin", "text", "ranges")
    cut = cut.mapInArrow(_without, "doc long, twin long, n_removed long, n_spans long, kept binary")
    cut = cut.select("doc", "twin", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    # rows of one doc_id and text are one text
    cut = keep("cut", cut.dropDuplicates(["doc", "twin"]))
    keep.drop(spark, "ranges")
    first = rows.groupBy("digest").agg(F.min("doc").alias("first"))
    joined = rows.join(first, "digest").join(cut, ["doc", "twin"], "left")
    copy = (F.col("first") < F.col("doc")) & (F.col("n_bytes") >= LENGTH)

    def chosen(whole: Column, part: str, none: Column) -> Column:
        return F.when(copy, whole).otherwise(F.coalesce(part, none)).alias(part)

    return joined.select(
        "doc_id", "n_bytes", chosen(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")),
        chosen(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")), chosen(F.lit(_EMPTY), "kept_sha256", F.col("digest")),
    )
