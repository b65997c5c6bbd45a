"""SentencePiece encoding and decoding; giant texts are encoded by a max-plus parallel scan over chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tongues.sources.scratch import stored

#: The model file on the driver; tasks get its bytes and tables by broadcast, whose size is that of the vocabulary.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts longer than ``GIANT`` code points are cut into chunks of ``CHUNK`` that are worked on separately.
GIANT, CHUNK = 65_536, 8_192
#: Transfer matrices that one group combines.
SPAN = 256
#: Words whose ids a worker remembers.
REMEMBERED = 100_000
_SPACE = "▁"
_WORD = re.compile(" +[^ ]*")
_SLOTS = 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PENALTY = 10.0
_NONE = -np.inf

State = tuple[int, int]  # start and end of a piece
START: State = (-1, 0)


@dataclass
class Vocabulary:
    """Pieces of a model as a trie in flat tables, ready for whole arrays of positions at once.

    The best path through the lattice of pieces is the model's own encoding. In a unigram model
    a piece weighs its score. In a merging model all pieces weigh nothing, and two pieces may only be
    neighbours if merging their joint text gives just these two: a segmentation is what merging
    yields exactly when all its neighbours pass that test, so one path remains.
    """

    proto: bytes
    merging: bool
    scores: np.ndarray
    surfaces: list[bytes]
    pieces: dict[str, int]
    bytes_from: int
    unknown: float
    longest: int
    by_word: bool
    first: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    piece: np.ndarray
    texts: dict[int, str]
    tested: dict[tuple[int, int], bool] = field(default_factory=dict)

    @staticmethod
    def load(path: str, merging: bool | None = None) -> Vocabulary:
        """Read a model; ``merging`` overrides what its trainer settings say."""
        import sentencepiece

        proto = Path(path).read_bytes()
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = model.vocab_size()
        scores = np.array([model.get_score(i) for i in range(size)])
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        octets = [i for i in range(size) if model.is_byte(i)]
        if len(octets) != 256 or octets[-1] - octets[0] != 255:
            raise ValueError("the model has no byte pieces to fall back on")
        texts = {i: model.id_to_piece(i).replace(_SPACE, " ") for i in plain}
        surfaces = [b""] * size
        for i, p in texts.items():
            surfaces[i] = p.encode()
        for i in octets:
            surfaces[i] = bytes([i - octets[0]])
        edges: dict[tuple[int, int], int] = {}
        piece = [-1]
        for i, p in texts.items():
            at = 0
            for c in map(ord, p):
                if (at, c) not in edges:
                    edges[at, c] = len(piece)
                    piece.append(-1)
                at = edges[at, c]
            piece[at] = i
        first = np.zeros(0x110000, np.int32)
        keys, targets = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS, np.int32)
        for (at, c), to in edges.items():
            if at == 0:
                first[c] = to
                continue
            key = at << 21 | c
            slot = int(_slot(np.array([key]))[0])
            while keys[slot] >= 0:
                slot = (slot + 1) % len(keys)
            keys[slot], targets[slot] = key, to
        return Vocabulary(
            proto, _merges(proto) if merging is None else merging, scores, surfaces, {p: i for i, p in texts.items()}, octets[0],
            float(min(scores[plain])) - _PENALTY, max(map(len, texts.values())), not any(" " in p.lstrip(" ") for p in texts.values()),
            first, keys, targets, np.array(piece, np.int32), texts,
        )

    def _follow(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Child nodes, 0 where there is none."""
        key = nodes.astype(np.int64) << 21 | codes
        slot = _slot(key)
        out = np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[slot]
            hit = held == key[todo]
            out[todo[hit]] = self.targets[slot[hit]]
            on = ~hit & (held >= 0)
            todo, slot = todo[on], (slot[on] + 1) % len(self.keys)
        return out

    def lattice(self, codes: np.ndarray) -> list[list[tuple[int, int]]]:
        """For every start, ``(end, piece)`` of the pieces there; piece -1 is a code point that no piece is."""
        found = np.full((self.longest, len(codes)), -1, np.int32)
        nodes, at = self.first[codes], np.arange(len(codes))
        for k in range(self.longest):
            if k:
                inside = at + k < len(codes)
                at, nodes = at[inside], nodes[inside]
                nodes = self._follow(nodes, codes[at + k])
            going = nodes > 0
            at, nodes = at[going], nodes[going]
            found[k, at] = self.piece[nodes]
        out: list[list[tuple[int, int]]] = [[(i + 1, -1)] if alone else [] for i, alone in enumerate((found[0] < 0).tolist())]
        lengths, starts = np.nonzero(found >= 0)
        for start, length, piece in zip(starts.tolist(), lengths.tolist(), found[lengths, starts].tolist()):
            out[start].append((start + length + 1, piece))
        return out

    def weight(self, piece: int) -> float:
        if self.merging:
            return 0.0
        return self.unknown if piece < 0 else float(self.scores[piece])

    def neighbours(self, a: int, b: int) -> bool:
        """Whether piece ``b`` may follow piece ``a``; anything may stand next to an unknown code point."""
        if not self.merging or a < 0 or b < 0:
            return True
        key = (a, b)
        known = self.tested.get(key)
        if known is None:
            if len(self.tested) > 1 << 21:
                self.tested.clear()
            known = self.tested[key] = self.merge(self.texts[a] + self.texts[b]) == [self.texts[a], self.texts[b]]
        return known

    def merge(self, text: str) -> list[str]:
        """Merge the neighbours whose joint piece has the best score, leftmost first, until none is left."""
        parts = list(text)
        while True:
            best, at = _NONE, -1
            for i in range(len(parts) - 1):
                joint = self.pieces.get(parts[i] + parts[i + 1])
                if joint is not None and self.scores[joint] > best:
                    best, at = self.scores[joint], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def spell(self, piece: int, code: int) -> list[int]:
        if piece >= 0:
            return [piece]
        return [self.bytes_from + x for x in chr(code).encode("utf-8", "surrogatepass")]


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * _MIX) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of the fields of a protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            at += 8 if kind == 1 else 4


def _merges(proto: bytes) -> bool:
    """Whether the trainer settings of a model (field 2) name merging (2) as its type (field 3); unigram is 1."""
    return any(k == 3 and v == 2 for n, spec in _fields(proto) if n == 2 for k, v in _fields(spec))


def codes_of(text: str) -> np.ndarray:
    """Code points; the sign that stands for a space in pieces is a space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(codes == ord(_SPACE), ord(" "), codes)


def boundary(lattice: list[list[tuple[int, int]]], at: int, longest: int) -> list[tuple[State, int]]:
    """States at a boundary: the pieces, with their places, that start before it and end at it or past it."""
    return [
        ((start, end), piece) for start in range(max(0, at - longest), at) for end, piece in lattice[start] if end >= at
    ]


def _walk(v: Vocabulary, lattice: list, entries: list[tuple[State, int]], a: int, b: int) -> dict[State, tuple[int, np.ndarray, State | None]]:
    """Best scores from every entry state to all pieces that start in ``[a, b)``.

    By place of the piece: the piece, one score for each entry, and its best predecessor for the first.
    """
    nodes: dict[State, tuple[int, np.ndarray, State | None]] = {}
    ending: dict[int, list[State]] = {}
    for i, (place, piece) in enumerate(entries):
        scores = np.full(len(entries), _NONE)
        scores[i] = 0.0
        nodes[place] = (piece, scores, None)
        ending.setdefault(place[1], []).append(place)
    for start in range(a, b):
        before = ending.pop(start, None)
        if not before:
            continue
        for end, piece in lattice[start]:
            best, came = None, None
            for place in before:
                previous, scores, _ = nodes[place]
                if place == START or v.neighbours(previous, piece):
                    if best is None:
                        best, came = scores, place
                    else:
                        came = place if scores[0] > best[0] else came
                        best = np.maximum(best, scores)
            if best is not None:
                nodes[start, end] = (piece, best + v.weight(piece), came)
                ending.setdefault(end, []).append((start, end))
    return nodes


def transfer(v: Vocabulary, lattice: list, a: int, b: int, begins: bool) -> np.ndarray:
    """The chunk's max-plus matrix, from the states at ``a`` to those at ``b``; the text itself has one state at its beginning."""
    entries = [(START, -1)] if begins else boundary(lattice, a, v.longest)
    exits = boundary(lattice, b, v.longest)
    nodes = _walk(v, lattice, entries, a, b)
    blank = np.full(len(entries), _NONE)
    return np.array([nodes[place][1] if place in nodes else blank for place, _ in exits]).reshape(len(exits), len(entries)).T


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: first ``a``, then ``b``."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """The max-plus product of some chunks' matrices, in order."""
    return reduce(compose, matrices)


def boundary_states(matrices: list[np.ndarray], entry: int = 0, leave: int | None = None) -> list[int]:
    """The states of a best path from state ``entry`` to state ``leave``, the best one by default, at the start of each chunk and after the last one."""
    scores = [np.full(matrices[0].shape[0], _NONE)]
    scores[0][entry] = 0.0
    for m in matrices:
        scores.append((scores[-1][:, None] + m).max(0))
    states = [int(scores[-1].argmax()) if leave is None else leave]
    for score, m in zip(reversed(scores[:-1]), reversed(matrices)):
        states.append(int((score + m[:, states[-1]]).argmax()))
    return states[::-1]


def backtrace(v: Vocabulary, lattice: list, codes: np.ndarray, a: int, b: int, begins: bool, entry: int, leave: int) -> list[int]:
    """Ids of the pieces of a best path that start in one chunk, between given states; needs nothing of other chunks."""
    first = (START, -1) if begins else boundary(lattice, a, v.longest)[entry]
    last = boundary(lattice, b, v.longest)[leave][0]
    nodes = _walk(v, lattice, [first], a, b)
    path: list[State] = []
    while last != first[0]:
        path.append(last)
        last = nodes[last][2]
    return [i for place in reversed(path) for i in v.spell(nodes[place][0], int(codes[place[0]]))]


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _texts(ids: list[np.ndarray], surfaces: list[bytes]) -> pa.Array:
    """The bytes of all pieces in order, without the space that encoding put in front."""
    octets = (b"".join([surfaces[i] for i in x.tolist()]) for x in ids)
    return pa.array([o.removeprefix(b" ").decode("utf-8", "replace") for o in octets], pa.string())


def _short(shared, decoded: bool, slice_: int = 250):
    """Texts of up to ``GIANT`` code points: word by word where no piece goes past a word, so that words repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        proto, by_word, surfaces = shared.value
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        space = model.piece_to_id(_SPACE)
        known: dict[str, bytes] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, slice_):
                batch = whole.slice(at, slice_)
                texts = [t.as_py().replace(_SPACE, " ") for t in batch.column(batch.schema.get_field_index("text"))]
                if by_word:
                    split = [_WORD.findall(" " + t) if t else [] for t in texts]
                    if len(known) > REMEMBERED:
                        known = {}
                    new = [w for w in {w for words in split for w in words} if w not in known]
                    for word, ids in zip(new, model.encode([w[1:] for w in new], num_threads=1)):
                        known[word] = np.array(ids if len(word) > 1 else [space], np.int32).tobytes()
                    ids = [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in split]
                else:
                    ids = [np.array(x, np.int32) for x in model.encode(texts, num_threads=1)]
                more = {"ids": _lists(ids)} | ({"decoded": _texts(ids, surfaces)} if decoded else {})
                yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])

    return run


def _read(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(m).reshape(-1, w) for m, w in zip(table["matrix"].to_pylist(), table["width"].to_pylist())]


def scan(moves: DataFrame, span: int = SPAN) -> DataFrame:
    """``tid, k, entry, leave``: the states of a best path of each text before and after each of its chunks ``k``, from their matrices."""

    def up(table: pa.Table) -> pa.Table:
        m = product(_read(table.sort_by("k")))
        return pa.table({"tid": table["tid"][:1], "k": table["block"][:1], "matrix": pa.array([m.tobytes()], pa.binary()), "width": pa.array([m.shape[1]], pa.int32())})

    def down(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        at = boundary_states(_read(table), table["from"][0].as_py(), table["to"][0].as_py())
        return pa.table({"tid": table["tid"], "k": table["k"], "entry": pa.array(at[:-1], pa.int32()), "leave": pa.array(at[1:], pa.int32())})

    block = F.expr(f"k div {span}").alias("block")
    levels = [stored(moves, "matrices")]
    while (levels[-1].agg(F.max("k")).first()[0] or 0) >= span:
        above = levels[-1].select("*", block).groupBy("tid", "block").applyInArrow(up, "tid string, k long, matrix binary, width int")
        levels.append(stored(above, "matrices"))
    # a text begins in its only state, 0, and ends in its best one
    ends = levels[-1].select("*", F.lit(0).alias("from"), F.lit(None).cast("int").alias("to"), F.lit(0).cast("long").alias("block"))
    for i in range(len(levels) - 1, -1, -1):
        found = ends.groupBy("tid", "block").applyInArrow(down, "tid string, k long, entry int, leave int")
        if i:
            found = stored(found.select("tid", F.col("k").alias("block"), F.col("entry").alias("from"), F.col("leave").alias("to")), "states")
            ends = levels[i - 1].select("*", block).join(found, ["tid", "block"])
    return found


def _giants(texts: DataFrame, v: Vocabulary, chunk: int) -> DataFrame:
    """``tid, ids`` of distinct giant texts ``tid, text``.

    Chunks are rows of their own, with a margin in which the pieces across their boundaries lie. Each yields its
    transfer matrix. As the product is associative, the matrices of ``SPAN`` neighbours are combined into one, and so on until a text has
    ``SPAN`` at most; from these the states at the boundaries are handed down again, level by level, so no group has more than
    ``SPAN`` matrices. Each chunk is then traced back on its own.
    """
    shared = texts.sparkSession.sparkContext.broadcast(v)
    margin = v.longest
    spaced = F.concat(F.lit(" "), F.col("text"))
    total = F.char_length(spaced)
    starts = F.expr(f"transform(sequence(0, (char_length(text)) div {chunk}), k -> cast(k * {chunk} AS int))")
    chunks = texts.select("tid", spaced.alias("text"), total.alias("total"), F.explode(starts).alias("start"))
    left = F.greatest(F.lit(0), F.col("start") - margin)
    stop = F.least(F.col("start") + chunk, F.col("total"))
    chunks = chunks.select(
        "tid", "start", (F.col("start") - left).alias("a"), (stop - left).alias("b"),
        F.substring("text", left + 1, stop - left + margin).alias("part"),
    )
    chunks = stored(chunks, "chunks")
    # a chunk is few bytes and much work: fixed partitions keep small files and shuffles from ending up in a few tasks
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            found, widths = [], []
            for start, a, b, part in zip(*[batch.column(n).to_pylist() for n in ("start", "a", "b", "part")]):
                m = transfer(v, v.lattice(codes_of(part)), a, b, start == 0)
                found.append(m.tobytes())
                widths.append(m.shape[1])
            columns = [batch.column("tid"), batch.column("start"), pa.array(found, pa.binary()), pa.array(widths, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["tid", "start", "matrix", "width"])

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            ids = []
            for start, a, b, part, entry, leave in zip(*[batch.column(n).to_pylist() for n in ("start", "a", "b", "part", "entry", "leave")]):
                codes = codes_of(part)
                ids.append(np.array(backtrace(v, v.lattice(codes), codes, a, b, start == 0, entry, leave), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("tid"), batch.column("start"), _lists(ids)], ["tid", "start", "ids"])

    # by other expressions than the join's keys, as an exchange that the join makes needless is dropped, and its own has few tasks
    dealt = F.xxhash64(F.lit(4), "tid", "start")
    moves = chunks.repartition(tasks, dealt).mapInArrow(matrices, "tid string, start int, matrix binary, width int")
    fixed = scan(moves.select("tid", F.expr(f"start div {chunk}").alias("k"), "matrix", "width"))
    fixed = fixed.select("tid", (F.col("k") * chunk).cast("int").alias("start"), "entry", "leave")
    placed = chunks.join(fixed, ["tid", "start"]).select("tid", "start", "a", "b", "part", "entry", "leave")
    traced = placed.repartition(tasks, dealt).mapInArrow(traces, "tid string, start int, ids array<int>")
    parts = traced.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("start", "ids"))).alias("parts"))
    return parts.select("tid", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, path: str = MODEL, giant: int = GIANT, chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, and ``decoded`` if asked for, the model's encoding of the whole ``text``; null texts are empty and have no ids.

    A leading space is added, as the model does; code points that are no piece are spelled in bytes. Texts of more than
    ``giant`` code points go through the parallel scan, each distinct one once, and come out the same.
    """
    v = Vocabulary.load(path)
    shared = docs.sparkSession.sparkContext.broadcast((v.proto, v.by_word, v.surfaces))
    docs = docs.drop("ids", "decoded").withColumn("text", F.coalesce("text", F.lit("")))
    long = F.char_length("text") > giant
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = T.StructType([*schema.fields, T.StructField("decoded", T.StringType())])
    short = docs.filter(~long).mapInArrow(_short(shared, decoded), schema)
    giants = docs.filter(long).withColumn("_tid", F.sha2("text", 256))
    distinct = giants.groupBy(F.col("_tid").alias("tid")).agg(F.first("text").alias("text"))
    ids = stored(_giants(distinct, v, chunk), "giant-ids")
    joined = giants.join(ids, giants["_tid"] == ids["tid"]).select(*docs.columns, "ids")
    return short.unionByName(decode(joined, path) if decoded else joined)


def decode(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """``rows`` with ``decoded``, the text that ``ids`` spell; null ids spell the empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(path).surfaces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = shared.value
        for batch in batches:
            ids = [x.values.to_numpy() if x.is_valid else np.empty(0, np.int32) for x in batch.column(batch.schema.get_field_index("ids"))]
            texts = _texts(ids, surfaces)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    rows = rows.drop("decoded")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def tokenize(docs: DataFrame, path: str = MODEL, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of every row.

    ``round_trip`` says that decoding gives the text back; the model has one sign for a space and
    for U+2581, so a text with the latter comes back with spaces.
    """
    found = encode(docs.select("doc_id", "text"), path, giant, chunk, decoded=True)
    same = F.col("decoded") == F.replace("text", F.lit(_SPACE), F.lit(" "))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))
