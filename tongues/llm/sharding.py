"""Stable shards by jump consistent hashing, and gapless slots within them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the multiplier of the 64-bit congruential generator in the published algorithm.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = (1 << 22) - 1, (1 << 20) - 1
_C0, _C1, _C2 = MULTIPLIER & _LOW, MULTIPLIER >> 22 & _LOW, MULTIPLIER >> 44
SLOT_BUCKETS = 1024


def _limbs(key: Column) -> tuple[Column, Column, Column]:
    """A 64-bit number as 22, 22 and 20 bits, lowest first: their products never overflow."""
    low = F.lit(_LOW).cast("long")
    return key.bitwiseAND(low), F.shiftrightunsigned(key, 22).bitwiseAND(low), F.shiftrightunsigned(key, 44)


def _advance(a: Column, b: Column, c: Column) -> tuple[Column, Column, Column]:
    """``key * MULTIPLIER + 1`` modulo two to the 64th, on limbs."""
    low, high = F.lit(_LOW).cast("long"), F.lit(_HIGH).cast("long")
    x = a * F.lit(_C0) + F.lit(1)
    y = a * F.lit(_C1) + b * F.lit(_C0) + F.shiftright(x, 22)
    z = a * F.lit(_C2) + b * F.lit(_C1) + c * F.lit(_C0) + F.shiftright(y, 22)
    return x.bitwiseAND(low), y.bitwiseAND(low), z.bitwiseAND(high)


def jump(key: Column, shards: int) -> Column:
    """Struct of ``shard`` among ``shards`` and ``grown``, the shard when there is one more.

    The generator is seeded with the key; each draw jumps ahead to the next shard count at
    which the key would move, until it passes the count asked for. At most ``shards + 1``
    jumps are possible and about ``ln(shards)`` happen; the rest of the fold does nothing.
    A null key counts as zero.
    """
    key = F.coalesce(key, F.lit(0).cast("long"))
    a, b, c = _limbs(key)
    zero = F.lit(0).cast("long")

    def state(a, b, c, at, shard, grown):
        return F.struct(a.alias("a"), b.alias("b"), c.alias("c"), at.alias("at"), shard.alias("shard"), grown.alias("grown"))

    def step(s: Column, _: Column) -> Column:
        x, y, z = _advance(s["a"], s["b"], s["c"])
        draw = F.shiftleft(z, 11).bitwiseOR(F.shiftright(y, 11))  # the 31 highest bits
        ahead = (s["at"] + 1).cast("double") * (F.lit(float(1 << 31)) / (draw + 1).cast("double"))
        moved = state(x, y, z, ahead.cast("long"), F.when(s["at"] < shards, s["at"]).otherwise(s["shard"]), s["at"])
        return F.when(s["at"] <= shards, moved).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(shards + 1))
    done = F.aggregate(steps, state(a, b, c, zero, zero, zero), step)
    return F.transform(F.array(done), lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))[0]


def slot_bucket(key: Column) -> Column:
    """One of ``SLOT_BUCKETS`` parts of a shard, from bits 44 to 53 of the generator's first draw."""
    return _advance(*_limbs(F.coalesce(key, F.lit(0).cast("long"))))[2].bitwiseAND(F.lit(SLOT_BUCKETS - 1).cast("long"))


def assign_shards(rows: DataFrame, key: str, shards: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns of ``keep``, ``shard``, ``slot`` and ``grown_shard``.

    A shard's rows are numbered from zero without gaps, ordered by slot bucket, key and the
    kept columns. Equal rows are counted first and told apart only at the end, so a key
    that repeats without bound is never sorted in one task; shards are numbered through
    buckets, so no task holds a whole shard. Bucket totals come from a scan of the key alone:
    there are ``shards * SLOT_BUCKETS`` of them at most, which bounds the broadcast.
    """
    columns = [key, *keep]
    placed = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    placed = placed.withColumn("_at", jump(F.col(key), shards)).withColumn("_bucket", slot_bucket(F.col(key)))
    placed = placed.select(*columns, "_n", "_bucket", F.col("_at.shard").alias("shard"), F.col("_at.grown").alias("grown_shard"))
    totals = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    totals = totals.groupBy(jump(F.col(key), shards)["shard"].alias("shard"), slot_bucket(F.col(key)).alias("_bucket"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.agg(F.sum("_n").alias("_total")).select(
        "shard", "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("shard", "_bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_rank", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    ranked = ranked.join(F.broadcast(offsets), ["shard", "_bucket"])
    first = F.col("_offset") + F.col("_rank")
    return ranked.select(
        *columns, "shard", F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"), "grown_shard"
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shards of documents by ``doc_id``: size in bytes plus 16, CRC-32 of the text, shard and slot.

    A null text has no bytes and the checksum of the empty text; a null ``doc_id`` is placed
    like zero; repeated rows get slots of their own; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = assign_shards(rows, "doc_id", shards, ("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
