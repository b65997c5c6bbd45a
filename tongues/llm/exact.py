"""Exact duplicates by progressive refinement: length, then a hash of the head, then the full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.llm.native import ascii_lower
from tongues.sources.scratch import stored

#: Code points of the head that the second step hashes.
HEAD = 64
#: Bitmaps of 32,768 bits each that tell the third step which heads are shared: 4 KB each.
BITMAPS = 1024
_BITS = 32_768


def _slot(size: Column, head: Column) -> Column:
    return F.pmod(F.xxhash64(size, head), F.lit(BITMAPS * _BITS))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), bit.bitwiseAND(F.lit(7).cast("long")).cast("int") + 1)
    return byte.bitwiseAND(mask) != 0


def exact_groups(docs: DataFrame, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after lower-casing A to Z; null counts as empty.
    The largest ``doc_id`` of a group stays. One row stays when that ``doc_id`` itself repeats;
    null ids are smaller than all others. Step one groups rows by length; step two hashes
    the head where a length is shared; step three hashes the whole text where
    length and head are shared. Which heads those are reaches the scan as ``BITMAPS`` fixed bitmaps,
    so no text is shuffled; a false hit costs one hash and nothing else, as rows are compared on the full
    keys afterwards. ``text_sha256`` is null for rows settled before step three, unless
    ``digest`` asks for the digest of every text. Counts are partly added up before each shuffle,
    so groups may be of any size.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", text.alias("text"), F.octet_length(text).alias("size"))
    shared_sizes = sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("size")
    heads = sized.select("size", F.xxhash64(ascii_lower(F.left("text", F.lit(HEAD)))).alias("head"))
    heads = heads.groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slots = heads.join(shared_sizes, "size", "left_semi").select(_slot(F.col("size"), F.col("head")).alias("slot"))
    bitmaps = slots.groupBy(F.expr(f"slot div {_BITS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod("slot", F.lit(_BITS))).alias("bitmap")
    )
    rows = sized.withColumn("head", F.xxhash64(ascii_lower(F.left("text", F.lit(HEAD)))))
    rows = rows.withColumn("slot", _slot(F.col("size"), F.col("head"))).withColumn("bucket", F.expr(f"slot div {_BITS}"))
    rows = rows.join(F.broadcast(bitmaps), "bucket", "left")
    hit = F.col("bitmap").isNotNull() & _is_set(F.col("bitmap"), F.pmod("slot", F.lit(_BITS)))
    full = F.sha2(ascii_lower(F.col("text")), 256)
    rows = rows.select(
        "doc_id", "size", "head", F.coalesce(hit, F.lit(False)).alias("hit"), (full if digest else F.when(hit, full)).alias("text_sha256")
    )
    rows = stored(rows, "exact-rows")
    alone = rows.filter(~F.col("hit")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    keys = ["size", "head", "text_sha256"]
    members = rows.filter("hit").groupBy("doc_id", *keys).agg(F.count(F.lit(1)).alias("n"))
    groups = rows.filter("hit").groupBy(*keys).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = stored(members, "exact-members").join(stored(groups, "exact-groups"), keys)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return alone.unionByName(found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"))
