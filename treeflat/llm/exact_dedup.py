"""Exact duplicates by two passes over a Bloom filter.

Pass 1 hashes every text to two slots of a bit table and counts how often each slot was hit (map-side
partial counts; 12 bytes a slot travel, never text).  The slots that were hit at least twice become
4 KB bitmaps: the filter of *possibly repeated* hashes.

Pass 2 probes the filter, broadcast.  A row of which either slot was hit once is unique for certain and
goes straight through.  Only the other rows are shuffled, grouped by SHA-256 and decided exactly; a false
positive of the filter costs a shuffle of that row and changes no result.

The filter takes 16 bits a row up to ``MAX_FILTER_BYTES``.  Over more rows than that holds (half a
billion bits) it fills up, more rows take the shuffle, and the results stay the same.

Defined results: a null text equals the empty text.  The largest id of a group stays; a null id is smaller
than every other, and a group of null ids only has ``keep_id`` null and is kept.  A row given twice (same
id, same text) is one document: the report marks both rows kept, ``drop_exact_duplicates`` emits it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treeflat.llm.common import keyed, staged

#: Upper bound of what pass 2 broadcasts.
MAX_FILTER_BYTES = 64 * 1024 * 1024
_BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions


def half_bits(rows: int) -> int:
    """Bits of each half of the filter: the power of two from 8 a row on, within the bound."""
    bits = _BITMAP_BITS
    while bits < 8 * rows and bits < MAX_FILTER_BYTES * 4:
        bits *= 2
    return bits


def _slots(h: Column, bits: int) -> tuple[Column, Column]:
    """Two slots from one 64-bit hash, numbered from 1 as the bitmap functions want; the second in the second half."""
    mask = F.lit(bits - 1).cast("long")
    return h.bitwiseAND(mask) + 1, F.shiftrightunsigned(h, 32).bitwiseAND(mask) + (bits + 1)


def repeated_filter(hashes: DataFrame, h: str, bits: int) -> DataFrame:
    """(bucket, bits): the slots that at least two rows hit."""
    first, second = _slots(F.col(h), bits)
    hit = hashes.select(F.explode(F.array(first, second)).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    return (
        hit.filter("n > 1")
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )


def bit_at(bits: Column, position: Column) -> Column:
    """Whether the bit is set; false for no bitmap."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8 + 1).cast("int"))
    return F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))


def probe(rows: DataFrame, h: str, filter_: DataFrame, bits: int, name: str) -> DataFrame:
    """``rows`` with the boolean column ``name``: whether the filter says that the hash may be repeated."""
    kept = [F.col(c) for c in rows.columns]
    first, second = _slots(F.col(h), bits)
    # at most 2 * bits / 32768 rows of 4 KB: bounded by MAX_FILTER_BYTES whatever the input
    one = F.broadcast(filter_.select(F.col("bucket").alias("_bucket1"), F.col("bits").alias("_bits1")))
    two = F.broadcast(filter_.select(F.col("bucket").alias("_bucket2"), F.col("bits").alias("_bits2")))
    return (
        rows.join(one, F.bitmap_bucket_number(first) == F.col("_bucket1"), "left")
        .join(two, F.bitmap_bucket_number(second) == F.col("_bucket2"), "left")
        .select(*kept, (bit_at(F.col("_bits1"), F.bitmap_bit_position(first)) & bit_at(F.col("_bits2"), F.bitmap_bit_position(second))).alias(name))
    )


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    keys = staged(keyed(docs, key, text).select("doc_id", F.unhex(sha).alias("sha")), "dedup-keys")
    hashed = keys.withColumn("h", F.xxhash64("sha"))
    bits = half_bits(keys.count())
    probed = probe(hashed, "h", staged(repeated_filter(hashed, "h", bits), "dedup-filter"), bits, "maybe")
    maybe = probed.filter("maybe").select("doc_id", "sha")
    # written first: a join of two plain tables can be broadcast if small, and split where one group is large
    groups = staged(maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    decided = maybe.join(groups, "sha")
    straight = probed.filter("NOT maybe").select("sha", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return decided.unionByName(straight).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each text, all columns; only rows that may have a copy are shuffled.

    Of equal texts the largest id stays; of rows with the same id and text, the one whose JSON form is largest.
    """
    if not docs.columns:
        return docs
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(
        row.alias("row"),
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)).alias("sha"),
    )
    bits = half_bits(docs.count())
    filter_ = staged(repeated_filter(packed.select(F.xxhash64("sha").alias("h")), "h", bits), "dedup-filter")
    probed = probe(packed.withColumn("h", F.xxhash64("sha")), "h", filter_, bits, "maybe")
    winners = (
        probed.filter("maybe")
        .groupBy("sha")
        .agg(F.max_by("row", F.struct("doc_id", F.to_json("row"))).alias("row"))
        .select("row")
    )
    out = probed.filter("NOT maybe").select("row").unionByName(winners)
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
