"""Shards of near-equal bytes, by sampled splitters.

1. A record's key is (hash of its text, id, row number), so copies lie side by side and no two keys are equal: a group
   of copies of any size can be cut.
2. Records are sampled with a chance in proportion to their weight (bytes, plus the mean as a fixed cost of any record).
   The chance is decided by a hash of the key, so a repeated task draws the same sample.
3. Quantiles of the sorted sample are the splitters.  A record finds its range by binary search over them.
4. Ranges are measured.  A range above twice the mean weight is subdivided by a finer sample of its own, until none is left.
5. Records are ranked inside their range and, with the prefix sums over the ranges, in the whole; the shard
   is the one in which the middle byte of the record lies.  So shards differ by little more than one record.

Only samples, splitters and per-range sums (``ranges`` rows) reach the driver; their number follows from the parameters and
``ROWS_PER_RANGE``.  The work on records is one shuffle of 40-byte keys; no text moves.

Defined results: a null text has no bytes (size 16) and crc32 0; null ids sort first; repeated rows are records of their own.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window, functions as F

from treeflat.llm.common import free_name, keyed, staged

#: Fixed cost of a record in bytes.
OVERHEAD = 16
#: Ranges for each shard at least ...
RANGES_PER_SHARD = 32
#: ... and so many that a range has about this many records at most.
ROWS_PER_RANGE = 500_000
#: Expected samples for each range.
SAMPLES_PER_RANGE = 16
_KEY = ["k", "id", "row"]
_LAST = (2**63 - 1,) * 3


def _longs(values) -> Column:
    return F.lit([int(v) for v in values]).cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _range_of(splitters: list[tuple]) -> Column:
    """How many splitters are at most the record's key: a binary search in a handful of steps."""
    steps = max(1, len(splitters).bit_length())
    padded = sorted(splitters) + [_LAST] * (2**steps - 1 - len(splitters))
    arrays = [_longs([s[i] for s in padded]) for i in range(3)]

    def at_most(at: Column) -> Column:
        a, b, c = (F.get(x, at) for x in arrays)
        k, i, r = (F.col(x) for x in _KEY)
        return (a < k) | ((a == k) & ((b < i) | ((b == i) & (c <= r))))

    return F.aggregate(
        F.lit([2**s for s in range(steps - 1, -1, -1)]),
        F.lit(0),
        lambda low, step: F.when(at_most(low + step - 1), low + step).otherwise(low),
    )


def _sampled(keys: DataFrame, chance: Column, round_: int) -> list[tuple]:
    u = F.shiftrightunsigned(F.xxhash64(*_KEY, F.lit(round_)), 12) / F.lit(float(2**52))
    return sorted(tuple(r) for r in keys.filter(u < chance).select(*_KEY).collect())


def splitters_of(keys: DataFrame, ranges: int, weight: Column, total: float) -> list[tuple]:
    """Sorted splitters for about ``ranges`` ranges of equal weight, overfull ranges subdivided."""
    mean = total / ranges
    sample = _sampled(keys, weight * F.lit(SAMPLES_PER_RANGE / mean), 0)
    splitters = sample[SAMPLES_PER_RANGE - 1 :: SAMPLES_PER_RANGE]
    for round_ in range(1, 9):
        found = keys.withColumn("range", _range_of(splitters))
        full = {
            r["range"]: r["w"]
            for r in found.groupBy("range").agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n")).filter((F.col("w") > 2 * mean) & (F.col("n") > 1)).collect()
        }
        if not full:
            break
        inside = found.filter(F.col("range").isin(list(full)))
        finer = 4 ** min(round_, 3) * SAMPLES_PER_RANGE
        more: dict[int, list[tuple]] = {}
        for s in _sampled(inside, weight * F.lit(finer / mean), round_):
            more.setdefault(bisect_right(splitters, s), []).append(s)
        added: set[tuple] = set()
        for r, found_keys in more.items():
            parts = int(full[r] / mean) + 1
            added |= {found_keys[len(found_keys) * p // parts] for p in range(1, parts)}
        splitters = sorted({*splitters, *added})
    return splitters


def shards(docs: DataFrame, count: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (the law is ``bytes``: nothing is said about growing)."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = staged(
        keyed(docs, key, text).select(
            "doc_id",
            (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.xxhash64(content).alias("k"),
            F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long")).alias("id"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-keys",
    )
    got = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n, total = got["n"], got["bytes"] or 0
    ranges = max(count * RANGES_PER_SHARD, -(-n // ROWS_PER_RANGE))
    weight = F.col("size") + F.lit(total / max(n, 1))
    splitters = splitters_of(keys, ranges, weight, max(2.0 * total, 1.0))
    placed = keys.withColumn("range", _range_of(splitters))
    sums = {r["range"]: (r["n"], r["bytes"]) for r in placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()}
    rows_before, bytes_before = [0], [0]
    for r in range(len(splitters) + 1):
        rows, size = sums.get(r, (0, 0))
        rows_before.append(rows_before[-1] + rows)
        bytes_before.append(bytes_before[-1] + size)
    within = Window.partitionBy("range").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.get(_longs(rows_before), F.col("range")) + F.count(F.lit(1)).over(within) - 1
    end = F.get(_longs(bytes_before), F.col("range")) + F.sum("size").over(within)
    middle = (2 * end - F.col("size")).cast("decimal(38,0)") * count
    shard = F.least(F.floor(middle / F.lit(2 * max(total, 1)).cast("decimal(38,0)")).cast("int"), F.lit(count - 1))
    ranked = staged(placed.select("doc_id", "size", "text_crc32", rank.alias("rank"), shard.alias("shard")), "shard-ranks")
    starts = {r["shard"]: r["start"] for r in ranked.groupBy("shard").agg(F.min("rank").alias("start")).collect()}
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.get(_longs([starts.get(s, 0) for s in range(count)]), F.col("shard"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, count: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` (unique ids) as Parquet, a folder per shard, cut into files by AQE and sorted by slot inside a file.

    Shard and slot are the columns ``_shard`` and ``_slot``, with underscores added where ``docs`` has such columns.
    """
    own, shard, slot = (free_name(docs.columns, n) for n in ("_shard_id", "_shard", "_slot"))
    placed = shards(docs, count, key, text).select(F.col("doc_id").alias(own), F.col("shard").alias(shard), F.col("slot").alias(slot))
    joined = docs.join(placed, F.col(f"`{key}`").cast("long") == F.col(own)).drop(own)
    joined.hint("rebalance", F.col(shard)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
