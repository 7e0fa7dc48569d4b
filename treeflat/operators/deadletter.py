"""Dead letters: one shape for record-level and row-level failures, enriched for debugging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from treeflat.functions.text import error_fingerprint, file_safe, id_prefix, iso_utc, parse_iso

BASE = ["record_id", "table_name", "xml", "row", "error", "error_type", "pipeline_step"]


def unified(parts: list[DataFrame], step: str | None = None) -> DataFrame:
    """Bring failures of every kind into one shape."""

    def shaped(df):
        have = df.columns
        cols = []
        for c in BASE:
            if c in have:
                cols.append(F.col(c).cast("string"))
            elif c == "pipeline_step" and step:
                cols.append(F.lit(step).alias(c))
            elif c == "record_id" and "uid" in have:
                cols.append(F.col("uid").alias(c))
            else:
                cols.append(F.lit(None).cast("string").alias(c))
        return df.select(*cols)

    return reduce(DataFrame.unionByName, [shaped(p) for p in parts])


def enriched(letters: DataFrame, stamp=None) -> DataFrame:
    """Add time, error hash, worker and id prefix.  ``stamp`` fixes the time (a timestamp)."""
    now = F.current_timestamp() if stamp is None else F.lit(stamp).cast("timestamp")
    return letters.select(
        *letters.columns,
        iso_utc(now).alias("timestamp"),
        F.unix_timestamp(now).alias("timestamp_epoch"),
        error_fingerprint(F.col("error_type"), F.col("error")).alias("error_hash"),
        F.spark_partition_id().cast("string").alias("worker_id"),
        id_prefix(F.col("record_id")).alias("record_id_prefix"),
    )


def by_error(letters: DataFrame) -> DataFrame:
    return letters.groupBy("error_type", "error_hash").agg(F.count(F.lit(1)).alias("letters"))


def rate(letters: DataFrame, processed: DataFrame) -> DataFrame:
    """Share of failures among everything processed: two partial sums over one union."""
    one, none = F.lit(1), F.lit(0)
    both = letters.select(one.alias("f"), none.alias("p")).unionAll(processed.select(none.alias("f"), one.alias("p")))
    sums = both.agg(F.sum("f").alias("failed"), F.sum("p").alias("processed"))
    return sums.select("failed", "processed", F.try_divide(F.col("failed"), F.col("processed")).alias("rate"))


def with_partition(letters: DataFrame) -> DataFrame:
    """Year, month, day of the letter and its file name; ``unknown`` if the time cannot be read."""
    ts = parse_iso(F.col("timestamp"))

    def part(pattern):
        return F.coalesce(F.date_format(ts, pattern), F.lit("unknown"))

    name = F.concat(
        file_safe(F.coalesce("record_id", F.lit("unknown"))), F.lit("_"), F.coalesce("error_hash", F.lit("nohash")),
        F.lit(".json"),
    )
    return letters.withColumns({"year": part("yyyy"), "month": part("MM"), "day": part("dd"), "file_name": name})


def write_jsonl(letters: DataFrame, path: str, shards: int | None = None) -> None:
    """Compact JSON lines.  The rebalance gives files of a sensible size; ``shards`` fixes their number."""
    spread = letters.repartition(shards) if shards else letters.hint("rebalance")
    spread.select(F.to_json(F.struct(*letters.columns)).alias("value")).write.text(path)


def write_by_day(letters: DataFrame, path: str) -> None:
    """One folder per day; runs add to what is there.  The rebalance keeps files large and splits a heavy day."""
    dated = with_partition(letters).hint("rebalance", "year", "month", "day")
    dated.write.mode("append").partitionBy("year", "month", "day").json(path)


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in BASE) + (
        ", timestamp string, timestamp_epoch bigint, error_hash string, worker_id string, record_id_prefix string"
    )
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def replayable(letters: DataFrame, with_origin: bool = False) -> DataFrame:
    """The record texts among the letters, to be split and shredded again after a repair."""
    return letters.where("xml is not null").select("record_id", "xml", *(["error", "timestamp"] if with_origin else []))
