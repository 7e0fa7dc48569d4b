"""Documents made ready for training: five stages over the corpus operators.

Each stage is (name, function of (spark, docs, sf_dir)); it works on all rows that the one before kept, and its result is written as
Parquet and read again.  All but the last return the columns of ``documents``.

1. ``language``: rows whose language the compression classifier rejects (no letter, or a lead under its margin) go.
2. ``exact_dedup``: of equal texts the row with the largest id stays.
3. ``near_dedup``: of each class of the 5-word shingle Jaccard join (0.8) the smallest id stays.
4. ``decontaminate``: rows that hold at least 0.8 of a benchmark item in tiles go.
5. ``encode``: every row with its sampled SentencePiece segmentations (``SEGMENTATIONS``, ranked, without replacement), the inclusion score of
   each, and whether it decodes to the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from treeflat.llm import decontaminate, exact_dedup, jaccard_join, langid, sentencepiece_sample
from treeflat.llm.common import staged, table


#: Segmentations of a row: with one, nothing would be drawn without replacement.
SEGMENTATIONS = 2

#: Bytes that a Python worker is sent at once: batches of 10,000 long texts fill executors whose heaps have grown.
BATCH_BYTES = "4m"


def _small_batches(spark: SparkSession) -> None:
    """Stages are run after they return, so the session keeps the setting; no result depends on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return jaccard_join.keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    sampled = sentencepiece_sample.sample(docs, k=SEGMENTATIONS, run_size=150_000)  # the executors' heaps have grown by now
    return sampled.select("doc_id", "rank", "ids", F.size("ids").alias("n_pieces"), "log_prob", "log_inclusion", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", benchmark),
    ("encode", encode),
]

#: Compression, tiling and sampling are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
