"""Headline queries, timed.  Prints one JSON line.

The XML corpora are written before the clock starts (the reference is given XML files, too).
Every query is run to its last row with the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

import catalog  # noqa: E402
from catalog import changes, corpora  # noqa: E402
from treeflat.ingest import ingest  # noqa: E402

QUERIES = [
    "shred_lines", "shred_root", "shred_three_levels", "shred_flatten_containers", "shred_shared_counter",
    "shred_mixed_text", "record_ids_and_hash", "container_gate", "path_join", "reassemble", "classify_changes",
    "validate_events", "delete_stale", "latest_version", "upsert_orders", "cascade_delete", "unique_keys", "dlq_errors",
    "quality_report", "insert_roundtrip", "bulk_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    for write in (corpora.lines_corpus, corpora.paras_corpus, corpora.lists_corpus, corpora.mixed_corpus,
                  corpora.broken_corpus, corpora.gated_corpus):
        write(spark, sf_dir)
    first, second = changes._version(spark, sf_dir, False), changes._version(spark, sf_dir, True)

    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.time()
        result = run()
        seconds[name] = round(time.time() - start, 3)
        return result

    for name in QUERIES:
        timed(name, lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    job = changes._job(spark)
    timed("ingest_first", lambda: ingest(spark, first, job, changes.RUN1))
    records = job.store.read("record_registry").count()  # of the first delivery
    timed("ingest_changed", lambda: ingest(spark, second, job, changes.RUN2))
    timed("ingest_unchanged", lambda: ingest(spark, second, job))
    size = sum(r[0] for r in spark.read.format("binaryFile").load(first).select("length").collect())
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "records": records, "megabytes": round(size / 1e6, 1),
        "records_per_second_ingest": round(records / max(seconds["ingest_first"], 1e-9), 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
