"""Incremental arrival: the same run, fed by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from treeflat.ingest import Job, ingest
from treeflat.sources.files import as_pattern, plain_path

_FILE = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, path: str, glob: str = "*.xml", files_per_batch: int | None = None) -> DataFrame:
    """``file_path`` of files as they arrive; the contents are not read, the stream's checkpoint remembers the files."""
    reader = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(plain_path(F.col("_metadata.file_path")).alias("file_path"))


def ingest_stream(
    spark: SparkSession, path: str, job: Job, checkpoint: str, run_ts: str | None = None, glob: str = "*.xml",
    files_per_batch: int | None = None,
):
    """Process everything that is there and stop.  Returns the finished query.

    Each batch is a run over its files, with profiles, encodings and the file registry, so a later batch run skips them.
    Its number is published together with its tables: a batch that is repeated after a failure does nothing if they are visible.
    """

    def batch(df: DataFrame, number: int):
        paths = [as_pattern(r[0]) for r in df.orderBy("file_path").collect()]  # a scan needs the list of paths on the driver
        if paths:
            ingest(spark, paths, job, run_ts, glob=glob, batch=(checkpoint, number))

    stream = arriving(spark, path, glob, files_per_batch)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
