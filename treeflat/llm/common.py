"""What the corpus operators share: reading tables, staging, checked sizes."""

from __future__ import annotations

import ctypes
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeflat.session import fresh_folder, shared_folder, staged

__all__ = ["crc32_of_id", "free_name", "fresh_folder", "keyed", "released", "shared_folder", "ship", "staged", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator works on, under names of its own: whatever else ``df`` has cannot clash."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def crc32_of_id(key: Column) -> Column:
    """crc32 of the decimal id, as a non-negative number; null ids give null."""
    return F.crc32(key.cast("string").cast("binary"))


def ship(module_name: str) -> None:
    """Send this module's functions along with the tasks: executors then need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def released(run):
    """``run``, a function of batches, that gives freed memory back to the system after each batch: idle workers stay small."""

    def outer(batches):
        try:
            libc = ctypes.CDLL(None)
            trim = libc.malloc_trim
        except (OSError, AttributeError):  # no glibc
            trim = None
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
            if trim:
                trim(0)
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)

    return outer


ship(__name__)
