"""Session helpers: the shared scratch folder and checked broadcasts."""

from __future__ import annotations

from contextlib import contextmanager
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: A side is broadcast only when it has at most this many rows ...
BROADCAST_ROWS = 200_000
#: ... and at most this many bytes of text.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset (local
    tests) a temporary folder is created and set as the checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = "file://" + tempfile.mkdtemp(prefix="treeflat-")
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage so that several consumers share one evaluation, and survives the
    loss of executors (nothing is held in executor memory).
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_with_tasks(module_name: str) -> None:
    """Send this module's functions along with the tasks that use them.

    Executors then need no installed copy of the package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


@contextmanager
def exact_names(spark: SparkSession):
    """Match names by case while a run executes, then restore the session's setting.

    XML names are case sensitive.  With the setting on, the parser is exact and faster, and
    records need no extra test for names in other spellings.
    """
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)
