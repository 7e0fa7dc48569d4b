"""Table upkeep as snapshot expressions: inserts, updates, deletes without MERGE.

Each function returns the next content of a table.  :mod:`treeflat.sinks.store` publishes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys for the right side of a semi or anti join.

    Repeats of a hot key are combined before the shuffle; the skew join can then split the
    left side, which is the only one it may split here.
    """
    return table.select(*keys).distinct()


def insert_new(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Add the rows whose key is not there yet."""
    fresh = incoming.join(_keys(current, [key]), key, "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def update_matched(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace the rows whose key matches; other incoming rows are ignored."""
    matched = incoming.join(_keys(current, [key]), key, "left_semi")
    kept = current.join(_keys(incoming, [key]), key, "left_anti")
    return kept.unionByName(matched.select(*current.columns))


def upsert(current: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Matched rows are replaced, the others added."""
    keys = [key] if isinstance(key, str) else key
    kept = current.join(_keys(incoming, keys), keys, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def _stale(run_ts: Column, null_is_old: bool) -> Column:
    older = F.col("ingestion_ts") < run_ts
    return F.coalesce(older, F.lit(null_is_old))


def delete_stale(
    table: DataFrame, changed_ids: DataFrame, run_ts, key: str = "id", null_is_old: bool = False
) -> DataFrame:
    """Drop rows of changed ids written before this run.

    Rows without a stamp stay unless ``null_is_old``.  The ids come as a DataFrame and are
    matched by an anti join; only the stale candidates take part in it.
    """
    ids = changed_ids.select(F.col(changed_ids.columns[0]).alias(key)).distinct()
    stamp = F.lit(run_ts).cast("timestamp")
    marked = table.withColumn("#old", _stale(stamp, null_is_old))
    return marked.join(
        ids.withColumn("#old", F.lit(True)), [key, "#old"], "left_anti"
    ).select(*table.columns)


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the children of deleted parents (the key prefix they inherited)."""
    return child.join(_keys(deleted_parents, keys), keys, "left_anti")


def only_ids(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows of certain ids."""
    return table.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")


def latest_version(table: DataFrame, key: str = "id", stamp: str = "ingestion_ts") -> DataFrame:
    """The rows of each id's newest run (all of them: a child table has many rows per id).

    A max with partial results and a join back instead of a window: an id with very many
    rows is never gathered in one task.
    """
    newest = table.groupBy(key).agg(F.max(stamp).alias("#newest")).withColumnRenamed(key, "#key")
    same = (F.col(key) == F.col("#key")) & F.col(stamp).eqNullSafe(F.col("#newest"))
    return table.join(newest, same, "left_semi")


def missing_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files not yet processed with this content: per file, path and fingerprint."""
    return files.join(registry.select("file_path", "file_md5"), ["file_path", "file_md5"], "left_anti")
