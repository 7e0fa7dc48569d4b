"""Keys, references, counts: the checks run on finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from treeflat.operators import validate
from treeflat.plans.contracts import Contracts
from treeflat.plans.mapping import Mapping


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Children whose (complete) key has no parent."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return child.where(complete).join(parent.select(*keys).distinct(), keys, "left_anti")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first."""
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("row_count"), "table_name")


def count_vs_distinct(table: DataFrame, key: str) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total"), F.countDistinct(key).alias("distinct_ids"))


def ingest_dates(table: DataFrame, stamp: str = "ingestion_ts") -> DataFrame:
    return table.select(F.date_format(stamp, "yyyy-MM-dd").alias("ingest_date")).distinct()


def latest_rows(table: DataFrame, stamp: str, k: int, ties: list[str]) -> DataFrame:
    """The k newest rows (a top-k: each task keeps k)."""
    return table.orderBy(F.desc(stamp), *ties).limit(k)


def duplicate_hashes(records: DataFrame) -> DataFrame:
    return duplicate_keys(records, ["record_hash"])


def records_per_file(records: DataFrame) -> DataFrame:
    return records.groupBy("source_file").agg(F.count(F.lit(1)).alias("record_count"))


def field_difference(table: DataFrame, contract_names: list[str]) -> list[str]:
    """Columns the contract does not declare (names only, no data is read)."""
    return sorted(set(table.columns) - set(contract_names))


def lineage_counts(tables: dict[str, DataFrame], mapping: Mapping) -> DataFrame:
    """Each parent -> child edge with the number of rows on both ends."""
    spark = next(iter(tables.values())).sparkSession
    counts = row_counts(tables)
    edges = mapping.lineage(spark)
    parents = counts.select(F.col("table_name").alias("parent_table"), F.col("row_count").alias("parent_rows"))
    children = counts.select(F.col("table_name").alias("child_table"), F.col("row_count").alias("child_rows"))
    return edges.join(parents, "parent_table").join(children, "child_table").select(
        "parent_table", "child_table", "parent_rows", "child_rows"
    )


def quality_report(
    tables: dict[str, DataFrame], mapping: Mapping, contracts: Contracts, ranges: dict[str, dict[str, tuple]] | None = None
) -> DataFrame:
    """One row per table and check with the number of failures (0 = passed).

    One aggregate over a table answers whether it is populated, how many rows break its contract, and how many values lie
    outside ``ranges`` (table -> column -> (low, high), closed; NULL passes); one over its keys tells repeated keys and, where it
    has a parent, keys without one: the keys of both go through one grouping, in which each side is first added up per task.
    """
    found = []
    for name, rows in tables.items():
        one = F.lit(1)
        checks = {"populated": F.when(F.count(one) == 0, 1).otherwise(0)}
        judged = rows
        if name in contracts:
            judged = validate.checked(rows, contracts[name])
            checks["types"] = F.count(F.when(F.col("error").isNotNull(), one))
        for column, (low, high) in (ranges or {}).get(name, {}).items():
            checks[f"range of {column}"] = F.count(F.when(~F.col(f"`{column}`").between(low, high), one))
        sums = judged.agg(*[c.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks.values())])
        cells = F.array(*[F.struct(F.lit(check).alias("check"), F.col(f"c{i}").alias("failures")) for i, check in enumerate(checks)])
        found.append(sums.select(F.explode(cells).alias("cell")).select(F.lit(name).alias("table_name"), "cell.check", "cell.failures"))
        opening = mapping.openings(name)[0]
        found.append(_failures(name, "unique key", duplicate_keys(rows, mapping.keys(opening)).agg(F.count(one).alias("failures"))))
        parent = opening.parent_row()
        if parent is not None and parent.table in tables:
            found.append(_failures(name, "foreign key", _without_parent(rows, tables[parent.table], mapping.keys(parent))))
    return reduce(DataFrame.unionByName, found)


def _failures(table: str, check: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(table).alias("table_name"), F.lit(check).alias("check"), F.col("failures").cast("bigint").alias("failures"))


def _without_parent(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """How many child rows have a complete key that no parent has: one grouping of both, no join."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    sides = child.where(complete).select(*keys, F.lit(1).alias("#child"), F.lit(0).alias("#parent"))
    sides = sides.unionByName(parent.where(complete).select(*keys, F.lit(0).alias("#child"), F.lit(1).alias("#parent")))
    groups = sides.groupBy(*keys).agg(F.sum("#child").alias("#child"), F.max("#parent").alias("#parent"))
    return groups.where(F.col("#parent") == 0).agg(F.coalesce(F.sum("#child"), F.lit(0)).alias("failures"))


def in_range(table: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies outside the closed range."""
    return table.where(~F.col(column).between(low, high))
