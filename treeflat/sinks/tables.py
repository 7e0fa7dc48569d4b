"""Plain table sinks: dispositions, CSV, INSERT text, id lists, physical layout."""

from __future__ import annotations

from functools import reduce
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from treeflat.functions.text import sql_literal
from treeflat.plans.mapping import Mapping
from treeflat.sinks.store import Files

APPEND, TRUNCATE, EMPTY = "WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"


def is_empty(spark: SparkSession, path: str) -> bool:
    files = Files(spark, path)
    if not any(n.endswith(".parquet") for n in files.names(path)):
        return True
    return not spark.read.parquet(path).limit(1).take(1)


def write_table(rows: DataFrame, path: str, disposition: str = APPEND, key: str | None = None) -> None:
    """Write one table; it is created if absent.  ``key`` clusters the files.

    Appended files may hold additional columns (read with :func:`read_table`).
    """
    out = clustered(rows, key) if key else rows
    if disposition == EMPTY and not is_empty(rows.sparkSession, path):
        raise ValueError(f"target is not empty: {path}")
    out.write.mode("append" if disposition == APPEND else "overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Files of different ages together: columns added later are NULL in older rows."""
    return spark.read.option("mergeSchema", True).parquet(path)


def clustered(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a key close together.  The rebalance splits a key too large for one file."""
    return rows.hint("rebalance", key).sortWithinPartitions(key)


def write_by_day(rows: DataFrame, path: str, stamp: str, key: str) -> None:
    """Registry layout: one folder per day, sorted by the key inside the files."""
    dated = rows.withColumn("day", F.to_date(stamp)).hint("rebalance", "day")
    dated.sortWithinPartitions("day", key).write.mode("append").partitionBy("day").parquet(path)


def write_ids(classified: DataFrame, path: str) -> None:
    """The ids of changed records, one per line."""
    classified.where("status = 'changed'").select("uid").write.text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    from treeflat.functions.text import strip_space

    return spark.read.text(path).select(strip_space("value").alias("uid")).where("uid <> ''")


def registry_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A registry table; absent means empty, so every record counts as new."""
    if Files(spark, path).exists(path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], T.StructType.fromDDL(schema))


def padded(rows: DataFrame, names: list[str]) -> DataFrame:
    """Exactly these columns as text, blanks for what is missing."""
    have = set(rows.columns)
    return rows.select(
        *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) if n in have else F.lit("").alias(n) for n in names]
    )


def write_csv(rows: DataFrame, path: str, names: list[str]) -> None:
    """Append CSV files with a header, columns in contract order."""
    padded(rows, names).write.mode("append").option("header", True).option("emptyValue", "").csv(path)


#: How names are quoted, by kind of database.
NAME_QUOTES = {None: "", "mysql": "`", "postgresql": '"'}


def insert_statements(rows: DataFrame, table: str, names: list[str] | None = None, quoting: str | None = None) -> DataFrame:
    """One INSERT per row; only the columns that have a value are listed.

    ``quoting`` (``mysql`` or ``postgresql``) quotes the names as that database does.
    """
    mark = NAME_QUOTES[quoting]
    quoted = lambda n: mark + n.replace(mark, 2 * mark) + mark if mark else n
    names = names or rows.columns
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    plain = ("int", "bigint", "double", "float", "smallint")

    def literal(n):
        c = F.col(f"`{n}`")
        return c.cast("string") if kinds[n] in plain else sql_literal(c.cast("string"))

    used = [F.when(F.col(f"`{n}`").isNotNull(), F.lit(quoted(n))) for n in names]
    values = [F.when(F.col(f"`{n}`").isNotNull(), literal(n)) for n in names]
    text = F.concat(
        F.lit(f"INSERT INTO {quoted(table)} ("), F.concat_ws(", ", *used), F.lit(") VALUES ("), F.concat_ws(", ", *values),
        F.lit(");"),
    )
    return rows.select(*rows.columns, text.alias("statement"))


def insert_script(tables: dict[str, DataFrame], mapping: Mapping, quoting: str | None = None) -> DataFrame:
    """All statements of all tables, parents before their children within an id.

    Ordered by range partitioning on (id, depth, keys): an id with very many rows spreads
    over several consecutive partitions instead of filling one.
    """
    parts = []
    for name, rows in tables.items():
        opening = mapping.openings(name)[0]
        chain = mapping.chain(opening)
        counters = [F.col(k).cast("bigint") for k in mapping.keys(opening)[1:]]
        made = insert_statements(rows, name, quoting=quoting)
        parts.append(
            made.select(
                F.col("id").cast("string").alias("id"),
                F.lit(len(chain) - 1).alias("depth"),
                F.lit(name).alias("table_name"),
                F.array(*counters).cast("array<bigint>").alias("keys"),
                "statement",
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("id", "depth", "table_name", "keys")


def write_script(script: DataFrame, path: str, template: str = "$data", file_number: int = -1) -> None:
    """Write statements as text lines through a line template.

    ``$data`` is the statement, ``$id`` the record id, ``$file_number`` the run's file number (a column of the script of that name
    goes first); ``$$`` is a dollar sign.  What the values hold is not read as a template.  The global order of
    :func:`insert_script` is kept over the numbered files.
    """
    number = F.col("file_number").cast("string") if "file_number" in script.columns else F.lit(str(file_number))
    values = {"$data": F.col("statement"), "$id": F.col("id"), "$file_number": number, "$$": F.lit("$")}
    parts = re.split(r"(\$\$|\$data\b|\$id\b|\$file_number\b)", template)
    line = F.concat(*[values.get(p, F.lit(p)) for p in parts])
    script.select(line.alias("value")).write.text(path)
