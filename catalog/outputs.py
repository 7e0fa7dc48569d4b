"""Queries: INSERT scripts, CSV, dispositions, layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpora as C
from catalog import mappings as M
from catalog.shredding import LINES
from treeflat.functions.text import split_quoted
from treeflat.operators import shred
from treeflat.session import fresh_folder, staged
from treeflat.sinks import tables as sinks
from treeflat.sources import inserts, records as R

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@query("insert_text", """SELECT c_custkey, 'INSERT INTO customer (id, name, segment) VALUES (' || c_custkey || ', ''' || c_name || ''', ''O''''' || c_mktsegment || '\\\\x'');' AS statement
FROM customer""")
def insert_text(spark, sf):
    """Quotes and back slashes are doubled."""
    c = C.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("O'"), F.col("c_mktsegment"), F.lit("\\x")).alias("segment"), F.lit(None).cast("string").alias("absent"))
    return sinks.insert_statements(c, "customer").select(F.col("id").alias("c_custkey"), "statement")


def _script(spark, sf):
    """All rows of the line corpus as an INSERT script on disk."""

    def write(path):
        rec = R.read_records(spark, C.lines_corpus(spark, sf))
        # Finished tables, stored: the global sort samples its input before it sorts it.
        tables = {t: staged(rows.drop("record_hash"), t) for t, rows in shred.shred_tables(rec, M.LINES, M.LINES.tables()).items()}
        sinks.write_script(sinks.insert_script(tables, M.LINES), path)

    return C.once(spark, sf, "script", write)


@query("insert_roundtrip", f"""WITH {LINES}
SELECT id, CAST(line_id AS VARCHAR) AS line_id, CASE WHEN line_id % 2 = 1 THEN CAST(length(line) AS VARCHAR) ELSE '-' END AS width,
  nullif(trim(regexp_replace(line, '^\\s+|\\s+$', '', 'g')), '') AS text FROM lines""")
def insert_roundtrip(spark, sf):
    """Tables -> INSERT script -> rows again; literals keep their quotes, commas and semicolons."""
    parsed = inserts.parse_statements(inserts.read_statements(spark, _script(spark, sf), "*"))
    rows = inserts.rows_for(parsed, "line", ["id", "line_id", "width", "text"])
    return rows.withColumn("text", F.nullif(F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("")))


@query("script_order", f"""WITH {LINES} SELECT (SELECT count(*) FROM docs) + count(*) AS statements, CAST(0 AS BIGINT) AS children_first FROM lines""")
def script_order(spark, sf):
    """Every child statement stands after its parent's: compared by position in the script."""
    s = inserts.parse_statements(inserts.read_statements(spark, _script(spark, sf), "*"))
    at = s.select("table_name", F.struct("source_file", "stmt").alias("at"), F.get("vals", F.lit(0)).alias("id"))
    first = at.groupBy("id").agg(
        F.min(F.when(F.col("table_name") == "line", F.col("at"))).alias("child"),
        F.min(F.when(F.col("table_name") == "doc", F.col("at"))).alias("parent"), F.count(F.lit(1)).alias("n"))
    return first.agg(F.sum("n").alias("statements"), F.count(F.when(F.col("child") < F.col("parent"), 1)).alias("children_first"))


@query("mismatch_log", "SELECT 'nation' AS table_name, n_nationkey % 3 = 0 AS mismatch, count(*) AS statements FROM nation GROUP BY ALL "
       "UNION ALL SELECT 'part', p_partkey % 3 = 0, count(*) FROM part GROUP BY ALL")
def mismatch_log(spark, sf):
    """INSERTs whose columns and values differ in number are flagged, not lost."""
    def text(table, key, name):
        short = F.when(F.col(key) % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(", '"), F.replace(F.col(name), F.lit("'"), F.lit("''")), F.lit("'")))
        return F.concat(F.lit(f"INSERT INTO {table} (k, name) VALUES ("), F.col(key), short, F.lit(");"))

    path = fresh_folder(spark, "mismatch")
    n = C.table(spark, sf, "nation").select(text("nation", "n_nationkey", "n_name").alias("value"))
    p = C.table(spark, sf, "part").select(text("part", "p_partkey", "p_name").alias("value"))
    n.unionByName(p).write.text(path)
    parsed = inserts.parse_statements(inserts.read_statements(spark, path, "*"))
    return parsed.groupBy("table_name", "mismatch").agg(F.count(F.lit(1)).alias("statements"))


@query("quoted_split", "SELECT doc_id, len(string_split(text, ',')) AS pieces, CAST(3 AS INTEGER) AS quoted FROM documents")
def quoted_split(spark, sf):
    """Commas inside quotes do not split: one long literal between two numbers is three values."""
    d = C.table(spark, sf, "documents")
    quoted = F.concat(F.lit("1, '"), F.replace("text", F.lit("'"), F.lit("''")), F.lit("', 2"))
    return d.select("doc_id", F.size(F.split("text", ",")).cast("bigint").alias("pieces"), F.size(split_quoted(quoted)).alias("quoted"))


@query("csv_pad", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END AS s_name, '' AS fax FROM supplier")
def csv_pad(spark, sf):
    """Contract columns in order, blanks for what is missing."""
    s = C.table(spark, sf, "supplier").select("s_suppkey", F.expr("CASE WHEN s_suppkey % 2 = 0 THEN s_name END").alias("s_name"), "s_acctbal")
    path = fresh_folder(spark, "csv")
    names = ["s_suppkey", "s_name", "fax"]
    sinks.write_csv(s, path, names)
    back = spark.read.schema("s_suppkey string, s_name string, fax string").option("header", True).csv(path)
    return back.na.fill("")


@query("sink_append_truncate_empty", """SELECT CAST(sum(2) AS BIGINT) AS appended, count(*) AS truncated, true AS empty_refused FROM orders""")
def sink_append_truncate_empty(spark, sf):
    """The three write dispositions."""
    o = C.table(spark, sf, "orders").select("o_orderkey")
    a, t = fresh_folder(spark, "append"), fresh_folder(spark, "truncate")
    sinks.write_table(o, a, sinks.EMPTY)
    sinks.write_table(o, a, sinks.APPEND)
    sinks.write_table(o, t, sinks.APPEND)
    sinks.write_table(o, t, sinks.TRUNCATE)
    try:
        sinks.write_table(o, t, sinks.EMPTY)
        refused = False
    except ValueError:
        refused = True
    both = sinks.read_table(spark, a).select(F.lit(1).alias("a"), F.lit(0).alias("t")).unionAll(
        sinks.read_table(spark, t).select(F.lit(0).alias("a"), F.lit(1).alias("t")))
    return both.agg(F.sum("a").alias("appended"), F.sum("t").alias("truncated"), F.lit(refused).alias("empty_refused"))


@query("sink_evolve", """SELECT o_orderkey, NULL AS o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def sink_evolve(spark, sf):
    """An appended column is NULL in older rows."""
    o, path = C.table(spark, sf, "orders"), fresh_folder(spark, "evolve")
    sinks.write_table(o.select("o_orderkey"), path)
    sinks.write_table(o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), path)
    return sinks.read_table(spark, path)


@query("sink_layout", "SELECT strftime(ts, '%Y-%m-%d') AS \"day\", count(*) AS row_count FROM events GROUP BY 1")
def sink_layout(spark, sf):
    """Day folders, sorted by key inside; the day filter prunes folders."""
    path = fresh_folder(spark, "layout")
    sinks.write_by_day(C.table(spark, sf, "events").select("event_id", "ts"), path, "ts", "event_id")
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


@query("sink_clustered", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1")
def sink_clustered(spark, sf):
    path = fresh_folder(spark, "clustered")
    sinks.write_table(C.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), path, key="l_orderkey")
    return spark.read.parquet(path).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
