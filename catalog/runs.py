"""Queries: repairs and replays, contracts as files, undeclared tables, planted faults, scripts for other databases."""

from __future__ import annotations

import json

from pyspark.sql import Window, functions as F

from catalog import corpora as C
from catalog import mappings as M
from catalog.changes import RUN1, RUN2, SECOND, _job, _version
from catalog.shredding import DOCS, LINES
from treeflat import Contracts, Mapping
from treeflat.ingest import Job, bulk_load, ingest, replay
from treeflat.operators import quality, shred, validate
from treeflat.session import fresh_folder
from treeflat.sinks import tables as sinks
from treeflat.sinks.store import Store
from treeflat.sources import files, inserts, records as R

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


ESCAPED = r"""replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(13), '&#13;')"""


@query("dlq_replay_letters", f"""WITH {DOCS}
SELECT DISTINCT CASE WHEN doc_id % 70 = 0 THEN 'FIX:' || sha256('<REC><lang>' || lang || '</lang><text>' || {ESCAPED} || CASE WHEN doc_id % 50 = 1 THEN '</txt>' ELSE '</text>' END || '</REC>') ELSE id END AS id,
  lang, nullif(text, '') AS text, CASE WHEN doc_id % 70 = 0 OR doc_id % 50 = 1 THEN 2 ELSE 1 END AS run, true AS repeated_is_skipped,
  CAST((SELECT count(DISTINCT lang || text || CASE WHEN doc_id % 70 = 0 THEN '' ELSE id END) FROM docs WHERE doc_id % 70 = 0 OR doc_id % 50 = 1) AS BIGINT) AS attempts
FROM docs""")
def dlq_replay_letters(spark, sf):
    """A broken delivery, its letters repaired and replayed twice: tables complete, the second replay does nothing.

    Letters are the only source: records without an id get one from their text.
    """
    job = Job(M.BROKEN, M.BROKEN_CONTRACTS, Store(spark, fresh_folder(spark, "store")), dead_letters=fresh_folder(spark, "letters"))
    ingest(spark, C.broken_corpus(spark, sf), job, RUN1, glob="*.txt")

    def repair(xml):
        named = F.concat(F.lit("<REC><UID>FIX:"), F.sha2(xml, 256), F.lit("</UID>"), F.substring(xml, 6, 2**31 - 1))
        closed = F.when(xml.startswith("<REC><UID>"), xml).otherwise(named)
        return F.replace(closed, F.lit("</txt>"), F.lit("</text>"))

    replay(spark, job, repair, RUN2)
    version = job.store.version()
    again = replay(spark, job, repair, "2024-09-01 00:00:00")
    attempts = job.store.read("replays").agg(F.sum("attempts").alias("attempts"))
    run = F.when(F.col("ingestion_ts") == F.lit(RUN1).cast("timestamp"), 1).otherwise(2).alias("run")
    rows = job.store.read("doc").select("id", "lang", "text", run, F.lit(again.skipped and job.store.version() == version).alias("repeated_is_skipped"))
    return rows.crossJoin(F.broadcast(attempts))  # one row


@query("contract_load", """SELECT s_suppkey::BIGINT AS s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal::DOUBLE END AS s_acctbal
FROM supplier WHERE s_suppkey % 7 <> 0""")
def contract_load(spark, sf):
    """Contracts read from files, one list per table, judge and type the rows of an untyped delivery."""
    path = fresh_folder(spark, "contracts")
    fields = [("s_suppkey", "INTEGER", "REQUIRED"), ("s_name", "STRING", "NULLABLE"), ("s_nationkey", "INTEGER", "NULLABLE"), ("s_acctbal", "FLOAT", "NULLABLE")]
    lists = {"supplier": [{"name": n, "type": t, "mode": m} for n, t, m in fields], "nation": [{"name": "n_name", "type": "STRING", "mode": "NULLABLE"}]}
    rows = [(f"{t}_schema", json.dumps(f)) for t, f in lists.items()]
    for name, text in rows:  # one small file each, named as its table
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{name}")
    contracts = Contracts.from_dict({t: [vars(f) for f in Contracts.load(spark, f"{path}/{t}_schema").tables.popitem()[1]] for t in lists})
    s = C.table(spark, sf, "supplier")
    untyped = s.select(
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_suppkey").cast("string")).alias("s_suppkey"), "s_name", F.col("s_nationkey").cast("string").alias("s_nationkey"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_acctbal").cast("string")).alias("s_acctbal"), F.lit("x").alias("undeclared"),
    )
    return validate.valid_rows(untyped, contracts["supplier"])


@query("undeclared_tables", f"""WITH {LINES}
SELECT 'para' AS table_name, true AS written, count(*) AS row_count FROM lines UNION ALL SELECT 'sentence', false, 0""")
def undeclared_tables(spark, sf):
    """Mapped tables without a contract are not written: paragraphs have one here, their sentences have none."""
    contracts = Contracts.from_dict({"para": [{"name": "id", "type": "STRING", "mode": "REQUIRED"}, {"name": "para_id", "type": "INTEGER", "mode": "REQUIRED"}]})
    job = Job(M.PARAS, contracts, Store(spark, fresh_folder(spark, "store")))
    paths = bulk_load(R.read_records(spark, C.paras_corpus(spark, sf)), job, fresh_folder(spark, "bulk"), RUN1, sinks.TRUNCATE)
    parts = []
    for table in ("para", "sentence"):
        rows = sinks.read_table(spark, paths[table]) if table in paths else spark.range(0)
        parts.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), F.lit(table in paths).alias("written"), "row_count"))
    return parts[0].unionByName(parts[1])


@query("run_metrics", f"""WITH {LINES}, first AS (SELECT * FROM lines WHERE doc_id % 7 <> 0)
SELECT 1 AS run, 'route new' AS metric, (SELECT count(*) FROM docs WHERE doc_id % 7 <> 0) AS n
UNION ALL SELECT 1, 'rows doc', (SELECT count(*) FROM docs WHERE doc_id % 7 <> 0) UNION ALL SELECT 1, 'rows line', (SELECT count(*) FROM first)
UNION ALL SELECT 2, 'route new', (SELECT count(*) FROM docs WHERE doc_id % 7 = 0)
UNION ALL SELECT 2, 'route changed', (SELECT count(*) FROM docs WHERE doc_id % 7 <> 0 AND doc_id % 5 = 0)
UNION ALL SELECT 2, 'route unchanged', (SELECT count(*) FROM docs WHERE doc_id % 7 <> 0 AND doc_id % 5 <> 0)
UNION ALL SELECT 2, 'rows doc', (SELECT count(*) FROM docs WHERE doc_id % 7 = 0 OR doc_id % 5 = 0)
UNION ALL SELECT 2, 'rows line', (SELECT sum(len(string_split({SECOND}, chr(10))))::BIGINT FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0)""")
def run_metrics(spark, sf):
    """Route counts and rows per table of two deliveries, observed while they were written."""
    job, rows = _job(spark), []
    for run, stamp in ((1, RUN1), (2, RUN2)):
        report = ingest(spark, _version(spark, sf, run == 2), job, stamp)
        rows += [(run, f"route {s}", n) for s, n in report.counts.items()] + [(run, f"rows {t}", n) for t, n in report.rows.items()]
    return spark.createDataFrame(rows, "run int, metric string, n long")


#: Long lines open rows but have no counter.
UNCOUNTED = Mapping.from_xml(
    """<records><REC table="doc"><UID/><short><l table="short_line" ctr_id="short_line:line_id">short_line:text</l></short>
    <long><l table="long_line">long_line:text</l></long></REC></records>"""
)


@query("missing_counter", f"""WITH {LINES}, marked AS (SELECT id, length(line) >= 80 AS is_long FROM lines)
SELECT id, CASE WHEN bool_or(is_long) THEN 'Counter not found in config' END AS error, CASE WHEN bool_or(is_long) THEN 0 ELSE count(*) END AS rows_kept FROM marked GROUP BY id""")
def missing_counter(spark, sf):
    """An element that opens a row without a counter costs its whole record, in every table."""
    rec = R.read_records(spark, C.lists_corpus(spark, sf))
    bad = shred.malformed(rec.select("uid", "xml"), UNCOUNTED).select(F.col("uid").alias("id"), "error", F.lit(0).cast("bigint").alias("n"))
    kept = shred.shred_table(rec, UNCOUNTED, "short_line").select("id", F.lit(None).cast("string").alias("error"), F.lit(1).cast("bigint").alias("n"))
    return bad.unionByName(kept).groupBy("id").agg(F.max("error").alias("error"), F.sum("n").alias("rows_kept"))


def _by_part(spark, sf):
    """Documents in 97 files by the remainder of their id."""

    def write(path):
        docs = C.documents(spark, sf)
        record = F.concat(F.lit("<REC><UID>"), C.escape(F.col("id")), F.lit("</UID></REC>")).alias("value")
        docs.select((F.col("doc_id") % 97).alias("part"), record).repartition("part").write.partitionBy("part").text(path)

    return C.once(spark, sf, "by-part", write)


@query("records_by_file", "SELECT doc_id % 97 AS part, count(*) AS record_count FROM documents GROUP BY 1")
def records_by_file(spark, sf):
    """Records of every file."""
    per_file = quality.records_per_file(R.read_records(spark, _by_part(spark, sf), recursive=True, glob="*.txt"))
    part = F.regexp_extract("source_file", r"part=(\d+)", 1).cast("bigint").alias("part")
    return per_file.select(part, "record_count").groupBy("part").agg(F.sum("record_count").alias("record_count"))


@query("file_order", "SELECT part, CAST(row_number() OVER (ORDER BY 'part=' || part || '/') AS BIGINT) AS place FROM (SELECT DISTINCT doc_id % 97 AS part FROM documents)")
def file_order(spark, sf):
    """The list of files comes sorted: each file's place in it."""
    found = files.discover(spark, _by_part(spark, sf), "*.txt", recursive=True)
    part = F.regexp_extract("file_path", r"part=(\d+)", 1).cast("bigint")
    placed = found.select(part.alias("part"), F.monotonically_increasing_id().alias("at"))
    # a list of files is small; the windows count what stands before
    first = placed.groupBy("part").agg(F.min("at").alias("at"))
    return first.select("part", F.row_number().over(Window.orderBy("at")).cast("bigint").alias("place"))


FAULTY = f"""{LINES}, parent AS (SELECT id, n_chars FROM docs WHERE doc_id % 13 <> 0 UNION ALL SELECT id, n_chars FROM docs WHERE doc_id % 17 = 0 AND doc_id % 13 <> 0),
child AS (SELECT id, doc_id, line_id, length(line) AS width FROM lines)"""


@query("quality_faults", f"""WITH {FAULTY}
SELECT 'doc' AS table_name, 'populated' AS "check", CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'doc', 'types', (SELECT count(*) FROM parent WHERE n_chars % 11 = 0)
UNION ALL SELECT 'doc', 'range of n_chars', (SELECT count(*) FROM parent WHERE n_chars % 11 <> 0 AND NOT n_chars BETWEEN 100 AND 2000)
UNION ALL SELECT 'doc', 'unique key', (SELECT count(*) FROM (SELECT id FROM parent GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT 'line', 'populated', 0
UNION ALL SELECT 'line', 'types', (SELECT count(*) FROM child WHERE line_id % 19 = 0)
UNION ALL SELECT 'line', 'range of width', (SELECT count(*) FROM child WHERE NOT width BETWEEN 10 AND 120)
UNION ALL SELECT 'line', 'unique key', 0
UNION ALL SELECT 'line', 'foreign key', (SELECT count(*) FROM child WHERE doc_id % 13 = 0)""")
def quality_faults(spark, sf):
    """The quality report over tables with planted faults: words for numbers, values out of range, repeated keys, lost parents."""
    docs = C.documents(spark, sf).select("id", "doc_id", "n_chars", "text")
    kept = docs.where("doc_id % 13 <> 0")
    number = F.when(F.col("n_chars") % 11 == 0, "many").otherwise(F.col("n_chars").cast("string")).alias("n_chars")
    parent = kept.unionByName(kept.where("doc_id % 17 = 0")).select("id", number)
    child = docs.select("id", F.posexplode(C.lines("text")).alias("at", "line")).select(
        "id", (F.col("at") + 1).cast("bigint").alias("line_id"), F.length("line").alias("width"),
        F.when((F.col("at") + 1) % 19 == 0, "x").otherwise(F.col("at").cast("string")).alias("n"),
    )
    fields = lambda *pairs: [{"name": n, "type": t, "mode": "NULLABLE"} for n, t in pairs]
    contracts = Contracts.from_dict({"doc": fields(("id", "STRING"), ("n_chars", "INTEGER")), "line": fields(("id", "STRING"), ("line_id", "INTEGER"), ("n", "INTEGER"), ("width", "INTEGER"))})
    return quality.quality_report({"doc": parent, "line": child}, M.LINES, contracts, {"doc": {"n_chars": (100, 2000)}, "line": {"width": (10, 120)}})


@query("insert_template", """SELECT 'customer' AS table_name, c_custkey, c_name, '/* ' || c_custkey || ' 42 $ */' AS lead FROM customer
UNION ALL SELECT 'my "part"', p_partkey, p_name, '/* ' || p_partkey || ' 42 $ */' FROM part""")
def insert_template(spark, sf):
    """Scripts with quoted names through a template with data, id and file number, read back."""
    path = fresh_folder(spark, "scripts")
    given = {"customer": ("c", "mysql"), "part": ("p", "postgresql")}
    for table, (letter, quoting) in given.items():
        key = "custkey" if letter == "c" else "partkey"
        rows = C.table(spark, sf, table).select(F.col(f"{letter}_{key}").alias("id"), F.col(f"{letter}_name").alias("full name"))
        name = table if letter == "c" else 'my "part"'
        script = sinks.insert_statements(rows, name, quoting=quoting).select(F.col("id").cast("string").alias("id"), "statement")
        sinks.write_script(script, f"{path}/{table}", "/* $id $file_number $$ */ $data", 42)
    text = inserts.read_statements(spark, [f"{path}/{t}" for t in given], "*")
    lead = F.regexp_extract("statement", r"^(/\*.*?\*/) ", 1)
    plain = text.select(lead.alias("lead"), F.regexp_replace("statement", r"^/\*.*?\*/ ", "").alias("statement"))
    parsed = inserts.parse_statements(plain)
    literal = lambda i: F.get("vals", F.lit(i))
    name = F.replace(F.regexp_extract(literal(1), r"(?s)^'(.*)'$", 1), F.lit("''"), F.lit("'"))
    return parsed.select("table_name", literal(0).cast("bigint").alias("c_custkey"), name.alias("c_name"), "lead")
