"""Queries: change detection, upkeep, registries, whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpora as C
from catalog import mappings as M
from catalog.shredding import DOCS, LINES
from treeflat.functions.text import sha256_hex
from treeflat.ingest import Job, bulk_load, ingest
from treeflat.operators import classify, quality, upkeep
from treeflat.session import fresh_folder
from treeflat.sinks import tables as sinks
from treeflat.sinks.store import Store
from treeflat.sources import files, records as R
from treeflat.streaming.ingest import ingest_stream

QUERIES, ORACLE = {}, {}

RUN1, RUN2 = "2024-06-01 00:00:00", "2024-07-01 00:00:00"

#: What a document's second version is: every fifth text gets a suffix.
SECOND = "CASE WHEN doc_id % 5 = 0 THEN text || ' revised' ELSE text END"


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def _records(spark, sf):
    """Documents as incoming records: id, content hash, origin."""
    return C.table(spark, sf, "documents").select(
        F.concat(F.lit("DOC:"), F.col("doc_id")).alias("uid"),
        sha256_hex(F.expr(SECOND)).alias("record_hash"),
        F.concat(F.col("lang"), F.lit(".xml")).alias("source_file"),
        "doc_id",
    )


def _registry(spark, sf):
    """What an earlier run registered: the first versions, without every seventh document."""
    return C.table(spark, sf, "documents").where("doc_id % 7 <> 0").select(
        F.concat(F.lit("DOC:"), F.col("doc_id")).alias("uid"),
        sha256_hex("text").alias("record_hash"),
        F.concat(F.col("lang"), F.lit(".xml")).alias("source_file"),
        F.lit(RUN1).cast("timestamp").alias("ingested_at"),
    )


STATUS = f"""classified AS (
  SELECT 'DOC:' || doc_id AS uid, doc_id, lang, sha256({SECOND}) AS record_hash,
         CASE WHEN doc_id % 7 = 0 THEN 'new' WHEN doc_id % 5 = 0 THEN 'changed' ELSE 'unchanged' END AS status
  FROM documents)"""


@query("classify_changes", f"WITH {STATUS} SELECT uid, record_hash, status FROM classified")
def classify_changes(spark, sf):
    return classify.classify(_records(spark, sf), _registry(spark, sf)).select("uid", "record_hash", "status")


@query("route_counts", f"WITH {STATUS} SELECT status, count(*) AS records FROM classified GROUP BY status")
def route_counts(spark, sf):
    return classify.route_counts(classify.classify(_records(spark, sf), _registry(spark, sf)))


@query("unchanged_filter", f"WITH {STATUS} SELECT uid, status FROM classified WHERE status <> 'unchanged'")
def unchanged_filter(spark, sf):
    return classify.to_process(classify.classify(_records(spark, sf), _registry(spark, sf))).select("uid", "status")


@query("changed_ids", f"WITH {STATUS} SELECT uid FROM classified WHERE status = 'changed'")
def changed_ids(spark, sf):
    """Written as one id per line for audit and read back."""
    path = fresh_folder(spark, "changed")
    sinks.write_ids(classify.classify(_records(spark, sf), _registry(spark, sf)), path)
    return sinks.read_ids(spark, path)


@query("registry_read", """SELECT count(*) AS present, CAST(0 AS BIGINT) AS absent FROM documents WHERE doc_id % 7 <> 0""")
def registry_read(spark, sf):
    """A registry that exists, and one that does not (empty: everything is new)."""
    path = fresh_folder(spark, "registry")
    _registry(spark, sf).write.parquet(path)
    got = sinks.registry_or_empty(spark, path, classify.REGISTRY_SCHEMA).select(F.lit(1).alias("p"), F.lit(0).alias("a"))
    none = sinks.registry_or_empty(spark, path + "-none", classify.REGISTRY_SCHEMA).select(F.lit(0).alias("p"), F.lit(1).alias("a"))
    return got.unionAll(none).agg(F.sum("p").alias("present"), F.sum("a").alias("absent"))


@query("registry_insert_new", f"""WITH {STATUS}
SELECT uid, sha256(text) AS record_hash, '{RUN1}' AS ingested_at FROM (SELECT 'DOC:' || doc_id AS uid, text FROM documents WHERE doc_id % 7 <> 0)
UNION ALL SELECT uid, record_hash, '{RUN2}' FROM classified WHERE status = 'new'""")
def registry_insert_new(spark, sf):
    reg = _registry(spark, sf)
    rows = classify.registry_rows(classify.classify(_records(spark, sf), reg), RUN2)
    return _stamped(upkeep.insert_new(reg, rows, "uid"))


@query("registry_update_changed", f"""WITH {STATUS}
SELECT uid, CASE WHEN status = 'changed' THEN record_hash ELSE sha256(text) END AS record_hash,
       CASE WHEN status = 'changed' THEN '{RUN2}' ELSE '{RUN1}' END AS ingested_at
FROM classified JOIN (SELECT doc_id, text FROM documents) d USING (doc_id) WHERE status <> 'new'""")
def registry_update_changed(spark, sf):
    reg = _registry(spark, sf)
    rows = classify.registry_rows(classify.classify(_records(spark, sf), reg), RUN2)
    return _stamped(upkeep.update_matched(reg, rows, "uid"))


def _stamped(reg):
    return reg.select("uid", "record_hash", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


def _two_runs(spark, sf):
    """Order rows of an earlier run, plus this run's rows for every fifth order."""
    orders = C.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderkey") % 11 != 0, F.lit(RUN1).cast("timestamp")).alias("ingestion_ts"))
    again = orders.where("id % 5 = 0").select(
        "id", F.concat("priority", F.lit("*")).alias("priority"), F.lit(RUN2).cast("timestamp").alias("ingestion_ts"))
    return orders, again


def _seconds(df):
    return df.withColumn("ingestion_ts", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss"))


BOTH = f"""both_runs AS (
  SELECT o_orderkey AS id, o_orderpriority AS priority,
         CASE WHEN o_orderkey % 11 <> 0 THEN '{RUN1}' END AS ingestion_ts FROM orders
  UNION ALL SELECT o_orderkey, o_orderpriority || '*', '{RUN2}' FROM orders WHERE o_orderkey % 5 = 0)"""


@query("delete_stale", f"""WITH {BOTH}
SELECT * FROM both_runs WHERE NOT (id % 5 = 0 AND coalesce(ingestion_ts < '{RUN2}', false))""")
def delete_stale(spark, sf):
    """After appending a run: older rows of changed ids go; rows without a stamp stay."""
    orders, again = _two_runs(spark, sf)
    return _seconds(upkeep.delete_stale(orders.unionByName(again), again.select("id"), RUN2))


@query("delete_stale_null_old", f"""WITH {BOTH}
SELECT * FROM both_runs WHERE NOT (id % 5 = 0 AND coalesce(ingestion_ts < '{RUN2}', true))""")
def delete_stale_null_old(spark, sf):
    orders, again = _two_runs(spark, sf)
    return _seconds(upkeep.delete_stale(orders.unionByName(again), again.select("id"), RUN2, null_is_old=True))


@query("latest_version", f"""WITH {BOTH}
SELECT b.* FROM both_runs b JOIN (SELECT id, max(ingestion_ts) AS m FROM both_runs GROUP BY id) l
ON b.id = l.id AND b.ingestion_ts IS NOT DISTINCT FROM l.m""")
def latest_version(spark, sf):
    orders, again = _two_runs(spark, sf)
    return _seconds(upkeep.latest_version(orders.unionByName(again)))


@query("upsert_orders", f"""SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority || '*' ELSE o_orderpriority END AS priority FROM orders""")
def upsert_orders(spark, sf):
    orders, again = _two_runs(spark, sf)
    return upkeep.upsert(orders, again, "id").select("id", "priority")


@query("cascade_delete", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""")
def cascade_delete(spark, sf):
    gone = C.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = C.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return upkeep.cascade_delete(lines, gone, ["l_orderkey"])


@query("rows_of_ids", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def rows_of_ids(spark, sf):
    ids = C.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return upkeep.only_ids(C.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ids, "l_orderkey")


def _files(spark, sf):
    """Parts as a file list: path and fingerprint; every ninth file has new content."""
    part = C.table(spark, sf, "part")
    path = F.concat(F.lit("in/"), F.col("p_partkey"), F.lit(".xml")).alias("file_path")
    seen = part.where("p_partkey % 4 <> 0").select(
        path, F.md5("p_name").alias("file_md5"), F.lit(RUN1).cast("timestamp").alias("processed_at"),
        F.col("p_size").cast("bigint").alias("record_count"))
    now = part.select(path, F.md5(F.expr("CASE WHEN p_partkey % 9 = 0 THEN p_name || '+' ELSE p_name END")).alias("file_md5"),
                      F.col("p_size").cast("bigint").alias("record_count"))
    return seen, now


@query("skip_processed", """SELECT 'in/' || p_partkey || '.xml' AS file_path FROM part WHERE p_partkey % 4 = 0 OR p_partkey % 9 = 0""")
def skip_processed(spark, sf):
    seen, now = _files(spark, sf)
    return upkeep.missing_files(now, seen).select("file_path")


@query("file_registry_upsert", f"""SELECT 'in/' || p_partkey || '.xml' AS file_path,
  md5(CASE WHEN p_partkey % 9 = 0 THEN p_name || '+' ELSE p_name END) AS file_md5,
  CASE WHEN p_partkey % 4 = 0 OR p_partkey % 9 = 0 THEN '{RUN2}' ELSE '{RUN1}' END AS processed_at,
  CAST(p_size AS BIGINT) AS record_count FROM part""")
def file_registry_upsert(spark, sf):
    seen, now = _files(spark, sf)
    rows = upkeep.missing_files(now, seen).withColumn("processed_at", F.lit(RUN2).cast("timestamp"))
    out = upkeep.upsert(seen, rows.select(*seen.columns), "file_path")
    return out.withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss"))


@query("file_seen", "SELECT count(*) AS seen FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 9 <> 0")
def file_seen(spark, sf):
    """The registry predicate: same path and same fingerprint."""
    seen, now = _files(spark, sf)
    return now.join(seen.select("file_path", "file_md5"), ["file_path", "file_md5"], "left_semi").agg(F.count(F.lit(1)).alias("seen"))


# ---- whole runs ---------------------------------------------------------------------


def _version(spark, sf, second: bool) -> str:
    """The corpus of the first or second delivery."""

    def write(path):
        docs = C.documents(spark, sf)
        docs = docs.withColumn("text", F.expr(SECOND)) if second else docs.where("doc_id % 7 <> 0")
        C.write_xml(C.lines_records(docs), path)

    return C.once(spark, sf, f"delivery{2 if second else 1}", write)


def _job(spark) -> Job:
    return Job(M.LINES, M.LINES_CONTRACTS, Store(spark, fresh_folder(spark, "store")))


AFTER = f"""after AS (
  SELECT 'DOC:' || doc_id AS id, n_chars, CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN '{RUN2}' ELSE '{RUN1}' END AS ingestion_ts,
         regexp_replace({SECOND}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{{FFFE}}\\x{{FFFF}}]', '', 'g') AS text
  FROM documents)"""

AFTER_LINES = f"""WITH {AFTER}
SELECT id, unnest(string_split(text, chr(10))) AS raw, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_id,
       ingestion_ts FROM after"""


@query("ingest_two_runs", f"""SELECT id, line_id, CASE WHEN line_id % 2 = 1 THEN CAST(length(raw) AS VARCHAR) ELSE '-' END AS width,
  nullif(raw, '') AS text, ingestion_ts FROM ({AFTER_LINES})""")
def ingest_two_runs(spark, sf):
    """Two deliveries: the line table holds exactly one version of every record."""
    job = _job(spark)
    ingest(spark, _version(spark, sf, False), job, RUN1)
    ingest(spark, _version(spark, sf, True), job, RUN2)
    return _seconds(job.store.read("line"))


@query("ingest_root_registry", f"""WITH {AFTER} SELECT id, CAST(n_chars AS BIGINT) AS n_chars, ingestion_ts, true AS registered FROM after""")
def ingest_root_registry(spark, sf):
    """Root rows and registry entries agree in hash and stamp after two deliveries."""
    job = _job(spark)
    ingest(spark, _version(spark, sf, False), job, RUN1)
    ingest(spark, _version(spark, sf, True), job, RUN2)
    reg = job.store.read("record_registry").select(
        F.col("uid").alias("id"), "record_hash", F.col("ingested_at").alias("ingestion_ts"), F.lit(True).alias("registered"))
    rows = job.store.read("doc").join(reg, ["id", "record_hash", "ingestion_ts"], "left")
    return _seconds(rows.select("id", "n_chars", "ingestion_ts", F.coalesce("registered", F.lit(False)).alias("registered")))


@query("idempotent_rerun", f"""WITH {LINES}
SELECT (SELECT count(*) FROM docs WHERE doc_id % 7 <> 0) AS docs, (SELECT count(*) FROM lines WHERE doc_id % 7 <> 0) AS "lines",
       true AS second_skipped, CAST(1 AS BIGINT) AS stamps""")
def idempotent_rerun(spark, sf):
    """The same delivery twice: the second run is skipped per file and nothing changes."""
    job = _job(spark)
    path = _version(spark, sf, False)
    ingest(spark, path, job, RUN1)
    second = ingest(spark, path, job, RUN2)
    marks = job.store.read("doc").select(F.lit(1).alias("d"), F.lit(0).alias("l"), "ingestion_ts").unionAll(
        job.store.read("line").select(F.lit(0).alias("d"), F.lit(1).alias("l"), "ingestion_ts"))
    return marks.agg(F.sum("d").alias("docs"), F.sum("l").alias("lines"),
                     F.lit(second.skipped).alias("second_skipped"), F.countDistinct("ingestion_ts").alias("stamps"))


@query("bulk_load", f"""WITH {LINES} SELECT id, line_id, nullif(line, '') AS text, '{RUN1}' AS ingestion_ts FROM lines""")
def bulk_load_lines(spark, sf):
    """Load without change detection: one parse fanned out to all tables."""
    out = fresh_folder(spark, "bulk")
    paths = bulk_load(R.read_records(spark, C.lines_corpus(spark, sf)), _job(spark), out, RUN1, sinks.TRUNCATE)
    return _seconds(sinks.read_table(spark, paths["line"]).select("id", "line_id", "text", "ingestion_ts"))


@query("stream_ingest", f"""WITH {LINES} SELECT id, line_id, nullif(line, '') AS text FROM lines""")
def stream_ingest(spark, sf):
    """The same run fed by a file stream; started twice, the second start finds nothing new."""
    job, checkpoint = _job(spark), fresh_folder(spark, "stream")
    path = C.lines_corpus(spark, sf)
    for stamp in (RUN1, RUN2):
        ingest_stream(spark, path, job, checkpoint, stamp)
    rows = job.store.read("line")
    return rows.where(F.col("ingestion_ts") == F.lit(RUN1).cast("timestamp")).select("id", "line_id", "text")


@query("latest_in_run", f"WITH {DOCS} SELECT text AS uid, max(id) AS source_file FROM docs GROUP BY text")
def latest_in_run(spark, sf):
    """Copies of one id within a run: the last by file wins (the text stands in for the id here)."""
    docs = C.documents(spark, sf)
    rec = docs.select(C.clean("text").alias("uid"), F.lit("").alias("xml"), F.lit("").alias("record_hash"),
                      F.col("id").alias("source_file"), F.col("doc_id").alias("pos"))
    return R.latest_record(rec).select("uid", "source_file")
