"""Queries: contracts, coercions, dead letters, keys, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpora as C
from catalog import mappings as M
from catalog.shredding import DOCS, LINES
from treeflat import Contracts
from treeflat.functions.coerce import to_boolean, to_float, to_integer
from treeflat.functions.text import file_safe, strip_space, target_parts
from treeflat.operators import deadletter, quality, shred, validate
from treeflat.session import fresh_folder, staged
from treeflat.sources import records as R

QUERIES, ORACLE = {}, {}

STAMP = "2024-06-01 12:30:00"


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# ---- contracts ------------------------------------------------------------------------

EVENTS = Contracts.from_dict(
    {
        "events": [
            {"name": "id", "type": "STRING", "mode": "REQUIRED", "description": "event"},
            {"name": "k", "type": "INTEGER", "mode": "NULLABLE", "description": ""},
            {"name": "value", "type": "FLOAT", "mode": "NULLABLE", "description": ""},
            {"name": "kind", "type": "STRING", "mode": "REQUIRED", "description": ""},
            {"name": "flag", "type": "BOOLEAN", "mode": "NULLABLE", "description": ""},
            {"name": "seen", "type": "TIMESTAMP", "mode": "NULLABLE", "description": ""},
        ]
    }
)


def _event_rows(spark, sf):
    """Events as untyped rows: some counts are words, some kinds are missing, flags are mixed."""
    e = C.table(spark, sf, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN concat('n', regexp_extract(props, '([0-9]+)', 1)) "
               "WHEN event_id % 4 = 0 THEN concat(' ', regexp_extract(props, '([0-9]+)', 1), ' ') END").alias("k0"),
        k.alias("k1"),
        F.floor("value").cast("bigint").cast("string").alias("value"),
        F.expr("CASE WHEN event_id % 17 <> 0 THEN event_type END").alias("kind"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN 'Yes' WHEN event_id % 3 = 1 THEN 'F' WHEN event_id % 19 = 0 THEN 'maybe' END").alias("flag"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"),
        F.lit("x").alias("extra"),
    ).select("id", F.coalesce("k0", "k1").alias("k"), "value", "kind", "flag", "seen", "extra")


EVENT_ROWS = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_id % 13 = 0 THEN 'n' || regexp_extract(props, '([0-9]+)', 1)
         WHEN event_id % 4 = 0 THEN ' ' || regexp_extract(props, '([0-9]+)', 1) || ' ' ELSE regexp_extract(props, '([0-9]+)', 1) END AS k,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS "value",
    CASE WHEN event_id % 17 <> 0 THEN event_type END AS kind,
    CASE WHEN event_id % 3 = 0 THEN 'Yes' WHEN event_id % 3 = 1 THEN 'F' WHEN event_id % 19 = 0 THEN 'maybe' END AS flag,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen
  FROM events),
judged AS (
  SELECT *, CASE WHEN k LIKE 'n%' THEN 'Type coercion failed for k: ' || k || ' -> INTEGER: invalid literal for int() with base 10: ''' || k || ''''
    WHEN kind IS NULL THEN 'Required field missing: kind'
    WHEN flag = 'maybe' THEN 'Type coercion failed for flag: maybe -> BOOLEAN: Cannot coerce ''maybe'' to BOOLEAN' END AS error FROM raw)"""


@query("validate_events", f"""WITH {EVENT_ROWS}
SELECT id, CAST(trim(k) AS BIGINT) AS k, CAST("value" AS DOUBLE) AS "value", kind,
       CASE flag WHEN 'Yes' THEN true WHEN 'F' THEN false END AS flag, seen FROM judged WHERE error IS NULL""")
def validate_events(spark, sf):
    return validate.valid_rows(_event_rows(spark, sf), EVENTS["events"])


@query("validate_refused", f"WITH {EVENT_ROWS} SELECT id, error FROM judged WHERE error IS NOT NULL")
def validate_refused(spark, sf):
    letters = validate.refused_rows(_event_rows(spark, sf), EVENTS["events"], "events")
    return letters.select(F.get_json_object("row", "$.id").alias("id"), "error")


@query("validate_missing_column", "SELECT 'Required field missing: kind' AS error, count(*) AS letters FROM events")
def validate_missing_column(spark, sf):
    rows = _event_rows(spark, sf).drop("kind", "k")
    letters = validate.refused_rows(rows, EVENTS["events"], "events")
    return letters.groupBy("error").agg(F.count(F.lit(1)).alias("letters"))


@query("unknown_table", "SELECT 'Schema not found for table: nowhere' AS error, count(*) AS letters FROM events GROUP BY 1")
def unknown_table(spark, sf):
    letters = validate.unknown_table(_event_rows(spark, sf), "nowhere")
    return letters.groupBy("error").agg(F.count(F.lit(1)).alias("letters"))


@query("extra_fields", f"WITH {EVENT_ROWS} SELECT count(*) AS row_count, 'extra' AS extra_fields FROM raw")
def extra_fields(spark, sf):
    """Undeclared columns are named (warn) and kept by validation, dropped by projection."""
    rows = _event_rows(spark, sf)
    extra = quality.field_difference(rows, EVENTS.names("events"))
    kept = validate.checked(rows, EVENTS["events"])
    return kept.agg(F.count("extra").alias("row_count")).select("row_count", F.lit(",".join(extra)).alias("extra_fields"))


def _texts():
    """Texts made from event counts in the ways people write numbers."""
    n = "regexp_extract(props, '([0-9]+)', 1)"
    return F.expr(
        f"CASE event_id % 8 WHEN 0 THEN {n} WHEN 1 THEN concat(' +', {n}, ' ') WHEN 2 THEN concat('-', {n}) "
        f"WHEN 3 THEN concat({n}, '.5') WHEN 4 THEN concat('1_', {n}) WHEN 5 THEN concat({n}, 'd') WHEN 6 THEN '' "
        f"ELSE concat({n}, 'e2') END")


TEXTS = """texts AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN n WHEN 1 THEN ' +' || n || ' ' WHEN 2 THEN '-' || n
  WHEN 3 THEN n || '.5' WHEN 4 THEN '1_' || n WHEN 5 THEN n || 'd' WHEN 6 THEN '' ELSE n || 'e2' END AS t, n
  FROM (SELECT event_id, regexp_extract(props, '([0-9]+)', 1) AS n FROM events))"""


@query("coerce_int", f"""WITH {TEXTS} SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(n AS BIGINT) WHEN 1 THEN CAST(n AS BIGINT)
  WHEN 2 THEN -CAST(n AS BIGINT) WHEN 4 THEN CAST('1' || n AS BIGINT) END AS as_int FROM texts""")
def coerce_int(spark, sf):
    return C.table(spark, sf, "events").select("event_id", to_integer(_texts()).alias("as_int"))


@query("coerce_float", f"""WITH {TEXTS} SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(n AS DOUBLE) WHEN 1 THEN CAST(n AS DOUBLE)
  WHEN 2 THEN -CAST(n AS DOUBLE) WHEN 3 THEN CAST(n || '.5' AS DOUBLE) WHEN 4 THEN CAST('1' || n AS DOUBLE)
  WHEN 7 THEN CAST(n AS DOUBLE) * 100 END AS as_float FROM texts""")
def coerce_float(spark, sf):
    return C.table(spark, sf, "events").select("event_id", to_float(_texts()).alias("as_float"))


@query("coerce_bool", """SELECT event_id, CASE WHEN event_type = 'click' THEN true WHEN event_type = 'view' THEN false END AS as_bool FROM events""")
def coerce_bool(spark, sf):
    text = F.expr("CASE event_type WHEN 'click' THEN element_at(array('true', '1', 'YES', 't', 'Y'), cast(event_id % 5 + 1 as int)) "
                  "WHEN 'view' THEN element_at(array('false', '0', 'No', 'F', 'n'), cast(event_id % 5 + 1 as int)) ELSE ' true' END")
    return C.table(spark, sf, "events").select("event_id", to_boolean(text).alias("as_bool"))


@query("scalar_functions", """SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe, left(url, 20) AS prefix,
  'a' AS target_table, CAST(page_id AS VARCHAR) AS target_col, url AS trimmed FROM pages""")
def scalar_functions(spark, sf):
    p = C.table(spark, sf, "pages")
    parts = target_parts(F.concat(F.lit("a:"), F.col("page_id"), F.lit(":dflt")))
    return p.select(
        "page_id", file_safe(F.col("url")).alias("safe"), F.substring("url", 1, 20).alias("prefix"),
        parts.table.alias("target_table"), parts.column.alias("target_col"),
        strip_space(F.concat(F.lit(" \t"), F.col("url"), F.lit("\n "))).alias("trimmed"))


# ---- dead letters ---------------------------------------------------------------------


def _letters(spark, sf):
    fragments = R.read_fragments(spark, C.broken_corpus(spark, sf))
    lost = R.split_failures(fragments).withColumn("pipeline_step", F.lit("SplitXMLRecords"))
    bad = shred.malformed(R.split_records(fragments), M.BROKEN).withColumn("pipeline_step", F.lit("ParseXMLRecord"))
    return deadletter.enriched(deadletter.unified([lost, bad]), STAMP)


LETTERS = f"""letters AS (
  SELECT NULL AS record_id, 'Could not extract ID from record (tag: UID)' AS error, 'ValueError' AS error_type, 'SplitXMLRecords' AS pipeline_step
  FROM documents WHERE doc_id % 70 = 0
  UNION ALL SELECT 'DOC:' || doc_id, 'record is not well-formed XML', 'XMLSyntaxError', 'ParseXMLRecord'
  FROM documents WHERE doc_id % 50 = 1 AND doc_id % 70 <> 0)"""


@query("dlq_errors", f"""WITH {LETTERS}
SELECT record_id, error, error_type, pipeline_step, md5(error_type || ':' || error) AS error_hash, '2024-06-01T12:30:00.000000Z' AS "timestamp",
  CAST(1717245000 AS BIGINT) AS timestamp_epoch, coalesce(left(record_id, 20), '') AS record_id_prefix FROM letters""")
def dlq_errors(spark, sf):
    return _letters(spark, sf).drop("worker_id", "xml", "row", "table_name")


@query("dlq_by_hash", f"""WITH {LETTERS}
SELECT error_type, md5(error_type || ':' || error) AS error_hash, count(*) AS letters FROM letters GROUP BY ALL""")
def dlq_by_hash(spark, sf):
    return deadletter.by_error(_letters(spark, sf))


@query("dlq_rate", f"""WITH {LETTERS} SELECT (SELECT count(*) FROM letters) AS failed, count(*) AS processed,
  (SELECT count(*) FROM letters) / count(*) AS rate FROM documents""")
def dlq_rate(spark, sf):
    return deadletter.rate(_letters(spark, sf), C.table(spark, sf, "documents"))


@query("good_records_survive", f"""WITH {DOCS} SELECT id, lang, nullif(text, '') AS text FROM docs WHERE doc_id % 70 <> 0 AND doc_id % 50 <> 1""")
def good_records_survive(spark, sf):
    """A malformed record costs itself only."""
    rows = shred.shred_table(R.read_records(spark, C.broken_corpus(spark, sf)), M.BROKEN, "doc")
    return rows.select("id", "lang", "text")


@query("sink_jsonl", f"""WITH {LETTERS} SELECT record_id, error_type, '2024-06-01T12:30:00.000000Z' AS "timestamp" FROM letters""")
def sink_jsonl(spark, sf):
    path = fresh_folder(spark, "letters")
    deadletter.write_jsonl(_letters(spark, sf), path)
    return deadletter.read_letters(spark, path).select("record_id", "error_type", "timestamp")


@query("sink_dlq_dates", f"""WITH {LETTERS}
SELECT CASE WHEN record_id IS NULL THEN 'unknown' ELSE '2024' END AS "year", CASE WHEN record_id IS NULL THEN 'unknown' ELSE '06' END AS "month",
  CASE WHEN record_id IS NULL THEN 'unknown' ELSE '01' END AS "day",
  replace(coalesce(record_id, 'unknown'), ':', '_') || '_' || md5(error_type || ':' || error) || '.json' AS file_name FROM letters""")
def sink_dlq_dates(spark, sf):
    """Day folders; letters whose time cannot be read go to ``unknown``."""
    path = fresh_folder(spark, "letters")
    letters = _letters(spark, sf).withColumn("timestamp", F.expr("CASE WHEN record_id IS NULL THEN 'soon' ELSE timestamp END"))
    deadletter.write_by_day(letters, path)
    back = spark.read.schema("year string, month string, day string, file_name string").json(path)
    return back.select("year", "month", "day", "file_name")


@query("dlq_replay", f"""WITH {DOCS} SELECT id, nullif(text, '') AS text FROM docs""")
def dlq_replay(spark, sf):
    """Dead letters of a broken delivery, repaired and shredded again, complete the table."""
    path = fresh_folder(spark, "letters")
    deadletter.write_jsonl(_letters(spark, sf), path)
    letters = deadletter.replayable(deadletter.read_letters(spark, path))
    texts = letters.select(F.replace("xml", F.lit("</txt>"), F.lit("</text>")).alias("xml"))
    # The repair gives id-less records back their id, found by the text of the source.
    rendered = C.broken_record(C.documents(spark, sf), repaired=True).select(
        F.col("id").alias("uid"), F.col("value").alias("full"),
        F.regexp_replace("value", "^<REC><UID>[^<]*</UID>", "<REC>").alias("bare"))
    fixed = rendered.join(texts.select(F.regexp_replace("xml", "^<REC><UID>[^<]*</UID>", "<REC>").alias("bare")).distinct(),
                          "bare", "left_semi").select("uid", F.col("full").alias("xml"))
    good = R.read_records(spark, C.broken_corpus(spark, sf)).select("uid", "xml")
    again = shred.shred_table(fixed, M.BROKEN, "doc").select("id", "text")
    first = shred.shred_table(good, M.BROKEN, "doc").select("id", "text")
    return again.join(first.select("id"), "id", "left_anti").unionByName(first)


# ---- keys, references, counts ---------------------------------------------------------


@query("unique_keys", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def unique_keys(spark, sf):
    return quality.duplicate_keys(C.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("orphans", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def orphans(spark, sf):
    parents = C.table(spark, sf, "documents").where("lang = 'en'")
    return quality.orphans(C.table(spark, sf, "labels").select("doc_id", "quality"), parents, ["doc_id"])


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
       for t in TABLES))
def row_counts(spark, sf):
    return quality.row_counts({t: C.table(spark, sf, t) for t in TABLES})


@query("count_vs_distinct", "SELECT count(*) AS total, count(DISTINCT user_id) AS distinct_ids FROM events")
def count_vs_distinct(spark, sf):
    return quality.count_vs_distinct(C.table(spark, sf, "events"), "user_id")


@query("ingest_dates", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ingest_date FROM events")
def ingest_dates(spark, sf):
    return quality.ingest_dates(C.table(spark, sf, "events"), "ts")


@query("top_k_registry", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events ORDER BY events.ts DESC, event_id LIMIT 20")
def top_k_registry(spark, sf):
    top = quality.latest_rows(C.table(spark, sf, "events"), "ts", 20, ["event_id"])
    return top.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("dup_hashes", "SELECT sha256(text) AS record_hash, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_hashes(spark, sf):
    return quality.duplicate_hashes(C.table(spark, sf, "documents").select(F.sha2("text", 256).alias("record_hash")))


@query("value_range", "SELECT l_orderkey, l_quantity FROM lineitem WHERE NOT l_quantity BETWEEN 5 AND 45")
def value_range(spark, sf):
    return quality.in_range(C.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), "l_quantity", 5, 45)


def _line_tables(spark, sf):
    """The finished tables the checks run on, stored as Parquet."""
    rec = R.read_records(spark, C.lines_corpus(spark, sf))
    return {t: staged(rows, t) for t, rows in shred.shred_tables(rec, M.LINES, M.LINES.tables()).items()}


@query("quality_report", """SELECT * FROM (VALUES ('doc', 'populated', 0::BIGINT), ('doc', 'unique key', 0), ('doc', 'types', 0),
  ('line', 'populated', 0), ('line', 'unique key', 0), ('line', 'foreign key', 0), ('line', 'types', 0)) v(table_name, "check", failures)""")
def quality_report(spark, sf):
    return quality.quality_report(_line_tables(spark, sf), M.LINES, M.LINES_CONTRACTS)


@query("lineage_counts", f"""WITH {LINES} SELECT 'doc' AS parent_table, 'line' AS child_table, (SELECT count(*) FROM docs) AS parent_rows, count(*) AS child_rows FROM lines""")
def lineage_counts(spark, sf):
    """Parent -> child edges of the mapping with the rows shredded on both ends."""
    return quality.lineage_counts(_line_tables(spark, sf), M.LINES)


@query("mapping_lint", f"""WITH {LINES}, n AS (SELECT (SELECT count(*) FROM docs) AS d, (SELECT count(*) FROM lines) AS l,
  (SELECT count(*) FROM docs WHERE text <> '') AS t)
SELECT 'records/REC/raw' AS path, 'column not in contract' AS finding, t AS lost_values FROM n
UNION ALL SELECT 'records/REC/extra/deep', 'column not in contract', d FROM n
UNION ALL SELECT 'records/REC/part/size', 'target table not open', l FROM n""")
def mapping_lint(spark, sf):
    """What the tables lose: lint findings with the number of values in the data."""
    from treeflat.operators import nodes

    lint = M.NOISY.lint(spark, M.NOISY_CONTRACTS)
    rec = R.read_records(spark, C.noisy_corpus(spark, sf)).select("uid", "xml")
    seen = nodes.walk_records(rec, M.NOISY.record.path).where("text <> ''").groupBy("path").agg(F.count(F.lit(1)).alias("lost_values"))
    return lint.join(seen, "path").select("path", "finding", "lost_values")
