"""Queries: record split, shredding, node walk."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import corpora as C
from catalog import mappings as M
from treeflat.functions.text import first_at, first_descendant
from treeflat.operators import nodes, quality, shred
from treeflat.operators.validate import project, valid_rows
from treeflat.session import fresh_folder
from treeflat.sources import files, records as R

QUERIES, ORACLE = {}, {}

#: Documents without characters XML cannot hold.
DOCS = r"""docs AS (
  SELECT doc_id, 'DOC:' || doc_id AS id, lang, source, n_chars,
         regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g') AS text
  FROM documents)"""

LINES = DOCS + """, lines AS (
  SELECT id, doc_id, unnest(string_split(text, chr(10))) AS line,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_id
  FROM docs)"""

SENTENCES = LINES + """, sentences AS (
  SELECT id, line_id, unnest(string_split(line, '. ')) AS s,
         CAST(generate_subscripts(string_split(line, '. '), 1) AS BIGINT) AS sentence_id
  FROM lines)"""


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@query("shred_lines", f"""WITH {LINES}
SELECT id, line_id, CASE WHEN line_id % 2 = 1 THEN CAST(length(line) AS VARCHAR) ELSE '-' END AS width,
       nullif(line, '') AS text FROM lines""")
def shred_lines(spark, sf):
    return shred.shred_table(R.read_records(spark, C.lines_corpus(spark, sf)), M.LINES, "line")


@query("shred_root", f"""WITH {DOCS}
SELECT id, CAST(7 AS BIGINT) AS file_number, CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'xx' END AS lang, source,
       CAST(n_chars AS VARCHAR) AS n_chars, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS line_count,
       '2024-06-01 00:00:00' AS ingestion_ts
FROM docs""")
def shred_root(spark, sf):
    rows = shred.shred_table(R.read_records(spark, C.lines_corpus(spark, sf)), M.LINES, "doc", file_number=7)
    stamped = rows.withColumn("ingestion_ts", F.lit("2024-06-01 00:00:00").cast("timestamp"))
    return stamped.drop("record_hash").withColumn("ingestion_ts", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss"))


@query("shred_three_levels", f"""WITH {SENTENCES}
SELECT id, line_id AS para_id, sentence_id, nullif(s, '') AS text FROM sentences""")
def shred_three_levels(spark, sf):
    return shred.shred_table(R.read_records(spark, C.paras_corpus(spark, sf)), M.PARAS, "sentence")


@query("shred_parent_level", f"""WITH {LINES}
SELECT id, line_id AS para_id, CAST(line_id AS VARCHAR) AS no FROM lines""")
def shred_parent_level(spark, sf):
    return shred.shred_table(R.read_records(spark, C.paras_corpus(spark, sf)), M.PARAS, "para")


@query("shred_flatten_containers", f"""WITH {SENTENCES}
SELECT id, row_number() OVER (PARTITION BY id ORDER BY line_id, sentence_id) AS sentence_id, nullif(s, '') AS text
FROM sentences""")
def shred_flatten_containers(spark, sf):
    return shred.shred_table(R.read_records(spark, C.paras_corpus(spark, sf)), M.FLAT_PARAS, "sentence")


@query("shred_shared_counter", f"""WITH {LINES}, placed AS (
  SELECT id, line, length(line) >= 80 AS is_long,
         row_number() OVER (PARTITION BY id ORDER BY length(line) < 80, line_id) AS n FROM lines)
SELECT id, n AS line_id, nullif(line, '') AS text, CASE WHEN is_long THEN 'long_line' ELSE 'short_line' END AS source_table
FROM placed""")
def shred_shared_counter(spark, sf):
    rec = R.read_records(spark, C.lists_corpus(spark, sf))
    parts = [rows.withColumn("source_table", F.lit(t)) for t, rows in shred.shred_tables(rec, M.LISTS, ["short_line", "long_line"]).items()]
    return parts[0].unionByName(parts[1])


@query("shred_interleaved", f"""WITH {LINES}
SELECT id, line_id AS item_id, nullif(line, '') AS text, CASE WHEN line_id % 3 = 1 THEN 'a_item' ELSE 'b_item' END AS source_table
FROM lines""")
def shred_interleaved(spark, sf):
    rec = R.read_records(spark, C.lists_corpus(spark, sf))
    parts = [rows.withColumn("source_table", F.lit(t)) for t, rows in shred.shred_tables(rec, M.LISTS, ["a_item", "b_item"]).items()]
    return parts[0].unionByName(parts[1])


@query("shred_mixed_text", f"""WITH {LINES}
SELECT id, line_id AS para_id, nullif(CASE WHEN len(string_split(line, '. ')) >= 3 THEN string_split(line, '. ')[1] ELSE line END, '') AS lead
FROM lines""")
def shred_mixed_text(spark, sf):
    return shred.shred_table(R.read_records(spark, C.mixed_corpus(spark, sf)), M.MIXED, "para")


@query("last_write_wins", f"""WITH {LINES}
SELECT docs.id, max_by(nullif(line, ''), line_id) FILTER (line <> '') AS current_line
FROM docs LEFT JOIN lines ON docs.id = lines.id GROUP BY docs.id""")
def last_write_wins(spark, sf):
    rows = shred.shred_table(R.read_records(spark, C.noisy_corpus(spark, sf)), M.NOISY, "doc")
    return rows.select("id", F.col("current").alias("current_line"))


@query("hoisted_column", f"""WITH {LINES} SELECT id, CAST(max(line_id) AS VARCHAR) AS last_part FROM lines GROUP BY id""")
def hoisted_column(spark, sf):
    rows = shred.shred_table(R.read_records(spark, C.noisy_corpus(spark, sf)), M.NOISY, "doc")
    return rows.select("id", "last_part")


@query("closed_target", f"""WITH {LINES} SELECT id, line_id AS part_id, CAST(NULL AS VARCHAR) AS kind FROM lines""")
def closed_target(spark, sf):
    """A value for a table that is not open is dropped; the part row itself is still emitted."""
    return shred.shred_table(R.read_records(spark, C.noisy_corpus(spark, sf)), M.NOISY, "part_row")


@query("contract_projection", f"""WITH {LINES}, d AS (
  SELECT id, max_by(line, line_id) FILTER (line <> '') AS current_line, CAST(max(line_id) AS VARCHAR) AS last_part
  FROM lines GROUP BY id)
SELECT id, current_line AS "current", last_part FROM d""")
def contract_projection(spark, sf):
    """Prefixed tags and un-mapped elements; columns the contract lacks (raw, undeclared) are dropped."""
    rows = shred.shred_table(R.read_records(spark, C.noisy_corpus(spark, sf)), M.NOISY, "doc")
    return project(rows, M.NOISY_CONTRACTS["doc"])


@query("cdata_text", f"""WITH {DOCS}
SELECT id, nullif(replace(replace(text, ']]>', ']] >'), chr(13), ''), '') AS raw FROM docs""")
def cdata_text(spark, sf):
    rows = shred.shred_table(R.read_records(spark, C.noisy_corpus(spark, sf)), M.NOISY, "doc")
    return rows.select("id", "raw")


@query("typed_rows", f"""WITH {DOCS}
SELECT id, CAST(-1 AS BIGINT) AS file_number, CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'xx' END AS lang, source,
       n_chars, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS line_count FROM docs""")
def typed_rows(spark, sf):
    rows = shred.shred_table(R.read_records(spark, C.lines_corpus(spark, sf)), M.LINES, "doc")
    return valid_rows(rows, M.LINES_CONTRACTS["doc"])


@query("node_table", f"""WITH {LINES}
SELECT id, CAST(1 AS INTEGER) AS seq, CAST(NULL AS INTEGER) AS parent_seq, 'records/REC' AS path, CAST(NULL AS VARCHAR) AS text FROM docs
UNION ALL SELECT id, 2, 1, 'records/REC/UID', id FROM docs
UNION ALL SELECT id, CAST(line_id + 2 AS INTEGER), 1, 'records/REC/p',
  nullif(CASE WHEN len(string_split(line, '. ')) >= 3 THEN string_split(line, '. ')[1] ELSE line END, '')
FROM (SELECT id, line, line_id + coalesce(sum(CASE WHEN len(string_split(line, '. ')) >= 3 THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_id FROM lines)
UNION ALL SELECT id, CAST(line_id + 3 AS INTEGER), CAST(line_id + 2 AS INTEGER), 'records/REC/p/i', nullif(string_split(line, '. ')[2], '')
FROM (SELECT id, line, line_id + coalesce(sum(CASE WHEN len(string_split(line, '. ')) >= 3 THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_id FROM lines)
WHERE len(string_split(line, '. ')) >= 3""")
def node_table(spark, sf):
    """Every element as a row in document order, parent pointers included."""
    rec = R.read_records(spark, C.mixed_corpus(spark, sf)).select(F.col("uid").alias("id"), "xml")
    return nodes.walk_records(rec, M.MIXED.record.path).select("id", "seq", "parent_seq", "path", "text")


@query("path_join", f"""WITH {LINES}
SELECT id, 'doc' AS target_table, 'source' AS target_col, source AS "value" FROM docs WHERE source <> ''
UNION ALL SELECT id, 'doc', 'n_chars', CAST(n_chars AS VARCHAR) FROM docs
UNION ALL SELECT id, 'doc', 'lang', CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'xx' END FROM docs
UNION ALL SELECT id, 'doc', 'line_count', CAST(len(string_split(text, chr(10))) AS VARCHAR) FROM docs
UNION ALL SELECT id, 'line', 'text', line FROM lines WHERE line <> ''
UNION ALL SELECT id, 'line', 'width', CASE WHEN line_id % 2 = 1 THEN CAST(length(line) AS VARCHAR) ELSE '-' END FROM lines""")
def path_join(spark, sf):
    """Nodes joined with the mapping on the path: one row per mapped value."""
    rec = R.read_records(spark, C.lines_corpus(spark, sf)).select(F.col("uid").alias("id"), "xml")
    cells = nodes.cells(nodes.walk_records(rec, M.LINES.record.path), M.LINES)
    return cells.select("id", "target_table", "target_col", "value")


@query("record_ids_and_hash", r"""SELECT 'DOC:' || doc_id AS uid,
  sha256('<REC><UID>DOC:' || doc_id || '</UID><lang>' || lang || '</lang><text>' ||
  replace(replace(replace(replace(replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g'),
    '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(13), '&#13;')
  || CASE WHEN doc_id % 50 = 1 THEN '</txt></REC>' ELSE '</text></REC>' END) AS record_hash
FROM documents WHERE doc_id % 70 <> 0""")
def record_ids_and_hash(spark, sf):
    """Ids and content hashes; records without an id are not here but among the failures."""
    return R.read_records(spark, C.broken_corpus(spark, sf)).select("uid", "record_hash")


@query("closing_forms", r"""SELECT 'DOC:' || doc_id AS uid,
  sha256('<REC>' || CASE WHEN doc_id % 7 = 4 THEN '<meta><t><![CDATA[<UID>fake</UID>]]></t><UID>DOC:' || doc_id || '</UID></meta>'
                         ELSE '<UID>DOC:' || doc_id || '</UID>' END ||
         CASE WHEN doc_id % 7 = 5 THEN '<c><![CDATA[ </REC> <!-- <REC><UID>no</UID></x:REC> ]]></c>' ELSE '' END || '<text>' ||
  replace(replace(replace(replace(replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g'),
    '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(13), '&#13;') || '</text></REC>') AS record_hash
FROM documents""")
def closing_forms(spark, sf):
    """Every record, whatever the spelling of its closing tag or the place of its id, and whatever CDATA and comments hold."""
    return R.read_any(spark, C.closings_corpus(spark, sf), recursive=True, glob="*.txt").select("uid", "record_hash")


@query("declared_encodings", r"""WITH clean AS (
  SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g') AS t FROM documents),
held AS (
  SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN regexp_replace(t, '[^\x{0}-\x{FF}]', '?', 'g')
    WHEN 3 THEN regexp_replace(t, '[^\x{0}-\x{7F}\x{A0}-\x{FF}\x{20AC}\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}\x{2026}]', '?', 'g') ELSE t END AS t FROM clean)
SELECT 'DOC:' || doc_id || chr(233) AS uid, sha256('<REC><UID>DOC:' || doc_id || chr(233) || '</UID><text>' ||
  replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(13), '&#13;') || '</text></REC>') AS record_hash
FROM held""")
def declared_encodings(spark, sf):
    """Files in five encodings, read as each declares or marks its own."""
    return R.read_any(spark, C.encodings_corpus(spark, sf), recursive=True, glob="*.txt").select("uid", "record_hash")


@query("path_functions", f"""WITH {DOCS}
SELECT id, source, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS line_count, id AS any_uid FROM docs""")
def path_functions(spark, sf):
    rec = R.read_records(spark, C.lines_corpus(spark, sf))
    return rec.select(
        F.col("uid").alias("id"),
        first_at(F.col("xml"), "/REC/meta/source").alias("source"),
        first_at(F.col("xml"), "/REC/body/@count").alias("line_count"),
        first_descendant(F.col("xml"), "UID").alias("any_uid"),
    )


@query("container_gate", f"""WITH {DOCS}
SELECT id AS uid, 'export/records' AS container FROM docs WHERE lang = 'en'
UNION ALL SELECT id, 'export/drafts' FROM docs WHERE lang <> 'en'""")
def container_gate(spark, sf):
    fragments = R.read_fragments(spark, C.gated_corpus(spark, sf))
    parts = [
        R.gated_records(fragments, c).select("uid", F.lit(c).alias("container")) for c in ("export/records", "export/drafts")
    ]
    return parts[0].unionByName(parts[1])


def _by_language(spark, sf):
    def write(path):
        C.write_xml(C.lines_records(C.documents(spark, sf)), f"{path}/all")
        C.documents(spark, sf).select(F.col("id").alias("value")).write.text(f"{path}/notes")

    return C.once(spark, sf, "tree", write)


@query("discover_records", "SELECT count(*) AS records, count(DISTINCT doc_id) AS ids FROM documents")
def discover_records(spark, sf):
    """Only ``*.xml`` below the folder, at any depth; records per discovered file, summed."""
    path = _by_language(spark, sf)
    found = files.discover(spark, path, "*.xml", recursive=True)
    rec = R.read_records(spark, path, recursive=True, glob="*.xml")
    listed = rec.join(found, rec.source_file == found.file_path)
    return listed.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("uid").alias("ids"))


@query("records_per_file", "SELECT count(*) AS record_count FROM documents")
def records_per_file(spark, sf):
    per_file = quality.records_per_file(R.read_records(spark, C.lines_corpus(spark, sf)))
    return per_file.agg(F.sum("record_count").alias("record_count"))


@query("fingerprints", """SELECT n_nationkey, min(n_nationkey) OVER (PARTITION BY n_regionkey) AS same_as FROM nation""")
def fingerprints(spark, sf):
    """A file per nation that holds its region: files of one region have one fingerprint, others differ."""
    path = fresh_folder(spark, "nations")
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    nation.select("n_nationkey", F.concat(F.lit("<r>"), F.col("n_regionkey"), F.lit("</r>")).alias("value")).write.partitionBy("n_nationkey").text(path)
    prints = files.fingerprints(spark, path, "*.txt", recursive=True)
    keyed = prints.select(F.regexp_extract("file_path", r"n_nationkey=(\d+)", 1).cast(nation.schema["n_nationkey"].dataType).alias("n_nationkey"), "file_md5")
    least = keyed.groupBy("file_md5").agg(F.min("n_nationkey").alias("same_as"))
    return keyed.join(least, "file_md5").select("n_nationkey", "same_as")


@query("fingerprints_corpus", """SELECT doc_id % 97 AS part, doc_id % 97 % 2 = 0 OR count(DISTINCT doc_id) = 1 AS same FROM documents GROUP BY doc_id % 97""")
def fingerprints_corpus(spark, sf):
    """All documents in files by the remainder of their id, written twice: the even files alike, the odd ones with their records turned round."""
    docs = C.documents(spark, sf)
    record = F.concat(F.lit("<REC><UID>"), C.escape(F.col("id")), F.lit("</UID><text>"), C.escape(F.col("text")), F.lit("</text></REC>")).alias("value")
    parts = docs.select((F.col("doc_id") % 97).alias("part"), "doc_id", record).repartition("part")
    twice = parts.select("part", F.explode(F.array(F.lit("first"), F.lit("second"))).alias("copy"), "doc_id", "value")
    turned = (F.col("copy") == "second") & (F.col("part") % 2 == 1)
    path = fresh_folder(spark, "parts")
    ordered = twice.sortWithinPartitions("copy", "part", F.when(turned, -F.col("doc_id")).otherwise(F.col("doc_id")))
    ordered.select("copy", "part", "value").write.partitionBy("copy", "part").text(path)
    prints = files.fingerprints(spark, path, "*.txt", recursive=True)
    part = F.regexp_extract("file_path", r"part=(\d+)", 1).cast(docs.schema["doc_id"].dataType).alias("part")
    found = prints.select(part, "file_md5").groupBy("part").agg(F.count(F.lit(1)).alias("files"), F.countDistinct("file_md5").alias("prints"))
    return found.select("part", ((F.col("files") == 2) & (F.col("prints") == 1)).alias("same"))


@query("file_numbers", """SELECT 'DOC:' || doc_id AS uid,
  CAST(CASE WHEN lang IN (SELECT DISTINCT lang FROM documents WHERE lang < 'f') THEN length(lang) * 100 + ascii(lang) ELSE -1 END AS BIGINT) AS file_number
FROM documents""")
def file_numbers(spark, sf):
    """Files named after languages; a CSV numbers some of them, the others get -1."""
    docs = C.documents(spark, sf)
    path = fresh_folder(spark, "numbers")
    numbers = docs.where("lang < 'f'").select(
        F.col("lang").alias("file_name"), (F.length("lang") * 100 + F.ascii("lang")).cast("bigint").alias("file_number")
    ).distinct()
    numbers.write.csv(path)
    named = docs.select(F.col("id").alias("uid"), F.concat(F.lit("in/"), F.col("lang")).alias("source_file"))
    return files.with_file_number(named, files.read_file_numbers(spark, path)).select("uid", "file_number")


@query("reassemble", f"""WITH {LINES}
SELECT docs.id, docs.source, lines.line_id, nullif(lines.line, '') AS text FROM docs JOIN lines ON docs.id = lines.id""")
def reassemble(spark, sf):
    """Children joined back to their parents on the inherited key."""
    rec = R.read_records(spark, C.lines_corpus(spark, sf))
    parent = shred.shred_table(rec, M.LINES, "doc").select("id", "source")
    child = shred.shred_table(rec, M.LINES, "line").select("id", "line_id", "text")
    return parent.join(child, "id").select("id", "source", "line_id", "text")
