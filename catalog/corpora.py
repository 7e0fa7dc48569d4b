"""XML corpora rendered by Spark from the given tables, one record per source row.

Every record is made from a single row (a document and its lines), so rendering needs no
grouping: however the rows are distributed, no task gathers more than a row.  A corpus is
written once per session and scale into the shared folder and read back from there.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeflat.session import fresh_folder, ship_with_tasks

ship_with_tasks(__name__)

_written: dict[tuple, str] = {}

#: Characters XML 1.0 cannot hold.
FORBIDDEN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"
#: A text without any of them: one run from its first character, which is much cheaper than a search at each.
ALLOWED = r"\A[\x20-\x{FFFD}\t\n\r\x{10000}-\x{10FFFF}]*+\z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean(col) -> Column:
    text = F.col(col) if isinstance(col, str) else col
    return F.when(F.rlike(text, F.lit(ALLOWED)), text).otherwise(F.regexp_replace(text, FORBIDDEN, ""))


def lines(col) -> Column:
    return F.split(clean(col), "\n")


def escape(col) -> Column:
    out = col
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(plain), F.lit(written))
    return out


def spread(df: DataFrame) -> DataFrame:
    """Use all cores even if the source is a single small file; large inputs pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).withColumn("id", F.concat(F.lit("DOC:"), F.col("doc_id")))


def with_lines(docs: DataFrame) -> DataFrame:
    """The documents with their ``clean`` text and its ``lines``, each worked out once."""
    return docs.withColumn("clean", clean("text")).withColumn("lines", F.split("clean", "\n"))


def once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a corpus, written at first use by ``write(path)``."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_folder(spark, f"corpus-{name}")
        write(path)
        _written[key] = path
    return _written[key]


def write_wrapped(records: DataFrame, path: str, open_tags: str, close_tags: str, compression: str = "none") -> None:
    """One well-formed file per partition: the container's tags around its records."""

    def wrap(batches):
        yield pa.RecordBatch.from_pydict({"value": [open_tags]})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": [close_tags]})

    records.select("value").mapInArrow(wrap, "value string").write.option("compression", compression).text(path)


def write_xml(records: DataFrame, path: str) -> None:
    """Spark's own XML writer: one file per partition with container and record tags."""
    (
        records.write.format("xml").option("rowTag", "REC").option("rootTag", "records")
        .option("attributePrefix", "@").option("valueTag", "#text").option("arrayElementName", "item").save(path)
    )


def line_structs(of: Column) -> Column:
    """Lines as elements with an attribute (character count) on every other one."""
    return F.transform(
        of,
        lambda l, i: F.struct(
            l.alias("#text"), F.when(i % 2 == 0, F.length(l).cast("string")).alias("@w")
        ),
    )


def lines_records(docs: DataFrame) -> DataFrame:
    return with_lines(docs).select(
        F.col("id").alias("UID"),
        F.when(F.col("n_chars") % 2 == 0, F.col("lang")).alias("@lang"),
        F.struct(F.col("source"), F.col("n_chars").cast("string").alias("n")).alias("meta"),
        F.struct(F.size("lines").cast("string").alias("@count"), line_structs(F.col("lines")).alias("line")).alias("body"),
    )


def lines_corpus(spark, sf_dir) -> str:
    """``REC@lang / UID, meta(source, n), body@count / line@w``."""
    return once(spark, sf_dir, "lines", lambda p: write_xml(lines_records(documents(spark, sf_dir)), p))


def paras_corpus(spark, sf_dir) -> str:
    """``REC / UID, body / para@no / s``: lines as paragraphs, sentences inside them."""

    def write(path):
        para = F.transform(
            lines("text"),
            lambda l, i: F.struct((i + 1).cast("string").alias("@no"), F.split(l, r"\. ").alias("s")),
        )
        docs = documents(spark, sf_dir).select(F.col("id").alias("UID"), F.struct(para.alias("para")).alias("body"))
        write_xml(docs, path)

    return once(spark, sf_dir, "paras", write)


def _element(name: str, text: Column, attrs: Column | None = None) -> Column:
    head = F.lit(f"<{name}") if attrs is None else F.concat(F.lit(f"<{name}"), attrs)
    return F.concat(head, F.lit(">"), escape(text), F.lit(f"</{name}>"))


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def lists_corpus(spark, sf_dir) -> str:
    """Two sibling lists with one counter (long lines stand first), and interleaved siblings."""

    def write(path):
        ls = F.col("lines")
        short = F.filter(ls, lambda l: F.length(l) < 80)
        long = F.filter(ls, lambda l: F.length(l) >= 80)
        mix = F.transform(
            ls, lambda l, i: F.when(i % 3 == 0, _element("a", l)).otherwise(_element("b", l))
        )
        value = F.concat(
            F.lit("<REC><UID>"), F.col("id"), F.lit("</UID><long>"),
            _joined(F.transform(long, lambda l: _element("l", l))), F.lit("</long><short>"),
            _joined(F.transform(short, lambda l: _element("l", l))), F.lit("</short><mix>"), _joined(mix),
            F.lit("</mix></REC>"),
        )
        write_wrapped(with_lines(documents(spark, sf_dir)).select(value.alias("value")), path, "<records>", "</records>")

    return once(spark, sf_dir, "lists", write)


def mixed_corpus(spark, sf_dir) -> str:
    """Text next to child elements: ``<p>sentence<i>middle</i>rest</p>`` for lines of three or more sentences."""

    def paragraph(line: Column) -> Column:
        s = F.split(line, r"\. ")
        rest = F.array_join(F.slice(s, 3, F.greatest(F.size(s) - 2, F.lit(0))), ". ")
        mixed = F.concat(F.lit("<p>"), escape(s[0]), _element("i", F.try_element_at(s, F.lit(2))), escape(rest), F.lit("</p>"))
        return F.when(F.size(s) >= 3, mixed).otherwise(_element("p", line))

    def write(path):
        value = F.concat(
            F.lit("<REC><UID>"), F.col("id"), F.lit("</UID>"), _joined(F.transform(lines("text"), paragraph)), F.lit("</REC>")
        )
        write_wrapped(documents(spark, sf_dir).select(value.alias("value")), path, "<records>", "</records>")

    return once(spark, sf_dir, "mixed", write)


def noisy_corpus(spark, sf_dir) -> str:
    """Name space prefixes, comments, CDATA, un-mapped elements, repeated scalars, nested hoists.

    It holds every text twice and an element for every line, so its files are compressed: a file is one split here.
    """

    def write(path):
        ls = F.col("lines")
        current = F.transform(ls, lambda l: _element("x:cur", l))
        cdata = F.concat(F.lit("<raw><![CDATA["), F.replace("clean", F.lit("]]>"), F.lit("]] >")), F.lit("]]></raw>"))
        value = F.concat(
            F.lit('<REC xmlns:x="urn:x"><!-- made from '), F.col("doc_id").cast("string"), F.lit(" --><x:UID> "),
            F.col("id"), F.lit(" </x:UID><extra><deep>"), F.col("lang"), F.lit("</deep></extra><state>"), _joined(current),
            F.lit("</state>"), F.replace(cdata, F.lit("\r"), F.lit("")),
            _joined(F.transform(ls, lambda l, i: F.concat(
                F.lit("<part><size>"), F.length(l).cast("string"), F.lit("</size><top>"), (i + 1).cast("string"),
                F.lit("</top></part>")))),
            F.lit("</REC>"),
        )
        write_wrapped(with_lines(documents(spark, sf_dir)).select(value.alias("value")), path, "<records>", "</records>", "gzip")

    return once(spark, sf_dir, "noisy", write)


def broken_record(docs: DataFrame, repaired: bool = False) -> DataFrame:
    """Documents as records; some lack the id or a closing tag unless ``repaired``."""
    text = _element("text", clean("text"))
    uid = _element("UID", F.col("id"))
    if not repaired:
        uid = F.when(F.col("doc_id") % 70 == 0, F.lit("")).otherwise(uid)
        text = F.when(F.col("doc_id") % 50 == 1, F.replace(text, F.lit("</text>"), F.lit("</txt>"))).otherwise(text)
    return docs.select("doc_id", "id", F.concat(F.lit("<REC>"), uid, _element("lang", F.col("lang")), text, F.lit("</REC>")).alias("value"))


def broken_corpus(spark, sf_dir) -> str:
    return once(
        spark, sf_dir, "broken",
        lambda p: write_wrapped(broken_record(documents(spark, sf_dir)), p, "<records>", "</records>"),
    )


def closings_corpus(spark, sf_dir) -> str:
    """Documents as records that end in all the spellings XML allows, a seventh each.

    The fifth seventh has its id deeper, beside a false one in CDATA; the sixth holds closing tags in CDATA, the last in a comment.  Documents with
    an id that 3 divides are in files of their own, in which every record ends with a prefix.
    """
    docs = documents(spark, sf_dir)
    uid, text = _element("UID", F.col("id")), _element("text", clean("text"))
    deep = F.concat(F.lit("<meta><t><![CDATA[<UID>fake</UID>]]></t>"), uid, F.lit("</meta>"))
    hidden = F.concat(uid, F.lit("<c><![CDATA[ </REC> <!-- <REC><UID>no</UID></x:REC> ]]></c>"))
    remark = F.concat(uid, F.lit("<!-- </REC> <![CDATA[ </x:REC> -->"))
    form, prefixed = F.col("doc_id") % 7, F.col("doc_id") % 3 == 0
    start = F.when((form == 2) | prefixed, "<x:REC>").otherwise("<REC>")
    end = F.when(prefixed, "</x:REC>").when(form == 1, "</REC >").when(form == 2, "</x:REC>").when(form == 3, "</REC\t>").otherwise("</REC>")
    own = F.when(form == 4, deep).when(form == 5, hidden).when(form == 6, remark).otherwise(uid)
    rec = docs.select(F.concat(start, own, text, end).alias("value"), prefixed.alias("prefixed"))

    def write(path):
        for apart in (False, True):
            write_wrapped(rec.filter(F.col("prefixed") == apart), f"{path}/prefixed={apart}", '<records xmlns:x="urn:x">', "</records>")

    return once(spark, sf_dir, "closings", write)


#: By remainder of the id: encoding, what the declaration says, what the text may not hold in it.
ENCODINGS = [
    ("UTF-8", "", None),
    ("ISO-8859-1", '<?xml version="1.0" encoding="iso-8859-1"?>', r"[^\x{0}-\x{FF}]"),
    ("UTF-16LE", '<?xml version="1.0" encoding="UTF-16"?>', None),
    ("windows-1252", "<?xml version='1.0' encoding='Windows-1252'?>", r"[^\x{0}-\x{7F}\x{A0}-\x{FF}\x{20AC}\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}\x{2026}]"),
    ("UTF-16BE", '<?xml version="1.0"?>', None),
]


def encodings_corpus(spark, sf_dir) -> str:
    """Documents in files of five encodings, declared or marked as XML has it."""
    docs = documents(spark, sf_dir)
    marks = {"UTF-16LE": "\ufeff", "UTF-16BE": "\ufeff"}
    windows = {c: bytes(c, "cp1252").decode("latin-1") for c in "\u20ac\u2013\u2014\u2018\u2019\u201c\u201d\u2026"}

    def write(path):
        for k, (encoding, declaration, foreign) in enumerate(ENCODINGS):
            text = clean("text") if foreign is None else F.regexp_replace(clean("text"), foreign, "?")
            rec = docs.filter(F.pmod(F.col("doc_id"), F.lit(len(ENCODINGS))) == k).select(
                F.concat(F.lit("<REC>"), _element("UID", F.concat(F.col("id"), F.lit("\u00e9"))), _element("text", text), F.lit("</REC>")).alias("value")
            )

            def wrap(batches, head=marks.get(encoding, "") + declaration + "<records>"):
                yield pa.RecordBatch.from_pydict({"value": [head]})
                yield from batches
                yield pa.RecordBatch.from_pydict({"value": ["</records>"]})

            value = F.col("value")
            if encoding == "windows-1252":
                value = F.encode(F.translate(value, "".join(windows), "".join(windows.values())), "ISO-8859-1")
            else:
                value = F.encode(value, encoding)
            written = rec.mapInArrow(wrap, "value string").select(value.cast("string").alias("value"))
            # the separator in the file's encoding, too
            written.write.option("encoding", encoding if encoding.startswith("UTF-16") else "UTF-8").option("lineSep", "\n").text(f"{path}/e={k}")

    return once(spark, sf_dir, "encodings", write)


def gated_corpus(spark, sf_dir) -> str:
    """Files holding two containers: records whose language is English, then all others as drafts."""

    def write(path):
        def wrap(batches):
            yield pa.RecordBatch.from_pydict({"value": ["<export><records>"]})
            inside = True
            for b in batches:
                rows = []
                for value, published in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if published != inside:
                        rows.append("</records><drafts>" if inside else "</drafts><records>")
                        inside = published
                    rows.append(value)
                yield pa.RecordBatch.from_pydict({"value": rows})
            yield pa.RecordBatch.from_pydict({"value": ["</records></export>" if inside else "</drafts></export>"]})

        docs = documents(spark, sf_dir)
        rec = F.concat(F.lit("<REC>"), _element("UID", F.col("id")), _element("t", clean("text")), F.lit("</REC>"))
        docs.select(rec.alias("value"), (F.col("lang") == "en").alias("published")).mapInArrow(wrap, "value string").write.text(path)

    return once(spark, sf_dir, "gated", write)
