"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

Writing.  A page becomes a transaction of three records: request, response (or revisit), metadata; request and
metadata name the response in ``WARC-Concurrent-To``.  Of equal payloads that of the largest page id is the response, the
others are revisits that refer to it (identical-payload-digest profile) and carry no payload.  The text sink writes
the records; its line separator is the blank line that ends a record.  Only digests are shuffled to find equal payloads.

Reading.  Every record starts with the version line and an ``Archive-Mark`` field that holds a random number drawn for
this archive, and that pair of lines is the separator of the text source: Spark cuts *inside* files, and no payload can
hold the separator by accident or on purpose, since the number was drawn after the payloads were made.  Without a mark (archives of
others) the version line alone separates; a record whose length is not its ``Content-Length`` is then
returned with ``complete`` false, never silently cut.

Assembly.  Requests and metadata are joined to responses through the concurrent-to identifiers, in either direction.

Defined results: null html is an empty payload, a null url is left out, of any other url (no check is made of it) NUL and line breaks of
every kind are written percent-encoded, a null page id is the smallest and empty in the archive;
rows given twice are captures of their own (the second a revisit of the first: of equal page ids the last row read is the response).
Requests or metadata without a response give a capture whose ``response`` is null.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeflat.llm.common import fresh_folder, staged

CRLF = "\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A list of revisits is broadcast up to this many rows; beyond, the join is a shuffle.
BROADCAST_ROWS = 50_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are four groups of 40, so hexadecimal converts group by group."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def _field(name: str, value: Column) -> Column:
    """A header line with its line end; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _one_line(url: Column) -> Column:
    """What would end a field, or look like a line end to a reader of other line ends, percent-encoded as UTF-8."""
    for sign in "\0\n\x0b\x0c\r\x85\u2028\u2029":
        url = F.replace(url, F.lit(sign), F.lit("".join(f"%{b:02X}" for b in sign.encode())))
    return url


def _record(mark: str, kind: Column, urn: Column, fields: list[Column], block: Column) -> Column:
    head = [F.lit(f"WARC/1.1{CRLF}Archive-Mark: {mark}{CRLF}"), _field("WARC-Type", kind), _field("WARC-Record-ID", F.concat(F.lit("<"), urn, F.lit(">")))]
    return F.concat(*head, *fields, _field("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", smallest: int = 0) -> str:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``; returns the mark.

    Payloads under ``smallest`` bytes are always responses.
    """
    spark = pages.sparkSession
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        _one_line(F.col("url").cast("string")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    )
    payload = F.col("html").cast("binary")
    keys = staged(source.select("page_id", "row", F.octet_length(payload).alias("size"), base32_sha1(payload).alias("digest")), "warc-keys")
    first = F.struct(F.coalesce(F.col("page_id"), F.lit(-(2**63)).cast("long")).alias("p"), F.col("row").alias("r"))
    groups = keys.filter(F.col("size") >= smallest).groupBy("digest").agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = staged(
        keys.filter(F.col("size") >= smallest).join(groups, "digest").filter(F.col("row") != F.col("first.r")).select("row", F.col("first.p").alias("first_page"), F.col("first.r").alias("first_row")),
        "warc-revisits",
    )
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    mark = uuid.uuid4().hex
    run = F.lit(mark)
    urn = lambda kind, page, row: _urn(run, F.lit(kind), row.cast("string"))
    rows = source.join(revisits, "row", "left").select(
        "page_id",
        "url",
        "html",
        base32_sha1(payload).alias("digest"),
        F.col("first_row").isNotNull().alias("again"),
        urn("response", F.col("page_id"), F.col("row")).alias("main"),
        urn("response", F.col("first_page"), F.col("first_row")).alias("refers"),
        urn("request", F.col("page_id"), F.col("row")).alias("request"),
        urn("metadata", F.col("page_id"), F.col("row")).alias("metadata"),
    )
    again = F.col("again")
    uri, when = _field("WARC-Target-URI", F.col("url")), _field("WARC-Date", F.lit(date))
    # not parse_url: URLs as crawled need not be what java.net.URI takes
    host = F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"), F.when(again, "").otherwise(F.col("html")))
    answer = _record(mark, F.when(again, "revisit").otherwise("response"), F.col("main"), [
        when, uri, _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, F.concat(_field("WARC-Profile", F.lit(_REVISIT)), _field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers"), F.lit(">"))))).otherwise(""),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
    ], http)
    to = _field("WARC-Concurrent-To", F.concat(F.lit("<"), F.col("main"), F.lit(">")))
    asked = _record(mark, F.lit("request"), F.col("request"), [when, uri, to, _field("Content-Type", F.lit("application/http; msgtype=request"))],
                    F.concat(F.lit("GET / HTTP/1.1" + CRLF), F.lit("Host: "), host, F.lit(CRLF * 2)))
    about = _record(mark, F.lit("metadata"), F.col("metadata"), [when, uri, to, _field("Content-Type", F.lit("application/warc-fields"))],
                    F.concat(F.lit("page: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    rows.select(F.explode(F.array(asked, answer, about)).alias("value")).write.option("lineSep", CRLF * 2).text(path)
    return mark


def read_records(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """One row per WARC record: record_id, type, date, uri, concurrent_to (list), refers_to, digest, content_type, block (bytes), complete."""
    separator = f"WARC/1.1{CRLF}" + (f"Archive-Mark: {mark}{CRLF}" if mark else "")
    raw = spark.read.option("lineSep", separator).text(path).filter(F.octet_length("value") > 0)
    cut = raw.select("value", F.substring_index("value", CRLF * 2, 1).alias("head"))

    # a field ends at CR LF and nowhere else
    pattern = r"(?is)(?:\A|(?<=\r\n)){name}:[ \t]*(.*?)[ \t]*(?=\r\n|\z)"

    def field(name: str) -> Column:
        got = F.regexp_extract("head", pattern.format(name=name), 1)
        return F.when(got != "", got)

    def bare(urn: Column) -> Column:
        return F.regexp_replace(urn, "^<|>$", "")

    length = F.coalesce(field("Content-Length").try_cast("int"), F.lit(-1))
    start = F.octet_length("head") + 5
    data = F.col("value").cast("binary")
    return cut.select(
        bare(field("WARC-Record-ID")).alias("record_id"),
        F.lower(field("WARC-Type")).alias("type"),
        field("WARC-Date").alias("date"),
        field("WARC-Target-URI").alias("uri"),
        F.transform(F.regexp_extract_all("head", F.lit(pattern.format(name="WARC-Concurrent-To")), 1), bare).alias("concurrent_to"),
        bare(field("WARC-Refers-To")).alias("refers_to"),
        field("WARC-Payload-Digest").alias("digest"),
        field("Content-Type").alias("content_type"),
        F.substring(data, start, F.greatest(length, F.lit(0))).alias("block"),
        (F.octet_length(data) == start - 1 + length + 4).alias("complete"),
    )


def captures(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: response (or revisit) with its payload, requests, metadata.

    Without ``payloads`` the response has only their size and digest, so no payload is shuffled.  ``requests`` and ``metadata`` are sorted lists without repeats, empty where there are none.
    """
    known = records.filter(F.col("record_id").isNotNull())
    head = F.substring_index(F.col("block").cast("string"), CRLF * 2, 1)
    body = F.substring(F.col("block"), F.octet_length(head) + 5, F.lit(2**31 - 1))
    payload = F.when(F.col("content_type").startswith("application/http"), body).otherwise(F.col("block"))
    mains = known.filter(F.col("type").isin("response", "revisit", "resource")).select(
        F.col("record_id").alias("capture_id"),
        "concurrent_to",
        F.struct(
            "type", "date", "uri", "refers_to", "digest", "complete",
            F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"),
            *([payload.alias("payload")] if payloads else []),
        ).alias("response"),
    )
    sides = known.filter(F.col("type").isin("request", "metadata")).select(
        "record_id", "concurrent_to", F.struct("record_id", "date", "uri", "content_type", F.col("block").cast("string").alias("text"), "complete").alias("side"), "type"
    )
    named = sides.select(F.explode("concurrent_to").alias("capture_id"), "type", "side")
    naming = mains.select("capture_id", F.explode("concurrent_to").alias("record_id")).join(sides.drop("concurrent_to"), "record_id").select("capture_id", "type", "side")
    attached = named.unionByName(naming).groupBy("capture_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("type") == "request", F.col("side")))).alias("requests"),
        F.sort_array(F.collect_set(F.when(F.col("type") == "metadata", F.col("side")))).alias("metadata"),
    )
    none = F.array().cast(attached.schema["requests"].dataType)
    return mains.drop("concurrent_to").join(attached, "capture_id", "full").select(
        "capture_id", "response", F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata")
    )


def page_report(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages, read the archives, assemble: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit takes its payload's size and digest from the response that it refers to.
    """
    spark = pages.sparkSession
    path = path or fresh_folder(spark, "warc")
    mark = write_archives(pages, path)
    light = staged(
        captures(read_records(spark, path, mark), payloads=False).select(
            "capture_id",
            F.regexp_extract(F.element_at(F.col("metadata.text"), 1), r"(?m)^page: *(-?[0-9]*)", 1).try_cast("long").alias("page_id"),
            F.col("response.type").alias("record_type"),
            F.col("response.refers_to").alias("refers_id"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
        ),
        "warc-captures",
    )
    revisit = F.col("record_type") == "revisit"
    targets = light.filter(~revisit).select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("sha"))
    kept = light.filter(~revisit).select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = light.filter(revisit).join(targets, "refers_id", "left").select("page_id", F.col("size").alias("payload_bytes"), F.col("sha").alias("payload_digest"), "record_type", "refers_to")
    return kept.unionByName(again)
