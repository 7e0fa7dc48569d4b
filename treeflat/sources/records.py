"""Record source: XML files to one row per record, split inside files by Spark."""

from __future__ import annotations

import codecs
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from treeflat.functions.text import blank_to_null, sha256_hex, strip_space
from treeflat.session import ship_with_tasks, staged
from treeflat.sources.files import as_pattern, plain_path, profiled

ship_with_tasks(__name__)

#: The fallback looks for this descendant in any name space.
FALLBACK_ID = "UID"
#: The error of a record that its file's end cuts off.
CUT_OFF = "record is cut off by the end of the file"
_PREFIX = r"(?:[^\s<>:/]++:)?"


#: Encodings of several bytes a character in which no byte of one looks like ``<`` or ``>``.
_MULTIBYTE = {"gb18030", "gbk", "gb2312", "big5", "big5hkscs", "shift_jis", "cp932", "euc_jp", "euc_kr", "cp949"}
#: Where a piece of text ends: in text, in a CDATA section, in a comment.
_TEXT, _CDATA, _COMMENT = 0, 1, 2


def read_fragments(
    spark: SparkSession, paths, record_tag: str = "REC", id_tag: str = "UID", recursive: bool = False,
    glob: str | None = None, encoding: str | None = None, closing: str | None = None,
) -> DataFrame:
    """Text up to each closing record tag, with its origin, the record in it and its id.

    The closing tag (``closing``, if it has another spelling in these files) is the line separator, so Spark cuts large files into splits at record
    ends and no task holds more than a split.  ``pos`` grows in file order.  Files in an
    ``encoding`` other than UTF-8 are decoded.  A closing tag inside CDATA or a comment ends a fragment, too: :func:`mended` joins such fragments.
    """
    kind = charset_kind(encoding)
    if kind is None:
        raise ValueError(f"unknown encoding {encoding}")
    reader = spark.read.option("lineSep", closing or f"</{record_tag}>").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if kind == "utf-16":
        reader = reader.option("encoding", encoding)  # of the separator's bytes
    return cut_fragments(with_origin(reader.text(paths)), record_tag, id_tag, encoding, closing)


def read_profiled(spark: SparkSession, profile: DataFrame, record_tag: str = "REC", id_tag: str = "UID") -> tuple[DataFrame | None, DataFrame]:
    """Fragments of the files of a profile (see :func:`treeflat.sources.files.profiled`), each file by its own encoding and closing tag.

    Files are read in groups of one encoding and closing tag.  The second table has ``source_file, error`` of files
    in an encoding that is not known; they are not read.
    """
    groups: dict[tuple, list[str]] = {}
    refused = []
    # the scan needs the list of paths on the driver, as any file scan does
    for r in profile.select("file_path", "charset", "closing").orderBy("file_path").collect():
        if charset_kind(r["charset"]) is None:
            refused.append((r["file_path"], f"unknown encoding {r['charset']}"))
        else:
            groups.setdefault((r["charset"], r["closing"]), []).append(as_pattern(r["file_path"]))
    parts = [read_fragments(spark, paths, record_tag, id_tag, encoding=charset, closing=closing) for (charset, closing), paths in groups.items()]
    return (reduce(DataFrame.unionByName, parts) if parts else None), spark.createDataFrame(refused, "source_file string, error string")


def charset_kind(name: str | None) -> str | None:
    """How an encoding is decoded: ``utf-8`` (as it is), ``utf-16``, ``single`` (a byte a character), ``multiple``; None if it is not known."""
    if name is None:
        return "utf-8"
    try:
        known = codecs.lookup(name).name
        # a declaration that could be read as ASCII cannot be in UTF-16
        if known in ("utf-8", "ascii", "utf-16"):
            return "utf-8"
        if known in ("utf-16-le", "utf-16-be"):
            return "utf-16"
        if known in _MULTIBYTE:
            return "multiple"
        low, high = bytes(range(128)).decode(known), bytes(range(128, 256)).decode(known, "replace")
    except (LookupError, UnicodeError):
        return None
    return "single" if low == bytes(range(128)).decode("ascii") and len(high) == 128 else None


def decoded(value: Column, encoding: str | None) -> Column:
    """The text of raw bytes that a text source has taken for UTF-8."""
    kind, data = charset_kind(encoding), value.cast("binary")
    if kind == "utf-8":
        return value
    if kind == "utf-16":
        return F.decode(data, encoding)
    if kind == "single":
        latin = F.decode(data, "ISO-8859-1")
        high = bytes(range(128, 256))
        own, plain = high.decode(encoding, "replace"), high.decode("latin-1")
        return latin if own == plain else F.translate(latin, plain, own)

    @F.pandas_udf("string")
    def multiple(texts: pd.Series) -> pd.Series:
        return texts.map(lambda b: None if b is None else bytes(b).decode(encoding, "replace"))

    return multiple(data)


def with_origin(text: DataFrame) -> DataFrame:
    """The text with the file columns Spark offers for file sources."""
    return text.select(
        "value",
        plain_path(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def cut_fragments(raw: DataFrame, record_tag: str = "REC", id_tag: str = "UID", encoding: str | None = None, closing: str | None = None) -> DataFrame:
    """Add ``ending``, ``n_bytes``, ``pos``, ``xml`` (NULL where no record starts) and ``uid`` (NULL where there is none).

    Records that end with another spelling of the closing tag than ``closing`` (a prefix, white space before ``>``) are cut
    here.  ``n_bytes`` counts a line with its separator, at the line's first piece; ``ending`` is the closing tag of a piece.

    The position is not deterministic for Catalyst, so later
    filters stay above the last projection and the text is searched once per fragment.
    """
    separator = closing or f"</{record_tag}>"
    n_separator = len(separator.encode(encoding if charset_kind(encoding) == "utf-16" else "utf-8"))
    value = decoded(F.col("value"), encoding)
    spelled = rf"</(?:[^\s<>:/]+:)?{_name(record_tag)}\s*>"
    pieces = F.regexp_extract_all(value, F.lit(rf"(?s).+?(?:{spelled}|\z)"), F.lit(0))
    unusual = _may_close(value, record_tag)
    rest = [c for c in raw.columns if c != "value"]
    lines = raw.select(
        *rest, F.octet_length(F.col("value").cast("binary")).alias("#size"), unusual.alias("#unusual"), F.when(unusual, pieces).otherwise(F.array(value)).alias("#pieces")
    )
    # There always is a piece.  The outer form keeps Catalyst from a filter below that would cut every line a second time to see that.
    cut = lines.select(*rest, "#size", "#unusual", F.size("#pieces").alias("#count"), F.posexplode_outer("#pieces").alias("#at", "#piece"))
    own = F.when(F.col("#unusual") & _may_close(F.col("#piece"), record_tag), F.regexp_extract("#piece", rf"{spelled}\z", 0)).otherwise(F.lit(""))
    cut = cut.select(*rest, "#size", "#count", "#at", "#piece", own.alias("#own"))
    ended = F.col("#own") != ""
    text = F.when(ended, F.left("#piece", F.char_length("#piece") - F.char_length("#own"))).otherwise(F.col("#piece"))
    # the line's separator counts unless its last piece ends otherwise
    size = F.when(F.col("#at") == 0, F.col("#size")).otherwise(0) + F.when((F.col("#at") == F.col("#count") - 1) & ~ended, n_separator).otherwise(0)
    fragments = cut.select(
        text.alias("value"), *rest, F.when(ended, F.col("#own")).otherwise(F.lit(separator)).alias("ending"), size.alias("n_bytes")
    )
    return _with_record(fragments, record_tag, id_tag, F.monotonically_increasing_id())


def _may_close(text: Column, record_tag: str) -> Column:
    """Whether a closing record tag of any spelling can be in a text; without a search by pattern."""
    return F.contains(text, F.lit(f"</{record_tag}")) | F.contains(text, F.lit(f":{record_tag}"))


def _with_record(fragments: DataFrame, record_tag: str, id_tag: str, pos: Column) -> DataFrame:
    """The record that a fragment ends with, with its closing tag (its own tag loses its prefix), and its id.

    The steps are projections of their own, so each is worked out once.
    """
    lead, name = _before_record(F.col("value"), record_tag), _name(record_tag)
    texts = fragments.select(*fragments.columns, lead.alias("#lead"))
    # Most fragments are their record, after white space: no pattern runs through those.
    whole = F.startswith("#lead", F.lit(f"<{record_tag}>")) | F.startswith("#lead", F.lit(f"<{record_tag} "))
    body = F.when(~whole, F.regexp_extract("#lead", rf"(?s)<{_PREFIX}{name}([\s>].*)", 1))
    texts = texts.select(*texts.columns, whole.alias("#whole"), body.alias("#body"))
    start, end = F.lit(f"<{record_tag}"), F.lit(f"</{record_tag}>")
    xml = F.when(F.col("#whole"), F.concat("#lead", end)).otherwise(F.concat(start, F.nullif("#body", F.lit("")), end))
    texts = texts.select(*fragments.columns, xml.alias("xml"))
    return texts.select(*[c for c in fragments.columns if c != "pos"], pos.alias("pos"), "xml", record_id(F.col("xml"), record_tag, id_tag).alias("uid"))


def _open_after(text: Column) -> Column:
    """The state in which a text ends that begins as plain text."""
    rest = F.regexp_replace(text, r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->", " ")
    cdata, comment = F.instr(rest, F.lit("<![CDATA[")), F.instr(rest, F.lit("<!--"))
    state = F.when((cdata == 0) & (comment == 0), _TEXT).when((comment == 0) | (cdata > 0) & (cdata < comment), _CDATA).otherwise(_COMMENT)
    return F.when(F.contains(text, F.lit("<!")), state).otherwise(_TEXT)


def _state_map() -> list[Column]:
    """For each state in which a fragment may begin, the state in which it ends."""
    out = [_open_after(F.col("value")).alias("from_text")]
    for state, name, mark in ((_CDATA, "from_cdata", "]]>"), (_COMMENT, "from_comment", "-->")):
        at = F.instr("value", F.lit(mark))
        rest = F.substring("value", at + 3, F.char_length("value"))
        out.append(F.when(at == 0, state).otherwise(_open_after(rest)).alias(name))
    return out


def mended(fragments: DataFrame, record_tag: str = "REC", id_tag: str = "UID", scan: DataFrame | None = None) -> DataFrame:
    """Fragments joined again where a closing tag that ended one lies in CDATA or in a comment.

    Each fragment maps the state (text, CDATA, comment) in which it begins to that in which it ends.  The maps are composed
    within each split, over the splits of a file on one small row per split, and give every fragment's state; those that
    begin inside go to the fragment before.  Only files with a fragment that ends inside take part, and only
    the texts of the fragments to join are moved.  What opens and never closes is left as it is: later records of the file survive.
    ``scan`` is a staged :func:`light_scan`, so that nothing is read to find that nothing is to be done.
    """
    light = fragments.select("source_file", _open_after(F.col("value")).alias("open")) if scan is None else scan
    opened = light.where(F.col("open") != _TEXT).select("source_file")
    if opened.isEmpty():
        return fragments
    odd = staged(opened.distinct(), "open-files")
    columns = fragments.columns
    mine = fragments.join(odd, "source_file", "left_semi")
    maps = staged(mine.select("source_file", "block", "pos", *_state_map()), "open-states")
    # numbers only: a split has as many rows as record ends
    splits = maps.groupBy("source_file", "block").applyInPandas(_composed, "source_file string, block long, states array<int>, heads array<long>")
    begins = staged(splits.groupBy("source_file").applyInPandas(_followed, "source_file string, block long, state int, head long, stop long"), "open-splits")
    states = maps.join(begins, ["source_file", "block"])
    members = staged(states.groupBy("source_file", "block").applyInPandas(_chained, "source_file string, pos long, head long"), "open-chains")
    parts = F.sort_array(F.collect_list(F.struct("pos", "value", "ending")))
    chains = mine.join(members, ["source_file", "pos"]).groupBy("source_file", "head").agg(
        parts.alias("parts"), F.min("block").alias("block"), F.max("file_size").alias("file_size"), F.sum("n_bytes").cast(fragments.schema["n_bytes"].dataType).alias("n_bytes")
    )
    last = F.element_at("parts", -1)
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["value"], F.when(p["pos"] == last["pos"], "").otherwise(p["ending"]))), "")
    joined = staged(chains.select(text.alias("value"), "source_file", "file_size", "block", last["ending"].alias("ending"), "n_bytes", last["pos"].alias("pos")), "open-joined")
    left = fragments.join(members.select("source_file", "pos"), ["source_file", "pos"], "left_anti")
    return left.select(*columns).unionByName(_with_record(joined, record_tag, id_tag, F.col("pos")).select(*columns))


def _steps(pdf: pd.DataFrame):
    ordered = pdf.sort_values("pos")
    return zip(ordered["pos"].tolist(), ordered[["from_text", "from_cdata", "from_comment"]].values.tolist())


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one split: the final state by first state, and the last fragment that begins as text (-1: none)."""
    states, heads = [_TEXT, _CDATA, _COMMENT], [-1, -1, -1]
    for pos, step in _steps(pdf):
        heads = [pos if s == _TEXT else h for s, h in zip(states, heads)]
        states = [step[s] for s in states]
    return pd.DataFrame({"source_file": pdf["source_file"].iloc[:1], "block": pdf["block"].iloc[:1], "states": [states], "heads": [heads]})


def _followed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one file: state and open fragment at each split's begin; ``stop`` is the fragment after which nothing closes any more (-1: none)."""
    ordered = pdf.sort_values("block")
    state, head, out = _TEXT, -1, []
    for states, heads in zip(ordered["states"], ordered["heads"]):
        out.append((state, head))
        head = head if heads[state] < 0 else heads[state]
        state = states[state]
    stop = head if state != _TEXT else -1
    return pd.DataFrame({"source_file": ordered["source_file"].values, "block": ordered["block"].values, "state": [s for s, _ in out], "head": [h for _, h in out], "stop": stop})


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The fragments of a split that begin or end inside, with the fragment that their chain begins with."""
    state, head, stop = (int(pdf[c].iloc[0]) for c in ("state", "head", "stop"))
    out = []
    for pos, step in _steps(pdf):
        after = step[state]
        head = pos if state == _TEXT else head
        if (state != _TEXT or after != _TEXT) and not (stop >= 0 and head >= stop):
            out.append((pos, head))
        state = after
    return pd.DataFrame({"source_file": pdf["source_file"].iloc[0], "pos": [p for p, _ in out], "head": [h for _, h in out]})


def without_comments(col: Column) -> Column:
    """Drop comments, but not the look-alikes inside CDATA."""
    cleaned = F.regexp_replace(col, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    return F.when(F.contains(col, F.lit("<!--")), cleaned).otherwise(col)


def _name(tag: str) -> str:
    return tag.replace(".", r"\.")


def record_id(xml: Column, record_tag: str, id_tag: str) -> Column:
    """The record's own id child, else the first descendant of the fallback name; trimmed.

    The id as the record's first child (the usual place) is found without a parse; only
    other records are parsed, and only for that child.
    """
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false",
               "valueTag": "#text", "attributePrefix": "@"}
    head = rf"(?s)^<{_name(record_tag)}(?:\s[^>]*+)?>"
    if id_tag == record_tag:
        lead = F.regexp_extract(xml, head + r"([^<]*+)", 1)
        return blank_to_null(strip_space(F.from_xml(F.concat(F.lit("<v><t>"), lead, F.lit("</t></v>")), "t string", options).t))
    tag = rf"(?:[\w.-]+:)?{_name(id_tag)}"
    # what does not end within these characters is left to the parser
    first = F.regexp_extract(F.left(xml, F.lit(2000)), head + rf"\s*<{tag}(?:\s[^>]*+)?>([^<&]*+)</", 1)
    child = F.from_xml(xml, f"`{id_tag}` array<struct<`#text`:string,`@#`:string>>", options)[id_tag]
    own = blank_to_null(F.try_element_at(child, F.lit(1)).getField("#text"))
    outside = F.regexp_replace(xml, r"(?s)<!\[CDATA\[.*?\]\]>", "")
    lead = F.regexp_extract(outside, rf"<(?:[\w.-]+:)?{FALLBACK_ID}(?:\s[^>]*)?>([^<]*)</", 1)
    anywhere = F.from_xml(F.concat(F.lit("<v><t>"), lead, F.lit("</t></v>")), "t string", options).t
    found = F.coalesce(blank_to_null(first), own, blank_to_null(anywhere))
    return blank_to_null(strip_space(found))


def _before_record(value: Column, record_tag: str) -> Column:
    """A fragment from its first character that is not white space, without comments and empty record elements."""
    clean = without_comments(value)
    # An empty record element has no closing tag of its own and would hide the next one.
    bare = F.when(F.contains(clean, F.lit("/>")), F.regexp_replace(clean, rf"<{_PREFIX}{_name(record_tag)}(\s[^<>]*)?/>", "")).otherwise(clean)
    return F.ltrim(bare, F.lit(" \t\r\n"))


def split_records(fragments: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """``uid, xml, record_hash, source_file, pos`` for every record that has an id.

    ``tails`` (see :func:`truncated_tails`) removes records cut off by the end of a file.
    """
    # Naming the position keeps this filter above the projection that searched the text.
    found = fragments.where("pos >= 0 and uid is not null")
    if tails is not None:
        found = found.join(tails.select("source_file", "pos"), ["source_file", "pos"], "left_anti")
    return found.select("uid", "xml", sha256_hex("xml").alias("record_hash"), "source_file", "pos")


def read_records(
    spark: SparkSession, paths, record_tag: str = "REC", id_tag: str = "UID", recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    return split_records(read_fragments(spark, paths, record_tag, id_tag, recursive, glob))


def read_any(spark: SparkSession, paths, record_tag: str = "REC", id_tag: str = "UID", recursive: bool = False, glob: str = "*.xml") -> DataFrame:
    """Records of files as they come: each file's declared encoding and own closing tag, closing tags in CDATA and comments.

    One scan more than :func:`read_records` to find out.  An unknown encoding is an error here; a run sends such files to the dead letters.
    """
    fragments, refused = read_profiled(spark, profiled(spark, paths, glob, recursive, record_tag), record_tag, id_tag)
    first = refused.first()
    if first:
        raise ValueError(f"{first['source_file']}: {first['error']}")
    if fragments is None:
        return spark.createDataFrame([], "uid string, xml string, record_hash string, source_file string, pos long")
    return split_records(mended(fragments, record_tag, id_tag))


def light_scan(fragments: DataFrame, record_tag: str = "REC") -> DataFrame:
    """What a run needs to know about every fragment, without the record texts.

    Only fragments that cannot become a record keep their text.  Staged, this is the one pass
    over the input that ids, hashes, cut-off tails, failures and counts are all taken from.
    """
    return fragments.select(
        "source_file", "file_size", "pos", "uid",
        F.when(F.col("uid").isNotNull(), sha256_hex("xml")).alias("record_hash"),
        "n_bytes",
        (F.col("xml").isNotNull() | F.col("value").rlike(rf"<{_PREFIX}{_name(record_tag)}[\s>]")).alias("starts"),
        F.when(F.col("uid").isNull(), F.col("xml")).alias("xml"),
        _hollow(record_tag).alias("hollow"),
        _open_after(F.col("value")).alias("open"),
    )


def _hollow(record_tag: str) -> Column:
    """Empty record elements in a fragment (NULL where there can be none)."""
    pattern = rf"<{_PREFIX}{_name(record_tag)}(?:\s[^<>]*)?/>"
    found = F.regexp_extract_all(without_comments(F.col("value")), F.lit(pattern), F.lit(0))
    return F.when(F.contains("value", F.lit("/>")), found)


def truncated_tails(scan: DataFrame, record_tag: str = "REC") -> DataFrame:
    """Unterminated last fragments that hold a record start: the file was cut off.

    One aggregate per file with partial sums.  A file whose bytes add up to its size with a
    separator after every fragment ends on a record; one separator less means an open tail.
    ``scan`` is a :func:`light_scan` or the fragments themselves.
    """
    light = scan if "starts" in scan.columns else light_scan(scan, record_tag)
    per_file = light.groupBy("source_file").agg(
        F.sum("n_bytes").alias("with_separators"),
        F.max("file_size").alias("file_size"),
        F.max(F.struct("pos", "starts", "uid", "record_hash")).alias("last"),
    )
    return per_file.where((F.col("with_separators") > F.col("file_size")) & F.col("last.starts")).select(
        "source_file", "last.pos", "last.uid", "last.record_hash"
    )


def split_failures(
    fragments: DataFrame, record_tag: str = "REC", id_tag: str = "UID", tails: DataFrame | None = None,
    scan: DataFrame | None = None,
) -> DataFrame:
    """What could not become a record: no id, cut off, or an empty record element.

    With a staged ``scan`` the input is not read again, except for the text of cut-off
    records, which are found by file, id and hash.
    """
    light = light_scan(fragments, record_tag) if scan is None else scan
    no_id = F.lit(f"Could not extract ID from record (tag: {id_tag})")
    off = F.lit(CUT_OFF)
    value_error, syntax = F.lit("ValueError").alias("error_type"), F.lit("XMLSyntaxError").alias("error_type")
    parts = []
    lost = light.where("pos >= 0 and xml is not null")
    if tails is not None:
        nameless = tails.where("uid is null").select("source_file", "pos")
        cut = lost.join(nameless, ["source_file", "pos"], "left_semi")
        lost = lost.join(nameless, ["source_file", "pos"], "left_anti")
        parts.append(cut.select("uid", "xml", off.alias("error"), syntax, "source_file"))
        named = tails.where("uid is not null").select("source_file", "uid", "record_hash")
        texts = split_records(fragments).join(named, ["source_file", "uid", "record_hash"], "left_semi")
        parts.append(texts.select("uid", "xml", off.alias("error"), syntax, "source_file"))
    parts.append(lost.select("uid", "xml", no_id.alias("error"), value_error, "source_file"))
    hollow = light.where("pos >= 0 and hollow is not null")
    parts.append(hollow.select("uid", F.explode("hollow").alias("xml"), no_id.alias("error"), value_error, "source_file")
                 .withColumn("uid", F.lit(None).cast("string")))
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("uid", "record_id")


def latest_record(records: DataFrame) -> DataFrame:
    """One version per id within a run: the last by file and position.

    An aggregate with partial results, so an id that holds a third of all records is reduced
    before the shuffle.
    """
    rest = [c for c in records.columns if c != "uid"]
    best = F.max_by(F.struct(*rest), F.struct("source_file", "pos"))
    return records.groupBy("uid").agg(best.alias("b")).select("uid", *[F.col("b").getField(c).alias(c) for c in rest])


def gated_records(fragments: DataFrame, container: str, record_tag: str = "REC") -> DataFrame:
    """Records whose ancestors are exactly ``container`` (a path such as ``export/records``)."""
    return split_records(fragments.join(inside(fragments, container, record_tag), ["source_file", "pos"], "left_semi"))


def inside(fragments: DataFrame, container: str, record_tag: str = "REC") -> DataFrame:
    """``source_file, pos`` of the fragments whose record has exactly these ancestors.

    The path at a record is the running sum of the tags between records.  It is computed as
    a prefix scan over those tags, without any record text: within a split by windows (a split is bounded by ``maxPartitionBytes``),
    across the splits of a file on one small row per split.
    """
    levels = container.split("/")
    name = _name(record_tag)
    value = without_comments(F.col("value"))
    gap = F.regexp_extract(value, rf"(?s)^(.*?)(?:<{_PREFIX}{name}[\s>]|\z)", 1)
    outer = F.regexp_replace(gap, r"(?s)<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^>]*>", "")
    tags = F.regexp_extract_all(outer, F.lit(r"<(/?[\w:.-]+)(?:\s[^<>]*)?(?<!/)>"), F.lit(1))
    light = staged(fragments.select("source_file", "block", "pos", tags.alias("tags")), "gate-tags")

    split = Window.partitionBy("source_file", "block").orderBy("pos", "at")
    until = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # most fragments have no tags before their record: only those that have take part in the windows over tags
    events = light.where(F.size("tags") > 0).select("source_file", "block", "pos", F.posexplode("tags").alias("at", "t")).select(
        "source_file", "block", "pos", "at",
        F.when(F.startswith("t", F.lit("/")), -1).otherwise(1).alias("step"), F.regexp_replace("t", r"^/?(?:.*:)?", "").alias("tag"),
    )
    nets = light.groupBy("source_file", "block").agg(
        F.sum(F.aggregate("tags", F.lit(0), lambda n, t: n + F.when(F.startswith(t, F.lit("/")), -1).otherwise(1))).alias("net")
    )
    depth_before = nets.select("source_file", "block", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("start"))
    depth = F.col("start") + F.sum("step").over(until)
    placed = events.join(depth_before, ["source_file", "block"]).withColumn("depth", depth)

    def opened(level):  # the name opened at this depth, at the tag itself
        return F.when((F.col("step") == 1) & (F.col("depth") == level), F.col("tag"))

    numbers = range(1, len(levels) + 1)
    # after its last tag, each fragment with tags has a depth and the names opened last in its split
    named = placed.withColumns({f"n{i}": F.last(opened(i), ignorenulls=True).over(until) for i in numbers})
    at_record = named.groupBy("source_file", "block", "pos").agg(
        F.max_by("depth", "at").alias("depth"), *[F.max_by(f"n{i}", "at").alias(f"n{i}") for i in numbers]
    )
    last = at_record.groupBy("source_file", "block").agg(*[F.max_by(f"n{i}", "pos").alias(f"n{i}") for i in numbers])
    carried = depth_before.join(last, ["source_file", "block"], "left").select(
        "source_file", "block", "start", *[F.last(f"n{i}", ignorenulls=True).over(earlier).alias(f"p{i}") for i in numbers]
    )
    # fragments without tags stand where the one before stands
    before = Window.partitionBy("source_file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = light.select("source_file", "block", "pos").join(at_record, ["source_file", "block", "pos"], "left")
    here = marked.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in ["depth", *[f"n{i}" for i in numbers]]})
    here = here.join(carried, ["source_file", "block"])
    found = F.coalesce("depth", "start") == len(levels)
    for i, wanted in zip(numbers, levels):
        found = found & (F.coalesce(f"n{i}", f"p{i}") == wanted)
    return here.where(found).select("source_file", "pos")
