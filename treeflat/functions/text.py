"""Scalar text functions as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_space(col) -> Column:
    """Trim every kind of white space at both ends (``trim`` alone removes blanks only)."""
    return F.regexp_replace(F.regexp_replace(col, r"^\s+", ""), r"\s+$", "")


def blank_to_null(col) -> Column:
    return F.nullif(col, F.lit(""))


def sha256_hex(col) -> Column:
    """64 lower-case hex digits over the UTF-8 bytes."""
    return F.sha2(F.col(col) if isinstance(col, str) else col, 256)


def error_fingerprint(error_type: Column, error: Column) -> Column:
    """MD5 of ``type:message``; an absent type counts as ``unknown``, an absent message as empty."""
    return F.md5(F.concat(F.coalesce(error_type, F.lit("unknown")), F.lit(":"), F.coalesce(error, F.lit(""))))


def id_prefix(col: Column) -> Column:
    return F.coalesce(F.substring(col, 1, 20), F.lit(""))


def file_safe(col) -> Column:
    """Everything but letters, digits, ``-`` and ``_`` becomes ``_``."""
    return F.regexp_replace(col, r"[^\p{L}\p{N}_-]", "_")


def sql_literal(col: Column) -> Column:
    """Quoted SQL text: quotes and back slashes doubled; NULL stays the word NULL."""
    body = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.coalesce(F.concat(F.lit("'"), body, F.lit("'")), F.lit("NULL"))


def sql_unliteral(col: Column) -> Column:
    """The text behind a quoted SQL literal; the bare word NULL becomes NULL."""
    marked = col.startswith("'")  # long texts are not made upper case: five characters tell
    # a line end may follow the last quote; that is rare, so only then the whole text is matched
    inner = F.when(col.endswith("'"), F.substring(col, F.lit(2), F.char_length(col) - 2)).otherwise(F.regexp_extract(col, r"(?s)^'(.*)'$", 1))
    plain = F.replace(F.replace(inner, F.lit("''"), F.lit("'")), F.lit("\\\\"), F.lit("\\"))
    whole = marked & (F.char_length(col) > 1) & (col.endswith("'") | col.rlike(r"(?s)^'.*'$"))
    return F.when(F.upper(F.substring(col, 1, 5)) == "NULL", F.lit(None)).when(whole, plain).otherwise(col)


def split_quoted(col: Column) -> Column:
    """Split at commas outside single or double quotes; the parts are trimmed.

    Whole quoted and plain stretches are matched possessively, so long texts need one pass
    and no look-ahead.  An empty part after the last comma is not a value.
    """
    part = r"""(?s),((?:'[^']*+'?+|"[^"]*+"?+|[^,'"]++)*+)"""
    parts = F.regexp_extract_all(F.concat(F.lit(","), col), F.lit(part), F.lit(1))
    # The parts are used several times: as the one element of an array they are worked out once.
    used = F.transform(F.array(parts), lambda p: F.when(F.try_element_at(p, F.lit(-1)) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))
    return F.transform(F.get(used, F.lit(0)), lambda p: F.trim(p))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_iso(col: Column) -> Column:
    """ISO-8601 text (``Z`` accepted) to a timestamp; NULL if it cannot be read."""
    return F.try_to_timestamp(col)


def target_parts(col: Column) -> Column:
    """``table:column[:default]`` to a struct of its parts."""
    bits = F.split(col, ":", 3)
    return F.struct(
        F.try_element_at(bits, F.lit(1)).alias("table"),
        F.try_element_at(bits, F.lit(2)).alias("column"),
        F.try_element_at(bits, F.lit(3)).alias("default"),
    )


def first_at(xml: Column, path: str) -> Column:
    """Text of the first node an XPath selects (well-formed input)."""
    return F.xpath_string(xml, F.lit(path))


def first_descendant(xml: Column, name: str) -> Column:
    """Text of the first descendant of that local name, in any namespace."""
    return F.xpath_string(xml, F.lit(f"//*[local-name()='{name}']"))
