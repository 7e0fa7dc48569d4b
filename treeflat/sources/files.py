"""Files as data: discovery, fingerprints, file numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILE_REGISTRY_SCHEMA = "file_path string, file_md5 string, processed_at timestamp, record_count bigint"
#: Of the fingerprints: products of two numbers below the prime fit into 64 bits.
_PRIME = 2**31 - 1
_POINTS = (1_103_527_590, 1_664_013_907, 747_796_405, 1_911_520_717)


def discover(spark: SparkSession, path, glob: str = "*.xml", recursive: bool = False) -> DataFrame:
    """Matching files with size and time; the contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return found.select(F.col("path").alias("file_path"), "length", "modificationTime").orderBy("file_path")


def plain_path(path: Column) -> Column:
    """A path as it is written, from the URL-encoded form of ``_metadata.file_path``."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def as_pattern(path: str) -> str:
    """The path for a reader that takes paths as patterns: its own special characters escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def listed(spark: SparkSession, path, glob: str = "*.xml", recursive: bool = False) -> DataFrame:
    """``file_path, length, modified`` of the matching files; the contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return found.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def fingerprints(spark: SparkSession, path, glob: str = "*.xml", recursive: bool = False) -> DataFrame:
    """``file_path, file_md5`` for every file, by one rule for all sizes.

    The text is read in pieces that end at ``>``, so large files are split and no task holds a
    file.  The hashes of a split's pieces, in their order, are the coefficients of four polynomials at fixed points modulo a
    prime; a file's value follows from those of its splits and is the same however it is split.  The fingerprint is the Base64
    of the MD5 of length, number of pieces and values: equal contents have equal fingerprints, and pieces that
    differ or stand at another place (values swapped between records, records in another order) give another one.
    """
    return profiled(spark, path, glob, recursive).select("file_path", "file_md5")


def profiled(spark: SparkSession, path, glob: str = "*.xml", recursive: bool = False, record_tag: str = "REC") -> DataFrame:
    """``file_path, length, modified, file_md5, charset, closing``: what one scan in pieces tells about every file.

    ``charset`` is that of a UTF-16 byte order mark (the text source takes off that of UTF-8), else the one that the XML declaration names, else UTF-8.  ``closing`` is the spelling of the closing record
    tag that the file has most of (NULL where it has none, and in UTF-16).  The scan stays in the JVM: the
    pieces' polynomials, see :func:`fingerprints`, are sums of products with powers that four table lookups give.
    """
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).option("lineSep", ">").text(path)
    data = F.col("value").cast("binary")
    start, head = F.col("_metadata.file_block_start"), F.hex(F.substring(data, 1, 2))
    opening = F.startswith("value", F.lit("<?xml")) | head.isin("FFFE", "FEFF", "3C00", "003C")
    name = record_tag.replace(".", r"\.")
    closes = F.contains("value", F.lit(record_tag)) & F.rlike("value", F.lit(rf"</(?:[^\s<>:/]+:)?{name}\s*$"))
    h, g = F.xxhash64("value"), F.xxhash64("value", F.lit(1))
    halves = [half for x in (h, g) for half in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    pieces = text.select(
        F.col("_metadata.file_path").alias("path"), start.alias("start"),
        F.when((start == 0) & opening, F.hex(F.substring(data, 1, 400))).alias("prolog"),
        F.when(closes, F.concat(F.regexp_extract("value", rf"</(?:[^\s<>:/]+:)?{name}\s*$", 0), F.lit(">"))).alias("closing"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"),
        *[(half % _PRIME).alias(f"h{k}") for k, half in enumerate(halves)],
    )
    # with powers of the inverse point the sum needs no piece's distance from the end
    terms = [F.col(f"h{k}") * _inverse_power(k, F.col("i")) % _PRIME for k in range(len(_POINTS))]
    marks = pieces.groupBy("path", "start", "prolog", "closing").agg(
        F.count(F.lit(1)).alias("n"), F.min("i").alias("first"), *[F.sum(t).alias(f"s{k}") for k, t in enumerate(terms)]
    )
    own = F.struct("first", F.col("prolog").alias("text"))
    closing = F.struct("closing", "n")
    splits = marks.groupBy("path", "start").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.min(F.when(F.col("prolog").isNotNull(), own)).alias("own"),
        F.collect_list(F.when(F.col("closing").isNotNull(), closing)).alias("closings"),
        *[(F.sum(F.col(f"s{k}") % _PRIME) % _PRIME).alias(f"s{k}") for k in range(len(_POINTS))],
    )
    last, count = F.col("first") + F.col("n") - 1, F.col("n")
    value = F.array(*[F.col(f"s{k}") * _power(point, last) % _PRIME for k, point in enumerate(_POINTS)])
    shift = F.array(*[_power(point, count) for point in _POINTS])
    prolog = F.when(F.col("own.first") == F.col("first"), F.col("own.text")).alias("prolog")
    splits = splits.select("path", "start", "n", prolog, "closings", value.alias("value"), shift.alias("shift"))
    # one small row per split of a file
    ordered = splits.groupBy("path").agg(
        F.sum("n").alias("n"), F.max("prolog").alias("prolog"), F.flatten(F.collect_list("closings")).alias("closings"),
        F.sort_array(F.collect_list(F.struct("start", "value", "shift"))).alias("splits"),
    )

    def follow(before: Column, split: Column) -> Column:
        moved = F.zip_with(before, split["shift"], lambda x, w: x * w % _PRIME)
        return F.zip_with(moved, split["value"], lambda x, y: (x + y) % _PRIME)

    total = F.aggregate("splits", F.array(*[F.lit(0).cast("bigint") for _ in _POINTS]), follow)
    values = ordered.select(
        plain_path(F.col("path")).alias("file_path"), "n", F.array_join(total.cast("array<string>"), ":").alias("value"), _charset(F.col("prolog")).alias("charset"), _most(F.col("closings")).alias("closing")
    )
    numbers = F.concat_ws(":", "length", "n", "value")
    return listed(spark, path, glob, recursive).join(values, "file_path", "left").select(
        "file_path", "length", "modified", F.base64(F.unhex(F.md5(numbers.cast("binary")))).alias("file_md5"), F.coalesce("charset", F.lit("UTF-8")).alias("charset"), "closing"
    )


def _inverse_power(k: int, exponent: Column) -> Column:
    """The inverse of a point to a power below 2^32: a table lookup per byte of the exponent."""
    inverse = pow(_POINTS[k], -1, _PRIME)
    out = None
    for byte in range(4):
        table = F.expr("array(" + ", ".join(f"{pow(inverse, j << 8 * byte, _PRIME)}L" for j in range(256)) + ")")
        entry = F.get(table, F.shiftrightunsigned(exponent, 8 * byte).bitwiseAND(F.lit(255)).cast("int"))
        out = entry if out is None else out * entry % _PRIME
    return out


def _power(point: int, exponent: Column) -> Column:
    """For one small row per split: the product over the exponent's bits."""
    squares = F.expr("array(" + ", ".join(f"{pow(point, 1 << bit, _PRIME)}L" for bit in range(40)) + ")")
    bits = F.zip_with(squares, F.sequence(F.lit(0), F.lit(39)), lambda w, bit: F.when(F.getbit(exponent, bit) == 1, w).otherwise(F.lit(1).cast("bigint")))
    return F.aggregate(bits, F.lit(1).cast("bigint"), lambda x, w: x * w % _PRIME)


def _charset(prolog: Column) -> Column:
    """From the hexadecimal bytes up to the first ``>``."""
    declared = F.regexp_extract(F.decode(F.unhex(prolog), "ISO-8859-1"), r"""^<\?xml\s[^>]*?encoding\s*=\s*["']([A-Za-z][A-Za-z0-9._-]*)["']""", 1)
    return (
        F.when(prolog.startswith("FFFE0000") | prolog.startswith("0000FEFF"), "UTF-32")
        .when(prolog.startswith("FFFE") | prolog.startswith("3C00"), "UTF-16LE")
        .when(prolog.startswith("FEFF") | prolog.startswith("003C"), "UTF-16BE")
        .when(declared == "", "UTF-8")
        .otherwise(F.upper(declared))
    )


def _most(closings: Column) -> Column:
    """The most frequent of (closing, n); of equally frequent ones the first by name."""
    names = F.array_sort(F.array_distinct(F.transform(closings, lambda c: c["closing"])))
    counted = F.transform(names, lambda name: F.struct(F.aggregate(closings, F.lit(0).cast("bigint"), lambda s, c: s + F.when(c["closing"] == name, c["n"]).otherwise(0)).alias("n"), name.alias("closing")))
    most = F.aggregate(counted, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("closing")), lambda best, c: F.when(c["n"] > best["n"], c).otherwise(best))
    return most["closing"]


def record_fingerprints(records: DataFrame) -> DataFrame:
    h = F.xxhash64("record_hash")
    sums = records.groupBy(F.col("source_file").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")
    )
    text = F.concat_ws(":", "n", F.col("s").cast("string"), F.col("x").cast("string"))
    return sums.select("file_path", F.base64(F.unhex(F.md5(text.cast("binary")))).alias("file_md5"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def with_file_number(rows: DataFrame, numbers: DataFrame, path_column: str = "source_file") -> DataFrame:
    """Add ``file_number`` by base name; unknown files get -1.

    ``numbers`` has ``file_name, file_number`` and one row per file, which is far smaller
    than the records; Catalyst broadcasts it below its size threshold.
    """
    lookup = numbers.groupBy("file_name").agg(F.max("file_number").alias("file_number"))
    named = rows.withColumn("#name", base_name(F.col(path_column)))
    joined = named.join(lookup, F.col("#name") == F.col("file_name"), "left")
    return joined.select(*rows.columns, F.coalesce(F.col("file_number").cast("bigint"), F.lit(-1)).alias("file_number"))


def read_file_numbers(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return spark.read.schema("file_name string, file_number bigint").option("header", header).csv(path)
