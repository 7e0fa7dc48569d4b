import pytest
from pyspark.sql import functions as F

from treeflat import Field
from treeflat.functions import coerce as co, text as tx
from treeflat.operators import deadletter, validate


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("text,want", [("5", 5), (" 5\n", 5), ("+5", 5), ("-5", -5), ("1_000", 1000), ("1.0", None), ("", None),
                                       ("_1", None), ("1__0", None), ("abc", None), ("99999999999999999999", None), (None, None)])
def test_integer(spark, text, want):
    assert one(spark, text, co.to_integer) == want


@pytest.mark.parametrize("text,want", [("1", 1.0), (" 1.5 ", 1.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1_0.5", 10.5), ("inf", float("inf")),
                                       ("1.0d", None), ("1,5", None), ("", None), ("0x1", None)])
def test_float(spark, text, want):
    assert one(spark, text, co.to_float) == want


@pytest.mark.parametrize("text,want", [("Yes", True), ("t", True), ("1", True), ("NO", False), ("0", False), (" true", None), ("maybe", None)])
def test_boolean(spark, text, want):
    assert one(spark, text, co.to_boolean) is want


def test_dates_pass_unless_strict(spark):
    assert one(spark, "soon", lambda c: co.coerce(c, "DATE")) == "soon"
    assert one(spark, "soon", lambda c: co.coerce(c, "DATE", True)) is None
    assert one(spark, "2024-02-30", lambda c: co.coerce(c, "DATE", True)) is None
    assert one(spark, "2024-02-29", lambda c: co.coerce(c, "DATE", True)) == "2024-02-29"
    assert one(spark, "2024-02-29T10:00:00Z", lambda c: co.coerce(c, "TIMESTAMP", True)) == "2024-02-29T10:00:00Z"


@pytest.mark.parametrize("text,want", [
    ("1, 'a', 2", ["1", "'a'", "2"]), ("'a,b',c", ["'a,b'", "c"]), ("'it''s', \"x,'y\"", ["'it''s'", "\"x,'y\""]),
    ("a,,b", ["a", "", "b"]), (",a", ["", "a"]), ("a,", ["a"]), ("'open, x", ["'open, x"]), ("'x'y, 'z'", ["'x'y", "'z'"]),
])
def test_quoted_split(spark, text, want):
    assert one(spark, text, tx.split_quoted) == want


def test_quoted_split_of_long_text(spark):
    text = "'" + "a,''b\n" * 40_000 + "', 2"
    assert one(spark, text, lambda c: F.size(tx.split_quoted(c))) == 2


def test_literals_round_trip(spark):
    for text in ["it's", "a\\b", "\\'", "''", "", "x;\ny"]:
        assert one(spark, text, lambda c: tx.sql_unliteral(tx.sql_literal(c))) == text
    assert one(spark, None, tx.sql_literal) == "NULL"


def test_error_fingerprint_and_prefix(spark):
    import hashlib

    got = spark.range(1).select(
        tx.error_fingerprint(F.lit(None).cast("string"), F.lit("boom")).alias("h"), tx.id_prefix(F.lit("x" * 30)).alias("p"),
        tx.id_prefix(F.lit(None).cast("string")).alias("e"), tx.file_safe(F.lit("WOS:é 1/2-_")).alias("s"),
        tx.strip_space(F.lit("\t a \n")).alias("t")).first()
    assert got.h == hashlib.md5(b"unknown:boom").hexdigest()
    assert (got.p, got.e, got.s, got.t) == ("x" * 20, "", "WOS_é_1_2-_", "a")


CONTRACT = [Field("id", "STRING", "REQUIRED"), Field("n", "INTEGER"), Field("f", "NUMERIC"), Field("must", "STRING", "REQUIRED")]


def test_validation_names_the_first_failing_field(spark, collect):
    df = spark.createDataFrame(
        [("a", "1", "2.5", "x", "e"), (None, "q", "1", None, "e"), ("c", "1.5", "z", "x", "e"), ("d", None, "z", "x", "e"), ("e", None, None, None, "e")],
        "id string, n string, f string, must string, extra string")
    assert collect(validate.valid_rows(df, CONTRACT)) == [("a", 1, 2.5, "x")]
    errors = [r[0] for r in collect(validate.refused_rows(df, CONTRACT, "t"), "error")]
    assert sorted(errors) == sorted([
        "Required field missing: id",
        "Type coercion failed for n: 1.5 -> INTEGER: invalid literal for int() with base 10: '1.5'",
        "Type coercion failed for f: z -> NUMERIC: could not convert string to float: 'z'",
        "Required field missing: must",
    ])


def test_projection_is_case_sensitive(spark):
    df = spark.createDataFrame([("1", "2")], "ID string, n string")
    assert validate.project(df, CONTRACT).columns == ["id", "n", "f", "must"]
    assert validate.project(df, CONTRACT).first().id is None


def test_dead_letters_partition_and_fallback(spark, tmp_path, collect):
    df = spark.createDataFrame([("r/1", "boom", "ValueError"), (None, None, None)], "record_id string, error string, error_type string")
    got = deadletter.enriched(deadletter.unified([df], "Step"), "2024-02-03 04:05:06")
    parts = collect(deadletter.with_partition(got), "year", "month", "day", "record_id_prefix", "pipeline_step")
    assert parts == [("2024", "02", "03", "", "Step"), ("2024", "02", "03", "r/1", "Step")]
    odd = deadletter.with_partition(got.withColumn("timestamp", F.lit("not a time")))
    assert {r.year for r in odd.collect()} == {"unknown"}
    deadletter.write_jsonl(got, str(tmp_path / "j"))
    assert deadletter.read_letters(spark, str(tmp_path / "j")).count() == 2
