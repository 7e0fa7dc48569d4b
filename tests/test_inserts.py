import random

import pytest

from treeflat import Mapping
from treeflat.sinks import tables as sinks
from treeflat.sources import inserts


def brute(text):
    """The statements of a script, read one character at a time."""
    out, current, quote = [], "", None
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        done = False
        for ch in line:
            if ch in "'\"":
                quote = None if quote == ch else (quote or ch)
            current += ch
            if ch == ";" and quote is None:
                done = True
                break
        if done:
            out.append(current)
            current = ""
        else:
            current += " "
    return out


@pytest.mark.parametrize("split", [200, 1 << 27])
def test_statements_match_a_sequential_reading(spark, tmp_path, split):
    rnd = random.Random(3)
    bits = ["INSERT INTO t (a) VALUES (", "'x;\ny'", "\"it's;\"", ");", "\n", " ", "'''", "trailing", ";", "'a''b'", "\n\n  ", "--"]
    texts = {f"s{n}": "".join(rnd.choice(bits) for _ in range(300)) for n in range(4)}
    texts["open"] = "INSERT INTO t (a) VALUES (1);\nINSERT INTO t (a) VALUES ('never closed;\n" + "more;\n" * 200
    for name, text in texts.items():
        (tmp_path / f"{name}.sql").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = inserts.read_statements(spark, str(tmp_path)).orderBy("source_file", "stmt").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in texts.items():
        assert [r.statement for r in got if r.source_file.endswith(f"/{name}.sql")] == brute(text), name


def test_rows_are_aligned_and_mismatches_flagged(spark, tmp_path, collect):
    (tmp_path / "a.sql").write_text(
        "INSERT INTO t (id, a, b) VALUES ('1', 'x, ''y''', 3);\nINSERT INTO t (id, a, b) VALUES ('2', 'only');\n"
        "INSERT INTO t (id, a, a) VALUES ('3', 'first', 'last');\nBEGIN;\nINSERT INTO u (id) VALUES (NULL);\n")
    parsed = inserts.parse_statements(inserts.read_statements(spark, str(tmp_path)))
    assert collect(inserts.rows_for(parsed, "t", ["id", "a", "b", "c"])) == [
        ("1", "x, 'y'", "3", None), ("2", "only", None, None), ("3", "last", None, None)]
    assert collect(parsed, "table_name", "mismatch") == [("t", False), ("t", False), ("t", True), ("u", False)]
    assert collect(inserts.rows_for(parsed, "u", ["id"])) == [(None,)]


def test_script_puts_parents_first(spark, tmp_path):
    m = Mapping.from_xml('<records><REC table="doc"><UID/><w table="word" ctr_id="word:wid">word:v</w></REC></records>')
    doc = spark.createDataFrame([("b",), ("a",)], "id string")
    word = spark.createDataFrame([("a", 2, "it's"), ("a", 1, None), ("b", 1, "x;y")], "id string, wid long, v string")
    sinks.write_script(sinks.insert_script({"word": word, "doc": doc}, m), str(tmp_path / "s"), "/* $id */ $data")
    lines = [r.value for r in spark.read.text(str(tmp_path / "s")).collect()]
    want = [
        "/* a */ INSERT INTO doc (id) VALUES ('a');",
        "/* a */ INSERT INTO word (id, wid) VALUES ('a', 1);",
        "/* a */ INSERT INTO word (id, wid, v) VALUES ('a', 2, 'it''s');",
        "/* b */ INSERT INTO doc (id) VALUES ('b');",
        "/* b */ INSERT INTO word (id, wid, v) VALUES ('b', 1, 'x;y');",
    ]
    assert sorted(lines) == sorted(want)


def test_csv_pads_in_contract_order(spark, tmp_path):
    df = spark.createDataFrame([("1", None, "x")], "id string, b string, gone string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "c"), ["b", "id", "c"])
    sinks.write_csv(df, str(tmp_path / "c"), ["b", "id", "c"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("*.csv")))
    assert text == "b,id,c\n,1,\n" * 2


def test_statements_are_read_by_their_form_without_matching_them_whole(spark, capsys):
    import re

    rnd = random.Random(7)
    bits = ["INSERT INTO t (a) VALUES (", "INSERT INTO ", "t", " (", "a", "`b`", '"c"', ") VALUES (", "'it''s'", "1", ");", ",", " "]
    texts = ["INSERT INTO " + "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 8))) + rnd.choice([");", ";"]) for _ in range(3000)]
    texts += ["INSERT INTO t (a) VALUES ();", "INSERT INTO t () VALUES (1);", "INSERT INTO  (a) VALUES (1);", "INSERT INTO é (ü) VALUES ('ß', 2);"]
    rows = spark.createDataFrame(list(enumerate(texts)), "stmt long, statement string")
    parsed = inserts.parse_statements(rows)
    got = {r.stmt: (r.table_name, len(r.cols)) for r in parsed.collect()}
    form = re.compile(r"(?s)^INSERT INTO (.+?) \((.+?)\) VALUES \((.+)\);$")
    found = {i: form.match(t) for i, t in enumerate(texts)}
    assert got.keys() == {i for i, m in found.items() if m} and len(got) > 50
    for i, (name, columns) in got.items():
        assert columns == len(found[i][2].split(","))
        if "`" not in found[i][1] and '"' not in found[i][1]:
            assert name == found[i][1]
    capsys.readouterr()
    inserts.rows_for(parsed, "t", ["a", "b"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("regexp_extract_all") == 1  # the values are searched once
    assert "(.+?)" not in plan
    assert plan.count("upper(") == plan.count("upper(substring(") > 0  # no whole value is made upper case
