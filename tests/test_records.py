import hashlib
import re

import pytest
from pyspark.sql import functions as F

from treeflat.sources import files, records as R


def rec(uid, body="<v>1</v>"):
    return f"<REC><UID>{uid}</UID>{body}</REC>"


def test_triples_and_hash(spark, xml_dir, collect):
    text = "<records>\n" + rec("A") + "\n" + rec("B") + "\n</records>\n"
    got = collect(R.read_records(spark, xml_dir(a=text)), "uid", "xml", "record_hash")
    assert got == [(u, rec(u), hashlib.sha256(rec(u).encode()).hexdigest()) for u in "AB"]


def test_id_rules(spark, xml_dir, collect):
    text = "<r>" + "".join([
        "<REC><UID> \n spaced\t</UID></REC>",
        '<REC a="1"><x/><UID q="1">late</UID></REC>',
        "<REC><x><UID>deep</UID></x></REC>",
        "<REC><x><n:UID>prefixed</n:UID></x></REC>",
        "<REC><n:UID>p2</n:UID></REC>",
        "<REC><x><UID>inner</UID></x><UID>own</UID></REC>",
        "<REC><UID>a &amp; b</UID></REC>",
        "<REC><UID></UID></REC>",
        "<REC><v>none</v></REC>",
        "<REC/>",
        "<REC><UID>last</UID></REC>",
    ]) + "</r>"
    path = xml_dir(a=text)
    fragments = R.read_fragments(spark, path)
    got = [r[0] for r in collect(R.split_records(fragments), "uid")]
    assert got == sorted(["spaced", "late", "deep", "prefixed", "p2", "own", "a & b", "last"])
    lost = R.split_failures(fragments, tails=R.truncated_tails(fragments)).collect()
    assert len(lost) == 3 and {r.error for r in lost} == {"Could not extract ID from record (tag: UID)"}


def test_other_id_tag_and_record_tag_as_id(spark, xml_dir, collect):
    path = xml_dir(a="<r><item><key>k1</key></item><item><key>k2</key><UID>no</UID></item></r>")
    assert collect(R.read_records(spark, path, "item", "key"), "uid") == [("k1",), ("k2",)]
    assert collect(R.read_records(spark, path, "key", "key"), "uid") == [("k1",), ("k2",)]


def test_comments_do_not_change_the_hash(spark, xml_dir, collect):
    a = xml_dir(a="<r><!-- <REC> -->" + rec("A", "<v>1<!-- x -->2</v>") + "</r>", b="<r>" + rec("A", "<v>12</v>") + "</r>")
    assert len(set(collect(R.read_records(spark, a), "record_hash"))) == 1
    kept = xml_dir(c="<r>" + rec("C", "<v><![CDATA[<!-- stays -->]]></v>") + "</r>")
    assert "<!-- stays -->" in R.read_records(spark, kept).where("uid = 'C'").first().xml


def test_splits_inside_a_file_lose_nothing(spark, xml_dir):
    path = xml_dir(a="<records>" + "\n".join(rec(i, "<v>" + "é" * (i % 50) + "</v>") for i in range(3000)) + "</records>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = R.read_records(spark, path)
        assert df.rdd.getNumPartitions() > 10
        assert sorted(int(r.uid) for r in df.collect()) == list(range(3000))
        order = [int(r.uid) for r in df.orderBy("pos").collect()]
        assert order == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("tail,cut", [("</records>\n", 0), ("", 0), ("\n<REC><UID>cut</UID><v>1</v>", 1), ("<REC><UID>c", 1)])
def test_truncated_tail(spark, xml_dir, collect, tail, cut):
    fragments = R.read_fragments(spark, xml_dir(a="<records>" + rec("A") + rec("B") + tail))
    tails = R.truncated_tails(fragments)
    assert tails.count() == cut
    assert collect(R.split_records(fragments, tails), "uid") == [("A",), ("B",)]
    assert R.split_failures(fragments, tails=tails).count() == cut


def test_every_legal_closing_tag_ends_a_record(spark, xml_dir, collect):
    text = "<r xmlns:x='u'>" + rec("1") + "<REC><UID>2</UID></REC ><REC>\n<UID>3</UID></REC\n>" + "<x:REC a='1'><UID>4</UID></x:REC>" + rec("5")
    text += "<x:REC/><x:RECORD/><REC><v>x:REC</v><UID>6</UID></REC >"
    for tail, cut in [("</r>", 0), ("", 0), ("<x:REC><UID>7</UID>", 1)]:
        fragments = R.read_fragments(spark, xml_dir(a=text + tail))
        tails = R.truncated_tails(fragments)
        got = collect(R.split_records(fragments, tails), "uid", "xml")
        assert [u for u, _ in got] == list("123456")
        assert dict(got)["4"] == "<REC a='1'><UID>4</UID></REC>" and dict(got)["2"] == "<REC><UID>2</UID></REC>"
        assert tails.count() == cut
        assert R.split_failures(fragments, tails=tails).count() == cut + 1  # the empty record element


def test_only_prefixed_records(spark, xml_dir, collect):
    path = xml_dir(a="<x:r xmlns:x='u'>" + "".join(f"<x:REC><x:UID>{i}</x:UID></x:REC>\n" for i in range(50)) + "</x:r>")
    assert R.read_records(spark, path).count() == 50
    assert sorted(r.uid for r in R.read_records(spark, path, "x:REC").collect()) == sorted(map(str, range(50)))


def test_encoding(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(("<r>" + rec("caf\u00e9") + "<REC><UID>b\u00e9</UID></REC ></r>").encode("latin-1"))
    fragments = R.read_fragments(spark, str(tmp_path), encoding="ISO-8859-1")
    assert sorted(r.uid for r in R.split_records(fragments).collect()) == ["b\u00e9", "caf\u00e9"]
    assert R.truncated_tails(fragments).count() == 0


def test_fallback_id_is_decoded_and_not_from_cdata(spark, xml_dir, collect):
    path = xml_dir(a="<r><REC><x><t><![CDATA[<UID>fake</UID>]]></t><UID>A &amp; B</UID></x></REC></r>")
    assert collect(R.read_records(spark, path), "uid") == [("A & B",)]


def test_gate_across_splits(spark, xml_dir, collect):
    parts, want = ["<export>"], {"export/records": [], "export/drafts/old": [], "export/drafts": []}
    for i in range(400):
        box = ["export/records", "export/drafts/old", "export/drafts"][(i // 7) % 3]
        names = box.split("/")[1:]
        if i % 7 == 0:
            parts.append("<!-- <records> -->" + "".join(f'<{n} k="a/b">' for n in names) + "<empty/>")
        parts.append(rec(i))
        want[box].append(str(i))
        if i % 7 == 6 or i == 399:
            parts.append("".join(f"</{n}>" for n in reversed(names)))
    parts.append("</export>")
    path = xml_dir(a="".join(parts), b="<export><records>" + rec("other") + "</records></export>")
    want["export/records"].append("other")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        fragments = R.read_fragments(spark, path)
        for box, ids in want.items():
            assert [r[0] for r in collect(R.gated_records(fragments, box), "uid")] == sorted(ids), box
        assert R.gated_records(fragments, "export").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_latest_record_of_a_hot_id(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"), F.lit("x").alias("xml"),
        F.col("id").cast("string").alias("record_hash"), F.lit("f").alias("source_file"), F.col("id").alias("pos"))
    got = R.latest_record(df)
    assert got.count() == 5000 - 1667 + 1
    assert got.where("uid = 'hot'").first().pos == 4998


def test_recursive_glob(spark, tmp_path, collect):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.xml").write_text("<r>" + rec("A") + "</r>")
    (tmp_path / "sub" / "b.xml").write_text("<r>" + rec("B") + "</r>")
    (tmp_path / "sub" / "c.txt").write_text("<r>" + rec("C") + "</r>")
    assert collect(R.read_records(spark, str(tmp_path), recursive=True, glob="*.xml"), "uid") == [("A",), ("B",)]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


HIDDEN = ["<c><![CDATA[ </REC> ]]></c>", "<!-- </REC><REC> -->", "<c><![CDATA[<!-- </REC> ]]></c>", "<!-- <![CDATA[ </x:REC> --><v/>", "<c><![CDATA[]]]]><![CDATA[> </REC >]]></c>", "<v>]]&gt; --&gt;</v>", "", "",
          "<c><![CDATA[" + " </REC> x" * 60 + "]]></c>", "<!--" + "</x:REC>\n" * 40 + "-->"]


def test_closing_tags_in_cdata_and_comments(spark, xml_dir, collect, small_splits):
    """Against the same records read one by one: chains inside a split, over one border and over several."""
    bodies = [HIDDEN[(i * 7 + i // 10) % len(HIDDEN)] + f"<v>{'é' * (i % 40)}</v>" for i in range(400)]
    inner = ["<!-- </REC> between -->" if i % 11 == 0 else "\n" for i in range(400)]
    path = xml_dir(a="<r>" + "".join(g + rec(i, b) for i, (g, b) in enumerate(zip(inner, bodies))) + "</r>", b="<r>" + "".join(rec(f"b{i}") for i in range(50)) + "</r>")
    fragments = R.read_fragments(spark, path)
    whole = R.mended(fragments)
    got = dict(collect(R.split_records(whole), "uid", "xml"))
    import re

    plain = lambda x: re.sub(r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", lambda m: m[1] or "", x)
    want = {str(i): plain(rec(i, b)) for i, b in enumerate(bodies)} | {f"b{i}": rec(f"b{i}") for i in range(50)}
    assert got == want
    assert R.split_failures(whole).count() == 0 and R.truncated_tails(whole).count() == 0
    untouched = R.read_fragments(spark, f"{path}/b.xml")
    assert R.mended(untouched) is untouched


@pytest.mark.parametrize("opening", ["<![CDATA[", "<!--"])
def test_what_never_closes_costs_its_record_only(spark, xml_dir, collect, small_splits, opening):
    text = "<r>" + rec(1, "<c><![CDATA[</REC>]]></c>") + rec(2, opening) + "".join(rec(i) for i in range(3, 200)) + "</r>"
    got = [u for (u,) in collect(R.split_records(R.mended(R.read_fragments(spark, xml_dir(a=text)))), "uid")]
    assert set(map(str, [1, *range(3, 200)])) <= set(got) and len(got) == len(set(got))


def test_files_by_their_own_encoding_and_closing_tag(spark, tmp_path, small_splits):
    head = '<?xml version="1.0" encoding="{}"?>\n<r>'
    sample = {"utf-8": "日é", "iso-8859-1": "é", "iso-8859-15": "€é", "windows-1251": "Жé".replace("é", "ы"), "shift_jis": "日本ソ", "gb18030": "中é", "euc-kr": "한"}
    want = {}

    def write(name, encoding, letter, declared, bom=b"", closing="</REC>", text_head=head):
        recs = "".join(f"<{closing[2:-1].strip()}><UID>{name}{i}{letter}</UID><v>{letter * (i % 30)}</v>{closing}" for i in range(60))
        (tmp_path / f"{name}.xml").write_bytes(bom + (text_head.format(declared) + recs + "</r>").encode(encoding))
        want.update({f"{name}{i}{letter}": f"<REC><UID>{name}{i}{letter}</UID><v>{letter * (i % 30)}</v></REC>" for i in range(60)})

    for k, (encoding, letter) in enumerate(sample.items()):
        write(f"f{k}", encoding, letter, encoding.upper())
    write("le", "utf-16-le", "日é", "UTF-16", b"\xff\xfe")
    write("be", "utf-16-be", "日é", "UTF-16", b"\xfe\xff")
    write("bom", "utf-8", "日", "utf-8", b"\xef\xbb\xbf")
    write("bare", "utf-8", "é", "", text_head="<r>")
    write("pre", "utf-8", "é", "utf-8", closing="</x:REC>")
    write("gap", "utf-8", "é", "utf-8", closing="</REC >")
    assert {r.uid: r.xml for r in R.read_any(spark, str(tmp_path)).collect()} == want
    profile = {r.file_path.rsplit("/")[-1]: r for r in files.profiled(spark, str(tmp_path)).collect()}
    assert profile["pre.xml"].closing == "</x:REC>" and profile["gap.xml"].closing == "</REC >" and profile["le.xml"].closing is None
    fragments, refused = R.read_profiled(spark, files.profiled(spark, str(tmp_path), "pre.xml"))
    assert fragments.rdd.getNumPartitions() > 2 and refused.count() == 0 and R.truncated_tails(fragments).count() == 0
    assert R.split_records(fragments).where("uid is not null").count() == 60


def test_unknown_encoding(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0" encoding="x-none"?><r>' + rec(1) + "</r>")
    (tmp_path / "b.xml").write_text("<r>" + rec(2) + "</r>")
    fragments, refused = R.read_profiled(spark, files.profiled(spark, str(tmp_path)))
    assert [r.uid for r in R.split_records(fragments).collect()] == ["2"]
    assert [(r.source_file.rsplit("/")[-1], r.error) for r in refused.collect()] == [("a.xml", "unknown encoding X-NONE")]
    with pytest.raises(ValueError, match="X-NONE"):
        R.read_any(spark, str(tmp_path))


def test_lines_are_cut_once(spark, xml_dir):
    """No filter cuts every line a second time, and fragments that are a record are not searched for its beginning."""
    fragments = R.read_fragments(spark, xml_dir(a="<r>" + rec("1") + "</r>")).select("pos", "value", "xml")
    plan = fragments._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and re.search(r"CASE WHEN #whole#\d+ THEN concat\(#lead", plan)


def test_record_text_by_its_beginning(spark):
    """The record of a fragment is the same whether it is taken as it is or searched for by pattern."""
    fragments = {
        "<REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "\r\n\t <REC a='1'><UID>1</UID> x ": "<REC a='1'><UID>1</UID> x </REC>",
        "\x0b\f<REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "<REC\n><UID>1</UID>": "<REC\n><UID>1</UID></REC>",
        "<x:REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "<records>\n<REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "<!-- <REC> --><REC><!-- c --><UID>1</UID>": "<REC><UID>1</UID></REC>",
        " <REC/> <REC a='1'/><REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "<REC ><UID>1</UID><REC>": "<REC ><UID>1</UID><REC></REC>",
        "<RECORD><REC><UID>1</UID>": "<REC><UID>1</UID></REC>",
        "<RECORD><UID>1</UID>": None,
        " \n": None,
        "": None,
        "<REC": None,
    }
    raw = spark.createDataFrame([(v, "f", 9, 0) for v in fragments], "value string, source_file string, file_size long, block long")
    got = {r.value: r.xml for r in R.cut_fragments(raw).select("value", "xml").collect()}
    assert got == fragments
    pieces = [("a</x:REC>b</REC >", "f", 9, 0)]  # spelled otherwise: cut here, and counted as the line's
    cut = R.cut_fragments(spark.createDataFrame(pieces, raw.schema)).orderBy("pos").collect()
    assert [(r.value, r.ending, r.n_bytes) for r in cut] == [("a", "</x:REC>", 17), ("b", "</REC >", 0)]


def test_clean_drops_what_xml_cannot_hold(spark):
    from catalog import corpora as C

    texts = ["", "plain\tand\n\r", "a\x00b\x0b\x0c\x0e\x1f\x08c", "\ufffe\uffff\ufffd\ud7ff\ue000", "\U0001f600\U0010ffff\u0085\x7f", "\x1f" * 3, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [tuple(r) for r in df.select(C.clean("text"), C.clean(F.col("text")), F.regexp_replace("text", C.FORBIDDEN, "")).collect()]
    assert all(a == b == c for a, b, c in got)
    assert [a for a, _, _ in got] == ["", "plain\tand\n\r", "abc", "\ufffd\ud7ff\ue000", "\U0001f600\U0010ffff\u0085\x7f", "", None]
