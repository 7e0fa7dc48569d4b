import random

import pytest

from brute import shred as brute_shred
from treeflat import Mapping
from treeflat.operators import nodes, shred

MAPPING = """<records><REC table="doc" prio="doc:prio:low"><UID/>
 <meta><n>doc:n</n><k a="doc:ka:dflt"/></meta>
 <ws count="doc:cnt"><w table="word" ctr_id="word:wid" t="word:t">word:text</w></ws>
 <g><it table="item" ctr_id="item:iid" x="item:x"><name>item:name</name><hoist>doc:h</hoist>
   <sub table="sub" ctr_id="sub:sid">sub:v<deep table="deep" ctr_id="deep:did" z="deep:z"/></sub></it></g>
 <a><l table="la" ctr_id="la:lid">la:v</l></a><b><l table="lb" ctr_id="lb:lid">lb:v</l></b>
</REC></records>"""


@pytest.fixture(scope="module")
def mapping():
    return Mapping.from_xml(MAPPING)


def frame(spark, *xml):
    return spark.createDataFrame([(f"u{i}", x, i) for i, x in enumerate(xml)], "uid string, xml string, pos long")


def table(df):
    return sorted([{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()], key=str)


def compare(spark, mapping, *xml, paths=("auto", "nodes")):
    want: dict = {}
    for i, x in enumerate(xml):
        for name, made in brute_shred(x, f"u{i}", mapping).items():
            want.setdefault(name, []).extend(made)
    for name in mapping.tables():
        for path in paths:
            got = table(shred.shred_table(frame(spark, *xml), mapping, name, path=path))
            assert got == sorted(want.get(name, []), key=str), (name, path)


def test_keys_counters_and_values(spark, mapping):
    compare(
        spark, mapping,
        '<REC prio="hi"><meta><n>5</n><k/></meta><ws count="2"><w t="q">a &lt; b</w><w/></ws>'
        '<g><it x="1"><name>n</name><sub>s1</sub><sub>s2</sub></it></g><g/><g><it><sub>s3</sub></it><it x="3"/></g></REC>',
        "<REC/>",
    )


def test_empty_wrapper_loses_nothing(spark, mapping):
    compare(spark, mapping, "<REC><g/><g><it/></g><g></g><g><it/><it/></g></REC>")


def test_repeated_scalar_keeps_the_last_with_text(spark, mapping):
    compare(spark, mapping, "<REC><meta><n>1</n><n>2</n><n/></meta><meta><n></n></meta></REC>")


def test_hoisted_column_climbs_to_the_root(spark, mapping):
    compare(spark, mapping, "<REC><g><it><hoist>H1</hoist></it><it><hoist>H2</hoist></it></g></REC>")


def test_shared_counter_follows_the_document(spark, mapping):
    compare(spark, mapping, "<REC><b><l>b1</l></b><a><l>a1</l><l>a2</l></a><b><l>b2</l></b></REC>")
    assert [[e.table for e in g] for g in mapping.shared_groups()] == [["la", "lb"]]
    plan = shred.native_table(frame(spark, "<REC/>"), mapping, "la")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_only_leading_text_counts(spark, mapping):
    compare(
        spark, mapping,
        "<REC><ws><w>pre<i>in</i>post</w><w><i>x</i>post</w><w>plain</w><w t='1'>a<i/></w></ws></REC>",
        "<REC><ws><w>\n <i>x</i></w></ws></REC>",
    )


def test_white_space_is_text(spark, mapping):
    compare(spark, mapping, "<REC><ws><w>  </w><w t='1'>  </w><w>\n</w></ws><meta><n> </n></meta></REC>")


def test_cdata(spark, mapping):
    compare(spark, mapping, "<REC><ws><w><![CDATA[a <b> & c]]></w><w>x<![CDATA[y]]>z</w><w t='1'>x<![CDATA[<i>]]>z</w>"
                            "<w><![CDATA[x]]><i>q</i>z</w></ws></REC>")


def test_attributes_empty_absent_and_prefixed(spark, mapping):
    compare(spark, mapping, '<REC xmlns:p="urn:p"><ws><w t="">x</w><w>y</w></ws></REC>')
    got = table(shred.shred_table(frame(spark, '<REC><ws><w p:t="no">x</w></ws></REC>'), mapping, "word"))
    assert got == [{"id": "u0", "wid": 1, "text": "x"}]


def test_prefixed_tags_lose_their_prefix(spark, mapping):
    for path in ("auto", "nodes"):
        got = table(shred.shred_table(frame(spark, '<q:REC><q:ws q:n="1"><q:w t="1">x</q:w></q:ws></q:REC>'), mapping, "word", path=path))
        assert got == [{"id": "u0", "wid": 1, "t": "1", "text": "x"}]


def test_malformed_record_costs_only_itself(spark, mapping):
    df = frame(spark, "<REC><ws><w>1</w></ws></REC>", "<REC><ws><w>un</ws></REC>", "<REC><ws><w>3</w></ws></REC>", "<REC>&nbsp;</REC>")
    for path in ("auto", "nodes"):
        assert [r["id"] for r in table(shred.shred_table(df, mapping, "word", path=path))] == ["u0", "u2"]
    assert sorted((r.uid, r.error_type) for r in shred.malformed(df, mapping).collect()) == [
        ("u1", "XMLSyntaxError"), ("u3", "XMLSyntaxError")]


def test_processing_instruction_fails_the_record(spark, mapping):
    df = frame(spark, "<REC><ws><?pi x?><w>1</w></ws></REC>", "<REC><ws><w>2</w></ws></REC>")
    assert [r["id"] for r in table(shred.shred_table(df, mapping, "word"))] == ["u1"]
    assert [r.uid for r in nodes.walk_failures(df, mapping).collect()] == ["u0"]


def test_missing_counter_loses_the_whole_record(spark):
    m = Mapping.from_xml('<records><REC table="doc"><UID/><x table="x">x:v</x><y table="y" ctr_id="y:n">y:v</y></REC></records>')
    df = frame(spark, "<REC><y>1</y></REC>", "<REC><y>1</y><x>2</x></REC>")
    for path in ("native", "nodes"):
        assert [r["id"] for r in table(shred.shred_table(df, m, "y", path=path))] == ["u0"]
    assert [(r.uid, r.error_type) for r in shred.malformed(df, m).collect()] == [("u1", "KeyError")]


def test_two_sources_of_one_column_take_the_last_in_document_order(spark):
    m = Mapping.from_xml('<records><REC table="doc"><UID/><p>doc:v</p><q v="doc:v">doc:v</q></REC></records>')
    assert m.needs_document_order("doc")
    compare(spark, m, "<REC><q v='1'/><p>2</p></REC>", "<REC><p>2</p><q v='1'>3</q></REC>", "<REC><p>2</p><q v='1'/></REC>",
            paths=("auto",))


def test_same_table_opened_at_two_places(spark):
    m = Mapping.from_xml('<records><REC table="doc"><UID/><p><e table="mail" ctr_id="mail:n">mail:v</e></p>'
                         '<q><e table="mail" ctr_id="mail:n" k="mail:k">mail:v</e></q></REC></records>')
    compare(spark, m, "<REC><q><e k='1'>a</e></q><p><e>b</e><e>c</e></p></REC>", paths=("auto",))


def test_copies_of_an_id_stay_separate(spark, mapping):
    df = spark.createDataFrame(
        [("same", "<REC><b><l>1</l></b><a><l>2</l></a></REC>", "f", i) for i in range(50)], "uid string, xml string, source_file string, pos long")
    got = shred.shred_table(df, mapping, "la").collect()
    assert len(got) == 50 and {r.lid for r in got} == {2}


def test_random_documents_agree_on_both_paths(spark, mapping):
    rnd = random.Random(7)

    def some(e, depth=0):
        inner = ""
        if e.text is not None and rnd.random() < 0.7:
            inner += rnd.choice(["t", " ", "a &amp; b", "x&lt;y", "é", ""]) + (str(rnd.randint(0, 9)) if rnd.random() < 0.7 else "")
        kids = list(e.children.values())
        rnd.shuffle(kids)
        for c in kids:
            for _ in range(rnd.choice([0, 1, 1, 2])):
                inner += some(c, depth + 1) + rnd.choice(["", "\n "])
        if not e.children and e.name not in ("UID",) and rnd.random() < 0.15:
            inner += "<zz>u</zz>tail"
        attrs = "".join(f' {a}="{rnd.randint(0, 9)}"' for a in e.attrs if rnd.random() < 0.6)
        return f"<{e.name}{attrs}>{inner}</{e.name}>" if inner or rnd.random() < 0.5 else f"<{e.name}{attrs}/>"

    compare(spark, mapping, *[some(mapping.record) for _ in range(120)])


def test_one_parse_per_record_and_no_shuffle(spark, mapping):
    df = shred.native_table(frame(spark, "<REC/>").repartition(2), mapping, "sub")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1
    assert plan.count("Exchange") == 1  # the repartition of the input


def test_general_path_uses_no_exchange(spark, mapping):
    for table in ("la", "sub"):
        plan = nodes.node_table(frame(spark, "<REC/>"), mapping, table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
        assert "Exchange" not in shred.shred_table(frame(spark, "<REC/>"), mapping, table)._jdf.queryExecution().executedPlan().toString()


def test_shared_counters_stay_in_the_jvm(spark, mapping):
    """Order comes from the parser's own elements; look-alikes in CDATA, prefixes, attributes and empty elements do not disturb it."""
    plan = shred.native_table(frame(spark, "<REC/>"), mapping, "la")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Exchange" not in plan
    wide = Mapping.from_xml(
        """<records><REC table="doc"><UID/><a><l table="la" ctr_id="la:lid" t="la:t">la:v</l></a>
        <b><m table="lb" ctr_id="lb:lid">lb:v</m></b><x><l>doc:other</l></x><y>doc:y</y></REC></records>"""
    )
    assert [sorted(e.table for e in g) for g in wide.shared_groups()] == [["la", "lb"]]
    compare(
        spark, wide,
        "<REC><b><m>1</m><m/></b><a><l t='q'>2</l></a><b><m>3</m></b></REC>",
        "<REC><y><![CDATA[<l><m>]]></y><a><l><![CDATA[<m>]]></l><l>&lt;l></l></a><x><l>no</l></x><b><n:m xmlns:n='u'>z</n:m></b><a/><a><l\nt='1'/></a></REC>",
        "<REC><a><l>only</l><l>these</l></a></REC>", "<REC><x><l>other</l></x></REC>", "<REC/>",
    )
    many = "".join(f"<a><l>{i}</l></a>" if i % 3 else f"<b><m>{i}</m></b>" for i in range(500))
    compare(spark, wide, f"<REC>{many}</REC>")


def test_names_are_told_apart_by_case(spark, mapping):
    compare(spark, mapping, '<REC><WS><w>no</w></WS><ws><W t="1">X</W><w T="2">y</w><w t="3">z</w></ws><ws COUNT="4"/></REC>')
    twins = Mapping.from_xml('<records><REC table="doc"><UID/><w>doc:a</w><W>doc:b</W></REC></records>')
    compare(spark, twins, "<REC><W>1</W><w>2</w></REC>", "<REC><w>3</w></REC>", paths=("auto",))


def test_records_are_read_once(spark, mapping, tmp_path):
    """Both paths share one reading of the text; a name in another spelling is found however far its sign of equality is."""
    from treeflat.sources.records import read_records

    (tmp_path / "a.xml").write_text("<records><REC><UID>1</UID><ws><w t='1'>x</w></ws></REC><REC><UID>2</UID><ws><w t='1'>x<i/></w><w>y</w></ws></REC></records>")
    got = shred.shred_table(read_records(spark, str(tmp_path)), mapping, "word")
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    assert sorted((r.id, r.wid, r.text) for r in got.collect()) == [("1", 1, "x"), ("2", 1, "x"), ("2", 2, "y")]
    for gap in ("", " " * 9, " " * 10, "\n" * 40):
        compare(spark, mapping, f"<REC><ws><w T{gap}=\"1\" t{gap}={gap}'2'>a = 'b' T= \"c\"</w><w p:t{gap}='3'>z</w></ws></REC>".replace("<REC>", '<REC xmlns:p="u">'))


def test_texts_of_a_batch_are_walked_a_few_at_a_time():
    """What a task of the node walk holds does not grow with the records that come in one batch."""
    import pyarrow as pa

    texts = ["<REC>" + "x" * 1_500_000 + "</REC>"] * 9
    batch = pa.RecordBatch.from_pydict({"uid": [str(i) for i in range(9)], "xml": texts})
    out = list(nodes._exploded(lambda xml: [(xml,)], ["uid"], [pa.string()], ["text"])([batch]))
    assert [b.num_rows for b in out] == [3, 3, 3]
    assert [u for b in out for u in b.column(0).to_pylist()] == [str(i) for i in range(9)]
