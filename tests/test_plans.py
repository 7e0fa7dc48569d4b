import json

import pytest

from treeflat import Contracts, Mapping
from treeflat.plans.mapping import Target

TEXT = """<config><summary table="t_sum" file_number="t_sum:fn" a="t_sum:ca:none"><title table="t_title" ctr_id="odd_name:title_id" lang="t_title:lang">t_title:title</title>
<text>t_sum:body</text><lost x="t_titel:x"/></summary></config>"""


def test_mapping_entries():
    m = Mapping.from_xml(TEXT)
    assert m.root_table == "t_sum" and m.tables() == ["t_sum", "t_title"]
    assert m.record.attrs["a"] == Target("t_sum", "ca", "none")
    title = m.openings("t_title")[0]
    assert title.counter == "title_id" and title.path == "config/summary/title"
    assert m.keys(title) == ["id", "title_id"]
    assert m.columns("t_sum") == ["id", "fn", "ca", "body"]


def test_mapping_without_root_table_is_an_error():
    with pytest.raises(ValueError, match="Core table not found"):
        Mapping.from_xml(TEXT, "config/nowhere")


def test_namespaces_are_stripped_from_mappings():
    m = Mapping.from_xml('<c xmlns="urn:x"><r table="t"><v>t:v</v></r></c>')
    assert m.record.path == "c/r" and m.columns("t") == ["id", "v"]


def test_lint_and_lineage(spark, collect):
    contracts = Contracts.from_dict({"t_sum": [{"name": "id"}, {"name": "ca"}, {"name": "fn"}]})
    found = collect(Mapping.from_xml(TEXT).lint(spark, contracts), "path", "finding")
    assert found == [
        ("config/summary/lost", "target table not open"),
        ("config/summary/text", "column not in contract"),
        ("config/summary/title", "table without contract"),
    ]
    assert collect(Mapping.from_xml(TEXT).lineage(spark)) == [("t_sum", "t_title")]


def test_contracts_load_both_layouts(spark, tmp_path):
    fields = [{"name": "id", "type": "STRING", "mode": "REQUIRED", "description": "key"}, {"name": "n", "type": "INTEGER", "mode": "NULLABLE"}]
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "t_sum_schema.json").write_text(json.dumps(fields))
    (tmp_path / "all.json").write_text(json.dumps({"t_sum": fields, "t_x": fields}))
    assert list(Contracts.load(spark, str(tmp_path / "one"))) == ["t_sum"]
    both = Contracts.load(spark, str(tmp_path / "all.json")).augmented("t_sum")
    assert both.names("t_sum") == ["id", "n", "ingestion_ts", "record_hash"] and both.names("t_x") == ["id", "n", "ingestion_ts"]
    struct = both.struct("t_sum")
    assert [f.dataType.simpleString() for f in struct] == ["string", "bigint", "string", "string"]
    assert not struct["id"].nullable and struct["n"].nullable and struct["id"].metadata["description"] == "key"
    again = Contracts.from_struct({"t_sum": struct})
    assert [(f.name, f.type, f.mode) for f in again["t_sum"]][:2] == [("id", "STRING", "REQUIRED"), ("n", "INTEGER", "NULLABLE")]


def test_mapping_load_from_file(spark, tmp_path):
    (tmp_path / "m.xml").write_text(TEXT)
    assert Mapping.load(spark, str(tmp_path / "m.xml")).tables() == ["t_sum", "t_title"]
