"""Mappings and contracts of the example corpora."""

from __future__ import annotations

from treeflat import Contracts, Mapping


def _fields(*names: str, required: tuple = ("id",), integers: tuple = ()):
    return [
        {"name": n, "type": "INTEGER" if n in integers else "STRING",
         "mode": "REQUIRED" if n in required else "NULLABLE", "description": ""}
        for n in names
    ]


LINES = Mapping.from_xml(
    """<records>
  <REC table="doc" file_number="doc:file_number" lang="doc:lang:xx">
    <UID/>
    <meta><source>doc:source</source><n>doc:n_chars</n></meta>
    <body count="doc:line_count">
      <line table="line" ctr_id="line:line_id" w="line:width:-">line:text</line>
    </body>
  </REC>
</records>""",
    "records/REC",
)

LINES_CONTRACTS = Contracts.from_dict(
    {
        "doc": _fields("id", "file_number", "lang", "source", "n_chars", "line_count", integers=("file_number", "n_chars")),
        "line": _fields("id", "line_id", "width", "text", required=("id", "line_id"), integers=("line_id",)),
    }
)

PARAS = Mapping.from_xml(
    """<records><REC table="doc"><UID/><body>
  <para table="para" ctr_id="para:para_id" no="para:no"><s table="sentence" ctr_id="sentence:sentence_id">sentence:text</s></para>
</body></REC></records>"""
)

#: Paragraphs are plain wrappers here: sentences are counted through all of them.
FLAT_PARAS = Mapping.from_xml(
    """<records><REC table="doc"><UID/><body>
  <para><s table="sentence" ctr_id="sentence:sentence_id">sentence:text</s></para>
</body></REC></records>"""
)

LISTS = Mapping.from_xml(
    """<records><REC table="doc"><UID/>
  <short><l table="short_line" ctr_id="short_line:line_id">short_line:text</l></short>
  <long><l table="long_line" ctr_id="long_line:line_id">long_line:text</l></long>
  <mix><a table="a_item" ctr_id="a_item:item_id">a_item:text</a><b table="b_item" ctr_id="b_item:item_id">b_item:text</b></mix>
</REC></records>"""
)

MIXED = Mapping.from_xml(
    """<records><REC table="doc"><UID/><p table="para" ctr_id="para:para_id">para:lead</p></REC></records>"""
)

#: ``top`` climbs from the part row into the root row; ``size`` names a table that is never open.
NOISY = Mapping.from_xml(
    """<records><REC table="doc"><UID/>
  <state><cur>doc:current</cur></state>
  <raw>doc:raw</raw>
  <part table="part_row" ctr_id="part_row:part_id" kind="part_row:kind"><size>nowhere:size</size><top>doc:last_part</top></part>
  <extra><deep>doc:undeclared</deep></extra>
</REC></records>"""
)

NOISY_CONTRACTS = Contracts.from_dict(
    {"doc": _fields("id", "current", "last_part"), "part_row": _fields("id", "part_id", "kind", integers=("part_id",))}
)

BROKEN = Mapping.from_xml(
    """<records><REC table="doc"><UID/><lang>doc:lang</lang><text>doc:text</text></REC></records>"""
)

BROKEN_CONTRACTS = Contracts.from_dict({"doc": _fields("id", "lang", "text")})
