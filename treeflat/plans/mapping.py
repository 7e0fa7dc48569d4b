"""The mapping: which element opens a row of which table, and where values go.

A mapping is written as a skeleton of the document.  ``table`` opens a row, ``ctr_id``
names its counter, ``file_number`` receives the run's file number, every other attribute
and the element text name a target ``table:column`` (attributes may add ``:default``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession, types as T


MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("attr", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("target_col", T.StringType()),
        T.StructField("default", T.StringType()),
        T.StructField("open", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Target:
    table: str
    column: str
    default: str | None = None


@dataclass(eq=False)
class Element:
    """One element of the skeleton."""

    name: str
    path: str
    parent: "Element | None"
    table: str | None = None
    counter: str | None = None
    file_number: Target | None = None
    text: Target | None = None
    attrs: dict[str, Target] = field(default_factory=dict)
    children: dict[str, "Element"] = field(default_factory=dict)

    def walk(self):
        yield self
        for child in self.children.values():
            yield from child.walk()

    def opener(self, table: str) -> "Element | None":
        """The outermost open element of that table at this place."""
        found, here = None, self
        while here is not None:
            if here.table == table:
                found = here
            here = here.parent
        return found

    def parent_row(self) -> "Element | None":
        """The nearest ancestor that opens a row."""
        here = self.parent
        while here is not None and here.table is None:
            here = here.parent
        return here

    def below(self, ancestor: "Element") -> list[str]:
        """Element names from (not including) ``ancestor`` down to this element."""
        names, here = [], self
        while here is not ancestor:
            names.append(here.name)
            here = here.parent
        return names[::-1]


@dataclass(frozen=True)
class Write:
    """A value that goes into a column of an opened row."""

    column: str
    source: Element
    attr: str | None  # None: the element's text
    default: str | None


def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _has_case_twin(element: Element) -> bool:
    """Whether a name on the way to the element, or an attribute of it, has a twin in other case."""
    lowered = [a.lower() for a in element.attrs]
    if len(set(lowered)) < len(lowered):
        return True
    here = element
    while here.parent is not None:
        if sum(n.lower() == here.name.lower() for n in here.parent.children) > 1:
            return True
        here = here.parent
    return False


class Mapping:
    def __init__(self, root: Element, record: Element):
        self.root, self.record = root, record

    # ---- loading ---------------------------------------------------------------

    @classmethod
    def from_xml(cls, text: str, record_path: str | None = None) -> "Mapping":
        """Read a mapping document.

        ``record_path`` is the path of the record element (container and record tag);
        by default the first element that opens a table.
        """

        def build(node, parent) -> Element:
            name = _local(node.tag)
            here = Element(name, f"{parent.path}/{name}" if parent else name, parent)
            for key, value in node.attrib.items():
                bits = value.split(":")
                if key == "table":
                    here.table = value
                elif key == "ctr_id":
                    here.counter = bits[1] if len(bits) > 1 else bits[0]
                elif key == "file_number":
                    here.file_number = Target(bits[0], bits[1])
                else:
                    here.attrs[key] = Target(bits[0], bits[1], bits[2] if len(bits) == 3 else None)
            if (node.text or "").strip():
                table, column = node.text.strip().split(":", 1)
                here.text = Target(table, column)
            for child in node:
                made = build(child, here)
                here.children[made.name] = made
            return here

        root = build(ET.fromstring(text), None)
        everything = list(root.walk())
        if record_path is None:
            record = next((e for e in everything if e.table), None)
        else:
            record = next((e for e in everything if e.path == record_path), None)
        if record is None or record.table is None:
            raise ValueError(f"Core table not found in config: {record_path or root.path}/table")
        return cls(root, record)

    @classmethod
    def load(cls, spark: SparkSession, path: str, record_path: str | None = None) -> "Mapping":
        """Read the mapping file from any file system Spark can read."""
        row = spark.read.text(path, wholetext=True).first()
        return cls.from_xml(row[0], record_path)

    # ---- shape -----------------------------------------------------------------

    @property
    def root_table(self) -> str:
        return self.record.table

    def openings(self, table: str | None = None) -> list[Element]:
        return [e for e in self.record.walk() if e.table and (table is None or e.table == table)]

    def tables(self) -> list[str]:
        return list(dict.fromkeys(e.table for e in self.openings()))

    def chain(self, opening: Element) -> list[Element]:
        """Row-opening elements from the record (first) to ``opening`` (last)."""
        out, here = [], opening
        while here is not None:
            out.append(here)
            here = here.parent_row()
        return out[::-1]

    def keys(self, opening: Element) -> list[str]:
        return ["id"] + [e.counter for e in self.chain(opening)[1:]]

    def sharing(self, opening: Element) -> list[Element]:
        """All openings that draw from the same counter of the same parent row."""
        parent = opening.parent_row()
        return [e for e in self.openings() if e.parent_row() is parent and e.counter == opening.counter]

    def writes(self, opening: Element) -> list[Write]:
        """Everything at or below ``opening`` that writes into the row it opens."""
        out = []
        for e in opening.walk():
            for attr, t in e.attrs.items():
                if e.opener(t.table) is opening:
                    out.append(Write(t.column, e, attr, t.default))
            if e.text and e.opener(e.text.table) is opening:
                out.append(Write(e.text.column, e, None, None))
        return out

    def columns(self, table: str) -> list[str]:
        """Key and value columns of a table, keys first, in mapping order."""
        names: list[str] = []
        for opening in self.openings(table):
            names += self.keys(opening)
        if self.record.file_number and self.record.file_number.table == table:
            names.append(self.record.file_number.column)
        for opening in self.openings(table):
            names += [w.column for w in self.writes(opening)]
        return list(dict.fromkeys(names))

    # ---- what depends on document order --------------------------------------------

    def shared_groups(self) -> list[list[Element]]:
        """Differently placed openings of the record's row that draw from one counter."""
        groups: list[list[Element]] = []
        for e in self.openings():
            if e.parent_row() is self.record and not any(e in g for g in groups):
                members = self.sharing(e)
                if len(members) > 1 and e.counter:
                    groups.append(members)
        return groups

    def needs_document_order(self, table: str) -> bool:
        """True if a whole table has to be assembled from nodes in document order.

        That is: a column with several sources, a mapped text that holds mapped elements, a
        counter shared below the record's own row (see :meth:`shared_groups` for the rest), or
        siblings whose names differ only by case.
        """
        for opening in self.openings(table):
            if any(_has_case_twin(e) for e in [opening, *(w.source for w in self.writes(opening))]):
                return True
            if any(len(self.sharing(e)) > 1 for e in self.chain(opening)[2:]):
                return True
            writes = self.writes(opening)
            if len({w.column for w in writes}) < len(writes):
                return True
            if any(w.attr is None and w.source.children for w in writes):
                return True
        return False

    # ---- as data ---------------------------------------------------------------

    def entries(self) -> list[tuple]:
        out = []
        for e in self.record.walk():
            if e.table:
                out.append((e.path, "table", None, e.table, None, None, True))
                if e.counter:
                    out.append((e.path, "ctr", None, e.table, e.counter, None, True))
            if e.file_number:
                t = e.file_number
                out.append((e.path, "file_number", None, t.table, t.column, None, e.opener(t.table) is not None))
            for attr, t in e.attrs.items():
                out.append((e.path, "attr", attr, t.table, t.column, t.default, e.opener(t.table) is not None))
            if e.text:
                out.append((e.path, "text", None, e.text.table, e.text.column, None, e.opener(e.text.table) is not None))
        return out

    def dataframe(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries(), MAPPING_SCHEMA)

    def lineage(self, spark: SparkSession) -> DataFrame:
        """Distinct, sorted parent -> child edges between tables."""
        edges = [(e.parent_row().table, e.table) for e in self.openings() if e.parent_row() is not None]
        schema = "parent_table string, child_table string"
        return spark.createDataFrame(edges, schema).distinct().orderBy("parent_table", "child_table")

    def lint(self, spark: SparkSession, contracts) -> DataFrame:
        """Everything the mapping promises and the tables would silently lose."""
        found = []
        for e in self.record.walk():
            if e is not self.record and e.table and not e.counter:
                found.append((e.path, e.table, None, "counter missing"))
            if e.table and e.table not in contracts:
                found.append((e.path, e.table, None, "table without contract"))
        for path, kind, attr, table, column, _, is_open in self.entries():
            if kind not in ("attr", "text", "file_number"):
                continue
            if not is_open:
                found.append((path, table, column, "target table not open"))
            elif table in contracts and column not in contracts.names(table):
                found.append((path, table, column, "column not in contract"))
        return spark.createDataFrame(found, "path string, target_table string, target_col string, finding string")
