"""The general path: elements in document order.

Used where the order between differently named elements matters (columns
fed from several places) or text stands next to child elements.  A small Python walker reads
a record's nodes; numbering, key inheritance and assembly go over them once, within the
record, so nothing is shuffled.  The nodes themselves are available as rows, too.
"""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from treeflat.plans.mapping import Element, Mapping
from treeflat.session import BROADCAST_ROWS, ship_with_tasks

ship_with_tasks(__name__)

NODE_COLUMNS = "seq int, parent_seq int, path string, text string, attrs map<string,string>, error string"
#: Rows, and characters of the texts they come from, that a task holds before it hands them on.
_FLUSH, _FLUSH_TEXT = 20_000, 4_000_000


def _local(name: str) -> str:
    return name.rsplit(":", 1)[-1]


def _walk(xml: str, root_path: str, wanted: frozenset | None):
    """Nodes of one record in document order: [seq, parent_seq, path, leading text, attributes]."""
    found, stack = [], []  # stack entries: [seq, path, texts or None, node or None]
    count = 0

    def start(name, attrs):
        nonlocal count
        count += 1
        path = f"{stack[-1][1]}/{_local(name)}" if stack else root_path
        parent = stack[-1][0] if stack else None
        if stack:
            close_text(stack[-1])
        node = None
        if wanted is None or path in wanted:
            own = [(k, v) for k, v in attrs.items() if k != "xmlns" and not k.startswith("xmlns:")]
            node = [count, parent, path, None, own]
            found.append(node)
        stack.append([count, path, [], node])

    def close_text(entry):
        if entry[2] is not None:
            if entry[3] is not None and entry[2]:
                entry[3][3] = "".join(entry[2])
            entry[2] = None

    def text(data):
        if stack and stack[-1][2] is not None:
            stack[-1][2].append(data)

    def end(_):
        close_text(stack.pop())

    def instruction(*_):
        raise ValueError("processing instruction inside a record")

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = text
    parser.ProcessingInstructionHandler = instruction
    parser.Parse(xml.encode("utf-8", "surrogatepass"), True)
    return found


def walk_records(records: DataFrame, root_path: str, wanted: list[str] | None = None) -> DataFrame:
    """One row per element.  Columns of ``records`` other than ``xml`` are carried along.

    A record that cannot be read yields a single row with ``error`` set and no path.
    """
    keep = [c for c in records.columns if c != "xml"]
    kept_types = {f.name: f.dataType.simpleString() for f in records.schema.fields}
    schema = ", ".join([f"`{c}` {kept_types[c]}" for c in keep] + [NODE_COLUMNS])
    chosen = frozenset(wanted) if wanted is not None else None
    node_types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
    node_names = ["seq", "parent_seq", "path", "text", "attrs", "error"]

    def made_of(xml: str):
        try:
            return [(*n, None) for n in _walk(xml, root_path, chosen)]
        except (expat.ExpatError, ValueError, TypeError, AttributeError) as e:
            return [(None, None, None, None, None, str(e))]

    return records.select(*keep, "xml").mapInArrow(_exploded(made_of, keep, node_types, node_names), schema)


def cells(nodes: DataFrame, mapping: Mapping) -> DataFrame:
    """Every mapped value as one row, by joining nodes with the mapping on the path.

    The mapping is broadcast up to ``BROADCAST_ROWS`` entries; a larger one is joined by a shuffle.
    """
    m = mapping.dataframe(nodes.sparkSession).where(F.col("kind").isin("attr", "text") & F.col("open"))
    joined = nodes.join(F.broadcast(m) if m.count() <= BROADCAST_ROWS else m, "path")
    value = F.when(F.col("kind") == "text", F.nullif("text", F.lit(""))).otherwise(
        F.coalesce(F.try_element_at("attrs", F.col("attr")), F.col("default"))
    )
    keep = [c for c in nodes.columns if c not in ("text", "attrs", "error", "path", "parent_seq")]
    return joined.select(*keep, "path", "target_table", "target_col", value.alias("value")).where("value is not null")


def wanted_paths(mapping: Mapping, tables: list[str]) -> list[str]:
    """The element paths that take part in the assembly of these tables."""
    from treeflat.operators.shred import uncounted

    wanted = {e.path for e in uncounted(mapping)}
    for table in tables:
        for opening in mapping.openings(table):
            chain = mapping.chain(opening)
            wanted |= {e.path for e in chain} | {w.source.path for w in mapping.writes(opening)}
            for step in chain[1:]:
                wanted |= {e.path for e in mapping.sharing(step)}
    return sorted(wanted)


#: What :func:`walk_tables` adds to the record's columns.
ROW_COLUMNS = "opening int, keys array<bigint>, cells array<string>, error string"


def _opened(mapping: Mapping, tables: list[str]) -> list[Element]:
    return [o for t in tables for o in mapping.openings(t)]


def _cells(mapping: Mapping, opening: Element) -> dict[str, list]:
    """The writes into a row of this opening, by column."""
    out: dict[str, list] = {}
    for w in mapping.writes(opening):
        out.setdefault(w.column, []).append(w)
    return out


class _Rows:
    """Numbering, key inheritance and assembly of one record's rows from its nodes in document order."""

    def __init__(self, mapping: Mapping, tables: list[str]):
        from treeflat.operators.shred import uncounted

        self.broken = {e.path for e in uncounted(mapping)}
        self.chains: dict[str, list[str]] = {}
        self.numbers: dict[str, int] = {}  # the opening's place in the list of all
        self.width: dict[str, int] = {}
        self.writes: dict[str, list[tuple]] = {}
        self.group: dict[str, int] = {}  # openings that draw from one counter
        self.starts: dict[str, list[int]] = {}  # counters that begin anew with a row
        groups: dict[tuple, int] = {}
        for number, opening in enumerate(_opened(mapping, tables)):
            chain = mapping.chain(opening)
            self.chains[opening.path], self.numbers[opening.path] = [e.path for e in chain[1:]], number
            for parent, e in zip(chain, chain[1:]):
                key = (parent.path, e.counter)
                if key not in groups:
                    groups[key] = len(groups)
                    self.starts.setdefault(parent.path, []).append(groups[key])
                    self.group |= {x.path: groups[key] for x in mapping.sharing(e)}
            columns = _cells(mapping, opening)
            self.width[opening.path] = len(columns)
            for at, sources in enumerate(columns.values()):
                # of one element's writes the text goes last, so it stays
                for w in reversed(sorted(sources, key=lambda w: w.attr is not None)):
                    self.writes.setdefault(w.source.path, []).append((opening.path, at, w.attr, w.default))

    def __call__(self, nodes: list) -> list[tuple]:
        """(opening, keys, cells) of every row; none if an element that opens a row has no counter."""
        counts, now, rows, open_rows = {}, {}, [], {}
        for _, _, path, text, attrs in nodes:
            if path in self.broken:
                return []
            for g in self.starts.get(path, ()):
                counts[g] = 0
            if path in self.group:
                g = self.group[path]
                counts[g] = now[path] = counts[g] + 1
            if path in self.numbers:
                open_rows[path] = cells = [None] * self.width[path]
                rows.append((self.numbers[path], [now[p] for p in self.chains[path]], cells))
            for opening, at, attr, default in self.writes.get(path, ()):
                value = (text or None) if attr is None else dict(attrs).get(attr, default)
                if value is not None:
                    open_rows[opening][at] = value
        return rows


def walk_tables(records: DataFrame, mapping: Mapping, tables: list[str]) -> DataFrame:
    """The rows of these tables, with as few record columns as possible: one walk serves all, and nothing is shuffled.

    A record that cannot be read yields a single row with ``error`` set.
    """
    keep = [c for c in ("source_file", "pos", "uid", "file_number", "routes") if c in records.columns]
    if mapping.root_table in tables and "record_hash" in records.columns:
        keep.append("record_hash")
    types = {f.name: f.dataType.simpleString() for f in records.schema.fields}
    wanted, root, rows_of = frozenset(wanted_paths(mapping, tables)), mapping.record.path, _Rows(mapping, tables)

    def rows(xml: str):
        try:
            return [(*row, None) for row in rows_of(_walk(xml, root, wanted))]
        except (expat.ExpatError, ValueError, TypeError, AttributeError) as e:
            return [(None, None, None, str(e))]

    row_types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.string()]
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), ROW_COLUMNS])
    return records.select(*keep, "xml").mapInArrow(_exploded(rows, keep, row_types, ["opening", "keys", "cells", "error"]), schema)


def _exploded(made_of, keep: list[str], types: list, names: list[str]):
    """A function of Arrow batches: for each ``xml`` the rows that ``made_of`` gives, with the columns ``keep``."""

    def run(batches):
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            rows, source = [[] for _ in types], []

            def flush():
                taken = [k.take(pa.array(source, pa.int64())) for k in kept]
                return pa.RecordBatch.from_arrays(taken + [pa.array(v, t) for v, t in zip(rows, types)], keep + names)

            size = 0
            for i, xml in enumerate(batch.column(batch.schema.get_field_index("xml"))):
                xml = xml.as_py()  # one text at a time
                for row in made_of(xml):
                    source.append(i)
                    for column, value in zip(rows, row):
                        column.append(value)
                    if len(source) >= _FLUSH:
                        yield flush()
                        rows, source, size = [[] for _ in types], [], 0
                size += len(xml or "")
                if source and size >= _FLUSH_TEXT:
                    yield flush()
                    rows, source, size = [[] for _ in types], [], 0
            if source:
                yield flush()

    return run


def node_table(records: DataFrame, mapping: Mapping, table: str, file_number: int = -1) -> DataFrame:
    """Rows of one table from the node walk (same columns as the native path)."""
    return assemble(walk_tables(records, mapping, [table]), mapping, table, [table], file_number)


def assemble(walked: DataFrame, mapping: Mapping, table: str, tables: list[str], file_number: int = -1) -> DataFrame:
    """Rows of one table from the walked rows of ``tables``, with the table's own columns."""
    given = F.col("file_number").cast("bigint") if "file_number" in walked.columns else F.lit(None).cast("bigint")
    number = F.coalesce(given, F.lit(file_number).cast("bigint"))
    keep = ["record_hash"] if table == mapping.root_table and "record_hash" in walked.columns else []
    names = _columns(mapping, table, tables, F.col, number)
    return walked.where(F.col("opening").isin(_own(mapping, table, tables))).select(F.col("uid").alias("id"), *names, *keep)


def _own(mapping: Mapping, table: str, tables: list[str]) -> list[int]:
    """The numbers of the table's openings."""
    return [i for i, o in enumerate(_opened(mapping, tables)) if o.table == table]


def _columns(mapping: Mapping, table: str, tables: list[str], at, file_number: Column) -> list[Column]:
    """The table's columns from a walked row; ``at`` gives the row's ``opening``, ``keys`` and ``cells``."""
    from treeflat.operators import shred

    number = mapping.record.file_number
    openings = _opened(mapping, tables)
    fields = shred.row_fields(mapping, table)
    values: dict[str, list[Column]] = {name: [] for name, _ in fields}
    for i in _own(mapping, table, tables):
        opening = openings[i]
        keys, cells = mapping.keys(opening)[1:], list(_cells(mapping, opening))
        for name, kind in fields:
            value = F.get(at("cells"), F.lit(cells.index(name))) if name in cells else None
            if name in keys:
                key = F.get(at("keys"), F.lit(keys.index(name)))
                value = key if value is None else F.coalesce(value.try_cast("bigint"), key)
            elif value is None and number and number.table == table and opening is mapping.record and number.column == name:
                value = file_number
            if value is not None:
                values[name].append(F.when(at("opening") == i, value.cast(kind)))
    return [(F.coalesce(*values[n]) if values[n] else F.lit(None).cast(k)).alias(n) for n, k in fields]


def walked_arrays(xml: Column, mapping: Mapping, table: str, file_number: Column) -> Column:
    """The rows of one table within each record, as ``array<struct>`` (NULL for NULL and for records that cannot be read)."""
    wanted, root, rows_of = frozenset(wanted_paths(mapping, [table])), mapping.record.path, _Rows(mapping, [table])
    kind = pa.list_(pa.struct([("opening", pa.int32()), ("keys", pa.list_(pa.int64())), ("cells", pa.list_(pa.string()))]))

    @F.arrow_udf("array<struct<opening:int,keys:array<bigint>,cells:array<string>>>")
    def walked(texts: pa.Array) -> pa.Array:
        out = [None] * len(texts)
        if texts.null_count < len(texts):
            for i, text in enumerate(texts):
                if text.is_valid:
                    try:
                        rows = rows_of(_walk(text.as_py(), root, wanted))
                    except (expat.ExpatError, ValueError, TypeError, AttributeError):
                        continue
                    out[i] = [dict(zip(("opening", "keys", "cells"), row)) for row in rows]
        return pa.array(out, kind)

    own = _own(mapping, table, [table])

    def row(w: Column) -> Column:
        columns = _columns(mapping, table, [table], w.getField, file_number)
        return F.struct(*columns) if columns else F.struct(F.lit(None).cast("string").alias("_none"))

    return F.transform(F.filter(walked(xml), lambda w: w.getField("opening").isin(own)), row)


def walk_failures(records: DataFrame, mapping: Mapping) -> DataFrame:
    """Records the walker could not read, with the reason."""
    kept = walk_records(records, mapping.record.path, []).where("error is not null")
    return kept.select(*[c for c in records.columns if c != "xml"], "error", F.lit("XMLSyntaxError").alias("error_type"))
