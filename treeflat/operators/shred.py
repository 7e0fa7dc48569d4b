"""Shredding with ``from_xml``: one parse per record, no shuffle, all in the JVM.

The schema handed to the parser is derived from the mapping and holds only what the wanted
tables need.  Every element below the record is declared as an array, so repeated wrappers
and repeated scalar elements lose nothing.  Each table becomes one array of flat rows per
record; ``inline`` turns it into rows.

What the parser cannot tell (text next to child elements, document order between differently
named siblings) goes through :mod:`treeflat.operators.nodes`, chosen per table and per record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from treeflat.operators import nodes
from treeflat.plans.mapping import Element, Mapping
from treeflat.session import staged

ATTR, TEXT, BAD = "@", "#text", "#bad"
#: An attribute that numbers the openings that share a counter, see :func:`numbered`.
PLACE = "treeflat.place"
DOC = "`#doc`"

#: The parser must keep white space, ignore name space prefixes and isolate bad records.
PARSER_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
    "attributePrefix": ATTR,
    "valueTag": TEXT,
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "inferSchema": "false",
}


class _Needs:
    """Which parts of the skeleton the wanted tables read."""

    def __init__(self, mapping: Mapping, tables: list[str]):
        self.record = mapping.record
        self.attrs: dict[Element, set[str]] = {}
        self.text: set[Element] = set()
        self.present: set[Element] = {mapping.record}
        self.ordered: set[Element] = set()
        for table in tables:
            for opening in mapping.openings(table):
                self._reach(opening)
                for w in mapping.writes(opening):
                    self._reach(w.source)
                    if w.attr is None:
                        self.text.add(w.source)
                    else:
                        self.attrs.setdefault(w.source, set()).add(w.attr)
        for e in uncounted(mapping):
            self._reach(e)
        for group in _shared(mapping, tables):
            for e in group:
                self._reach(e)
                self.ordered.add(e)

    def _reach(self, element: Element | None):
        while element is not None and element not in self.present:
            self.present.add(element)
            element = element.parent if element is not self.record else None

    def children(self, e: Element) -> list[Element]:
        return [c for c in e.children.values() if c in self.present]

    def is_plain(self, e: Element) -> bool:
        return e is not self.record and e not in self.ordered and not self.attrs.get(e) and not self.children(e)

    def struct(self, e: Element) -> T.StructType:
        fields = [T.StructField(ATTR + a, T.StringType()) for a in e.attrs if a in self.attrs.get(e, ())]
        if e in self.ordered:
            fields.append(T.StructField(ATTR + PLACE, T.StringType()))
        if e in self.text:
            fields.append(T.StructField(TEXT, T.StringType()))
        for c in self.children(e):
            inner = T.StringType() if self.is_plain(c) else self.struct(c)
            fields.append(T.StructField(c.name, T.ArrayType(inner)))
        return T.StructType(fields)

    def schema(self) -> T.StructType:
        # The corrupt-record column has to be the last one.
        return T.StructType(self.struct(self.record).fields + [T.StructField(BAD, T.StringType())])


def uncounted(mapping: Mapping) -> list[Element]:
    """Row-opening elements without a counter: a record that holds one cannot be keyed."""
    return [e for e in mapping.openings() if e is not mapping.record and not e.counter]


# The expressions below are written as SQL text: one mapping may need thousands of them, and
# Catalyst parses a text much faster than the driver can assemble Column objects.


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _occurrences(base: str, names: list[str], stems: dict | None = None) -> str:
    """All elements on a relative path, over all repetitions of the wrappers on the way.

    From the record, the longest prefix that has a column of its own (see :func:`_stems`) is
    read from there.
    """
    found, at = f"{base}.{_q(names[0])}", 1
    if stems and base == DOC:
        for n in range(len(names), 0, -1):
            if tuple(names[:n]) in stems:
                found, at = _q(stems[tuple(names[:n])]), n
                break
    for name in names[at:]:
        # An empty wrapper yields a NULL inner array, which flatten must not see.
        found = f"flatten(filter({found}.{_q(name)}, w -> w is not null))"
    return found


def _stems(needs: _Needs) -> list[tuple[tuple, str, str]]:
    """Paths below the record that several expressions start from: (path, column, expression).

    Each becomes a column once, so that no table and no value walks its wrappers again.
    """
    made: list[tuple[tuple, str, str]] = []
    known: dict[tuple, str] = {}

    def visit(e: Element, names: tuple):
        uses = len(needs.children(e)) + len(needs.attrs.get(e, ())) + (e in needs.text) + (e.table is not None)
        if uses > 1:
            column = f"#s{len(made)}"
            made.append((names, column, _occurrences(DOC, list(names), known)))
            known[names] = column
        if e.table is None:
            for c in needs.children(e):
                visit(c, (*names, c.name))

    for c in needs.children(needs.record):
        visit(c, (c.name,))
    return made


def _value(base: str, opening: Element, write, needs: _Needs, stems: dict) -> str:
    src = write.source
    steps = src.below(opening)
    plain = needs.is_plain(src)
    text, attr = f".{_q(TEXT)}", f".{_q(ATTR + (write.attr or ''))}"
    default = None if write.default is None else _literal(write.default)
    if not steps:
        if write.attr is None:
            got = base if plain else base + text
            return f"if({got} = '', null, {got})"
        return base + attr if default is None else f"coalesce({base}{attr}, {default})"
    found = _occurrences(base, steps, stems)
    if write.attr is None:
        return f"try_element_at(filter({found if plain else found + text}, t -> t <> ''), -1)"
    if default is not None:
        return f"try_element_at(transform({found}{attr}, t -> coalesce(t, {default})), -1)"
    return f"try_element_at(filter({found}{attr}, t -> t is not null), -1)"


def row_fields(mapping: Mapping, table: str) -> list[tuple[str, str]]:
    """(name, type) of the shredded columns of a table besides ``id``."""
    counters = {c for o in mapping.openings(table) for c in mapping.keys(o)[1:]}
    number = mapping.record.file_number
    special = {number.column} if number and number.table == table else set()
    return [
        (c, "bigint" if c in counters or c in special else "string") for c in mapping.columns(table) if c != "id"
    ]


def _row(mapping, table, opening, base: str, keys: dict[str, str], needs, stems: dict) -> str:
    values = {w.column: _value(base, opening, w, needs, stems) for w in mapping.writes(opening)}
    number = mapping.record.file_number
    if number and number.table == table and opening is mapping.record:
        values.setdefault(number.column, "`#n`")
    out = []
    for name, kind in row_fields(mapping, table):
        value = values.get(name)
        if name in keys:
            value = keys[name] if value is None else f"coalesce(try_cast({value} as {kind}), {keys[name]})"
        if value is None or kind != "string":
            value = f"cast({value or 'null'} as {kind})"
        out.append(f"{_literal(name)}, {value}")
    return f"named_struct({', '.join(out)})" if out else "named_struct('_none', cast(null as string))"


def table_array(mapping: Mapping, table: str, needs: _Needs, orders: dict[Element, str], stems: dict) -> str:
    """The rows of one table within one record, as ``array<struct>``.

    ``orders`` holds, for openings that share a counter, the counter values of this opening's
    elements (see :func:`_shared_values`).
    """

    def descend(base: str, at: int, chain: list[Element], keys: dict[str, str]) -> str:
        here = chain[at]
        if at == 0 and len(chain) == 1:
            return f"array({_row(mapping, table, here, base, keys, needs, stems)})"
        nxt, item, number = chain[at + 1], f"e{at}", f"n{at}"
        found = _occurrences(base, nxt.below(here), stems)
        # Where a counter is shared the numbers are zipped in, worked out once per record.
        counted = number if nxt in orders else f"({number} + 1)"
        mine = {**keys, nxt.counter: f"cast({counted} as bigint)"}
        last = at + 2 == len(chain)
        body = _row(mapping, table, nxt, item, mine, needs, stems) if last else descend(item, at + 1, chain, mine)
        head = f"zip_with({found}, {orders[nxt]}" if nxt in orders else f"transform({found}"
        rows = f"{head}, ({item}, {number}) -> {body})"
        return rows if last else f"flatten(filter({rows}, r -> r is not null))"

    arrays = [descend(DOC, 0, mapping.chain(o), {}) for o in mapping.openings(table)]
    if len(arrays) == 1:
        return arrays[0]
    blank = f"cast(array() as {arrays_type(mapping, table)})"
    return f"concat({', '.join(f'coalesce({a}, {blank})' for a in arrays)})"


def _shared(mapping: Mapping, tables: list[str]) -> list[list[Element]]:
    """The groups with a common counter that the wanted tables pass through."""
    steps = {e for t in tables for o in mapping.openings(t) for e in mapping.chain(o)[1:2]}
    return [g for g in mapping.shared_groups() if any(e in steps for e in g)]


def _shared_values(groups: list[list[Element]]) -> dict[Element, str]:
    """Counter values of each member of each group, from the member numbers in document order."""
    return {
        e: f"filter(transform(`#order`[{g}], (m, a) -> if(m = {i}, a + 1, null)), n -> n is not null)"
        for g, members in enumerate(groups)
        for i, e in enumerate(members)
    }


def arrays_type(mapping: Mapping, table: str) -> str:
    fields = row_fields(mapping, table) or [("_none", "string")]
    return "array<struct<" + ",".join(f"`{n}`:{k}" for n, k in fields) + ">>"


def numbered(xml: Column, names: set[str]) -> Column:
    """The record with a running number, as an attribute, at every opening tag with one of these names (outside CDATA).

    So the parser reports with each element where it stood among the differently named ones.
    """
    name = rf"<(?:[\w.-]++:)?+(?:{_names(names)})(?=[\s/>])"
    start = "<![CDATA["
    sections = F.regexp_extract_all(xml, F.lit(r"(?s)<!\[CDATA\[.*?\]\]>|.+?(?=<!\[CDATA\[|\z)"), F.lit(0))
    sections = F.when(F.contains(xml, F.lit(start)), sections).otherwise(F.array(xml))
    cut = F.transform(sections, lambda s: F.when(F.startswith(s, F.lit(start)), F.array(s)).otherwise(F.split(s, f"(?={name})", -1)))
    marked = F.transform(F.flatten(cut), lambda p, i: F.regexp_replace(p, F.lit(f"^({name})"), F.concat(F.lit(f'$1 {PLACE}="'), i.cast("string"), F.lit('"'))))
    return F.array_join(marked, "")


def _orders(groups: list[list[Element]], record: Element, stems: dict) -> str:
    """For each group of openings that share a counter: their member numbers in document order."""
    out = []
    for group in groups:
        members = []
        for i, e in enumerate(group):
            places = f"{_occurrences(DOC, e.below(record), stems)}.{_q(ATTR + PLACE)}"
            members.append(f"coalesce(transform({places}, p -> named_struct('p', cast(p as int), 'm', {i})), cast(array() as array<struct<p:int,m:int>>))")
        out.append(f"transform(array_sort(concat({', '.join(members)})), x -> x.m)")
    return f"array({', '.join(out)})"


def parse(xml: Column, needs: _Needs) -> Column:
    return F.from_xml(xml, needs.schema(), PARSER_OPTIONS)


def unusable(mapping: Mapping) -> str:
    """True for a record that is malformed or holds an element that cannot be keyed."""
    tests = [f"{DOC}.{_q(BAD)} is not null"]
    tests += [f"coalesce(size({_occurrences(DOC, e.below(mapping.record))}), 0) > 0" for e in uncounted(mapping)]
    return " or ".join(tests)


def _names(elements) -> str:
    """An alternation of names with common beginnings factored out."""
    tree: dict = {}
    for name in sorted(set(elements)):
        here = tree
        for ch in name:
            here = here.setdefault(ch, {})
        here[""] = {}

    def text(node: dict) -> str:
        options = [re.escape(ch) + text(nxt) for ch, nxt in node.items() if ch]
        if not options:
            return ""
        body = options[0] if len(options) == 1 and "" not in node else "(?:" + "|".join(options) + ")"
        return body + ("?" if "" in node else "")

    return text(tree)


def misread(records: DataFrame, mapping: Mapping, tables: list[str]) -> Column:
    """True for records whose ``xml`` the parser would not report as written.

    It may be true too often (such records take the node walk, which is exact as well) but
    never too seldom: a mapped text element holding a child element or only white space, a
    processing instruction, a mapped attribute written with a prefix, or, where the session
    is not case sensitive, a name in another spelling than the mapping's.  Separate patterns,
    each tied to one leading character, search much faster than one alternation.
    """
    xml = F.col("xml")
    needs = _Needs(mapping, tables)
    texts, attrs = {e.name for e in needs.text}, set().union(*needs.attrs.values())
    exact = records.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    everything = list(mapping.record.walk())
    used = {e.name for e in needs.present if e is not mapping.record}
    tags = []
    if texts:
        tags.append(
            rf"(?:{_names(texts)})(?:\s[^>]*+)?+(?<!/)>(?:\s++</|[^<]*+(?:<!\[CDATA\[.*?\]\]>[^<]*+)*+<[A-Za-z_:])"
        )
    if used and not exact:
        tags.append(rf"(?!(?:{_names({e.name for e in everything})})[\s/>])(?iu:{_names(used)})[\s/>]")
    options = [r"\?"] + ([rf"(?:[\w.-]++:)?+(?:{'|'.join(tags)})"] if tags else [])
    test = xml.rlike(rf"(?s)<(?:{'|'.join(options)})")
    if attrs:
        # Searched from the ``=`` and its quote, which are rare in texts; far off from its name is too seldom to be looked at.
        names = [rf":(?:{_names(attrs)})"]
        if not exact:
            known = _names({a for e in everything for a in e.attrs})
            names.append(rf"\s(?!(?:{known})[\s=])(?iu:{_names(attrs)})")
        test = test | xml.rlike(rf"=(?<=(?:{'|'.join(names)})\s{{0,9}}=|\s{{10}}=)\s*+[\"']")
    return test


def _file_number(records: DataFrame, number: int) -> Column:
    if "file_number" in records.columns:
        return F.coalesce(F.col("file_number").cast("bigint"), F.lit(number).cast("bigint"))
    return F.lit(number).cast("bigint")


def _parsed(records: DataFrame, mapping: Mapping, tables: list[str], file_number: int):
    """Records with ``#doc``, ``#n`` and, where counters are shared, ``#order``; the array columns."""
    needs = _Needs(mapping, tables)
    groups = _shared(mapping, tables)
    out = records.withColumn("#n", _file_number(records, file_number))
    xml = numbered(F.col("xml"), {e.name for group in groups for e in group}) if groups else F.col("xml")
    out = out.withColumn("#doc", parse(xml, needs))
    orders, stems = _shared_values(groups), {}
    by_depth: dict[int, dict[str, Column]] = {}
    for names, column, expression in _stems(needs):
        by_depth.setdefault(len(names), {})[column] = F.expr(expression)
        stems[names] = column
    for depth in sorted(by_depth):  # one projection per level, as each may read the one above
        out = out.withColumns(by_depth[depth])
    if groups:
        out = out.withColumn("#order", F.expr(_orders(groups, mapping.record, stems)))
    return out, {t: table_array(mapping, t, needs, orders, stems) for t in tables}


def native_table(records: DataFrame, mapping: Mapping, table: str, file_number: int = -1) -> DataFrame:
    keep = ["record_hash"] if "record_hash" in records.columns and table == mapping.root_table else []
    parsed, arrays = _parsed(records, mapping, [table], file_number)
    # explode_outer adds no size filter above the parser, so each record is parsed once.
    rows = F.expr(f"case when not ({unusable(mapping)}) then {arrays[table]} end")
    made = parsed.select(F.col("uid").alias("id"), *keep, F.explode_outer(rows).alias("#row"))
    made = made.where(F.col("#row").isNotNull())
    return _flat(made, mapping, table, keep)


def _flat(made: DataFrame, mapping: Mapping, table: str, keep: list[str]) -> DataFrame:
    """``#row`` spread into its columns."""
    fields = ["`#row`.*"] if row_fields(mapping, table) else []
    return made.select("id", *fields, *keep)


def shred_table(
    records: DataFrame, mapping: Mapping, table: str, file_number: int = -1, path: str = "auto"
) -> DataFrame:
    """Rows of one mapped table: ``id``, the inherited counters, the table's columns.

    ``path`` is ``auto`` (exact: per-table and per-record choice), ``native`` (the input is
    known to hold no mixed content) or ``nodes``.
    """
    if table not in mapping.tables():
        raise ValueError(f"no element opens table {table}")
    if path == "native":
        return native_table(records, mapping, table, file_number)
    if path == "nodes" or mapping.needs_document_order(table):
        return nodes.node_table(records, mapping, table, file_number)
    return _either_path(records, mapping, table, file_number)


def _either_path(records: DataFrame, mapping: Mapping, table: str, file_number: int) -> DataFrame:
    """Rows by the path each record needs, from one reading of the records: the node walk is handed the texts that need it, NULL for the others."""
    keep = ["record_hash"] if "record_hash" in records.columns and table == mapping.root_table else []
    number = ["file_number"] if "file_number" in records.columns else []
    marked = records.select("uid", "xml", *keep, *number, misread(records, mapping, [table]).alias("#ordered"))
    apart = marked.select("uid", *keep, *number, F.when(F.col("#ordered"), F.col("xml")).alias("#walk"), F.when(~F.col("#ordered"), F.col("xml")).alias("xml"))
    parsed, arrays = _parsed(apart, mapping, [table], file_number)
    native = F.expr(f"case when xml is not null and not ({unusable(mapping)}) then {arrays[table]} end")
    walked = nodes.walked_arrays(F.col("#walk"), mapping, table, F.col("#n"))
    made = parsed.select("uid", *keep, "#n", "#walk", native.alias("#native")).select(
        F.col("uid").alias("id"), *keep, F.explode_outer(F.coalesce(F.col("#native"), walked)).alias("#row")
    )
    return _flat(made.where(F.col("#row").isNotNull()), mapping, table, keep)


def malformed(records: DataFrame, mapping: Mapping) -> DataFrame:
    """The records none of whose rows can be used, with the reason."""
    needs = _Needs(mapping, [mapping.root_table])
    doc = F.col("#doc")
    parsed = records.withColumn("#doc", parse(F.col("xml"), needs))
    reason = F.when(doc.getField(BAD).isNotNull(), F.lit("record is not well-formed XML")).when(
        F.expr(unusable(mapping)), F.lit("Counter not found in config")
    )
    kind = F.when(doc.getField(BAD).isNotNull(), F.lit("XMLSyntaxError")).otherwise(F.lit("KeyError"))
    return (
        parsed.select(*records.columns, reason.alias("error"), kind.alias("error_type"))
        .where(F.col("error").isNotNull())
    )


def staged_arrays(records: DataFrame, mapping: Mapping, tables: list[str], file_number: int = -1) -> DataFrame:
    """All wanted tables of every record from one parse: one ``array<struct>`` column each.

    Written as Parquet, every table is later read through its own column only.  ``unusable``
    marks records for the dead letters; ``routes`` lists the tables (by position) whose rows of
    this record come from the node walk instead, which is decided per record and table.
    """
    native = [t for t in tables if not mapping.needs_document_order(t)]
    parsed, arrays = _parsed(records, mapping, native or [mapping.root_table], file_number)
    marks = [
        F.lit(i) if t not in native else F.when(misread(records, mapping, [t]), F.lit(i))
        for i, t in enumerate(tables)
    ]
    routes = F.filter(F.array(*marks), lambda i: i.isNotNull())
    if len(native) == len(tables):  # most records need no look at the single tables
        routes = F.when(misread(records, mapping, tables), routes)
    return parsed.select(
        *[F.col(c) for c in records.columns],
        routes.alias("routes"),  # never empty: whatever the common test finds, one table's test finds
        F.expr(unusable(mapping)).alias("unusable"),
        *[F.expr(arrays[t]).alias(t) for t in native],
    )


def shred_tables(records: DataFrame, mapping: Mapping, tables: list[str], file_number: int = -1) -> dict[str, DataFrame]:
    """Rows of several tables from one parse, staged: as :func:`shred_table` gives them one by one."""
    arrays = staged_arrays(records, mapping, tables, file_number)
    again = F.col("routes").isNotNull()
    parsed = staged(arrays.withColumn("xml", F.when(again, F.col("xml"))), "parsed")
    walked = nodes.walk_tables(parsed.where(again & ~F.col("unusable")), mapping, tables)
    out = {}
    for at, table in enumerate(tables):
        rows = nodes.assemble(walked.where(routed_to_nodes(at)), mapping, table, tables, file_number)
        out[table] = rows if mapping.needs_document_order(table) else rows_of(parsed, mapping, table, at).unionByName(rows)
    return out


def routed_to_nodes(table_at: int) -> Column:
    """Whether a staged record's rows of the table come from the node walk."""
    return F.coalesce(F.array_contains("routes", F.lit(table_at)), F.lit(False))


def rows_of(staged: DataFrame, mapping: Mapping, table: str, table_at: int) -> DataFrame:
    """Flat rows of one staged table column, without the records routed to the node walk."""
    keep = ["record_hash"] if table == mapping.root_table and "record_hash" in staged.columns else []
    mine = staged.where(~F.col("unusable") & ~routed_to_nodes(table_at))
    made = mine.select(F.col("uid").alias("id"), *keep, F.explode(F.col(table)).alias("#row"))
    return _flat(made, mapping, table, keep)
