"""INSERT scripts as a source: statements, columns and values from SQL text.

A statement ends at the first ``;`` outside quotes; the rest of that line is ignored; lines
are trimmed and joined by one blank.  Whether a line starts inside a literal depends on all
lines before it, so the quote state is a prefix scan: per split over its lines as they are
read, for each state in which it may begin; across the splits of a file on one row each.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeflat.functions.text import split_quoted, strip_space
from treeflat.session import ship_with_tasks, staged

ship_with_tasks(__name__)

#: Quote state between lines: 0 outside, 1 in single quotes, 2 in double quotes.
_QUOTES = {"'": 1, '"': 2}
_MARKS = ["", "'", '"']
_STOP = re.compile(r"""['";]""")


def _scan(line: str, state: int) -> tuple[int, int]:
    """(state after the line, length kept if a statement ends on it else -1)."""
    at = 0
    while True:
        if state:
            close = line.find(_MARKS[state], at)
            if close < 0:
                return state, -1
            state, at = 0, close + 1
        stop = _STOP.search(line, at)
        if stop is None:
            return 0, -1
        at = stop.end()
        if stop[0] == ";":
            return 0, at
        state = _QUOTES[stop[0]]


def _scan_splits(batches):
    """Over a split's lines in their order: for each state in which the split may begin, what happens at every line.

    Per line and first state: ``end`` (as :func:`_scan`), ``stmt`` (statements that the split ended before), ``solo`` (a whole statement stands
    on the line).  After each split one row without a line: the states in which it ends, and how many statements it ended.
    """
    import pyarrow as pa

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.bool_())]
    names = ["source_file", "block", "pos", "line", "end", "stmt", "state", "solo"]

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    split, states, counts, fresh = None, [], [], []
    for batch in batches:
        rows = []
        for file, block, pos, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != split:
                if split:
                    rows.append((*split, None, None, None, counts, states, None))
                split, states, counts, fresh = (file, block), [0, 1, 2], [0, 0, 0], [True, True, True]
            scans = [_scan(line, state) for state in states] if _STOP.search(line) else [(state, -1) for state in states]
            ends = [end for _, end in scans]
            rows.append((file, block, pos, line, ends, list(counts), None, [f and end >= 0 for f, end in zip(fresh, ends)]))
            states = [state for state, _ in scans]
            counts = [n + (end >= 0) for n, end in zip(counts, ends)]
            # a split may begin within a statement, so its first line is no whole one: the fold tells
            fresh = [end >= 0 for end in ends]
        if rows:
            yield made(rows)
    if split:
        yield made([(*split, None, None, None, counts, states, None)])


_SCANNED = "source_file string, block bigint, pos bigint, line string, end array<bigint>, stmt array<bigint>, state array<bigint>, solo array<boolean>"


def read_statements(spark: SparkSession, paths, glob: str = "*.sql") -> DataFrame:
    """``source_file, stmt, statement`` in file order.  Text after the last end is no statement.

    The scan runs over the text source's own partitions; only the lines of statements over several lines are shuffled.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(paths).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        strip_space("value").alias("line"),
    ).where("pos >= 0 and line <> ''")
    # Read twice below; staged, so that the scan runs once.
    scanned = staged(lines.mapInArrow(_scan_splits, _SCANNED), "script")

    # One row per split, folded along the file; written, so that the join below can be a broadcast if they are few.
    splits = scanned.where("line is null").select("source_file", "block", "state", "stmt")
    carried = staged(splits.groupBy("source_file").applyInPandas(_carry, "source_file string, block bigint, first int, stmts bigint, open boolean, total bigint"), "script-splits")
    placed = scanned.where("line is not null").join(carried, ["source_file", "block"]).select(
        "source_file", "pos", "line", F.get("end", "first").alias("end"), (F.col("stmts") + F.get("stmt", "first")).alias("stmt"),
        # the first line of a split goes on with an open statement of the split before
        (F.get("solo", "first") & ~(F.col("open") & (F.get("stmt", "first") == 0))).alias("solo"), "total",
    )
    part = F.when(F.col("end") >= 0, F.substring("line", F.lit(1), F.col("end").cast("int"))).otherwise(F.col("line"))
    solo = placed.where("solo").select("source_file", "stmt", part.alias("statement"))
    # What follows the last complete statement is dropped before anything is gathered.
    pieces = F.sort_array(F.collect_list(F.struct("pos", part.alias("t"))))
    parts = placed.where("not solo and stmt < total").groupBy("source_file", "stmt")
    return solo.unionByName(parts.agg(F.array_join(F.transform(pieces, lambda p: p.t), " ").alias("statement")))


def _carry(splits: pd.DataFrame) -> pd.DataFrame:
    """Of one file: each split's first state, the statements ended before it, and whether one is open there."""
    splits = splits.sort_values("block")
    state, stmts, rows, open_ = 0, 0, [], False
    for r in splits.itertuples():
        rows.append((r.source_file, r.block, state, stmts, open_))
        stmts += int(r.stmt[state])
        # whether the split ends within a statement is not known from its states: its first line is then gathered with that, if any
        open_, state = True, int(r.state[state])
    out = pd.DataFrame(rows, columns=["source_file", "block", "first", "stmts", "open"])
    out["total"] = stmts
    return out


def _bare(name: Column) -> Column:
    """A name without the quotes of MySQL or PostgreSQL."""
    for mark in ("`", '"'):
        inner = F.replace(F.regexp_extract(name, f"(?s)^{mark}(.*){mark}$", 1), F.lit(2 * mark), F.lit(mark))
        name = F.when(name.rlike(f"(?s)^{mark}.*{mark}$"), inner).otherwise(name)
    return name


def _quoted(names: str) -> Column:
    """Whether any of the names may be quoted: mostly none is, and then no pattern needs to be tried on each."""
    return F.contains(F.col(names), F.lit("`")) | F.contains(F.col(names), F.lit('"'))


def parse_statements(statements: DataFrame) -> DataFrame:
    """``table_name, cols, vals, mismatch``; statements of another form are left out.

    The form is INSERT INTO name (columns) VALUES (values); where each part ends at the first mark that can end it.  Marks are
    located, not matched: a statement may be long, and it is gone through once for its end and once for its values.
    """
    head, values = "INSERT INTO ", ") VALUES ("
    s = F.col("statement")
    # Steps of their own: what is used several times is then worked out once.
    opened = statements.where(s.startswith(head) & s.endswith(");")).select(
        *statements.columns, F.expr(f"locate(' (', statement, {len(head) + 2})").alias("_name_end"))
    closed = opened.select("*", F.expr(f"locate('{values}', statement, _name_end + 3)").alias("_cols_end")).where(
        f"_name_end > 0 and _cols_end > 0 and char_length(statement) > _cols_end + {len(values) + 1}")
    named = closed.select(
        *statements.columns,
        F.expr(f"substring(statement, {len(head) + 1}, _name_end - {len(head) + 1})").alias("table_name"),
        F.expr("substring(statement, _name_end + 2, _cols_end - _name_end - 2)").alias("cols"),
        F.expr(f"substring(statement, _cols_end + {len(values)}, char_length(statement) - _cols_end - {len(values) + 1})").alias("vals"),
    )
    read = named.select(
        *statements.columns, F.when(_quoted("table_name"), _bare(F.col("table_name"))).otherwise(F.col("table_name")).alias("table_name"),
        F.when(_quoted("cols"), F.transform(F.split("cols", ","), lambda c: _bare(F.trim(c)))).otherwise(F.transform(F.split("cols", ","), lambda c: F.trim(c))).alias("cols"),
        split_quoted(F.col("vals")).alias("vals"),
    )
    return read.withColumn("mismatch", F.size("cols") != F.size("vals"))


def rows_for(parsed: DataFrame, table: str, names: list[str], unquote: bool = True) -> DataFrame:
    """Rows of one table, aligned with its contract; blanks are NULL.

    Columns and values are paired up to the shorter list; of a repeated column the last counts.
    """
    from treeflat.functions.text import sql_unliteral

    shorter = F.least(F.size("cols"), F.size("vals"))
    # Backwards, so that the first place of a name is its last.
    got = parsed.where(F.col("table_name") == table).select(
        F.reverse(F.slice("cols", F.lit(1), shorter)).alias("c"), F.reverse(F.slice("vals", F.lit(1), shorter)).alias("v"))

    def cell(n):
        return F.get("v", (F.array_position("c", n) - 1).cast("int")).alias(n)

    cells = got.select(*[cell(n) for n in names])
    return cells.select(*[sql_unliteral(F.col(f"`{n}`")).alias(n) for n in names]) if unquote else cells
