"""Contract types: coercions that yield NULL when a text cannot be read as the type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from treeflat.functions.text import strip_space

# Texts that mean true / false, compared in lower case and untrimmed.
TRUE_WORDS = ["true", "1", "yes", "t", "y"]
FALSE_WORDS = ["false", "0", "no", "f", "n"]

# Contract type -> Spark type of the stored column.
STORED_TYPE = {
    "STRING": "string",
    "INTEGER": "bigint",
    "NUMERIC": "double",
    "FLOAT": "double",
    "BOOLEAN": "boolean",
    "DATE": "string",
    "TIMESTAMP": "string",
}

_INT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
_FLOAT = (
    r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
)


def to_integer(col: Column) -> Column:
    digits = F.replace(strip_space(col), F.lit("_"), F.lit(""))
    return F.when(col.rlike(_INT), digits.try_cast("bigint"))


def to_float(col: Column) -> Column:
    digits = F.replace(strip_space(col), F.lit("_"), F.lit(""))
    return F.when(col.rlike(_FLOAT), digits.try_cast("double"))


def to_boolean(col: Column) -> Column:
    word = F.lower(col)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def coerce(col: Column, contract_type: str, strict_dates: bool = False) -> Column:
    """Typed value of a text column; unknown types pass through as text."""
    kind = contract_type.upper()
    if kind == "INTEGER":
        return to_integer(col)
    if kind in ("FLOAT", "NUMERIC"):
        return to_float(col)
    if kind == "BOOLEAN":
        return to_boolean(col)
    if strict_dates and kind == "DATE":
        return F.when(F.to_date(F.try_to_timestamp(col, F.lit("yyyy-MM-dd"))).isNotNull(), col)
    if strict_dates and kind == "TIMESTAMP":
        return F.when(F.try_to_timestamp(col).isNotNull(), col)
    return col


def coercion_reason(col: Column, contract_type: str) -> Column:
    """Why a text was refused.  Fixed values: the message formats users grep for."""
    kind = contract_type.upper()
    if kind == "INTEGER":
        return F.concat(F.lit("invalid literal for int() with base 10: '"), col, F.lit("'"))
    if kind in ("FLOAT", "NUMERIC"):
        return F.concat(F.lit("could not convert string to float: '"), col, F.lit("'"))
    return F.concat(F.lit("Cannot coerce '"), col, F.lit(f"' to {kind}"))
