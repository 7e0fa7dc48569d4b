"""Contract validation: one projection gives typed columns and the first error of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treeflat.functions.coerce import STORED_TYPE, coerce, coercion_reason
from treeflat.plans.contracts import Field
from treeflat.plans.mapping import Mapping

#: A column Catalyst may not recompute.  Filters that name it stay above the projection, so
#: every coercion is evaluated once instead of once in the filter and once in the result.
MARK = "#at"


def checked(rows: DataFrame, contract: list[Field], strict_dates: bool = False) -> DataFrame:
    """Contract columns (typed), undeclared columns (as they are), ``error`` and the mark.

    The first failing field in contract order names the error.
    """
    have = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    typed, errors = [], []
    for f in contract:
        stored = STORED_TYPE.get(f.type.upper(), "string")
        if f.name not in have:
            typed.append(F.lit(None).cast(stored).alias(f.name))
            if f.required:
                errors.append(F.lit(f"Required field missing: {f.name}"))
            continue
        raw = F.col(f"`{f.name}`")
        if f.required:
            errors.append(F.when(raw.isNull(), F.lit(f"Required field missing: {f.name}")))
        if have[f.name] != "string":  # already typed by the shredder or a source
            typed.append(raw.cast(stored).alias(f.name))
            continue
        value = coerce(raw, f.type, strict_dates)
        typed.append(value.cast(stored).alias(f.name))
        if stored != "string" or strict_dates:
            message = F.concat(
                F.lit(f"Type coercion failed for {f.name}: "), raw, F.lit(f" -> {f.type}: "), coercion_reason(raw, f.type)
            )
            errors.append(F.when(raw.isNotNull() & value.isNull(), message))
    declared = {f.name for f in contract}
    extra = [F.col(f"`{c}`") for c in rows.columns if c not in declared]
    error = F.coalesce(*errors) if errors else F.lit(None)
    return rows.select(*typed, *extra, error.cast("string").alias("error"), F.spark_partition_id().alias(MARK))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(f"`{MARK}` >= 0 and error is null").drop(MARK)


def failed(judged: DataFrame) -> DataFrame:
    return judged.where(f"`{MARK}` >= 0 and error is not null").drop(MARK)


def may_refuse(contract: list[Field], mapping: Mapping, table: str) -> bool:
    """Whether a shredded row of this table can break its contract at all.

    Keys are always present and typed; plain text columns accept everything.
    """
    keys = {k for o in mapping.openings(table) for k in mapping.keys(o)}
    return any(
        f.name not in keys and (f.required or STORED_TYPE.get(f.type.upper(), "string") != "string") for f in contract
    ) or any(f.name in keys and f.required and f.name not in mapping.columns(table) for f in contract)


def project(rows: DataFrame, contract: list[Field]) -> DataFrame:
    """Only the declared columns, in contract order; names are matched by case."""
    have = set(rows.columns)
    return rows.select(
        *[
            F.col(f"`{f.name}`") if f.name in have
            else F.lit(None).cast(STORED_TYPE.get(f.type.upper(), "string")).alias(f.name)
            for f in contract
        ]
    )


def valid_rows(rows: DataFrame, contract: list[Field], strict_dates: bool = False) -> DataFrame:
    return project(accepted(checked(rows, contract, strict_dates)), contract)


def refused_rows(rows: DataFrame, contract: list[Field], table: str, strict_dates: bool = False) -> DataFrame:
    """Dead letters of one table: the row as JSON and the first error."""
    as_json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    kept = rows.withColumn("#row", as_json)
    errors = failed(checked(kept, contract, strict_dates))
    return errors.select(
        F.lit(table).alias("table_name"),
        F.col("#row").alias("row"),
        "error",
        F.lit("ValueError").alias("error_type"),
        F.lit("ValidateSchema").alias("pipeline_step"),
    )


def unknown_table(rows: DataFrame, table: str) -> DataFrame:
    """Dead letters for rows of a table that has no contract."""
    return rows.select(
        F.lit(table).alias("table_name"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("row"),
        F.lit(f"Schema not found for table: {table}").alias("error"),
        F.lit("ValueError").alias("error_type"),
        F.lit("ValidateSchema").alias("pipeline_step"),
    )
