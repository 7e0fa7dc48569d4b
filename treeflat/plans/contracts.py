"""Table contracts: the declared columns of each target table."""

from __future__ import annotations

from dataclasses import dataclass
import json

from pyspark.sql import SparkSession, functions as F, types as T

from treeflat.functions.coerce import STORED_TYPE


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "STRING"
    mode: str = "NULLABLE"
    description: str = ""

    @property
    def required(self) -> bool:
        return self.mode == "REQUIRED"


RUN_STAMP = Field("ingestion_ts", "TIMESTAMP", "NULLABLE", "start of the run that wrote the row")
CONTENT_HASH = Field("record_hash", "STRING", "NULLABLE", "SHA-256 of the record")

_FIELD_DDL = "array<struct<name:string,type:string,mode:string,description:string>>"


class Contracts:
    def __init__(self, tables: dict[str, list[Field]]):
        self.tables = tables

    def __contains__(self, table: str) -> bool:
        return table in self.tables

    def __getitem__(self, table: str) -> list[Field]:
        return self.tables[table]

    def __iter__(self):
        return iter(self.tables)

    def names(self, table: str) -> list[str]:
        return [f.name for f in self.tables[table]]

    @classmethod
    def from_dict(cls, tables: dict[str, list[dict]]) -> "Contracts":
        return cls({t: [Field(**{k: v for k, v in f.items() if v is not None}) for f in fs] for t, fs in tables.items()})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Contracts":
        """Read one JSON object ``{table: [field, ...]}``, or a folder of ``<table>_schema.json`` lists."""
        files = (
            spark.read.text(path, wholetext=True)
            .select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:_schema)?\.json$", 1).alias("name"), "value")
            .orderBy("name")
        )
        tables: dict[str, list[dict]] = {}
        for row in files.collect():  # contracts are configuration, one small file per table
            body = json.loads(row["value"])
            tables.update(body if isinstance(body, dict) else {row["name"]: body})
        return cls.from_dict(tables)

    @classmethod
    def from_struct(cls, tables: dict[str, T.StructType]) -> "Contracts":
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "double": "FLOAT", "float": "FLOAT",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
        return cls(
            {
                t: [
                    Field(f.name, kinds.get(f.dataType.simpleString(), "STRING"), "NULLABLE" if f.nullable else "REQUIRED",
                          (f.metadata or {}).get("description", ""))
                    for f in s.fields
                ]
                for t, s in tables.items()
            }
        )

    def augmented(self, root_table: str) -> "Contracts":
        """Add the run stamp to every table and the record hash to the root table."""

        def extra(table):
            have = set(self.names(table))
            wanted = [RUN_STAMP] + ([CONTENT_HASH] if table == root_table else [])
            return [f for f in wanted if f.name not in have]

        return Contracts({t: fs + extra(t) for t, fs in self.tables.items()})

    def struct(self, table: str) -> T.StructType:
        """The stored schema (REQUIRED becomes not null, descriptions go to the metadata)."""
        parse = T.DataType.fromDDL
        return T.StructType(
            [
                T.StructField(f.name, parse(STORED_TYPE.get(f.type.upper(), "string")), not f.required,
                              {"description": f.description})
                for f in self.tables[table]
            ]
        )
