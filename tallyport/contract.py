"""What a table promises beyond its Spark schema: keys, defaults, identity, parameterised types. Kept as JSON beside it."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyport.functions.types import parse_type, spark_type, sql_type


_UNIQUE = re.compile(r"\s*CREATE\s+UNIQUE\s+INDEX\b[^(]*\(([^()]*)\)(?:\s+INCLUDE\s*\([^()]*\))?\s*;?\s*$", re.IGNORECASE | re.DOTALL)


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type_name: str
    nullable: bool = True
    default: str | None = None
    identity: bool = False
    identity_cache: int = 1
    generated: bool = False


@dataclass(frozen=True)
class TableContract:
    schema: str
    table: str
    columns: tuple[ColumnContract, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    indexes: dict[str, str] = field(default_factory=dict)
    checks: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type_name for c in self.columns}

    @property
    def keys(self) -> list[str]:
        """The primary key, else the first unique constraint: one key, stated, never several run together."""
        return list(self.primary_key or (self.unique[0] if self.unique else ()))

    @property
    def all_keys(self) -> list[list[str]]:
        """The primary key, the unique constraints and the unique indexes over plain columns, each once."""
        found = [list(k) for k in (self.primary_key, *self.unique) if k]
        for statement in self.indexes.values():
            named = _UNIQUE.match(statement)
            columns = [c.strip().strip('"') for c in named[1].split(",")] if named else []
            # An index over an expression, or of a part of the rows, is no key of whole columns.
            if columns and all(c in self.names for c in columns):
                found.append(columns)
        return [k for i, k in enumerate(found) if sorted(k) not in [sorted(x) for x in found[:i]]]

    @property
    def defaults(self) -> dict[str, str]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(*parse_type(c.type_name)), c.nullable) for c in self.columns])

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> TableContract:
        raw = json.loads(text)
        columns = tuple(ColumnContract(**c) for c in raw.pop("columns"))
        for name in ("primary_key", "checks"):
            raw[name] = tuple(raw[name])
        raw["unique"] = tuple(map(tuple, raw["unique"]))
        return cls(columns=columns, **raw)

    @classmethod
    def of(cls, df: DataFrame, schema: str, table: str, primary_key: tuple[str, ...] = ()) -> TableContract:
        columns = tuple(ColumnContract(f.name, sql_type(f.dataType), f.nullable and f.name not in primary_key) for f in df.schema.fields)
        return cls(schema, table, columns, primary_key)
