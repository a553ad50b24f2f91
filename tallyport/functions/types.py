"""The closed set of column types: names, promotion, and the Spark type that carries each."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import types as T


class SqlType(Enum):
    BOOLEAN = "BOOLEAN"
    SMALLINT = "SMALLINT"
    INTEGER = "INTEGER"
    BIGINT = "BIGINT"
    REAL = "REAL"
    DOUBLE = "DOUBLE PRECISION"
    NUMERIC = "NUMERIC"
    TEXT = "TEXT"
    VARCHAR = "VARCHAR"
    CHAR = "CHAR"
    DATE = "DATE"
    TIMESTAMP = "TIMESTAMP"
    TIMESTAMPTZ = "TIMESTAMPTZ"
    TIME = "TIME"
    INTERVAL = "INTERVAL"
    UUID = "UUID"
    BYTEA = "BYTEA"
    JSON = "JSON"
    JSONB = "JSONB"


S = SqlType
INTS = (S.SMALLINT, S.INTEGER, S.BIGINT)
TEXTS = (S.TEXT, S.VARCHAR, S.CHAR)

#: Other names that a catalog or a dump uses; anything unknown is text.
ALIASES = {
    "bool": S.BOOLEAN, "int2": S.SMALLINT, "int": S.INTEGER, "int4": S.INTEGER, "int8": S.BIGINT, "float4": S.REAL, "float": S.REAL, "float8": S.DOUBLE,
    "double": S.DOUBLE, "decimal": S.NUMERIC, "character varying": S.VARCHAR, "string": S.TEXT, "character": S.CHAR, "bpchar": S.CHAR,
    "timestamp without time zone": S.TIMESTAMP, "timestamp_ntz": S.TIMESTAMP, "timestamp with time zone": S.TIMESTAMPTZ,
    "time without time zone": S.TIME, "tinyint": S.SMALLINT, "binary": S.BYTEA,
}


def parse_type(name: str) -> tuple[SqlType, tuple[int, ...]]:
    """A type name, with or without parameters, as the type and its parameters."""
    head, _, rest = name.strip().partition("(")
    inside, _, tail = rest.partition(")")
    base = " ".join((head + " " + tail).lower().split())
    known = {t.value.lower(): t for t in SqlType} | ALIASES
    parameters = tuple(int(x) for x in inside.split(",") if x.strip().isdigit())
    return known.get(base, S.TEXT), parameters


def common_type(a: SqlType, b: SqlType) -> SqlType:
    """The type that holds both, where the first seen comes first. Not Spark's widening: a boolean and a float give text."""
    if a is b:
        return a
    pair = {a, b}
    if S.BOOLEAN in pair:
        other = b if a is S.BOOLEAN else a
        return other if other in (*INTS, S.NUMERIC) else S.TEXT
    if pair <= set(INTS):
        return max(pair, key=INTS.index)
    for wide in (S.NUMERIC, S.REAL, S.DOUBLE):
        if wide in pair and pair - {wide} <= set(INTS):
            return wide
    if pair <= {S.NUMERIC, S.REAL, S.DOUBLE}:
        return S.DOUBLE
    if pair == {S.DATE, S.TIMESTAMP}:
        return S.TIMESTAMP
    if S.TIMESTAMPTZ in pair and pair <= {S.DATE, S.TIMESTAMP, S.TIMESTAMPTZ}:
        return S.TIMESTAMPTZ
    return S.TEXT


def spark_type(kind: SqlType, parameters: tuple[int, ...] = ()) -> T.DataType:
    if kind is S.NUMERIC:
        precision, scale = (*parameters, 0)[:2] if parameters else (38, 18)
        return T.DecimalType(precision, scale)
    return {
        S.BOOLEAN: T.BooleanType(), S.SMALLINT: T.ShortType(), S.INTEGER: T.IntegerType(), S.BIGINT: T.LongType(), S.REAL: T.FloatType(), S.DOUBLE: T.DoubleType(),
        S.DATE: T.DateType(), S.TIMESTAMP: T.TimestampNTZType(), S.TIMESTAMPTZ: T.TimestampType(), S.BYTEA: T.BinaryType(),
    }.get(kind, T.StringType())


def sql_type(kind: T.DataType) -> str:
    """The type name of a Spark column, with its parameters."""
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"nested type {kind.simpleString()} has no column type")
    names = {
        T.BooleanType: S.BOOLEAN, T.ByteType: S.SMALLINT, T.ShortType: S.SMALLINT, T.IntegerType: S.INTEGER, T.LongType: S.BIGINT, T.FloatType: S.REAL,
        T.DoubleType: S.DOUBLE, T.DateType: S.DATE, T.TimestampNTZType: S.TIMESTAMP, T.TimestampType: S.TIMESTAMPTZ, T.BinaryType: S.BYTEA,
    }
    return names.get(type(kind), S.TEXT).value
