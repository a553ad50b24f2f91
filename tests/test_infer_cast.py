import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyport.functions import infer
from tallyport.functions.casts import failed, recast
from tallyport.functions.types import SqlType, common_type, parse_type

VALUES = {
    "42": "SMALLINT", "100000": "INTEGER", "9999999999": "BIGINT", "3.14": "REAL", "3.141592653589": "DOUBLE PRECISION", "1e5": "DOUBLE PRECISION", "true": "BOOLEAN", "F": "BOOLEAN",
    "0": "BOOLEAN", "hello": "TEXT", "2025-12-03": "DATE", "2024-02-29": "DATE", "2025-02-29": "TEXT", "2025-13-01": "TEXT", "12/31/2024": "DATE", "31/12/2024": "DATE",
    "2024-01-02 03:04:05": "TIMESTAMP", "2024-01-02T03:04:05.123": "TIMESTAMP", "2024-01-02 03:04": "TIMESTAMP", "http://a/b": "TEXT", "12:30": "TEXT", "": None, "  ": None,
    "99999999999999999999": "REAL", "1\t": "BOOLEAN", "\u00a07 ": "SMALLINT", "1/5/2024": "DATE", "31/04/2024": "TEXT", "nan": "REAL", "-Inf": "REAL", ".5": "REAL", "5.": "REAL", "+3": "SMALLINT", "1e": "TEXT", "13/12/2024 01:02:03": "TIMESTAMP",
}


def test_value_types(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    assert {r.v: r.t for r in df.select("v", infer.value_type(F.col("v")).alias("t")).collect()} == VALUES


def test_fold_depends_on_order():
    small, real, boolean = "SMALLINT", "REAL", "BOOLEAN"
    assert infer.fold([small, real, boolean])[0] is SqlType.TEXT
    assert infer.fold([boolean, small, real])[0] is SqlType.REAL
    assert infer.fold([None, None]) == (SqlType.TEXT, True)


def test_common_type_is_symmetric():
    for a in SqlType:
        for b in SqlType:
            assert common_type(a, b) is common_type(b, a)
    assert common_type(SqlType.BOOLEAN, SqlType.REAL) is SqlType.TEXT
    assert common_type(SqlType.BIGINT, SqlType.REAL) is SqlType.REAL
    assert common_type(SqlType.NUMERIC, SqlType.REAL) is SqlType.DOUBLE


def test_infer_columns_and_ddl(spark):
    df = spark.createDataFrame([(1, "1", None), (2, "70000", "x")], "i int, a string, b string")
    found = infer.infer(df.orderBy("i").select("a", "b"))
    assert [(c.name, c.type, c.nullable) for c in found] == [("a", SqlType.INTEGER, False), ("b", SqlType.TEXT, True)]
    assert infer.ddl("t", found) == 'CREATE TABLE IF NOT EXISTS t ("a" INTEGER NOT NULL, "b" TEXT)'
    with pytest.raises(ValueError):
        infer.infer(df.limit(0).select("a"))


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("t", "boolean", True), ("off", "boolean", False), ("maybe", "boolean", None), ("40000", "smallint", None), ("1.005", "numeric(10,2)", Decimal("1.01")), ("2.675", "numeric(10,2)", Decimal("2.68")),
        ("12/31/2024", "date", datetime.date(2024, 12, 31)), ("1234", "date", None), ("13/12/2024", "date", datetime.date(2024, 12, 13)), ("2024-01-02 03:04:05", "date", datetime.date(2024, 1, 2)), ("12/31/2024 01:02:03", "timestamp", datetime.datetime(2024, 12, 31, 1, 2, 3)),
        ("2024-01-02T03:04", "timestamp", datetime.datetime(2024, 1, 2, 3, 4)), ("word", "timestamp", None), ("2024-01-02 00:00:00.6", "timestamp(0)", datetime.datetime(2024, 1, 2, 0, 0, 1)),
        ("2024-01-02 00:00:00.123456", "timestamp(3)", datetime.datetime(2024, 1, 2, 0, 0, 0, 123000)), ("1969-12-31 23:59:59.99995", "timestamp(4)", datetime.datetime(1970, 1, 1)),
        ("2024-01-02 00:00:00.15", "timestamp(1)", datetime.datetime(2024, 1, 2, 0, 0, 0, 200000)), ("abc", "varchar(2)", None), ("ab", "char(3)", "ab "), (r"\x4142", "bytea", b"AB"), ("{A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11}", "uuid", "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"),
        ('{"b":1,"a":2}', "jsonb", '{"a":2,"b":1}'), ('{"b": 1}', "json", '{"b": 1}'), ("{", "json", None), ("x", "nothing known", "x"),
    ],
)
def test_recast(spark, text, kind, value):
    row = spark.createDataFrame([(text,)], "v string").select(recast(F.col("v"), kind).alias("c"), failed(F.col("v"), recast(F.col("v"), kind)).alias("f")).first()
    got = bytes(row.c) if isinstance(row.c, bytearray) else row.c
    assert got == value
    assert row.f == (value is None)


def test_parse_type():
    assert parse_type("numeric(10, 2)") == (SqlType.NUMERIC, (10, 2))
    assert parse_type("timestamp(3) without time zone") == (SqlType.TIMESTAMP, (3,))
    assert parse_type("geometry") == (SqlType.TEXT, ())
