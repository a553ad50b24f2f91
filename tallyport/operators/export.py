"""Tables as dump text: row lines by expression, headers and DDL from the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions import copytext
from tallyport.functions.identifiers import escape_literal, qualified, quote
from tallyport.functions.render import render
from tallyport.functions.types import SqlType, parse_type
from tallyport.contract import ColumnContract, TableContract


def cell_text(value: Column, kind, type_name: str) -> Column:  # noqa: ANN001
    """A cell as the text that loads it again."""
    if parse_type(type_name)[0] is SqlType.BYTEA:
        return F.concat(F.lit("\\x"), F.lower(F.hex(value)))
    return render(value, kind)


def row_lines(df: DataFrame, contract: TableContract) -> DataFrame:
    """(line) of each row, in key order if there is a key."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ordered = df.orderBy(*(F.col(f"`{k}`") for k in contract.primary_key)) if contract.primary_key else df
    return ordered.select(copytext.encode_line(*(cell_text(F.col(f"`{c.name}`"), kinds[c.name], c.type_name) for c in contract.columns)).alias("line"))


def copy_header(contract: TableContract) -> str:
    names = ", ".join(quote(c.name) for c in contract.columns)
    return f"COPY {qualified(contract.schema, contract.table)} ({names}) FROM stdin;"


def column_line(column: ColumnContract) -> str:
    parts = [quote(column.name), column.type_name]
    if column.identity:
        parts.append(f"GENERATED BY DEFAULT AS IDENTITY (CACHE {column.identity_cache})")
    elif column.default is not None:
        parts.append(f"DEFAULT {column.default}")
    if not column.nullable:
        parts.append("NOT NULL")
    return " ".join(parts)


def table_ddl(contract: TableContract) -> str:
    if contract.checks:
        raise ValueError(f"{contract.table} has CHECK constraints, which can't be exported")
    for column in contract.columns:
        if column.generated:
            raise ValueError(f"{contract.table}.{column.name} is a generated column, which can't be exported")
    lines = [column_line(c) for c in contract.columns]
    if contract.primary_key:
        lines.append(f"PRIMARY KEY ({', '.join(map(quote, contract.primary_key))})")
    body = ",\n    ".join(lines)
    return f"CREATE TABLE {qualified(contract.schema, contract.table)} (\n    {body}\n);"


def index_lines(contract: TableContract) -> list[str]:
    """Index statements in order of name; the primary key's own is made by its constraint."""
    return [sql.rstrip(";") + ";" for name, sql in sorted(contract.indexes.items()) if name != f"{contract.table}_pkey"]


def identity_setval(contract: TableContract, df: DataFrame) -> str | None:
    """Statement that sets the sequence behind an identity column to the greatest id; None for an empty table."""
    column = next((c for c in contract.columns if c.identity), None)
    if column is None:
        return None
    most = df.agg(F.max(f"`{column.name}`")).first()[0]
    literal = escape_literal(qualified(contract.schema, contract.table))
    return None if most is None else f"SELECT pg_catalog.setval(pg_get_serial_sequence('{literal}', '{escape_literal(column.name)}'), {most}, true);"


def document_parts(contract: TableContract, df: DataFrame) -> tuple[str, DataFrame, str]:
    """(text before the rows, row lines, text after them) of one table."""
    before = "\n".join([table_ddl(contract), *index_lines(contract), "", copy_header(contract)]) + "\n"
    setval = identity_setval(contract, df)
    return before, row_lines(df, contract), "\\.\n\n" + (setval + "\n\n" if setval else "")
