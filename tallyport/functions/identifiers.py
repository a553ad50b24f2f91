"""Names: which are allowed, how they are quoted and shown, and small option parsers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Format characters that can make a name read as another.
FORMAT_RANGES = ((0x200B, 0x200F), (0x2028, 0x202E), (0x2066, 0x2069), (0xFEFF, 0xFEFF))
_FORMAT = "".join(f"{chr(a)}-{chr(b)}" for a, b in FORMAT_RANGES)
_CONTROL = "\\x00-\\x1F\\x7F-\\x9F"
_UNSAFE = re.compile(f'[{_CONTROL}"\\\\{_FORMAT}]')


def is_unsafe_char(char: str) -> bool:
    return bool(_UNSAFE.match(char))


def validate_identifier(name: str, what: str = "identifier") -> str:
    if not name:
        raise ValueError(f"{what} is empty")
    if found := _UNSAFE.search(name):
        raise ValueError(f"{what} contains U+{ord(found[0]):04X}")
    return name


def identifier_ok(name: Column) -> Column:
    """The same rule by expression."""
    return F.coalesce((name != "") & ~F.regexp_like(name, F.lit(f'[{_CONTROL}"\\\\{_FORMAT}]')), F.lit(False))


def check_listable(schema: str, table: str, columns: list[str]) -> None:
    for name in (schema, table, *columns):
        validate_identifier(name)
    for column in columns:
        if "," in column:
            raise ValueError(f"column name {column!r} contains a comma, which separates names in the list")


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def qualified(schema: str, table: str) -> str:
    return quote(table) if schema == "public" else f"{quote(schema)}.{quote(table)}"


def backtick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def escape_literal(text: str) -> str:
    return text.replace("'", "''")


def shown(text: str, most: int = 200) -> str:
    """Safe for a terminal: unsafe characters become `?`, long texts are cut."""
    cut = text if len(text) <= most else text[:most] + "..."
    return "".join("?" if is_unsafe_char(c) and c not in '"\\' else c for c in cut)


def shown_keys(keys: list[str]) -> str:
    return ", ".join("".join(f"\\u{{{ord(c):x}}}" if is_unsafe_char(c) or c == "," else c for c in key) for key in keys)


def parse_size(text: str) -> int:
    """`10MB` and the like, in binary units and whole numbers."""
    found = re.fullmatch(r"\s*(\d+)\s*([KMGT]?)(I?B)?\s*", text.upper())
    if not found:
        raise ValueError(f"not a size: {text!r}")
    return int(found[1]) << 10 * " KMGT".index(found[2] or " ")


def parse_names(text: str) -> list[str]:
    names = [x.strip() for x in text.split(",")]
    if "" in names:
        raise ValueError("empty column name in the list")
    if len(set(names)) < len(names):
        raise ValueError("a column is named twice")
    return names


def parse_mapping(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for pair in text.split(","):
        source, colon, target = (x.strip() for x in pair.partition(":"))
        if not colon or not source or not target or ":" in target:
            raise ValueError(f"not a source:target pair: {pair!r}")
        if source in out:
            raise ValueError(f"column {source!r} is mapped twice")
        out[source] = target
    if len(set(out.values())) < len(out):
        raise ValueError("two columns are mapped to one name")
    return out


def parse_char(text: str) -> str:
    """One character, or one of the escapes for backslash, tab, line end, return and quotes."""
    known = {"\\\\": "\\", "\\t": "\t", "\\n": "\n", "\\r": "\r", '\\"': '"', "\\'": "'"}
    char = known.get(text, text)
    if len(char) != 1 or ord(char) > 0x7F:
        raise ValueError(f"not a single-byte character: {text!r}")
    return char
