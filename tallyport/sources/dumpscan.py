"""Plain-text dumps: where each table's data block lies, and the statements around the blocks. Metadata only."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

HEADER_LIMIT = 1 << 20
ARCHIVE_MAGIC = b"PGDMP"


class ScanError(ValueError):
    """A dump that can't be scanned."""


class NotFound(ScanError):
    pass


class Duplicate(ScanError):
    pass


class MissingColumnList(ScanError):
    pass


class MalformedColumnList(ScanError):
    pass


class MissingTerminator(ScanError):
    pass


class NotPlainText(ScanError):
    pass


@dataclass(frozen=True)
class Block:
    """One table's data: its names, and byte offsets of the header, the rows, their end and what follows."""

    schema: str
    table: str
    columns: tuple[str, ...]
    header_start: int
    data_start: int
    data_end: int
    block_end: int


_IDENTIFIER = re.compile(r'"((?:[^"]|"")*)"|([A-Za-z0-9_]+)')
_COPY = re.compile(r"COPY\s+", re.IGNORECASE)
_TAIL = re.compile(r"\s*FROM\s+stdin\s*;?\s*", re.IGNORECASE)


def _identifier(text: str, at: int) -> tuple[str, int] | None:
    found = _IDENTIFIER.match(text, at)
    if not found or found.end() == at:
        return None
    name = found[1].replace('""', '"') if found[1] is not None else found[2]
    return name, found.end()


def column_list(text: str, at: int) -> tuple[tuple[str, ...], int]:
    """Names of a parenthesised list that begins at `at`; commas and brackets inside quotes belong to a name."""
    names: list[str] = []
    at += 1
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        if (found := _identifier(text, at)) is None:
            raise MalformedColumnList(f"no column name at {at} of {text.strip()!r}")
        names.append(found[0])
        at = found[1]
        while at < len(text) and text[at].isspace():
            at += 1
        if at >= len(text) or text[at] not in ",)":
            raise MalformedColumnList(f"neither comma nor bracket at {at} of {text.strip()!r}")
        at += 1
        if text[at - 1] == ")":
            return tuple(names), at


def parse_header(line: str) -> tuple[str, str, tuple[str, ...]] | None:
    """(schema, table, columns) of a data block's header line, or None if it is another line."""
    start = _COPY.match(line)
    first = _identifier(line, start.end()) if start else None
    if first is None:
        return None
    schema, table, at = "public", *first
    if at < len(line) and line[at] == ".":
        if (second := _identifier(line, at + 1)) is None:
            return None
        schema, table, at = table, *second
    while at < len(line) and line[at].isspace():
        at += 1
    if at >= len(line) or line[at] != "(":
        if _TAIL.fullmatch(line, at):
            raise MissingColumnList(f"{schema}.{table} has no column list")
        return None
    columns, at = column_list(line, at)
    return (schema, table, columns) if _TAIL.fullmatch(line, at) else None


def check_plain(file) -> None:  # noqa: ANN001
    file.seek(0)
    if file.read(len(ARCHIVE_MAGIC)) == ARCHIVE_MAGIC:
        raise NotPlainText("the file is a binary archive; make a plain-text dump")


_TERMINATOR = re.compile(rb"^\\\.(?:\r?\n|\Z)", re.MULTILINE)
_HEADER = re.compile(rb"^COPY[^\n]*(?:\n|\Z)", re.IGNORECASE | re.MULTILINE)
HEADER, END, ERROR = "header", "end", "error"


@dataclass(frozen=True)
class Event:
    """A header line, a line that ends a block, or why the scan can't go on; `at` and `after` are the line's offsets."""

    kind: str
    at: int
    after: int
    schema: str = ""
    table: str = ""
    columns: tuple[str, ...] = ()
    error: str = ""


def events(data: bytes, base: int, inside: bool) -> list[Event]:
    """What happens in a chunk that begins, at offset `base`, inside or outside of a block. A backslash and a dot end a block,
    with a carriage return only before a line end. Nothing that lies inside a block is looked at but its end."""
    out: list[Event] = []
    at = 0
    while True:
        found = (_TERMINATOR if inside else _HEADER).search(data, at)
        if found is None:
            return out
        at = found.end()
        here = (base + found.start(), base + found.end())
        if inside:
            out.append(Event(END, *here))
            inside = False
            continue
        try:
            if len(found[0]) > HEADER_LIMIT:
                raise ScanError(f"the header at byte {here[0]} is longer than {HEADER_LIMIT} bytes")
            head = parse_header(found[0].decode("utf-8", "replace"))
        except ScanError as error:
            return [*out, Event(ERROR, *here, error=f"{type(error).__name__}:{error}")]
        if head:
            out.append(Event(HEADER, *here, *head))
            inside = True


def joined(chunks: Iterable[tuple[list[Event], list[Event]]]) -> list[Block]:
    """Blocks from the events of each chunk, in order, if it begins outside and if it begins inside of a block. Chunks in
    which nothing happens either way can be left out."""
    out: list[Block] = []
    head: Event | None = None
    for outside, inside in chunks:
        for event in outside if head is None else inside:
            if event.kind == ERROR:
                name, _, text = event.error.partition(":")
                raise next((c for c in ScanError.__subclasses__() if c.__name__ == name), ScanError)(text)
            if event.kind == HEADER:
                head = event
            else:
                out.append(Block(head.schema, head.table, head.columns, head.at, head.after, event.at, event.after))
                head = None
    if head is not None:
        raise MissingTerminator(f"the rows of {head.schema}.{head.table} do not end")
    return out


def blocks(file) -> list[Block]:  # noqa: ANN001
    """All data blocks of an open file that fits into memory; `dumpsource.index` finds those of any."""
    check_plain(file)
    file.seek(0)
    data = file.read()
    return joined([(events(data, 0, False), [])])


def find_block(found: list[Block], schema: str, table: str) -> Block:
    same = [b for b in found if (b.schema, b.table) == (schema, table)]
    if not same:
        raise NotFound(f"no data of {schema}.{table}; there are {', '.join(sorted(f'{b.schema}.{b.table}' for b in found)) or 'no tables'}")
    if len(same) > 1:
        raise Duplicate(f"{schema}.{table} has {len(same)} data blocks")
    return same[0]


def statements_text(file, found: list[Block]) -> str:  # noqa: ANN001
    """Everything outside the blocks, of which nothing is read; must be UTF-8."""
    parts, at = [], 0
    for block in found:
        file.seek(at)
        parts.append(file.read(block.header_start - at))
        at = block.block_end
    file.seek(at)
    return b"".join([*parts, file.read()]).decode("utf-8")
