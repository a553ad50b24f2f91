"""A range of a text source as a Spark data source: one partition for each newline-aligned chunk. It reads the data blocks of
dumps line by line, and delimited files record by record, with chunks that are the same on every cluster.

The rows are (chunk_id, line_no, raw, fault): raw lines or records with everything that their line end leaves, so that
decoding, arity and NULLs are expressions that Catalyst sees. line_no counts from 1 within the chunk. A fault says why a
record can't be read: its bytes are no UTF-8, or its quotes do not close. A source is one file, or the files of a folder
put together in order of name.

Filters on chunk_id reach the source: chunks that they leave out are not opened. A resumed load and a sample use that. Spark
keeps the chosen chunks with the table that was read, so a table that was filtered is not read again without that filter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tallyport.functions import copytext
from tallyport.session import register, ship
from tallyport.sources import dumpscan, quotes
from tallyport.sources.files import CHUNK_BYTES, Joined, Place, chunk_count, nth_chunk

NAME = "tallyport_text"
SCHEMA = "chunk_id int, line_no long, raw string, fault string"
PUSH_DOWN = "spark.sql.python.filterPushdown.enabled"
#: Bytes of a record beyond which an open quote is taken for a stray one: the record is a fault, shown by its first line.
RECORD_LIMIT = 1 << 28
#: Bytes of a dump's line at most.
LINE_LIMIT = 1 << 30
NOT_UTF8 = "not valid UTF-8"
OPEN_QUOTE = "a quote that is not closed"
_SUMMARY = "chunk int, outside int, inside int, first long"


class _Part(InputPartition):
    def __init__(self, number: int, first: int | None = -1) -> None:
        #: Where the first record begins: -1 where the chunk does, None if none begins in it.
        self.number, self.first = number, first


def _batch(chunk: int, before: int, raw: list[bytes], lenient: bool, faults: dict[int, str]) -> pa.RecordBatch:
    """Lines of a dump take U+FFFD for bytes that are no UTF-8; a record with such bytes is a fault."""
    n = len(raw)
    try:
        texts = [r.decode("utf-8") for r in raw]
    except UnicodeDecodeError:
        texts = [r.decode("utf-8", "replace") for r in raw]
        if not lenient:
            for i, (r, t) in enumerate(zip(raw, texts, strict=True)):
                if "�" in t and t.encode() != r:
                    faults.setdefault(i, NOT_UTF8)
    said = pa.array([faults.get(i) for i in range(n)], pa.string()) if faults else pa.nulls(n, pa.string())
    return pa.RecordBatch.from_arrays([pa.array([chunk] * n, pa.int32()), pa.array(range(before + 1, before + n + 1), pa.int64()), pa.array(texts, pa.string()), said], names=["chunk_id", "line_no", "raw", "fault"])


def wanted_chunks(filters: list[Filter]) -> tuple[set[int] | None, list[Filter]]:
    """(chunks that filters on chunk_id leave, filters that are left to Spark)."""
    only: set[int] | None = None
    left: list[Filter] = []
    for f in filters:
        if isinstance(f, (EqualTo, In)) and f.attribute == ("chunk_id",):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            only = values if only is None else only & values
        else:
            left.append(f)
    return only, left


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.pieces = [tuple(p) for p in json.loads(options["pieces"])]
        self.scheme, self.start, self.end, self.target = options["scheme"], int(options["start"]), int(options["end"]), int(options["chunkbytes"])
        #: Delimiter, quote and escape of records; None to read lines.
        self.dialect: list[str | None] | None = json.loads(options["dialect"])
        self.begins: dict[str, int | None] = json.loads(options["begins"])
        self.only: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        self.only, left = wanted_chunks(filters)
        yield from left

    def partitions(self) -> list[_Part]:
        numbers = range(chunk_count(self.start, self.end, self.target))
        chosen = numbers if self.only is None else sorted(n for n in self.only if n in numbers)
        return [_Part(n, self.begins.get(str(n), -1)) for n in chosen] or [_Part(-1)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if partition.number < 0 or partition.first is None:
            return
        with Joined(self.scheme, self.pieces) as file:
            chunk = nth_chunk(file, self.start, self.end, self.target, partition.number)
            if self.dialect is None:
                yield from self._lines(file, chunk.start, chunk.end, partition.number)
            else:
                yield from self._records(file, chunk.start if partition.first < 0 else partition.first, chunk.end, partition.number)

    def _lines(self, file: Joined, start: int, end: int, chunk: int) -> Iterator[pa.RecordBatch]:
        file.seek(start)
        left, held, number = end - start, [], 0
        while left:
            block = file.read(min(1 << 20, left))
            if not block:
                raise EOFError(f"{left} bytes are missing")
            left -= len(block)
            whole, stop, rest = block.rpartition(b"\n")
            if not stop and left:
                held.append(block)
                continue
            # The end of the range ends its last line; a line end there begins no further one.
            lines = b"".join([*held, whole if stop else block]).split(b"\n")
            held = [rest] if rest else []
            if not left and rest and stop:
                lines.append(rest)
            yield _batch(chunk, number, lines, True, {})
            number += len(lines)

    def _records(self, file: Joined, start: int, end: int, chunk: int) -> Iterator[pa.RecordBatch]:
        """The records that begin in [start, end); the last of them may end behind it."""
        grammar = quotes.records(*self.dialect)
        file.seek(start)
        data = file.read(end - start) if end > start else b""
        number, at, raw, size = 0, 0, [], 0
        for stop in grammar.ends(data):
            raw.append(data[at:stop])
            at, size = stop, size + stop - at
            if size > 1 << 20:
                yield self._made(chunk, number, raw, {})
                number, raw, size = number + len(raw), [], 0
        if at < len(data):
            # Quotes are open at the chunk's end: read on until they close.
            last, position = data[at:], end
            del data
            stop = None
            while position < self.end and len(last) <= RECORD_LIMIT:
                more = file.read(min(max(1 << 20, len(last)), self.end - position))
                position += len(more)
                last += more
                stop = grammar.end(last, 0)
                # The end of what was read so far only looks like the end of a record.
                if stop is not None and (stop < len(last) or last.endswith(b"\n") or position >= self.end):
                    break
                stop = None
            raw.append(last[:stop] if stop is not None else last.partition(b"\n")[0])
            yield self._made(chunk, number, raw, {} if stop is not None else {len(raw) - 1: OPEN_QUOTE})
        elif raw:
            yield self._made(chunk, number, raw, {})

    def _made(self, chunk: int, number: int, raw: list[bytes], faults: dict[int, str]) -> pa.RecordBatch:
        bare = [r[:-2] if r.endswith(b"\r\n") else r[:-1] if r.endswith((b"\n", b"\r")) else r for r in raw]
        return _batch(chunk, number, bare, False, faults)


class TextSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:  # noqa: ANN001
        return _Reader(dict(self.options))


def _read(spark: SparkSession, place: Place, start: int, end: int, chunk_bytes: int, dialect: tuple[str, str, str | None] | None, begins: dict[int, int | None]) -> DataFrame:
    ship(spark)
    spark.conf.set(PUSH_DOWN, "true")
    register(spark, TextSource)
    if start >= end:
        return spark.createDataFrame([], SCHEMA)
    options = {"pieces": json.dumps(place.pieces()), "scheme": place.source.scheme, "start": start, "end": end, "chunkbytes": chunk_bytes, "dialect": json.dumps(dialect), "begins": json.dumps(begins)}
    return spark.read.format(NAME).options(**options).load()


def raw_lines(spark: SparkSession, path: str, start: int, end: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The lines of bytes [start, end) of a source."""
    return _read(spark, Place.of(path), start, end, chunk_bytes, None, {}).drop("fault")


def quote_states(spark: SparkSession, path: str, start: int, end: int, dialect: tuple[str, str, str | None], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, outside, inside, first) of each chunk of a delimited source: how it ends if it begins outside and inside
    quotes, and where its first record begins in the latter case. Executors read the chunks."""
    ship(spark)
    place = Place.of(path)
    pieces, scheme = place.pieces(), place.source.scheme

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = quotes.records(*dialect)
        with Joined(scheme, pieces) as file:
            for batch in batches:
                rows = []
                for number in batch.column(0).to_pylist():
                    chunk = nth_chunk(file, start, end, chunk_bytes, number)
                    file.seek(chunk.start)
                    s = grammar.summary(number, file.read(chunk.end - chunk.start) if chunk.end > chunk.start else b"")
                    rows.append({"chunk": s.chunk, "outside": s.outside, "inside": s.inside, "first": None if s.first is None else chunk.start + s.first})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("chunk", pa.int32()), ("outside", pa.int32()), ("inside", pa.int32()), ("first", pa.int64())]))

    count = chunk_count(start, end, chunk_bytes)
    return spark.range(0, count, 1, max(1, min(count, 100_000))).mapInArrow(summaries, _SUMMARY)


def record_begins(spark: SparkSession, path: str, start: int, end: int, dialect: tuple[str, str, str | None], chunk_bytes: int = CHUNK_BYTES) -> dict[int, int | None]:
    """Of the chunks that begin inside quotes, where their first record begins. A pass of its own over the source; of what it
    finds one small row a chunk, as many as there will be partitions, is put together here."""
    states = quote_states(spark, path, start, end, dialect, chunk_bytes).collect() if end > start else []
    return quotes.begins(quotes.Summary(*r) for r in sorted(states))[0]


def raw_records(spark: SparkSession, path: str, start: int, end: int, dialect: tuple[str, str, str | None], chunk_bytes: int = CHUNK_BYTES, begins: dict[int, int | None] | None = None) -> DataFrame:
    """The records of bytes [start, end) of a delimited source; `begins` as above, if it is known."""
    if begins is None:
        begins = record_begins(spark, path, start, end, dialect, chunk_bytes)
    return _read(spark, Place.of(path), start, end, chunk_bytes, dialect, begins)


def index(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> list[dumpscan.Block]:
    """All data blocks of a dump. Executors read its chunks and say what happens in each if it begins outside and if it begins
    inside of a block; put together in order that gives the blocks. Chunks in which nothing happens say nothing."""
    ship(spark)
    place = Place.of(path)
    pieces, scheme = place.pieces(), place.source.scheme
    with Joined(scheme, pieces) as file:
        dumpscan.check_plain(file)
        end = file.size()
    count = chunk_count(0, end, chunk_bytes)

    def happenings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Joined(scheme, pieces) as file:
            for batch in batches:
                rows = []
                for number in batch.column(0).to_pylist():
                    chunk = nth_chunk(file, 0, end, chunk_bytes, number)
                    if chunk.end == chunk.start:
                        continue
                    if chunk.end - chunk.start > LINE_LIMIT + chunk_bytes:
                        raise dumpscan.ScanError(f"a line after byte {chunk.start} is longer than {LINE_LIMIT} bytes")
                    file.seek(chunk.start)
                    data = file.read(chunk.end - chunk.start)
                    both = [[asdict(e) for e in dumpscan.events(data, chunk.start, inside)] for inside in (False, True)]
                    if both != [[], []]:
                        rows.append({"chunk": number, "events": json.dumps(both)})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("chunk", pa.int32()), ("events", pa.string())]))

    found = spark.range(0, count, 1, max(1, min(count, 100_000))).mapInArrow(happenings, "chunk int, events string").collect()
    of = lambda e: dumpscan.Event(**(e | {"columns": tuple(e["columns"])}))
    return dumpscan.joined([[[of(e) for e in side] for side in json.loads(r.events)] for r in sorted(found)])


def scan(lines: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(chunk_id, line_no, good, raw, columns as nullable text). Blank lines and wrong widths are not good."""
    # A table without columns has empty lines.
    return copytext.decoded(lines.select("chunk_id", "line_no", "raw"), "raw", columns)
