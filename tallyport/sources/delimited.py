"""CSV and TSV scans as all-text DataFrames, with the records that do not parse kept apart."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions.nulls import blank_to_null
from tallyport.sources import dumpsource, quotes
from tallyport.sources.files import CHUNK_BYTES, Place

BAD = "_bad_record"
WIDTH = "not a record of the table's width"
#: Bytes of a source's first record at most.
HEADER_LIMIT = 1 << 24


@dataclass(frozen=True)
class Dialect:
    """`multiline` has Spark's own reader read each file in one piece; without it records may span lines just as well, and a
    file is read by chunks."""

    delimiter: str = ","
    header: bool = False
    quote: str = '"'
    escape: str | None = None
    multiline: bool = False

    def with_(self, **changes: object) -> Dialect:
        return replace(self, **changes)

    @property
    def marks(self) -> tuple[str, str, str | None]:
        return self.delimiter, self.quote, self.escape


CSV = Dialect()
TSV = Dialect(delimiter="\t")


def _reader(spark: SparkSession, dialect: Dialect):  # noqa: ANN202
    # Without an escape character quotes are doubled, which Spark reads with the quote as its own escape.
    return (
        spark.read.option("sep", dialect.delimiter).option("header", dialect.header).option("quote", dialect.quote).option("escape", dialect.escape or dialect.quote)
        .option("multiLine", dialect.multiline).option("mode", "PERMISSIVE").option("enforceSchema", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    )


def _names(values: list[str | None], header: bool) -> list[str]:
    names = [v if header and v is not None else f"column_{i}" for i, v in enumerate(values, 1)]
    return [n if names.index(n) == i else f"{n}_{i + 1}" for i, n in enumerate(names)]


def column_names(spark: SparkSession, path: str, dialect: Dialect = CSV) -> list[str]:
    """Header names (one that comes again with its place behind it), or column_1 to column_n by the first record's width."""
    first = _reader(spark, dialect.with_(header=False)).csv(path).limit(1)
    row = first.first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return _names(list(row), dialect.header)


@dataclass(frozen=True)
class Head:
    """A source's column names, and the bytes [start, end) of its records."""

    columns: list[str]
    start: int
    end: int


def head(uri: str, dialect: Dialect = CSV) -> Head:
    """From the first record, which is all that is read. A record may span lines."""
    grammar = quotes.records(*dialect.marks)
    with Place.of(uri).open() as file:
        size, data, end = file.size(), b"", None
        while end is None and len(data) < min(size, HEADER_LIMIT):
            data += file.read(1 << 16)
            # Empty lines are no records.
            at = len(data) - len(data.lstrip(b"\r\n"))
            end = grammar.end(data, at) if at < len(data) else None
            if end == len(data) and not data.endswith(b"\n") and len(data) < size:
                end = None
    if end is None:
        raise ValueError(f"{uri} is empty" if not data.strip(b"\r\n") else f"the first record of {uri} does not end")
    text = data[at:end].decode("utf-8", "replace").rstrip("\r\n")
    fields = next(csv.reader([text], delimiter=dialect.delimiter, quotechar=dialect.quote, escapechar=dialect.escape if dialect.escape != dialect.quote else None, doublequote=True), [""])
    return Head(_names([f if f.strip() else None for f in fields], dialect.header), end if dialect.header else 0, size)


def scan(spark: SparkSession, path: str, dialect: Dialect = CSV, columns: list[str] | None = None) -> DataFrame:
    """All columns as text with the blank rule applied, and BAD: the raw record if its width is wrong, else NULL. Spark's own
    reader: a record is a line unless the dialect has `multiline`."""
    columns = columns or column_names(spark, path, dialect)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField(BAD, T.StringType())])
    raw = _reader(spark, dialect).schema(schema).option("columnNameOfCorruptRecord", BAD).csv(path)
    return raw.select(*(blank_to_null(F.col(f"`{c}`")).alias(c) for c in columns), BAD)


def fields(width: int) -> list[str]:
    """Names of a packed row's fields: by place, so that no name of a source's column is in the way of another."""
    return [f"f{i}" for i in range(width)]


def packed(lines: DataFrame, width: int, dialect: Dialect = CSV) -> DataFrame:
    """(chunk_id, line_no, raw[, fault]) records to (chunk_id, line_no, fault, raw, row): `row` has the fields as text, with
    the blank rule applied; `fault` says why a record is none of `width` fields. Empty lines are no records."""
    options = {"sep": dialect.delimiter, "quote": dialect.quote, "escape": dialect.escape or dialect.quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    bare = F.when(F.endswith("raw", F.lit("\r")), F.left("raw", F.length("raw") - 1)).otherwise(F.col("raw"))
    schema = ", ".join(f"{c} string" for c in [*fields(width), "bad"])
    quote, opens = dialect.quote, f"(^|{re.escape(dialect.delimiter)}){re.escape(dialect.quote)}"
    odd = (F.length("raw") - F.length(F.replace("raw", F.lit(quote), F.lit("")))) % 2 == 1
    # Of lines that were not read as records nothing else says that their quotes do not close.
    known = F.col("fault") if "fault" in lines.columns else F.when(odd & F.regexp_like("raw", F.lit(opens)), F.lit(dumpsource.OPEN_QUOTE))
    # A generator, so that a record is parsed once and not for each of its columns.
    once = lines.where(bare != "").select("chunk_id", "line_no", "raw", known.alias("known"), F.explode(F.array(F.from_csv(bare, schema, options))).alias("x"))
    fault = F.coalesce("known", F.when(F.col("x.bad").isNotNull(), F.lit(WIDTH)))
    return once.select("chunk_id", "line_no", fault.alias("fault"), "raw", F.struct(*(blank_to_null(F.col(f"x.{c}")).alias(c) for c in fields(width))).alias("row"))


def parsed(lines: DataFrame, columns: list[str], dialect: Dialect = CSV) -> DataFrame:
    """`packed` with the fields under the names of `columns` and `good` for whether there is no fault."""
    rows = packed(lines, len(columns), dialect)
    return rows.select("chunk_id", "line_no", F.col("fault").isNull().alias("good"), "raw", *(F.col(f"row.{f}").alias(c) for f, c in zip(fields(len(columns)), columns, strict=True)))


def records(spark: SparkSession, uri: str, dialect: Dialect = CSV, chunk_bytes: int = CHUNK_BYTES, begins: dict[int, int | None] | None = None) -> tuple[Head, DataFrame, dict[int, int | None]]:
    """A source's head, its records as `packed` rows, by chunks, and where the records of chunks begin that begin inside quotes;
    with those given the source is not read for them. Records may span lines."""
    found = head(uri, dialect)
    if begins is None:
        begins = dumpsource.record_begins(spark, uri, found.start, found.end, dialect.marks, chunk_bytes)
    raw = dumpsource.raw_records(spark, uri, found.start, found.end, dialect.marks, chunk_bytes, begins)
    return found, packed(raw, len(found.columns), dialect), begins


def split_bad(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records with what was read of them). A query on BAD alone would not parse the other columns, so
    both sides keep a reference to all of them."""
    parsed = scanned.where(F.hash(*(F.col(f"`{c}`") for c in scanned.columns)).isNotNull())
    return parsed.where(F.col(BAD).isNull()).drop(BAD), parsed.where(F.col(BAD).isNotNull())
