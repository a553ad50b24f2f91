"""Parquet scans: native types, the blank rule on text, exact row counts from the footers, and chunks of row groups.

`scan` is Spark's own vectorised reader. `chunked` reads with a chunk and a line number for each row: executors read the
footers, row groups are packed into chunks, and each chunk is one partition of a data source that opens its file, reads
its row groups as Arrow batches and closes it. So no row is joined to find its chunk, no file name is compared, and a
filter on chunk_id leaves files shut.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tallyport.functions.nulls import blank_to_null
from tallyport.functions.types import sql_type
from tallyport.session import register, ship
from tallyport.sources.delimited import fields
from tallyport.sources.dumpsource import PUSH_DOWN, wanted_chunks
from tallyport.sources.files import CHUNK_BYTES, Place, file_system, row_group_chunks

NAME = "tallyport_row_groups"
_FOOTER = "file int, start int, stop int, rows long"
#: Rows of an Arrow batch.
_ROWS = 10_000


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, extra: list[Column] | None = None) -> DataFrame:
    """The file's columns with their types, and `extra` ones; blank text is NULL. Nested columns are refused."""
    found = spark.read.parquet(path)
    for field in found.schema.fields:
        sql_type(field.dataType)
    chosen = columns or found.columns
    kinds = {f.name: f.dataType for f in found.schema.fields}
    return found.select(*(blank_to_null(F.col(f"`{c}`")).alias(c) if isinstance(kinds[c], T.StringType) else F.col(f"`{c}`") for c in chosen), *(extra or []))


def chunk_plan(spark: SparkSession, place: Place, target: int = CHUNK_BYTES) -> list[tuple[str, int, int, int]]:
    """(path, first row group, row group after the last, rows) of each chunk, in order of file name. Executors read the
    footers; what comes back is as much as there will be partitions."""
    paths, scheme = place.files(), place.source.scheme

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = file_system(scheme)
        for batch in batches:
            out = []
            for number, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(path) as file:
                    groups = row_groups(file)
                out += [{"file": number, "start": c.start, "stop": c.end, "rows": sum(n for n, _ in groups[c.start : c.end])} for c in row_group_chunks([size for _, size in groups], target)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("file", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("rows", pa.int64())]))

    if not paths:
        return []
    ship(spark)
    listed = spark.createDataFrame(list(enumerate(paths)), "file int, path string").repartition(max(1, min(len(paths), 1000)), "file")
    return [(paths[r.file], r.start, r.stop, r.rows) for r in sorted(listed.mapInArrow(footers, _FOOTER).collect())]


class _Part(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.scheme, self.chunks, self.only = options["scheme"], json.loads(options["chunks"]), None
        self.names: list[str] = json.loads(options["names"])
        self.row = to_arrow_schema(schema["row"].dataType)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        self.only, left = wanted_chunks(filters)
        yield from left

    def partitions(self) -> list[_Part]:
        numbers = range(len(self.chunks))
        return [_Part(n) for n in (numbers if self.only is None else sorted(n for n in self.only if n in numbers))] or [_Part(-1)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if partition.number < 0:
            return
        path, start, stop, _ = self.chunks[partition.number]
        line = 1
        with file_system(self.scheme).open_input_file(path) as opened:
            file = pq.ParquetFile(opened)
            there = set(file.schema_arrow.names)
            for batch in file.iter_batches(_ROWS, row_groups=list(range(start, stop)), columns=[n for n in self.names if n in there]):
                n = batch.num_rows
                # A column that this file does not have is NULL, as in Spark's own reader.
                cells = [_cast(batch.column(name), kind.type) if name in there else pa.nulls(n, kind.type) for name, kind in zip(self.names, self.row, strict=True)]
                row = pa.StructArray.from_arrays(cells, fields=list(self.row))
                yield pa.RecordBatch.from_arrays([pa.array([partition.number] * n, pa.int32()), pa.array(range(line, line + n), pa.int64()), row], names=["chunk_id", "line_no", "row"])
                line += n


def _cast(array: pa.Array, kind: pa.DataType) -> pa.Array:
    if pa.types.is_dictionary(array.type):
        array = array.dictionary_decode()
    if array.type == kind:
        return array
    if pa.types.is_unsigned_integer(array.type) and pa.types.is_decimal(kind):
        return array.cast(pa.decimal128(20, 0)).cast(kind)
    return array.cast(kind, safe=not pa.types.is_timestamp(kind))


class RowGroups(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        raise ValueError("read with a schema")

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(schema, dict(self.options))


def chunked(spark: SparkSession, uri: str, target: int = CHUNK_BYTES) -> tuple[DataFrame, T.StructType, int, int]:
    """(rows, schema, number of chunks, number of rows by the footers) of a file or of a folder's files. A row is (chunk_id,
    line_no, row): `row` has the columns under names by place, with the blank rule applied. Chunks are runs of row groups of
    about `target` bytes, the same on every cluster; lines are counted within a chunk. Names of folders are no data."""
    place = Place.of(uri)
    plan = chunk_plan(spark, place, target)
    found = spark.read.option("recursiveFileLookup", "true").parquet(place.for_spark).schema
    for field in found.fields:
        sql_type(field.dataType)
    names = fields(len(found))
    row = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, found.fields, strict=True)])
    spark.conf.set(PUSH_DOWN, "true")
    register(spark, RowGroups)
    schema = T.StructType().add("chunk_id", T.IntegerType()).add("line_no", T.LongType()).add("row", row)
    read = spark.read.format(NAME).schema(schema).options(scheme=place.source.scheme, chunks=json.dumps(plan), names=json.dumps(found.names)).load()
    cells = [blank_to_null(F.col(f"row.{f.name}")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"row.{f.name}").alias(f.name) for f in row.fields]
    rows = read.select("chunk_id", "line_no", F.struct(*cells).alias("row")) if cells else read
    return rows, found, len(plan), sum(n for *_, n in plan)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows by the footers alone."""
    return spark.read.parquet(path).count()


def row_groups(file) -> list[tuple[int, int]]:  # noqa: ANN001
    """(rows, bytes) of each row group of an open file."""
    meta = pq.ParquetFile(file).metadata
    return [(meta.row_group(i).num_rows, meta.row_group(i).total_byte_size) for i in range(meta.num_row_groups)]
