"""Column types from text: the type of each value by expression, and the fold of types in row order.

The fold is not commutative (5, 2.5, 1 is text; 1, 5, 2.5 is real), but it is associative as a map: a run of rows makes a
state of each state that came before. So runs are folded where they lie, and only their maps, a few bytes a column, are put
together in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.casts import shaped
from tallyport.functions.patterns import DATE_PATTERNS, ISO_TIMESTAMP, TIMESTAMP_PATTERNS
from tallyport.functions.types import SqlType, common_type

_WHOLE = r"^[+-]?\d+$"
_REAL = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def is_date(value: Column) -> Column:
    """A real date in one of the patterns."""
    return shaped(value, DATE_PATTERNS, F.try_to_date).isNotNull()


def is_timestamp(value: Column) -> Column:
    iso = F.when(F.regexp_like(value, F.lit(ISO_TIMESTAMP)), value.try_cast("timestamp_ntz"))
    return shaped(value, TIMESTAMP_PATTERNS, lambda v, p: F.try_to_timestamp(v, F.lit(p)).cast("timestamp_ntz"), iso).isNotNull()


def value_type(text: Column) -> Column:
    """The type name of a value; NULL (no vote) for NULL and blank. Unicode white space around a value does not count,
    and whole numbers beyond 64 bits are REAL."""
    value = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    number = F.when(F.length(value) <= 20, value.try_cast("bigint"))
    decimals = F.length(value) - F.instr(value, ".")
    real = F.when((F.length(value) - F.instr(F.lower(value), "e") < F.length(value)) | ((F.instr(value, ".") > 0) & (decimals > 7)), SqlType.DOUBLE.value).otherwise(SqlType.REAL.value)
    whole = (
        F.when(number.between(-32768, 32767), SqlType.SMALLINT.value)
        .when(number.between(-2147483648, 2147483647), SqlType.INTEGER.value)
        .when(number.isNotNull(), SqlType.BIGINT.value)
        .otherwise(SqlType.REAL.value)
    )
    return (
        F.when(value.isNull() | (value == ""), F.lit(None).cast("string"))
        .when(F.lower(value).isin("true", "false", "t", "f", "0", "1"), SqlType.BOOLEAN.value)
        .when(F.regexp_like(value, F.lit(_WHOLE)), whole)
        .when(F.regexp_like(value, F.lit(_REAL)), real)
        .when(is_date(value), SqlType.DATE.value)
        .when(is_timestamp(value), SqlType.TIMESTAMP.value)
        .otherwise(SqlType.TEXT.value)
    )


@dataclass(frozen=True)
class Inferred:
    name: str
    type: SqlType
    nullable: bool


#: The states of the fold: nothing seen yet, or one of the types.
STATES: tuple[SqlType | None, ...] = (None, *SqlType)
_AT = {t.value: i for i, t in enumerate(STATES) if t is not None}
_STEP = np.array([[STATES.index(b) if a is None or b is None else STATES.index(common_type(a, b)) for a in STATES] for b in STATES], np.int8)


def fold(types: list[str | None]) -> tuple[SqlType, bool]:
    """Promote value types in row order; nothing but NULLs is text."""
    out: SqlType | None = None
    for name in types:
        if name is not None:
            out = SqlType(name) if out is None else common_type(out, SqlType(name))
    return out or SqlType.TEXT, None in types


def run_map(codes: np.ndarray) -> np.ndarray:
    """What a run of types, as numbers of STATES without 0, makes of each state. Types that change no state any more are
    passed over at once, so the steps are as many as the lattice is high, however long the run."""
    states = np.arange(len(STATES), dtype=np.int8)
    while len(codes):
        changing = np.array([not np.array_equal(_STEP[c][states], states) for c in range(len(STATES))])
        at = np.flatnonzero(changing[codes])
        if not len(at):
            break
        states = _STEP[codes[at[0]]][states]
        codes = codes[at[0] + 1 :]
    return states


def run_maps(typed: DataFrame) -> DataFrame:
    """(run, part, maps, nulls, rows) of rows (run, at, types array), which are in order of `at` within a run: for each
    column the map of its types and whether one is NULL. A run that several partitions or batches hold gives several parts,
    told apart by their first `at`."""

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, ats = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            width = len(lists[0]) if batch.num_rows else 0
            codes = np.asarray(lists.flatten().fill_null(0)).reshape(-1, width) if batch.num_rows else np.zeros((0, 0), np.int8)
            borders = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
            rows = []
            for a, b in zip(borders, borders[1:], strict=False):
                if a == b:
                    continue
                order = a + np.argsort(ats[a:b], kind="stable")
                columns = [codes[order, c] for c in range(width)]
                found = [run_map(c[c > 0]).tolist() for c in columns]
                rows.append({"run": int(runs[a]), "part": int(ats[a:b].min()), "maps": found, "nulls": [bool((c == 0).any()) for c in columns], "rows": b - a})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("run", pa.int64()), ("part", pa.int64()), ("maps", pa.list_(pa.list_(pa.int8()))), ("nulls", pa.list_(pa.bool_())), ("rows", pa.int64())]))

    return typed.mapInArrow(maps, "run long, part long, maps array<array<tinyint>>, nulls array<boolean>, rows long")


def composed(parts: DataFrame) -> DataFrame:
    """(run, part, maps, nulls, rows): a thousand parts put together in order to one, by groups of that size."""
    numbered = parts.select((F.col("run") * 1).alias("run"), "part", "maps", "nulls", "rows")
    together = numbered.groupBy(F.floor(F.col("run") / 1000).alias("run")).agg(F.sort_array(F.collect_list(F.struct("run", "part", "maps", "nulls", "rows"))).alias("all"))
    step = lambda acc, x: F.struct(
        F.zip_with(acc["maps"], x["maps"], lambda a, b: F.transform(a, lambda s: F.get(b, s.cast("int")))).alias("maps"), F.zip_with(acc["nulls"], x["nulls"], lambda a, b: a | b).alias("nulls"), (acc["rows"] + x["rows"]).alias("rows")
    )
    first = F.struct(F.col("all")[0]["maps"].alias("maps"), F.col("all")[0]["nulls"].alias("nulls"), F.col("all")[0]["rows"].alias("rows"))
    whole = F.aggregate(F.slice("all", 2, 1_000_000), first, step)
    return together.select("run", F.col("all")[0]["part"].alias("part"), whole.alias("x")).select("run", "part", "x.*")


#: Columns whose types are found in compiled code.
FEW = 16


def infer_runs(rows: DataFrame, names: list[str], values: list[Column]) -> list[Inferred]:
    """Types of text columns `values` of rows (run, at, ...) by the fold over all rows, in order of run and at. Executors fold
    runs; no row comes to the driver. A run's rows must be in order within a partition, as a chunk's are."""
    codes = F.create_map(*(x for name, code in _AT.items() for x in (F.lit(name), F.lit(code).cast("tinyint"))))
    # Many columns in one function would be too much code to compile; a lambda is compiled once for all.
    types = F.array(*(codes[value_type(v)] for v in values)) if len(values) <= FEW else F.transform(F.array(*values), lambda v: codes[value_type(v)])
    typed = rows.select(F.col("run").cast("long").alias("run"), F.col("at").cast("long").alias("at"), types.alias("types"))
    parts = run_maps(typed)
    found = composed(parts).collect()
    state, nulls, total = [0] * len(names), [False] * len(names), 0
    for part in sorted(found, key=lambda r: (r.run, r.part)):
        state = [m[s] for m, s in zip(part.maps, state, strict=True)]
        nulls = [a or b for a, b in zip(nulls, part.nulls, strict=True)]
        total += part.rows
    if not total:
        raise ValueError("no rows to infer a schema from")
    return [Inferred(name, STATES[s] or SqlType.TEXT, n) for name, s, n in zip(names, state, nulls, strict=True)]


def infer(df: DataFrame, order: list[Column] | None = None) -> list[Inferred]:
    """Types of an all-text DataFrame by the fold over all its rows, which depends on their order: that of `order`, else the
    one in which they come. Ranges of the order are runs."""
    ordered = df.orderBy(*order) if order else df
    # The high bits of this number are the partition's, which the sort made of a range.
    place = F.monotonically_increasing_id()
    rows = ordered.select(F.spark_partition_id().alias("run"), place.alias("at"), *(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(df.columns)))
    return infer_runs(rows, df.columns, [F.col(f"v{i}") for i in range(len(df.columns))])


def ddl(table: str, columns: list[Inferred]) -> str:
    """CREATE TABLE text; NOT NULL where the sample had no NULL."""
    body = ", ".join(f'"{c.name}" {c.type.value}{"" if c.nullable else " NOT NULL"}' for c in columns)
    return f"CREATE TABLE IF NOT EXISTS {table} ({body})"
