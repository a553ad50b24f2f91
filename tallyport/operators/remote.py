"""Loading a database: each batch goes in with its line of a ledger in one transaction, and what may be tried again.

A task that runs twice, a connection that breaks while it commits and a job that is started again all meet the ledger, so each
batch goes in once. Tasks reach the database by a connection of Python's database API (PEP 249), opened where it is used.
"""

from __future__ import annotations

import datetime
import decimal
import importlib
import random
import sqlite3
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.contract import TableContract
from tallyport.functions.casts import recast
from tallyport.functions.identifiers import qualified, quote
from tallyport.operators import export
from tallyport.operators.sink import OnConflict
from tallyport.session import ship

#: Attempts, first and longest pause, statement time-out.
ATTEMPTS = 5
FIRST_PAUSE_S = 1.0
LONGEST_PAUSE_S = 30.0
TIMEOUT_S = 180
#: Classes and codes of errors that may pass by themselves, and texts of those without a code.
TRANSIENT_CLASSES = ("08", "53", "57")
TRANSIENT_STATES = frozenset({"40001", "40P01", "42001", "OC000", "OC001"})
TRANSIENT_TEXTS = ("timed out", "server unavailable", "transaction age limit", "Connection reset")


def pause(attempt: int, draw: Callable[[], float] = random.random) -> float:
    """Seconds before attempt 1, 2, ...: doubling, a quarter up or down, never above the longest."""
    return min(LONGEST_PAUSE_S, FIRST_PAUSE_S * 2 ** (attempt - 1) * (0.75 + draw() / 2))


def is_transient(state: str | None, message: str = "") -> bool:
    """Connection, resource and operator trouble, conflicts of transactions, time-outs and broken connections."""
    if state and (state[:2] in TRANSIENT_CLASSES or state in TRANSIENT_STATES):
        return True
    return any(text in message for text in TRANSIENT_TEXTS)


def retried(act: Callable[[], object], state_of: Callable[[Exception], str | None] = lambda error: getattr(error, "sqlstate", None), sleep: Callable[[float], None] = time.sleep) -> object:
    """Run `act` until it ends or fails for good."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return act()
        except Exception as error:
            broken = isinstance(error, (ConnectionError, TimeoutError))
            if attempt == ATTEMPTS or not (broken or is_transient(state_of(error), str(error))):
                raise
            sleep(pause(attempt))
    raise AssertionError("unreachable")


#: The ledger: a line for each batch that is in, and one with batch -1 for each chunk of which nothing is left over.
LEDGER = "tallyport_batches"
JOBS = "tallyport_jobs"
CHUNK_DONE = -1
#: What became of a batch: it went in by this run, it was in before, or it can't go in.
OUTCOMES = "chunk_id int, batch_id int, n long, unread long, outcome string, attempts int, seconds double, detail string"


def plain(value: object) -> object:
    """Values that every driver takes: exact numbers and times as text."""
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value) if isinstance(value, (datetime.date, datetime.time)) else value


def state_of(error: Exception) -> str | None:
    """The error state as drivers name it; a database file that another writer has locked counts as a conflict."""
    if isinstance(error, sqlite3.OperationalError) and "locked" in str(error):
        return "40001"
    return getattr(error, "sqlstate", None)


@dataclass(frozen=True)
class Database:
    """How tasks reach a database: `connect` opens a connection with transactions; it and the others are sent to the tasks."""

    connect: Callable[[], Any]
    placeholder: str = "?"
    adapt: Callable[[object], object] = plain
    state_of: Callable[[Exception], str | None] = state_of
    sleep: Callable[[float], None] = time.sleep

    @classmethod
    def of(cls, text: str) -> Database:
        """`sqlite:path` of a file that all tasks can lock, or `module:name` of a function that opens a connection."""
        kind, colon, rest = text.partition(":")
        if not colon or not rest:
            raise ValueError(f"not a database: {text!r}")
        if kind == "sqlite":
            return cls(partial(sqlite3.connect, rest, timeout=TIMEOUT_S))
        return cls(getattr(importlib.import_module(kind), rest), placeholder="%s")

    def places(self, n: int) -> str:
        return ", ".join([self.placeholder] * n)

    def run(self, *statements: tuple[str, tuple]) -> list[tuple]:
        """Statements in one transaction, tried again as a batch is; the rows of the last one."""

        def act() -> list[tuple]:
            connection = self.connect()
            try:
                cursor = connection.cursor()
                for sql, values in statements:
                    cursor.execute(sql, values)
                rows = cursor.fetchall() if cursor.description else []
                connection.commit()
                return rows
            finally:
                connection.close()

        return retried(act, self.state_of, self.sleep)

    def prepare(self) -> None:
        """The ledger's tables, once a load and by the driver."""
        self.run(
            (f"CREATE TABLE IF NOT EXISTS {JOBS} (job varchar(200) PRIMARY KEY, plan text NOT NULL)", ()),
            (f"CREATE TABLE IF NOT EXISTS {LEDGER} (job varchar(200), chunk_id bigint, batch_id bigint, n bigint NOT NULL, PRIMARY KEY (job, chunk_id, batch_id))", ()),
        )

    def create(self, contract: TableContract) -> None:
        """The table of a contract, with its keys; an error if it is there."""
        unique = [f"CREATE UNIQUE INDEX {quote(f'{contract.table}_key{i}')} ON {qualified(contract.schema, contract.table)} ({', '.join(map(quote, k))})" for i, k in enumerate(contract.unique)]
        self.run(*((sql, ()) for sql in (export.table_ddl(contract).rstrip(";"), *unique, *(line.rstrip(";") for line in export.index_lines(contract)))))

    def begin(self, job: str, plan: str) -> None:
        """Keep a job's plan, or refuse one that is not the first run's."""
        p = self.placeholder
        kept = self.run(
            (f"INSERT INTO {JOBS} (job, plan) VALUES ({p}, {p}) ON CONFLICT DO NOTHING", (job, plan)),
            (f"SELECT plan FROM {JOBS} WHERE job = {p}", (job,)),
        )[0][0]
        if kept != plan:
            raise ValueError(f"can't resume {job}: its plan was {kept} and is {plan}")

    def done_chunks(self, job: str) -> set[int]:
        """Chunks that need not be opened again."""
        return {r[0] for r in self.run((f"SELECT chunk_id FROM {LEDGER} WHERE job = {self.placeholder} AND batch_id = {CHUNK_DONE}", (job,)))}


def insert_statement(database: Database, table: str, columns: list[str], keys: list[str], mode: OnConflict) -> str:
    """The insert of one row under a conflict policy. Do-nothing holds for every key that the table has, do-update for `keys`."""
    sql = f"INSERT INTO {table} ({', '.join(map(quote, columns))}) VALUES ({database.places(len(columns))})"
    if mode is OnConflict.DO_NOTHING:
        return f"{sql} ON CONFLICT DO NOTHING"
    if mode is OnConflict.ERROR:
        return sql
    others = [c for c in columns if c not in keys]
    what = "DO UPDATE SET " + ", ".join(f"{quote(c)} = excluded.{quote(c)}" for c in others) if others else "DO NOTHING"
    return f"{sql} ON CONFLICT ({', '.join(map(quote, keys))}) {what}"


class _Writer:
    """One task's connection and the chunk it is in."""

    def __init__(self, database: Database, job: str, statement: str, whole_chunks: bool) -> None:
        self.database, self.job, self.statement, self.whole_chunks = database, job, statement, whole_chunks
        self.connection: Any = None
        self.chunk: int | None = None
        self.before: dict[int, int] = {}
        self.left_over = False

    def _open(self) -> Any:
        if self.connection is None:
            self.connection = self.database.connect()
        return self.connection

    def close(self) -> None:
        """Nothing that is not committed stays, whatever state the connection is in."""
        connection, self.connection = self.connection, None
        if connection is not None:
            try:
                connection.close()
            except Exception:  # noqa: BLE001, S110  A broken connection may not close.
                pass

    def _once(self, act: Callable[[Any], Any]) -> tuple[Any, int]:
        """What `act` gives with a connection, and the attempts that it took. Each attempt after a failure has a new connection."""
        attempts = 0

        def attempt() -> Any:
            nonlocal attempts
            attempts += 1
            try:
                return act(self._open())
            except Exception:
                self.close()
                raise

        try:
            return retried(attempt, self.database.state_of, self.database.sleep), attempts
        except Exception as error:
            error.attempts = attempts
            raise

    def enter(self, chunk: int) -> None:
        """Look up which batches of a chunk are in, once a chunk."""
        p = self.database.placeholder

        def act(connection: Any) -> dict[int, int]:
            cursor = connection.cursor()
            cursor.execute(f"SELECT batch_id, n FROM {LEDGER} WHERE job = {p} AND chunk_id = {p} AND batch_id >= 0", (self.job, chunk))
            found = dict(cursor.fetchall())
            connection.rollback()
            return found

        self.before, _ = self._once(act)
        self.chunk, self.left_over = chunk, False

    def leave(self) -> None:
        if self.chunk is not None and self.whole_chunks and not self.left_over:
            self._once(self._mark)
        self.chunk = None

    def _mark(self, connection: Any) -> None:
        self._claim(connection, CHUNK_DONE, 0)
        connection.commit()

    def _claim(self, connection: Any, batch: int, n: int) -> Any:
        """A cursor of the transaction that has the batch's line; None if another one has committed it."""
        cursor = connection.cursor()
        sql = f"INSERT INTO {LEDGER} (job, chunk_id, batch_id, n) VALUES ({self.database.places(4)}) ON CONFLICT DO NOTHING"
        cursor.execute(sql, (self.job, self.chunk, batch, n))
        return cursor if cursor.rowcount else None

    def put(self, batch: int, rows: list[tuple], unread: int, why: str | None) -> tuple:
        began = time.perf_counter()
        taken = lambda: time.perf_counter() - began
        self.left_over |= bool(unread)
        if batch in self.before:
            return self.chunk, batch, self.before[batch], unread, "before", 0, taken(), None
        if why is not None:
            self.left_over = True
            return self.chunk, batch, len(rows), unread, "unfit", 0, taken(), why

        def act(connection: Any) -> None:
            # The ledger's line comes first: a second writer of the batch waits for it, then finds it.
            cursor = self._claim(connection, batch, len(rows))
            if cursor is None:
                connection.rollback()
                return
            if rows:
                cursor.executemany(self.statement, rows)
            connection.commit()

        try:
            _, attempts = self._once(act)
        except Exception as error:  # noqa: BLE001  Whatever the driver raises, the batch is out and the next one is tried.
            self.left_over = True
            return self.chunk, batch, len(rows), unread, "failed", error.attempts, taken(), f"{type(error).__name__}: {error}"[:200]
        return self.chunk, batch, len(rows), unread, "loaded", attempts, taken(), None


def write(rows: DataFrame, database: Database, job: str, table: str, columns: list[str], keys: list[str], mode: OnConflict, whole_chunks: bool = False) -> DataFrame:
    """Outcomes, one row a batch (see OUTCOMES), of rows (chunk_id, batch_id, fault, why, row) that go into a table.

    The rows of a batch must be neighbours in one partition, as sources by chunk give them (`together` puts others so); then
    nothing is shuffled and a task holds one batch at a time. `whole_chunks` says that partitions hold whole chunks, so that
    finished ones are marked. The result is lazy and has effects; write it once. Rows of one key in batches of different
    tasks go in in any order; within a batch the first wins under do-nothing, the last under do-update."""
    ship(rows.sparkSession)
    statement = insert_statement(database, table, columns, keys, mode)
    fields = ["chunk_id", "batch_id", "n", "unread", "outcome", "attempts", "seconds", "detail"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.string()]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(database, job, statement, whole_chunks)
        try:
            for chunk, batch, values, unread, why in _runs(batches, database.adapt):
                if chunk != writer.chunk:
                    writer.leave()
                    writer.enter(chunk)
                out = writer.put(batch, values, unread, why)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(out, kinds, strict=True)], names=fields)
            writer.leave()
        finally:
            writer.close()

    return rows.select("chunk_id", "batch_id", "fault", "why", "row").mapInArrow(load, OUTCOMES)


def together(rows: DataFrame) -> DataFrame:
    """Rows (chunk_id, batch_id, line_no, ...) with each batch in one partition, in order."""
    return rows.repartition("chunk_id", "batch_id").sortWithinPartitions("chunk_id", "batch_id", "line_no")


def _runs(batches: Iterator[pa.RecordBatch], adapt: Callable[[object], object]) -> Iterator[tuple[int, int, list[tuple], int, str | None]]:
    """(chunk, batch, rows, records with a fault, why it does not fit) of each run of one batch."""
    at: tuple[int, int] | None = None
    rows: list[tuple] = []
    unread, why = 0, None
    for part in batches:
        chunks, numbers, faults, whys = (part.column(i).to_pylist() for i in range(4))
        cells = [[adapt(v) for v in column.to_pylist()] for column in part.column(4).flatten()]
        for place, key in enumerate(zip(chunks, numbers, strict=True)):
            if key != at:
                if at is not None:
                    yield *at, rows, unread, why
                at, rows, unread, why = key, [], 0, None
            if faults[place] is not None:
                unread += 1
                continue
            rows.append(tuple(column[place] for column in cells))
            why = why or whys[place] or None
    if at is not None:
        yield *at, rows, unread, why


def read(spark: SparkSession, database: Database, contract: TableContract, key: str, parts: int) -> DataFrame:
    """A table of the database, by `parts` ranges of a whole-number key, a task each; values are typed by the contract.
    Ranges are equal in keys, so parts are equal in rows if keys are spread evenly. Rows whose key is NULL come with the first."""
    ship(spark)
    table, named = qualified(contract.schema, contract.table), quote(key)
    least, most = database.run((f"SELECT min({named}), max({named}) FROM {table}", ()))[0]
    least, most = least or 0, most or 0
    width = (most - least) // parts + 1
    p, names = database.placeholder, contract.names
    sql = f"SELECT {', '.join(map(quote, names))} FROM {table} WHERE {named} >= {p} AND {named} < {p}"

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (int(v) for b in batches for v in b.column(0).to_pylist()):
            connection = database.connect()
            try:
                cursor = connection.cursor()
                for where, values in [(sql, (least + part * width, least + (part + 1) * width))] + ([(f"{sql.partition(' WHERE ')[0]} WHERE {named} IS NULL", ())] if part == 0 else []):
                    cursor.execute(where, values)
                    while rows := cursor.fetchmany(10_000):
                        texts = [pa.array([None if v is None else str(v) for v in column], pa.string()) for column in zip(*rows, strict=True)]
                        yield pa.RecordBatch.from_arrays(texts, names=[f"t{i}" for i in range(len(names))])
            finally:
                connection.close()

    text = spark.range(0, parts, 1, parts).mapInArrow(fetch, ", ".join(f"t{i} string" for i in range(len(names))))
    kinds = {f.name: f.dataType for f in contract.struct().fields}
    # A text stays as it is: the rule that blanks are NULL is one of files.
    value = lambda i, c: F.col(f"t{i}") if kinds[c].typeName() == "string" else recast(F.col(f"t{i}"), contract.types[c]).cast(kinds[c])
    return text.select(*(value(i, c).alias(c) for i, c in enumerate(names)))
