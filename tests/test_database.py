"""Loads into a database: each batch once, whatever breaks."""

import sqlite3
import sys
from dataclasses import replace

import pytest
from pyspark import cloudpickle

from tallyport.contract import ColumnContract, TableContract
from tallyport.operators import remote
from tallyport.operators.sink import OnConflict
from tallyport.plans import database_load, jobs

# The tasks can't import tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = (ColumnContract("id", "bigint", False), ColumnContract("name", "text"), ColumnContract("bal", "numeric(10,2)"))
KEYED = TableContract("public", "t", COLUMNS, ("id",))
BARE = TableContract("public", "t", COLUMNS)


class Stumbling:
    """A connection that raises `error` at one place of each transaction's first try: "rows" (half of them in), "commit" (before
    it) or "committed" (after it)."""

    def __init__(self, connection, where, error, seen):
        self.connection, self.where, self.error, self.seen, self.batch = connection, where, error, seen, None
        self.rollback, self.close = connection.rollback, connection.close

    def cursor(self):
        self.at = self.connection.cursor()
        self.fetchall = self.at.fetchall
        return self

    def execute(self, sql, values=()):
        self.at.execute(sql, values)
        self.rowcount, self.description = self.at.rowcount, self.at.description
        self.batch = values[1:3] if len(values) == 4 else None

    def executemany(self, sql, rows):
        self.at.executemany(sql, rows[: len(rows) // 2])
        self.stumble("rows")
        self.at.executemany(sql, rows[len(rows) // 2 :])

    def commit(self):
        self.stumble("commit")
        self.connection.commit()
        self.stumble("committed")

    def stumble(self, where):
        if where == self.where and self.batch and self.batch not in self.seen:
            self.seen.add(self.batch)
            raise self.error


@pytest.fixture
def database(tmp_path):
    return remote.Database.of(f"sqlite:{tmp_path / 'target.db'}")


def stumbling(database, where, error):
    seen = set()
    return replace(database, connect=lambda: Stumbling(database.connect(), where, error, seen), sleep=lambda s: None)


def csv(tmp_path, rows, name="a.csv"):
    (tmp_path / name).write_text("".join(f"{','.join(r)}\n" for r in rows))
    return jobs.LoadOptions(str(tmp_path / name), "t", batch_size=7, chunk_bytes=100)


def many(n):
    return [(str(i), f"name {i}", f"{i}.50") for i in range(n)]


def content(database, columns="id, name, bal"):
    return sorted(database.run((f"SELECT {columns} FROM t", ())))


@pytest.mark.parametrize("where", ["rows", "commit", "committed"])
def test_each_row_goes_in_once_without_a_key(spark, tmp_path, database, where):
    database.create(BARE)
    found = database_load.load(spark, stumbling(database, where, ConnectionError("gone")), BARE, csv(tmp_path, many(200)), "job")
    assert content(database) == [(i, f"name {i}", i + 0.5) for i in range(200)]
    batches = found.batches.collect()
    assert (found.loaded, found.failed, found.before) == (200, 0, 0)
    # One try that stumbled for each batch, and one that held.
    assert {b.attempts for b in batches} == {2}
    assert found.attempts == 2 * len(batches)
    assert found.p50 <= found.p90 <= found.p99


def test_a_job_goes_on_where_it_was_killed(spark, tmp_path, database):
    database.create(BARE)
    options = csv(tmp_path, many(200))

    class Killed(BaseException):
        pass

    # The task dies once each chunk's second batch has been committed; nothing of it comes back to the driver.
    def dying():
        class Dying(Stumbling):
            def stumble(self, where):
                if where == "committed" and self.batch and self.batch[1] == 1:
                    raise Killed

        return Dying(database.connect(), "", None, set())

    with pytest.raises(Exception, match="Killed"):
        database_load.load(spark, replace(database, connect=dying), BARE, options, "job")
    before = len(content(database))
    assert 0 < before < 200
    found = database_load.load(spark, database, BARE, options, "job")
    assert content(database, "id") == [(i,) for i in range(200)]
    assert found.loaded == 200 - before
    again = database_load.load(spark, database, BARE, options, "job")
    assert (again.loaded, again.before, again.attempts) == (0, 0, 0)
    # Chunks that are done were not opened, so no batch of theirs was looked at.
    assert again.batches.count() == 0
    assert len(content(database)) == 200


def test_a_job_of_another_source_is_refused(spark, tmp_path, database):
    database.create(BARE)
    database_load.load(spark, database, BARE, csv(tmp_path, many(20)), "job")
    with pytest.raises(ValueError, match="can't resume"):
        database_load.load(spark, database, BARE, csv(tmp_path, many(21), "b.csv"), "job")
    # Another job of the same source adds its rows.
    database_load.load(spark, database, BARE, csv(tmp_path, many(20)), "other")
    assert len(content(database)) == 40


def test_errors_that_do_not_pass_fail_their_batch_only(spark, tmp_path, database):
    database.create(KEYED)
    database.run(("INSERT INTO t VALUES (9, 'there', 0)", ()))
    rows = many(60)
    rows[30] = ("30", "no number", "x")
    rows[45] = ("45", "wide", "1", "2")
    options = replace(csv(tmp_path, rows), on_conflict=OnConflict.ERROR, chunk_bytes=1 << 20)
    found = database_load.load(spark, database, KEYED, options, "job")
    outcomes = {(b.batch_id): b for b in found.batches.collect()}
    assert {n: b.outcome for n, b in outcomes.items() if b.outcome != "loaded"} == {1: "failed", 4: "unfit"}
    assert "UNIQUE" in outcomes[1].detail
    assert "bal does not fit" in outcomes[4].detail
    # A constraint is not tried again.
    assert outcomes[1].attempts == 1
    assert (found.parse_errors, found.failed) == (1, 15)
    ids = {i for (i,) in content(database, "id")}
    assert ids == set(range(60)) - set(range(7, 14)) - set(range(28, 35)) - {45} | {9}
    # What failed is tried again by the next run, what is in is not.
    database.run(("DELETE FROM t WHERE id = 9", ()))
    found = database_load.load(spark, database, KEYED, options, "job")
    assert (found.loaded, found.before) == (7, 60 - 15 + 0)
    assert len(content(database)) == 52


def test_an_error_that_stays_is_given_up(spark, tmp_path, database):
    database.create(BARE)

    class Down(Stumbling):
        def stumble(self, where):
            if where == "rows":
                raise ConnectionError("down")

    down = replace(database, connect=lambda: Down(database.connect(), "", None, set()), sleep=lambda s: None)
    found = database_load.load(spark, down, BARE, csv(tmp_path, many(20)), "job")
    assert found.loaded == 0
    assert found.failed == 20
    assert {(b.outcome, b.attempts) for b in found.batches.collect()} == {("failed", remote.ATTEMPTS)}
    assert content(database) == []
    assert found.p50 is None


def test_conflict_policies(spark, tmp_path, database):
    database.create(replace(KEYED, unique=(("name",),)))
    options = csv(tmp_path, [("1", "a", "1"), ("1", "b", "2"), ("2", "a", "3"), ("3", "", "4"), ("4", "", "5")])
    # Do-nothing holds for every key that the table has; a NULL is no key.
    database_load.load(spark, database, KEYED, options, "first")
    assert content(database) == [(1, "a", 1), (3, None, 4), (4, None, 5)]
    options = replace(csv(tmp_path, [("1", "z", "9"), ("5", "y", "8"), ("5", "x", "7")], "b.csv"), on_conflict=OnConflict.DO_UPDATE)
    database_load.load(spark, database, KEYED, options, "second")
    assert content(database) == [(1, "z", 9), (3, None, 4), (4, None, 5), (5, "x", 7)]
    with pytest.raises(ValueError, match="needs a primary"):
        database_load.load(spark, database, BARE, replace(options, on_conflict=OnConflict.DO_UPDATE), "third")


def test_hostile_names_values_and_an_empty_source(spark, tmp_path, database):
    columns = tuple(ColumnContract(n, "text") for n in ("chunk_id", "row", "raw")) + (ColumnContract("select", "text"), ColumnContract("batch_id", "bigint"))
    contract = TableContract("public", "order", columns)
    database.create(contract)
    data = [("it's", "\u00e4\U0001f600", "?", "%s", 1), (None, "", "x" * 100_000, "\n", 2), (None, None, None, None, None)]
    frame = spark.createDataFrame(data, "chunk_id string, row string, raw string, select string, batch_id long")
    frame.write.parquet(str(tmp_path / "in"))
    options = jobs.LoadOptions(str(tmp_path / "in"), "order", format="parquet")
    assert database_load.load(spark, database, contract, options, "job").loaded == 3
    back = remote.read(spark, database, contract, "batch_id", 3)
    # Blank text is NULL in every load.
    data[1] = (None, None, *data[1][2:4], 2)
    got = sorted(map(tuple, back.collect()), key=repr)
    assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in sorted(data, key=repr)]
    assert got[1][2] == data[1][2]
    database.run(('UPDATE "order" SET "row" = %s WHERE batch_id = 1' % "''", ()))
    assert remote.read(spark, database, contract, "batch_id", 3).where("batch_id = 1").first()[1] == ""
    frame.limit(0).write.parquet(str(tmp_path / "none"))
    found = database_load.load(spark, database, contract, replace(options, uri=str(tmp_path / "none")), "empty")
    assert (found.loaded, found.failed, found.p99) == (0, 0, None)


def test_batches_that_are_put_together(spark, database):
    database.create(BARE)
    database.prepare()
    rows = spark.range(0, 1000, 1, 8).selectExpr(
        "int(id % 3) chunk_id", "int(id % 30) batch_id", "id line_no", "string(NULL) fault", "string(NULL) why", "named_struct('a', id, 'b', string(id), 'c', decimal(id)) row"
    )
    out = remote.write(remote.together(rows), database, "job", "t", ["id", "name", "bal"], [], OnConflict.ERROR)
    assert {(r.n, r.outcome) for r in out.collect()} <= {(33, "loaded"), (34, "loaded")}
    assert content(database, "id, name") == [(i, str(i)) for i in range(1000)]
    # The same frame again, as after a task that was lost: the ledger has all of it.
    assert {r.outcome for r in out.collect()} == {"before"}
    assert len(content(database)) == 1000


def test_statements_and_names(tmp_path):
    database = remote.Database.of(f"sqlite:{tmp_path / 'x.db'}")
    assert remote.insert_statement(database, "t", ["a", 'b"'], ["a"], OnConflict.ERROR) == 'INSERT INTO t ("a", "b""") VALUES (?, ?)'
    assert remote.insert_statement(database, "t", ["a"], ["a"], OnConflict.DO_UPDATE).endswith('ON CONFLICT ("a") DO NOTHING')
    assert remote.Database.of("sqlite3:connect").placeholder == "%s"
    with pytest.raises(ValueError):
        remote.Database.of("sqlite:")
    assert remote.state_of(sqlite3.OperationalError("database is locked")) == "40001"
    assert remote.state_of(ValueError("x")) is None


def test_command_line(spark, tmp_path, database, capsys, monkeypatch):
    from tallyport import cli, session

    monkeypatch.setattr(session, "build", lambda *a, **k: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    jobs.Store(spark, str(tmp_path / "store")).create(KEYED)
    database.create(KEYED)
    csv(tmp_path, many(30))
    args = ["load", "--source", str(tmp_path / "a.csv"), "--store", str(tmp_path / "store"), "--table", "t", "--database", f"sqlite:{tmp_path / 'target.db'}"]
    assert cli.main([*args, "--job", "j", "--connections", "2"]) == 0
    assert '"loaded": 30' in capsys.readouterr().out
    assert len(content(database)) == 30
    assert cli.main(args) != 0
    assert "needs --job" in capsys.readouterr().err
