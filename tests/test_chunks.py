"""What is read and written by chunk: records over lines, dump indexes, row groups, versions, several keys, folds of types."""

import io
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyport.contract import ColumnContract, TableContract
from tallyport.functions import infer
from tallyport.functions.render import plain_float
from tallyport.functions.types import SqlType
from tallyport.operators import sink
from tallyport.operators.sink import OnConflict
from tallyport.plans import jobs
from tallyport.plans.store import Store
from tallyport.sources import delimited, dumpscan, dumpsource, files, parquet, quotes

HEADER = delimited.CSV.with_(header=True)


def table(*columns, key=(), unique=(), indexes=None):
    made = tuple(ColumnContract(n, t) for n, t in columns)
    return TableContract("public", "t", made, key, unique, indexes or {})


def rows_of(store, name="t"):
    return sorted((tuple(r) for r in store.read("public", name).collect()), key=repr)


# Records


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='ab,"\n\r\\', max_size=60), st.sampled_from([None, "\\", '"']), st.integers(1, 12))
def test_chunks_begin_where_records_do(text, escape, target):
    data, grammar = text.encode(), quotes.records(",", '"', escape)
    ends = list(grammar.ends(data))
    starts = [s for s in [0, *ends] if s < len(data)]
    chunks = list(files.chunks(io.BytesIO(data), 0, len(data), target))
    summaries = []
    for c in chunks:
        s = grammar.summary(c.id, data[c.start : c.end])
        summaries.append(quotes.Summary(s.chunk, s.outside, s.inside, None if s.first is None else c.start + s.first))
    begins, _ = quotes.begins(summaries)
    got = []
    for c in chunks:
        at = begins.get(c.id, c.start)
        while at is not None and at < c.end:
            got.append(at)
            at = grammar.end(data, at)
    assert got == starts


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_records_over_lines_load_whole(spark, tmp_path, chunk):
    rng = random.Random(chunk)
    want = [(i, "".join(rng.choice(['"', ",", "\n", "\r\n", "x", "é", "☃ "]) for _ in range(rng.randint(1, 30))) + "z") for i in range(200)]
    path, store = tmp_path / "a.csv", Store(spark, str(tmp_path / "store"))
    path.write_text('"the\nid",text\n' + "".join(f'{i},"{t.replace(chr(34), chr(34) * 2)}"\r\n' for i, t in want), newline="")
    store.create(table(("id", "INTEGER"), ("text", "TEXT")))
    found = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=HEADER, chunk_bytes=max(chunk, 5)))
    assert (found.loaded, found.failed) == (200, 0)
    assert rows_of(store) == sorted(want, key=repr)


def test_a_quoted_line_end_with_default_options(spark, tmp_path):
    path, store = tmp_path / "a.csv", Store(spark, str(tmp_path / "store"))
    path.write_text('1,"line1\nline2"\n2,normal\n')
    store.create(table(("id", "INTEGER"), ("name", "TEXT")))
    assert jobs.load(spark, store, jobs.LoadOptions(str(path), "t")).loaded == 2
    assert rows_of(store) == [(1, "line1\nline2"), (2, "normal")]


def test_faults_are_counted_never_cut(spark, tmp_path):
    path, store = tmp_path / "a.csv", Store(spark, str(tmp_path / "store"))
    path.write_bytes(b'1,a\n2,\xff\n\n   \n3,b,c\r\n4,"d"\n5,"open\n6,e\n')
    store.create(table(("id", "INTEGER"), ("name", "TEXT")))
    found = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", batch_size=1, chunk_bytes=6))
    assert (found.loaded, found.failed, found.parse_errors) == (2, 4, 4)
    assert rows_of(store) == [(1, "a"), (4, "d")]
    said = sorted(r.detail for r in spark.read.parquet(found.errors).collect())
    assert [s.split(":")[0] for s in said] == ["a quote that is not closed", "not a record of the table's width", "not a record of the table's width", "not valid UTF-8"]
    # A line of blanks is a record, of one field.
    path.write_text("x\n  \n\ny\n")
    store.create(TableContract("public", "one", (ColumnContract("name", "TEXT"),)))
    assert jobs.load(spark, store, jobs.LoadOptions(str(path), "one")).loaded == 3
    assert rows_of(store, "one") == [("x",), ("y",), (None,)]


def test_heads(tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('\n"a\n""b",, c\n1,2,3\n')
    assert delimited.head(str(path), HEADER).columns == ['a\n"b', "column_2", " c"]
    assert delimited.head(str(path)).columns == ["column_1", "column_2", "column_3"]
    path.write_text('"a\n')
    with pytest.raises(ValueError, match="end"):
        delimited.head(str(path))
    path.write_text("\n\n")
    with pytest.raises(ValueError, match="empty"):
        delimited.head(str(path))


def test_followed_lines_with_open_quotes_are_faults(spark):
    lines = spark.createDataFrame([(0, 1, '1,"line1'), (0, 2, 'line2"'), (0, 3, '2,5" pipe')], "chunk_id int, line_no long, raw string")
    assert {r.line_no: r.good for r in delimited.parsed(lines, ["a", "b"]).collect()} == {1: False, 2: False, 3: True}


def test_joined_files(tmp_path):
    for name, text in (("part-2", "cd"), ("part-10", "ef"), ("part-1", ""), ("_SUCCESS", "x"), (".part.crc", "x"), ("part-0", "ab\n")):
        (tmp_path / name).write_text(text)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x").write_text("g")
    place = files.Place.of(str(tmp_path))
    with place.open() as file:
        assert file.size() == 8
        assert file.read() == b"ab\ncdefg"
        file.seek(1)
        assert (file.read(3), file.read(2), file.read(99), file.read(1)) == (b"b\nc", b"de", b"fg", b"")
    assert place.size() == 8
    with pytest.raises(FileNotFoundError):
        (place / "nothing").files()


# Dumps


def hostile_dump(rng):
    out = []
    for n in range(rng.randint(0, 5)):
        out.append(rng.choice(["", "SELECT 1;\n", "-- COPY x (a) FROM stdin;\n", "\\.\n", "copy is not a header\n", "COPY (SELECT 1) TO stdout;\n"]))
        out.append(rng.choice([f'COPY public.t{n} (a, "b,c") FROM stdin;\n', f'copy  "t {n}" ( a ) from STDIN\r\n']))
        out += [rng.choice(["1\t2\n", "COPY x (a) FROM stdin;\n", "COPY y FROM stdin;\n", "\\.x\n", "\\.\t\n", " \\.\n", "\n", "\\\\.\r\n"]) for _ in range(rng.randint(0, 6))]
        out.append(rng.choice(["\\.\n", "\\.\r\n"]))
    if rng.random() < 0.3:
        out.append(rng.choice(["COPY z (a) FROM stdin;\n\\.", "COPY z (a) FROM stdin;\n\\.\r", "COPY z (a FROM stdin;\n", "COPY z FROM stdin;\n"]))
    return "".join(out).encode()


def serial_blocks(data):
    """A plain pass over the lines."""
    out, head, at = [], None, 0
    for line in data.splitlines(keepends=True) if b"\r" not in data.replace(b"\r\n", b"") else [x + b"\n" for x in data.split(b"\n")[:-1]] + ([data.split(b"\n")[-1]] if not data.endswith(b"\n") else []):
        if head is None:
            if line[:4].upper() == b"COPY" and (found := dumpscan.parse_header(line.decode())):
                head = (*found, at, at + len(line))
        elif line in (b"\\.\n", b"\\.\r\n", b"\\."):
            out.append(dumpscan.Block(*head, at, at + len(line)))
            head = None
        at += len(line)
    if head:
        raise dumpscan.MissingTerminator("rows do not end")
    return out


@pytest.mark.parametrize("seed", range(150))
def test_events_of_chunks_make_the_serial_blocks(seed):
    rng = random.Random(seed)
    data = hostile_dump(rng)
    chunks = list(files.chunks(io.BytesIO(data), 0, len(data), rng.randint(1, 60)))
    find = lambda: dumpscan.joined([[dumpscan.events(data[c.start : c.end], c.start, side) for side in (False, True)] for c in chunks])
    try:
        want = serial_blocks(data)
    except dumpscan.ScanError as error:
        with pytest.raises(type(error)):
            find()
        return
    assert find() == want == dumpscan.blocks(io.BytesIO(data))


def _whole(data):
    try:
        return len(serial_blocks(data)) > 2
    except dumpscan.ScanError:
        return False


def test_index_by_executors(spark, tmp_path):
    (tmp_path / "dump").mkdir()
    data = next(d for d in (hostile_dump(random.Random(s)) for s in range(1000, 2000)) if len(d) > 300 and _whole(d))
    for n in range(0, len(data), 70):
        (tmp_path / "dump" / f"part-{n}").write_bytes(data[n : n + 70])
    assert dumpsource.index(spark, str(tmp_path / "dump"), 50) == serial_blocks(data)
    (tmp_path / "a").write_bytes(b"PGDMP\x01")
    with pytest.raises(dumpscan.NotPlainText):
        dumpsource.index(spark, str(tmp_path / "a"))
    (tmp_path / "a").write_bytes(b"COPY a (b) FROM stdin;\n1\n")
    with pytest.raises(dumpscan.MissingTerminator):
        dumpsource.index(spark, str(tmp_path / "a"), 10)


# Row groups


def test_parquet_any_name_any_column(spark, tmp_path):
    df = spark.range(50).selectExpr("id AS raw", "id * 2 AS good", "id % 3 AS chunk_id", "id AS line_no", "CAST(id AS STRING) AS `a.b`", "id AS `_order`", "id AS t0")
    for name in ("x y.parquet", "a%20b.parquet"):
        df.coalesce(1).write.parquet(str(tmp_path / "d"), mode="overwrite")
        part = next(p for p in (tmp_path / "d").iterdir() if p.suffix == ".parquet")
        (tmp_path / name).write_bytes(part.read_bytes())
        store = Store(spark, str(tmp_path / f"store {name}"))
        found = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / name), "p", create=True))
        assert (found.loaded, found.failed, found.source_rows) == (50, 0, 50)
        assert rows_of(store, "p") == sorted((tuple(r) for r in df.collect()), key=repr)
        contract = store.contract("public", "p")
        (tmp_path / f"store {name}" / "public" / "p" / "contract.json").write_text(jobs.replace(contract, primary_key=("a.b",)).to_json())
        for mode in OnConflict:
            again = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / name), "p", on_conflict=mode))
            assert again.loaded == (0 if mode is OnConflict.ERROR else 50)
            assert len(rows_of(store, "p")) == 50
    assert "Join" not in parquet.chunked(spark, str(tmp_path / "x y.parquet"))[0]._jdf.queryExecution().toString()


def test_parquet_row_groups_and_types(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pa.table({
        "u": pa.array([2**63 + 5, None, 1], pa.uint64()), "d": pa.array(["x", "y", "x"]).dictionary_encode(), "ts": pa.array([0, 1, None], pa.timestamp("ms")), "tz": pa.array([0, 1, 2], pa.timestamp("us", "UTC")),
        "b": pa.array([b"\x00", None, b"z"]), "f": pa.array([1.5, 2.0, None], pa.float32()), "day": pa.array([0, 18993, None], pa.date32()), "s": pa.array(["", " ", "k"]), "i8": pa.array([1, -1, None], pa.int8()),
    })
    pq.write_table(t, tmp_path / "p.parquet", row_group_size=1)
    rows, schema, chunks, count = parquet.chunked(spark, str(tmp_path / "p.parquet"), 1)
    assert (chunks, count) == (3, 3)
    got = rows.select("chunk_id", "line_no", "row.*").toDF("chunk_id", "line_no", *schema.names)
    want = parquet.scan(spark, str(tmp_path / "p.parquet"))
    assert got.drop("chunk_id", "line_no").exceptAll(want).count() == want.exceptAll(got.drop("chunk_id", "line_no")).count() == 0
    assert [(r.chunk_id, r.line_no) for r in got.orderBy("chunk_id").collect()] == [(0, 1), (1, 1), (2, 1)]
    one = rows.where("chunk_id = 1")
    assert one.rdd.getNumPartitions() == 1
    assert one.first().row.f0 is None


def test_records_over_lines_keep_rows_of_no_key_and_of_one_key(spark, tmp_path):
    from tallyport.plans import registry

    want = [(1, 'a\n"b"', "en", "s"), (1, "again", "en", "s"), (None, "no key", "en", "s"), (2, None, None, "s"), (2, None, None, "s")]
    spark.createDataFrame(want, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.queries()["csv_records_over_lines"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_a_lost_row_is_an_error(spark, tmp_path, monkeypatch):
    spark.range(10).write.parquet(str(tmp_path / "p"))
    whole = parquet.chunked
    monkeypatch.setattr(parquet, "chunked", lambda *a: (lambda r, *x: (r.where("row.f0 <> 3"), *x))(*whole(*a)))
    with pytest.raises(ValueError, match="10 rows, but 9"):
        jobs.load(spark, Store(spark, str(tmp_path / "store")), jobs.LoadOptions(str(tmp_path / "p"), "p", format="parquet", create=True))


# Versions


def test_a_version_is_made_once(tmp_path):
    place = files.Place.of(str(tmp_path)) / "log" / "1.json"
    assert place.create("a")
    assert not place.create("b")
    assert place.read_text() == "a"
    assert (files.Place.of(str(tmp_path)) / "log").names() == ["1.json"]


@pytest.mark.parametrize("keys", [(), ("id",)])
def test_two_writers_keep_all_rows(spark, tmp_path, keys):
    """A second load goes through between the first one's look at the table and its version."""
    store = Store(spark, str(tmp_path / "store"))
    store.create(table(("id", "INTEGER"), ("v", "TEXT"), key=keys))
    (tmp_path / "a.csv").write_text("1,a\n2,a\n3,a\n")
    (tmp_path / "b.csv").write_text("3,b\n4,b\n4,c\n")
    late = Late(spark, str(tmp_path / "store"), lambda: jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "b.csv"), "t")))
    jobs.load(spark, late, jobs.LoadOptions(str(tmp_path / "a.csv"), "t"))
    want = [(1, "a"), (2, "a"), (3, "b"), (4, "b")] if keys else [(1, "a"), (2, "a"), (3, "a"), (3, "b"), (4, "b"), (4, "c")]
    assert rows_of(store) == want
    assert store.version("public", "t").number == 2


class Late(Store):
    """A store in which something happens after the first look at a table's version."""

    def __init__(self, spark, root, act):
        super().__init__(spark, root)
        self.act, self.looks = act, 0

    def commit(self, schema, table, change):
        def first(base):
            out = change(base)
            self.looks += 1
            if self.looks == 1:
                self.act()
            return out

        return super().commit(schema, table, first)


def test_two_runs_of_one_job_load_each_batch_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create(table(("id", "INTEGER"), ("v", "TEXT")))
    (tmp_path / "a.csv").write_text("".join(f"{i},a\n" for i in range(40)))
    options = jobs.LoadOptions(str(tmp_path / "a.csv"), "t", batch_size=3, chunk_bytes=50, resume=str(tmp_path / "job.json"))
    late = Late(spark, str(tmp_path / "store"), lambda: jobs.load(spark, store, options))
    jobs.load(spark, late, options)
    assert [r[0] for r in sorted(rows_of(store), key=lambda r: r[0])] == list(range(40))


@pytest.mark.parametrize("keys", [(), ("id",)])
@pytest.mark.parametrize("step", ["write", "add", "create"])
def test_a_driver_killed_between_any_two_writes(spark, tmp_path, keys, step, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    store.create(table(("id", "INTEGER"), ("v", "TEXT"), key=keys))
    (tmp_path / "a.csv").write_text("".join(f"{i},a\n" for i in range(20)))
    options = jobs.LoadOptions(str(tmp_path / "a.csv"), "t", batch_size=3, chunk_bytes=50, resume=str(tmp_path / "job.json"))

    def dies(target, name, before):
        real = getattr(target, name)

        def act(self, *args):
            if before and not (name == "create" and "log" not in self.source.path):
                raise KeyboardInterrupt
            real(self, *args)
            raise KeyboardInterrupt

        return act

    with monkeypatch.context() as patch:
        target = {"write": Store, "add": jobs.Job, "create": files.Place}[step]
        patch.setattr(target, step, dies(target, step, step == "create") if step != "create" else _dying_create(target.create))
        with pytest.raises(KeyboardInterrupt):
            jobs.load(spark, store, options)
    assert rows_of(store) == []
    assert jobs.load(spark, store, options).loaded == 20
    assert jobs.load(spark, store, options).loaded == 0
    assert len(rows_of(store)) == 20


def _dying_create(real):
    def create(self, text):
        if "/log/" in self.source.path:
            raise KeyboardInterrupt
        return real(self, text)

    return create


def test_done_chunks_are_not_opened(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create(table(("id", "SMALLINT"), ("v", "TEXT")))
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(4):
        (folder / f"part-{n}").write_text("".join(f"{i if n != 2 else 100000 + i},a\n" for i in range(10)))
    options = jobs.LoadOptions(str(folder), "t", format="csv", batch_size=1, chunk_bytes=40, resume=str(tmp_path / "job.json"))
    first = jobs.load(spark, store, options)
    assert (first.loaded, first.failed) == (30, 10)
    # What the first and the last part hold is not looked at again; their sizes stay what they were.
    for n in (0, 3):
        (folder / f"part-{n}").write_bytes(re.sub(rb"[^\n,]", b"\xff", (folder / f"part-{n}").read_bytes()))
    (tmp_path / "store" / "public" / "t" / "contract.json").write_text(table(("id", "INTEGER"), ("v", "TEXT")).to_json())
    store.replace("public", "t", spark.createDataFrame([], "id int, v string"))
    lines = dumpsource.raw_records(spark, str(folder), 0, 100, delimited.CSV.marks, 40).where(F.col("chunk_id").isin([1, 2]))
    assert lines.rdd.getNumPartitions() == 2
    assert "chunk_id" in lines._jdf.queryExecution().executedPlan().toString() and "Filter" not in lines._jdf.queryExecution().optimizedPlan().toString()
    second = jobs.load(spark, store, options)
    assert (second.loaded, second.failed) == (10, 0)


def test_a_load_with_too_few_rows_warns(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create(table(("id", "INTEGER"), ("v", "TEXT")))
    (tmp_path / "a.csv").write_text("".join(f"{i},a\n" for i in range(2000)) + "".join(f'{i},"{"x" * 200}"\n' for i in range(500)))
    found = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "a.csv"), "t"))
    assert found.too_few and any("half" in w for w in found.warnings)
    assert found.bytes == (tmp_path / "a.csv").stat().st_size - 2500


# Several keys


def greedy(target, new):
    taken = [{r[0] for r in target if r[0] is not None}, {r[1:] for r in target if None not in r[1:]}]
    out = []
    for n, (a, b, c) in enumerate(new):
        if (a is not None and a in taken[0]) or (None not in (b, c) and (b, c) in taken[1]):
            continue
        out.append(n)
        if a is not None:
            taken[0].add(a)
        if None not in (b, c):
            taken[1].add((b, c))
    return out


@pytest.mark.parametrize(("rounds", "most"), [(0, 1000), (2, 1000), (1, 3), (9, 0)])
def test_several_keys_equal_a_sequential_pass(spark, monkeypatch, rounds, most):
    monkeypatch.setattr(sink, "ROUNDS", rounds)
    monkeypatch.setattr(sink, "COMPONENT_ROWS", most)
    rng = random.Random(rounds)
    draw = lambda: rng.choice([None, *range(12)])
    target = [(draw(), str(draw()), draw()) for _ in range(5)]
    new = [(draw(), rng.choice([None, "1", "1:1", "11"]), draw()) for _ in range(40)]
    # A chain in which each row waits for the one before.
    new += [(100 + n // 2, f"c{(n + 1) // 2}", 0) for n in range(14)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(new)], "n long, a int, b string, c int").repartition(3)
    kept = sink.do_nothing(spark.createDataFrame(target, "a int, b string, c int"), df, [["a"], ["b", "c"]], F.col("n"))
    assert sorted(r.n for r in kept.collect()) == greedy(target, new)


def test_loads_keep_all_unique_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    index = 'CREATE UNIQUE INDEX x ON t USING btree ("email")'
    contract = table(("id", "INTEGER"), ("email", "TEXT"), key=("id",), unique=(("id",),), indexes={"x": index, "y": "CREATE UNIQUE INDEX y ON t (lower(email))", "z": "CREATE UNIQUE INDEX z ON t (id) WHERE id > 3", "w": "CREATE INDEX w ON t (id)"})
    assert contract.all_keys == [["id"], ["email"]]
    store.create(contract)
    path = tmp_path / "a.csv"
    path.write_text("1,a@x\n2,a@x\n2,b@x\n3,b@x\n")
    jobs.load(spark, store, jobs.LoadOptions(str(path), "t"))
    assert rows_of(store) == [(1, "a@x"), (2, "b@x")]
    path.write_text("7,a@x\n8,c@x\n")
    found = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", on_conflict=OnConflict.ERROR, batch_size=1))
    assert (found.loaded, found.failed) == (1, 1)


# Inference


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from([t.value for t in SqlType])), max_size=40), st.lists(st.integers(0, 40), max_size=4))
def test_runs_compose_to_the_fold(types, cuts):
    state = 0
    borders = sorted({0, len(types), *(min(c, len(types)) for c in cuts)})
    for a, b in zip(borders, borders[1:], strict=False):
        codes = np.array([0 if t is None else infer._AT[t] for t in types[a:b]], np.int8)
        state = infer.run_map(codes[codes > 0])[state]
    assert (infer.STATES[state] or SqlType.TEXT) is infer.fold(types)[0]


def test_inference_by_chunks_keeps_the_order(spark, tmp_path):
    values = ["1", *(str(i) for i in range(2, 300)), "2.5", " ", "70000"]
    path = tmp_path / "a.csv"
    path.write_text("".join(f'{v},{w},"{i}\n"\n' for i, (v, w) in enumerate(zip(values, reversed(values), strict=True))))
    _, rows, _ = delimited.records(spark, str(path), delimited.CSV, 100)
    assert rows.select("chunk_id").distinct().count() > 10
    found = infer.infer_runs(rows.select(F.col("chunk_id").alias("run"), F.col("line_no").alias("at"), "row"), ["a", "b", "c"], [F.col(f"row.f{i}") for i in range(3)])
    assert [(c.type, c.nullable) for c in found] == [(SqlType.REAL, True), (SqlType.TEXT, True), (infer.fold(["BOOLEAN", "BOOLEAN", "SMALLINT"])[0], False)]
    wide = [f"w{i}" for i in range(infer.FEW + 4)]
    found = infer.infer(spark.createDataFrame([tuple("7" for _ in wide)], ", ".join(f"{w} string" for w in wide)))
    assert {c.type for c in found} == {SqlType.SMALLINT}


def test_floats_into_text(spark):
    values = [1e7, 100.0, 0.25, 1.5e-5, -2.5e20, 0.0, -0.0, 123456.789, 1e22, float("inf"), float("-inf"), float("nan"), 5e-324]
    got = [r.t for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(plain_float(F.col("v"), None).alias("t")).collect()]
    assert got[:9] == ["10000000", "100", "0.25", "0.000015", "-250000000000000000000", "0", "-0", "123456.789", "10000000000000000000000"]
    assert got[9:12] == ["inf", "-inf", "NaN"]
    assert float(got[12]) == 5e-324
