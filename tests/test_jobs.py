import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest

from tallyport import cli, session
from tallyport.operators.sink import OnConflict
from tallyport.operators.verify import VerifyMode
from tallyport.plans import jobs
from tallyport.sources import delimited, parquet

DUMP = """SET statement_timeout = 0;
CREATE TABLE public.things (
    id bigint NOT NULL,
    name character varying(50),
    bal numeric(10,2),
    status text DEFAULT 'new'::text NOT NULL,
    note text,
    payload json,
    ts timestamp without time zone
);
CREATE SEQUENCE public.things_id_seq;
ALTER TABLE ONLY public.things ALTER COLUMN id SET DEFAULT nextval('public.things_id_seq'::regclass);
COPY public.things (id, note, name, bal, status, payload, ts) FROM stdin;
1\ta\\tb\tone\t1.005\tnew\t{"a": 1}\t2024-01-02 03:04:05.123456
2\t\t\\N\t-0.05\told\tnull\t\\N
3\tline\\nbreak \\\\N\tthree\t\\N\tnew\t\\N\t2024-02-29 00:00:00
\\.
ALTER TABLE ONLY public.things ADD CONSTRAINT things_pkey PRIMARY KEY (id);
"""


@pytest.fixture
def store(spark, tmp_path):
    return jobs.Store(spark, str(tmp_path / "store"))


def test_migrate_export_migrate_round_trip(spark, store, tmp_path):
    path = tmp_path / "in.sql"
    path.write_text(DUMP)
    report = jobs.migrate(spark, store, str(path), VerifyMode.FULL)
    assert report.passed
    assert report.tables[0].verdict == "Match"
    assert jobs.export_tables(store, str(tmp_path / "out.sql")) == 1
    again = jobs.Store(spark, str(tmp_path / "again"))
    assert jobs.migrate(spark, again, str(tmp_path / "out.sql"), VerifyMode.FULL).passed
    a, b = store.read("public", "things"), again.read("public", "things")
    assert a.subtract(b).count() == b.subtract(a).count() == 0
    assert a.count() == 3
    assert [r.table for r in jobs.list_tables(spark, str(path)).collect()] == ["things"]


def test_dry_run_and_unfixable_touch_nothing(spark, store, tmp_path):
    path = tmp_path / "in.sql"
    path.write_text(DUMP)
    assert jobs.migrate(spark, store, str(path), dry_run=True).created[0].startswith('CREATE TABLE "things"')
    path.write_text(DUMP + "CREATE TRIGGER x;\n")
    assert not jobs.migrate(spark, store, str(path)).passed
    assert store.tables() == []


def test_csv_load_policies(spark, store, tmp_path):
    path, header = tmp_path / "a.csv", delimited.CSV.with_(header=True)
    path.write_text("id,name,value\n1,a,10\n2,b,20\n3,c\n")
    first = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, create=True))
    assert (first.loaded, first.parse_errors) == (2, 1)
    contract = store.contract("public", "t")
    home = tmp_path / "store" / "public" / "t" / "contract.json"
    home.write_text(jobs.replace(contract, primary_key=("id",)).to_json())
    assert spark.read.parquet(first.errors).select("kind", "chunk_id", "line_no").collect() == [("parse_error", 0, 3)]
    path.write_text("id,name,value\n2,B,21\n4,d,40\n4,D,41\n")
    jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header))
    assert sorted((r.id, r.name, r.value) for r in store.read("public", "t").collect()) == [(1, "a", 10), (2, "b", 20), (4, "d", 40)]
    jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, on_conflict=OnConflict.DO_UPDATE))
    assert sorted((r.id, r.name, r.value) for r in store.read("public", "t").collect()) == [(1, "a", 10), (2, "B", 21), (4, "D", 41)]
    path.write_text("id,name,value\n5,e,50\n6,f,bad\n")
    failed = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, batch_size=1))
    assert (failed.loaded, failed.failed) == (1, 1)
    whole = jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, batch_size=10))
    assert (whole.loaded, whole.failed) == (0, 2)


def test_loads_at_once_ship_the_library_once():
    """A context on a cluster refuses a second file of the same name."""

    class Context:
        def __init__(self):
            self.sent = []

        def addPyFile(self, path):  # noqa: N802
            time.sleep(0.1)
            self.sent.append(path)

    spark = SimpleNamespace(sparkContext=Context())
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: session.ship(spark), range(8)))
    assert len(spark.sparkContext.sent) == 1


def test_loads_at_once_register_a_source_once():
    made = []
    spark = SimpleNamespace(dataSource=SimpleNamespace(register=lambda source: (time.sleep(0.1), made.append(source))))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: session.register(spark, parquet.RowGroups), range(8)))
    assert made == [parquet.RowGroups]


def test_a_load_that_creates_its_table_reads_every_chunk(spark, tmp_path):
    """What the first chunk is asked for the types must not bound what is loaded."""
    path = tmp_path / "many.csv"
    path.write_text("id,name\n" + "".join(f"{i + 40_000},n{i}\n" for i in range(500)))
    store = jobs.Store(spark, str(tmp_path / "store"))
    found = jobs.load(spark, store, jobs.LoadOptions(str(path), "many", dialect=delimited.CSV.with_(header=True), create=True, chunk_bytes=1000))
    assert (found.loaded, found.failed) == (500, 0)
    assert store.read("public", "many").where("id = 40000 + CAST(substr(name, 2) AS INT)").count() == 500
    assert [c.type_name for c in store.contract("public", "many").columns] == ["INTEGER", "TEXT"]


def test_parquet_load_creates_and_counts(spark, store, tmp_path):
    spark.createDataFrame([(i, f"n{i}", i / 2) for i in range(100)], "id int, name string, v double").write.parquet(str(tmp_path / "p.parquet"))
    result = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "p.parquet"), "p", create=True))
    assert (result.source_rows, result.loaded) == (100, 100)
    again = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "p.parquet"), "p", verify=VerifyMode.COUNT))
    assert again.verdict == "Match"


def values_table(store, keys=()):
    columns = tuple(jobs.ColumnContract(n, t) for n, t in (("id", "INTEGER"), ("name", "TEXT"), ("value", "SMALLINT")))
    store.create(jobs.TableContract("public", "v", columns, keys))


@pytest.mark.parametrize("mode", list(OnConflict))
@pytest.mark.parametrize("keys", [(), ("id",)])
def test_resume_retries_what_failed_and_loads_no_row_twice(spark, store, tmp_path, mode, keys):
    """10 of 40 rows do not fit; once the table takes them, a second run of the job loads just these."""
    if mode is OnConflict.DO_UPDATE and not keys:
        return
    path, job = tmp_path / "r.csv", str(tmp_path / "job.json")
    path.write_text("".join(f"{i},n{i},{i if i % 4 else 100000 + i}\n" for i in range(40)))
    values_table(store, keys)
    options = jobs.LoadOptions(str(path), "v", on_conflict=mode, batch_size=1, chunk_bytes=100, resume=job)
    first = jobs.load(spark, store, options)
    assert (first.loaded, first.failed, first.too_few) == (30, 10, False)
    assert spark.read.parquet(first.errors).where("kind = 'batch_error' AND detail = 'value does not fit SMALLINT'").count() == 10
    home = tmp_path / "store" / "public" / "v" / "contract.json"
    again = jobs.load(spark, store, options)
    assert (again.loaded, again.failed) == (0, 10)
    home.write_text(home.read_text().replace("SMALLINT", "INTEGER"))
    store.replace("public", "v", spark.createDataFrame(store.spark.read.parquet(*[str(home.parent / p) for p in store.parts("public", "v")]).collect(), "id int, name string, value int"))
    third = jobs.load(spark, store, jobs.replace(options, batch_size=7, chunk_bytes=999))
    assert (third.loaded, third.failed, third.estimated) == (10, 0, None)
    assert sorted(r.id for r in store.read("public", "v").collect()) == list(range(40))
    assert jobs.load(spark, store, options).loaded == 0


def test_resume_keeps_conflicting_batches_open(spark, store, tmp_path):
    """A batch of which nothing went in is not done."""
    path, job = tmp_path / "c.csv", str(tmp_path / "job.json")
    path.write_text("1,a,1\n1,b,2\n2,c,3\n")
    values_table(store, ("id",))
    options = jobs.LoadOptions(str(path), "v", on_conflict=OnConflict.ERROR, resume=job)
    assert (jobs.load(spark, store, options).loaded, jobs.load(spark, store, options).failed) == (0, 3)
    assert jobs.load(spark, store, jobs.replace(options, on_conflict=OnConflict.DO_NOTHING)).loaded == 3
    assert sorted((r.id, r.name) for r in store.read("public", "v").collect()) == [(1, "a"), (2, "c")]


def test_resume_refuses_another_job(spark, store, tmp_path):
    path, job = tmp_path / "r.csv", str(tmp_path / "job.json")
    path.write_text("1,a,1\n")
    values_table(store)
    options = jobs.LoadOptions(str(path), "v", resume=job)
    jobs.load(spark, store, options)
    other = tmp_path / "o.csv"
    other.write_text("1,a,1\n")
    for changes in ({"uri": str(other)}, {"exclude": ("value",)}, {"format": "tsv"}, {"rename": {"column_1": "id"}}, {"dialect": delimited.CSV.with_(header=True)}):
        with pytest.raises(ValueError, match="resume"):
            jobs.load(spark, store, jobs.replace(options, **changes))
    path.write_text("1,a,1\n2,b,2\n")
    with pytest.raises(ValueError, match="size"):
        jobs.load(spark, store, options)


def test_typed_sources_fail_rows_and_batches(spark, store, tmp_path):
    spark.createDataFrame([(i if i % 10 else 3_000_000_000, f"n{i}", i) for i in range(50)], "id long, name string, value long").coalesce(1).write.parquet(str(tmp_path / "p.parquet"))
    values_table(store)
    result = jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "p.parquet"), "v", batch_size=1))
    assert (result.source_rows, result.loaded, result.failed) == (50, 45, 5)
    assert {r.detail for r in spark.read.parquet(result.errors).collect()} == {"id does not fit INTEGER"}
    assert jobs.load(spark, store, jobs.LoadOptions(str(tmp_path / "p.parquet"), "v", batch_size=10)).failed == 50


def test_loads_that_add_write_one_part_more(spark, store, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("1,a,1\n")
    values_table(store, ("id",))
    for n in range(3):
        path.write_text(f"{n},a,1\n")
        jobs.load(spark, store, jobs.LoadOptions(str(path), "v"))
    assert len(store.parts("public", "v")) == 3
    jobs.load(spark, store, jobs.LoadOptions(str(path), "v", on_conflict=OnConflict.DO_UPDATE))
    assert len(store.parts("public", "v")) == 1
    assert store.read("public", "v").count() == 3
    with pytest.raises(LookupError, match="schema"):
        store.contract("elsewhere", "v")


def test_files_bind_by_position_and_excluded_columns_take_defaults(spark, store, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("name,id,value\nx,7,1\n")
    columns = (jobs.ColumnContract("a", "TEXT"), jobs.ColumnContract("b", "INTEGER"), jobs.ColumnContract("value", "INTEGER", default="42"))
    store.create(jobs.TableContract("public", "t", columns))
    header = delimited.CSV.with_(header=True)
    jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, exclude=("value",)))
    assert [tuple(r) for r in store.read("public", "t").collect()] == [("x", 7, 42)]
    with pytest.raises(ValueError, match="columns"):
        jobs.load(spark, store, jobs.LoadOptions(str(path), "t", dialect=header, rename={"name": "b"}))


def test_parts_are_the_dump(spark, store, tmp_path):
    path = tmp_path / "in.sql"
    path.write_text(DUMP)
    jobs.migrate(spark, store, str(path))
    jobs.export_tables(store, str(tmp_path / "out.sql"))
    parts = jobs.export_parts(store, str(tmp_path / "parts"), ("pub%",), ("th_ngs",))
    assert "".join(open(p, newline="").read() for p in parts) == (tmp_path / "out.sql").read_text()
    with pytest.raises(LookupError):
        jobs.export_parts(store, str(tmp_path / "none"), (), ("x%",))


def test_value_mismatch_is_found_and_reported(spark, store, tmp_path):
    path = tmp_path / "in.sql"
    path.write_text(DUMP)
    jobs.migrate(spark, store, str(path))
    changed = store.read("public", "things").withColumn("note", jobs.F.lit("other"))
    store.replace("public", "things", changed)
    found = jobs.load(spark, store, jobs.LoadOptions(str(path), "things", format="dump", verify=VerifyMode.FULL))
    assert (found.verdict, found.passed) == ("RowsConflictedAtTarget(3)", False)
    assert found.bad_keys == ("1", "2", "3")
    assert '"too_few": false' in jobs.as_json(found)


@pytest.mark.parametrize(
    "options",
    [
        {"uri": "a.parquet", "dialect": delimited.CSV}, {"uri": "a", "format": "dump", "create": True}, {"uri": "a.csv", "resume": "m", "verify": VerifyMode.FULL},
        {"uri": "a.csv", "exclude": ("x",), "create": True}, {"uri": "a.unknown"}, {"uri": "a.csv", "exclude": ("x",), "rename": {"x": "y"}},
    ],
)
def test_illegal_combinations(options):
    with pytest.raises(ValueError):
        jobs.LoadOptions(table="t", **options).validated()


def test_cli_parses():
    args = cli.parser().parse_args(["load", "--source", "a.csv", "--store", "s", "--table", "t", "--delimiter", "\\t", "--chunk-size", "1MB", "--column-map", "a:b"])
    assert (args.delimiter, args.chunk_size, args.column_map) == ("\t", 1 << 20, {"a": "b"})
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["load", "--source", "a", "--store", "s", "--table", "t", "--delimiter", "ab"])
