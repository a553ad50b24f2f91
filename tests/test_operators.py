import pytest
from pyspark.sql import functions as F

from tallyport.functions import identifiers as ids
from tallyport.operators import shape, sink, verify
from tallyport.operators.sink import OnConflict
from tallyport.plans import ddl


def frame(spark, rows, schema="k int, v string, o int"):
    return spark.createDataFrame(rows, schema)


def test_policies_first_and_last_win(spark):
    target, new = frame(spark, [(1, "old")], "k int, v string"), frame(spark, [(1, "a", 1), (2, "b", 2), (2, "c", 3), (None, "n", 4), (None, "m", 5)])
    kept = sink.do_nothing(target, new, ["k"], F.col("o")).collect()
    assert sorted((r.k or 0, r.v) for r in kept) == [(0, "m"), (0, "n"), (2, "b")]
    after = sink.do_update(target, new, ["k"], F.col("o")).collect()
    assert sorted((r.k or 0, r.v) for r in after) == [(0, "m"), (0, "n"), (1, "a"), (2, "c")]


def test_error_batches_follow_order(spark):
    target = frame(spark, [(9,)], "k int")
    new = frame(spark, [(1, 0), (1, 1), (2, 1), (2, 2), (9, 3), (5, 4), (5, 4)], "k int, batch_id int")
    got = {r.batch_id: r.failed for r in sink.error_batches(target, new, ["k"]).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: True}


def test_error_batches_settle_long_chains(spark):
    """Batch n shares a key with n + 1: every second one goes in."""
    new = frame(spark, [(k, b) for b in range(7) for k in (b, b + 1)] + [(None, 1), (None, 1)], "k int, batch_id int")
    got = {r.batch_id: r.failed for r in sink.error_batches(frame(spark, [(100,)], "k int"), new, ["k"]).collect()}
    assert got == {b: b % 2 == 1 for b in range(7)}


def test_key_rules():
    with pytest.raises(ValueError):
        sink.validate_keys(OnConflict.DO_UPDATE, [], [])
    with pytest.raises(ValueError):
        sink.validate_keys(OnConflict.DO_UPDATE, ["a"], ["a"])
    assert sink.validate_keys(OnConflict.DO_UPDATE, ["a", "b"], ["a"])
    assert OnConflict.parse("Do_Nothing") is OnConflict.DO_NOTHING


def test_compare_states(spark):
    types = {"k": "INTEGER", "v": "TEXT"}
    source = spark.createDataFrame([("1", "a"), ("2", None), ("3", ""), ("4", "x")], "k string, v string")
    target = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "k int, v string")
    got = {r.key: r.state for r in verify.compare(source, target, "k", types).collect()}
    assert got == {"1": "match", "2": "match", "3": "mismatch", "4": "missing"}
    row = verify.summary(verify.compare(source, target, "k", types)).first()
    assert (row.rows, row.mismatched, row.missing, row.mismatch_keys, row.missing_keys) == (4, 1, 1, ["3"], ["4"])


def test_null_key_is_an_error(spark):
    with pytest.raises(ValueError):
        verify.check_keys(spark.createDataFrame([(None,)], "k string"), "k")
    assert verify.skip_reason([], ["a"], ["a"]) == "no key"
    assert verify.skip_reason(["a", "b"], ["a", "b"], ["a", "b"]) == "composite key"
    assert verify.skip_reason(["z"], ["a"], ["z"]) == "key not in the source"


def test_shape_errors(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    for bad in (lambda: shape.exclude(df, ["x"]), lambda: shape.exclude(df, ["a", "b"]), lambda: shape.rename(df, {"a": "b"}), lambda: shape.align(df, ["a", "c"]), lambda: shape.validate_exclude_rename(["a"], {"a": "z"})):
        with pytest.raises(ValueError):
            bad()
    assert shape.align(df, ["b", "a"]).columns == ["b", "a"]
    assert shape.excluded_positions(["a", "b", "c"], ["c", "a"]) == [0, 2]


def test_split_statements():
    text = "a; 'x;''y'; -- c;\n\"q;\"\"\" ; /* n /* ; */ ; */ b; $t$ ; $u$ ; $t$; /* only */ ; -- end"
    assert [s.rsplit("\n", 1)[-1] for s in ddl.split_statements(text)] == ["a", "'x;''y'", '"q;"""', "/* n /* ; */ ; */ b", "$t$ ; $u$ ; $t$"]


def test_unknown_statements_are_not_dropped():
    found = ddl.normalize("CREATE TABLE t (id int);\nCREATE TRIGGER x;\nALTER TABLE t ALTER COLUMN id SET DEFAULT nextval('gone');")
    assert [(f.rule, f.line) for f in found.unfixable] == [("unsupported_statement", 2), ("at_unsupported_alter_column_set_default", 3)]


def test_statements_that_a_store_does_not_keep_are_findings():
    found = ddl.normalize("SET search_path = x;\nCREATE TABLE t (id int);\nCOMMENT ON TABLE t IS 'x';\nGRANT ALL ON t TO x;\nALTER TABLE t OWNER TO x;\nSELECT pg_catalog.setval('s', 3, true);\n")
    assert [f.rule for f in found.findings] == ["setting_not_kept", "comment_not_kept", "privilege_not_kept", "owner_not_kept", "sequence_value_not_kept"]
    assert not found.unfixable


def test_contracts_are_applied_in_order():
    tables = list(ddl.normalize("CREATE TABLE a (id int);\nCREATE TABLE b (id int);\nCREATE TABLE c (id int);").tables.values())

    def create(contract):
        if contract.table == "b":
            raise RuntimeError("relation already exists")
        return contract.table == "a"

    assert ddl.apply(tables, create) == (["public.a"], ["public.b", "public.c"])
    with pytest.raises(RuntimeError):
        ddl.apply(tables, lambda c: (_ for _ in ()).throw(RuntimeError("disk full")))


def test_preamble():
    assert ddl.strip_preamble("\\restrict x\nSET client_encoding = 'UTF8';\nSET work_mem = '1';\nx") == "SET work_mem = '1';\nx"


def test_already_exists():
    assert ddl.is_already_exists("42P07")
    assert ddl.is_already_exists("XX000", "relation already exists")
    assert not ddl.is_already_exists("42601", "already exists")


def test_identifiers():
    for bad in ("", "a\x07", 'a"', "a\\b", "a\u202eb", "\ufeff"):
        with pytest.raises(ValueError):
            ids.validate_identifier(bad)
    assert ids.qualified("public", 'a"b') == '"a""b"'
    assert ids.qualified("s", "t") == '"s"."t"'
    assert ids.parse_size("10MB") == 10 << 20
    assert ids.parse_mapping("a:b, c:d") == {"a": "b", "c": "d"}
    for bad in ("a", "a:", ":b", "a:b,a:c", "a:b,c:b"):
        with pytest.raises(ValueError):
            ids.parse_mapping(bad)
    with pytest.raises(ValueError):
        ids.check_listable("s", "t", ["a,b"])
    assert ids.shown("a\u202eb") == "a?b"
    assert ids.parse_char("\\t") == "\t"


def test_retries():
    from tallyport.operators import remote

    assert [remote.pause(n, lambda: 0.5) for n in (1, 2, 3, 9)] == [1, 2, 4, 30]
    assert all(remote.is_transient(s) for s in ("08006", "53300", "57P01", "40001", "OC001"))
    assert remote.is_transient(None, "query timed out after 180s")
    assert not remote.is_transient("23505", "duplicate key")
    assert remote.retried(iter([1]).__next__) == 1
    calls: list[int] = []

    def act():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError("it timed out")
        return "done"

    assert remote.retried(act, sleep=lambda s: None) == "done"
    with pytest.raises(ValueError):
        remote.retried(lambda: (_ for _ in ()).throw(ValueError("no")), sleep=lambda s: None)
