import pytest

from tallyport.contract import ColumnContract, TableContract
from tallyport.plans.store import Store
from tallyport.sources import delimited
from tallyport.streaming.follow import follow


def test_follow_loads_new_files_once(spark, tmp_path):
    store, folder = Store(spark, str(tmp_path / "store")), tmp_path / "in"
    store.create(TableContract("public", "t", (ColumnContract("id", "INTEGER", False), ColumnContract("v", "TEXT")), ("id",)))
    folder.mkdir()
    (folder / "a.csv").write_text("1,a\n2,b\n2,again\nx,c\n3\n")
    run = lambda: follow(store, str(folder), "t", str(tmp_path / "check"))
    run()
    run()
    rows = lambda: sorted((r.id, r.v) for r in store.read("public", "t").collect())
    assert [i for i, _ in rows()] == [1, 2]
    errors = spark.read.parquet(str(tmp_path / "store" / ".errors" / "public.t-follow-0"))
    assert sorted(r.kind for r in errors.collect()) == ["batch_error", "parse_error"]
    (folder / "b.csv").write_text("3,c\n1,other\n")
    run()
    assert [i for i, _ in rows()] == [1, 2, 3]
    assert dict(rows())[1] == "a"
    with pytest.raises(ValueError):
        follow(store, str(folder), "t", str(tmp_path / "check"), dialect=delimited.CSV.with_(header=True))
