"""Every core query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tallyport.plans import registry

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    out = duckdb.connect()
    for path in SF.iterdir():
        out.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return out


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, db, tmp_path, name):
    registry.queries()[name](spark, str(SF)).write.parquet(str(tmp_path / "got"))
    got = f"'{tmp_path}/got/*.parquet'"
    columns = ", ".join(sorted(spark.read.parquet(str(tmp_path / "got")).columns))
    sql = registry.oracle_sql()[name]
    differ = f"SELECT count(*) FROM ((SELECT {columns} FROM ({sql}) EXCEPT ALL SELECT {columns} FROM {got}) UNION ALL (SELECT {columns} FROM {got} EXCEPT ALL SELECT {columns} FROM ({sql})))"
    assert db.execute(differ).fetchall() == [(0,)]


def test_flagship(spark):
    row = registry.flagship(spark, str(SF)).first()
    assert (row.verdict, row.passed) == ("Match", True)
