"""Queries about sources of several parts, records that span lines, the dump index, row groups, the log of a table, several
unique keys and inference. All build their input from the tables with Spark, and read it again by chunks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.contract import ColumnContract, TableContract
from tallyport.functions import copytext, infer
from tallyport.functions.render import render_all
from tallyport.functions.types import SqlType
from tallyport.operators import remote, sink, verify
from tallyport.plans import jobs, registry
from tallyport.plans.database_load import load as database_load_of
from tallyport.plans.registry import query
from tallyport.session import cut
from tallyport.sources import delimited, dumpsource, files
from tallyport.sources.files import Place

HEADER = delimited.CSV.with_(header=True)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry._table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


@query("SELECT doc_id, text, lang, source FROM documents")
def csv_records_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose texts have line ends and quotes, as CSV with a header: loaded by chunks smaller than many records. The
    table has no key, as rows may have none or share one, and all of them are wanted."""
    docs, home = _docs(spark, sf_dir), registry._home(spark, "records")
    text = render_all(docs)
    path = registry._written(text.select(registry._csv_line(text)), home, "documents.csv", ",".join(text.columns) + "\n")
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(TableContract.of(docs, "public", "documents"))
    jobs.load(spark, store, jobs.LoadOptions(path, "documents", dialect=HEADER, chunk_bytes=100_000))
    return store.read("public", "documents")


@query(
    """SELECT fault, CAST(sum(n) AS BIGINT) AS n, CAST(sum(chars) AS BIGINT) AS chars FROM (SELECT CASE WHEN o_orderkey % 19 = 3 THEN 'not valid UTF-8' WHEN o_orderkey % 19 = 5 THEN 'not a record of the table''s width' ELSE 'none' END AS fault, 1 AS n,
 CASE WHEN o_orderkey % 19 IN (3, 5) THEN 0 WHEN o_orderkey % 2 = 0 THEN length(o_orderpriority) * 2 + 7 ELSE length(o_orderpriority) END AS chars FROM orders
 UNION ALL SELECT 'none', 1, 5 UNION ALL SELECT 'a quote that is not closed', 1, 0) GROUP BY fault"""
)
def csv_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that span lines (every second), bytes that are no UTF-8, wrong widths, lines of blanks, empty lines, and at the
    end a quote that does not close: each is told by chunk."""
    orders, home = registry._table(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL"), registry._home(spark, "faults")
    key, word = F.col("o_orderkey"), F.col("o_orderpriority")
    cell = F.when(key % 2 == 0, F.concat(F.lit('"'), word, F.lit('\n"",""""\r\n'), word, F.lit('"'))).otherwise(word).cast("binary")
    cell = F.when(key % 19 == 3, F.concat(F.lit("a").cast("binary"), F.unhex(F.lit("FF")))).otherwise(cell)
    blank = F.when(key % 19 == 5, F.when(key % 2 == 0, F.lit("   ")).otherwise(F.concat(key.cast("string"), F.lit(",a,b")))).cast("binary")
    line = F.coalesce(blank, F.concat(key.cast("string").cast("binary"), F.lit(",").cast("binary"), cell))
    line = F.concat(line, F.when(key % 7 == 0, F.lit("\n\r\n")).otherwise(F.lit("\n")).cast("binary"))
    # Bytes that are no UTF-8 can't be written as text; the parts are written as they are.
    source = home / "orders.csv"
    _write_bytes(orders.select(line.alias("line")), source / "1-lines")
    (source / "0-first").write_text("0,first\n")
    (source / "2-after").write_text('7,"open\n')
    _, rows, _ = delimited.records(spark, source.for_spark, delimited.CSV, 10_000)
    chars = F.when(F.col("fault").isNull(), F.length("row.f1"))
    return rows.groupBy(F.coalesce("fault", F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(chars), F.lit(0)).cast("bigint").alias("chars"))


def _write_bytes(lines: DataFrame, home: Place) -> None:
    """Parts of bytes, written by the tasks."""
    folder = home.source.path

    def write(batches):  # noqa: ANN001, ANN202
        import os
        import uuid

        import pyarrow as pa

        os.makedirs(folder, exist_ok=True)
        name = f"{folder}/part-{uuid.uuid4().hex}"
        rows = 0
        with open(f"{folder}/.{name.rpartition('/')[2]}", "wb") as out:
            for batch in batches:
                for line in batch.column(0):
                    out.write(line.as_py())
                rows += batch.num_rows
        os.rename(f"{folder}/.{name.rpartition('/')[2]}", name)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["n"])

    lines.mapInArrow(write, "n long").agg(F.sum("n")).collect()


@query(
    """SELECT 'public' AS table_schema, 'first' AS table_name, 'id,line' AS columns, count(*) AS n, CAST(count(*) FILTER (WHERE doc_id % 3 = 0) AS BIGINT) AS headers FROM documents
 UNION ALL SELECT 'other', 'se cond', 'id,"l', count(*), 0 FROM documents UNION ALL SELECT 'public', 'none', 'a', 0, 0"""
)
def dump_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data blocks of a dump whose rows look like headers and nearly like block ends, found by its chunks."""
    docs, home = _docs(spark, sf_dir), registry._home(spark, "index")
    hostile = F.when(F.col("doc_id") % 3 == 0, F.lit("COPY x (a) FROM stdin;")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("\\."), F.lit("\t"), F.col("doc_id").cast("string")))
    line = F.coalesce(hostile, copytext.encode_line(F.col("doc_id").cast("string"), F.substring("text", 1, 200)))
    dump = home / "dump.sql"
    for at, (head, rows, tail) in enumerate((
        ("SET lock_timeout = 0;\nCOPY public.first (id, line) FROM stdin;\n", docs.select(line), "\\.\n\n-- COPY (x)\n"),
        ('copy other."se cond" ( id , """l" ) from stdin\n', docs.select(F.col("doc_id").cast("string")), "\\.\r\nCOPY none (a) FROM STDIN;\n\\."),
    )):
        (dump / f"{at}a").write_text(head)
        rows.write.option("lineSep", "\n").text((dump / f"{at}b").for_spark)
        (dump / f"{at}c").write_text(tail)
    out = []
    for b in dumpsource.index(spark, dump.for_spark, 5000):
        lines = dumpsource.raw_lines(spark, dump.for_spark, b.data_start, b.data_end, 50_000)
        found = lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.startswith("raw", F.lit("COPY"))).alias("headers"))
        out.append(found.select(F.lit(b.schema).alias("table_schema"), F.lit(b.table).alias("table_name"), F.lit(",".join(b.columns)).alias("columns"), "n", "headers"))
    first, *rest = out
    for other in rest:
        first = first.unionAll(other)
    return first


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, l_returnflag, CAST(l_orderkey % 5 AS INTEGER) AS shard FROM lineitem")
def parquet_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in files with blanks and percent signs in their names, in nested folders, with columns named like the
    engine's own, loaded by row groups into a table that the load creates."""
    home = registry._home(spark, "odd")
    items = registry._table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("raw"), F.col("l_linenumber").alias("line_no"), F.col("l_quantity").alias("good"), F.col("l_shipdate").alias("chunk_id"), F.col("l_returnflag").alias("a.b"), (F.col("l_orderkey") % 5).cast("int").alias("row")
    )
    for n in range(5):
        items.where(F.col("row") == n).write.option("parquet.block.size", "100000").parquet((home / "in" / ("x y.parquet", "a%20b", "c=1", "d/e#f", "é")[n]).source.path)
    store = jobs.Store(spark, (home / "store").for_spark)
    found = jobs.load(spark, store, jobs.LoadOptions((home / "in").source.path, "odd", format="parquet", create=True, chunk_bytes=50_000))
    if (found.loaded, found.failed) != (found.source_rows, 0):
        raise AssertionError(found)
    return store.read("public", "odd").toDF("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "shard")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads into one table without a key, at once: every row is there, once."""
    orders, home = registry._table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), registry._home(spark, "race")
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(TableContract.of(orders, "public", "orders"))
    paths = []
    for n in range(4):
        orders.where(F.col("o_orderkey") % 4 == n).write.parquet(path := (home / f"in{n}").for_spark)
        paths.append(path)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda path: jobs.load(spark, store, jobs.LoadOptions(path, "orders", format="parquet")), paths))
    return store.read("public", "orders")


_LINKS = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders"


@query(f"SELECT o_orderkey FROM ({_LINKS}) WHERE r % 1000 % 2 = 0 AND r % 1000 >= 4 UNION ALL SELECT o_orderkey FROM ({_LINKS}) WHERE r % 1000 = 0")
def several_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of a thousand rows, each of which shares its number with the row before or its name with the row after: taken in
    order, every second goes in. Rows 1 and 3 of each chain are in the table before, under other names, and keep 2 out."""
    rows = registry.numbered(registry._table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    chain, at = F.floor(F.col("r") / 1000), F.col("r") % 1000
    new = rows.select(F.col("r").alias("at"), "o_orderkey", (chain * 1000 + F.floor(at / 2)).alias("number"), F.concat(chain.cast("string"), F.lit("n"), F.floor((at + 1) / 2).cast("string")).alias("name"))
    target = rows.where(at.isin(3)).select((chain * 1000 + F.floor(at / 2)).alias("number"), F.lit(None).cast("string").alias("name"))
    kept = sink.do_nothing(target, new, [["number"], ["name"]], F.col("at"))
    return kept.select("o_orderkey")


@query(
    """SELECT 'loaded' AS counter, count(*) FILTER (WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0) AS n FROM orders UNION ALL SELECT 'failed', count(*) FILTER (WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0) FROM orders
 UNION ALL SELECT 'parse_errors', count(*) FILTER (WHERE o_orderkey % 17 = 0) FROM orders
 UNION ALL SELECT 'bytes', CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1 + CASE WHEN o_orderkey % 13 = 0 THEN 4 ELSE length(CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR)) END + CASE WHEN o_orderkey % 17 <> 0 THEN 1 + length(o_orderstatus) ELSE 0 END) AS BIGINT) FROM orders"""
)
def load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load counts while it stages its rows."""
    home = registry._home(spark, "counters")
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(registry._UNFIT)
    found = jobs.load(spark, store, jobs.LoadOptions(registry._unfit(registry._table(spark, sf_dir, "orders"), home), "t", dialect=HEADER, batch_size=1))
    return spark.createDataFrame([(n, getattr(found, n)) for n in ("loaded", "failed", "parse_errors", "bytes")], "counter string, n long")


@query(
    """SELECT 'id' AS column_name, CASE WHEN max(c_custkey) <= 32767 THEN 'SMALLINT' ELSE 'INTEGER' END AS type_name, false AS nullable FROM customer UNION ALL SELECT 'full_name', 'TEXT', false
 UNION ALL SELECT 'c_acctbal', 'REAL', false UNION ALL SELECT 'c_mktsegment', 'TEXT', true UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR), false FROM customer"""
)
def load_creates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a table that a load creates from a CSV file, two of them renamed."""
    home = registry._home(spark, "creates")
    customer = registry._table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    text = render_all(customer)
    path = registry._written(text.select(registry._csv_line(text)), home, "customer.csv", ",".join(text.columns) + "\n")
    store = jobs.Store(spark, (home / "store").for_spark)
    found = jobs.load(spark, store, jobs.LoadOptions(path, "c", dialect=HEADER, create=True, rename={"c_custkey": "id", "c_name": "full_name"}))
    rows = [(c.name, c.type_name, c.nullable) for c in store.contract("public", "c").columns]
    return spark.createDataFrame([*rows, ("rows", str(found.loaded), False)], "column_name string, type_name string, nullable boolean")


@query("SELECT s_suppkey AS id, s_name AS full_name, 'new' AS status, s_nationkey FROM supplier")
def load_excludes_and_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that leaves a column to its default and renames another."""
    home = registry._home(spark, "excludes")
    text = render_all(registry._table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit("old").alias("status"), "s_nationkey"))
    path = registry._written(text.select(registry._csv_line(text)), home, "s.csv", ",".join(text.columns) + "\n")
    store = jobs.Store(spark, (home / "store").for_spark)
    columns = (ColumnContract("id", "BIGINT", False), ColumnContract("full_name", "TEXT"), ColumnContract("status", "TEXT", default="'new'"), ColumnContract("s_nationkey", "INTEGER"))
    store.create(TableContract("public", "s", columns, ("id",)))
    jobs.load(spark, store, jobs.LoadOptions(path, "s", dialect=HEADER, exclude=("status",), rename={"s_suppkey": "id", "s_name": "full_name"}))
    return store.read("public", "s")


@query(
    """SELECT 'first' AS run, count(*) AS loaded FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'killed', 0 UNION ALL SELECT 'second', count(*) FROM orders WHERE o_orderkey % 2 = 1 UNION ALL SELECT 'total', count(*) FROM orders"""
)
def load_survives_kill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resumable load of one half, then of the other into a table without a key, where the driver dies after the rows were
    written and before they were named: nothing of that run is there, and the next one loads all of it, once."""
    orders, home = registry._table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), registry._home(spark, "kill")
    for n in range(2):
        orders.where(F.col("o_orderkey") % 2 == n).write.parquet((home / f"in{n}").for_spark)
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(TableContract.of(orders, "public", "orders"))
    options = [jobs.LoadOptions((home / f"in{n}").for_spark, "orders", format="parquet", resume=(home / f"job{n}.json").for_spark) for n in range(2)]
    first = jobs.load(spark, store, options[0]).loaded
    dying = _Dying(spark, (home / "store").for_spark)
    try:
        jobs.load(spark, dying, options[1])
    except KeyboardInterrupt:
        pass
    killed = store.read("public", "orders").count() - first
    second = jobs.load(spark, store, options[1]).loaded + jobs.load(spark, store, options[1]).loaded
    total = store.read("public", "orders").count()
    return spark.createDataFrame([("first", first), ("killed", killed), ("second", second), ("total", total)], "run string, loaded long")


class _Dying(jobs.Store):
    """A store whose driver dies where a version would be made."""

    def commit(self, schema, table, change):  # noqa: ANN001, ANN201
        change(self.version(schema, table))
        raise KeyboardInterrupt


def _kind_texts() -> dict[SqlType, object]:
    key = F.col("s_suppkey")
    return {
        SqlType.BOOLEAN: F.lit("t"), SqlType.SMALLINT: (key % 100 + 2).cast("string"), SqlType.INTEGER: (key + 100_000).cast("string"), SqlType.BIGINT: (key + 10_000_000_000).cast("string"),
        SqlType.REAL: F.concat(key.cast("string"), F.lit(".5")), SqlType.DOUBLE: F.concat(key.cast("string"), F.lit("e1")), SqlType.TEXT: F.col("s_name"), SqlType.DATE: F.lit("2024-02-29"), SqlType.TIMESTAMP: F.lit("2024-02-29 10:00"),
    }


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each pair of types the type of a column whose first suppliers, by key, have texts of the one and whose last ones
    have texts of the other."""
    texts = _kind_texts()
    pairs = [(a, b) for a in texts for b in texts]
    rows = registry._table(spark, sf_dir, "supplier")
    half = rows.agg(F.percentile_approx("s_suppkey", 0.5)).first()[0]
    columns = rows.select(F.col("s_suppkey").alias("k"), *(F.when(F.col("s_suppkey") < half, texts[a]).otherwise(texts[b]).alias(f"p{i}") for i, (a, b) in enumerate(pairs)))
    found = infer.infer(columns.orderBy("k").drop("k"))
    return spark.createDataFrame([(a.value, b.value, f.type.value) for (a, b), f in zip(pairs, found, strict=True)], "left_type string, right_type string, common string")


@query("SELECT 'estimate' AS what, count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL UNION ALL SELECT 'bytes', 11 * count(*) FROM orders")
def estimated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the mean length of the first lines: exact where all are of one length."""
    home = registry._home(spark, "estimate")
    lines = registry._table(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL").select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    place = Place.of(registry._written(lines, home, "keys.csv"))
    with place.open() as file:
        found = [("estimate", files.rows_in(file, 0, file.size())), ("bytes", file.size())]
    return spark.createDataFrame(found, "what string, n long")


@query(
    """WITH c AS (SELECT c_nationkey AS k, count(*) AS source, count(*) FILTER (WHERE c_custkey % 7 = 0) AS failed, count(*) FILTER (WHERE c_custkey % 7 <> 0) AS loaded, count(*) FILTER (WHERE c_custkey % 7 <> 0 AND c_custkey % 11 = 0) AS gone FROM customer GROUP BY 1),
 d AS (SELECT k, source, CASE WHEN k % 6 = 1 THEN loaded - 1 ELSE loaded END AS loaded, failed, CASE k % 6 WHEN 2 THEN loaded + 3 WHEN 3 THEN loaded - gone ELSE CASE WHEN k % 6 = 1 THEN loaded - 1 ELSE loaded END END AS growth, CASE WHEN k % 6 = 4 THEN gone ELSE 0 END AS missing, CASE WHEN k % 6 >= 4 THEN source ELSE 0 END AS mismatched FROM c)
 SELECT k AS nation, CASE WHEN source > loaded + failed THEN 'LoaderDropped(' || (source - loaded - failed) || ')' WHEN growth > loaded THEN 'ExtraTarget(' || (growth - loaded) || ')' WHEN growth < loaded THEN 'MissingTarget(' || (loaded - growth) || ')'
 WHEN missing > 0 THEN 'ValueRowMissingAtTarget(' || missing || ')' WHEN mismatched > 0 THEN 'ValueMismatch(' || mismatched || ')' ELSE 'Match' END AS verdict FROM d"""
)
def verdicts_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for each nation's customers as if they had been loaded, with losses and changes of every kind."""
    key, k = F.col("c_custkey"), F.col("c_nationkey")
    c = registry._table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("source"), F.count_if(key % 7 == 0).alias("failed"), F.count_if(key % 7 != 0).alias("all"), F.count_if((key % 7 != 0) & (key % 11 == 0)).alias("gone")
    )
    case = k % 6
    c = c.withColumn("loaded", F.when(case == 1, F.col("all") - 1).otherwise(F.col("all"))).withColumn("pre", F.lit(5))
    post = F.col("pre") + F.when(case == 2, F.col("all") + 3).when(case == 3, F.col("all") - F.col("gone")).otherwise(F.col("loaded"))
    value = verify.verdict(F.col("source"), F.col("loaded"), F.col("failed"), F.col("pre"), post, F.lit("error"), F.lit(False), F.when(case == 4, F.col("gone")).otherwise(0), F.when(case >= 4, F.col("source")).otherwise(0))
    return c.select(k.alias("nation"), value.alias("verdict"))


@query("SELECT CAST(c AS INTEGER) AS chunk_id FROM (SELECT unnest(range((SELECT max(o_orderkey) // 1000 + 1 FROM orders))) AS c) WHERE c NOT IN (SELECT o_orderkey // 1000 FROM orders WHERE (o_orderkey // 1000) % 7 <> 3)")
def chunks_without_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of a thousand keys of which no row has a result."""
    from tallyport.operators import accounting

    orders = registry._table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 1000).cast("int").alias("chunk_id"))
    chunks = orders.agg(F.max("chunk_id")).first()[0] + 1
    return accounting.missing_chunks(orders.where("chunk_id % 7 <> 3").distinct(), chunks)


@query(
    """WITH o AS (SELECT *, o_orderkey // 400 AS b FROM orders), hit AS (SELECT DISTINCT b FROM o WHERE o_orderkey % 1499 = 0), own AS (SELECT b, b IN (SELECT b FROM hit) OR b % 5 = 4 AS failed FROM (SELECT DISTINCT b FROM o)),
 late AS (SELECT b, failed OR (b % 5 = 1 AND (SELECT min(x.o_orderkey) FROM o x WHERE x.b = own.b - 1) % 1499 = 0) AS failed, b % 5 = 1 AND NOT coalesce((SELECT x.failed FROM own x WHERE x.b = own.b - 1), true) AS after FROM own) SELECT b AS batch_id, failed OR after AS failed FROM late"""
)
def batches_in_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 400 order keys. Some keys are in the target; every fifth batch has a key twice; every fifth shares a key with
    the batch before, which makes it fail unless that one failed."""
    orders = registry._table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.floor(F.col("o_orderkey") / 400).alias("batch_id"))
    least = orders.groupBy("batch_id").agg(F.min("k").alias("k"))
    twice = least.where("batch_id % 5 = 4").select("k", "batch_id")
    shared = least.where("batch_id % 5 = 0").select("k", (F.col("batch_id") + 1).alias("batch_id")).join(orders.select("batch_id").distinct(), "batch_id", "left_semi").select("k", "batch_id")
    return sink.error_batches(orders.where("k % 1499 = 0").select("k"), orders.unionAll(twice).unionAll(shared), ["k"])


class _Breaking:
    """A connection that breaks for some batches when they are first tried: in the rows, or after the commit, so that whoever
    asked can't know that it happened."""

    def __init__(self, connection, broken: set) -> None:  # noqa: ANN001
        self.connection, self.broken, self.batch = connection, broken, None
        self.rollback, self.close = connection.rollback, connection.close

    def cursor(self) -> _Breaking:
        self.at = self.connection.cursor()
        self.fetchall, self.fetchmany = self.at.fetchall, self.at.fetchmany
        return self

    def execute(self, sql: str, values: tuple = ()) -> None:
        self.at.execute(sql, values)
        self.rowcount, self.description = self.at.rowcount, self.at.description
        self.batch = values[1:3] if len(values) == 4 else None

    def executemany(self, sql: str, rows: list[tuple]) -> None:
        self.at.executemany(sql, rows[: len(rows) // 2])
        self._break(1)
        self.at.executemany(sql, rows[len(rows) // 2 :])

    def commit(self) -> None:
        self.connection.commit()
        self._break(2)

    def _break(self, when: int) -> None:
        if self.batch and sum(self.batch) % 3 == when and self.batch not in self.broken:
            self.broken.add(self.batch)
            raise ConnectionError("the connection broke")


def _database(home: Place, breaking: bool = False) -> remote.Database:
    """A database file in the shared folder."""
    (home / "made").write_text("")
    opened, broken = remote.Database.of(f"sqlite:{(home / 'target.db').source.path}"), set()
    return replace(opened, connect=lambda: _Breaking(opened.connect(), broken), sleep=lambda s: None) if breaking else opened


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def database_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV, loaded into a table of a database without a key while connections break before and after commits, then
    loaded by the same job again: each row is there once. Read back by ranges of the key."""
    orders, home = registry._table(spark, sf_dir, "orders"), registry._home(spark, "database")
    text = render_all(orders)
    path = registry._written(text.select(registry._csv_line(text)), home, "orders.csv")
    contract, database = TableContract.of(orders, "public", "orders"), _database(home, breaking=True)
    database.create(contract)
    options = jobs.LoadOptions(path, "orders", batch_size=500, chunk_bytes=200_000)
    first = database_load_of(spark, database, contract, options, "orders", connections=4)
    again = database_load_of(spark, database, contract, options, "orders")
    if again.loaded or first.failed:
        raise AssertionError(f"{again.loaded} rows went in twice, {first.failed} failed")
    return remote.read(spark, database, contract, "o_orderkey", 8)


@query(
    """SELECT o_orderkey // 400 AS batch, count(*) AS n, CASE WHEN bool_or(o_orderkey % 1499 = 0) THEN 'failed' ELSE 'loaded' END AS outcome FROM orders GROUP BY 1"""
)
def database_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 400 order keys into a database's table that has some of them, conflicts being errors: what became of each."""
    key = F.col("o_orderkey")
    orders, home = registry._table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), registry._home(spark, "database")
    contract, database = TableContract.of(orders, "public", "orders", ("o_orderkey",)), _database(home)
    database.create(contract)
    database.prepare()

    def rows(df: DataFrame) -> DataFrame:
        nothing = F.lit(None).cast("string")
        placed = df.select(F.floor(key / 10_000).cast("int").alias("chunk_id"), F.floor(key % 10_000 / 400).cast("int").alias("batch_id"), key.alias("line_no"), nothing.alias("fault"), nothing.alias("why"), F.struct(*df.columns).alias("row"))
        return remote.together(placed)

    put = lambda df, job: cut(remote.write(rows(df), database, job, '"orders"', contract.names, contract.keys, sink.OnConflict.ERROR), "database-batches")
    put(orders.where(key % 1499 == 0), "first")
    return put(orders, "second").select((F.col("chunk_id").cast("long") * 25 + F.col("batch_id")).alias("batch"), "n", "outcome")


@query("SELECT o_custkey AS k, CAST(count(*) AS BIGINT) AS orders, CAST(max(o_orderkey) AS BIGINT) AS latest FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1 UNION ALL SELECT c_custkey, 0, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 2 = 0)")
def database_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of all customers in a database, whose rows a second load replaces where customers have orders."""
    home = registry._home(spark, "database")
    even = registry._table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("latest"))
    empty = registry._table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit(0).cast("long").alias("orders"), F.lit(None).cast("long").alias("latest"))
    contract, database = TableContract.of(even, "public", "latest", ("k",)), _database(home)
    database.create(contract)
    for job, df in (("all", empty), ("even", even)):
        df.write.parquet((home / job).for_spark)
        database_load_of(spark, database, contract, jobs.LoadOptions((home / job).for_spark, "latest", format="parquet", on_conflict=sink.OnConflict.DO_UPDATE), job)
    return remote.read(spark, database, contract, "k", 4)
