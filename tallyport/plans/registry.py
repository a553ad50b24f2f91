"""Queries of the core library by name, each with the SQL that must give the same rows.

The tables hold no NULL and no blank text, so queries about those make such values from a key, alike on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions import copytext
from tallyport.functions.casts import failed, recast
from tallyport.functions.identifiers import identifier_ok
from tallyport.functions.infer import infer, value_type
from tallyport.functions.nulls import blank_to_null
from tallyport.functions.render import float_text, render, render_all
from tallyport.functions.types import sql_type
from tallyport.operators import accounting, export, shape, sink, verify
from tallyport.contract import ColumnContract, TableContract
from tallyport.plans import jobs
from tallyport.session import shared_folder
from tallyport.sources import delimited, dumpscan, dumpsource
from tallyport.sources.files import Place

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Scans


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def scan_parquet_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in TABLES]
    return reduce(DataFrame.unionAll, counts)


def _blanks(text: Column) -> Column:
    key = F.col("doc_id") % 4
    return F.when(key == 0, F.lit(None)).when(key == 1, F.lit(" \t\u00a0 ")).when(key == 2, F.lit("")).otherwise(F.concat(F.lit("  "), text))


@query(
    "SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN '  ' || text END AS kept, CASE WHEN doc_id % 4 = 3 THEN 0 ELSE 1 END AS is_null FROM documents"
)
def blank_to_null_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = blank_to_null(_blanks(F.col("text")))
    return _table(spark, sf_dir, "documents").select("doc_id", kept.alias("kept"), kept.isNull().cast("int").alias("is_null"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate + INTERVAL 1500 MILLISECOND, '%Y-%m-%d %H:%M:%S') || '.500' AS stamp FROM orders")
def render_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", render(F.col("o_orderdate").cast("date"), T.DateType()).alias("day"), render(F.col("o_orderdate") + F.expr("interval 1500 milliseconds"), T.TimestampNTZType()).alias("stamp"))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price, CAST(CAST(-(o_orderkey % 100) AS DECIMAL(15, 2)) / 100 AS DECIMAL(15, 2)) AS small FROM orders")
def render_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(15,2)")
    small = (F.expr("CAST(-(o_orderkey % 100) AS DECIMAL(15,2)) / 100")).cast("decimal(15,2)")
    return _table(spark, sf_dir, "orders").select("o_orderkey", render(price, T.DecimalType(15, 2)).alias("price"), small.alias("small"))


_ENCODED = "replace(replace(replace(replace(replace(replace(replace({}, '\\', '\\\\'), chr(8), '\\b'), chr(12), '\\f'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t'), chr(11), '\\v')"


@query(f"SELECT doc_id, CAST(doc_id AS VARCHAR) || chr(9) || coalesce({_ENCODED.format('CASE WHEN doc_id % 3 = 0 THEN NULL ELSE text END')}, '\\N') || chr(9) || {_ENCODED.format('lang')} AS line FROM documents")
def copy_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", copytext.encode_line(F.col("doc_id").cast("string"), text, F.col("lang")).alias("line"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' WHEN doc_id % 5 = 2 THEN '\\N' || chr(9) || text ELSE text END AS text, 1 AS same FROM documents")
def copy_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id") % 5
    text = F.when(key == 0, F.lit(None)).when(key == 1, F.lit("")).when(key == 2, F.concat(F.lit("\\N\t"), F.col("text"))).otherwise(F.col("text"))
    line = _table(spark, sf_dir, "documents").select(text.alias("was"), copytext.encode_line(F.col("doc_id").cast("string"), text).alias("line"))
    back = copytext.decoded(line, "line", ["doc_id", "text"])
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("text").eqNullSafe(F.col("was")).cast("int").alias("same"))


@query(
    "SELECT l_orderkey, l_linenumber, n - CASE WHEN k = 1 THEN 1 ELSE 0 END AS n_fields, k <> 1 AS good FROM (SELECT l_orderkey, l_linenumber, 3 AS n, l_orderkey % 7 AS k FROM lineitem)"
)
def dump_line_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field missing (every seventh order) or a carriage return at their end."""
    line = F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.when(F.col("l_orderkey") % 7 != 1, F.lit("")), F.col("l_returnflag"))
    n = F.size(copytext.fields(F.concat(line, F.when(F.col("l_orderkey") % 2 == 0, F.lit("\r")).otherwise(F.lit("")))))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", n.alias("n_fields"), (n == 3).alias("good"))


# Inference and coercion

_VALUES = """SELECT part, id, CASE part WHEN 0 THEN CAST(id AS VARCHAR) WHEN 1 THEN CAST(id * 1000003 AS VARCHAR) WHEN 2 THEN CAST(CAST(price AS DECIMAL(12, 2)) AS VARCHAR)
 WHEN 3 THEN strftime(day, '%Y-%m-%d') WHEN 4 THEN strftime(day, '%Y-%m-%d %H:%M:%S') WHEN 5 THEN word WHEN 6 THEN CASE WHEN id % 2 = 0 THEN 'true' ELSE 'F' END WHEN 7 THEN CASE WHEN id % 2 = 0 THEN '' END
 ELSE strftime(day, '%m/%d/%Y') END AS v FROM (SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate AS day, o_orderpriority AS word FROM orders) CROSS JOIN (SELECT unnest(range(9)) AS part)"""


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    forms = [
        F.col("o_orderkey").cast("string"), (F.col("o_orderkey") * 1000003).cast("string"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss"), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("F"), F.when(F.col("o_orderkey") % 2 == 0, ""), F.date_format(day, "MM/dd/yyyy"),
    ]
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.posexplode(F.array(*forms)).alias("part", "v"))


@query(
    f"""SELECT part, type_name, count(*) AS n FROM (SELECT part, CASE WHEN v IS NULL OR v = '' THEN NULL WHEN lower(v) IN ('true', 'false', 't', 'f', '0', '1') THEN 'BOOLEAN'
 WHEN regexp_full_match(v, '-?[0-9]+') THEN CASE WHEN abs(CAST(v AS BIGINT)) <= 32767 THEN 'SMALLINT' WHEN abs(CAST(v AS BIGINT)) <= 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END
 WHEN regexp_full_match(v, '-?[0-9]+[.][0-9]+') THEN 'REAL' WHEN regexp_full_match(v, '[0-9]+-[0-9]+-[0-9]+|[0-9]+/[0-9]+/[0-9]+') THEN 'DATE'
 WHEN regexp_full_match(v, '[0-9]+-[0-9]+-[0-9]+ [0-9:]+') THEN 'TIMESTAMP' ELSE 'TEXT' END AS type_name FROM ({_VALUES})) GROUP BY ALL"""
)
def infer_value_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir).select("part", value_type(F.col("v")).alias("type_name")).groupBy("part", "type_name").agg(F.count(F.lit(1)).alias("n"))


_INT_TYPE = "CASE WHEN max({0}) <= 32767 THEN 'SMALLINT' ELSE 'INTEGER' END"


@query(
    f"""WITH s AS (SELECT * FROM customer), o AS (SELECT * FROM orders)
 SELECT 'c_custkey' AS column_name, {_INT_TYPE.format('c_custkey')} AS type_name, 0 AS nullable FROM s UNION ALL SELECT 'c_name', 'TEXT', 0 UNION ALL SELECT 'c_nationkey', {_INT_TYPE.format('c_nationkey')}, 0 FROM s
 UNION ALL SELECT 'c_acctbal', 'REAL', 0 UNION ALL SELECT 'c_mktsegment', 'TEXT', CASE WHEN count(*) FILTER (WHERE c_custkey % 3 = 0) > 0 THEN 1 ELSE 0 END FROM s
 UNION ALL SELECT 'o_orderkey', {_INT_TYPE.format('o_orderkey')}, 0 FROM o UNION ALL SELECT 'o_orderdate', 'DATE', 0"""
)
def infer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of customers and orders in order of key."""
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).otherwise(F.lit(" "))
    text = render_all(_table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)")).withColumn("c_mktsegment", segment))
    orders = render_all(_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")))
    found = infer(text, [F.col("c_custkey").cast("bigint")]) + infer(orders, [F.col("o_orderkey").cast("bigint")])
    return spark.createDataFrame([(c.name, c.type.value, int(c.nullable)) for c in found], "column_name string, type_name string, nullable int")


@query(
    """WITH v AS (SELECT o_orderkey AS k, (SELECT min(o_orderkey) FROM orders) AS low, (SELECT max(o_orderkey) FROM orders) AS high FROM orders)
 SELECT 'up' AS direction, CASE WHEN count(*) FILTER (WHERE k > low + 1 AND k % 2 = 1) > 0 THEN 'REAL' ELSE 'TEXT' END AS type_name, CASE WHEN count(*) FILTER (WHERE k % 5 = 0 AND k > low) > 0 THEN 1 ELSE 0 END AS nullable FROM v
 UNION ALL SELECT 'down', 'TEXT', CASE WHEN count(*) FILTER (WHERE k % 5 = 0 AND k > low) > 0 THEN 1 ELSE 0 END FROM v"""
)
def infer_fold_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold depends on row order: a truth value, whole numbers and fractions of all orders by key are real upwards, text
    downwards, where the truth value comes last."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    low = orders.agg(F.min("k")).first()[0]
    odd = F.when((F.col("k") % 2 == 1) & (F.col("k") > low + 1), F.concat(F.col("k").cast("string"), F.lit(".5"))).otherwise((F.col("k") % 100 + 2).cast("string"))
    v = F.when(F.col("k") == low, "1").when(F.col("k") % 5 == 0, F.lit(" ")).otherwise(odd)
    out = []
    for name, order in (("up", F.col("k").asc()), ("down", F.col("k").desc())):
        # Downwards whole numbers would come before the truth value too, and keep it one: only fractions there.
        values = v if name == "up" else F.when((F.col("k") == low) | (F.col("k") % 2 == 1), v)
        (found,) = infer(orders.orderBy(order).select(values.alias("v")))
        out.append((name, found.type.value, int(found.nullable)))
    return spark.createDataFrame(out, "direction string, type_name string, nullable int")


@query(
    """WITH k(n, r) AS (VALUES ('BOOLEAN', 0), ('SMALLINT', 1), ('INTEGER', 2), ('BIGINT', 3), ('REAL', 5), ('DOUBLE PRECISION', 6), ('TEXT', 99), ('DATE', 20), ('TIMESTAMP', 21))
 SELECT a.n AS left_type, b.n AS right_type, CASE WHEN a.n = b.n THEN a.n WHEN least(a.r, b.r) = 0 AND greatest(a.r, b.r) BETWEEN 1 AND 4 THEN CASE WHEN a.r = 0 THEN b.n ELSE a.n END
 WHEN least(a.r, b.r) >= 1 AND greatest(a.r, b.r) <= 3 THEN CASE WHEN a.r > b.r THEN a.n ELSE b.n END
 WHEN least(a.r, b.r) BETWEEN 1 AND 3 AND greatest(a.r, b.r) BETWEEN 4 AND 6 THEN CASE WHEN a.r > b.r THEN a.n ELSE b.n END
 WHEN least(a.r, b.r) >= 4 AND greatest(a.r, b.r) <= 6 THEN 'DOUBLE PRECISION'
 WHEN least(a.r, b.r) >= 20 AND greatest(a.r, b.r) <= 21 THEN CASE WHEN a.r > b.r THEN a.n ELSE b.n END ELSE 'TEXT' END AS common FROM k a, k b WHERE (SELECT count(*) FROM supplier) > 1"""
)
def promotion_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_queries.promotions(spark, sf_dir)


@query(
    f"""SELECT part, count(*) AS n, count(v) FILTER (WHERE TRY_CAST(v AS INTEGER) IS NULL OR contains(v, '.')) AS bad_int, count(v) FILTER (WHERE TRY_CAST(v AS DOUBLE) IS NULL) AS bad_double,
 count(v) FILTER (WHERE lower(v) NOT IN ('true', 'f', '1', '0')) AS bad_bool, count(v) FILTER (WHERE part NOT IN (3, 4, 8)) AS bad_date FROM ({_VALUES}) GROUP BY part"""
)
def recast_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    bad = lambda kind: F.count_if(failed(v, recast(v, kind)))
    return _values(spark, sf_dir).groupBy("part").agg(F.count(F.lit(1)).alias("n"), bad("INTEGER").alias("bad_int"), bad("DOUBLE PRECISION").alias("bad_double"), bad("BOOLEAN").alias("bad_bool"), bad("DATE").alias("bad_date"))


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10, 1)) AS price, CAST(o_orderdate AS DATE) AS us_day, o_orderdate AS stamp FROM orders")
def recast_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in forms that a plain cast does not take, recast to parameterised types."""
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        recast(F.col("o_totalprice").cast("decimal(15,4)").cast("string"), "numeric(10,1)").alias("price"),
        recast(F.date_format("o_orderdate", "MM/dd/yyyy"), "date").alias("us_day"),
        recast(F.date_format(F.col("o_orderdate") + F.expr("interval 400 milliseconds"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), "timestamp(0)").alias("stamp"),
    )


@query("SELECT table_name, column_name, type_name FROM (VALUES ('nation', 'n_nationkey', 'INTEGER'), ('nation', 'n_name', 'TEXT'), ('nation', 'n_regionkey', 'INTEGER'), ('events', 'event_id', 'BIGINT'), ('events', 'ts', 'TIMESTAMP'), ('events', 'user_id', 'BIGINT'), ('events', 'event_type', 'TEXT'), ('events', 'value', 'DOUBLE PRECISION'), ('events', 'props', 'TEXT'), ('embeddings', 'embedding', 'rejected')) AS t(table_name, column_name, type_name)")
def table_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types by name; a nested column is refused."""
    rows = [(t, f.name, sql_type(f.dataType)) for t in ("nation", "events") for f in _table(spark, sf_dir, t).schema.fields]
    for field in _table(spark, sf_dir, "embeddings").schema.fields:
        try:
            sql_type(field.dataType)
        except ValueError:
            rows.append(("embeddings", field.name, "rejected"))
    return spark.createDataFrame(rows, "table_name string, column_name string, type_name string")


# Shape


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def exclude_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.exclude(_table(spark, sf_dir, "customer"), ["c_acctbal"])


@query("SELECT c_custkey AS id, c_name AS full_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.rename(_table(spark, sf_dir, "customer"), {"c_custkey": "id", "c_name": "full_name"})


@query("SELECT c_name, c_custkey, c_mktsegment, c_acctbal, c_nationkey FROM customer")
def reorder_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.align(_table(spark, sf_dir, "customer"), ["c_name", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"])


@query("SELECT s_suppkey, s_name, 1 AS good FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey, CAST(NULL AS VARCHAR), 0 FROM supplier WHERE s_suppkey % 3 = 0")
def exclude_raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fields without the second; rows of another width are flagged."""
    fields = F.when(F.col("s_suppkey") % 3 == 0, F.array("s_name")).otherwise(F.array(F.col("s_suppkey").cast("string"), F.lit("x"), F.col("s_name")))
    kept, good = shape.exclude_fields(fields, 3, [1])
    return _table(spark, sf_dir, "supplier").select("s_suppkey", F.when(good, F.get(kept, F.lit(1))).alias("s_name"), good.cast("int").alias("good"))


# Batches, chunks, conflicts

BATCH, CHUNK = 2000, 5000
_ROWS = f"SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) AS r FROM orders"
_BATCHED = f"SELECT *, CAST(r // {CHUNK} AS INTEGER) AS chunk_id, CAST((r % {CHUNK}) // {BATCH} AS INTEGER) AS batch_id FROM ({_ROWS})"


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Rows with r, their place in order of a key, from 0. Ranges are numbered by themselves; only their counts meet."""
    ranged = df.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id())
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return ranged.withColumn("_at", inside).join(starts, "_part").withColumn("r", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return rows.withColumn("chunk_id", F.floor(F.col("r") / CHUNK).cast("int")).withColumn("batch_id", sink.batch_id(F.col("r") % CHUNK + 1, BATCH))


@query(f"SELECT o_orderkey, chunk_id, batch_id FROM ({_BATCHED})")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("o_orderkey", "chunk_id", "batch_id")


@query(
    f"""SELECT chunk_id, count(*) AS n_batches, CAST(sum(CASE WHEN bad = 0 THEN n ELSE 0 END) AS BIGINT) AS loaded, CAST(sum(CASE WHEN bad > 0 THEN n ELSE 0 END) AS BIGINT) AS failed
 FROM (SELECT chunk_id, batch_id, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3001 = 0) AS bad FROM ({_BATCHED}) GROUP BY ALL) GROUP BY chunk_id"""
)
def chunk_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bad row fails its batch."""
    rows = _batched(spark, sf_dir).withColumn("bad", F.col("o_orderkey") % 3001 == 0)
    return accounting.chunk_totals(accounting.batch_totals(rows))


@query(
    "SELECT (SELECT count(*) FROM orders) AS whole, CAST(NULL AS BIGINT) AS with_a_gap, CAST(NULL AS BIGINT) AS without_a_chunk"
)
def source_row_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum of chunk counts is unknown as soon as one chunk's is."""
    counts = _table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 5).alias("chunk_id")).agg(F.count(F.lit(1)).alias("source_rows"))
    whole = accounting.source_rows(counts, 5).select(F.col("source_rows").alias("whole"), F.lit(1).alias("one"))
    gap = accounting.source_rows(counts.withColumn("source_rows", F.when(F.col("chunk_id") != 2, F.col("source_rows"))), 5).select(F.col("source_rows").alias("with_a_gap"), F.lit(1).alias("one"))
    short = accounting.source_rows(counts.where("chunk_id <> 4"), 5).select(F.col("source_rows").alias("without_a_chunk"), F.lit(1).alias("one"))
    return whole.join(gap, "one").join(short, "one").drop("one")


_TARGET = "SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0"
_NEW = "SELECT o_orderkey, o_totalprice + 1 AS price, 0 AS part FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, o_totalprice + 2, 1 FROM orders WHERE o_orderkey % 9 = 0"


def _conflict(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("price") + 1).alias("price"), F.lit(0).alias("part"))
    again = orders.where("o_orderkey % 9 = 0").select("o_orderkey", (F.col("price") + 2).alias("price"), F.lit(1).alias("part"))
    return orders.where("o_orderkey % 2 = 0"), new.unionAll(again)


@query(f"SELECT o_orderkey, price FROM ({_TARGET}) UNION ALL SELECT o_orderkey, arg_min(price, part) FROM ({_NEW}) WHERE o_orderkey % 2 <> 0 GROUP BY o_orderkey")
def upsert_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, new = _conflict(spark, sf_dir)
    return target.unionByName(sink.do_nothing(target, new, ["o_orderkey"], F.col("part")).drop("part"))


@query(f"SELECT o_orderkey, price FROM ({_TARGET}) WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, arg_max(price, part) FROM ({_NEW}) GROUP BY o_orderkey")
def upsert_do_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, new = _conflict(spark, sf_dir)
    return sink.do_update(target, new, ["o_orderkey"], F.col("part"))


@query("SELECT CAST(b AS INTEGER) AS batch_id, b IN (1, 2, 4) AS failed FROM (SELECT unnest(range(5)) AS b)")
def conflict_error_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 has a key of the target, 2 a key twice, 4 a key of batch 3; 3 has a key of 1, which never went in."""
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    target = nation.where("k >= 20")
    rows = [nation.where("k < 3").select("k", F.lit(0).alias("batch_id")), nation.where("k in (3, 20)").select("k", F.lit(1).alias("batch_id"))]
    rows += [nation.where("k = 4").select("k", F.lit(2).alias("batch_id"))] * 2
    rows += [nation.where("k in (3, 5)").select("k", F.lit(3).alias("batch_id")), nation.where("k in (5, 6)").select("k", F.lit(4).alias("batch_id"))]
    return sink.error_batches(target, reduce(DataFrame.unionAll, rows), ["k"])


@query("SELECT s_suppkey, s_name, s_nationkey, CAST(7.5 AS DOUBLE) AS s_acctbal FROM supplier")
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    return sink.fill_defaults(supplier.drop("s_acctbal"), {"s_acctbal": "CAST(7.5 AS DOUBLE)"}, supplier.columns)


# Verification


def _order_types(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return {f.name: sql_type(f.dataType) for f in _table(spark, sf_dir, "orders").schema.fields}


def _states(spark: SparkSession, sf_dir: str, target: Callable[[DataFrame], DataFrame]) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    states = verify.compare(render_all(orders), target(orders), "o_orderkey", _order_types(spark, sf_dir))
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'match' AS state, count(*) AS n FROM orders")
def value_check_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir, lambda t: t)


@query("SELECT CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 1 THEN 'mismatch' ELSE 'match' END AS state, count(*) AS n FROM orders GROUP BY 1")
def value_check_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices off by a cent and statuses set to NULL."""
    price = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    status = F.when(F.col("o_orderkey") % 89 != 1, F.col("o_orderstatus"))
    return _states(spark, sf_dir, lambda t: t.withColumn("o_totalprice", price).withColumn("o_orderstatus", status))


@query("SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'missing' ELSE 'match' END AS state, count(*) AS n FROM orders GROUP BY 1")
def value_check_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir, lambda t: t.where("o_orderkey % 89 <> 0"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey % 97 = 0 ORDER BY CAST(o_orderkey AS VARCHAR) LIMIT 100")
def value_check_first_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's hundred keys."""
    orders = _table(spark, sf_dir, "orders")
    target = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 97 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")))
    found = verify.summary(verify.compare(render_all(orders), target, "o_orderkey", _order_types(spark, sf_dir)))
    return found.select(F.explode("mismatch_keys").alias("key"))


#: case, source, loaded, failed, pre, post, on_conflict, skipped, missing, mismatched
_CASES = (
    (1, None, 5, 0, 0, 5, "error", False, 0, 0), (2, 10, 5, 0, 0, 5, "error", False, 0, 0), (3, 5, 5, 0, 0, 9, "error", False, 0, 0), (4, 5, 5, 0, 0, 3, "error", False, 0, 0),
    (5, 5, 5, 0, 0, 3, "do-nothing", False, 0, 0), (6, 5, 5, 0, 0, 5, "error", True, 0, 0), (7, 5, 5, 0, 0, 5, "error", False, 2, 3), (8, 5, 5, 0, 0, 5, "error", False, 0, 3),
    (9, 5, 5, 0, 0, 5, "error", False, 0, 0), (10, 5, 3, 2, 0, 3, "error", False, 0, 0), (11, 5, 5, 0, 9, 3, "do-update", False, 0, 0), (12, 5, 5, 0, None, None, "error", None, None, None),
)
_VERDICTS = {1: "SkippedNoExactSourceCount", 2: "LoaderDropped(5)", 3: "ExtraTarget(4)", 4: "MissingTarget(2)", 5: "RowsConflictedAtTarget(2)", 6: "ValueCheckSkipped", 7: "ValueRowMissingAtTarget(2)", 8: "ValueMismatch(3)", 9: "Match", 10: "Match", 11: "RowsConflictedAtTarget(5)", 12: "Match"}


@query("SELECT * FROM (VALUES " + ", ".join(f"({k}, '{v}', {str(v in verify.GOOD).lower()})" for k, v in _VERDICTS.items()) + ") AS t(case_id, verdict, passed)")
def verdict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("source", "loaded", "failed", "pre", "post", "on_conflict", "skipped", "missing", "mismatched")
    rows = spark.createDataFrame(_CASES, "case_id int, source long, loaded long, failed long, pre long, post long, on_conflict string, skipped boolean, missing long, mismatched long")
    value = verify.verdict(*(F.col(n) for n in names))
    return rows.select("case_id", value.alias("verdict"), verify.passes(value).alias("passed"))


@query(
    """WITH a AS (SELECT c_custkey, c_name FROM customer), b AS (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name END AS c_name FROM customer WHERE c_custkey % 70 <> 1)
 SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
)
def two_way_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    b = a.where("c_custkey % 70 <> 1").withColumn("c_name", F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")))
    return verify.equal_tables(a, b)


@query("SELECT quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.9) AS p90, quantile_disc(l_quantity, 0.99) AS p99 FROM lineitem")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.percentiles(_table(spark, sf_dir, "lineitem"), "l_quantity")


@query("SELECT * FROM (VALUES (0), (3)) AS t(chunk_id)")
def missing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _table(spark, sf_dir, "region").where("r_regionkey in (1, 2, 4)").select(F.col("r_regionkey").cast("int").alias("chunk_id"))
    return accounting.missing_chunks(results, 5)


@query("SELECT kind, chunk_id, line_no, detail FROM (SELECT 'field_count_mismatch' AS kind, 0 AS chunk_id, o_orderkey AS line_no, o_orderstatus AS detail FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT 'batch_error', 1, 0, 'all' FROM region)")
def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0").withColumn("chunk_id", F.lit(0))
    batches = _table(spark, sf_dir, "region").withColumn("chunk_id", F.lit(1))
    return accounting.errors(rows, "field_count_mismatch", F.col("o_orderstatus"), F.col("o_orderkey")).unionAll(accounting.errors(batches, "batch_error", F.lit("all")))


# Export


@query("SELECT 'orders' AS table_name, (SELECT max(o_orderkey) FROM orders) AS last_id UNION ALL SELECT 'customer', (SELECT max(c_custkey) FROM customer) UNION ALL SELECT 'empty', NULL")
def identity_setval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for name, key, keep in (("orders", "o_orderkey", "true"), ("customer", "c_custkey", "true"), ("empty", "c_custkey", "false")):
        contract = TableContract("public", name, (ColumnContract(key, "BIGINT", False, identity=True),), (key,))
        text = export.identity_setval(contract, _table(spark, sf_dir, "customer" if name == "empty" else name).where(keep))
        rows.append((name, None if text is None else int(text.rsplit(", ", 2)[1])))
    return spark.createDataFrame(rows, "table_name string, last_id long")


@query(f"SELECT CAST(n_nationkey AS VARCHAR) || chr(9) || {_ENCODED.format('n_name')} || chr(9) || CAST(n_regionkey AS VARCHAR) AS line FROM nation")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    return export.row_lines(nation, TableContract.of(nation, "public", "nation", ("n_nationkey",)))


@query(
    "SELECT doc_id, part, CASE WHEN part = 1 THEN false ELSE NOT regexp_matches(name, '[\\x00-\\x1F\\x7F-\\x{9F}\"\\\\\\x{200B}-\\x{200F}\\x{2028}-\\x{202E}\\x{2066}-\\x{2069}\\x{FEFF}]') END AS ok FROM (SELECT doc_id, part, CASE part WHEN 0 THEN substr(text, 1, 40) WHEN 1 THEN '' WHEN 2 THEN substr(text, 1, 5) || chr(8238) ELSE source END AS name FROM documents CROSS JOIN (SELECT CAST(unnest(range(4)) AS INTEGER) AS part))"
)
def identifier_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which names could deceive: beginnings of texts, nothing, names with a mark that turns the direction, and sources."""
    names = F.array(F.substring("text", 1, 40), F.lit(""), F.concat(F.substring("text", 1, 5), F.lit("\u202e")), F.col("source"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(names).alias("part", "name"))
    return rows.select("doc_id", "part", identifier_ok(F.col("name")).alias("ok"))


@query(
    f"""WITH l AS (SELECT doc_id, octet_length(encode({_ENCODED.format('text')})) + 1 AS n FROM documents), s AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS lines FROM l)
 SELECT total, lines, total // (total // lines) AS estimated FROM s"""
)
def row_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by bytes and mean line length, in whole numbers."""
    size = F.octet_length(copytext.encode(F.col("text"))) + 1
    whole = _table(spark, sf_dir, "documents").agg(F.sum(size).cast("bigint").alias("total"), F.count(F.lit(1)).alias("lines"))
    return whole.select("total", "lines", F.expr("total div (total div lines)").alias("estimated"))


# Flagship: text round trip of a table, proved by a verdict


def round_trip(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Table to dump lines, back to typed columns, compared with the table by key: one verdict row."""
    table = _table(spark, sf_dir, name)
    contract = TableContract.of(table, "public", name, (key,))
    lines = render_all(table).select(copytext.encode_line(*(F.col(f"`{c}`") for c in table.columns)).alias("line"))
    loaded = copytext.decoded(lines, "line", table.columns).select(*(recast(F.col(f"`{c}`"), contract.types[c]).alias(c) for c in table.columns))
    found = verify.compare(render_all(table), loaded, key, contract.types).agg(
        F.count(F.lit(1)).alias("source"), F.count_if(F.col("state") == "missing").alias("missing"), F.count_if(F.col("state") == "mismatch").alias("mismatched")
    )
    n = F.col("source") - F.col("missing")
    value = verify.verdict(F.col("source"), F.col("source"), F.lit(0), F.lit(0), n, F.lit("error"), F.lit(False), F.col("missing"), F.col("mismatched"))
    return found.select(F.lit(name).alias("table_name"), "source", value.alias("verdict"), verify.passes(value).alias("passed"))


@query("SELECT 'orders' AS table_name, count(*) AS source, 'Match' AS verdict, true AS passed FROM orders")
def load_verify_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, sf_dir, "orders", "o_orderkey")


@query("SELECT 'documents' AS table_name, count(*) AS source, 'Match' AS verdict, true AS passed FROM documents")
def load_verify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, sf_dir, "documents", "doc_id")


@query("SELECT 'events' AS table_name, count(*) AS source, 'Match' AS verdict, true AS passed FROM events")
def load_verify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, sf_dir, "events", "event_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_verify_orders(spark, sf_dir)


# Files: what is written, scanned, loaded, resumed, migrated and exported


def _home(spark: SparkSession, name: str) -> Place:
    return Place.of(shared_folder(spark)) / "tallyport" / f"{name}-{uuid.uuid4().hex}"


def _written(lines: DataFrame, home: Place, name: str, before: str = "", after: str = "") -> str:
    """A text source of `lines` between two texts: a folder of parts, the lines written by the executors."""
    source = home / name
    (source / "0-before").write_text(before)
    lines.write.option("lineSep", "\n").text((source / "1-lines").for_spark)
    (source / "2-after").write_text(after)
    return source.for_spark


def _csv_line(df: DataFrame, delimiter: str = ",") -> Column:
    """Every cell in quotes, quotes doubled; NULL as nothing."""
    cells = [F.concat(F.lit('"'), F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns]
    return F.concat_ws(delimiter, *(F.coalesce(c, F.lit("")) for c in cells))


def _store_of(spark: SparkSession, sf_dir: str, home: Place, names: dict[str, str]) -> jobs.Store:
    """A store with these tables (name to key), each loaded from its Parquet file."""
    store = jobs.Store(spark, home.for_spark)
    for name, key in names.items():
        store.create(TableContract.of(_table(spark, sf_dir, name), "public", name, (key,)))
        jobs.load(spark, store, jobs.LoadOptions(f"{sf_dir}/{name}.parquet", name))
    return store


def _dump_of(spark: SparkSession, sf_dir: str, home: Place, names: dict[str, str]) -> str:
    """A dump of tables, by way of the export of a store: the folder of its parts."""
    jobs.export_parts(_store_of(spark, sf_dir, home / "store", names), (home / "dump").for_spark)
    return (home / "dump").for_spark


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV with a header, loaded by chunks into typed columns."""
    orders, home = _table(spark, sf_dir, "orders"), _home(spark, "csv")
    text = render_all(orders)
    path = _written(text.select(_csv_line(text)), home, "orders.csv", ",".join(text.columns) + "\n")
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(TableContract.of(orders, "public", "orders", ("o_orderkey",)))
    jobs.load(spark, store, jobs.LoadOptions(path, "orders", dialect=delimited.CSV.with_(header=True), chunk_bytes=1 << 20))
    return store.read("public", "orders")


@query("SELECT o_orderkey % 11 = 0 AS short, count(*) AS n, o_orderkey % 11 <> 0 AS good, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE count(*) END AS with_status FROM orders GROUP BY o_orderkey % 11 = 0, o_orderkey % 11 <> 0")
def tsv_chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines, every eleventh too short, with blank lines between: read by byte chunks, each line told good or bad."""
    orders, home = _table(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL"), _home(spark, "tsv")
    short = F.col("o_orderkey") % 11 == 0
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.when(~short, F.col("o_orderstatus")), F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"')))
    path = _written(orders.select(F.concat(line, F.when(F.col("o_orderkey") % 5 == 0, "\r\n").otherwise(""))), home, "orders.tsv")
    lines = dumpsource.raw_lines(spark, path, 0, Place.of(path).size(), 100_000)
    rows = delimited.parsed(lines, ["key", "status", "priority"], delimited.TSV).withColumn("short", F.expr("CAST(key AS BIGINT) % 11 = 0"))
    return rows.groupBy("short", "good").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("good"), F.col("status"))).alias("with_status"))


@query("SELECT doc_id, text, lang, source FROM documents")
def dump_scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a dump's data block, found in the file, read by chunks and decoded."""
    home = _home(spark, "dump")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    line = copytext.encode_line(*(F.col(c).cast("string") for c in docs.columns))
    path = _written(docs.select(line), home, "dump.sql", "SET statement_timeout = 0;\nCOPY public.documents (doc_id, text, lang, source) FROM stdin;\n", "\\.\n")
    block = dumpscan.find_block(dumpsource.index(spark, path, 1 << 20), "public", "documents")
    rows = dumpsource.scan(dumpsource.raw_lines(spark, path, block.data_start, block.data_end, 1 << 20), block.columns)
    return rows.where("good").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source")


_MIGRATED = {"nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS source, count(*) AS loaded, 0 AS failed, 'Match' AS verdict, 0 AS differ FROM {t}" for t in _MIGRATED))
def migrate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables exported as a dump, migrated into another store with full verification, compared with the first by EXCEPT."""
    home = _home(spark, "migrate")
    path = _dump_of(spark, sf_dir, home, _MIGRATED)
    again = jobs.Store(spark, (home / "again").for_spark)
    report = jobs.migrate(spark, again, path, verify.VerifyMode.FULL)
    rows = [(r.table, r.source_rows, r.loaded, r.failed, r.verdict, verify.equal_tables(_table(spark, sf_dir, r.table), again.read("public", r.table)).count()) for r in report.tables]
    return spark.createDataFrame(rows, "table_name string, source long, loaded long, failed int, verdict string, differ int")


@query("SELECT * FROM (VALUES ('public', 'customer', 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment'), ('public', 'nation', 'n_nationkey,n_name,n_regionkey')) AS t(table_schema, table_name, columns)")
def list_dump_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _dump_of(spark, sf_dir, _home(spark, "list"), {"customer": "c_custkey", "nation": "n_nationkey"})
    return jobs.list_tables(spark, path).select(F.col("schema").alias("table_schema"), F.col("table").alias("table_name"), F.array_join("columns", ",").alias("columns"))


@query(
    """SELECT 0 AS line_at, 'CREATE TABLE "region" (' AS line UNION ALL SELECT 1, '    "r_regionkey" INTEGER NOT NULL,' UNION ALL SELECT 2, '    "r_name" TEXT,' UNION ALL SELECT 3, '    PRIMARY KEY ("r_regionkey")' UNION ALL SELECT 4, ');'
 UNION ALL SELECT 5, '' UNION ALL SELECT 6, 'COPY "region" ("r_regionkey", "r_name") FROM stdin;' UNION ALL SELECT 7 + row_number() OVER (ORDER BY r_regionkey) - 1, r_regionkey || chr(9) || r_name FROM region
 UNION ALL SELECT 7 + count(*), '\\.' FROM region UNION ALL SELECT 8 + count(*), '' FROM region"""
)
def export_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a table's dump, with its place."""
    path = _dump_of(spark, sf_dir, _home(spark, "export"), {"region": "r_regionkey"})
    lines = dumpsource.raw_lines(spark, path, 0, Place.of(path).size())
    return lines.select((F.col("line_no") - 1).alias("line_at"), F.col("raw").alias("line"))


@query(
    """SELECT 'first' AS load, count(*) AS source, count(*) AS loaded, 0 AS failed, 'Match' AS verdict FROM orders UNION ALL SELECT 'again', count(*), count(*), 0, 'RowsConflictedAtTarget(' || count(*) || ')' FROM orders
 UNION ALL SELECT 'update', count(*), count(*), 0, 'RowsConflictedAtTarget(' || count(*) || ')' FROM orders UNION ALL SELECT 'error', count(*), 0, count(*), 'Match' FROM orders"""
)
def parquet_load_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Parquet file loaded four times under the three policies: what was loaded, what failed, and the verdict by counts."""
    store = jobs.Store(spark, _home(spark, "parquet").for_spark)
    store.create(TableContract.of(_table(spark, sf_dir, "orders"), "public", "orders", ("o_orderkey",)))
    rows = []
    for name, mode in (("first", "do-nothing"), ("again", "do-nothing"), ("update", "do-update"), ("error", "error")):
        r = jobs.load(spark, store, jobs.LoadOptions(f"{sf_dir}/orders.parquet", "orders", on_conflict=sink.OnConflict.parse(mode), verify=verify.VerifyMode.COUNT))
        rows.append((name, r.source_rows, r.loaded, r.failed, r.verdict))
    return spark.createDataFrame(rows, "load string, source long, loaded long, failed long, verdict string")


def _unfit(orders: DataFrame, home: Place) -> str:
    """Orders of which some have a word for a price, and some lack their last field."""
    price = F.when(F.col("o_orderkey") % 13 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), price, F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")))
    return _written(orders.select(line), home, "orders.csv", "id,price,status\n")


_UNFIT = TableContract("public", "t", (ColumnContract("id", "BIGINT", False), ColumnContract("price", "NUMERIC(15,2)"), ColumnContract("status", "TEXT")), ("id",))


@query(
    """SELECT kind, detail, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'parse_error' ELSE 'batch_error' END AS kind, CASE WHEN o_orderkey % 17 = 0 THEN 'short' ELSE 'price does not fit NUMERIC(15,2)' END AS detail
 FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0) GROUP BY ALL"""
)
def load_error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error records of a load whose batches are single rows."""
    home = _home(spark, "errors")
    store = jobs.Store(spark, (home / "store").for_spark)
    store.create(_UNFIT)
    found = jobs.load(spark, store, jobs.LoadOptions(_unfit(_table(spark, sf_dir, "orders"), home), "t", dialect=delimited.CSV.with_(header=True), batch_size=1))
    detail = F.when(F.startswith("detail", F.lit("not a record")), "short").otherwise(F.col("detail"))
    return spark.read.parquet(found.errors).groupBy("kind", detail.alias("detail")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT 'first' AS run, count(*) FILTER (WHERE o_orderkey % 17 <> 0 AND o_orderkey % 13 <> 0) AS loaded, count(*) FILTER (WHERE o_orderkey % 17 = 0 OR o_orderkey % 13 = 0) AS failed, NULL AS total FROM orders
 UNION ALL SELECT 'second', count(*) FILTER (WHERE o_orderkey % 17 <> 0 AND o_orderkey % 13 = 0), count(*) FILTER (WHERE o_orderkey % 17 = 0), count(*) FILTER (WHERE o_orderkey % 17 <> 0) FROM orders"""
)
def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job whose table can't take some rows at first: its second run loads what failed, and no row twice."""
    home = _home(spark, "resume")
    path, store = _unfit(_table(spark, sf_dir, "orders"), home), jobs.Store(spark, (home / "store").for_spark)
    options = jobs.LoadOptions(path, "t", dialect=delimited.CSV.with_(header=True), batch_size=1, chunk_bytes=200_000, resume=(home / "job.json").for_spark)
    store.create(replace(_UNFIT, primary_key=()))
    first = jobs.load(spark, store, options)
    # The same rows in a table that takes any price.
    wider = replace(_UNFIT, primary_key=(), columns=tuple(replace(c, type_name="TEXT") if c.name == "price" else c for c in _UNFIT.columns))
    kept = store.read("public", "t").withColumn("price", F.col("price").cast("string"))
    (home / "store" / "public" / "t" / "contract.json").write_text(wider.to_json())
    store.replace("public", "t", kept)
    second = jobs.load(spark, store, options)
    total = store.read("public", "t").count()
    return spark.createDataFrame([("first", first.loaded, first.failed, None), ("second", second.loaded, second.failed, total)], "run string, loaded long, failed long, total long")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE list_contains(['BUILDING', 'MACHINERY'], c_mktsegment) AND c_name LIKE '%1%'")
def any_of_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x = ANY(array), and LIKE."""
    wanted = F.array(F.lit("BUILDING"), F.lit("MACHINERY"))
    return _table(spark, sf_dir, "customer").where(F.array_contains(wanted, F.col("c_mktsegment")) & F.col("c_name").like("%1%")).select("c_custkey", "c_mktsegment")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS flag, lower(hex(encode(event_type))) AS bytes, CAST(CAST(event_id AS SMALLINT) AS VARCHAR) AS small, CAST(CAST(event_id AS INTEGER) / 4 AS VARCHAR) AS shown FROM (SELECT *, event_id % 1000 + 1 AS id FROM events) e".replace("CAST(event_id AS SMALLINT)", "CAST(id AS SMALLINT)").replace("CAST(CAST(event_id AS INTEGER) / 4 AS VARCHAR)", "regexp_replace(CAST(CAST(id AS DOUBLE) / 4 AS VARCHAR), '[.]0$', '')"))
def render_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booleans, bytes, small integers and doubles as text; the last without a trailing zero, for display."""
    small = (F.col("event_id") % 1000 + 1).cast("short")
    return _table(spark, sf_dir, "events").select(
        "event_id", render(F.col("event_id") % 2 == 0, T.BooleanType()).alias("flag"), render(F.encode("event_type", "UTF-8"), T.BinaryType()).alias("bytes"), render(small, T.ShortType()).alias("small"), float_text(small.cast("double") / 4).alias("shown")
    )


from tallyport.plans import source_queries  # noqa: E402  registers its queries
