"""What the operators of this subpackage share: text units, shared folders, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, and what stands between words: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Most rows that may be broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 100_000


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def unsigned_hex(value: Column) -> Column:
    """16 lower-case hex digits of a long's 64 bits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A long that tells rows apart by these columns; maps are hashed by their text."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.xxhash64(F.lit(0), *(F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kinds[c] or "variant" in kinds[c] else F.col(f"`{c}`") for c in columns))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names. A temporary one is made only where none is set and the driver and
    the executors are one process (tests); on a cluster none would be shared, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="tallyport-")).as_uri()
        spark.sparkContext.setCheckpointDir(found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tallyport/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table in the shared folder and read again: ends its lineage, survives lost executors."""
    spark = df.sparkSession
    df.write.parquet(path := fresh_path(spark, name))
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that `cut` wrote, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffled(df: DataFrame) -> DataFrame:
    """`df` with the hint that a join with it is by shuffle. Spark sizes a table by its packed file, and what an explode makes
    of a row as one row; left to choose, it would broadcast tables that are a hundred times what it takes them for."""
    return df.hint("merge")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if its counted rows are within the bound, else with the hint for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else shuffled(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
