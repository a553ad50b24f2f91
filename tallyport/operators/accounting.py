"""Counts of what happened to every row: batches, chunks, errors, latencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_SCHEMA = "kind string, chunk_id int, line_no long, detail string"
#: The kinds of error records. Line 0 stands for a whole chunk or batch.
KINDS = ("parse_error", "field_count_mismatch", "batch_error", "conflict_clause_error")


def errors(df: DataFrame, kind: str, detail: Column, line_no: Column | None = None) -> DataFrame:
    """Error records of the rows of `df`, which has chunk_id."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind of error {kind!r}")
    return df.select(F.lit(kind).alias("kind"), F.col("chunk_id").cast("int").alias("chunk_id"), F.coalesce(line_no, F.lit(0)).cast("long").alias("line_no") if line_no is not None else F.lit(0).cast("long").alias("line_no"), detail.cast("string").alias("detail"))


def batch_totals(rows: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(chunk_id, batch, n, n_bad): with one bad row a batch fails as a whole."""
    return rows.groupBy("chunk_id", batch).agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad")).withColumn("failed", F.col("n_bad") > 0)


def chunk_totals(batches: DataFrame) -> DataFrame:
    """(chunk_id, n_batches, loaded, failed) from batch totals."""
    return batches.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum(F.when(~F.col("failed"), F.col("n")).otherwise(0)).alias("loaded"),
        F.sum(F.when(F.col("failed"), F.col("n")).otherwise(0)).alias("failed"),
    )


def source_rows(counts: DataFrame, chunks: int, column: str = "source_rows") -> DataFrame:
    """One row: the sum over chunks, NULL if a chunk has none, is missing, or the sum overflows."""
    whole = (F.count(column) == F.count(F.lit(1))) & (F.count(F.lit(1)) == chunks)
    return counts.agg(F.when(whole, F.try_sum(column)).alias("source_rows"))


def missing_chunks(results: DataFrame, chunks: int) -> DataFrame:
    return results.sparkSession.range(chunks).select(F.col("id").cast("int").alias("chunk_id")).join(results.select("chunk_id"), "chunk_id", "left_anti")


#: Below this part of the estimate a load warns.
WARN_PART = 0.5


def too_few(processed: int, estimated: int | None, part: float = 0.75) -> bool:
    """Whether a load processed less than a part of what was estimated."""
    return estimated is not None and processed < part * estimated


def rate(rows: int, seconds: float) -> float:
    """Rows a second of a load."""
    return rows / seconds if seconds > 0 else 0.0


def percentiles(df: DataFrame, column: str, points: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Nearest-rank percentiles, one column each: p50, p90, p99."""
    return df.agg(*(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{column}`)").alias(f"p{round(100 * p)}") for p in points))
