"""A source into a table of a database: the same scans, casts and batches as a load into the store, with the ledger of
`operators/remote.py` as its log."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.contract import TableContract
from tallyport.functions.identifiers import qualified
from tallyport.operators import accounting, remote, sink
from tallyport.operators.remote import Database
from tallyport.plans import jobs
from tallyport.session import cut
from tallyport.sources import dumpscan


@dataclass(frozen=True)
class DatabaseResult:
    """Rows that this run put in, those that were in before, rows of failed batches, records that do not parse; and what the
    batches took, in seconds (None if none went in)."""

    table: str
    loaded: int
    before: int
    failed: int
    parse_errors: int
    attempts: int
    p50: float | None
    p90: float | None
    p99: float | None
    seconds: float
    warnings: tuple[str, ...]
    #: (chunk_id, batch_id, n, unread, outcome, attempts, seconds, detail) of each batch, as a table.
    batches: DataFrame


def load(
    spark: SparkSession, database: Database, contract: TableContract, options: jobs.LoadOptions, job: str, connections: int | None = None, block: dumpscan.Block | None = None
) -> DatabaseResult:
    """One source into one table, under a job's name. A run of the same job goes on where others stopped: chunks that are done
    are not opened, batches that are in are not tried. `connections` bounds how many tasks write at once."""
    began = time.monotonic()
    options = options.validated()
    database.prepare()
    source = jobs._source(spark, options, block)
    bound = jobs._bound(options, source, contract)
    warnings = sink.validate_keys(options.on_conflict, contract.keys, list(options.exclude))
    database.begin(job, json.dumps(jobs._plan(options, source) | {"on_conflict": options.on_conflict.value}, sort_keys=True))
    done = database.done_chunks(job)
    reading = source
    if done and source.chunks is not None:
        reading = replace(source, rows=source.rows.where(F.col("chunk_id").isin([c for c in range(source.chunks) if c not in done])))
    rows = jobs._typed(reading, contract, bound).withColumn("batch_id", sink.batch_id(F.col("line_no"), options.batch_size))
    if connections is not None:
        # Whole chunks are put together, nothing is shuffled.
        rows = rows.coalesce(connections)
    outcomes = remote.write(rows, database, job, qualified(contract.schema, contract.table), list(bound), contract.keys, options.on_conflict, source.chunks is not None)
    outcomes = cut(outcomes, "database-batches")
    sums = outcomes.agg(
        *(F.coalesce(F.sum(F.when(F.col("outcome").isin(*which), F.col("n"))), F.lit(0)).alias(name) for name, which in (("loaded", ["loaded"]), ("before", ["before"]), ("failed", ["unfit", "failed"]))),
        F.coalesce(F.sum("unread"), F.lit(0)).alias("unread"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts"),
    ).first()
    times = accounting.percentiles(outcomes.where("outcome = 'loaded'"), "seconds").first()
    seen = sums.loaded + sums.failed + sums.unread
    if not done and not sums.before and accounting.too_few(seen, source.estimated, accounting.WARN_PART):
        warnings.append(f"{seen} rows seen, less than half of about {source.estimated}")
    seconds = round(time.monotonic() - began, 3)
    return DatabaseResult(options.table, sums.loaded, sums.before, sums.failed + sums.unread, sums.unread, sums.attempts, times.p50, times.p90, times.p99, seconds, tuple(warnings), outcomes)


def as_json(result: DatabaseResult) -> str:
    """One line for a terminal."""
    shown = {f.name: getattr(result, f.name) for f in fields(result) if f.name != "batches"}
    return json.dumps(shown | {"rows_a_second": round(accounting.rate(result.loaded, result.seconds), 1)})
