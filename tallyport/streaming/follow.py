"""Following a folder: every new delimited file goes into one table of a store, once.

Each micro-batch is cast and accounted for like a load's rows, with single rows as batches: what does not parse or fit goes
to the table's error records, the rest in under the do-nothing policy. The number of the last batch that went in is part of
the version of the table that has its rows, so a batch that Spark runs again after a failure adds nothing twice, whenever
the driver died.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallyport.operators import accounting, sink
from tallyport.plans import jobs
from tallyport.plans.store import Store, Version
from tallyport.sources import delimited
from tallyport.sources.files import Place


def follow(store: Store, folder: str, table: str, checkpoint: str, schema: str = "public", dialect: delimited.Dialect = delimited.CSV) -> StreamingQuery:
    """Load all files that the folder has and end; call it again, with the same checkpoint, for those that came since. Files
    bind by position and have no header."""
    if dialect.header or dialect.multiline:
        raise ValueError("followed files have no header, and a record is a line")
    contract = store.contract(schema, table)
    lines = store.spark.readStream.text(Place.of(folder).for_spark)
    job = f"follow {checkpoint}"

    def take(batch: DataFrame, number: int) -> None:
        if _last(store.version(schema, table), job) >= number:
            return
        numbered = batch.select(F.lit(number).cast("int").alias("chunk_id"), (F.monotonically_increasing_id() + 1).alias("line_no"), F.col("value").alias("raw"))
        rows = jobs.cut(jobs.typed(delimited.parsed(numbered, contract.names, dialect), contract), "follow")
        good = rows.where("fault IS NULL AND why = ''").select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(contract.names)), F.col("line_no").alias("_order"))

        def change(base: Version) -> Version | None:
            if _last(base, job) >= number:
                return None
            fresh = sink.do_nothing(store.read(schema, table, base), good, contract.all_keys, F.col("_order"))
            out = base.with_part(store.write(schema, table, fresh.select(*contract.names)))
            # The batch's number goes in with its rows.
            return replace(out, jobs=out.jobs | {job: [str(number)]})

        store.commit(schema, table, change)
        bad = rows.where("fault IS NOT NULL OR why <> ''")
        if bad.limit(1).count():
            kind = F.when(F.col("fault").isNull(), F.col("why")).otherwise(F.concat("fault", F.lit(": "), F.left("raw", F.lit(200))))
            errors = accounting.errors(bad.where("fault IS NULL"), "batch_error", kind, F.col("line_no")).unionAll(accounting.errors(bad.where("fault IS NOT NULL"), "parse_error", kind, F.col("line_no")))
            errors.write.parquet((store.root / ".errors" / f"{schema}.{table}-follow-{number}").for_spark, mode="overwrite")
        jobs.discard(rows)

    query = lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _last(version: Version, job: str) -> int:
    return int(version.jobs.get(job, ["-1"])[-1])
