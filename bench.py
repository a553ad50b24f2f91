"""Headline queries of the core library at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyport import session
from tallyport.plans import registry

HEADLINE = (
    "load_verify_orders", "load_verify_documents", "load_verify_events", "copy_encode", "copy_roundtrip", "infer_value_types", "recast_flags", "recast_values", "chunk_totals",
    "upsert_do_nothing", "upsert_do_update", "value_check_clean", "value_check_mismatch", "two_way_except", "latency_percentiles", "dump_line_arity",
    "csv_load_rows", "dump_scan_rows", "parquet_load_verdicts", "migrate_verdicts", "resumed_load",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
