"""The corpus pipeline: documents to a clean, deduplicated, mixed and sharded corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and
read again as the next one's docs. All but the last return the columns of `documents`; the last adds where each row
lives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyport.llm import common, decontaminate, mixing, sharding, similar, toxicity

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity.stage),
    ("simhash_near_dedup", similar.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
    ("sharding", sharding.stage),
]

#: The first stage scores with a model, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
