"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyport.llm import decontaminate, fingerprints, infill, katz, licenses, minhash, mixing, pii, ranked, sharding, simhash, tokens, toxicity


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": pipeline,
        "op1_bottom_k_fingerprints": fingerprints.query,
        "op2_template_decontamination": decontaminate.query,
        "op3_kneser_ney_toxicity": toxicity.query,
        "op4_simhash_near_dedup": simhash.query,
        "op5_license_windows": licenses.query,
        "op6_pii_boosted_spans": pii.query,
        "op7_katz_backoff": katz.query,
        "op8_mix_sources": mixing.query,
        "op9_token_segments": tokens.query,
        "op10_shard_slots": sharding.query,
        "op11_minhash_near_dedup": minhash.query,
        "op12_ranked_search": ranked.query,
        "op13_fill_in_middle": infill.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_mix_sources": mixing.SQL, "op12_ranked_search": ranked.SQL, "op13_fill_in_middle": infill.SQL}
