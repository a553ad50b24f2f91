from samples import words

import corpus_pipeline
from tallyport.llm import common, queries


def test_stages_in_order_and_effective(spark, tmp_path):
    rows, labels = [], []
    for i in range(160):
        w = words(90, i)
        if i % 8 == 0:
            w[5] = w[40] = w[60] = "grumblefex"
            w[20] = "zorkheads"
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(i % 8 == 0)))
    item = "what is the sum of all the numbers that the old clerk wrote down before noon"
    rows += [(500, " ".join(words(50, 900)) + " " + item, "en", "s0", 0), (501, rows[1][1], "en", "s0", 0), (502, None, "en", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = common.table(spark, str(tmp_path), "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, str(tmp_path)), "test-stage")
        seen[name] = docs
        assert docs.columns[:5] == columns
    assert list(seen) == ["toxicity", "simhash_near_dedup", "decontamination", "mixing", "sharding"]
    kept = {r.doc_id for r in seen["toxicity"].collect()}
    assert sum(i in kept for i in range(0, 160, 8)) <= 2
    assert sum(i in kept for i in range(160) if i % 8) >= 135
    assert {r.doc_id for r in seen["simhash_near_dedup"].collect()} == kept - {501}
    assert {r.doc_id for r in seen["decontamination"].collect()} == kept - {500, 501}
    assert {r.shard for r in seen["sharding"].collect()} <= set(range(16))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["sharding"].count()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries() if n.startswith("op")) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None
    assert set(queries.oracle_sql()) <= set(queries.queries())
