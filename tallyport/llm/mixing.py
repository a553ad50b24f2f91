"""Mixing sources to target weights by capped water-filling, with JVM-side expressions only.

The budget (100% of all words) is shared by weight; a source's target stops at `max_epochs` times its words, and the
excess goes to the others by weight until none is above. In closed form: with sources ordered by cap / weight, the
capped ones are a prefix, and the rest get weight * level, where level = (budget - caps of the prefix) / (weights of
the rest).

A source takes each document floor(target / words) times, and for what is left once more those that come first in a
seeded order while they fit, then the one document whose size comes nearest to what is still missing.

The order is seeded by doc_id and text, so rows that share a doc_id, or have none, are still told apart; rows that repeat
are numbered, so each has a place of its own (the repeats of one row meet in one task, by their places). One row a source
meets in the windows over sources (`targets`); sources are counted in thousands, not by document.

Defined results: a null text has size 0; documents of size 0 take 0 words; the null source is last in order; rows that
repeat are taken one by one, and which of them is as good as any; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import cut, row_hash, small, table, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the seeded hash that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target, whole, extra). One row a source, so its windows see one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy(F.lit(1))
    ranked = caps.withColumn("fill", F.col("cap") / F.col("weight")).withColumn("budget", F.sum("source_size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
    before = Window.partitionBy(F.lit(1)).orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # The first source that its level does not fill sets the level of all after it.
    levels = ranked.withColumn("level", level).withColumn("final", F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", F.col("source").isNull(), "source", "level"))).over(everything)["level"])
    target = F.when(F.col("final").isNull() | (F.col("fill") <= F.col("final")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("final"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return levels.withColumn("target", target).withColumn("whole", whole).select("source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("extra"))


def seeded(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def told_apart(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with (source, place), where of rows that share a place all but the first get another. Tables without repeats pass."""
    again = cut(rows.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("place"), "mix-again")
    if not again.limit(1).count():
        return rows
    again = small(again)
    nth = F.row_number().over(Window.partitionBy("place").orderBy(F.col("source").asc_nulls_last(), *order))
    numbered = rows.join(again, "place", "left_semi").withColumn("nth", nth)
    place = F.when(F.col("nth") == 1, F.col("place")).otherwise(F.md5(F.concat("place", F.lit(":"), F.col("nth").cast("string"))))
    return rows.join(again, "place", "left_anti").unionByName(numbered.withColumn("place", place).drop("nth"))


def decide(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, size, place) rows to one row a source: its target, whole repeats, the last place that is taken once
    more (`upto`), and the place of the document that fills the rest (`fit`). A source is never ordered in one task:
    bucket sums find the bucket in which it ends, and only that bucket's documents are ordered."""
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    plan = small(cut(plan, "mix-plan"))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    bucket = F.substring("place", 1, BUCKET_DIGITS).alias("bucket")
    buckets = sized.groupBy("source", bucket).agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("source").orderBy("bucket")
    filled = buckets.withColumn("after", F.sum("n").over(upto)).withColumn("before", F.col("after") - F.col("n"))
    ends = (
        filled.alias("b").join(plan.alias("p"), same("b", "p")).where((F.col("before") <= F.col("extra")) & (F.col("after") > F.col("extra")))
        .select("b.source", "bucket", "before", "extra")
    )
    ends = small(cut(ends, "mix-ends"))
    inside = (
        sized.withColumn("bucket", bucket).alias("d").join(ends.alias("e"), same("d", "e") & (F.col("d.bucket") == F.col("e.bucket")))
        .groupBy("d.source", "place").agg(F.sum("size").alias("n"), F.first("before").alias("before"), F.first("extra").alias("extra"))
    )
    run = Window.partitionBy("source").orderBy("place")
    running = inside.withColumn("sum", F.col("before") + F.sum("n").over(run))
    last = running.groupBy("source").agg(
        F.max(F.when(F.col("sum") <= F.col("extra"), F.col("place"))).alias("inner"),
        F.first("extra").alias("extra"),
        F.first("before").alias("before"),
        F.max(F.when(F.col("sum") <= F.col("extra"), F.col("sum"))).alias("taken"),
        F.min(F.substring("place", 1, BUCKET_DIGITS)).alias("bucket"),
    )
    # With none taken in that bucket, what precedes it ends before the bucket's own prefix.
    stop = last.select("source", F.coalesce("inner", "bucket").alias("upto"), (F.col("extra") - F.coalesce("taken", "before")).alias("gap"))
    stop = small(cut(stop, "mix-stop"))
    rest = (
        sized.alias("d").join(stop.alias("s"), same("d", "s")).where(F.col("place") > F.col("upto"))
        .groupBy("d.source", "place").agg(F.sum("size").alias("n"), F.first("gap").alias("gap"))
        .where((F.col("n") > 0) & (F.col("n") < 2 * F.col("gap")))
        .groupBy("source").agg(F.min(F.struct(F.abs(F.col("n") - F.col("gap")), "place"))["place"].alias("fit"))
    )
    return (
        plan.alias("p").join(stop.alias("s"), same("p", "s"), "left").join(rest.alias("r"), F.col("p.source").eqNullSafe(F.col("r.source")), "left")
        .select("p.source", "p.source_size", "p.target", "p.whole", "s.upto", "r.fit")
    )


def repeats() -> Column:
    """How often a row joined with its source's decision is taken."""
    more = (F.col("place") <= F.col("upto")) | (F.col("place") == F.col("fit"))
    return F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, place) of each row."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), seeded(F.col("doc_id"), F.col("text"), seed).alias("place"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, repeats) of each row."""
    sized = told_apart(cut(sizes(docs, seed), "mix-sizes"))
    plan = small(cut(decide(sized, weights, max_epochs), "mix-decided"))
    joined = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    return joined.select("doc_id", "size", "source_size", "target", (repeats() * F.col("size")).alias("taken"), repeats().alias("repeats"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("repeats")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each row as often as the mix takes it."""
    plan = small(cut(decide(told_apart(cut(sizes(docs), "mix-sizes"))), "mix-decided"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), row_hash(docs, docs.columns).alias("_hash"), "source", seeded(F.col("doc_id"), F.col("text")).alias("place"))
    joined = told_apart(rows, F.col("_hash")).alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    return joined.select("_row", F.explode(F.array_repeat(F.lit(0), repeats().cast("int"))).alias("_copy")).select("_row.*")


SQL = """
WITH e AS (
    SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS size,
        md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS place
    FROM documents
), n AS (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY source NULLS LAST) AS nth FROM e
), d AS (
    SELECT * EXCLUDE (place, nth), CASE WHEN nth = 1 THEN place ELSE md5(place || ':' || nth) END AS place FROM n
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS weight, 3 * source_size AS cap FROM s
), f AS (
    SELECT *, CAST(cap AS DOUBLE) / weight AS fill, CAST(sum(source_size) OVER () AS BIGINT) AS budget, CAST(sum(weight) OVER () AS BIGINT) AS all_weight FROM w
), l AS (
    SELECT *, CAST(budget - coalesce(CAST(sum(cap) OVER b AS BIGINT), 0) AS DOUBLE) / (all_weight - coalesce(CAST(sum(weight) OVER b AS BIGINT), 0)) AS level
    FROM f WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), z AS (
    SELECT (SELECT level FROM l WHERE fill > level ORDER BY fill, source NULLS LAST LIMIT 1) AS final
), t AS (
    SELECT source, source_size, CASE WHEN final IS NULL OR fill <= final THEN CAST(cap AS DOUBLE) ELSE weight * final END AS target FROM l, z
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), u AS (
    SELECT d.source, place, sum(size) AS n, any_value(target - whole * source_size) AS extra
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source GROUP BY d.source, place
), r AS (
    SELECT *, sum(n) OVER (PARTITION BY source ORDER BY place) AS run FROM u
), g AS (
    SELECT source, max(place) FILTER (run <= extra) AS upto, any_value(extra) - coalesce(max(run) FILTER (run <= extra), 0) AS gap FROM r GROUP BY source
), x AS (
    SELECT r.source, min({'a': abs(n - gap), 'b': place}).b AS fit
    FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source
    WHERE place > coalesce(upto, '') AND n > 0 AND n < 2 * gap GROUP BY r.source
)
SELECT doc_id, size, p.source_size, target,
    (whole + CASE WHEN coalesce(place <= upto OR place = fit, false) OR (upto IS NULL AND place = fit) THEN 1 ELSE 0 END) * size AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN g ON d.source IS NOT DISTINCT FROM g.source
LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""
