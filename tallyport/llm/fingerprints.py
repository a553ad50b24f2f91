"""Document fingerprints: bottom-k sketches of shingle hashes, made and compared by JVM-side expressions only.

A sketch is the sorted array of the K least distinct XXH64 hashes of a text's shingles of WIDTH words (of fewer words,
the whole sequence; none for a text without words). Sketches of parts merge into the sketch of the whole, and estimate
resemblance (Jaccard similarity), containment and the number of distinct shingles; below K hashes all are exact.

Defined results of the query: a null text counts as empty; documents are in descending doc_id, null last, then by the
hash of their text; rows that repeat (same doc_id and text) count once in that order and get the same result each; the
only document is its own next; an empty table gives no rows. Two texts without words are alike (1), a text with and one
without are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import cut, table, words

WIDTH = 5
K = 128


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """array<long> sketch of a text. The words are bound by a lambda, so they are split once and not for each shingle."""

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(w) - F.lit(width - 1), F.lit(1)))
        hashes = F.transform(at, lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.when(F.size(w) > 0, bottom(hashes, k)).otherwise(F.array().cast("array<long>"))

    return F.element_at(F.transform(F.array(words(text)), of), 1)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together. Shingles across the seam are in neither part."""
    return bottom(F.concat(a, b), k)


def merge_all(df: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch for each key from any number of parts; ranks stop at k on each side of the shuffle."""
    hashes = df.select(*keys, F.explode(sketch_col).alias("_h")).distinct()
    least = hashes.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_n") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the part of the union's sketch that both have."""
    both = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(merged(a, b, k)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; null if a has none."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def printed(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def followers(ids: DataFrame) -> DataFrame:
    """Distinct (none, id, h, n) rows with the row that follows in descending id, null ids last: adds after_none, after_id,
    after_h. Rows are ranged and numbered within ranges; only one row a range meets in one task."""
    order = [F.col("none"), F.col("id").desc(), F.col("h")]
    ranged = ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = cut(ranged, "fingerprint-order")
    key = F.struct("none", "id", "h")
    inside = ranged.withColumn("after", F.lead(key).over(Window.partitionBy("part").orderBy(*order)))
    # Negation would overflow for the smallest long.
    place = F.struct("none", F.bitwise_not(F.col("id")).alias("down"), "h")
    firsts = ranged.groupBy("part").agg(F.min_by(key, place).alias("first"))
    parts = Window.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(parts)).alias("border"))
    return inside.join(firsts, "part").select("none", "id", "h", "n", F.coalesce("after", "border").alias("after")).select("none", "id", "h", "n", *(F.col(f"after.{c}").alias(f"after_{c}") for c in ("none", "id", "h")))


def neighbours(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document with its own sketch, that of its edited text, and how near both and the next document's are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    counted = rows.select("none", "id", "h", F.length("text").cast("long").alias("n"))
    ids = cut(counted.groupBy("none", "id", "h", "n").agg(F.count(F.lit(1)).alias("times")), "fingerprint-ids")
    after = followers(ids.drop("times"))
    once = rows
    if ids.where("times > 1").limit(1).count():
        once = rows.dropDuplicates(["none", "id", "h"])
    # The next document sends its head and its sketch back to the one before it.
    to = after.select(F.col("none").alias("to_none"), F.col("id").alias("to_id"), F.col("h").alias("to_h"), "n", F.col("after_none").alias("none"), F.col("after_id").alias("id"), F.col("after_h").alias("h"))
    sent = once.join(to.hint("shuffle_hash"), ["none", "id", "h"]).select(
        F.col("to_none").alias("none"), F.col("to_id").alias("id"), F.col("to_h").alias("h"),
        F.substr("text", F.lit(1), F.floor(F.col("n") / 3).cast("int")).alias("head"), sketch(F.col("text"), k).alias("next"),
    )
    size = F.length("text").cast("long")
    joined = rows.join(sent, ["none", "id", "h"])
    edited = joined.select("none", "id", size.alias("n_chars"), "text", "next", F.concat(F.substr("text", F.lit(1), (size - F.floor(size / 3)).cast("int")), "head").alias("edited"))
    sketched = edited.select("none", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("text"), k).alias("own"), sketch(F.col("edited"), k).alias("changed"), "next")
    return sketched.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed"), k).alias("near_edited"),
        resemblance(F.col("own"), F.col("next"), k).alias("near_next"),
        distinct_shingles(F.col("own"), k).alias("n_shingles"),
        containment(F.col("own"), F.col("changed"), k).alias("kept_share"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents"))
