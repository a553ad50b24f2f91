"""Near-duplicate texts by SimHash balls and shingle prefixes, verified on exact word shingles.

This is the pipeline's form of the operator in `simhash`: five-word shingles and a similarity of 0.8. The operator's ball
hashing brings together texts whose 64-bit fingerprints are at most three bits apart, as copies with few edits are. At a
similarity of 0.8 fingerprints differ in about ten bits, beyond the reach of any ball, so what the balls have not joined
is searched again by the prefixes of the texts' shingles. All shingles have one order, those that are frequent in a sample
last; of two texts with Jaccard similarity SIMILARITY or more, the first n - ceil(SIMILARITY * n) + 1 shingles of each have
one in common. So no similar pair fails to meet, whatever was edited; the sample bears on cost only.

Every pair that meets is settled. In HUBS rounds each member of a bucket is compared with one central member (the one
that meets most others, as the original of many copies does), and what is alike is joined. Then all pairs of members
that meet and are not in one component are compared. Pairs are left out only by bounds that no similar pair breaks: the
sizes of both sets, what can still follow the shared shingle in each, and the bits in which two bitmaps of the sets
differ, at most the size of the sets' difference. Compared texts are linked if the exact sets of their shingles have a
Jaccard similarity of SIMILARITY or more. Texts with the same words count as one text throughout.

A bucket is never ordered, and its pairs are dealt out by groups: what has to be known of it is aggregated and joined back,
and a join's hot key is split when the plan is adapted. Only the first pass, which drops the keys of one text, reads a
bucket's keys (no texts) in one task, spilling where it has to. Unrelated texts that share a prefix shingle by chance cost
a bounds test a pair; that is the part which grows faster than the input where such shingles are common but not in the
sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm import simhash
from tallyport.llm.common import cut, discard, shuffled, small
from tallyport.llm.simhash import components
from tallyport.session import ship

WIDTH = 5
SIMILARITY = 0.8
#: Rounds in which a bucket's members are compared with one central member before all pairs are.
HUBS = 2
#: A part of the texts, but about SAMPLE of them at least, tells which shingles are frequent; at most FREQUENT are broadcast.
SAMPLE = 5000
SAMPLE_PART = 16
FREQUENT = 500_000
#: Members of a bucket that are paired in one group; larger buckets are dealt out as pairs of groups.
GROUP = 256
_UP, _DOWN = Fraction(SIMILARITY).limit_denominator(1000).as_integer_ratio()
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def text_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


def shingles(found: list[bytes]) -> frozenset[bytes]:
    """The distinct shingles of WIDTH words; of fewer words the whole sequence."""
    if len(found) < WIDTH:
        return frozenset([b" ".join(found)]) if found else frozenset()
    return frozenset(b" ".join(found[i : i + WIDTH]) for i in range(len(found) - WIDTH + 1))


def similarity(a: frozenset[bytes], b: frozenset[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def shingle_hashes(found: list[bytes]) -> np.ndarray:
    """The distinct hashes of the shingles, in ascending order."""
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[WIDTH - 1 :] if len(found) >= WIDTH else ends[-1:]
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(starts[: len(last)].tolist(), last.tolist(), strict=True)], dtype=np.uint64))


def prefix(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles of which two similar sets share one at least. `frequent` has hashes in ascending order, and counts."""
    known, counts = frequent
    rank = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[at] == hashes, counts[at], 0)
    n = len(hashes)
    return hashes[np.lexsort((hashes, rank))[: n + 1 + -n * _UP // _DOWN if n else 0]]


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """512 bits as 8 longs: the parity of the hashes that fall on each."""
    odd = np.bincount((hashes >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


_HASHES = T.ArrayType(T.LongType())


@F.pandas_udf(_HASHES)
def _shingle_hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingle_hashes(text_words(t)).view(np.int64) for t in texts], dtype=object)


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the shingles that repeat in a sample; the texts' hashes choose it."""
    share = max(1, min(SAMPLE_PART, docs.count() // SAMPLE))
    sample = docs.select(F.col("text").cast("binary").alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).distinct()
    counted = sample.select(F.explode(_shingle_hashes("text")).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counted.orderBy(F.col("n").desc(), "s").limit(FREQUENT).toPandas()
    hashes, counts = found["s"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _sketches(spark: SparkSession, frequent: tuple[np.ndarray, np.ndarray]):  # noqa: ANN202
    """Pandas UDF: a text to the hash of its words, its number of shingles, its fingerprint, its bitmap and its prefix."""
    shared = spark.sparkContext.broadcast(frequent)

    @F.pandas_udf("struct<h:bigint,size:int,fp:bigint,bitmap:array<bigint>,prefix:array<bigint>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                found = text_words(t)
                hashes = shingle_hashes(found)
                h = np.uint64(xxhash.xxh64_intdigest(b" ".join(found))).view(np.int64)
                rows.append((h, len(hashes), fingerprint(hashes), bitmap(hashes), prefix(hashes, shared.value).view(np.int64)))
            yield pd.DataFrame(rows, columns=["h", "size", "fp", "bitmap", "prefix"])

    return of


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of distinct shingles, as a signed long."""
    ones = np.zeros(simhash.BITS, np.int64)
    for at in range(0, len(hashes), 50_000):
        ones += simhash.bit_counts(hashes[at : at + 50_000])
    return int(np.uint64(simhash.majority(ones, len(hashes))).view(np.int64))


@F.pandas_udf(T.BooleanType())
def _alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        known: dict[bytes, frozenset[bytes]] = {}
        held = 0
        out = []
        for pair in zip(left, right, strict=True):
            sets = []
            for t in pair:
                if t not in known:
                    if held > 64_000_000:
                        known, held = {}, 0
                    known[t] = shingles(text_words(t))
                    held += 16 * len(t)
                sets.append(known[t])
            small_set, large_set = sorted(map(len, sets))
            out.append(small_set >= SIMILARITY * large_set and similarity(*sets) >= SIMILARITY)
        yield pd.Series(out)


def ball_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts by the operator's ball hashing: stars over fingerprints in one component, each text with the
    first text of the star's centre. Texts of one fingerprint form a star too."""
    prints = texts.where("size > 0").groupBy("fp").agg(F.min("h").alias("first"))
    near = cut(simhash.candidates(prints.select("fp")), "similar-near")
    stars = shuffled(simhash.links(near)).join(prints.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(shuffled(prints.select(F.col("fp").alias("b"), F.col("first").alias("y"))), "b")
    same = texts.where("size > 0").join(shuffled(prints), "fp").where(F.col("h") != F.col("first")).select(F.col("first").alias("a"), F.col("h").alias("b"))
    pairs = cut(stars.select(F.col("x").alias("a"), F.col("y").alias("b")).union(same), "similar-balls")
    discard(near)
    return pairs


def met(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, h, size, at, root) of distinct texts that share a key with a text of another component. `at` is the place of
    the shingle `key` in the text's prefix."""
    dealt = rows.where("size > 0").select("h", "size", F.posexplode("prefix").alias("at", "key")).select("key", "h", "size", "at")
    # One shuffle: texts that repeat, the bucket's extremes and its members are all told by the key.
    by_key = dealt.repartition("key").groupBy("key", "h").agg(F.first("size").alias("size"), F.min("at").alias("at"))
    bucket = Window.partitionBy("key")
    shared = cut(by_key.withColumns({"least": F.min("h").over(bucket), "most": F.max("h").over(bucket)}).where("least <> most").drop("least", "most"), "similar-shared")
    out = live(shared, roots)
    discard(shared)
    return out


def possible(a: str, b: str) -> Column:
    """Whether a shared key leaves room for SIMILARITY: true of similar texts at the first shingle that they share."""
    size = lambda x: F.col(f"{x}.size").cast("long")
    rest = F.least(size(a) - F.col(f"{a}.at"), size(b) - F.col(f"{b}.at"))
    return rest * (_UP + _DOWN) >= _UP * (size(a) + size(b))


def close(a: str, b: str) -> Column:
    """Whether the bitmaps leave room for SIMILARITY."""
    apart = F.aggregate(F.zip_with(f"{a}.bitmap", f"{b}.bitmap", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return apart.cast("long") * (_UP + _DOWN) <= (_DOWN - _UP) * (F.col(f"{a}.size").cast("long") + F.col(f"{b}.size"))


def live(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The members, with their `root`, of the buckets whose members are not all in one component."""
    rooted = members.drop("root")
    if roots is not None:
        rooted = rooted.join(shuffled(roots.withColumnRenamed("node", "h")), "h", "left")
        rooted = rooted.select("key", "h", "size", "at", F.coalesce("root", "h").alias("root"))
    else:
        rooted = rooted.withColumn("root", F.col("h"))
    rooted = cut(rooted, "similar-rooted")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
    out = cut(rooted.join(shuffled(open_), "key"), "similar-live")
    discard(rooted)
    return out


def hub_pairs(members: DataFrame, nth: int, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's most central member and those that are not in its component; with `nth` above 0, of
    the most central one that is in none of the nth components before."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # How many others a text meets: copies of one original meet it more often than each other.
    weights = members.join(shuffled(counts), "key").groupBy("h").agg(F.sum(F.col("n") - 1).alias("weight"))
    weighed = members.join(shuffled(weights), "h")
    hub = None
    for _ in range(nth + 1):
        left = weighed if hub is None else weighed.join(shuffled(hub.select("key", F.col("a.root").alias("taken"))), "key").where("root <> taken").drop("taken")
        hub = left.groupBy("key").agg(F.max_by(F.struct("h", "size", "at", "root"), F.struct("weight", F.bitwise_not(F.col("h")))).alias("a"))
        weighed = left
    met_ = members.join(shuffled(hub), "key").select("a", F.struct("h", "size", "at", "root").alias("b"))
    pairs = met_.where((F.col("a.root") != F.col("b.root")) & possible("a", "b")).select(F.col("a.h").alias("a"), F.col("b.h").alias("b")).distinct()
    of = lambda side: texts.select(F.col("h").alias(side), F.struct("size", "bitmap").alias(f"{side}_text"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(close("a_text", "b_text")).select("a", "b")


def all_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs (a, b) of members of one bucket that are in two components."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    members = members.join(shuffled(counts), "key").join(shuffled(texts.select("h", "bitmap")), "h")
    groups = F.ceil(F.col("n") / GROUP).cast("int")
    member = F.struct("h", "size", "at", "root", "bitmap")
    own = F.pmod(F.xxhash64("h"), groups).cast("int")
    # A bucket's pairs are those of its groups: one side is dealt to its own group, the other to each.
    left = members.select("key", own.alias("group"), member.alias("a"))
    right = members.select("key", F.explode(F.sequence(F.lit(0), groups - 1)).alias("group"), member.alias("b"))
    apart = (F.col("a.h") < F.col("b.h")) & (F.col("a.root") != F.col("b.root"))
    x, y = left.alias("x"), right.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.group") == F.col("y.group"))
    return shuffled(x).join(y, same & apart & possible("a", "b") & close("a", "b")).select(F.col("a.h").alias("a"), F.col("b.h").alias("b")).distinct()


def key_of(doc_id: Column) -> list[Column]:
    """doc_id in two columns that are never null and sort it with null last."""
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("id")]


def text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): (none, id, h) of each row, h telling its words; and (h, root) of the texts that have a link."""
    ship(docs.sparkSession)
    sketch = _sketches(docs.sparkSession, frequent_shingles(docs))
    rows = docs.select(*key_of(F.col("doc_id")), sketch(F.col("text").cast("binary")).alias("p")).select("none", "id", "p.*")
    rows = cut(rows, "similar-prints")
    texts = rows.groupBy("h").agg(F.min(F.struct("none", "id")).alias("least"), F.first(F.struct("size", "fp", "bitmap")).alias("p"))
    texts = cut(texts.select("h", "least", "p.*"), "similar-texts")
    edges, roots = _joined(ball_pairs(texts), None, None, texts, docs)
    members = met(rows, roots)
    ids = cut(rows.select("none", "id", "h"), "similar-rows")
    discard(rows)
    for nth in range(HUBS + 1):
        pairs = cut(hub_pairs(members, nth, texts) if nth < HUBS else all_pairs(members, texts), "similar-pairs")
        edges, roots = _joined(pairs, edges, roots, texts, docs)
        if nth < HUBS:
            before, members = members, live(members, roots)
            discard(before)
    discard(members, texts, edges)
    return ids, roots.withColumnRenamed("node", "h")


def _joined(pairs: DataFrame, edges: DataFrame | None, roots: DataFrame | None, texts: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links so far, roots) with those of `pairs` that are similar. Of links only a spanning star a component is kept."""
    bearers, whole = bearing(pairs, texts, docs)
    found = cut(_compared(pairs, whole), "similar-links")
    discard(pairs, bearers, whole)
    if edges is not None and not found.limit(1).count():
        discard(found)
        return edges, roots
    roots = components(found if edges is None else edges.union(found))
    discard(found, *([] if edges is None else [edges]))
    return cut(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")), "similar-stars"), roots


def bearing(pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that bear the texts of a pair, one a text, and (h, text): only these rows' texts are shuffled."""
    ids = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()
    bearers = cut(texts.join(shuffled(ids), "h").select("h", "least.*"), "similar-bearers")
    whole = docs.select(*key_of(F.col("doc_id")), F.col("text").cast("binary").alias("text")).join(small(bearers), ["none", "id"])
    # With a doc_id that repeats, a bearer may meet another row's text; its words tell.
    whole = whole.select("h", "text").where(_words_hash(F.col("text")) == F.col("h")).groupBy("h").agg(F.min("text").alias("text"))
    return bearers, cut(whole, "similar-whole")


def _compared(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs that are similar enough. Either side's text may belong to many pairs; they are dealt out by both."""
    of = lambda side, name: shuffled(whole.withColumnsRenamed({"h": side, "text": name}))
    sides = pairs.join(of("a", "left"), "a").join(of("b", "right"), "b")
    return sides.where(_alike("left", "right")).select("a", "b")


@F.pandas_udf(T.LongType())
def _words_hash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([xxhash.xxh64_intdigest(b" ".join(text_words(t))) for t in texts], dtype=np.uint64).view(np.int64))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id; of rows that repeat, one.

    Null, empty and blank texts are one group. A null doc_id is larger than any other."""
    rows, roots = text_classes(docs)
    rooted = rows.join(shuffled(roots), "h", "left").select("none", "id", "h", F.coalesce("root", "h").alias("root"))
    kept = cut(rooted.groupBy("root").agg(F.min(F.struct("none", "id", "h")).alias("key")).select("key.*"), "similar-kept")
    # Rows are told apart by doc_id; where it repeats, by their words.
    repeated = rows.groupBy("none", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *key_of(F.col("doc_id")))
    if not repeated:
        return whole.join(small(kept.select("none", "id")), ["none", "id"], "left_semi").select("row.*")
    marked = whole.withColumn("h", _words_hash(F.col("row.text").cast("binary")))
    chosen = marked.join(small(kept), ["none", "id", "h"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("none", "id", "h").orderBy("none", "id", "h"))
    return chosen.withColumn("nth", nth).where("nth = 1").select("row.*")
