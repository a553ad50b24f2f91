"""MinHash near-duplicates: universal hash minima in bands, signature check, exact check, components by stars.

A text's set is its distinct shingles of WIDTH lower-cased words. Each of HASHES multiply-shift functions of the shingles'
64-bit hashes gives a minimum; two sets agree in one with a probability equal to their Jaccard similarity. BANDS bands of
ROWS minima are the buckets. Two sets of similarity 0.8 share no bucket with probability (1 - 0.8 ** 5) ** 51, below 2e-9,
and more similar ones less. The lowest bits of the minima, packed into a few words, are the signature: of two sets with
similarity s they differ in (1 - s) / 2 of HASHES bits, so a pair that differs in more than MOST_APART is left out (at 0.8
that is nearly seven standard deviations off, below 1e-9). Sizes rule out pairs exactly, and so do bitmaps that have for
each of BITS places the parity of the hashes that fall on it: two differ in at most as many bits as the sets have elements
that are not in both. What is left is compared on full sets.

Equal word sequences count as one text from the start. A bucket is never ordered, collected or read by one task: what has
to be known of it is aggregated and joined back. Its pairs are settled in rounds. In HUBS rounds each text is compared with
one other, the most central text of any of its buckets that it is not joined with (a family of copies meets its original most
often), and what is alike becomes one component. Then all pairs of members that are still in two components are compared, each
in the first bucket that both are in; they are dealt out by size classes, of which only neighbours can hold similar sets, and
within a class by groups. So no link between two components is lost, and a family that is one component costs no pairs. Texts
of a family that are alike, but not alike enough, are the part that grows with the square of the family: no bound short of
the comparison tells them from links.

Defined results: texts without words (null, empty, blank) have an empty set and link with nothing; with fewer words than a
shingle the whole sequence is the one shingle; rows that repeat are in one component, and all are kept if their doc_id is
the component's; a null doc_id is never the smallest of its component unless all are null; an empty table gives no rows.
Texts are told apart by 64-bit hashes of their words; two texts of 10**9 share one by chance with probability 0.03.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm.common import cut, discard, small, table
from tallyport.llm.simhash import components
from tallyport.session import ship

WIDTH = 4
SIMILARITY = Fraction(4, 5)
BANDS, ROWS = 51, 5
HASHES = 256
MOST_APART = 58
BITS = 1024
HUBS = 3
#: Members of a bucket's size class that are paired in one group.
GROUP = 1024
#: Pairs of texts that are handed to Python at once.
TEXTS_AT_ONCE = 500
_SEED = 20_240_229
#: Shingles that are hashed at once; bounds memory for very long texts.
_AT_ONCE = 512
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_UP, _DOWN = SIMILARITY.numerator, SIMILARITY.denominator


def text_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


def shingles(found: list[bytes]) -> frozenset[bytes]:
    """The distinct shingles of WIDTH words; of fewer words the whole sequence; none without words."""
    if len(found) < WIDTH:
        return frozenset([b" ".join(found)]) if found else frozenset()
    return frozenset(b" ".join(found[i : i + WIDTH]) for i in range(len(found) - WIDTH + 1))


def shingle_hashes(found: list[bytes]) -> np.ndarray:
    """The distinct 64-bit hashes of the shingles."""
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[WIDTH - 1 :] if len(found) >= WIDTH else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts[: len(last)].tolist(), last.tolist(), strict=True)), np.uint64, len(last)))


class Hashes:
    """Functions x -> (a * x + b mod 2 ** 64) >> 32 with odd a, drawn from a fixed seed."""

    def __init__(self, count: int = HASHES, seed: int = _SEED) -> None:
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 63, count, np.uint64) << np.uint64(1) | np.uint64(1))[:, None]
        self.b = rng.integers(0, (1 << 64) - 1, count, np.uint64, endpoint=True)[:, None]

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The functions' minima over a set that is not empty."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), _AT_ONCE):
            values = self.a * hashes[at : at + _AT_ONCE]
            values += self.b
            np.minimum(least, values.min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: np.ndarray) -> list[int]:
    """A signed 64-bit key a band."""
    data = minima.astype("<u4").tobytes()
    size = 4 * ROWS
    return [xxhash.xxh64_intdigest(data[i * size : (i + 1) * size], i) - (1 << 63) for i in range(BANDS)]


def lanes(keys: list[int]) -> np.ndarray:
    """32 bits of each band's key, which tell the first band that two texts share but for one pair in 10**8."""
    return np.array(keys, np.int64).view(np.uint32)[::2].view(np.int32)


def bitmap(hashes: np.ndarray) -> list[int]:
    """BITS bits as signed longs: whether an odd number of the hashes falls on each."""
    odd = np.bincount((hashes >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def signature(minima: np.ndarray) -> list[int]:
    """The minima's lowest bits as signed longs."""
    return np.packbits((minima & np.uint32(1)).astype(np.uint8), bitorder="little").view("<i8").tolist()


_LONGS = T.ArrayType(T.LongType())


@F.pandas_udf(T.StructType().add("h", "long").add("size", "long").add("sig", _LONGS).add("bits", _LONGS).add("keys", _LONGS).add("lanes", T.ArrayType(T.IntegerType())))
def sketches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """A text to the hash of its words, its set's size, its signature and its bands' keys."""
    drawn = Hashes()
    for texts in batches:
        rows = []
        for text in texts:
            found = text_words(text)
            hashes = shingle_hashes(found)
            h = xxhash.xxh64_intdigest(b" ".join(found)) - (1 << 63)
            if not len(hashes):
                rows.append((h, 0, [], [], [], []))
                continue
            minima = drawn.minima(hashes)
            keys = band_keys(minima)
            rows.append((h, len(hashes), signature(minima), bitmap(hashes), keys, lanes(keys)))
        yield pd.DataFrame(rows, columns=["h", "size", "sig", "bits", "keys", "lanes"])


@F.pandas_udf(T.LongType())
def words_hash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([xxhash.xxh64_intdigest(b" ".join(text_words(t))) - (1 << 63) for t in texts], dtype=np.int64)


@F.pandas_udf(T.BooleanType())
def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether two texts' full sets are similar enough. Sets of texts that come again are kept while they are few."""
    known: dict[bytes, frozenset[bytes]] = {}
    held = 0
    for left, right in batches:
        out = []
        for pair in zip(left, right, strict=True):
            sets = []
            for text in pair:
                if text not in known:
                    if held > 64_000_000:
                        known.clear()
                        held = 0
                    known[text] = shingles(text_words(text))
                    held += 16 * len(text)
                sets.append(known[text])
            both = len(sets[0] & sets[1])
            out.append(both > 0 and both * _DOWN >= _UP * (len(sets[0]) + len(sets[1]) - both))
        yield pd.Series(out, dtype=bool)


def near(a: Column, b: Column) -> Column:
    """Whether sizes, bitmaps and signatures leave room for the similarity."""
    fits = F.least(a["size"], b["size"]) * _DOWN >= F.greatest(a["size"], b["size"]) * _UP
    differ = lambda name, longs: reduce(Column.__add__, [F.bit_count(a[name][i].bitwiseXOR(b[name][i])) for i in range(longs)])
    # Of sets that are similar enough at most this part of both sizes is not in both.
    return fits & (differ("sig", HASHES // 64) <= MOST_APART) & (differ("bits", BITS // 64) * (_DOWN + _UP) <= (a["size"] + b["size"]) * (_DOWN - _UP))


def met(texts: DataFrame) -> DataFrame:
    """(key, band, h, root) of distinct texts in the buckets that hold more than one, each text its own root."""
    dealt = texts.where("size > 0").select("h", F.posexplode("keys").alias("band", "key"))
    shared = dealt.groupBy("key").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least <> most").select("key")
    return cut(dealt.join(shared, "key").select("key", "band", "h", F.col("h").alias("root")), "minhash-met")


def live(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, band, h, root) of the buckets whose members are not all in one component."""
    rooted = cut(members.select("key", "band", "h").join(roots.withColumnRenamed("node", "h"), "h", "left").select("key", "band", "h", F.coalesce("root", "h").alias("root")), "minhash-rooted")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
    out = cut(rooted.join(open_, "key"), "minhash-live")
    discard(rooted)
    return out


def _with_sketches(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts that sizes and signatures do not rule out."""
    of = lambda side: texts.select(F.col("h").alias(side), F.struct("size", "sig", "bits").alias(f"of_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(near(F.col("of_a"), F.col("of_b"))).select("a", "b")


def hub_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b): each text with the most central one, of those that are first in one of its buckets, in another component."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weights = members.join(counts, "key").groupBy("h").agg(F.sum(F.col("n") - 1).alias("weight"))
    rank = F.struct("weight", F.bitwise_not(F.col("h")))
    hub = members.join(weights, "h").groupBy("key").agg(F.max_by(F.struct("h", "root", "weight"), rank).alias("hub"))
    apart = members.join(hub, "key").where(F.col("root") != F.col("hub.root"))
    best = apart.groupBy("h").agg(F.max_by("hub.h", F.struct("hub.weight", F.bitwise_not(F.col("hub.h")))).alias("hub"))
    pairs = best.select(F.least("h", "hub").alias("a"), F.greatest("h", "hub").alias("b")).distinct()
    of = lambda side: texts.select(F.col("h").alias(side), F.struct("size", "sig", "bits").alias(f"of_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(near(F.col("of_a"), F.col("of_b"))).select("a", "b")


def all_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that are in two components, each in the first bucket that both are in. Sets of which one
    is less than 0.8 times as large as the other never meet, and a size class is dealt out as pairs of groups."""
    # A trifle more than the logarithm, so that rounding never puts similar sizes two classes apart.
    step = math.log(_DOWN / _UP) * (1 + 1e-9)
    sized = members.join(texts.select("h", "size", "sig", "bits", "lanes"), "h").withColumn("class", F.floor(F.log("size") / step).cast("int"))
    counts = sized.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    member = F.struct("h", "root", "size", "sig", "bits", "lanes")
    # A pair of two classes is met at the upper one. One side is dealt to its own group, the other to every group.
    right = sized.select("key", F.col("class").alias("own"), F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"), member.alias("b"))
    groups = counts.select("key", "class", "n", F.ceil(F.col("n") / GROUP).cast("int").alias("groups"))
    left = sized.select("key", "band", "class", member.alias("a")).join(groups, ["key", "class"]).select("key", "band", "class", F.pmod(F.xxhash64("a.h"), F.col("groups")).cast("int").alias("group"), "a")
    # Who is alone in a class meets nobody there.
    right = right.join(groups, ["key", "class"]).where("own <> class OR n > 1").select("key", "class", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "b")
    left, right = left.alias("l"), right.alias("r")
    a, b = F.col("l.a"), F.col("r.b")
    one = reduce(Column.__and__, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "class", "group")])
    # Pairs of one class would meet twice.
    once = (F.floor(F.log(b["size"]) / step).cast("int") != F.col("l.class")) | (a["h"] < b["h"])
    before = lambda side: F.slice(side["lanes"], F.lit(1), F.col("l.band"))
    earlier = F.exists(F.zip_with(before(a), before(b), lambda x, y: x == y), lambda same: same)
    return left.join(right, one & once & (a["root"] != b["root"]) & near(a, b) & ~earlier).select(F.least("l.a.h", "r.b.h").alias("a"), F.greatest("l.a.h", "r.b.h").alias("b"))


def confirmed(pairs: DataFrame, bearers: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough. Only texts of a pair are read out and shuffled."""
    ids = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()
    wanted = cut(bearers.join(ids, "h"), "minhash-wanted")
    rows = docs.select(*_id(F.col("doc_id")), F.col("text").cast("binary").alias("text")).join(small(wanted), ["none", "id"])
    # Where a doc_id repeats, a bearer may meet another row's text; its words tell.
    with few_rows(docs.sparkSession, TEXTS_AT_ONCE):
        return _compared(pairs, wanted, rows)


def _compared(pairs: DataFrame, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    whole = cut(rows.where(words_hash("text") == F.col("h")).groupBy("h").agg(F.min("text").alias("text")), "minhash-whole")
    sides = pairs.join(whole.select(F.col("h").alias("a"), F.col("text").alias("left")), "a").join(whole.select(F.col("h").alias("b"), F.col("text").alias("right")), "b")
    found = cut(sides.where(alike("left", "right")).select("a", "b"), "minhash-links")
    discard(wanted, whole)
    return found


@contextmanager
def few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most `rows` rows between Spark and Python: rows with whole texts, two of them in a pair, may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _id(doc_id: Column) -> list[Column]:
    """doc_id in two columns that are never null and sort it with null last."""
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("id")]


def _roots(stars: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spanning stars, roots) of the links so far and those just found."""
    roots = components(found if stars is None else stars.union(found))
    return cut(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")), "minhash-stars"), roots


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): (none, id, h, size) of each row, h telling its words, and (h, root) of the texts with a link."""
    ship(docs.sparkSession)
    with few_rows(docs.sparkSession, 4 * TEXTS_AT_ONCE):
        sketched = cut(docs.select(*_id(F.col("doc_id")), sketches(F.col("text").cast("binary")).alias("s")).select("none", "id", "s.*"), "minhash-rows")
    texts = sketched.groupBy("h").agg(F.min(F.struct("none", "id")).alias("least"), F.first(F.struct("size", "sig", "bits", "keys", "lanes")).alias("s"))
    texts = cut(texts.select("h", "least.*", "s.*"), "minhash-texts")
    rows = cut(sketched.select("none", "id", "h", "size"), "minhash-ids")
    discard(sketched)
    members, stars, roots = met(texts), None, None
    bearers = cut(texts.select("h", "none", "id", "size", "sig", "bits", "lanes"), "minhash-bearers")
    discard(texts)
    for nth in range(HUBS + 1):
        pairs = cut(hub_pairs(members, bearers) if nth < HUBS else all_pairs(members, bearers), "minhash-pairs")
        if pairs.limit(1).count():
            found = confirmed(pairs, bearers.select("h", "none", "id"), docs)
            before = [] if stars is None else [stars, roots]
            stars, roots = _roots(stars, found)
            discard(found, *before)
        discard(pairs)
        if nth < HUBS and roots is not None:
            passed, members = members, live(members, roots)
            discard(passed)
    discard(members, bearers, *([] if stars is None else [stars]))
    if roots is None:
        roots = docs.sparkSession.createDataFrame([], "node long, root long")
    return rows, roots.withColumnRenamed("node", "h")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row."""
    rows, roots = classes(docs)
    doc_id = F.when(~F.col("none"), F.col("id"))
    rooted = rows.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    # Texts without words link with nothing, not even each other.
    linked = rooted.where("size > 0").groupBy("root").agg(F.min(doc_id).alias("component_id"))
    out = rooted.join(linked, "root", "left").select(doc_id.alias("doc_id"), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(doc_id).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
