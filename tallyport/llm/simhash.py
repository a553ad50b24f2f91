"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most 3 bits apart meet in a variant that is 1 bit from one and at most 2 bits from the other. Which
of the two goes further is settled by parity: fingerprints 3 bits apart differ in parity, so the odd one emits all
variants within 1 bit, and the even one also those 2 bits away. Of any three differing bits two lie in the same half of
the word, so the even one needs pairs of bits of one half only. In a variant's bucket every member is linked to every
member that is within 1 bit of it (an even distance between equal parities, else at most 1 + 2), so one star around
such a member stands for all pairs: a bucket costs as many rows as it has members, never their square.

Before that, fingerprints that can have no partner are left out. Of two within 3 bits, one half differs in at most
1 bit; so a fingerprint stays if another's half is within 1 bit of its own. Nothing is lost, at any size.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other; with fewer words than
a shingle the whole sequence is the one shingle; rows that repeat have equal fingerprints and one component; an empty
table gives no rows; a null doc_id never is the smallest of its component unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import cut, discard, shuffled, table, unsigned_hex
from tallyport.session import ship

BITS = 64
RADIUS = 3
SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words whose shingles are hashed and summed at once; bounds memory for very long texts.
_AT_ONCE = 50_000


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: a bit is set if set in over half of the shingles' hashes."""
    found = (text or b"").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = max(1, len(found) - width + 1)
    first, last = starts[:spans].tolist(), (ends[width - 1 :] if len(found) >= width else ends[-1:]).tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, spans, _AT_ONCE):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first[at : at + _AT_ONCE], last[at : at + _AT_ONCE], strict=True)], dtype="<u8")
        ones += bit_counts(hashes)
    return majority(ones, spans)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(np.ascontiguousarray(hashes).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, of: int) -> int:
    return int(np.packbits(2 * ones > of, bitorder="little").view("<u8")[0])


def fingerprints(width: int = 3):  # noqa: ANN201
    """Pandas UDF: UTF-8 bytes to the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return of


def with_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of each row, written once."""
    return cut(docs.select("doc_id", fingerprints(width)(F.col("text").cast("binary")).alias("fp")), "simhash")


def _masks(within: int) -> list[int]:
    """Signed longs with 0..within bits; of two bits, both in one half."""
    bits = [1 << i for i in range(BITS)]
    out = [0, *bits] if within == 1 else [a | b for i, a in enumerate(bits) for j, b in enumerate(bits) if i < j and i // 32 == j // 32]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def _flipped(value: Column, masks: list[int]) -> Column:
    return F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m)))


def candidates(prints: DataFrame) -> DataFrame:
    """The distinct fingerprints (fp) of which another has a half within one bit."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    halves = prints.select("fp", F.explode(F.array(low, high.bitwiseOR(F.lit(1 << 32)))).alias("half"))
    index = halves.groupBy("half").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    near = halves.select("fp", _flipped(F.col("half"), [0, *(1 << i for i in range(32))]).alias("half"))
    met = shuffled(near).join(index, "half").where((F.col("least") != F.col("fp")) | (F.col("most") != F.col("fp")))
    return met.select("fp").distinct()


def links(prints: DataFrame) -> DataFrame:
    """Star links (a, b) whose components are those of all pairs within RADIUS bits."""
    even = F.bit_count("fp") % 2 == 0
    near = prints.select("fp", _flipped(F.col("fp"), _masks(1)).alias("variant"), F.lit(True).alias("near"))
    far = prints.where(even).select("fp", _flipped(F.col("fp"), _masks(2)).alias("variant"), F.lit(False).alias("near"))
    centre = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    starred = near.union(far).select("fp", centre.alias("centre"))
    return starred.where(F.col("centre") != F.col("fp")).select(F.col("centre").alias("a"), F.col("fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node that has a link; root is the smallest node of its component. Alternates large and
    small stars until nothing changes: a number of steps that grows with the logarithm of the nodes. Neighbours are only
    aggregated and joined, so a hub is never one task's list. Each step's table goes once the next one is written."""
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large, "cc")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, edges = edges, cut(small, "cc")
        discard(before, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            found = cut(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "cc-roots")
            discard(edges)
            return found
        seen = tuple(now)


def classes(prints: DataFrame) -> DataFrame:
    """(doc_id, fp) rows to (fp, root, component_id): root is the component's least fingerprint as a signed long."""
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    kept = cut(candidates(by_print.select("fp")), "simhash-near")
    roots = shuffled(components(links(kept)))
    discard(kept)
    rooted = by_print.join(roots, by_print.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(shuffled(smallest), "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row."""
    ship(docs.sparkSession)
    prints = with_fingerprints(docs, width)
    of = cut(classes(prints), "simhash-classes")
    return prints.join(shuffled(of), "fp").select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
