"""Ranked lexical search by Fagin's threshold algorithm over an index that is split by documents.

A pass over the documents writes the forward index: of each document its length and, for the terms that any query has, how
often they occur. The counts that scores need (documents, lengths, documents with a term) are aggregates of that table.
Every task then takes its documents in segments. In a segment each term has a list of its documents in falling order of
impact, and a query is answered by the threshold algorithm: its lists are read round by round, a document that is met for
the first time is looked up in the forward index and scored in full, and the search ends once the threshold, the sum of
the impacts last read, is strictly below the k-th best score (a document not met yet can't reach it; one that ties with it
still can, and doc_id decides). Rounds are read in blocks of growing size, with the threshold tested after each block. What
a task has found in one segment is the k-th score to beat in the next, so a task puts out k rows a query, however many
documents it had. These are merged in two steps, first within a few dozen groups of tasks, then a query.

Impacts are whole numbers, so scores add up alike in any order.

Items are taken in blocks of BLOCK_ITEMS items or BLOCK_CHARS characters; a block's terms are what is broadcast. Each block
reads the documents once and is written before the next one begins.

Defined results: null texts have no terms; a document without terms is in no count and no result; an item without terms has
no rows; rows that repeat are ranked each by itself; items that repeat are answered each by itself; a null doc_id comes
last among equal scores; with no documents or no items there are no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import cut, discard, table
from tallyport.session import ship

TOP = 50
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000
#: Documents and index entries of a segment.
SEGMENT_DOCS = 16_384
SEGMENT_ENTRIES = 4_000_000
#: Rounds of the first block; each further block has twice as many.
FIRST_ROUNDS = 8
#: Groups in which the tasks' results are merged first.
MERGE_GROUPS = 32
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_FOUND = "item int, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and all other characters than ASCII; only A-Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


def weight(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def blocks(items: DataFrame) -> Iterator[list[tuple[object, bytes]]]:
    """(item_id, text) of all items in bounded blocks; one block at a time is with the driver."""
    held: list[tuple[object, bytes]] = []
    chars = 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).where("text IS NOT NULL").toLocalIterator():
        text = bytes(row.text)
        if held and (len(held) >= BLOCK_ITEMS or chars + len(text) > BLOCK_CHARS):
            yield held
            held, chars = [], 0
        held.append((row.item_id, text))
        chars += len(text)
    if held:
        yield held


def forward_index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term: its length in terms, and of the vocabulary's terms that it
    has the numbers and the occurrences."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        known = numbers.keys()
        for batch in batches:
            ids, lengths, sizes, numbers_of, counts_of = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                counted = Counter(found)
                have = known & counted.keys()
                ids.append(doc_id)
                lengths.append(len(found))
                numbers_of += [numbers[t] for t in have]
                counts_of += [counted[t] for t in have]
                sizes.append(len(numbers_of))
            offsets = pa.array(sizes, pa.int32())
            arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(numbers_of, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(counts_of, pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return cut(rows.mapInArrow(index, "doc_id long, n long, terms array<int>, counts array<int>"), "ranked-forward")


class Segment:
    """Some documents' part of the index: their entries by document, and by term in falling order of impact."""

    def __init__(self, ids: list[int | None], lengths: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, counts: np.ndarray, weights: np.ndarray, documents: int, total: int) -> None:
        self.ids = ids
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.numbers = numbers
        norm = 50 + 50 * lengths * documents // total
        of = np.repeat(np.arange(len(ids)), sizes)
        self.impacts = weights[numbers] * (1_000_000_000 * counts // (1000 * counts + 20 * norm[of]))
        order = np.lexsort((-self.impacts, numbers))
        self.list_docs, self.list_impacts = of[order], self.impacts[order]
        self.list_starts = np.searchsorted(numbers[order], np.arange(len(weights) + 1))
        self.wanted = np.zeros(len(weights), np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores of documents for the terms in `wanted`, by the forward index."""
        starts, sizes = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.arange(int(sizes.sum())) + np.repeat(starts - begins, sizes)
        return np.add.reduceat(self.wanted[self.numbers[at]] * self.impacts[at], begins)

    def search(self, query: np.ndarray, top: list[tuple[int, float, int | None]], k: int) -> None:
        """Put the segment's best documents for the terms of a query into `top`, a heap of (score, -doc_id, doc_id)."""
        bounds = [(int(self.list_starts[t]), int(self.list_starts[t + 1])) for t in query.tolist()]
        bounds = [b for b in bounds if b[0] < b[1]]
        self.wanted[query] = 1
        met = np.zeros(len(self.ids), bool)
        depth, rounds = 0, FIRST_ROUNDS
        while bounds:
            read = np.concatenate([self.list_docs[a + depth : min(a + depth + rounds, b)] for a, b in bounds])
            new = np.unique(read[~met[read]])
            if len(new):
                met[new] = True
                found = self.scores(new)
                keep = np.flatnonzero(found >= (top[0][0] if len(top) == k else 1))
                for i in keep.tolist():
                    score, doc_id = int(found[i]), self.ids[new[i]]
                    entry = (score, -math.inf if doc_id is None else -doc_id, doc_id)
                    if len(top) < k:
                        heapq.heappush(top, entry)
                    elif entry[:2] > top[0][:2]:
                        heapq.heapreplace(top, entry)
            depth += rounds
            rounds *= 2
            bounds = [(a, b) for a, b in bounds if a + depth < b]
            threshold = sum(int(self.list_impacts[a + depth - 1]) for a, _ in bounds)
            if len(top) == k and threshold < top[0][0]:
                break
        self.wanted[query] = 0


def _segments(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, total: int) -> Iterator[Segment]:
    """The rows of the forward index in segments of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = entries = 0

    def made() -> Segment:
        whole = pa.Table.from_batches(held).combine_chunks()
        numbers, counts = (whole.column(c).combine_chunks() for c in ("terms", "counts"))
        sizes = np.diff(numbers.offsets.to_numpy())
        flat = lambda a: a.flatten().to_numpy(zero_copy_only=False)
        return Segment(whole.column("doc_id").to_pylist(), whole.column("n").to_numpy(), sizes, flat(numbers), flat(counts).astype(np.int64), weights, documents, total)

    for batch in batches:
        for at in range(0, batch.num_rows, SEGMENT_DOCS):
            part = batch.slice(at, SEGMENT_DOCS)
            size = len(part.column(2).flatten())
            if held and (rows + part.num_rows > SEGMENT_DOCS or entries + size > SEGMENT_ENTRIES):
                yield made()
                held, rows, entries = [], 0, 0
            held.append(part)
            rows += part.num_rows
            entries += size
    if rows:
        yield made()


def best(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): of each task the best k documents of each query."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weighed = shared.value
        tops: list[list[tuple[int, float, int | None]]] = [[] for _ in asked]
        for segment in _segments(batches, weighed, documents, total):
            for query_, top in zip(asked, tops, strict=True):
                segment.search(query_, top, k)
        rows = [(i, doc_id, score) for i, top in enumerate(tops) for score, _, doc_id in top]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

    # A document without a term of any query is in the counts only.
    return index.where(F.size("terms") > 0).mapInArrow(run, _FOUND)


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    out: list[DataFrame] = []
    for block in blocks(items):
        found = [sorted(set(terms(text))) for _, text in block]
        vocabulary = sorted(set().union(*found))
        if not vocabulary:
            continue
        index = forward_index(docs, vocabulary)
        documents, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row a term of the block, which the block's size bounds.
        holding = {r.term: r.n for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
        weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        number = {t: i for i, t in enumerate(vocabulary)}
        queries = [np.array([number[t] for t in f], np.int64) for f in found]
        tasks = best(index, queries, weights, documents, max(total, 1), k).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
        ranked = _top(_top(tasks, ["item", "group"], k).drop("rank", "group"), ["item"], k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind}")
        out.append(cut(ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked"))
        discard(index)
    if not out:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.union, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""WITH q AS (SELECT item_id, row_number() OVER () AS item, {_TERMS} AS found FROM benchmark), qt AS (SELECT DISTINCT item, item_id, unnest(found) AS term FROM q),
 d AS (SELECT doc_id, row_number() OVER () AS place, {_TERMS} AS found FROM documents), l AS (SELECT doc_id, place, len(found) AS n FROM d WHERE len(found) > 0), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
 t AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(found) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
 p AS (SELECT place, term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS impact FROM t JOIN f USING (term) JOIN l USING (place), s),
 r AS (SELECT item, any_value(item_id) AS item_id, place, CAST(sum(impact) AS BIGINT) AS score FROM qt JOIN p USING (term) GROUP BY item, place HAVING sum(impact) > 0),
 k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM r JOIN l USING (place)) SELECT * FROM k WHERE rank <= {TOP}"""
