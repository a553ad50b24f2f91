"""Benchmark decontamination by template windows.

A text becomes a template: numbers, names (capitalised words inside a sentence) and units (after a number) turn into
typed placeholders, other words are lower-cased. Windows of WINDOW template tokens are hashed and joined with the
benchmark's by a hash table that is broadcast. Matching windows of a document and an item that lie on one diagonal are
an alignment; its slots are checked: a benchmark value must stand for one document value throughout (a re-parameterised
question), or else only windows whose slots are equal count. A document holds an item if the accepted windows cover
COVERAGE of the item's. The same is done with plain lower-cased tokens, so a change of case or stops does not hide a
copy. A capitalised word that starts a sentence may be a name or not, so there are two templates: one where it is a
word, and one where it is a name. A run of names within a sentence is one slot. Windows with too few words that are not placeholders are not used.

The benchmark is the query set: it is taken in blocks of at most BLOCK_ITEMS items and BLOCK_CHARS characters, each
broadcast on its own; every text is read whole, and documents are not shuffled. Documents are read once a block, so the
cost grows with the benchmark's blocks (one for benchmarks of up to 20,000 items), and a window that many items share is
looked up for each of them.

Defined results: null and empty texts hold nothing; benchmark items without a text, or with fewer than SHORTEST tokens,
are in no document; items between SHORTEST and WINDOW tokens are one window; rows that repeat are reported as often;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import table
from tallyport.session import ship

WINDOW = 8
SHORTEST = 5
COVERAGE = 0.4
#: Least share of a template window's tokens that are not placeholders.
LITERAL = 0.5
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000
CACHE_TOKENS = 500_000
#: Characters of texts that are searched together for any item's window.
BATCH_CHARS = 1_000_000
_TOKEN = re.compile(r"[.!?\n]+|[^\W\d_]+|\d+(?:[.,:/]\d+)*|[%$€£°]")
#: Units that become a placeholder after a number.
UNITS = frozenset(
    "% $ € £ ° mm cm m km in inch inches ft foot feet yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs oz pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees meter meters metre metres kilometer kilometers kph mph watt watts volt volts".split()
)
_WORD, _CAPITAL, _NUMBER, _STOP, _UNIT = range(5)
_NAME_CODE, _NUMBER_CODE, _UNIT_CODE = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\x00name", b"\x00number", b"\x00unit"))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)
_FILTER_BITS = 22
HIT = "item_id long, coverage double, kind string, first_token long, changed_slots int"


class Coder:
    """Tokens to hashes and kinds, remembered by token."""

    def __init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self.at: dict[str, int] = {}
        #: While a batch is read, its tokens stay.
        self.held = False
        self.codes = np.zeros(1024, np.uint64)
        self.kinds = np.zeros(1024, np.int8)

    def _learn(self, token: str) -> None:
        at, low = len(self.at), token.lower()
        if at == len(self.codes):
            self.codes, self.kinds = np.resize(self.codes, 2 * at), np.resize(self.kinds, 2 * at)
        self.at[token] = at
        self.codes[at] = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"))
        self.kinds[at] = _STOP if token[0] in ".!?\n" else _NUMBER if token[0].isdigit() else _UNIT if low in UNITS else _CAPITAL if token[0].isupper() and not token[1:].isupper() else _WORD

    def _rows(self, text: str | None) -> tuple[list[str], np.ndarray]:
        """All tokens of a text, stops included, and the place of each in `codes` and `kinds`."""
        found = _TOKEN.findall(text) if text else []
        new = set(found).difference(self.at)
        if new:
            if len(self.at) > CACHE_TOKENS and not self.held:
                self._reset()
                new = set(found)
            for token in new:
                self._learn(token)
        return found, np.fromiter(map(self.at.__getitem__, found), np.int64, len(found))

    def plain(self, text: str | None) -> tuple[list[str], np.ndarray]:
        """The lower-cased reading alone: tokens without stops, and their codes."""
        found, rows = self._rows(text)
        keep = self.kinds[rows] != _STOP
        return [t for t, k in zip(found, keep.tolist(), strict=True) if k], self.codes[rows[keep]]

    def code(self, text: str | None) -> list[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
        """Three readings, plain and the two templates: tokens without stops, their codes, whether they are placeholders,
        and the place of each among the plain tokens."""
        found, rows = self._rows(text)
        place = np.cumsum(self.kinds[rows] != _STOP) - 1
        out = []
        for codes, slot, starts, more in self._readings(rows):
            ends = np.append(starts[1:], len(found)) if len(starts) else starts
            tokens = [found[at] for at in starts.tolist()]
            for i in np.flatnonzero(more[np.minimum(starts + 1, len(found) - 1)] & (starts + 1 < len(found))).tolist() if len(starts) else ():
                tokens[i] = " ".join(t for t, m in zip(found[starts[i] + 1 : ends[i]], more[starts[i] + 1 : ends[i]].tolist(), strict=True) if m)
                tokens[i] = f"{found[starts[i]]} {tokens[i]}"
            out.append((tokens, codes, slot, place[starts]))
        return out

    def _readings(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each reading: codes, placeholders, which token each begins with, and which tokens go on with a run of names."""
        codes, kinds = self.codes[rows], self.kinds[rows]
        before = np.concatenate((np.array([_STOP], np.int8), kinds[:-1]))[: len(kinds)]
        keep = kinds != _STOP
        starts = np.flatnonzero(keep)
        out = [(codes[starts], np.zeros(len(starts), bool), starts, np.zeros(len(rows), bool))]
        number, unit = kinds == _NUMBER, (kinds == _UNIT) & (before == _NUMBER)
        typed = np.where(number, _NUMBER_CODE, np.where(unit, _UNIT_CODE, codes))
        for name in ((kinds == _CAPITAL) & (before != _STOP), kinds == _CAPITAL):
            more = name.copy()
            more[1:] &= name[:-1]
            more[:1] = False
            starts = np.flatnonzero(keep & ~more)
            out.append((np.where(name, _NAME_CODE, typed)[starts], (name | number | unit)[starts], starts, more))
        return out

    def batch(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each reading of many texts at once: the codes, and the text of each. A stop stands between two texts, so each
        reads as by itself; only windows may reach into the next."""
        if len(self.at) > CACHE_TOKENS:
            self._reset()
        self.held = True
        rows = [np.append(self._rows(t)[1], self._stop()) for t in texts]
        self.held = False
        every = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return [(codes, of[starts]) for codes, _, starts, _ in self._readings(every)]

    def _stop(self) -> int:
        if "\n" not in self.at:
            self._learn("\n")
        return self.at["\n"]


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += (codes[k : k + n] ^ (codes[k : k + n] >> np.uint64(29))) * _FACTORS[k]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


class Index:
    """Windows of a block of benchmark items."""

    def __init__(self, items: Iterable[tuple[int, str]]) -> None:
        coder = Coder()
        #: Of each item and reading: tokens, codes, placeholders, size of windows, number of windows.
        self.items: dict[int, list[tuple[list[str], np.ndarray, np.ndarray, int, int]]] = {}
        self.windows: tuple[dict[tuple[int, int], list[tuple[int, int]]], ...] = (defaultdict(list), defaultdict(list), defaultdict(list))
        for item, text in items:
            readings = coder.code(text)
            if len(readings[0][0]) < SHORTEST:
                continue
            self.items[item] = []
            for way, (tokens, codes, slot, _) in enumerate(readings):
                size, used = min(WINDOW, len(tokens)), 0
                literal = np.convolve(~slot, np.ones(size), "valid")
                for at, h in enumerate(window_hashes(codes, size).tolist()):
                    if way == 0 or literal[at] >= LITERAL * size:
                        self.windows[way][size, h].append((item, at))
                        used += 1
                self.items[item].append((tokens, codes, slot, size, used))
        self.sizes = [sorted({x[way][3] for x in self.items.values()}) for way in range(3)]
        self.filters = []
        for way in range(3):
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[[h >> (64 - _FILTER_BITS) for _, h in self.windows[way]]] = True
            self.filters.append(bits)
        self.hashes = [np.array(sorted({h for _, h in self.windows[way]}), dtype=np.uint64) for way in range(3)]

    def may_hold(self, coder: Coder, texts: list[str | None]) -> np.ndarray:
        """Which texts have a window of any item; all others hold none."""
        out = np.zeros(len(texts), bool)
        for way, (codes, of) in enumerate(coder.batch(texts)):
            known = self.hashes[way]
            for size in self.sizes[way] if len(known) else ():
                hashes = window_hashes(codes, size)
                at = np.flatnonzero(self.filters[way][hashes >> np.uint64(64 - _FILTER_BITS)])
                place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                out[of[at[known[place] == hashes[at]]]] = True
        return out

    def hits(self, coder: Coder, text: str | None) -> list[dict]:
        """The items that a text holds."""
        best: dict[int, dict] = {}
        for way, (tokens, codes, _, place) in enumerate(coder.code(text)):
            found: defaultdict[tuple[int, int], list[int]] = defaultdict(list)
            for size in self.sizes[way]:
                hashes = window_hashes(codes, size)
                for at in np.flatnonzero(self.filters[way][hashes >> np.uint64(64 - _FILTER_BITS)]).tolist():
                    for item, pos in self.windows[way].get((size, int(hashes[at])), ()):
                        if np.array_equal(self.items[item][way][1][pos : pos + size], codes[at : at + size]):
                            found[item, at - pos].append(pos)
            accepted: defaultdict[int, dict] = defaultdict(lambda: {"at": set(), "first": None, "changed": 0})
            for (item, shift), places in found.items():
                self._accept(accepted[item], item, shift, places, tokens, way)
            for item, x in accepted.items():
                if not x["at"]:
                    continue
                coverage = len(x["at"]) / max(1, self.items[item][way][4])
                if coverage >= COVERAGE and (item not in best or coverage > best[item]["coverage"]):
                    kind = "reparameterised" if x["changed"] else "template" if way else "verbatim"
                    best[item] = {"item_id": item, "coverage": coverage, "kind": kind, "first_token": int(place[x["first"]]), "changed_slots": x["changed"]}
        return [best[item] for item in sorted(best)]

    def _accept(self, into: dict, item: int, shift: int, places: list[int], tokens: list[str], way: int) -> None:
        """Add an alignment's windows: all if its slots are consistent, else those whose slots are equal."""
        own, _, slot, size, _ = self.items[item][way]
        changed = 0
        if way:
            covered = sorted({p + k for p in places for k in range(size) if slot[p + k]})
            values: defaultdict[str, set[str]] = defaultdict(set)
            for p in covered:
                mine, theirs = own[p], tokens[p + shift]
                # A run that starts with the same word on both sides ("If Alice", "If Carol") is judged by the rest.
                while " " in mine and " " in theirs and mine.split(" ", 1)[0] == theirs.split(" ", 1)[0]:
                    mine, theirs = mine.split(" ", 1)[1], theirs.split(" ", 1)[1]
                values[mine].add(theirs)
            if any(len(v) > 1 for v in values.values()):
                places = [p for p in places if all(own[p + k] == tokens[p + k + shift] for k in range(size) if slot[p + k])]
            else:
                changed = sum(k not in v for k, v in values.items())
        if places:
            into["at"].update(places)
            into["changed"] += changed
            first = min(places) + shift
            into["first"] = first if into["first"] is None else min(first, into["first"])


def blocks(items: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    held: list[tuple[int, str]] = []
    chars = 0
    for item in items:
        if held and (len(held) >= BLOCK_ITEMS or chars + len(item[1]) > BLOCK_CHARS):
            yield held
            held, chars = [], 0
        held.append(item)
        chars += len(item[1])
    if held:
        yield held


def _finder(spark: SparkSession, items: list[tuple[int, str]]):  # noqa: ANN202
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(f"array<struct<{HIT.replace(' ', ':')}>>".replace(",:", ","))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, coder = Index(shared.value), Coder()
        for texts in batches:
            rows: list[list[dict]] = []
            for part in parts(texts.tolist()):
                rows += [index.hits(coder, t) if may else [] for t, may in zip(part, index.may_hold(coder, part).tolist(), strict=True)]
            yield pd.Series(rows, dtype=object)

    return of


def parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about BATCH_CHARS characters together."""
    held: list[str | None] = []
    chars = 0
    for t in texts:
        held.append(t)
        chars += len(t or "")
        if chars >= BATCH_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def finders(benchmark: DataFrame) -> list:
    """One pandas UDF (text to hits) for each block of the benchmark."""
    spark = benchmark.sparkSession
    ship(spark)
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text").distinct().orderBy("item_id", "text")
    return [_finder(spark, block) for block in blocks((row.item_id, row.text) for row in items.toLocalIterator())]


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, kind, first_token, changed_slots): a row for each item that a document holds."""
    parts = [docs.select("doc_id", F.explode(of(F.col("text"))).alias("hit")).select("doc_id", "hit.*") for of in finders(benchmark)]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {HIT}")
    return reduce(DataFrame.union, parts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    for of in finders(table(spark, sf_dir, "benchmark")):
        docs = docs.where(F.size(of(F.col("text"))) == 0)
    return docs
