"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A document states a template if it holds CONTAINMENT of the template's distinct shingles of SHINGLE tokens, in any place
and whatever stands between them. A template is cut into tiles of at most TILE shingles. If a document holds
CONTAINMENT of a template, it holds as much of one tile at least; and as a run of words put into the middle of a tile
destroys SHINGLE - 1 of its shingles, more than a tile may lose, what is left of that tile is one passage, however much
the notice as a whole has grown. So overlapping windows of a tile's size plus a stride are signed, and a window that
holds the tile's rest resembles it by `least_resemblance` at least. With one MinHash value a band, the odds of missing
it are (1 - resemblance) ** bands, which `bands_for` keeps below MISS. What a band retrieves is verified on the exact
sets of shingles of the whole document and the whole template.

A band can only match where the text has the tile's least shingle of that band; windows without such a shingle are
therefore never signed, which changes no result. Templates of fewer than SHINGLE tokens (tags) are one shingle of their
own length and are looked up exactly.

Templates are the query set: they are taken in blocks (as in `decontaminate`), each broadcast, and every text is read
whole. Defined results: null and empty texts have no license; templates without a token are refused; of several
templates of one license the one that is contained most is reported, the longest of these; rows that repeat are
reported as often; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import table
from tallyport.llm.decontaminate import Coder, window_hashes
from tallyport.llm.license_texts import TEMPLATES
from tallyport.session import ship

SHINGLE = 5
CONTAINMENT = 0.8
#: Most shingles of a tile: SHINGLE - 1 of them have to be more than it may lose.
TILE = 16
STRIDE = 2
MISS = 1e-4
BLOCK = 2_000
_FILTER_BITS = 20
HIT = "license string, containment double, first_token long, last_token long"


def tiles(shingles: np.ndarray) -> list[np.ndarray]:
    """A template's shingles in order, cut into parts of nearly equal size, TILE at most."""
    return np.array_split(shingles, -(-len(shingles) // TILE))


def least_resemblance(size: int) -> float:
    """Of a tile of `size` shingles and the window that holds CONTAINMENT of them."""
    shared = math.ceil(CONTAINMENT * size - 1e-9)
    return shared / (2 * size + STRIDE - shared)


def bands_for(size: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - least_resemblance(size)))


_BANDS = np.array([(k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(bands_for(1))], dtype=np.uint64)


def band_values(shingles: np.ndarray, bands: int) -> np.ndarray:
    """A row of hashes for each band."""
    x = shingles[None, :] ^ _BANDS[:bands, None]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Library:
    """Signed templates."""

    def __init__(self, templates: Iterable[tuple[str, str]]) -> None:
        coder = Coder()
        #: License, distinct shingles in ascending order, tokens.
        self.sets: list[tuple[str, np.ndarray, int]] = []
        self.bands: defaultdict[tuple[int, int, int], set[int]] = defaultdict(set)
        self.short: defaultdict[tuple[int, int], set[int]] = defaultdict(set)
        sizes_of: defaultdict[int, set[int]] = defaultdict(set)
        for name, text in templates:
            codes = coder.plain(text)[1]
            if not len(codes):
                raise ValueError(f"template of {name} has no token")
            at = len(self.sets)
            shingles = window_hashes(codes, min(SHINGLE, len(codes)))
            self.sets.append((name, np.unique(shingles), len(codes)))
            if len(codes) < SHINGLE:
                self.short[len(codes), int(shingles[0])].add(at)
                continue
            for tile in tiles(shingles):
                own = np.unique(tile)
                values = band_values(own, bands_for(len(tile)))
                for band, (value, least) in enumerate(zip(values.min(axis=1).tolist(), own[values.argmin(axis=1)].tolist(), strict=True)):
                    self.bands[len(tile), band, value].add(at)
                    sizes_of[least].add(len(tile))
        self.sizes_of = dict(sizes_of)
        self.least = np.array(sorted(sizes_of), dtype=np.uint64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.least >> np.uint64(64 - _FILTER_BITS)] = True
        self.short_sizes = sorted({n for n, _ in self.short})

    def retrieved(self, shingles: np.ndarray) -> set[int]:
        """Templates of which a tile shares a band's value with a window of the text."""
        places = np.flatnonzero(self.filter[shingles >> np.uint64(64 - _FILTER_BITS)])
        places = places[np.isin(shingles[places], self.least)]
        starts: defaultdict[int, set[int]] = defaultdict(set)
        for p, h in zip(places.tolist(), shingles[places].tolist(), strict=True):
            for size in self.sizes_of[h]:
                width = size + STRIDE
                starts[size].update(s * STRIDE for s in range(max(0, -(-(p - width + 1) // STRIDE)), p // STRIDE + 1))
        found: set[int] = set()
        for size, at in starts.items():
            for start in at:
                values = band_values(shingles[start : start + size + STRIDE], bands_for(size)).min(axis=1).tolist()
                for band, value in enumerate(values):
                    found |= self.bands.get((size, band, value), set())
        return found

    def hits(self, coder: Coder, text: str | None) -> list[dict]:
        codes = coder.plain(text)[1]
        shingles = window_hashes(codes, SHINGLE)
        best: dict[str, dict] = {}

        def keep(at: int, share: float, places: np.ndarray, width: int) -> None:
            name, _, tokens = self.sets[at]
            if name not in best or (share, tokens) > best[name]["rank"]:
                first, last = _passage(places, max(64, 2 * tokens))
                best[name] = {"rank": (share, tokens), "license": name, "containment": share, "first_token": first, "last_token": last + width - 1}

        for at in sorted(self.retrieved(shingles)):
            own = self.sets[at][1]
            places = np.flatnonzero(np.isin(shingles, own))
            share = len(np.unique(shingles[places])) / len(own)
            if share >= CONTAINMENT:
                keep(at, share, places, SHINGLE)
        for size in self.short_sizes:
            hashes = window_hashes(codes, size)
            for h in np.unique(hashes).tolist():
                for at in sorted(self.short.get((size, h), ())):
                    keep(at, 1.0, np.flatnonzero(hashes == np.uint64(h)), size)
        return [{k: v for k, v in best[name].items() if k != "rank"} for name in sorted(best)]


def _passage(places: np.ndarray, gap: int) -> tuple[int, int]:
    """First and last of the largest group of places that no gap divides; of equal groups the first."""
    groups = np.split(places, np.flatnonzero(np.diff(places) > gap) + 1)
    most = max(groups, key=len)
    return int(most[0]), int(most[-1])


def _scanner(spark: SparkSession, templates: list[tuple[str, str]]):  # noqa: ANN202
    shared = spark.sparkContext.broadcast(templates)

    @F.pandas_udf("array<struct<license:string,containment:double,first_token:long,last_token:long>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        library, coder = Library(shared.value), Coder()
        for texts in batches:
            yield pd.Series([library.hits(coder, t) for t in texts], dtype=object)

    return of


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, first_token, last_token): a row for each license that a document states. With
    several blocks of templates a license whose templates fall into two of them has a row of each."""
    spark = docs.sparkSession
    ship(spark)
    every = list(templates)
    parts = []
    for at in range(0, len(every), BLOCK):
        of = _scanner(spark, every[at : at + BLOCK])
        parts.append(docs.select("doc_id", F.explode(of(F.col("text"))).alias("hit")).select("doc_id", "hit.*"))
    if not parts:
        return spark.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {HIT}")
    return reduce(DataFrame.union, parts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
