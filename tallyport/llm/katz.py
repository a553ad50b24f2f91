"""Katz backoff language model over words, order 3: Good-Turing discounted counts, exactly normalised backoff weights.

P(w | u v) = d(c) c(u v w) / c(u v) if the trigram was seen, else alpha(u v) P(w | v); P(w | v) alike from bigrams and
alpha(v) P(w); P(w) = d(c) c(w) / N, where what discounting frees goes to one class of unknown words. A history's weight
is what its seen words leave free, over what the lower order gives to words not seen after it. A history that was never
seen leaves the lower order as it is. Where counts give no valid Good-Turing discount none is made, and a history left
without free mass gives up 1 / (c + 1). A text begins with two start marks and ends with an end token.

All n-grams of a history word v are in one bucket, so the recursion from trigrams down to bigrams needs no other; only
counts of single words come from elsewhere. They travel as packed arrays, not as rows:

1. pack: each task turns its documents into (v, u, w, documents) arrays, one payload for each bucket of a block, sorted by part
   of the bucket, then v, u, w.
2. count: a bucket merges its payloads into counts, part by part. It asks the owners of the words that follow for their counts.
3. answer: an owner answers. Statistics (counts of counts and what follows) are summed in a tree.
4. score: a bucket knows every probability and weight, and sums the log-probabilities of its tokens by document; the
   documents' sums over buckets follow. It also puts out its part of the model's tables.

Frequent history words (`heavy`) are spread over the buckets by the word before them, their bigrams counted by the owners
of the words that follow; frequent pairs (`hot`) are spread by the word that follows, and their weight, which needs a sum
over buckets, is added when the documents are finished. Both lists come from a sample and change no result; so does the
list of common words, which are sent as short codes. What is left in one bucket is a single frequent trigram, packed to
about two bytes an occurrence, and read payload by payload. A block sends a payload to each bucket that it has tokens
of, so there are never more payloads than tokens; with many thousands of buckets payloads get small.

The tables (`tables`) hold counts and weights by bucket; `evaluate` scores any documents from them by joins.

Words are told apart by 64 bits of their XXH64. Defined results: null and empty texts have only the end token; rows that
repeat are counted and scored as often; an empty table gives no rows; without training rows all counts are 0, P is that of
the unknown class, 1, and the base score that of the formula.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import cut, discard, fresh_path, table
from tallyport.session import ship

#: Counts up to this are discounted.
KATZ_K = 5
#: Bytes of text for each bucket; tokens after which a task's block is packed.
BUCKET_BYTES = 20_000_000
BLOCK_TOKENS = 700_000
CACHE_WORDS = 300_000
#: Parts of a bucket, by history word, that are merged one after the other: only its packed bytes are held together.
PARTS = 4
#: About as many documents tell which words and pairs are frequent; at most so many words get codes, words and pairs are spread.
SAMPLE = 8000
COMMON = 300_000
HEAVY = 2000
#: A word or pair is spread if it has this part of a bucket's tokens.
SPREAD = 1 / 16
#: Words that are held before their distinct ones are looked for.
HELD_WORDS = 4_000_000
#: Parts in which statistics are summed before they meet.
TREE = 32
#: Sums by document travel as whole numbers of this part.
GRAIN = 1e-9
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words never contain white space, so these are no word's hash but by chance.
START, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\n start", b"\n end"))
PACKED = "bucket long, kind string, block long, payload binary"
SENT = "bucket long, kind string, source long, payload binary"
STORED = "block long, payload binary, kind string"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def freeze(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, whole numbers in as few bytes as hold their maximum."""
    parts = []
    for a in arrays:
        width = a.dtype.itemsize if a.dtype.kind == "f" else next(n for n in (1, 2, 3, 4, 5, 6, 8) if not len(a) or int(a.max()) < 1 << 8 * n)
        raw = a.view(np.uint8).reshape(len(a), width) if a.dtype.kind == "f" else a.astype("<u8").view(np.uint8).reshape(len(a), 8)[:, :width]
        # Bytes of one place together: the high ones compress.
        data = np.ascontiguousarray(raw.T).tobytes()
        parts.append(struct.pack("<cBQ", a.dtype.kind.encode(), width, len(a)) + data)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


class Frozen:
    """An array of a frozen payload; slices of it are plain arrays."""

    def __init__(self, kind: bytes, planes: np.ndarray) -> None:
        self.kind, self.planes = kind, planes

    def __getitem__(self, part: slice) -> np.ndarray:
        planes = self.planes[:, part]
        width, n = planes.shape
        if self.kind == b"f":
            return np.ascontiguousarray(planes.T).view(f"<f{width}").ravel()
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = planes.T
        return wide.view("<u8").ravel()


def opened(payload: bytes) -> list[Frozen]:
    data, at, out = zstandard.ZstdDecompressor().decompress(payload), 0, []
    while at < len(data):
        kind, width, n = struct.unpack_from("<cBQ", data, at)
        at += struct.calcsize("<cBQ")
        out.append(Frozen(kind, np.frombuffer(data, np.uint8, width * n, at).reshape(width, n)))
        at += width * n
    return out


def thaw(payload: bytes) -> list[np.ndarray]:
    return [a[:] for a in opened(payload)]


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Places where a run of equal keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _order(key: np.ndarray) -> np.ndarray:
    """Places of a key's values in order, equal ones as they stand. Small values are sorted with their places in one number."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 64:
        return np.argsort(key, kind="stable")
    both = (key << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << bits) - 1)).view(np.int64)


def _runs(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def find(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places in a sorted array; -1 where it has no such value."""
    if not len(known):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for a pair of words."""
    x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


#: Of words, or what stands for them, to (codes, rare words in order).
Coder = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Plan:
    """What all tasks share: hashes of common words, the most frequent first, so that most codes are small, and sorted ones
    of heavy words and hot pairs (mixed)."""

    buckets: int
    common: np.ndarray
    heavy: np.ndarray
    hot: np.ndarray

    @cached_property
    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The common words in order, and the place of each among the common ones."""
        order = np.argsort(self.common)
        return self.common[order], order

    def placed(self, v: np.ndarray, u: np.ndarray, w: np.ndarray, heavy: np.ndarray) -> np.ndarray:
        """Bucket of each trigram: its history word's; for heavy ones by the word before, for hot pairs by the word after."""
        pair = mixed(v, u)
        spread = np.where(find(self.hot, pair) >= 0, mixed(pair, w), pair) >> np.uint64(7)
        return np.where(heavy, spread, v) % np.uint64(self.buckets)

    def coded(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, rare words in order): code 0 stands for the next rare word."""
        known, place = self.places
        at = find(known, words)
        codes = np.zeros(len(words), np.uint64)
        codes[at >= 0] = place[at[at >= 0]] + 1
        return codes, words[at < 0]

    def words(self, codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
        at = codes.view(np.int64) - 1
        out = self.common[at] if len(self.common) else np.empty(len(at), np.uint64)
        out[at < 0] = rare
        return out

    def freeze_ngrams(self, v: np.ndarray, u: np.ndarray, w: np.ndarray, *more: np.ndarray, code: Coder | None = None) -> bytes:
        """Trigrams in order of (v, u, w), with further arrays. They may be anything of which `code` tells the coded words."""
        code = code or self.coded
        pairs = _starts(v, u)
        heads = _starts(v[pairs])
        coded = [x for words in (v[pairs][heads], u[pairs], w) for x in code(words)]
        return freeze(*coded, _runs(heads, len(pairs)).astype(np.uint64), _runs(pairs, len(v)).astype(np.uint64), *more)

    def thaw_last(self, payload: bytes) -> np.ndarray:
        """The last words of frozen trigrams."""
        return self.words(*(a[:] for a in opened(payload)[4:6]))

    def thaw_part(self, payload: bytes, part: int, words: bool = True) -> tuple[np.ndarray | None, ...]:
        """(v, u, w, times, documents, block's documents) of the trigrams of a part, which are together in a payload of `packer`."""
        vc, vr, uc, ur, wc, wr, of_v, of_pair, times, docs, size = opened(payload)
        heads = self.words(vc[:], vr[:])
        first, last = np.searchsorted(part_of(heads), np.array([part, part + 1], np.uint64))
        pairs, grams = (np.concatenate(([0], np.cumsum(x[:].astype(np.int64)))) for x in (of_v, of_pair))
        of = slice(int(pairs[first]), int(pairs[last]))
        gram = slice(int(grams[of.start]), int(grams[of.stop]))
        before, here = int(times[: gram.start].sum()), times[gram]
        found = here, docs[before : before + int(here.sum())], size[:]
        if not words:
            return None, None, None, *found

        def cut_out(codes: Frozen, rare: Frozen, at: slice) -> np.ndarray:
            skipped, mine = int((codes[: at.start] == 0).sum()), codes[at]
            return self.words(mine, rare[skipped : skipped + int((mine == 0).sum())])

        runs = np.diff(grams[of.start : of.stop + 1])
        v = np.repeat(np.repeat(heads[first:last], np.diff(pairs[first : last + 1])), runs)
        return v, np.repeat(cut_out(uc, ur, of), runs), cut_out(wc, wr, gram), *found

    def thaw_ngrams(self, payload: bytes) -> tuple[np.ndarray, ...]:
        vc, vr, uc, ur, wc, wr, of_v, of_pair, *more = thaw(payload)
        of_v, of_pair = of_v.astype(np.int64), of_pair.astype(np.int64)
        v = np.repeat(np.repeat(self.words(vc, vr), of_v), of_pair)
        return v, np.repeat(self.words(uc, ur), of_pair), self.words(wc, wr), *more


class Shared:
    """The plan on the workers, sent once to each."""

    def __init__(self, spark: SparkSession, plan: Plan) -> None:
        self.sent = spark.sparkContext.broadcast((plan.buckets, plan.common, plan.heavy, plan.hot))

    def plan(self) -> Plan:
        return Plan(*self.sent.value)


class Hashes(dict[bytes, int]):
    """Hashes of words, each worked out when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def word_hashes(text: bytes | None, cache: Hashes) -> np.ndarray:
    words = (text or b"").translate(_LOWER).split()
    if len(cache) > CACHE_WORDS:
        cache.clear()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def packer(shared: Shared):  # noqa: ANN201
    """mapInPandas function: (key, known, held, text) to PACKED rows: data of each bucket and one meta row a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, cache = shared.plan(), Hashes()
        hashes: list[np.ndarray] = []
        keys: list[int] = []
        flags: list[int] = []
        held, number = 0, TaskContext.get().partitionId() << 24

        def rows() -> pd.DataFrame:
            sizes = np.array([len(h) for h in hashes], np.int64)
            known, at = np.unique(np.concatenate([x for h in hashes for x in ([START, START], h, [END])]).astype(np.uint64), return_inverse=True)
            at = at.astype(np.uint32)
            # Every token but the two marks that begin a text, with the two before it.
            first = np.cumsum(np.concatenate(([0], sizes[:-1] + 3)))
            token = np.ones(len(at), bool)
            token[first] = token[first + 1] = False
            here = np.flatnonzero(token)
            w, v, u = at[here], at[here - 1], at[here - 2]
            doc = np.repeat(np.arange(len(hashes), dtype=np.uint64) * np.uint64(2) + (np.array(flags, np.uint64) & np.uint64(1)), sizes + 1)
            heavy, part = find(plan.heavy, known) >= 0, part_of(known)
            spot = plan.placed(known[v], known[u], known[w], heavy[v]) * np.uint64(PARTS) + part[v]
            # Places among the known words are in the order of the words; equal ones stay in the order of documents.
            width = np.uint64(len(known).bit_length())
            order = _order((u.astype(np.uint64) << width) | w)
            order = order[_order(((spot << width) | v)[order])]
            v, u, w, doc, spot = v[order], u[order], w[order], doc[order], spot[order]
            del order, at, here, token
            grams = _starts(spot, v, u, w)
            # Each word of the block is coded once.
            codes, _ = plan.coded(known)
            code = lambda at: ((found := codes[at]), known[at[found == 0]])
            edges = np.searchsorted(spot[grams], np.arange(plan.buckets + 1, dtype=np.uint64) * np.uint64(PARTS))
            times = _runs(grams, len(v)).astype(np.uint64)
            meta = freeze(np.array(keys, np.int64).view(np.uint64), np.array(flags, np.uint64), sizes.astype(np.uint64))
            out = [(number % plan.buckets, "m", number, meta)]
            for b in range(plan.buckets):
                i, j = int(edges[b]), int(edges[b + 1])
                if i < j:
                    g = grams[i:j]
                    end = int(grams[j]) if j < len(grams) else len(v)
                    out.append((b, "d", number, plan.freeze_ngrams(v[g], u[g], w[g], times[i:j], doc[g[0] : end], np.array([len(hashes)], np.uint64), code=code)))
            return pd.DataFrame(out, columns=["bucket", "kind", "block", "payload"])

        for batch in batches:
            for key, known, is_held, text in zip(batch["key"].tolist(), batch["known"].tolist(), batch["held"].tolist(), batch["text"], strict=True):
                hashes.append(word_hashes(text, cache))
                keys.append(key)
                flags.append(int(is_held) + 2 * int(known))
                held += len(hashes[-1]) + 1
                if held >= BLOCK_TOKENS:
                    yield rows()
                    hashes, keys, flags, held, number = [], [], [], 0, number + 1
        if hashes:
            yield rows()

    return run


class Bucket:
    """The merged trigrams (v, u, w) of a part of a bucket in order, with training counts c3; their pairs (v, u); the bigrams (v, w)
    with the counts that this bucket has; and the history words v."""

    def __init__(self, plan: Plan, payloads: list[bytes], part: int, places: bool = False) -> None:
        vs, us, ws, cs = [], [], [], []
        for payload in payloads:
            v, u, w, times, docs, _ = plan.thaw_part(payload, part)
            ends = np.cumsum(times).astype(np.int64)
            trained = np.concatenate(([0], np.cumsum((docs & np.uint64(1)) == 0)))
            vs.append(v)
            us.append(u)
            ws.append(w)
            cs.append(trained[ends] - trained[ends - times.astype(np.int64)])
        sizes = [len(x) for x in vs]
        v, u, w, c = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (vs, us, ws, cs))
        del vs, us, ws, cs
        order = np.lexsort((w, u, v))
        v, u, w = v[order], u[order], w[order]
        first = _starts(v, u, w)
        if places:
            #: Place among the merged trigrams of each payload's trigrams.
            place = np.empty(len(v), np.int32)
            new = np.zeros(len(v), np.int32)
            new[first] = 1
            place[order] = np.cumsum(new) - 1
            self.places = np.split(place, np.cumsum(sizes)[:-1]) if sizes else []
        self.v, self.u, self.w = v[first], u[first], w[first]
        self.c3 = np.add.reduceat(c[order], first) if len(first) else np.zeros(0, np.int64)
        del v, u, w, c, order
        pairs = _starts(self.v, self.u)
        #: Pair of each trigram.
        self.pair_of = np.repeat(np.arange(len(pairs)), _runs(pairs, len(self.v)))
        self.pair_v, self.pair_u = self.v[pairs], self.u[pairs]
        self.pair_count = np.add.reduceat(self.c3, pairs) if len(pairs) else np.zeros(0, np.int64)
        self.hot_of = find(plan.hot, mixed(self.pair_v, self.pair_u))
        heads = _starts(self.pair_v)
        self.words = self.pair_v[heads]
        self.word_count = np.add.reduceat(self.pair_count, heads) if len(heads) else np.zeros(0, np.int64)
        self.heavy_of = find(plan.heavy, self.words)
        order = np.lexsort((self.w, self.v))
        v, w = self.v[order], self.w[order]
        first = _starts(v, w)
        self.big_v, self.big_w = v[first], w[first]
        del v, w
        self.c2 = np.add.reduceat(self.c3[order], first) if len(first) else np.zeros(0, np.int64)
        #: Bigram of each trigram, history word of each bigram.
        self.big_of = np.empty(len(self.v), np.int64)
        self.big_of[order] = np.repeat(np.arange(len(first)), _runs(first, len(self.v)))
        self.word_of = np.searchsorted(self.words, self.big_v)
        #: Bigrams whose counts the owners of their second words sum.
        self.asked = np.flatnonzero(self.heavy_of[self.word_of] >= 0) if len(self.words) else np.zeros(0, np.int64)


def distinct(arrays: Iterable[np.ndarray]) -> np.ndarray:
    """The distinct values of all arrays, in order. What is held is sorted when it has doubled, so that many arrays cost
    little more than one sort."""
    held: list[np.ndarray] = []
    size = least = 0
    for a in chain(arrays, [None]):
        if a is not None:
            held.append(a)
            size += len(a)
        if (a is None or size > max(HELD_WORDS, 2 * least)) and held:
            x = np.sort(np.concatenate(held))
            held = [x[_starts(x)]]
            size = least = len(held[0])
    return held[0] if held else np.zeros(0, np.uint64)


def wanted_words(plan: Plan, words: Iterable[np.ndarray]) -> np.ndarray:
    """The words that follow in a bucket, in order, but for those whose counts come with the statistics."""
    found = distinct(words)
    return found[find(plan.heavy, found) < 0]


def by_owner(words: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its words, in order) of each bucket that owns one of the words."""
    to = (words % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    first = _starts(to[order])
    for i, n in zip(first.tolist(), _runs(first, len(order)).tolist(), strict=True):
        yield int(to[order[i]]), order[i : i + n]


def part_of(v: np.ndarray) -> np.ndarray:
    return (v >> np.uint64(40)) % np.uint64(PARTS)


def _histogram(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c[c > 0], KATZ_K + 2), minlength=KATZ_K + 3)[1 : KATZ_K + 2]


class Totals:
    """Statistics as one array of sums and the heavy pairs that were seen."""

    def __init__(self, plan: Plan) -> None:
        h, p, k = len(plan.heavy), len(plan.hot), KATZ_K
        sizes = {"words": 2, "tri": k + 1, "bi": k + 1, "uni": k + 1, "heavy": h, "few2": h * k, "light": h * k, "more": h, "hot": p, "few3": p * k}
        self.sums = np.zeros(sum(sizes.values()), np.int64)
        self.seen = np.zeros(0, np.uint64)
        ends = np.cumsum(list(sizes.values()))
        self.part = {name: self.sums[end - n : end] for (name, n), end in zip(sizes.items(), ends.tolist(), strict=True)}

    def add(self, payload: bytes) -> Totals:
        sums, seen = thaw(payload)
        self.sums += sums.astype(np.int64)
        self.seen = np.union1d(self.seen, seen)
        return self

    def frozen(self) -> bytes:
        return freeze(self.sums.astype(np.uint64), self.seen)


def counter(shared: Shared):  # noqa: ANN201
    """A bucket's PACKED rows to SENT rows: its words' counts, what it asks of the others, and its statistics."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        plan, own = shared.plan(), int(rows["bucket"].iloc[0])
        payloads = rows[rows["kind"] == "d"].sort_values("block")["payload"].tolist()
        totals, out = Totals(plan), []
        t = totals.part
        followers: list[np.ndarray] = []
        for part in range(PARTS):
            b = Bucket(plan, payloads, part)
            followers.append(distinct([b.w]))
            # Who asks is a part of a bucket.
            me = own * PARTS + part
            light = (b.heavy_of < 0) & (b.word_count > 0)
            out.append((own, "u", me, freeze(b.words[light], b.word_count[light].astype(np.uint64))))
            heavy, w, c = b.heavy_of[b.word_of[b.asked]].astype(np.uint64), b.big_w[b.asked], b.c2[b.asked].astype(np.uint64)
            for target, at in by_owner(w, plan.buckets):
                out.append((target, "b", me, freeze(heavy[at], c[at], *plan.coded(w[at]))))
            t["words"] += np.array([b.word_count[light].sum(), light.sum()])
            t["tri"] += _histogram(b.c3)
            t["uni"] += _histogram(b.word_count[light])
            t["bi"] += _histogram(b.c2[b.heavy_of[b.word_of] < 0]) if len(b.c2) else 0
            np.add.at(t["heavy"], b.heavy_of[b.heavy_of >= 0], b.word_count[b.heavy_of >= 0])
            np.add.at(t["hot"], b.hot_of[b.hot_of >= 0], b.pair_count[b.hot_of >= 0])
            hot = b.hot_of[b.pair_of] if len(b.c3) else b.c3
            few = (hot >= 0) & (b.c3 > 0) & (b.c3 <= KATZ_K)
            np.add.at(t["few3"], hot[few] * KATZ_K + b.c3[few] - 1, 1)
            del b
        wanted = wanted_words(plan, followers)
        for target, at in by_owner(wanted, plan.buckets):
            out.append((target, "r", own * PARTS, freeze(*plan.coded(wanted[at]))))
        out.append((own, "s", own, totals.frozen()))
        return pd.DataFrame(out, columns=["bucket", "kind", "source", "payload"])

    return run


def answerer(shared: Shared):  # noqa: ANN201
    """SENT rows of a bucket to its answers and its part of the statistics."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        plan, own = shared.plan(), int(rows["bucket"].iloc[0])
        of = {kind: group for kind, group in rows.groupby("kind")}
        lists = [thaw(payload) for payload in of["u"]["payload"]] if "u" in of else []
        known, counts = (np.concatenate([x[i] for x in lists]) if lists else np.zeros(0, np.uint64) for i in range(2))
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        # An answer goes to the bucket that asked, marked with its part.
        to = lambda source: (int(source) // PARTS, own * PARTS + int(source) % PARTS)

        def count_of(words: np.ndarray) -> np.ndarray:
            at = find(known, words)
            return np.where(at >= 0, counts[at], 0).astype(np.uint64) if len(known) else np.zeros(len(words), np.uint64)

        out = []
        for source, payload in of["r"][["source", "payload"]].itertuples(index=False) if "r" in of else ():
            bucket, mark = to(source)
            out.append((bucket, "a", mark, freeze(count_of(plan.words(*thaw(payload))))))
        totals = Totals(plan)
        for payload in of["s"]["payload"] if "s" in of else ():
            totals.add(payload)
        if "b" in of:
            parts = []
            for source, payload in of["b"][["source", "payload"]].itertuples(index=False):
                h, c, *coded = thaw(payload)
                parts.append((int(source), (h, plan.words(*coded), c)))
            h, w, c = (np.concatenate([p[i] for _, p in parts]) for i in range(3))
            order = np.lexsort((w, h))
            first = _starts(h[order], w[order])
            total = np.add.reduceat(c[order].astype(np.int64), first)
            place = np.empty(len(h), np.int64)
            place[order] = np.repeat(np.arange(len(first)), _runs(first, len(h)))
            for (source, p), at in zip(parts, np.split(place, np.cumsum([len(p[0]) for _, p in parts])[:-1]), strict=True):
                bucket, mark = to(source)
                out.append((bucket, "q", mark, freeze(total[at].astype(np.uint64))))
            seen = total > 0
            h, w, total = h[order][first][seen].astype(np.int64), w[order][first][seen], total[seen]
            t = totals.part
            t["bi"] += _histogram(total)
            few = total <= KATZ_K
            np.add.at(t["few2"], h[few] * KATZ_K + total[few] - 1, 1)
            heavy, n = find(plan.heavy, w), count_of(w).astype(np.int64)
            few = (heavy < 0) & (n <= KATZ_K) & (n > 0)
            np.add.at(t["light"], h[few] * KATZ_K + n[few] - 1, 1)
            more = (heavy < 0) & (n > KATZ_K)
            np.add.at(t["more"], h[more], n[more])
            totals.seen = np.unique((h[heavy >= 0] * len(plan.heavy) + heavy[heavy >= 0]).astype(np.uint64))
        out.append((-1, "s", own, totals.frozen()))
        return pd.DataFrame(out, columns=["bucket", "kind", "source", "payload"])

    return run


def summer(shared: Shared):  # noqa: ANN201
    """Rows of statistics to one row."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        totals = Totals(shared.plan())
        for payload in rows["payload"]:
            totals.add(payload)
        return pd.DataFrame([(totals.frozen(),)], columns=["payload"])

    return run


def discounts(n: np.ndarray) -> np.ndarray:
    """Factor of counts 0..KATZ_K + 1 from counts of counts 1..KATZ_K + 1; the last stands for all larger counts."""
    d, n = np.ones(KATZ_K + 2), np.concatenate(([0.0], n.astype(np.float64)))
    if n[1] <= 0 or n[KATZ_K + 1] <= 0:
        return d
    least = (KATZ_K + 1) * n[KATZ_K + 1] / n[1]
    for r in range(1, KATZ_K + 1):
        if n[r] > 0 and n[r + 1] > 0 and least < 1:
            value = ((r + 1) * n[r + 1] / (r * n[r]) - least) / (1 - least)
            if 0 < value < 1:
                d[r] = value
    return d


def kept_share(mass: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What a history without free mass keeps of its own."""
    return np.where(1 - mass < 1e-9, count / (count + 1.0), 1.0)


def free(mass: np.ndarray, count: np.ndarray, followers: np.ndarray) -> np.ndarray:
    """Backoff weight of histories that were seen."""
    return (1 - mass * kept_share(mass, count)) / np.maximum(1 - followers, 1e-300)


class Model:
    """What all buckets share: discounts, P of a word by its count, and the weights of heavy words."""

    def __init__(self, plan: Plan, payload: bytes) -> None:
        totals = Totals(plan).add(payload)
        t, heavy, k = totals.part, plan.heavy, KATZ_K
        start, end = find(heavy, np.array([START, END]))
        self.docs = int(t["heavy"][start])
        #: Training counts of heavy words as tokens; the start is none, and the end is one a document.
        self.heavy_tokens = t["heavy"].copy()
        self.heavy_tokens[start], self.heavy_tokens[end] = 0, self.docs
        words, distinct = t["words"].tolist()
        self.n, self.v = words + int(self.heavy_tokens.sum()), distinct + int((self.heavy_tokens > 0).sum())
        per_count = t["uni"] + _histogram(self.heavy_tokens)
        self.d1, self.d2, self.d3 = discounts(per_count), discounts(t["bi"]), discounts(t["tri"])
        r = np.arange(1, k + 1)
        freed = float((per_count[:k] * r * (1 - self.d1[1 : k + 1])).sum()) / self.n if self.n else 1.0
        self.unknown = max(freed, 0.5 / (self.n + 0.5 * (self.v + 1))) if self.n else 1.0
        self.scale = (1 - self.unknown) / (1 - freed) if freed < 1 else 0.0
        given = lambda few, d: few.reshape(-1, k) @ (r * (1 - d[1 : k + 1]))
        #: Of heavy history words and of hot pairs: count, and mass of the words seen after them.
        self.heavy_count, self.hot_count = t["heavy"].copy(), t["hot"].copy()
        self.heavy_mass = np.where(self.heavy_count > 0, 1 - given(t["few2"], self.d2) / np.maximum(1, self.heavy_count), 0.0)
        self.hot_mass = np.where(self.hot_count > 0, 1 - given(t["few3"], self.d3) / np.maximum(1, self.hot_count), 0.0)
        followers = (t["light"].reshape(-1, k) @ (r * self.d1[1 : k + 1]) + t["more"]) * self.scale / max(1, self.n)
        at = totals.seen.astype(np.int64)
        np.add.at(followers, at // max(1, len(heavy)), self.p(self.heavy_tokens[at % max(1, len(heavy))]))
        self.heavy_weight = np.where(self.heavy_count > 0, free(self.heavy_mass, self.heavy_count, followers), 1.0)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d1[np.minimum(c, KATZ_K + 1)] * c / max(1, self.n) * self.scale, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


@dataclass
class Scored:
    """log10 P of each trigram of a bucket, where unseen words of a hot pair still lack its weight (`waits`), the count of
    each bigram's second word, and the backoff weights."""

    logs: np.ndarray
    waits: np.ndarray
    word_counts: np.ndarray
    word_weights: np.ndarray
    pair_weights: np.ndarray
    hot_followers: np.ndarray


def scored(b: Bucket, plan: Plan, m: Model, wanted: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> Scored:
    """From the answers: counts of the `wanted` words, and summed counts of the `b.asked` bigrams."""
    heavy_w = find(plan.heavy, b.big_w)
    cw = m.heavy_tokens[np.maximum(heavy_w, 0)]
    light = heavy_w < 0
    cw[light] = counts[find(wanted, b.big_w[light])] if light.any() else 0
    p1 = m.p(cw)
    # Bigrams.
    c2, is_heavy = b.c2.copy(), b.heavy_of >= 0
    c2[b.asked] = asked
    total = np.where(is_heavy, m.heavy_count[np.maximum(b.heavy_of, 0)], b.word_count)
    n, seen = len(b.words), c2 > 0
    raw = np.where(seen, m.d2[np.minimum(c2, KATZ_K + 1)] * c2 / np.maximum(1, total[b.word_of]), 0.0)
    mass = np.where(is_heavy, m.heavy_mass[np.maximum(b.heavy_of, 0)], np.bincount(b.word_of, raw, n))
    followers = np.bincount(b.word_of, np.where(seen, p1, 0.0), n)
    weight = np.where(total > 0, np.where(is_heavy, m.heavy_weight[np.maximum(b.heavy_of, 0)], free(mass, total, followers)), 1.0)
    p2 = np.where(seen, raw * kept_share(mass, total)[b.word_of], weight[b.word_of] * p1)
    # Trigrams.
    is_hot = b.hot_of >= 0
    total = np.where(is_hot, m.hot_count[np.maximum(b.hot_of, 0)], b.pair_count) if len(m.hot_count) else b.pair_count
    n, seen = len(b.pair_v), b.c3 > 0
    raw = np.where(seen, m.d3[np.minimum(b.c3, KATZ_K + 1)] * b.c3 / np.maximum(1, total[b.pair_of]), 0.0)
    mass = np.bincount(b.pair_of, raw, n)
    if len(m.hot_mass):
        mass = np.where(is_hot, m.hot_mass[np.maximum(b.hot_of, 0)], mass)
    followers = np.bincount(b.pair_of, np.where(seen, p2[b.big_of], 0.0), n)
    pair_weight = np.where((total > 0) & ~is_hot, free(mass, total, followers), 1.0)
    hot = np.zeros(len(plan.hot))
    np.add.at(hot, b.hot_of[is_hot], followers[is_hot])
    with np.errstate(divide="ignore"):
        logs = np.log10(np.where(seen, raw * kept_share(mass, total)[b.pair_of], pair_weight[b.pair_of] * p2[b.big_of]))
    return Scored(logs, ~seen & (is_hot & (total > 0))[b.pair_of], cw, weight, pair_weight, hot)


def scorer(shared: Shared):  # noqa: ANN201
    """A bucket's PACKED rows and the answers it got to STORED rows: sums by document, one row a block, and its tables."""

    def run(rows: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        plan = shared.plan()
        out = [(block, payload, "m") for kind, block, payload in rows[["kind", "block", "payload"]].itertuples(index=False) if kind == "m"]
        data = rows[rows["kind"] == "d"].sort_values("block")
        root = sent[sent["kind"] == "t"]["payload"].iloc[0]
        m = Model(plan, root)
        if int(sent["bucket"].iloc[0]) == 0:
            out.append((0, root, "s"))
        if len(data):
            own = int(rows["bucket"].iloc[0])
            payloads, blocks = data["payload"].tolist(), data["block"].tolist()
            sums: list[list[np.ndarray] | None] = [None] * len(blocks)
            late: list[list[np.ndarray]] = [[] for _ in blocks]
            hot = np.zeros(len(plan.hot))
            wanted = wanted_words(plan, map(plan.thaw_last, payloads))
            counts = _answers(sent, "a", 0, wanted, plan)
            for part in range(PARTS):
                b = Bucket(plan, payloads, part, places=True)
                s = scored(b, plan, m, wanted, counts, _answers(sent, "q", part, b.big_w[b.asked], plan))
                hot += s.hot_followers
                cw = s.word_counts[b.big_of]
                base, known = m.base(cw), cw > 0
                for i, (payload, place) in enumerate(zip(payloads, b.places, strict=True)):
                    *_, times, docs, size = plan.thaw_part(payload, part, words=False)
                    gram, doc = np.repeat(place, times.astype(np.int64)), (docs >> np.uint64(1)).astype(np.int64)
                    new = [np.bincount(doc, x[gram], int(size[0])) for x in (s.logs, base, known)]
                    sums[i] = new if sums[i] is None else [x + y for x, y in zip(sums[i], new, strict=True)]
                    wait = s.waits[gram]
                    late[i].append(doc[wait] * max(1, len(plan.hot)) + b.hot_of[b.pair_of[gram[wait]]])
                taught = b.c3 > 0
                # A pair seen once has the weight that its one word's P leaves; only others' weights are kept.
                pairs, words = (b.pair_count > 1) & (b.hot_of < 0), b.word_count > 0
                out.append((own, plan.freeze_ngrams(b.v[taught], b.u[taught], b.w[taught], b.c3[taught].astype(np.uint64), s.pair_weights[pairs].astype(np.float32)), "t3"))
                out.append((own, freeze(b.words[words], np.where(b.heavy_of[words] < 0, b.word_count[words], 0).astype(np.uint64), s.word_weights[words].astype(np.float32)), "t1"))
                del b, s, cw, base, known
            for block, total, waiting in zip(blocks, sums, late, strict=True):
                later, often = np.unique(np.concatenate(waiting), return_counts=True)
                whole = [np.rint(-x / GRAIN).astype(np.uint64) for x in total[:2]]
                out.append((block, freeze(*whole, total[2].astype(np.uint64), later.astype(np.uint64), often.astype(np.uint64)), "p"))
            out.append((own, freeze(hot), "f"))
        return pd.DataFrame([(block, payload, kind) for block, payload, kind in out], columns=["block", "payload", "kind"])

    return run


def _answers(sent: pd.DataFrame, kind: str, part: int, words: np.ndarray, plan: Plan) -> np.ndarray:
    """What the owners of `words` answered to a part of a bucket, in their order."""
    out, of = np.zeros(len(words), np.int64), dict(by_owner(words, plan.buckets))
    got = sent[(sent["kind"] == kind) & (sent["source"] % PARTS == part)]
    for source, payload in got[["source", "payload"]].itertuples(index=False):
        out[of[source // PARTS]] = thaw(payload)[0]
    return out


def _follower_sum(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"payload": [freeze(np.sum([thaw(p)[0] for p in rows["payload"]], axis=0))]})


def hot_weights(m: Model, followers: np.ndarray) -> np.ndarray:
    """Backoff weights of the hot pairs from the summed probabilities of the words after them."""
    return np.where(m.hot_count > 0, free(m.hot_mass, m.hot_count, followers), 1.0)


def finisher(late: np.ndarray, trained: int):  # noqa: ANN201
    """Function of a block's sums and meta row to its documents; `late` has log10 of the hot pairs' weights."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys, flags, sizes = thaw(rows[rows["kind"] == "m"]["payload"].iloc[0])
        score, base, known = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys), np.int64)
        for payload in rows[rows["kind"] == "p"].sort_values("payload")["payload"]:
            s, b, k, later, times = thaw(payload)
            score, base, known = score - s * GRAIN, base - b * GRAIN, known + k.astype(np.int64)
            if len(later):
                np.add.at(score, (later // np.uint64(len(late))).astype(np.int64), late[(later % np.uint64(len(late))).astype(np.int64)] * times.astype(np.float64))
        ids = pd.array(keys.view(np.int64), dtype="Int64")
        ids[(flags & np.uint64(2)) == 0] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": (flags & np.uint64(1)).astype(bool), "n_tokens": sizes.astype(np.int64) + 1, "n_known": known,
            "train_tokens": np.full(len(keys), trained, np.int64), "base_score": base, "score": score,
        })

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, held: Column | None = None, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); rows where `held` is true teach nothing. The model's
    tables are stored at `path`, a folder for each kind, a row for each bucket."""
    spark = docs.sparkSession
    ship(spark)
    held = held_out(F.col("doc_id")) if held is None else held
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("key"), F.col("doc_id").isNotNull().alias("known"), held.alias("held"), F.col("text").cast("binary").alias("text"))
    size, n = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    plan = planned(docs, max(8, -(-(size or 0) // BUCKET_BYTES)), n)
    shared = Shared(spark, plan)
    packed = rows.mapInPandas(packer(shared), PACKED)
    sent = packed.groupBy("bucket").applyInPandas(counter(shared), SENT)
    got = sent.groupBy("bucket").applyInPandas(answerer(shared), SENT)
    branch = got.where("kind = 's'").groupBy((F.col("source") % TREE).alias("part")).applyInPandas(summer(shared), "payload binary")
    root = branch.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(summer(shared), "payload binary")
    to_all = root.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(plan.buckets - 1).cast("long"))).alias("bucket"), F.lit("t").alias("kind"), F.lit(-1).cast("long").alias("source"), "payload")
    answers = got.where("kind <> 's'").union(to_all)
    path = path or fresh_path(spark, "katz")
    packed.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(scorer(shared), STORED).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(STORED).parquet(path)
    model, late = _finished(plan, stored)
    _store(spark, path, plan, late)
    return stored.where("kind IN ('m', 'p')").groupBy("block").applyInPandas(finisher(np.log10(late), model.n), SCORES)


def _finished(plan: Plan, stored: DataFrame) -> tuple[Model, np.ndarray]:
    """The model, and the weights of the hot pairs; what comes to the driver is bounded by HEAVY."""
    model = Model(plan, _root(plan, stored))
    parts = stored.where("kind = 'f'").groupBy((F.col("block") % TREE).alias("part")).applyInPandas(_follower_sum, "payload binary").collect()
    followers = np.sum([thaw(r.payload)[0] for r in parts], axis=0) if parts else np.zeros(len(plan.hot))
    return model, hot_weights(model, followers)


def _root(plan: Plan, stored: DataFrame) -> bytes:
    """The statistics of all buckets; of an empty table there are none."""
    found = stored.where("kind = 's'").first()
    return found.payload if found else Totals(plan).frozen()


def _store(spark: SparkSession, path: str, plan: Plan, late: np.ndarray) -> None:
    """The plan and the hot pairs' weights beside the tables."""
    rows = [(0, freeze(plan.common, plan.heavy, plan.hot, late), "c"), (1, json.dumps({"buckets": plan.buckets}).encode(), "c")]
    spark.createDataFrame(rows, STORED).coalesce(1).write.mode("append").partitionBy("kind").parquet(path)


def _loaded(spark: SparkSession, path: str) -> tuple[Plan, np.ndarray, Model, DataFrame]:
    stored = spark.read.schema(STORED).parquet(path)
    first, second = stored.where("kind = 'c'").orderBy("block").collect()
    common, heavy, hot, late = thaw(first.payload)
    plan = Plan(json.loads(second.payload)["buckets"], common, heavy, hot)
    return plan, late, Model(plan, _root(plan, stored)), stored


def tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The stored model as tables, words as hashes, probabilities and weights as log10: `words` (word, count, p), `bigrams`
    (v, word, count, p), `trigrams` (u, v, word, count, p), and the weights `of_words` (v, weight), `of_pairs` (u, v, weight).
    Stored are trigram counts and weights; bigram counts are their sums."""
    ship(spark)
    plan, late, model, stored = _loaded(spark, path)
    shared, root = Shared(spark, plan), _root(plan, stored)
    signed = lambda x: x.view(np.int64)

    def reader(make):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            of = shared.plan()
            m = Model(of, root)
            for batch in batches:
                for payload in batch["payload"]:
                    yield make(of, m, payload)

        return run

    def words(of: Plan, m: Model, payload: bytes) -> pd.DataFrame:
        v, c, _ = thaw(payload)
        c = c.astype(np.int64)
        return pd.DataFrame({"word": signed(v), "count": c, "p": np.log10(m.p(c))})[c > 0]

    def of_words(of: Plan, m: Model, payload: bytes) -> pd.DataFrame:
        v, _, weight = thaw(payload)
        return pd.DataFrame({"v": signed(v), "weight": np.log10(weight.astype(np.float64))})

    def trigrams(of: Plan, m: Model, payload: bytes) -> pd.DataFrame:
        v, u, w, c, _ = of.thaw_ngrams(payload)
        c, heads, hot = c.astype(np.int64), _starts(v, u), find(of.hot, mixed(v, u))
        runs = _runs(heads, len(v))
        raw = m.d3[np.minimum(c, KATZ_K + 1)] * c
        own, mass = (np.repeat(np.add.reduceat(x, heads), runs) if len(v) else x for x in (c, raw))
        total = np.where(hot >= 0, m.hot_count[np.maximum(hot, 0)], own) if len(of.hot) else own
        mass = np.where(hot >= 0, m.hot_mass[np.maximum(hot, 0)], mass / total) if len(of.hot) else mass / total
        return pd.DataFrame({"u": signed(u), "v": signed(v), "word": signed(w), "count": c, "p": np.log10(raw / total * kept_share(mass, total))})

    def of_pairs(of: Plan, m: Model, payload: bytes) -> pd.DataFrame:
        """Weight of a pair, or the one word that was seen after it, or its place among the hot pairs."""
        v, u, w, c, weight = of.thaw_ngrams(payload)
        heads = _starts(v, u)
        total = np.add.reduceat(c, heads) if len(v) else c
        hot = find(of.hot, mixed(v[heads], u[heads]))
        kept = (total > 1) & (hot < 0)
        out = pd.DataFrame({"u": signed(u[heads]), "v": signed(v[heads]), "at": pd.array(hot, "Int64"), "word": pd.array(signed(w[heads]), "Int64"), "weight": np.nan})
        out.loc[kept, "weight"] = np.log10(weight.astype(np.float64))
        out.loc[hot < 0, "at"] = pd.NA
        out.loc[kept | (hot >= 0), "word"] = pd.NA
        return out

    part = lambda kind, make, schema: stored.where(F.col("kind") == kind).select("payload").mapInPandas(reader(make), schema)
    of = {"words": part("t1", words, "word long, count long, p double"), "of_words": part("t1", of_words, "v long, weight double").distinct(), "trigrams": part("t3", trigrams, "u long, v long, word long, count long, p double")}
    heavy = pd.DataFrame({"word": signed(plan.heavy), "count": model.heavy_tokens, "p": np.log10(model.p(model.heavy_tokens))})[model.heavy_tokens > 0]
    of["words"] = of["words"].union(spark.createDataFrame(heavy, "word long, count long, p double"))
    counts = of["trigrams"].groupBy("v", "word").agg(F.sum("count").alias("count"))
    factor = lambda d, c: F.element_at(F.array(*map(F.lit, d.tolist())), (F.least(c, F.lit(KATZ_K + 1)) + 1).cast("int"))
    raw = factor(model.d2, F.col("count")) * F.col("count")
    sums = counts.groupBy("v").agg(F.sum("count").alias("total"), F.sum(raw).alias("raw_total"))
    kept = F.when(1 - F.col("raw_total") / F.col("total") < 1e-9, F.col("total") / (F.col("total") + 1)).otherwise(F.lit(1.0))
    of["bigrams"] = counts.join(sums, "v").select("v", "word", "count", F.log10(raw / F.col("total") * kept).alias("p"))
    weights = spark.createDataFrame([(i, float(np.log10(x))) for i, x in enumerate(late)], "at long, late double")
    known = part("t3", of_pairs, "u long, v long, at long, word long, weight double").join(weights, "at", "left").join(of["bigrams"].select("v", "word", "p"), ["v", "word"], "left")
    once = float(model.d3[1] * kept_share(np.array([model.d3[1]]), np.array([1]))[0])
    single = F.log10((1 - once) / (1 - F.pow(F.lit(10.0), F.col("p"))))
    of["of_pairs"] = known.select("u", "v", F.when(F.col("at").isNotNull(), F.col("late")).when(F.col("word").isNotNull(), single).otherwise(F.col("weight")).alias("weight")).distinct()
    return of


def evaluate(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """(doc_id, score) of documents by a stored model: the recursion from trigrams to words, one join a table."""
    model, found = _loaded(spark, path)[2], tables(spark, path)

    @F.pandas_udf("array<struct<u:bigint,v:bigint,word:bigint>>")
    def grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = Hashes()
        for texts in batches:
            rows = []
            for t in texts:
                x = np.concatenate(([START, START], word_hashes(t, cache), [END])).astype(np.uint64).view(np.int64)
                rows.append([{"u": a, "v": b, "word": c} for a, b, c in zip(x[:-2].tolist(), x[1:-1].tolist(), x[2:].tolist(), strict=True)])
            yield pd.Series(rows)

    tokens = docs.select("doc_id", F.explode(grams(F.col("text").cast("binary"))).alias("g")).select("doc_id", "g.*")
    for name, keys, value in (("trigrams", ["u", "v", "word"], "p3"), ("of_pairs", ["u", "v"], "w3"), ("bigrams", ["v", "word"], "p2"), ("of_words", ["v"], "w2"), ("words", ["word"], "p1")):
        other = found[name].select(*keys, F.col("p" if value[0] == "p" else "weight").alias(value))
        tokens = tokens.join(other, keys, "left")
    p1 = F.coalesce("p1", F.lit(float(np.log10(model.unknown))))
    p2 = F.coalesce("p2", F.coalesce("w2", F.lit(0.0)) + p1)
    p3 = F.coalesce("p3", F.coalesce("w3", F.lit(0.0)) + p2)
    return tokens.groupBy("doc_id").agg(F.sum(p3).alias("score"))


def planned(docs: DataFrame, buckets: int, n: int) -> Plan:
    """Common words, heavy words and hot pairs by a sample of documents. What comes to the driver is bounded by COMMON and HEAVY."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Hashes()
        for batch in batches:
            for at in range(0, len(batch), 64):
                texts = [np.concatenate(([START, START], word_hashes(t, cache))).astype(np.uint64) for t in batch["text"][at : at + 64]]
                a, b = np.concatenate([x[:-1] for x in texts]), np.concatenate([x[1:] for x in texts])
                order = np.lexsort((b, a))
                first = _starts(a[order], b[order])
                yield pd.DataFrame({"a": a[order][first].view(np.int64), "b": b[order][first].view(np.int64), "n": _runs(first, len(a))})

    sample = docs.where(F.pmod(F.xxhash64(F.lit("katz"), "doc_id", "text"), F.lit(max(1, n // SAMPLE))) == 0)
    seen = sample.select(F.col("text").cast("binary").alias("text")).mapInPandas(pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    seen = cut(seen, "katz-pairs")
    words = seen.groupBy("b").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    least = SPREAD * total / buckets
    common = words.where("n > 1").orderBy(F.col("n").desc(), "b").limit(COMMON).select("b").toPandas()["b"].to_numpy(np.int64).view(np.uint64)
    heavy = [r.b for r in words.where(F.col("n") >= max(2.0, least)).orderBy(F.col("n").desc(), "b").limit(HEAVY).collect()]
    hot = [(r.a, r.b) for r in seen.where(F.col("n") >= max(2.0, least)).orderBy(F.col("n").desc(), "a", "b").limit(HEAVY).collect()]
    discard(seen)
    heavy_words = np.unique(np.concatenate((np.array(heavy, np.int64).view(np.uint64), [START, END])))
    # Only pairs whose second word is heavy are spread, the start's among them.
    u, v = (np.array([*(p[i] for p in hot), np.int64(START.view(np.int64))], np.int64).view(np.uint64) for i in (0, 1))
    spread = np.unique(mixed(v, u)[find(heavy_words, v) >= 0])
    return Plan(buckets, common, heavy_words, spread)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
