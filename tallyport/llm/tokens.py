"""Token ids in binary segments with Elias-Fano coded document boundaries.

Documents are put in ascending doc_id order by a range partitioning; each task encodes its range and packs it into
segments. A segment is self-contained bytes (layout below); segments travel in a Parquet table (part, seq, payload), so
any store that Spark can write takes them, and a lost or repeated task leaves no half-written segment behind.

Segment layout, little-endian: magic "EFT1"; uint8 bytes of an id (2 or 4); uint8 1 if doc ids are stored plainly;
uint16 zero; uint64 documents; uint64 ids; uint64 documents without a doc_id (they are last); then the boundary
sequence (end of each document), the doc_id sequence (relative to the first, or plain int64), and the ids.
Elias-Fano sequence of n values below u: uint8 low bits l = floor(log2(u / n)), uint64 n, int64 base, uint64 bytes of
the upper part, the low bits packed, the upper parts in unary (value v_i sets bit (v_i >> l) + i), and a uint32 sample
of every 256th set bit, from which select(i) starts: about 2 + l bits a document instead of 64.

One row a part of the write meets in the window that places the parts. Rows of one doc_id whose texts begin alike are in one
task of the write, which streams them.

Defined results: a null or empty text has only the end id; rows with a null doc_id come last; rows that repeat are
stored and returned as often; an empty table gives no segments and no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import fresh_path, small, table
from tallyport.session import ship

MAGIC = b"EFT1"
END_ID = 0
SAMPLE = 256
#: Ids after which a segment ends (with its document).
SEGMENT_IDS = 2_000_000
#: Pieces a worker remembers; when full it forgets those that it has not met since half of that were new.
CACHE_PIECES = 1_000_000
_HEADER = struct.Struct("<4sBBHQQQ")
_EF_HEADER = struct.Struct("<BQqQ")


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space, with select."""

    def __init__(self, low_bits: int, n: int, base: int, upper: np.ndarray, low: np.ndarray, samples: np.ndarray) -> None:
        self.low_bits, self.n, self.base, self.upper, self.low, self.samples = low_bits, n, base, upper, low, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, base = len(values), int(values[0]) if len(values) else 0
        rel = values.astype(np.int64).view(np.uint64) - np.uint64(base % (1 << 64))
        spread = int(rel[-1]) + 1 if n else 1
        low_bits = max(0, (spread // n).bit_length() - 1) if n else 0
        places = (rel >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        unary = np.zeros((int(places[-1]) + 1 if n else 0), np.uint8)
        unary[places] = 1
        low = ((rel[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(low_bits, n, base, np.packbits(unary, bitorder="little"), np.packbits(low, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return _EF_HEADER.pack(self.low_bits, self.n, self.base, len(self.upper)) + self.low.tobytes() + self.upper.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        low_bits, n, base, upper_len = _EF_HEADER.unpack_from(data, at)
        at += _EF_HEADER.size
        low_len, samples = (low_bits * n + 7) // 8, -(-n // SAMPLE)
        low = np.frombuffer(data, np.uint8, low_len, at)
        upper = np.frombuffer(data, np.uint8, upper_len, at + low_len)
        sampled = np.frombuffer(data[at + low_len + upper_len : at + low_len + upper_len + 4 * samples], "<u4")
        return cls(low_bits, n, base, upper, low, sampled), at + low_len + upper_len + 4 * samples

    def _low(self, first: int, count: int) -> np.ndarray:
        bit = first * self.low_bits
        bits = np.unpackbits(self.low[bit // 8 : -(-(bit + count * self.low_bits) // 8)], bitorder="little")[bit % 8 :][: count * self.low_bits]
        return (bits.reshape(count, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value i, read from its sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        skip = start % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.upper[byte : byte + 64], bitorder="little")[skip:]) + skip
            if left < len(ones):
                high = byte * 8 + int(ones[left]) - i
                return ((high << self.low_bits) | int(self._low(i, 1)[0] if self.low_bits else 0)) + self.base
            left, byte, skip = left - len(ones), byte + 64, 0

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        high = (np.flatnonzero(np.unpackbits(self.upper, bitorder="little")) - np.arange(self.n)).astype(np.uint64)
        rel = high << np.uint64(self.low_bits)
        if self.low_bits:
            rel = rel | self._low(0, self.n)
        return (rel + np.uint64(self.base % (1 << 64))).view(np.int64)


def pack(doc_ids: list[int | None], ids: list[np.ndarray], id_bytes: int) -> bytes:
    """A segment of documents in ascending doc_id order, those without one last."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    plain = bool(len(known)) and int(known[-1]) - int(known[0]) >= 1 << 62
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    body = EliasFano.of(ends).to_bytes() + (known.astype("<i8").tobytes() if plain else EliasFano.of(known).to_bytes())
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    head = _HEADER.pack(MAGIC, id_bytes, plain, 0, len(doc_ids), len(flat), len(doc_ids) - len(known))
    return head + body + flat.astype(f"<u{id_bytes}").tobytes()


class Segment:
    """Reads a packed segment."""

    def __init__(self, payload: bytes) -> None:
        data = memoryview(payload)
        magic, id_bytes, plain, _, self.docs, self.n_ids, nulls = _HEADER.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.ends, at = EliasFano.read(data, _HEADER.size)
        if plain:
            known = np.frombuffer(data[at : at + 8 * (self.docs - nulls)], "<i8")
            at += 8 * (self.docs - nulls)
        else:
            coded, at = EliasFano.read(data, at)
            known = coded.all()
        self.doc_ids = [*map(int, known), *[None] * nulls]
        self.ids = np.frombuffer(data[at : at + id_bytes * self.n_ids], f"<u{id_bytes}")

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


#: Characters that every Unicode version classes alike, in whose texts a blank between non-blanks starts a new piece.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧]*")
#: In such texts, what makes a blank part of a longer run of white space.
_JOINED = ("  ", " \n", "\n ", " \t", "\t ", "\r", "\n\n", "\n\t", "\t\n")
#: Pieces that are encoded as lines of one text (more cost the library more each), and in one call.
_LINES = 100
_CALL = 2000
#: Marks that end a letter's or a digit's piece of the byte-level pattern, and are a piece with those after them.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _splits_at_blanks(config: dict) -> bool:
    """Whether a vocabulary file says that texts are split by the byte-level pattern and then each piece alone is encoded."""
    before, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    split = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    return bool(split) and not config.get("normalizer") and not config.get("truncation") and not config.get("padding") and model.get("type") == "BPE" and not model.get("dropout")


class Encoder:
    """Encodes texts piece by piece; a piece is a word with the blank before it, or a line end, which a byte-level
    pre-tokeniser with its own pattern never joins to its neighbours. Other texts, and all texts of a vocabulary with any
    other pre-tokeniser or a normaliser, are encoded as a whole."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = _splits_at_blanks(json.loads(self.tokenizer.to_str()))
        self.never = [*_JOINED, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else -1
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of plain pieces. Those on one line are joined by line ends, which are pieces of their own,
        so one call encodes thousands."""
        lines = [p for p in pieces if "\n" not in p and "\t" not in p and p.strip(" ")]
        others = set(pieces).difference(lines)
        parts = [lines[at : at + _LINES] for at in range(0, len(lines), _LINES)]
        for at in range(0, len(parts), _CALL // _LINES):
            call = parts[at : at + _CALL // _LINES]
            for part, raw in zip(call, self._raw(["\n".join(part) for part in call]), strict=True):
                ends = np.flatnonzero(np.frombuffer(raw, "<u4") == self.line_end)
                if len(ends) != len(part) - 1:
                    others.update(part)
                    continue
                starts = [0, *(4 * ends + 4).tolist()]
                self.known.update(zip(part, [raw[i:j] for i, j in zip(starts, [*(4 * ends).tolist(), len(raw)], strict=True)], strict=True))
        rest = list(others)
        for at in range(0, len(rest), _CALL):
            part = rest[at : at + _CALL]
            self.known.update(zip(part, self._raw(part), strict=True))

    def _meet(self, pieces: set[str]) -> None:
        """Have the ids of plain pieces among the known ones. Marks that end a piece are encoded apart from what they follow."""
        if len(self.known) > CACHE_PIECES // 2:
            self.known, self.older = {}, self.known
        known, older, new, ended = self.known, self.older, set(), []
        for piece in pieces.difference(known):
            if piece in older:
                known[piece] = older[piece]
                continue
            body = piece.rstrip(_MARKS)
            if len(body) == len(piece) or not body[-1:].isalnum():
                new.add(piece)
                continue
            ended.append((piece, body, piece[len(body) :]))
        for part in {x for _, *parts in ended for x in parts}.difference(known):
            if part in older:
                known[part] = older[part]
            else:
                new.add(part)
        self._learn(list(new))
        for piece, body, marks in ended:
            known[piece] = known[body] + known[marks]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        pieces: list[list[str] | None] = []
        for text in texts:
            plain = self.by_piece and _PLAIN.fullmatch(text) and not any(s in text for s in self.never)
            split = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if plain else None
            pieces.append(split)
        self._meet(set().union(*(p for p in pieces if p)))
        get, end = self.known.__getitem__, np.array([END_ID], dtype="<u4").tobytes()
        out = []
        for text, split in zip(texts, pieces, strict=True):
            raw = b"".join(map(get, split)) if split is not None else self._raw([text])[0]
            out.append(np.frombuffer(raw + end, "<u4"))
        return out


@lru_cache(maxsize=1)
def encoder(name: str) -> Encoder:
    """The encoder of a vocabulary file that the context has sent to the workers; kept for the worker's next tasks."""
    return Encoder(SparkFiles.get(name))


def packer(name: str):  # noqa: ANN201
    """mapInPandas function: (doc_id, key, text) in order to (part, seq, docs, n_ids, payload)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part, seq = encoder(name), TaskContext.get().partitionId(), 0
        width = 4 if coder.wide else 2
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0
        row = lambda: pd.DataFrame({"part": [part], "seq": [seq], "docs": [len(doc_ids)], "n_ids": [held], "payload": [pack(doc_ids, ids, width)]})
        for batch in batches:
            known = batch["doc_id"].notna().to_numpy()
            keys = batch["key"].to_numpy()
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for first in range(0, len(texts), 256):
                for at, found in enumerate(coder.encode(texts[first : first + 256]), first):
                    doc_ids.append(int(keys[at]) if known[at] else None)
                    ids.append(found)
                    held += len(found)
                    if held >= SEGMENT_IDS:
                        yield row()
                        doc_ids, ids, held, seq = [], [], 0, seq + 1
        if doc_ids:
            yield row()

    return run


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the documents' ids as segments at `path`, in ascending doc_id order."""
    ship(docs.sparkSession)
    docs.sparkSession.sparkContext.addFile(tokenizer)
    # doc_id twice: pandas turns longs with nulls into floats, so `key` carries the exact value.
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("key"), "text")
    # Rows that share a doc_id, or have none, are parted by how their texts begin.
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_last(), F.left("text", F.lit(24))).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    ordered.mapInPandas(packer(os.path.basename(tokenizer)), "part int, seq int, docs long, n_ids long, payload binary").write.parquet(path)


def _opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for base, payload in zip(batch["base"], batch["payload"], strict=True):
            segment = Segment(payload)
            ends = np.fromiter((segment.ends.select(i) for i in range(segment.docs)), np.int64, segment.docs)
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            crcs = [zlib.crc32(segment.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame({"doc_id": pd.array(segment.doc_ids, dtype="Int64"), "start": starts + base, "n_tokens": ends - starts, "ids_crc32": np.array(crcs, dtype=np.int64)})


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document, all taken from the segments by select."""
    found = spark.read.schema("part int, seq int, docs long, n_ids long, payload binary").parquet(path)
    sizes = found.select("part", "seq", "n_ids")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    # One row a part: as many as the write had tasks.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    bases = inside.join(parts, "part").select("part", "seq", (F.col("inside") + F.col("part_base")).alias("base"))
    return found.join(small(bases), ["part", "seq"]).select("base", "payload").mapInPandas(_opened, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path)
