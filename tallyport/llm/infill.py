"""Fill-in-the-middle rearrangement of whole texts, cut between units with a sparse index of checkpoints.

While a text's units are counted, a checkpoint is kept after every EVERY of them: the unit's number, and how many bytes
and how many code points lie before it. A cut after a unit is then found by a binary search of the checkpoints and a short
scan from the one before it, at most EVERY units long. So counting is one pass over the bytes, in blocks, and neither a
list of all units nor one of all code points is held, however long a text is. Units are lines (a last line may lack its
end) or code points.

A document's draws come from the SHA-256 of a seed and its doc_id, so they are the same on every run and every cluster,
and one document's do not depend on another's. The texts are put together from bytes by expressions; only cut points come
from Python.

Defined results: null and empty texts are plain, of 0 units, and give an empty output; a text that holds a marker is
plain, so every output can be taken apart again; a document without doc_id draws as if its number were no digits at all;
rows that repeat come out alike; an empty table gives no rows; other columns of the table, whatever their names, stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import table
from tallyport.session import ship

#: Units between two checkpoints.
EVERY = 64
#: Bytes that are counted at once.
BLOCK = 1 << 20
LINE, CHARACTER = "line", "character"
CUTS = "n bigint, prefix_bytes bigint, prefix_chars bigint, middle_bytes bigint, middle_chars bigint"


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


@dataclass(frozen=True)
class Options:
    """Of 100 documents `rate` are rearranged, of 100 of these `spm` begin with the suffix."""

    seed: str = "7"
    rate: int = 100
    spm: int = 50
    unit: str = LINE
    every: int = EVERY
    markers: Markers = Markers()


class Checkpoints:
    """`n` units of a UTF-8 text, and for every `every` of them the bytes and the code points before."""

    def __init__(self, data: bytes, unit: str = LINE, every: int = EVERY) -> None:
        self.data, self.unit, self.every = data, unit, every
        self.units, self.bytes, self.chars = [0], [0], [0]
        self.n = 0
        self._count()

    def _ends(self, block: np.ndarray, base: int) -> np.ndarray:
        """Offsets of the bytes of a block that end a unit."""
        if self.unit == LINE:
            return np.flatnonzero(block == 10)
        # A code point ends where the next byte begins one, and at the text's end.
        following = np.empty(len(block), np.uint8)
        following[:-1] = block[1:]
        following[-1] = self.data[base + len(block)] if base + len(block) < len(self.data) else 0
        return np.flatnonzero((following & 0xC0) != 0x80)

    def _count(self) -> None:
        whole = np.frombuffer(self.data, np.uint8)
        chars = 0
        for base in range(0, len(whole), BLOCK):
            block = whole[base : base + BLOCK]
            ends = self._ends(block, base)
            # The first checkpoint of this block comes after as many units as are missing to a full run.
            marks = ends[self.every - 1 - self.n % self.every :: self.every] + 1
            begins = (block & 0xC0) != 0x80
            at = 0
            for mark in marks.tolist():
                chars += int(np.count_nonzero(begins[at:mark]))
                at = mark
                self.units.append(self.units[-1] + self.every)
                self.bytes.append(base + mark)
                self.chars.append(chars)
            chars += int(np.count_nonzero(begins[at:]))
            self.n += len(ends)
        if self.unit == LINE and self.data and not self.data.endswith(b"\n"):
            self.n += 1
        self.all_chars = chars

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before the place after `unit` units."""
        if unit >= self.n:
            return len(self.data), self.all_chars
        at = bisect_right(self.units, unit) - 1
        byte, chars, left = self.bytes[at], self.chars[at], unit - self.units[at]
        start = byte
        for _ in range(left):
            byte = self._next(byte)
        part = np.frombuffer(self.data, np.uint8, byte - start, start)
        return byte, chars + int(np.count_nonzero((part & 0xC0) != 0x80))

    def _next(self, byte: int) -> int:
        if self.unit == LINE:
            return self.data.index(b"\n", byte) + 1
        byte += 1
        while byte < len(self.data) and self.data[byte] & 0xC0 == 0x80:
            byte += 1
        return byte


def cuts(unit: str = LINE, every: int = EVERY):  # noqa: ANN201
    """Pandas UDF: (UTF-8 text, two draws) to the number of units and the sizes of prefix and middle. The prefix ends
    after the lesser, the middle after the greater of the draws modulo the number of places between units."""

    @F.pandas_udf(f"struct<{CUTS.replace(' ', ':').replace(',:', ',')}>")
    def of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, first, second in batches:
            rows = []
            for data, a, b in zip(texts, first.tolist(), second.tolist(), strict=True):
                points = Checkpoints(data or b"", unit, every)
                low, high = sorted((a % (points.n + 1), b % (points.n + 1)))
                (byte, char), (byte_end, char_end) = points.cut(low), points.cut(high)
                rows.append((points.n, byte, char, byte_end - byte, char_end - char))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CUTS.split(", ")])

    return of


def draws(doc_id: Column, seed: str) -> list[Column]:
    """The first four 32-bit numbers of the SHA-256 of the seed and the document's number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def rearranged(docs: DataFrame, options: Options = Options(), out: str = "fim") -> DataFrame:  # noqa: B008
    """The table with a struct column `out`: n, form (plain, psm or spm), output, and prefix_chars and middle_chars, null
    if plain. psm is marked prefix, suffix, middle; spm is marked suffix, prefix, middle."""
    ship(docs.sparkSession)
    marks = options.markers
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    drawn = docs.select(row.alias("row"), text.alias("text"), F.struct(*(d.alias(f"h{i + 1}") for i, d in enumerate(draws(F.col("doc_id"), options.seed)))).alias("d"))
    found = drawn.select("row", "text", "d", cuts(options.unit, options.every)(F.col("text").cast("binary"), F.col("d.h1"), F.col("d.h2")).alias("c"))
    held = F.lit(False)
    for mark in (marks.prefix, marks.suffix, marks.middle):
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (F.col("d.h3") % 100 >= options.rate)
    form = F.when(plain, "plain").when(F.col("d.h4") % 100 < options.spm, "spm").otherwise("psm")
    data, a, b = F.col("text").cast("binary"), F.col("c.prefix_bytes"), F.col("c.middle_bytes")
    piece = lambda start, length: F.substring(data, (start + 1).cast("int"), length.cast("int"))
    prefix, middle, suffix = piece(F.lit(0), a), piece(a, b), piece(a + b, F.octet_length(data) - a - b)
    mark = lambda m: F.lit(m).cast("binary")
    psm = F.concat(mark(marks.prefix), prefix, mark(marks.suffix), suffix, mark(marks.middle), middle)
    spm = F.concat(mark(marks.suffix), suffix, mark(marks.prefix), prefix, mark(marks.middle), middle)
    output = F.when(F.col("form") == "plain", data).when(F.col("form") == "psm", psm).otherwise(spm).cast("string")
    count = lambda name: F.when(F.col("form") != "plain", F.col(f"c.{name}")).alias(name)
    made = found.withColumn("form", form)
    fim = F.struct(F.col("c.n").alias("n"), F.col("form"), output.alias("output"), count("prefix_chars"), count("middle_chars"))
    return made.select("row", fim.alias("fim")).select("row.*", F.col("fim").alias(out))


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:  # noqa: B008
    """The text that an output was made of."""
    parts = F.split(output, "|".join(re.escape(m) for m in (markers.prefix, markers.suffix, markers.middle)))
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).otherwise(F.concat(part(2), part(3), part(1)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output, and of the text restored from it."""
    made = rearranged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output = F.col("fim.output")
    back = restored(output, F.col("fim.form"))
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2(output, 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
 u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
 c AS (SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
 p AS (SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS prefix, coalesce(array_to_string(lines[a + 1:b], ''), '') AS middle, coalesce(array_to_string(lines[b + 1:n], ''), '') AS suffix FROM c)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
 sha256(text) AS restored_sha256 FROM p"""
