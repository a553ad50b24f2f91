"""Delimited records that span lines, found by chunk: where each chunk's first record begins.

A line end inside quotes does not end a record, and whether a byte is inside quotes depends on all bytes before it. But at
the start of a line there are only two cases, inside or outside. So each chunk, which begins at the start of a line, is
looked at under both: how it ends, and where its first record begins. These summaries are made in parallel; put together in
order they give every chunk its case. Only what begins in a chunk is read with it, to its end, wherever that is.

A quote opens at the start of a field only. Inside, a doubled quote is a quote, and so is one behind the escape character
if the dialect has one. What follows a closing quote up to the delimiter belongs to the field.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

OUTSIDE, INSIDE = 0, 1


@dataclass(frozen=True)
class Summary:
    """A chunk's end if it begins outside and if it begins inside quotes; and in the latter case the offset at which its
    first record begins, None if none does."""

    chunk: int
    outside: int
    inside: int
    first: int | None


class Records:
    """Patterns of a dialect's records over bytes."""

    def __init__(self, delimiter: str, quote: str, escape: str | None) -> None:
        self.quote = quote.encode()
        d, q = re.escape(delimiter.encode()), re.escape(self.quote)
        e = re.escape(escape.encode()) if escape and escape != quote else None
        # What is inside quotes, without the closing one. Possessive, so a quote that does not close fails at once.
        body = rb"(?:[^%s]++|%s%s)*+" % (q, q, q) if e is None else rb"(?:[^%s%s]++|%s.|%s%s)*+" % (q, e, e, q, q)
        rest = rb"%s[^%s\n]*+" % (q, d)
        field = rb"(?:%s%s%s|[^%s%s\n][^%s\n]*+|)" % (q, body, rest, q, d, d)
        more = rb"(?:%s%s)*+" % (d, field)
        self._record = re.compile(field + more + rb"(\n|\Z)", re.DOTALL)
        self._rest = re.compile(body + rest + more + rb"(\n|\Z)", re.DOTALL)

    def end(self, data: bytes, at: int, inside: bool = False) -> int | None:
        """The offset after the record that begins at `at` (or goes on there, inside quotes); None if it does not end in
        `data`. The end of the data ends a record whose quotes are closed."""
        found = (self._rest if inside else self._record).match(data, at)
        return None if found is None else found.end()

    def ends(self, data: bytes, at: int = 0) -> Iterator[int]:
        """Offsets after each whole record from `at` on."""
        while at < len(data):
            end = self.end(data, at)
            if end is None:
                return
            yield end
            at = end

    def summary(self, chunk: int, data: bytes) -> Summary:
        """Of a chunk that begins at the start of a line and ends with a line end (or is the last)."""
        if not data:
            return Summary(chunk, OUTSIDE, INSIDE, None)
        if self.quote not in data:
            return Summary(chunk, OUTSIDE, INSIDE, None)
        ends = list(self.ends(data))
        outside = OUTSIDE if ends and ends[-1] == len(data) else INSIDE
        first = self.end(data, 0, inside=True)
        if first is None:
            return Summary(chunk, outside, INSIDE, None)
        at = first
        while at < len(data):
            # As soon as a record of the other case begins here, both go on alike.
            place = bisect_left(ends, at)
            if place < len(ends) and ends[place] == at:
                return Summary(chunk, outside, outside, first)
            end = self.end(data, at)
            if end is None:
                return Summary(chunk, outside, INSIDE, first)
            at = end
        return Summary(chunk, outside, OUTSIDE, first)


@lru_cache(maxsize=8)
def records(delimiter: str, quote: str, escape: str | None) -> Records:
    return Records(delimiter, quote, escape)


def begins(summaries: Iterable[Summary]) -> tuple[dict[int, int | None], int]:
    """From summaries in order of chunk: of the chunks that begin inside quotes the offset of their first record (None if
    none begins there), and how the last one ends. The others' first record begins where they do."""
    state, out = OUTSIDE, {}
    for s in summaries:
        if state == INSIDE:
            out[s.chunk] = s.first
            state = s.inside
        else:
            state = s.outside
    return out, state
