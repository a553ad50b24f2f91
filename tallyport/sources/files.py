"""Files by URI: validation, ranged reads, newline-aligned chunks and row estimates."""

from __future__ import annotations

import os
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow import fs

SCAN_BYTES = 8 * 1024
SAMPLE_BYTES = 8 * 1024
CHUNK_BYTES = 10 * 1024 * 1024
FORMATS = ("csv", "tsv", "parquet", "dump")


@dataclass(frozen=True)
class Source:
    """A validated file location: scheme `file` or `s3`."""

    scheme: str
    path: str

    @property
    def for_spark(self) -> str:
        return f"s3a://{self.path}" if self.scheme == "s3" else f"file://{self.path}" if self.path.startswith("/") else self.path

    def open(self) -> Joined:
        """The file, or the files of the folder put together in order of name."""
        return Joined(self.scheme, Place(self).pieces())


def file_system(scheme: str) -> fs.FileSystem:
    return fs.S3FileSystem() if scheme == "s3" else fs.LocalFileSystem()


class Joined:
    """Files read as one: a position is that in all of them put together. Only the files that are read are opened."""

    def __init__(self, scheme: str, pieces: list[tuple[str, int]]) -> None:
        self._system, self._pieces = file_system(scheme), pieces
        self._starts = [0]
        for _, size in pieces:
            self._starts.append(self._starts[-1] + size)
        self._at, self._number, self._file = 0, -1, None

    def size(self) -> int:
        return self._starts[-1]

    def seek(self, at: int) -> None:
        self._at = at

    def read(self, n: int = -1) -> bytes:
        """As many bytes, fewer only at the end."""
        left = self.size() - self._at if n < 0 else min(n, self.size() - self._at)
        out = []
        while left > 0:
            # The last file that begins at or before the position; empty files begin where the next one does.
            number = bisect_right(self._starts, self._at, 0, len(self._pieces)) - 1
            if number != self._number:
                self.close()
                self._file, self._number = self._system.open_input_file(self._pieces[number][0]), number
            self._file.seek(self._at - self._starts[number])
            part = self._file.read(min(left, self._starts[number + 1] - self._at))
            if not part:
                raise EOFError(f"{left} bytes are missing in {self._pieces[number][0]}")
            out.append(part)
            self._at += len(part)
            left -= len(part)
        return out[0] if len(out) == 1 else b"".join(out)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._file, self._number = None, -1

    def __enter__(self) -> Joined:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


@dataclass(frozen=True)
class Place:
    """A folder or a small text file of a store. Executors reach it by `for_spark`, the driver by the same file system."""

    source: Source

    @classmethod
    def of(cls, uri: str) -> Place:
        return cls(parse_uri(uri))

    def __truediv__(self, name: str) -> Place:
        return Place(Source(self.source.scheme, f"{self.source.path.rstrip('/')}/{name}"))

    @property
    def for_spark(self) -> str:
        return self.source.for_spark

    @property
    def _system(self) -> fs.FileSystem:
        return file_system(self.source.scheme)

    def read_text(self) -> str | None:
        """None if there is no such file."""
        if self._system.get_file_info(self.source.path).type != fs.FileType.File:
            return None
        with self._system.open_input_stream(self.source.path) as file:
            return file.read().decode("utf-8")

    def write_text(self, text: str) -> None:
        """All at once: an object appears whole, a local file is moved into its place."""
        system, local = self._system, self.source.scheme != "s3"
        parent = self.source.path.rpartition("/")[0]
        if local and parent:
            system.create_dir(parent, recursive=True)
        path = f"{self.source.path}.new" if local else self.source.path
        with system.open_output_stream(path) as file:
            file.write(text.encode("utf-8"))
        if local:
            system.move(path, self.source.path)

    def names(self) -> list[str]:
        """What the folder holds; nothing if there is none."""
        found = self._system.get_file_info(fs.FileSelector(self.source.path, allow_not_found=True))
        return sorted(f.base_name for f in found)

    def size(self) -> int:
        """Bytes of a file, or of all files of a folder."""
        return sum(size for _, size in self.pieces())

    def pieces(self) -> list[tuple[str, int]]:
        """(path, bytes) of the file itself, or of the data files below the folder, in order of name; runs of digits are
        ordered as numbers. Names that begin with a dot or an underscore are no data."""
        info = self._system.get_file_info(self.source.path)
        if info.type == fs.FileType.File:
            return [(self.source.path, info.size)]
        if info.type != fs.FileType.Directory:
            raise FileNotFoundError(f"there is nothing at {self.source.path}")
        below = len(self.source.path.rstrip("/")) + 1
        found = [(f.path, f.size) for f in self._system.get_file_info(fs.FileSelector(self.source.path, recursive=True)) if f.type == fs.FileType.File]
        shown = [f for f in found if not any(name.startswith(("_", ".")) for name in f[0][below:].split("/"))]
        return sorted(shown, key=lambda f: [[int(x) if x.isdigit() else x for x in re.split(r"(\d+)", name)] for name in f[0][below:].split("/")])

    def files(self) -> list[str]:
        return [path for path, _ in self.pieces()]

    def open(self) -> Joined:
        return Joined(self.source.scheme, self.pieces())

    def create(self, text: str) -> bool:
        """Write a new file, whole; False if there is one already. On a local file system, also a mounted one, just one of
        several writers succeeds."""
        system = self._system
        if system.get_file_info(self.source.path).type != fs.FileType.NotFound:
            return False
        if self.source.scheme == "s3":
            self.write_text(text)
            return True
        parent = self.source.path.rpartition("/")[0] or "."
        system.create_dir(parent, recursive=True)
        draft = f"{parent}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(draft, self.source.path)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True

    def remove(self) -> None:
        info = self._system.get_file_info(self.source.path)
        if info.type == fs.FileType.Directory:
            self._system.delete_dir(self.source.path)
        elif info.type == fs.FileType.File:
            self._system.delete_file(self.source.path)


def parse_uri(uri: str) -> Source:
    scheme, mark, rest = uri.partition("://")
    if uri.startswith("file:/") and not mark:
        return Source("file", unquote(uri.removeprefix("file:")))
    if not mark:
        if not uri:
            raise ValueError("empty path")
        return Source("file", uri)
    if scheme == "file":
        return Source("file", unquote(rest))
    if scheme in ("s3", "s3a"):
        bucket, _, key = rest.partition("/")
        if not bucket or not key:
            raise ValueError(f"{uri}: bucket and key must not be empty")
        return Source("s3", rest)
    raise ValueError(f"{uri}: unknown scheme {scheme!r}")


def detect_format(path: str) -> str:
    """By extension; dumps have none of their own and must be named."""
    extension = path.rpartition(".")[2].lower() if "." in path else ""
    if extension in ("csv", "tsv", "parquet"):
        return extension
    raise ValueError(f"can't tell the format of {path}; name it")


def read_range(file, start: int, end: int) -> bytes:  # noqa: ANN001
    file.seek(start)
    data = file.read(end - start)
    if len(data) != end - start:
        raise EOFError(f"{end - start} bytes wanted at {start}, {len(data)} found")
    return data


def next_boundary(file, at: int, end: int) -> int:  # noqa: ANN001
    """The byte after the first line end at or after `at`, or `end`. Quotes are not looked at."""
    while at < end:
        block = read_range(file, at, min(at + SCAN_BYTES, end))
        if (found := block.find(b"\n")) >= 0:
            return at + found + 1
        at += len(block)
    return end


def estimate_rows(sample: bytes, total: int) -> int | None:
    """Rows in `total` bytes that begin with `sample`, in whole-number arithmetic; None without a line end."""
    if total == 0:
        return 0
    lines = sample.count(b"\n")
    return total // (len(sample) // lines) if lines else None


@dataclass(frozen=True)
class Chunk:
    id: int
    start: int
    end: int


def chunk_count(start: int, end: int, target: int = CHUNK_BYTES) -> int:
    return -(-(end - start) // target)


def nth_chunk(file, start: int, end: int, target: int, number: int) -> Chunk:  # noqa: ANN001
    """The chunk of the lines that begin in the number-th `target` bytes of [start, end). Whoever reads a chunk finds its
    borders alone, so no one has to walk over the whole file; a chunk within one long line is empty."""
    border = lambda n: start if n <= 0 else next_boundary(file, start + n * target - 1, end) if start + n * target < end else end
    return Chunk(number, border(number), border(number + 1))


def chunks(file, start: int, end: int, target: int = CHUNK_BYTES) -> Iterator[Chunk]:  # noqa: ANN001
    """Contiguous chunks of about `target` bytes over [start, end), each ending after a line end."""
    for number in range(chunk_count(start, end, target)):
        yield nth_chunk(file, start, end, target, number)


def rows_in(file, start: int, end: int) -> int | None:  # noqa: ANN001
    """Estimated rows of [start, end), from its first SAMPLE_BYTES."""
    return estimate_rows(read_range(file, start, min(start + SAMPLE_BYTES, end)), end - start)


def row_group_chunks(sizes: list[int], target: int = CHUNK_BYTES) -> list[Chunk]:
    """Row groups packed in order up to `target` bytes, at least one a chunk; start and end are row-group numbers."""
    out: list[Chunk] = []
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and held + size > target:
            out.append(Chunk(len(out), start, at))
            start, held = at, 0
        held += size
    if start < len(sizes):
        out.append(Chunk(len(out), start, len(sizes)))
    return out
