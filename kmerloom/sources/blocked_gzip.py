"""Blocked gzip files of reads as a Spark data source: one file is read by many tasks.

Block gzip is gzip in members of at most 64 KB, each of which says its length in a field of its header. A task takes a range
of a file's bytes and reads the blocks that start in it; the first is found by its header and its checksum.
Records go over the edges of ranges: a task skips to the first record that starts in its blocks, and reads on behind them to
the end of its last record. Files in other gzip forms (one member, or several without lengths) are read by one task.

A block with wrong bytes fails its checksum, and a block that is not where the one before says is an error.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .binary_database import _open
from .manifest import GROUPS, sample_of

FORMAT = "blocked_reads"
SPLIT_BYTES = 16 << 20
#: The longest block, and so the farthest that a range's first block can be from its start.
BLOCK = 1 << 16
READ = 1 << 20
ROWS = 8192
MAGIC = b"\x1f\x8b\x08\x04"


def block_length(head: bytes) -> int | None:
    """The length of the block that starts with these bytes; None where none does."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    (extra,) = struct.unpack_from("<H", head, 10)
    at, end = 12, min(12 + extra, len(head))
    while at + 4 <= end:
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def first_block(data: bytes) -> int | None:
    """Where the first whole block starts in ``data``: one with a header, a length, and the checksum of its text.

    A damaged block is passed over here; whoever reads the block before it comes to it and refuses it.
    """
    at = data.find(MAGIC)
    while at >= 0:
        size = block_length(data[at : at + 256])
        if size is not None:
            try:
                zlib.decompress(data[at : at + size], 31)
                return at
            except zlib.error:
                pass
        at = data.find(MAGIC, at + 1)
    return None


class _Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; ``end`` is None for files that one task reads."""

    def __init__(self, path: str, start: int, end: int | None) -> None:
        self.path, self.start, self.end = path, start, end


def _blocks(f: pa.NativeFile, path: str, at: int) -> Iterator[tuple[int, bytes]]:
    """``(place, text)`` of the blocks from ``at`` on, checked."""
    size, held, base = f.size(), b"", at
    while at < size:
        if at - base + BLOCK + 256 > len(held) and base + len(held) < size:
            held, base = f.read_at(READ, at), at
        length = block_length(held[at - base : at - base + 256])
        if length is None or at + length > size:
            raise ValueError(f"{path}: no block of gzip at byte {at}")
        try:
            text = zlib.decompress(held[at - base : at - base + length], 31)
        except zlib.error as e:
            raise ValueError(f"{path}: the block at byte {at} is damaged") from e
        yield at, text
        at += length


def _members(f: pa.NativeFile, path: str) -> Iterator[bytes]:
    """The text of a whole file of gzip members."""
    at, size, rest, unzip = 0, f.size(), b"", None
    while rest or at < size:
        data, rest = rest, b""
        if not data:
            data = f.read_at(min(READ, size - at), at)
            at += len(data)
        if not unzip:
            # Zeros behind a member fill a file up.
            if not (data := data.lstrip(b"\0")):
                continue
            unzip = zlib.decompressobj(31)
        try:
            text = unzip.decompress(data)
        except zlib.error as e:
            raise ValueError(f"{path}: a member is damaged") from e
        yield text
        if unzip.eof:
            rest, unzip = unzip.unused_data, None
    if unzip:
        raise ValueError(f"{path}: ends within a member")


def _pieces(texts: Iterator[tuple[bytes, bool]], from_start: bool) -> Iterator[bytes]:
    """Texts between line ends before an ``@``, of ``(text, own)``: pieces whose line end before stands in own text."""
    held, own, before = b"", from_start, from_start
    for text, mine in texts:
        at = 0
        data = held + text
        # A line end and its @ may stand in two texts.
        scan = max(0, len(held) - 1)
        while (end := data.find(b"\n@", scan)) >= 0:
            if own:
                yield data[at:end]
            # The line end belongs to the text it stands in.
            own = mine if end >= len(held) else before
            if not own:
                return
            at = scan = end + 2
        held, before = data[at:] if own else data[-1:], mine
    if own and held:
        yield held


def sequence_of(piece: bytes) -> bytes | None:
    """The second line of a record without its first sign; None for a cut quality line."""
    lines = piece.replace(b"\r\n", b"\n").split(b"\n", 3)
    return lines[1] if len(lines) >= 3 and lines[2].startswith(b"+") else None


class _Reads(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int) -> None:
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[_Range]:
        out = []
        for path in self.paths:
            with _open(path) as f:
                size = f.size()
                blocked = block_length(f.read_at(min(256, size), 0)) is not None
            out += [_Range(path, at, min(at + self.split_bytes, size)) for at in range(0, size, self.split_bytes)] if blocked else [_Range(path, 0, None)]
        return out

    def _texts(self, f: pa.NativeFile, part: _Range) -> Iterator[tuple[bytes, bool]]:
        if part.end is None:
            yield from ((text, True) for text in _members(f, part.path))
            return
        at = part.start
        if at:
            found = first_block(f.read_at(min(4 * BLOCK, f.size() - at), at))
            if found is None or at + found >= part.end:
                return
            at += found
        for place, text in _blocks(f, part.path, at):
            yield text, place < part.end

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        with _open(part.path) as f:
            rows: list[bytes] = []
            for piece in _pieces(self._texts(f, part), part.start == 0):
                if (seq := sequence_of(piece)) is not None:
                    rows.append(seq)
                if len(rows) >= ROWS:
                    yield self._batch(part.path, rows)
                    rows = []
            if rows:
                yield self._batch(part.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(path, len(rows)), pa.array(rows, pa.binary()).cast(pa.string())], names=["path", "seq"])


class BlockedReads(DataSource):
    """``(path, seq)`` of the FASTQ files in the option ``files``, a JSON list."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, seq string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reads(json.loads(self.options["files"]), int(self.options.get("split_bytes", SPLIT_BYTES)))


def read_blocked_fastq(spark: SparkSession, paths: list[str], groups: tuple[str, str] = GROUPS, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(path, grp, sample, seq)`` of four-line FASTQ files under gzip, as ``read_fastq`` has them."""
    spark.dataSource.register(BlockedReads)
    reads = spark.read.format(FORMAT).option("files", json.dumps(paths)).option("split_bytes", str(split_bytes)).load()
    grp = F.when(F.col("path").rlike(f"(?:^|/){re.escape(groups[0])}/"), 1).otherwise(2)
    return reads.select("path", grp.alias("grp"), sample_of(F.col("path"), groups).alias("sample"), "seq")
