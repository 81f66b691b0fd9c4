"""Binary k-mer databases of external counters as a Spark data source.

A database is a pair of files, ``<path>.kmc_pre`` and ``<path>.kmc_suf``, each between two markers. The first has a table
of running totals, one entry per bin and prefix, and a header; the second has one record per k-mer: the rest of its
letters, four to a byte, and its count. Tasks read ranges of the table and the records that belong to them, so that a
database of any size is read in parallel and never held whole. Many databases are one scan, whose partitions are ranges of
one or several files. Counts outside of a header's range are not listed, nor those outside of a narrower one that is asked
for.

Single k-mers are found by the table as an index: it says which records share a k-mer's bin and prefix, and only these are
read and searched.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.superkmers import normalised_table
from .manifest import natural_key

FORMAT = "kmer_files"
ENTRIES = 1 << 16
RECORDS = 1 << 17
#: Places of the table that are read at once where k-mers are looked up.
PAGE = 512

# Fixed values of the format: markers, versions, and the fields of the headers.
PREFIX_MARK, SUFFIX_MARK = b"KMCP", b"KMCS"
SINGLE, BINNED = 0, 0x200
HEADERS = {BINNED: struct.Struct("<7IQB"), SINGLE: struct.Struct("<6IQBI")}

LETTERS = np.frombuffer(b"ACGT", np.uint8)
_FOUR = LETTERS[(np.arange(256)[:, None] >> np.array([6, 4, 2, 0])) & 3]


@dataclass(frozen=True)
class DatabaseInfo:
    """The facts of a database's header; ``entries`` is the length of its table, ``binned`` the newer of two formats."""

    kmer_length: int
    mode: int
    counter_size: int
    prefix_length: int
    signature_length: int
    min_count: int
    max_count: int
    total_kmers: int
    both_strands: bool
    binned: bool
    entries: int

    @property
    def suffix_bytes(self) -> int:
        return (self.kmer_length - self.prefix_length) // 4

    @property
    def record_bytes(self) -> int:
        return self.suffix_bytes + self.counter_size


def _open(path: str) -> pa.NativeFile:
    path = re.sub(r"^file:/(?!//)", "file:///", path)
    if "://" in path:
        store, path = fs.FileSystem.from_uri(path)
    else:
        store = fs.LocalFileSystem()
    return store.open_input_file(path)


def read_info(path: str) -> DatabaseInfo:
    """The header of a database, checked; ValueError where it is none, of an unknown version, or damaged."""
    with _open(f"{path}.kmc_pre") as pre, _open(f"{path}.kmc_suf") as suf:
        for f, mark in ((pre, PREFIX_MARK), (suf, SUFFIX_MARK)):
            if f.size() < 8 or f.read_at(4, 0) != mark or f.read_at(4, f.size() - 4) != mark:
                raise ValueError(f"{path}: a marker {mark.decode()} is missing")
        size, suffix_size = pre.size(), suf.size()
        version, header_bytes = struct.unpack("<IB", pre.read_at(5, size - 12)) if size >= 20 else (None, 0)
        if version not in HEADERS:
            raise ValueError(f"{path}: version {version} is not known")
        layout = HEADERS[version]
        if header_bytes < layout.size or header_bytes + 12 > size:
            raise ValueError(f"{path}: the header is damaged")
        values = layout.unpack(pre.read_at(layout.size, size - header_bytes - 8))
    if version == BINNED:
        k, mode, counter, prefix, signature, low, high, total, single_strand = values
        spare = size - 12 - (4 * (4**signature + 1) + header_bytes + 8)
    else:
        k, mode, counter, prefix, low, high, total, single_strand, above = values
        signature, high, spare = 0, high + (above << 32), 8 * 4**prefix
    if mode != 0:
        raise ValueError(f"{path}: counts of mode {mode} are not supported")
    if not 0 <= prefix < k or (k - prefix) % 4:
        raise ValueError(f"{path}: {k} letters with a prefix of {prefix} are not supported")
    if spare < 8 or spare % (8 * 4**prefix) or spare + 12 > size:
        raise ValueError(f"{path}: the table of totals is damaged")
    info = DatabaseInfo(k, mode, counter, prefix, signature, low, high, total, not single_strand, version == BINNED, spare // 8)
    if suffix_size != 8 + total * info.record_bytes:
        raise ValueError(f"{path}: {suffix_size} bytes of records are not those of {total} k-mers")
    return info


def _kmers(prefix: np.ndarray, suffix: np.ndarray, info: DatabaseInfo) -> pa.Array:
    """The text of k-mers from the numbers of their prefixes and the bytes of their suffixes."""
    n, k, p = len(prefix), info.kmer_length, info.prefix_length
    text = np.empty((n, k), np.uint8)
    for at in range(p):
        text[:, at] = LETTERS[(prefix >> (2 * (p - 1 - at))) & 3]
    text[:, p:] = _FOUR[suffix].reshape(n, k - p)
    offsets = np.arange(n + 1, dtype=np.int32) * k
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(text.tobytes())])


def _counts(rows: np.ndarray, info: DatabaseInfo) -> np.ndarray:
    """The counts of whole records; 1 where the format keeps none."""
    count = np.zeros(len(rows), np.int64)
    for byte in range(info.counter_size):
        count |= rows[:, info.suffix_bytes + byte].astype(np.int64) << (8 * byte)
    return count if info.counter_size else count + 1


def _in_range(count: np.ndarray, info: DatabaseInfo, low: int | None, high: int | None) -> np.ndarray:
    ok = np.ones(len(count), bool)
    if info.counter_size:
        ok &= (count >= info.min_count) & (count <= info.max_count)
    if low is not None:
        ok &= count >= low
    return ok if high is None else ok & (count <= high)


def one_length(infos: list[DatabaseInfo]) -> None:
    """ValueError where databases have k-mers of different lengths."""
    if len(lengths := {info.kmer_length for info in infos}) > 1:
        raise ValueError(f"databases have k-mers of different lengths: {sorted(lengths)}")


class _Ranges(InputPartition):
    """Ranges ``(number of the database, first entry, entry behind the last)`` that one task reads."""

    def __init__(self, ranges: list[tuple[int, int, int]]) -> None:
        self.ranges = ranges


class _Reader(DataSourceReader):
    def __init__(self, databases: list[tuple[str | None, str]], low: int | None = None, high: int | None = None) -> None:
        self.databases, self.low, self.high = databases, low, high
        self.infos = [read_info(path) for _, path in databases]
        one_length(self.infos)

    def partitions(self) -> list[_Ranges]:
        """Small files share a task, large ones are read by many."""
        out, held, size = [], [], 0
        for k, info in enumerate(self.infos):
            for at in range(0, info.entries, ENTRIES):
                end = min(at + ENTRIES, info.entries)
                if held and size + end - at > ENTRIES:
                    out.append(_Ranges(held))
                    held, size = [], 0
                held.append((k, at, end))
                size += end - at
        return [*out, _Ranges(held)] if held else out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        for k, first, last in partition.ranges:
            sample, path = self.databases[k]
            for kmer, count in self._records(path, self.infos[k], first, last):
                own, names = [kmer, pa.array(count)], ["kmer", "cnt"]
                if sample is not None:
                    own, names = [pa.repeat(sample, len(count)), *own], ["sample", *names]
                yield pa.RecordBatch.from_arrays(own, names=names)

    def _records(self, path: str, info: DatabaseInfo, first: int, last: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
        with _open(f"{path}.kmc_pre") as pre, _open(f"{path}.kmc_suf") as suf:
            table = _totals(pre, path, info, first, last)
            for at in range(int(table[0]), int(table[-1]), RECORDS):
                stop = min(at + RECORDS, int(table[-1]))
                rows = np.frombuffer(suf.read_at((stop - at) * info.record_bytes, 4 + at * info.record_bytes), np.uint8).reshape(-1, info.record_bytes)
                entry = np.searchsorted(table, np.arange(at, stop), side="right") - 1 + first
                count = _counts(rows, info)
                keep = _in_range(count, info, self.low, self.high)
                if keep.any():
                    yield _kmers(entry[keep] % 4**info.prefix_length, rows[keep][:, : info.suffix_bytes], info), count[keep]


def _totals(pre: pa.NativeFile, path: str, info: DatabaseInfo, first: int, last: int) -> np.ndarray:
    """The running totals of entries ``first`` to ``last``, the one behind them included."""
    n, ends = last - first, last == info.entries
    # The entry after the last is not kept by all writers: it is the total.
    table = np.frombuffer(pre.read_at(8 * (n + (not ends)), 4 + 8 * first), "<u8").astype(np.int64)
    table = np.append(table, info.total_kmers) if ends else table
    if (np.diff(table) < 0).any() or table[-1] > info.total_kmers:
        raise ValueError(f"{path}: the table of totals is damaged")
    return table


class KmerFiles(DataSource):
    """``(kmer, cnt)`` of the database at the option ``path``, the files' name without its ending.

    With ``databases``, a JSON list of samples and paths, ``(sample, kmer, cnt)`` of all of them. ``low`` and ``high``
    narrow the range of counts.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ("sample string, " if "databases" in self.options else "") + "kmer string, cnt long"

    def reader(self, schema: object) -> DataSourceReader:
        named = self.options.get("databases")
        databases = [(None, self.options["path"])] if named is None else [tuple(x) for x in json.loads(named)]
        low, high = (int(self.options[c]) if c in self.options else None for c in ("low", "high"))
        return _Reader(databases, low, high)


def _scan(spark: SparkSession, low: int | None, high: int | None, **options: str) -> DataFrame:
    spark.dataSource.register(KmerFiles)
    bounds = {name: str(x) for name, x in (("low", low), ("high", high)) if x is not None}
    return spark.read.format(FORMAT).options(**options, **bounds).load()


def read_database(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """``(kmer, cnt)`` of a binary database, counts from ``low`` to ``high``."""
    return _scan(spark, low, high, path=path)


def discover_databases(spark: SparkSession, root: str, first: str = "female") -> DataFrame:
    """``(path, grp, sample)`` of the databases under ``root``, by their names; group 1 starts with ``first``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.kmc_pre").load(root)
    path = F.regexp_replace("path", r"\.kmc_pre$", "")
    sample = F.regexp_extract(path, r"([^/]+)$", 1)
    return files.select(path.alias("path"), F.when(sample.startswith(first), 1).otherwise(2).alias("grp"), sample.alias("sample"))


def _found(pre: pa.NativeFile, suf: pa.NativeFile, path: str, info: DatabaseInfo, bins: np.ndarray | None, kmers: list[str], low: int | None, high: int | None) -> list[int | None]:
    """The counts of k-mers, sorted by entry, so that pages of the table and records are read once each."""
    k, p = info.kmer_length, info.prefix_length
    out: list[int | None] = [None] * len(kmers)
    own = [i for i, w in enumerate(kmers) if w is not None and len(w) == k and not set(w) - set("ACGT")]
    if not own:
        return out
    codes = np.frombuffer("".join(kmers[i] for i in own).encode(), np.uint8).reshape(-1, k)
    codes = ((codes >> 1) ^ (codes >> 2)) & 3
    place = (codes[:, :p].astype(np.int64) << (2 * np.arange(p - 1, -1, -1))).sum(1) if p else np.zeros(len(own), np.int64)
    if bins is not None:
        m = info.signature_length
        weights = 2 * np.arange(m - 1, -1, -1)
        mmers = (np.lib.stride_tricks.sliding_window_view(codes, m, axis=1).astype(np.int64) << weights).sum(2)
        place += bins[normalised_table(m)[mmers].min(1)].astype(np.int64) * 4**p
    suffix = np.bitwise_or.reduce(codes[:, p:].reshape(len(own), -1, 4) << np.array([6, 4, 2, 0], np.uint8), axis=2)
    page, table, entry, rows, keys = None, None, None, None, None
    for i in np.argsort(place, kind="stable").tolist():
        at = int(place[i])
        if at >= info.entries:
            continue
        if at // PAGE != page:
            page = at // PAGE
            table = _totals(pre, path, info, page * PAGE, min((page + 1) * PAGE, info.entries))
        if at != entry:
            entry = at
            start, stop = (int(x) for x in table[at - page * PAGE : at - page * PAGE + 2])
            rows = np.frombuffer(suf.read_at((stop - start) * info.record_bytes, 4 + start * info.record_bytes), np.uint8).reshape(-1, info.record_bytes)
            keys = np.ascontiguousarray(rows[:, : info.suffix_bytes]).view(f"S{info.suffix_bytes}").ravel()
        asked = suffix[i].tobytes().rstrip(b"\0")
        found = int(np.searchsorted(keys, asked))
        if found < len(keys) and keys[found] == asked:
            count = _counts(rows[found : found + 1], info)
            if _in_range(count, info, low, high)[0]:
                out[own[i]] = int(count[0])
    return out


def find_kmers(probe: DataFrame, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """``probe (kmer, ...)`` with ``cnt``, null where the database has no such k-mer within the range of counts.

    k-mers are taken as given, in capitals. They are sorted first, so that a task reads neighbouring records; a database's
    other records are not read.
    """
    info = read_info(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _open(f"{path}.kmc_pre") as pre, _open(f"{path}.kmc_suf") as suf:
            bins = np.frombuffer(pre.read_at(4 * (4**info.signature_length + 1), 4 + 8 * info.entries + 8), "<u4") if info.binned else None
            for batch in batches:
                counts = _found(pre, suf, path, info, bins, batch.column(0).to_pylist(), low, high)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["kmer", "cnt"])

    asked = probe.select("kmer").distinct().repartitionByRange("kmer").sortWithinPartitions("kmer")
    return probe.join(asked.mapInArrow(run, "kmer string, cnt long"), "kmer", "left")


def database_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row of header facts per database."""
    rows = [{"path": p, **asdict(read_info(p))} for p in paths]
    return spark.createDataFrame(rows, "path string, kmer_length int, mode int, counter_size int, prefix_length int, signature_length int, min_count long, max_count long, total_kmers long, both_strands boolean, binned boolean, entries long")


def read_databases(spark: SparkSession, samples: dict[str, str], low: int | None = None, high: int | None = None) -> DataFrame:
    """``(sample, kmer, cnt)`` of the databases of many samples, in one scan; all must have k-mers of one length."""
    one_length([read_info(path) for path in samples.values()])
    named = sorted(samples.items(), key=lambda x: natural_key(x[0]))
    return _scan(spark, low, high, databases=json.dumps(named))
