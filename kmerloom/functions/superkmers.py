"""Super-k-mers with numpy inside Spark tasks: stretches of reads whose k-mers have one bin.

A k-mer's signature is the smallest normalised m-mer in it, the same for both strands; signatures are dealt to bins. A
stretch of n k-mers is n + k - 1 bases, four to a byte, where its k-mers on their own are eight bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from .packing import _CODES, INVALID, MAX_K, _bytes_of, _chunks, _groups, _joined

MAX_PAIR = 63
LOW = 32
TURN = np.uint64(1 << 63)
FLUSH_KMERS = 1 << 22
COUNT_KMERS = 1 << 21
_SHIFTS = np.array([6, 4, 2, 0], np.uint8)


@cache
def normalised_table(m: int) -> np.ndarray:
    """The normalised value of every packed m-mer; see ``signatures.normalised``."""
    values = np.arange(4**m)
    d = (values[:, None] >> (2 * np.arange(m - 1, -1, -1))) & 3
    a, c, g, t = range(4)
    refused = ((d[:, -3] == t) & ((d[:, -2] == t) | (d[:, -2] == g) & (d[:, -1] == t))) | ((d[:, 1:-1] == a) & (d[:, 2:] == a)).any(1)
    refused |= (d[:, 0] == a) & ((d[:, 1] == a) | (d[:, 1] == c)) & (d[:, 2] == a)
    other = ((3 - d) << (2 * np.arange(m))).sum(1)
    own = np.where(refused, 4**m, values)
    return np.minimum(own, own[other]).astype(np.int32)


def signatures(codes: np.ndarray, k: int, m: int) -> np.ndarray:
    """The signature of the k-mer at each position of base codes."""
    low = normalised_table(m)[_joined(codes, m, len(codes) - m + 1, True)]
    width, size = k - m + 1, 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(codes) - k + 1], low[width - size : width - size + len(codes) - k + 1])


def stretches(symbols: np.ndarray, k: int, m: int, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, number of k-mers, bytes, packed bases)`` of the stretches of valid k-mers in the bytes ``symbols``."""
    codes = _CODES[symbols]
    bad = np.concatenate(([0], np.cumsum(codes == INVALID, dtype=np.int32)))
    one = (codes & 3).astype(np.int64)
    own = (signatures(one, k, m).astype(np.uint32) * np.uint32(2654435761) >> np.uint32(7)).astype(np.int64) % bins
    own[bad[k:] != bad[:-k]] = -1
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    n = np.diff(np.r_[start, len(own)])
    keep = own[start] >= 0
    start, n = start[keep], n[keep]
    size = (n + k + 2) // 4
    at = np.repeat(start - 4 * (np.cumsum(size) - size), 4 * size) + np.arange(4 * size.sum())
    four = (codes & 3)[np.minimum(at, len(codes) - 1)].reshape(-1, 4)
    return own[start], n, size, np.bitwise_or.reduce(four << _SHIFTS, axis=1)


def cut_batches(batches: Iterator[pa.RecordBatch], k: int, m: int, bins: int) -> Iterator[pa.RecordBatch]:
    """``(keys ..., bin, n, sizes, bases)`` of batches ``(keys ..., seq)``: one row for the stretches of a bin."""
    for batch in batches:
        *keys, seq = batch.columns
        names = [*batch.schema.names[:-1], "bin", "n", "sizes", "bases"]
        if not batch.num_rows:
            continue
        data, offsets = _bytes_of(seq)
        first, group = _groups(keys, batch.num_rows)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(len(first) + 1))
        for g, row in enumerate(first):
            held, size = [], 0

            def flush(row: int = int(row), keys: list[pa.Array] = keys, names: list[str] = names, held: list = held) -> pa.RecordBatch:
                own, n, size, packed = (np.concatenate(c) for c in zip(*held, strict=True))
                by = np.argsort(own, kind="stable")
                start = (np.cumsum(size) - size)[by]
                own, n, size = own[by], n[by], size[by]
                packed = packed[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                ends = np.flatnonzero(np.r_[own[1:] != own[:-1], True]) + 1
                starts = np.r_[0, ends[:-1]]
                places = np.r_[0, np.cumsum(size)]
                sizes, bases = n.astype("<u4"), packed.tobytes()
                at = pa.array(np.full(len(ends), row))
                cells = [pa.array(own[starts].astype(np.int32)), pa.array(np.add.reduceat(n, starts).astype(np.int64))]
                cells.append(pa.array([sizes[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()))
                cells.append(pa.array([bases[places[a] : places[b]] for a, b in zip(starts, ends, strict=True)], pa.binary()))
                return pa.RecordBatch.from_arrays([*(c.take(at) for c in keys), *cells], names=names)

            for symbols in _chunks(data, offsets, order[bounds[g] : bounds[g + 1]], k):
                found = stretches(symbols, k, m, bins)
                if len(found[0]):
                    held.append(found)
                    size += int(found[1].sum())
                if size >= FLUSH_KMERS:
                    yield flush()
                    held.clear()
                    size = 0
            if held:
                yield flush()


def expanded(n: np.ndarray, bases: np.ndarray, k: int, both_strands: bool) -> tuple[np.ndarray, ...]:
    """The packed (canonical) k-mers of stretches of ``n`` k-mers, in order: one number each, or two beyond 31 bases."""
    codes = ((bases[:, None] >> _SHIFTS) & 3).ravel().astype(np.int64)
    size = 4 * ((n + k + 2) // 4)
    at = np.repeat((np.cumsum(size) - size) - (np.cumsum(n) - n), n) + np.arange(n.sum())
    total = len(codes) - k + 1
    if k > MAX_K:
        return pair_windows(codes, k, total, at, both_strands)
    values = _joined(codes, k, total, True)[at]
    return (np.minimum(values, _joined(codes ^ 3, k, total, False)[at]) if both_strands else values,)


def pair_windows(codes: np.ndarray, k: int, total: int, at: np.ndarray, both_strands: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(high, low)`` of the k-mers of 32 to 63 bases at places ``at``: the last 32 bases are low, so that pairs sort as strings do.

    All 64 bits of ``low`` count; its first bit is turned, so that signed numbers have the order of unsigned ones.
    """
    lead = k - LOW

    def part(own: np.ndarray, start: int, width: int, first_high: bool) -> np.ndarray:
        return _joined(own[start:], width, total, first_high)[at] if width else np.zeros(len(at), np.int64)

    high, low = part(codes, 0, lead, True), part(codes, lead, LOW, True).view(np.uint64)
    if both_strands:
        other = codes ^ 3
        high2, low2 = part(other, LOW, lead, False), part(other, 0, LOW, False).view(np.uint64)
        less = (high2 < high) | (high2 == high) & (low2 < low)
        high, low = np.where(less, high2, high), np.where(less, low2, low)
    return high, (low ^ TURN).view(np.int64)


def distinct(columns: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct rows in ascending order, and how often each occurs."""
    if len(columns) == 1:
        values, n = np.unique(columns[0], return_counts=True)
        return (values,), n
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    first = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]) if len(order) else order
    return tuple(c[first] for c in columns), np.diff(np.r_[first, len(order)])


def counted_stretches(batches: Iterator[pa.RecordBatch], k: int, both_strands: bool, min_count: int, n_keys: int) -> Iterator[pa.RecordBatch]:
    """``(keys ..., kmer, cnt)``, or ``high`` and ``low`` for longer k-mers, of rows ``(keys ..., bin, part, n, sizes, bases)`` sorted by keys, bin and part.

    A k-mer has one bin, so that what is held between two bins is counted whole, and ``min_count`` holds for it.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).combine_chunks() for c in range(n_keys)]
        first, group = _groups(keys, len(table)) if keys else (np.zeros(1, np.int64), np.zeros(len(table), np.int64))
        sizes, bases = table.column("sizes").to_pylist(), table.column("bases").to_pylist()
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(len(first) + 1))
        names = [*table.schema.names[:n_keys], *(("kmer",) if k <= MAX_K else ("high", "low")), "cnt"]
        for g, row in enumerate(first):
            own = order[bounds[g] : bounds[g + 1]].tolist()
            n = np.frombuffer(b"".join(sizes[r] for r in own), "<u4").astype(np.int64)
            kmers, cnt = distinct(expanded(n, np.frombuffer(b"".join(bases[r] for r in own), np.uint8), k, both_strands))
            keep = cnt >= min_count
            if keep.any():
                at = pa.array(np.full(int(keep.sum()), row))
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in keys), *(pa.array(c[keep]) for c in kmers), pa.array(cnt[keep].astype(np.int64))], names=names)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        # Places where a bin ends: only there may a count end as well.
        bins = [batch.column(c) for c in range(n_keys + 2)]
        _, code = _groups(bins, batch.num_rows)
        total = np.cumsum(batch.column(n_keys + 2).to_numpy())
        at = 0
        for row in np.flatnonzero(np.r_[False, code[1:] != code[:-1]]).tolist():
            if size + total[row - 1] - (total[at - 1] if at else 0) >= COUNT_KMERS:
                held.append(batch.slice(at, row - at))
                yield from flush()
                held, size, at = [], 0, row
        head = [c[0].as_py() for c in bins]
        if held and at == 0 and size >= COUNT_KMERS and head != last:
            yield from flush()
            held, size = [], 0
        held.append(batch.slice(at))
        size += int(total[-1] - (total[at - 1] if at else 0))
        last = [c[-1].as_py() for c in bins]
    if held:
        yield from flush()
