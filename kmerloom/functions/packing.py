"""Packed windows of whole batches of reads, with numpy inside Spark tasks.

A window becomes two bits a base, first base highest, so that numbers sort as strings do. All windows of a batch are packed
at once by doubling: windows of 2m bases are two neighbouring windows of m. In JVM expressions each window is a string of
its own (cut, checked, reversed, translated, compared), which took about fifteen times the CPU time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_K = 31
CHUNK = 1 << 16
FLUSH_ROWS = 1 << 17
INVALID = 4
_CODES = np.full(256, INVALID, np.uint8)
for _code, _letters in enumerate((b"Aa", b"Cc", b"Gg", b"Tt")):
    _CODES[list(_letters)] = _code


def packed_windows(symbols: np.ndarray, k: int, both_strands: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The packed (canonical) k-mer at each position of the bytes ``symbols``, and whether it has the four bases only."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, bool)
    codes = _CODES[symbols]
    bad = np.concatenate(([0], np.cumsum(codes == INVALID, dtype=np.int32)))
    ok = bad[k:] == bad[:-k]
    one = (codes & 3).astype(np.int64)
    forward, backward = _joined(one, k, n, True), None
    if both_strands:
        backward = _joined(one ^ 3, k, n, False)
        forward = np.minimum(forward, backward, out=forward)
    return forward, ok


def _joined(one: np.ndarray, k: int, n: int, first_high: bool) -> np.ndarray:
    """Windows of ``k`` symbols from windows of 1, 2, 4, ... symbols."""
    out, width, at, size = None, 0, one, 1
    while True:
        if k & size:
            # The part so far covers the first ``width`` symbols.
            if out is None:
                out = at[:n].copy() if size == k else at[: n + k - size].copy()
            else:
                right = at[width : width + n + k - width - size]
                left = out[: len(right)]
                out = (left << (2 * size)) | right if first_high else left | (right << (2 * width))
            width += size
        if width == k:
            return out[:n]
        at = (at[:-size] << (2 * size)) | at[size:] if first_high else at[:-size] | (at[size:] << (2 * size))
        size *= 2


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the rows' offsets in them; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize) if len(column) else np.zeros(1, kind)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets.astype(np.int64)


def _groups(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A first row of each group of equal rows, and every row's group."""
    code = np.zeros(n, np.int64)
    for column in columns:
        indices = pc.fill_null(column.dictionary_encode(null_encoding="encode").indices, 0).to_numpy(zero_copy_only=False)
        _, code = np.unique(code * (int(indices.max(initial=0)) + 1) + indices, return_inverse=True)
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    return first, group


def _chunks(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The rows' symbols, rows parted by an invalid one, in pieces of about ``CHUNK`` windows; no window is in two pieces."""
    gap = np.zeros(1, np.uint8)
    held: list[np.ndarray] = []
    size = 0
    for r in rows.tolist():
        start, end = offsets[r], offsets[r + 1]
        if end - start < k:
            continue
        for at in range(start, end - k + 1, CHUNK):
            piece = data[at : min(end, at + CHUNK + k - 1)]
            held += [piece, gap]
            size += len(piece)
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def counted_batches(batches: Iterator[pa.RecordBatch], k: int, both_strands: bool) -> Iterator[pa.RecordBatch]:
    """``(keys ..., kmer, cnt)`` of batches ``(keys ..., seq)``: k-mers counted within pieces of a batch."""
    for batch in batches:
        *keys, seq = batch.columns
        names = [*batch.schema.names[:-1], "kmer", "cnt"]
        if not batch.num_rows:
            continue
        data, offsets = _bytes_of(seq)
        first, group = _groups(keys, batch.num_rows)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(len(first) + 1))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(keys: list[pa.Array] = keys, names: list[str] = names) -> pa.RecordBatch:
            row, kmer, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            at = pa.array(row)
            return pa.RecordBatch.from_arrays([*(c.take(at) for c in keys), pa.array(kmer), pa.array(n)], names=names)

        for g, row in enumerate(first):
            for symbols in _chunks(data, offsets, order[bounds[g] : bounds[g + 1]], k):
                values, ok = packed_windows(symbols, k, both_strands)
                values = values[ok]
                if k <= 10:
                    n = np.bincount(values, minlength=1)
                    kmer = np.flatnonzero(n)
                    n = n[kmer]
                else:
                    kmer, n = np.unique(values, return_counts=True)
                held.append((np.full(len(kmer), row), kmer.astype(np.int64), n.astype(np.int64)))
                size += len(kmer)
                if size >= FLUSH_ROWS:
                    yield flush()
                    size = 0
        if held:
            yield flush()


def placed_batches(batches: Iterator[pa.RecordBatch], k: int, both_strands: bool, null: bool = False) -> Iterator[pa.RecordBatch]:
    """``(key, pos, kmer)`` of batches ``(key, seq)``: one row per window.

    Windows with other symbols get negative numbers, which differ, so that no join meets them as one key, or ``null``.
    """
    for batch in batches:
        key, seq = batch.columns
        data, offsets = _bytes_of(seq)
        names = [batch.schema.names[0], "pos", "kmer"]
        for r in range(batch.num_rows):
            start, end = int(offsets[r]), int(offsets[r + 1])
            for at in range(start, end - k + 1, CHUNK):
                values, ok = packed_windows(data[at : min(end, at + CHUNK + k - 1)], k, both_strands)
                pos = np.arange(at - start, at - start + len(values), dtype=np.int64)
                if not null:
                    values[~ok] = -1 - pos[~ok]
                kmer = pa.array(values, mask=~ok if null else None)
                yield pa.RecordBatch.from_arrays([key.take(pa.array(np.full(len(values), r))), pa.array(pos.astype(np.int32)), kmer], names=names)
