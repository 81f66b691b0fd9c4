"""Suffix arrays of many short byte runs, with numpy: Larsson-Sadakane refinement, Kasai's common prefixes, merging."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def words_at(data: bytes) -> np.ndarray:
    """The eight bytes from each position on as a little-endian number; zeros follow the end."""
    n = len(data)
    out = np.empty(n, np.uint64)
    padded = data + b"\0" * 8
    for o in range(min(8, n)):
        out[o::8] = np.frombuffer(padded, "<u8", (n - o + 7) // 8, o)
    return out


@dataclass
class Runs:
    """Runs laid end to end, each followed by a separator that is smaller than any byte and unlike any other separator."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray  # of the bytes; the separator stands there

    @classmethod
    def of(cls, runs: list[bytes]) -> Runs:
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        ends = np.cumsum(lengths + 1) - 1
        return cls(b"\0".join(runs) + b"\0", ends - lengths, ends)


def suffix_array(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of all positions, separators included."""
    n, r = len(runs.data), len(runs.ends)
    words = words_at(runs.data)
    run_of = np.repeat(np.arange(r), runs.ends - runs.starts + 1)
    left = runs.ends[run_of] - np.arange(n)  # symbols before the separator
    short = left < 8
    # Bytes from the separator on count as zeros; a suffix that ends there sorts before one that goes on with zeros.
    head = words.copy()
    cut = left[short].astype(np.uint64) * np.uint64(8)
    head[short] &= (np.uint64(1) << cut) - np.uint64(1)
    head = head.byteswap()
    tail = np.where(short, left * r + run_of, 8 * r)
    order = np.lexsort((tail, head))
    new = np.r_[True, (head[order[1:]] != head[order[:-1]]) | (tail[order[1:]] != tail[order[:-1]])]
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    open_ = slots[~(new & np.r_[new[1:], True])]
    h = 8
    while len(open_):
        at = order[open_]
        key = rank[at] * n + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~(new & np.r_[new[1:], True])]
        h *= 2
    return order, rank


def common_prefixes(runs: Runs, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the suffix array, by position; separators match nothing.

    Kasai's rule in bulk: where the bytes before a suffix and before its predecessor agree, its common prefix is that of
    the position before less one. Only the other positions are compared, eight bytes at a time.
    """
    n = len(runs.data)
    text = np.frombuffer(runs.data, np.uint8)
    mark = np.zeros(n + 1, bool)
    mark[runs.ends] = True
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    at = np.arange(n)
    follows = (at > 0) & (before > 0)
    k = at[follows]
    follows[k] = (text[k - 1] == text[before[k] - 1]) & ~mark[k - 1] & ~mark[before[k] - 1]
    lead = np.flatnonzero(~follows)
    length = np.zeros(n, np.int64)
    run_of = np.repeat(np.arange(len(runs.ends)), runs.ends - runs.starts + 1)
    ends = runs.ends[run_of]
    words = words_at(runs.data)
    lead = lead[before[lead] >= 0]
    other = before[lead]
    most = np.minimum(ends[lead] - lead, ends[other] - other)
    done = 0
    while len(lead):
        x = words[np.minimum(lead + done, n - 1)] ^ words[np.minimum(other + done, n - 1)]
        # Equal low bytes of the eight.
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, (np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64)) >> 3)
        length[lead] = np.minimum(done + same, most)
        on = (same == 8) & (done + 8 < most)
        lead, other, most = lead[on], other[on], most[on]
        done += 8
    source = np.maximum.accumulate(np.where(follows, 0, at))
    return np.where(follows, length[source] - (at - source), length)


def sorted_windows(runs: Runs, order: np.ndarray, size: int) -> np.ndarray:
    """Positions of the windows of ``size`` bytes that lie within a run, in suffix order."""
    run_of = np.repeat(np.arange(len(runs.ends)), runs.ends - runs.starts + 1)
    return order[runs.ends[run_of[order]] - order >= size]


def later_windows(runs: Runs, size: int) -> tuple[np.ndarray, np.ndarray]:
    """True at each position whose window of ``size`` bytes also starts earlier in these runs; windows in suffix order."""
    order, _ = suffix_array(runs)
    prefix = common_prefixes(runs, order)
    windows = sorted_windows(runs, order, size)
    later = np.zeros(len(runs.data), bool)
    if len(windows):
        new = prefix[windows] < size
        new[0] = True
        first = np.minimum.reduceat(windows, np.flatnonzero(new))
        later[windows] = windows != first[np.cumsum(new) - 1]
    return later, windows


def later_rows(groups: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """True where an earlier row has the same group and window: each is looked up by binary search in the merged windows."""
    merged = np.unique(windows)
    entry = np.searchsorted(merged, windows)
    _, first = np.unique(np.stack([groups, entry], 1), axis=0, return_index=True)
    later = np.ones(len(windows), bool)
    later[first] = False
    return later


def covered(later: np.ndarray, runs: Runs, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run number, start and end in the run of each maximal stretch of bytes under the marked windows."""
    at = np.flatnonzero(later)
    if not len(at):
        return at, at, at
    run = np.searchsorted(runs.ends, at)
    new = np.r_[True, (at[1:] - at[:-1] > size) | (run[1:] != run[:-1])]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]
    first = np.flatnonzero(new)
    base = runs.starts[run[first]]
    return run[first], at[first] - base, at[last] + size - base
