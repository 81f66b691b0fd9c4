"""Hashed n-gram features, computed with numpy inside Spark tasks."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np

PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
CHUNK = 1 << 20


def _slots(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h + np.uint64(salt)) * MIX
        h ^= h >> np.uint64(32)
        return ((h * PRIME) >> np.uint64(64 - bits)).astype(np.int64)


def _grams(codes: np.ndarray, n: int, salt: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = codes[: len(codes) - n + 1].astype(np.uint64)
        for k in range(1, n):
            h = h * PRIME + codes[k : len(codes) - n + 1 + k]
    return _slots(h, salt, bits)


def char_slots(text: str, sizes: Iterable[int], bits: int) -> Iterator[np.ndarray]:
    """Slots of all character n-grams of a whole text, in pieces of bounded length."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = list(sizes)
    for at in range(0, len(codes), CHUNK):
        for n in sizes:
            piece = codes[at : at + CHUNK + n - 1]
            if len(piece) >= n:
                yield _grams(piece, n, n, bits)


def word_slots(words: list[bytes], sizes: Iterable[int], bits: int) -> Iterator[np.ndarray]:
    """Slots of all word n-grams."""
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    for n in sizes:
        if len(codes) >= n:
            yield _grams(codes, n, 100 + n, bits)


def counted(slots: Iterable[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and how often each occurs."""
    slots = list(slots)
    if sum(map(len, slots)) < 1 << (bits - 3):
        return np.unique(np.concatenate(slots) if slots else np.empty(0, np.int64), return_counts=True)
    total = np.zeros(1 << bits, np.int64)
    for s in slots:
        total += np.bincount(s, minlength=1 << bits)
    at = np.flatnonzero(total)
    return at, total[at]
