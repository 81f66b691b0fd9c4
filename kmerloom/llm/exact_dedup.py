"""Exact duplicates by counting quotient filters.

1. Every text, with A-Z in lower case, gets a 64-bit fingerprint. Each task counts its fingerprints in counting quotient
   filters, one for each shard of the fingerprints' leading bits: the next bits (the quotient) name a slot, the rest (the
   remainder) stand in it or behind it, sorted, and a count above one takes a slot of its own.
2. The filters of a shard are read in the order of their remainders and merge into one without loss. Shards have about
   ``SHARD`` fingerprints, copies included, however many tasks there are.
3. Fingerprints with a count above one route their documents to verification by bytes: Spark groups the whole texts, after
   one partial group in each task, so that a very common text crosses the network once a task.
4. What a group decides goes back to its documents by fingerprint and SHA-256, without the texts.

Repeated fingerprints are broadcast up to ``BROADCAST_ROWS`` of them (two numbers a row) and joined beyond that.

Defined cases: a null text counts as empty, and empty texts are equal; rows that repeat a text are copies, also under one
doc_id, and where the largest doc_id of a group stands on several rows all of these are marked as kept; a null doc_id is
smaller than any other, and a group with null ids only keeps null; texts of any length are compared whole; columns other
than doc_id and text are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHARD = 1 << 17
LEAST_SHARDS = 64
PIECE = 1 << 20
BROADCAST_ROWS = 500_000
HEADER = struct.Struct("<BBIQ")


@dataclass(frozen=True)
class CountingQuotientFilter:
    """A multiset of numbers below ``2 ** bits``, by quotient (the high bits) and remainder.

    ``occupied`` has a bit for each quotient, ``run_end`` one for the last slot of each quotient's run, ``counter`` one for
    slots that hold the count of the remainder before them. A run starts at its quotient's slot or behind the run before.
    """

    bits: int
    quotient_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    counter: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """From distinct values in ascending order and their counts."""
        wide = np.where(counts > 1, 2, 1)
        quotient_bits = min(bits, max(1, int(wide.sum()).bit_length()))
        shift = np.uint64(bits - quotient_bits)
        home = (values >> shift).astype(np.int64)
        before = np.cumsum(wide) - wide
        start = before + np.maximum.accumulate(home - before) if len(home) else before
        size = max(1 << quotient_bits, int(start[-1] + wide[-1]) if len(start) else 0)
        occupied, run_end, counter, slots = np.zeros(1 << quotient_bits, bool), np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.uint64)
        occupied[home] = True
        slots[start] = values & ((np.uint64(1) << shift) - np.uint64(1))
        many = counts > 1
        counter[start[many] + 1] = True
        slots[start[many] + 1] = counts[many].astype(np.uint64)
        last = np.r_[home[1:] != home[:-1], True] if len(home) else np.zeros(0, bool)
        run_end[(start + wide - 1)[last]] = True
        return cls(bits, quotient_bits, occupied, run_end, counter, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values in ascending order, and their counts."""
        quotient, end = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        start = np.maximum(quotient, np.r_[0, end[:-1] + 1]) if len(end) else end
        size = end - start + 1
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        of = np.repeat(quotient, size)
        own = ~self.counter[at]
        followed = np.r_[self.counter[at][1:], False][own] if len(at) else own
        counts = np.ones(int(own.sum()), np.int64)
        counts[followed] = self.slots[at[own][followed] + 1].astype(np.int64)
        shift = np.uint64(self.bits - self.quotient_bits)
        return (of[own].astype(np.uint64) << shift) | self.slots[at[own]], counts

    def to_bytes(self) -> bytes:
        flags = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)]
        return HEADER.pack(self.bits, self.quotient_bits, len(self.slots), int(self.slots.any())) + b"".join(flags) + self.slots.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, quotient_bits, n, _ = HEADER.unpack_from(data)
        at, flags = HEADER.size, []
        for size in (1 << quotient_bits, n, n):
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(bits, quotient_bits, *flags, np.frombuffer(data, "<u8", n, at))


def merged(filters: Iterable[CountingQuotientFilter]) -> CountingQuotientFilter:
    """One filter with the counts of all: their values come sorted, so that the sort only merges runs."""
    filters = list(filters)
    values, counts = (np.concatenate(x) for x in zip(*(f.items() for f in filters), strict=True))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
    return CountingQuotientFilter.of(values[first], np.add.reduceat(counts, first) if len(first) else counts, filters[0].bits)


def normalised(text: str = "text") -> Column:
    """The text with A-Z in lower case; null is empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, UPPER.lower()))


def repeated_fingerprints(prints: DataFrame, shards: int) -> DataFrame:
    """``(fp, n)`` of the fingerprints ``fp`` that more than one row of ``prints`` has; ``shards`` is a power of two."""
    lead = shards.bit_length() - 1
    bits = 64 - lead
    low = np.uint64((1 << bits) - 1)
    out = pa.schema([("shard", pa.int32()), ("filter", pa.binary())])

    def filters(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        shard = (values >> np.uint64(bits)).astype(np.int64) if lead else np.zeros(len(values), np.int64)
        own, start = np.unique(shard, return_index=True)
        blobs = [CountingQuotientFilter.of(values[a:b] & low, counts[a:b], bits).to_bytes() for a, b in zip(start, [*start[1:], len(values)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(blobs, pa.binary())], schema=out)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += batch.num_rows
            if size >= PIECE:
                yield filters(held)
                held, size = [], 0
        if size:
            yield filters(held)

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values, counts = merged(map(CountingQuotientFilter.from_bytes, pdf["filter"])).items()
        many = counts > 1
        prefix = np.uint64((int(key[0]) << bits) & ((1 << 64) - 1)) if lead else np.uint64(0)
        return pd.DataFrame({"fp": (values[many] | prefix).view(np.int64), "n": counts[many]})

    return prints.select("fp").mapInArrow(build, "shard int, filter binary").groupBy("shard").applyInPandas(merge, "fp long, n long")


def exact_duplicates(docs: DataFrame, shard: int = SHARD, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(doc_id, keep_id, group_size, text_sha256)`` for every row of ``docs (doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("text"))
    rows = rows.withColumn("fp", F.xxhash64("text"))
    prints = common.written(rows.select("doc_id", "fp", F.unhex(F.sha2("text", 256)).alias("sha")), "prints")
    shards = max(LEAST_SHARDS, 1 << (-(-prints.count() // shard)).bit_length())
    repeated = common.written(repeated_fingerprints(prints, shards), "repeated").select("fp")
    side = F.broadcast(repeated) if repeated.count() <= broadcast_rows else repeated
    groups = rows.join(side, "fp", "left_semi").groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    verified = common.written(groups.where("group_size > 1").select("fp", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"), "verified")
    found = prints.join(verified, ["fp", "sha"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    lost = exact_duplicates(docs).where("not doc_id <=> keep_id").select(F.col("doc_id").alias("_lost"), F.unhex("text_sha256").alias("_sha"))
    own = docs.select(F.struct(*[common.column(c) for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("_id"), F.unhex(F.sha2(normalised(), 256)).alias("_own"))
    kept = own.join(lost.distinct(), F.col("_id").eqNullSafe(F.col("_lost")) & (F.col("_own") == F.col("_sha")), "left_anti")
    return kept.select("doc.*")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group, its size, the row that stays, and the hash of its text."""
    found = exact_duplicates(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
