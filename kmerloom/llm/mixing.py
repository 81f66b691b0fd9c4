"""Mixing sources to target weights.

Each source's words are packed into blocks of a fixed number of words, in a fixed pseudorandom order of its documents; its
last block may be shorter. Blocks have ``block_words`` words, or less for a source too small to have ``MIN_BLOCKS`` of
them, so that small sources meet their targets as well. A source's target is its share of all words by weight; no target
exceeds ``max_repeats`` times the source, and what is above goes to the other sources by weight.

The mix is dealt into output shards of about ``shard_slots`` slots. A shard's counts of slots by source are multinomial,
given what the targets leave: a tree halves the shards, and at each node each source's slots go left or right by a
binomial draw, keyed by the node. A task draws the path to its own shard, so that totals are exact and nothing but one row
per source is planned on the driver. A source's slots are numbered over the shards; slot ``k`` takes block
``perm(k mod n)`` of the source's ``n`` blocks, where ``perm`` is a keyed pseudorandom permutation for each pass over the
source. Slots and blocks are then joined by source and block number. No block is taken more often than ``max_repeats``
times, and reruns give the same mix.

The words of documents before each document are found in two steps: sums of chunks of documents by hash, then a running
sum inside each chunk, so that no source is gathered in one task.

Defined cases: a null text has no words; a null source is a source of its own, the last one; empty tables and tables
without words give a mix without blocks; repeated rows are documents of their own; documents of any length are cut into
blocks like others; other columns keep their names and values.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SPACE = "[\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 64
MIN_BLOCKS = 64
SHARD_SLOTS = 1 << 13
PIECE_SLOTS = 1 << 16
SMALL_PLANS = 100_000
CHUNK_WORDS = 500
SEED = 20_240


def word_count(text) -> F.Column:
    """Words of a text: maximal runs of characters other than ASCII white space."""
    trimmed = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def targets(sizes: list[int], weights: list[float], max_repeats: float = MAX_REPEATS) -> list[float]:
    """Words by weight; what is above ``max_repeats`` times a source goes to the others by weight until none is above."""
    left, by_weight, out = float(sum(sizes)), float(sum(weights)), [0.0] * len(sizes)
    # The first to be full is the one with the least room for its weight.
    order = sorted(range(len(sizes)), key=lambda k: sizes[k] / weights[k])
    for at, k in enumerate(order):
        if left * weights[k] / by_weight <= max_repeats * sizes[k]:
            for j in order[at:]:
                out[j] = left * weights[j] / by_weight
            break
        out[k] = float(max_repeats * sizes[k])
        left, by_weight = left - out[k], by_weight - weights[k]
    return out


@dataclass(frozen=True)
class SourcePlan:
    number: int
    source: str | None
    size: int
    block_words: int
    blocks: int
    target: float
    slots: int


def plan_sources(sized: DataFrame, block_words: int, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> list[SourcePlan]:
    """One plan per source, in code-point order with null last."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(((r["source"], int(r["size"])) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([n for _, n in rows], [float(weights[k % len(weights)]) for k in range(len(rows))], max_repeats)
    plans = []
    for k, ((source, size), target) in enumerate(zip(rows, goal, strict=True)):
        words = max(1, min(block_words, size // MIN_BLOCKS))
        blocks = -(-size // words)
        slots = min(round(target * blocks / size), max_repeats * blocks) if size else 0
        plans.append(SourcePlan(k, source, size, words, blocks, target, slots))
    return plans


def shard_depth(slots: list[int], shard_slots: int = SHARD_SLOTS) -> int:
    """Halvings that bring all slots down to shards of at most about ``shard_slots``."""
    return max(0, -(-sum(slots) // shard_slots) - 1).bit_length()


def shard_counts(slots: list[int], shard: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in a shard, and in all shards before it."""
    left, before = np.array(slots, np.int64), np.zeros(len(slots), np.int64)
    for level in range(depth):
        node = shard >> (depth - level)
        half = np.random.default_rng((seed, level, node)).binomial(left, 0.5)
        if shard >> (depth - level - 1) & 1:
            before, left = before + half, left - half
        else:
            left = half
    return left, before


def permuted(k: np.ndarray, n: int, key: str) -> np.ndarray:
    """A keyed permutation of ``range(n)`` at ``k``: a four-round Feistel network over the next power of four, walked."""
    if n <= 1:
        return np.zeros_like(k)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little") | 1) for r in range(4)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        with np.errstate(over="ignore"):
            for r in rounds:
                f = (right + r) * np.uint64(0x9E3779B97F4A7C15)
                f ^= f >> np.uint64(29)
                f = (f * r) >> np.uint64(17)
                left, right = right, left ^ (f & mask)
        return left << np.uint64(half) | right

    out = once(k.astype(np.uint64))
    while (outside := np.flatnonzero(out >= n)).size:
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def mix_slots(spark: SparkSession, plans: list[SourcePlan], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``(shard, source_no, block, pass_no)``: one row per slot of the mix, made in tasks from one number per shard."""
    slots, blocks = [p.slots for p in plans], [p.blocks for p in plans]
    depth = shard_depth(slots, shard_slots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                counts, before = shard_counts(slots, int(shard), depth, seed)
                for s in np.flatnonzero(counts):
                    # A shard may be larger than planned for, if slots are few: it goes out in pieces.
                    for at in range(0, int(counts[s]), PIECE_SLOTS):
                        k = before[s] + np.arange(at, min(at + PIECE_SLOTS, int(counts[s])))
                        turn = k // blocks[s]
                        block = np.empty_like(k)
                        for t in np.unique(turn):
                            block[turn == t] = permuted(k[turn == t] % blocks[s], blocks[s], f"{seed}/{s}/{t}")
                        yield pd.DataFrame({"shard": shard, "source_no": s, "block": block, "pass_no": turn})

    tasks = min(1 << depth, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # Spark takes this table for as small as its one row per shard; it must not be broadcast.
    return spark.range(0, 1 << depth, 1, tasks).mapInPandas(run, "shard long, source_no int, block long, pass_no long").hint("shuffle_merge")


def plan_table(spark: SparkSession, plans: list[SourcePlan]) -> DataFrame:
    """One row per source; broadcast where they are few."""
    rows = spark.createDataFrame([(p.source, p.number, p.block_words, p.size, p.target) for p in plans], "plan_source string, source_no int, block_words long, source_size long, target double")
    return F.broadcast(rows) if len(plans) <= SMALL_PLANS else rows


def placed(sized: DataFrame, plans: list[SourcePlan], row: tuple[str, ...]) -> DataFrame:
    """``sized`` with its source's plan and ``before``, the words of its source before each document."""
    n = sized.join(plan_table(sized.sparkSession, plans), F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    # Chunks of a source, and documents of a chunk, both grow with the root of the input.
    chunks = 1 + math.isqrt(sum(p.size for p in plans) // CHUNK_WORDS)
    n = n.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(chunks)))
    sums = n.groupBy("source_no", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", "chunk", F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("doc_id", *row).rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return n.join(bases, ["source_no", "chunk"]).withColumn("before", F.col("base") + F.col("inside")).drop("base", "inside", "chunk")


def document_blocks(at: DataFrame) -> DataFrame:
    """One row per document and block that holds words of it, with the words' first number and count."""
    first, last, block_words = F.expr("before div block_words"), F.expr("(before + size - 1) div block_words"), F.col("block_words")
    rows = at.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("before"), F.col("block") * block_words)
    end = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block_words)
    return rows.withColumn("first_word", start - F.col("before")).withColumn("words", end - start)


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``op7_mixing`` that is fixed before anything is drawn, by the same code."""
    docs = common.read_table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    plans = plan_table(spark, plan_sources(sized, BLOCK_WORDS))
    return sized.join(plans, F.col("source").eqNullSafe(F.col("plan_source"))).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size, its source's size and target, and the words that the mix takes from it."""
    docs = common.read_table(spark, sf_dir, "documents")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sized = common.written(sized, "sized")
    plans = plan_sources(sized, BLOCK_WORDS)
    at = placed(sized, plans, ("size",)).withColumn("row", F.monotonically_increasing_id())
    at = common.written(at, "placed")
    slots = mix_slots(spark, plans)
    pieces = document_blocks(at).select("row", "source_no", "block", "words")
    taken = pieces.join(slots, ["source_no", "block"]).groupBy("row").agg(F.sum("words").alias("taken"))
    out = at.join(taken, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document's words as often as the mix takes them.

    A document stands once for each pass in which the mix takes blocks of it, with the words of these blocks and the white
    space between them; a wholly taken document keeps its exact text. ``n_chars`` is that of the new text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*map(common.column, docs.columns)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
    )
    rows = common.written(rows, "rows")
    narrow = rows.select("row", "doc_id", "source", "size")
    plans = plan_sources(narrow, block_words)
    pieces = document_blocks(placed(narrow, plans, ("row",))).select("row", "source_no", "block", "first_word", "words")
    taken = pieces.join(mix_slots(spark, plans), ["source_no", "block"])
    passes = taken.groupBy("row", "pass_no").agg(F.sum("words").alias("words"), F.array_sort(F.collect_list(F.struct("first_word", "words"))).alias("parts"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut_words(t, [(p["first_word"], p["words"]) for p in ps]) for t, ps in zip(texts, parts, strict=True)], dtype=object)

    joined = rows.select("row", "doc", "size").join(passes, "row")
    whole, text = F.col("words") == F.col("size"), F.col("doc")["text"].cast("string")
    # Wholly taken documents do not go to Python.
    joined = joined.withColumn("new", F.when(whole, text).otherwise(cut(F.when(~whole, text), F.col("parts"))))
    out = []
    for field in docs.schema:
        value = {"text": F.col("new"), "n_chars": F.length("new").cast(field.dataType)}.get(field.name.lower(), F.col("doc")[field.name])
        out.append(value.alias(field.name))
    return joined.select(*out)


def cut_words(text: str, parts: list[tuple[int, int]]) -> str:
    """The words numbered ``first`` to ``first + n`` of each part; neighbouring parts keep the white space between them, others get a space."""
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out: list[str] = []
    end = None
    for first, n in parts:
        stop = spans[first + n - 1][1]
        out.append(text[spans[first - 1][1] : stop] if first == end else " " * bool(out) + text[spans[first][0] : stop])
        end = first + n
    return "".join(out)
