"""Phrase collocation mining by prefix-free parsing.

1. Each document becomes tokens: its words, and one mark for every stretch between pieces. A pair of tokens whose hash has
   remainder zero is a trigger. Chunks run from one trigger to the end of the next, so that neighbours share two tokens,
   and two marks end a document. The distinct chunks of a language with their frequencies are the dictionary: repeated
   passages are counted once from here on.
2. n-grams are counted inside distinct chunks, times the chunk's frequency. One belongs to the chunk that it starts in
   before the shared tokens, which is exactly one, and three tokens from there never leave the chunk.
3. Before that, a sketch of saturating counts by hash says which n-grams cannot reach the least count; it has at most
   ``2 ** SKETCH_BITS`` counters, whatever the input, and is a bitmap when it reaches the tasks. It only saves work: what it
   lets through is counted exactly, by its words.
4. Scores, cuts and the drop rule are joins of the counted phrases; numbers are exact (decimals of 38 digits).

Defined cases: a null text is empty, a null language is ``und``; a text without words gives nothing; repeated rows count
each; texts and words of any length are taken whole; ties are as ordered; columns other than text and lang are not read,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

MIN_COUNT = 10
TOP = 2000
SCALE = 1_000_000
#: The longest phrase, and the tokens that neighbouring chunks share.
WORDS, OVERLAP = 3, 2
MODULUS = 24
FLUSH_BYTES = 16 << 20
COUNT_BYTES = 6 << 20
SKETCH_BITS = 27
SEGMENT_BITS = 16

MARK = b"."
#: A-Z in lower case, ends of pieces as marks, tabs as spaces.
_TABLE = bytes(ord(" ") if c == 9 else MARK[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in bytes(range(256)).lower())
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def tokens_of(text: bytes) -> list[bytes]:
    """Words and marks of a text."""
    return text.translate(_TABLE).replace(MARK, b" . ").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    return h * _C


def chunks_of(text: bytes, modulus: int = MODULUS) -> Iterator[bytes]:
    """The overlapping chunks of a text, tokens parted by spaces."""
    tokens = tokens_of(text)
    n = len(tokens)
    if not n:
        return
    tokens += [MARK] * OVERLAP
    h = np.fromiter(map(crc32, tokens), np.uint64, len(tokens))
    with np.errstate(over="ignore"):
        trigger = _mixed(h[:n] * _A + h[1 : n + 1]) >> np.uint64(32)
    starts = np.flatnonzero(trigger % np.uint64(modulus) == 0)
    for a, b in pairwise([0, *starts[starts > 0].tolist(), n]):
        yield b" ".join(tokens[a : b + OVERLAP])


def dictionary(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """``(lang, chunk, freq)``: the distinct chunks of each language and how often the parse has them."""
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), ("freq", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, bytes]] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            langs, chunks = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(chunks, pa.binary()), pa.array(list(found.values()))], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                name, data = lang.as_py(), text.as_py()
                found.update((name, c) for c in chunks_of(data, modulus))
                size += len(data)
                if size >= FLUSH_BYTES:
                    if found:
                        yield flush()
                    found.clear()
                    size = 0
        if found:
            yield flush()

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, "lang string, chunk binary, freq long").groupBy("lang", "chunk").agg(F.sum("freq").alias("freq"))


class _Grams:
    """Owned n-grams of some chunks of one language: places, words and hashes."""

    def __init__(self, chunks: pa.Array, freq: np.ndarray) -> None:
        split = pc.split_pattern(chunks, " ")
        length = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = split.flatten().dictionary_encode()
        self.words, self.ids = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = np.fromiter(map(crc32, self.words.to_pylist()), np.uint64, len(self.words))
        with np.errstate(over="ignore"):
            self.h = _mixed(hashes + _B)[self.ids]
        word = pc.not_equal(self.words, pa.scalar(MARK, self.words.type)).to_numpy(zero_copy_only=False)
        is_word = np.r_[word[self.ids], False, False]
        ends = np.cumsum(length)
        owned = np.ones(len(self.ids), bool)
        for back in range(1, OVERLAP + 1):
            owned[ends - back] = False
        self.weight = np.repeat(freq, length)
        one = owned & is_word[:-2]
        two = one & is_word[1:-1]
        self.at = [np.flatnonzero(x) for x in (one, two, two & is_word[2:])]

    def slots(self, at: np.ndarray, n: int, bits: int) -> np.ndarray:
        """The sketch's counters of the n-grams of ``n`` words at these places."""
        with np.errstate(over="ignore"):
            h = self.h[at]
            for k in range(1, n):
                h = _mixed(h * _A + self.h[at + k])
            return ((h * _B) >> np.uint64(64 - bits)).astype(np.int64)

    def counted(self, n: int, keep: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
        """Distinct n-grams (of those to ``keep``) and their weighted counts."""
        at = self.at[n - 1] if keep is None else self.at[n - 1][keep]
        code = self.ids[at]
        for k in range(1, n):
            if len(code) and int(code.max()) >= (1 << 62) // len(self.words):
                code = np.unique(code, return_inverse=True)[1]
            code = code * len(self.words) + self.ids[at + k]
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, int)
        total = np.add.reduceat(self.weight[at[order]], first) if len(first) else np.zeros(0, np.int64)
        own = at[order][first]
        parts = [self.words.take(pa.array(self.ids[own + k])) for k in range(n)]
        return (parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", self.words.type))), total


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Grams]]:
    """The n-grams of ``(lang, chunk, freq)``, a language and some megabytes at a time."""

    def grams(held: list[pa.RecordBatch]) -> Iterator[tuple[str, _Grams]]:
        table = pa.Table.from_batches(held).combine_chunks()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = table.filter(pc.equal(langs.indices, k))
            yield lang, _Grams(own.column("chunk").combine_chunks(), own.column("freq").to_numpy())

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= COUNT_BYTES:
            yield from grams(held)
            held, size = [], 0
    if held:
        yield from grams(held)


def sketch(chunks: DataFrame, bits: int, min_count: int) -> np.ndarray:
    """A bitmap of the counters that reach ``min_count``, over all n-grams of two words or more.

    Each task counts in an array of its own and hands on what is not zero, by segments of the array. A segment's parts meet
    sorted, so that the task that adds them up holds one segment, however many parts there are.
    """
    segment_bits = min(bits, SEGMENT_BITS)
    size = 1 << segment_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint8)
        for _, grams in _gathered(batches):
            for n in range(2, WORDS + 1):
                slots = grams.slots(grams.at[n - 1], n, bits)
                order = np.argsort(slots)
                slots = slots[order]
                first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.zeros(0, int)
                if len(first):
                    total = np.add.reduceat(grams.weight[grams.at[n - 1][order]], first)
                    own = slots[first]
                    counters[own] = np.minimum(counters[own] + np.minimum(total, 255), 255).astype(np.uint8)
        for k in range(1 << (bits - segment_bits)):
            own = counters[k * size : (k + 1) * size]
            at = np.flatnonzero(own)
            if len(at):
                yield pa.RecordBatch.from_pydict({"segment": pa.array([k], pa.int32()), "places": [at.astype("<u2").tobytes()], "counts": [own[at].tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(size, np.int64)

        def bitmap() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment": pa.array([at], pa.int32()), "bitmap": [np.packbits(total >= min_count).tobytes()]})

        for batch in batches:
            for segment, places, counts in zip(*(batch.column(k) for k in range(3)), strict=True):
                if at != (own := segment.as_py()):
                    if at is not None:
                        yield bitmap()
                    at = own
                    total[:] = 0
                total[np.frombuffer(places.as_py(), "<u2")] += np.frombuffer(counts.as_py(), np.uint8)
        if at is not None:
            yield bitmap()

    parts = chunks.mapInArrow(count, "segment int, places binary, counts binary")
    # At most 2 ** SKETCH_BITS bits reach the driver.
    found = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(add, "segment int, bitmap binary").collect()
    out = np.zeros((1 << (bits - segment_bits), -(-size // 8)), np.uint8)
    for r in found:
        out[r["segment"]] = np.frombuffer(r["bitmap"], np.uint8)
    return out.ravel()


def gram_counts(chunks: DataFrame, min_count: int = MIN_COUNT, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``(lang, size, phrase, f)``: all words, and the phrases of two and three words with at least ``min_count`` occurrences."""
    spark = chunks.sparkSession
    total = chunks.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    bits = max(10, min(sketch_bits, int(total).bit_length()))
    bitmap = spark.sparkContext.broadcast(sketch(chunks, bits, min_count).tobytes())
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.binary()), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bitmap.value, np.uint8)

        def often(slots: np.ndarray) -> np.ndarray:
            return (flags[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1

        for lang, grams in _gathered(batches):
            _, two, three = grams.at
            triples = often(grams.slots(three, 2, bits)) & often(grams.slots(three + 1, 2, bits))
            triples[triples] = often(grams.slots(three[triples], 3, bits))
            for n, keep in ((1, None), (2, often(grams.slots(two, 2, bits))), (3, triples)):
                phrase, f = grams.counted(n, keep)
                if len(f):
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(f)).cast(pa.string()), pa.array(np.full(len(f), n, np.int32)), phrase.cast(pa.binary()), pa.array(f)], schema=schema)

    counts = chunks.mapInArrow(run, "lang string, size int, phrase binary, f long").groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return counts.where((F.col("size") == 1) | (F.col("f") >= min_count)).withColumn("phrase", F.col("phrase").cast("string"))


def _exact(c: Column | str, digits: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({digits},0)")


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sketch_bits: int = SKETCH_BITS, modulus: int = MODULUS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of ``docs (text, lang)``."""
    chunks = common.written(dictionary(docs, modulus), "chunks")
    grams = common.written(gram_counts(chunks, min_count, sketch_bits), "grams")
    totals = grams.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    often = grams.where(F.col("f") >= min_count)
    longer = often.where(F.col("size") == WORDS)
    words = F.split("phrase", " ")

    def joined(start: int, length: int) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    cut = F.when(F.col("size") == 2, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))
    cuts = often.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.explode(cut).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    known = often.select("lang", "phrase", "f")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.withColumnsRenamed({"phrase": side, "f": name}), ["lang", side])
    top_half = _exact(F.lit(SCALE), 7) * _exact("a", 15) * _exact("a", 15)
    cuts = cuts.withColumns({"over": top_half, "under": _exact("l", 19) * _exact("r", 19)}).withColumn("score", F.expr("`over` div `under`"))
    scored = cuts.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = longer.select("lang", "f", F.explode(F.array(joined(1, 2), joined(2, 2))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    scored = scored.join(inside, ["lang", "phrase"], "left").where((F.col("size") == WORDS) | F.col("inside").isNull() | (100 * F.col("inside") < 50 * F.col("a")))
    rows = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language that hold together best."""
    return phrases(common.read_table(spark, sf_dir, "documents"))
