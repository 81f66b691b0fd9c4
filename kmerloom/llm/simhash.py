"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint's bit is 1 where over half of the text's 3-word shingle hashes have it. Fingerprints link at three or fewer
differing bits. They are cut into two 32-bit segments, so that linked ones agree in one segment up to one bit at most.
Each segment is indexed 33 times: whole, and with each one of its bits as a wildcard. Linked fingerprints meet in a
bucket with the wildcard where they differ, or with none; an equality join on buckets finds them and the whole distance
verifies them.

Only distinct fingerprints are indexed. Buckets are never expanded into pairs in Spark: a task compares a bucket's members
with numpy and returns links that join the same members, one per member at most. A bucket that may hold more than
``chunk`` members is dealt to several tasks, each comparing two chunks of it, so that every pair is still compared.

Defined cases: a null or blank text has fingerprint zero, linked like any other; repeated rows link with each other; a
component's id is the smallest non-null doc_id in it, null where it has none; texts of any length are read whole; an
empty table gives an empty result; columns other than doc_id and text are not read, and ``keep_first`` returns them as
they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import connected_components, forest

SEED = 42
SHINGLE = 3
BITS = 3
CHUNK = 2048
BROADCAST_ROWS = 50_000
SMALL = 48


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
    n = len(words) - size + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64), dtype="int64")

    return docs.withColumn("fp", run(F.col("text").cast("string")))


def _half(fp: str, segment) -> F.Column:
    return F.when(segment == 0, F.col(fp).bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned(fp, 32))


def _bucket(segment, wildcard, half) -> F.Column:
    """Bucket number: segment, wildcard (32: none), and the segment's bits with the wildcard's cleared."""
    bit = F.when(wildcard < 32, F.expr("shiftleft(1L, cast(wildcard as int))")).otherwise(F.lit(0).cast("long"))
    return half.bitwiseAND(F.bitwise_not(bit)) + F.shiftleft(wildcard, 32) + F.shiftleft(segment, 38)


def _variants(distinct: DataFrame) -> DataFrame:
    """``(bucket, fp)``: the 66 signatures of every distinct fingerprint."""
    v = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("v"))
    v = v.select("fp", F.expr("cast(v div 33 as long)").alias("segment"), F.expr("cast(v % 33 as long)").alias("wildcard"))
    return v.select(_bucket(F.col("segment"), F.col("wildcard"), _half("fp", F.col("segment"))).alias("bucket"), "fp")


def _large_buckets(distinct: DataFrame, chunk: int) -> DataFrame:
    """``(bucket, chunks)`` of the buckets that may have more than ``chunk`` members.

    Members are counted by whole segments, two rows for each fingerprint: a bucket joins two segments at most.
    """
    halves = distinct.select("fp", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("segment"))
    halves = halves.groupBy("segment", _half("fp", F.col("segment")).alias("half")).agg(F.count("*").alias("n"))
    large = halves.where(F.col("n") > chunk // 2)
    keyed = large.select("segment", "half", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(32).cast("long"))).alias("wildcard"))
    keyed = keyed.select(_bucket(F.col("segment"), F.col("wildcard"), F.col("half")).alias("bucket"), "n")
    return keyed.groupBy("bucket").agg((F.ceil(F.sum("n") / chunk) + 1).cast("int").alias("chunks"))


def _pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within neighbouring groups of these sizes."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    rows = np.arange(len(ends))
    later = ends - rows - 1
    first = np.repeat(rows, later)
    start = np.cumsum(later) - later
    return first, np.arange(len(first)) - np.repeat(start, later) + first + 1


def compare_members(bucket: np.ndarray, task: np.ndarray, part: np.ndarray, fp: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links among the members of whole buckets, sorted by bucket and task.

    Members of a bucket with a wildcard are compared where they differ in it; those that agree meet in the bucket without.
    """
    fp = fp.view(np.uint64)
    wildcard = (bucket >> 32) & 63
    shift = np.where(wildcard < 32, wildcard + 32 * (bucket >> 38), 0).astype(np.uint64)
    side = np.where(wildcard < 32, (fp >> shift) & np.uint64(1), 2).astype(np.int8)
    starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (task[1:] != task[:-1])])
    sizes = np.diff(np.r_[starts, len(bucket)])
    low, high = np.minimum.reduceat(side, starts), np.maximum.reduceat(side, starts)
    useful = (sizes > 1) & ((low == 2) | (low != high))
    us, vs = [], []
    keep = np.flatnonzero(np.repeat(useful & (sizes <= SMALL), sizes))
    small = sizes[useful & (sizes <= SMALL)]
    for at in np.split(np.arange(len(small)), np.flatnonzero(np.diff(np.cumsum(small * small) // 4_000_000)) + 1):
        n = small[at].sum()
        rows, keep = keep[:n], keep[n:]
        a, b = _pairs(small[at])
        u, v = rows[a], rows[b]
        ok = (np.bitwise_count(fp[u] ^ fp[v]) <= bits) & ((side[u] == 2) | (side[u] != side[v]))
        us.append(u[ok])
        vs.append(v[ok])
    for g in np.flatnonzero(useful & (sizes > SMALL)):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        if low[g] != 2:
            left, right = rows[side[rows] == 0], rows[side[rows] == 1]
        elif task[rows[0]] and (part[rows] != part[rows[0]]).any():
            left, right = rows[part[rows] == part[rows[0]]], rows[part[rows] != part[rows[0]]]
        else:
            left = right = rows
        for at in range(0, len(left), 512):
            block = left[at : at + 512]
            a, b = np.nonzero(np.bitwise_count(fp[block][:, None] ^ fp[right][None, :]) <= bits)
            # Of a block's links those suffice that join the same rows.
            joined = forest(a, b + len(block), len(block) + len(right))
            own = np.r_[block, right]
            moved = np.flatnonzero(joined != np.arange(len(own)))
            us.append(own[moved])
            vs.append(own[joined[moved]])
    if not us:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = forest(np.concatenate(us), np.concatenate(vs), len(fp))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved].view(np.int64), fp[label[moved]].view(np.int64)


def fingerprint_links(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links ``(u, v)`` of distinct fingerprints that join exactly those that links of three bits or fewer join."""
    large = common.written(_large_buckets(distinct, chunk), "large")
    members = _variants(distinct)
    if (n_large := large.count()) == 0:
        members = members.select("bucket", F.lit(0).cast("long").alias("task"), F.lit(0).alias("part"), "fp")
    else:
        side = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        members = members.join(side, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        members = members.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        pair = F.least("part", "other") * F.col("chunks") + F.greatest("part", "other") + 1
        members = members.select("bucket", F.when(F.col("chunks") == 1, 0).otherwise(pair).cast("long").alias("task"), "part", "fp")

    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            u, v = compare_members(*columns)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            # The last bucket may go on in the next batch.
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            at = int(np.argmax(last))
            rest = [c[at:] for c in columns]
            if at:
                yield links([c[:at] for c in columns])
        if rest is not None:
            yield links(rest)

    dealt = members.repartition("bucket", "task").sortWithinPartitions("bucket", "task", "fp")
    return dealt.mapInArrow(run, "u long, v long")


def _classes(prints: DataFrame, chunk: int) -> DataFrame:
    """``(fp, first, root)``: of each fingerprint its smallest doc_id, and one fingerprint of its component."""
    distinct = common.written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(fingerprint_links(distinct, chunk))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs (doc_id, text)``."""
    prints = common.written(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "fp"), "prints")
    rooted = _classes(prints, chunk)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id that links lead to."""
    found = simhash_components(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row of each component, that of its smallest doc_id, with the columns of ``docs``.

    A component without any doc_id keeps a row of its smallest fingerprint. Rows that repeat doc_id and fingerprint are
    one document.
    """
    names = [common.column(c) for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = common.written(fingerprints(rows).drop("text"), "rows")
    prints = rows.select("doc_id", "fp")
    best = F.min(F.struct(F.col("first").isNull().alias("no_id"), F.col("first"), F.col("fp").alias("best_fp"))).alias("best")
    winners = _classes(prints, chunk).groupBy("root").agg(best).select("best.first", "best.best_fp")
    kept = rows.join(winners, (F.col("fp") == F.col("best_fp")) & F.col("doc_id").eqNullSafe(F.col("first")))
    if prints.groupBy("doc_id", "fp").count().where("count > 1").limit(1).collect():
        # Of repeated rows the one with the smallest hash of its content stays, whichever order they come in.
        kept = kept.groupBy("doc_id", "fp").agg(F.min_by("doc", F.struct(F.xxhash64(F.to_json("doc")), F.to_json("doc"))).alias("doc"))
    return kept.select("doc.*")
