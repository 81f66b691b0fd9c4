"""Removal of byte strings that stand earlier in the corpus, by suffix arrays over content-defined shards.

A byte goes if a string of ``size`` bytes over it also starts earlier: in a document with a smaller doc_id, or earlier in
the same document. Strings are judged on the input.

1. Every window of ``size`` bytes gets a key: the smallest hash of its 24-byte grams. Neighbouring windows with one key
   form a run. Equal windows have equal keys, so that keys shard the corpus by content and no two shards share a window.
2. Runs are shuffled by key and content hash, as hashes and places only. A run that equals an earlier one goes as a whole;
   of others, those that share their key with a different run, or may repeat a window themselves, are candidates. Runs
   count as equal where the key (64 bits of content), 96 bits of two hashes of all bytes, and the length agree.
3. Only candidates' bytes are fetched and shuffled by key. Each shard of them gets a suffix array (Larsson-Sadakane) and
   common prefixes (Kasai); of windows in a class of equal ones, all but the first are marked.
4. A key with more bytes than a shard may have is dealt to several shards by place. Each sorts its own suffixes and hands
   on one window of each class, as its place and 128 bits of hash; these are dealt by hash to merging tasks, which find
   equal windows of different shards by binary search in the merged, sorted hashes and mark all but the first. No task holds more than a shard, and
   work grows with the windows, not with pairs of shards.
5. Marked stretches are gathered by document and cut out.

Keys of very common text, found on a sample of the documents, are refined by two more minimizers of the same window, so
that windows which reach into different contexts part. The runs of keys that stay crowded are dealt by their hash, so that
no task holds such a key. This and the collapse of equal runs inside each task balance the work; none of it changes a
result.

Defined cases: a null text is empty; a null doc_id comes before all others; rows that repeat a doc_id come in the order of
their texts' hashes, and of equal rows the first stays; texts of any length are searched whole; columns other than doc_id
and text are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .suffix_arrays import Runs, covered, later_rows, later_windows, words_at

SIZE = 100
GRAM = 24
SHARD_BYTES = 2 << 20
HOT_RUNS = 20_000
SAMPLE = 64
MAX_HOT = 100_000
COMBINER_RUNS = 200_000
BUCKETS = 16
ROW_BYTES = 32
FIRST = -(1 << 63)

MULTIPLIERS = np.array([[0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], [0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F]], np.uint64)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def _gram_hashes(words: np.ndarray, seed: int) -> np.ndarray:
    n = len(words) - GRAM + 1
    a, b, c = MULTIPLIERS[seed]
    h = words[:n] * a + words[8 : n + 8] * b + words[16 : n + 16] * c
    h ^= h >> np.uint64(32)
    h *= MIX
    return h ^ (h >> np.uint64(29))


def _window_keys(h: np.ndarray, size: int) -> np.ndarray:
    """The smallest gram hash in each window."""
    width, step = size - GRAM + 1, 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (width - step)], h[width - step :]) if width > step else h


def window_runs(data: bytes, size: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each run of windows with one key; ``hot`` keys, sorted, are refined.

    The last array is True where a run may hold one window twice: its key is the hash of a gram that recurs in the text.
    """
    if len(data) < size:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty.astype(bool)
    words = words_at(data)
    grams = _gram_hashes(words, 0)
    keys = smallest = _window_keys(grams, size)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        if (is_hot := hot[at] == keys).any():
            finer = (keys ^ (_window_keys(_gram_hashes(words, 1), size) * MIX)) * MIX ^ _window_keys(_gram_hashes(words, 2), size)
            keys = np.where(is_hot, finer, keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    grams = np.sort(grams)
    recurring = grams[1:][grams[1:] == grams[:-1]]
    again = np.isin(smallest[starts], recurring) if len(recurring) else np.zeros(len(starts), bool)
    return keys[starts], starts, np.diff(np.r_[starts, len(keys)]), again


def _documents(docs: DataFrame, repeats: bool) -> DataFrame:
    """``(doc_id, ord, tie, text)``: ``ord`` and ``tie`` give the order of documents; ``tie`` only where ids repeat."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tie = F.xxhash64(text) if repeats else F.lit(0).cast("long")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(FIRST)).alias("ord"), tie.alias("tie"), text.alias("text"))


def _frequent(docs: DataFrame, size: int, known: np.ndarray, sample: int, hot_runs: int) -> np.ndarray:
    """Keys with about ``hot_runs`` runs or more, estimated on one document in ``sample``; at most ``MAX_HOT`` of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [window_runs(t.encode(), size, known)[0] for t in pdf["text"]]
            yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64) if keys else []}, dtype="int64")

    least = max(2, hot_runs // sample)
    sampled = docs.where(F.pmod(F.xxhash64("ord", F.lit(3)), F.lit(sample)) == 0).select("text")
    found = sampled.mapInPandas(run, "key long").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    rows = found.orderBy(F.desc("n"), "key").limit(MAX_HOT).toPandas()
    return np.sort(rows["key"].to_numpy(np.int64).view(np.uint64))


def hot_keys(docs: DataFrame, size: int, sample: int = SAMPLE, hot_runs: int = HOT_RUNS) -> tuple[np.ndarray, np.ndarray]:
    """Keys to be refined, and keys that are crowded even so. Both only balance the work: no result depends on them."""
    hot = _frequent(docs, size, np.empty(0, np.uint64), sample, hot_runs)
    return hot, _frequent(docs, size, hot, sample, hot_runs) if len(hot) else hot


def _places(docs: DataFrame, size: int, hot: np.ndarray, crowded: np.ndarray) -> DataFrame:
    """``(key, run, ord, tie, at, n)``: hashes and place of each run, packed as ``_unpacked`` says, to be shuffled."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "run", "ord", "tie", "at", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        seen: dict[tuple[bytes, int], tuple[int, int, int]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: list[list[np.ndarray]] = [[] for _ in schema]
                for o, t, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    data = text.encode()
                    keys, starts, n, again = window_runs(data, size, hot)
                    if not len(keys):
                        continue
                    hashes = [xxh3_128_digest(data[s:e]) for s, e in zip(starts.tolist(), (starts + n + size - 1).tolist(), strict=True)]
                    gone = np.zeros(len(keys), bool)
                    for k, (run, s) in enumerate(zip(zip(hashes, n.tolist(), strict=True), starts.tolist(), strict=True)):
                        here = (o, t, s)
                        there = seen.setdefault(run, here)
                        if there < here:
                            gone[k] = True
                        elif here < there:
                            seen[run] = here
                    if len(seen) > COMBINER_RUNS:
                        seen.clear()
                    full = np.ones(len(keys), np.int64)
                    digests = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                    at = starts.astype(np.int64) << 32 | digests[:, 1] & 0xFFFFFFFF
                    flags = gone + 2 * again.astype(np.int64) + 4 * np.isin(keys, crowded)
                    for column, values in zip(out, (keys.view(np.int64), digests[:, 0], o * full, t * full, at, n.astype(np.int64) << 3 | flags), strict=True):
                        column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    return docs.select("ord", "tie", "text").mapInArrow(run, "key long, run long, ord long, tie long, at long, n long")


def _unpacked(places: DataFrame) -> DataFrame:
    """``at`` holds a run's first window and 32 bits of a second hash, ``n`` its number of windows and three marks.

    The marks: an equal run in the same task is earlier (``gone``); it may hold one window twice (``again``); its key is
    crowded.
    """
    n = F.col("n")
    return places.select(
        "key", "run", F.col("at").bitwiseAND(0xFFFFFFFF).alias("more"), "ord", "tie", F.shiftright("at", 32).cast("int").alias("start"), F.shiftright(n, 3).cast("int").alias("n"),
        (n.bitwiseAND(6) != 0).alias("again"), (n.bitwiseAND(1) != 0).alias("gone"),
    )


def _sorted_out(places: DataFrame) -> DataFrame:
    """Of all runs, those that go whole (``whole``) and the candidates: the first of each run where its key has others or it may repeat itself."""
    schema = pa.schema([("key", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("whole", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the next batch needs to know: the last run, and the last first of a run while its key has no other.
        last: tuple | None = None
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, run_, more, o, t, s, n, again, gone = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(9))
            live = ~gone
            k, r = key[live], np.stack([run_[live], more[live], n[live].astype(np.int64)])
            place = np.stack([o[live], t[live], s[live].astype(np.int64)])
            new_run, new_key = np.ones(len(k), bool), np.ones(len(k), bool)
            same_place = np.zeros(len(k), bool)
            if len(k):
                new_key[1:] = k[1:] != k[:-1]
                new_run[1:] = new_key[1:] | (r[:, 1:] != r[:, :-1]).any(0)
                same_place[1:] = ~new_run[1:] & (place[:, 1:] == place[:, :-1]).all(0)
                if last is not None:
                    new_key[0] = k[0] != last[0]
                    new_run[0] = new_key[0] or tuple(r[:, 0]) != last[1]
                    same_place[0] = not new_run[0] and tuple(place[:, 0]) == last[2]
                last = (k[-1], tuple(r[:, -1]), tuple(place[:, -1]))
            first = np.flatnonzero(new_run)
            columns = [k[first], o[live][first], t[live][first], s[live][first], n[live][first], again[live][first]]
            fresh = new_key[first]
            if held is not None:
                columns = [np.concatenate((a, b)) for a, b in zip(held[:6], columns, strict=True)]
                fresh = np.concatenate((held[6], fresh))
            # A first is a candidate if the first before it or after it has its key, or if it may repeat itself.
            keep = ~fresh | columns[5]
            keep[:-1] |= ~fresh[1:]
            held = None
            if len(fresh):
                if not keep[-1]:
                    held = [c[-1:] for c in columns] + [fresh[-1:]]
            whole = np.flatnonzero(~new_run & ~same_place)
            parts = [
                [np.concatenate(x) for x in zip([c[keep] for c in columns[:5]], [k[whole], o[live][whole], t[live][whole], s[live][whole], n[live][whole]], [key[gone], o[gone], t[gone], s[gone], n[gone]], strict=True)],
                np.r_[np.zeros(int(keep.sum()), bool), np.ones(len(whole) + int(gone.sum()), bool)],
            ]
            yield pa.RecordBatch.from_arrays([*map(pa.array, parts[0]), pa.array(parts[1])], schema=schema)

    # Runs already known to go pass through wherever they are; the runs of a crowded key are candidates wherever they are.
    gone, crowded = F.col("n").bitwiseAND(1) != 0, F.col("n").bitwiseAND(4) != 0
    dealt = places.repartition(F.when(gone, F.xxhash64("ord", "at")).when(crowded, F.xxhash64("key", "run")).otherwise(F.col("key")))
    return _unpacked(dealt).sortWithinPartitions("key", "run", "more", "n", "ord", "tie", "start").mapInArrow(run, "key long, ord long, tie long, start int, n int, whole boolean")


def _candidates(found: DataFrame, size: int, shard_bytes: int) -> DataFrame:
    """``(key, ord, tie, start, n, shards)``: candidates with the number of shards that their key needs."""
    firsts = found.where("not whole")
    keys = firsts.groupBy("key").agg(F.ceil(F.sum(F.col("n") + size - 1) / shard_bytes).cast("int").alias("shards"))
    return firsts.join(keys, "key").select("key", "ord", "tie", "start", "n", "shards")


def _candidate_bytes(candidates: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``(key, ord, tie, start, data, shards)`` of the candidate runs."""
    asked = candidates.groupBy("ord", "tie").agg(F.collect_list(F.struct("key", "start", "n", "shards")).alias("asked"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for o, t, text, runs, _ in pdf.itertuples(index=False):
                data = text.encode()
                rows += [(r["key"], o, t, r["start"], data[r["start"] : r["start"] + r["n"] + size - 1], r["shards"]) for r in runs]
            yield pd.DataFrame(rows, columns=["key", "ord", "tie", "start", "data", "shards"])

    # doc_id is not used here: with it, the dealt texts are the very ones that are cut in the end, and are shuffled once.
    return texts.join(asked, ["ord", "tie"]).select("ord", "tie", "text", "asked", "doc_id").mapInPandas(run, "key long, ord long, tie long, start int, data binary, shards int")


def _shards_of(batches: Iterator[pd.DataFrame], columns: tuple[str, ...], shard_bytes: int) -> Iterator[list[tuple]]:
    """Rows of neighbouring groups, whole groups together, up to about ``shard_bytes`` of ``data``."""
    rows: list[tuple] = []
    group: list[tuple] = []
    total = size = 0
    for pdf in batches:
        place = pdf.columns.get_loc("data")
        width = len(columns)
        for row in pdf.itertuples(index=False, name=None):
            if group and row[:width] != group[0][:width]:
                if rows and total + size > shard_bytes:
                    yield rows
                    rows, total = [], 0
                rows, total = rows + group, total + size
                group, size = [], 0
            group.append(row)
            size += ROW_BYTES + len(row[place] or b"")
    if rows and total + size > shard_bytes:
        yield rows
        rows = []
    if rows or group:
        yield rows + group


def _marked(runs: DataFrame, size: int, shard_bytes: int, large: bool) -> DataFrame:
    """``(ord, tie, start, end)``: stretches of candidate runs under windows that also start earlier.

    ``large``: there are keys of several shards. These hand on their windows, and one merge by content follows, through
    which stretches that are known already pass.
    """
    columns = ["key", "bucket", "ord", "tie", "start", "end", "data"]

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for rows in _shards_of(batches, ("key", "shard"), shard_bytes):
            laid = Runs.of([r[5] for r in rows])
            later, windows = later_windows(laid, size)
            found = [(rows[k][0], k, *rows[k][2:4], rows[k][4] + int(start), rows[k][4] + int(end), None) for k, start, end in zip(*covered(later, laid, size), strict=True)]
            yield pd.DataFrame(found, columns=columns)
            first = windows[~later[windows]] if any(r[6] > 1 for r in rows) else windows[:0]
            for at in range(0, len(first), 1 << 13):
                part = first[at : at + (1 << 13)]
                run_of = np.searchsorted(laid.ends, part)
                out = []
                for p, k in zip(part.tolist(), run_of.tolist(), strict=True):
                    key, _, o, t, s, _, shards = rows[k]
                    if shards > 1:
                        digest = xxh3_128_digest(laid.data[p : p + size])
                        place = s + p - int(laid.starts[k])
                        out.append((key, int.from_bytes(digest[:8], "big") % (BUCKETS * shards), o, t, place, place + size, digest))
                yield pd.DataFrame(out, columns=columns)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _shards_of(batches, ("key", "bucket"), shard_bytes):
            yield pd.DataFrame([r[2:6] for r in rows if r[6] is None], columns=columns[2:6])
            # Rows come sorted by key, bucket and place: of equal windows the first row is the first place.
            asked = [r for r in rows if r[6] is not None]
            if asked:
                later = later_rows(np.array([r[0] for r in asked], np.int64), np.array([r[6] for r in asked], "S16"))
                yield pd.DataFrame([asked[k][2:6] for k in np.flatnonzero(later)], columns=columns[2:6])

    shard = F.when(F.col("shards") > 1, F.pmod(F.xxhash64("ord", "tie", "start"), F.col("shards"))).otherwise(0)
    dealt = runs.select("key", shard.alias("shard"), "ord", "tie", "start", "data", "shards").repartition("key", "shard").sortWithinPartitions("key", "shard", "ord", "tie", "start")
    done = dealt.mapInPandas(own, "key long, bucket long, ord long, tie long, start int, end int, data binary")
    if large:
        done = done.repartition("key", "bucket").sortWithinPartitions("key", "bucket", "ord", "tie", "start").mapInPandas(merge, "ord long, tie long, start int, end int")
    return done.select("ord", "tie", "start", "end")


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches of the union of half-open spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def removed_spans(docs: DataFrame, texts: DataFrame, size: int = SIZE, shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS, sample: int = SAMPLE) -> DataFrame:
    """``(ord, tie, spans)`` of the documents ``docs (ord, tie, text)`` that lose bytes; spans may overlap.

    ``texts`` are the same, dealt by ``ord`` and ``tie``, each pair of these once.
    """
    found = common.written(_sorted_out(_places(docs, size, *hot_keys(docs, size, sample, hot_runs))), "runs")
    candidates = _candidates(found, size, shard_bytes)
    large = bool(candidates.where("shards > 1").limit(1).collect())
    marked = _marked(_candidate_bytes(candidates, texts, size), size, shard_bytes, large)
    whole = found.where("whole").select("ord", "tie", "start", (F.col("start") + F.col("n") + size - 1).alias("end"))
    return whole.unionByName(marked).groupBy("ord", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def dedup_documents(docs: DataFrame, size: int = SIZE, shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every row; ``kept`` is what remains, as bytes."""
    repeats = bool(docs.groupBy(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))).count().where("count > 1").limit(1).collect())
    # Joins are on the same columns, so that texts are shuffled once: without repeats the constant tie is none of them.
    texts = _documents(docs, repeats).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *(("ord", "tie") if repeats else ("ord",)))
    copy = F.row_number().over(Window.partitionBy("ord", "tie").orderBy(F.col("doc_id").asc_nulls_first())) if repeats else F.lit(1)
    texts = texts.withColumn("copy", copy)
    spans = removed_spans(_documents(docs, repeats), texts.where("copy = 1"), size, shard_bytes, hot_runs, sample)
    joined = texts.join(spans, ["ord", "tie"], "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.octet_length("text").cast("int").alias("end")))
    joined = joined.withColumn("spans", F.when((F.col("copy") > 1) & (F.octet_length("text") >= size), whole).otherwise(F.col("spans")))

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, ss in zip(texts, spans, strict=True):
            if ss is None:
                rows.append((0, 0, None))
                continue
            data, kept, at = text.encode(), [], 0
            gone = merged_spans([(s["start"], s["end"]) for s in ss])
            for start, end in gone:
                kept.append(data[at:start])
                at = end
            rows.append((sum(e - s for s, e in gone), len(gone), b"".join([*kept, data[at:]])))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])

    # Texts that lose nothing do not go to Python.
    lost = F.col("spans").isNotNull()
    done = joined.withColumn("cut", cut(F.when(lost, F.col("text")), F.col("spans")))
    return done.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "cut.n_removed", "cut.n_spans",
        F.when(lost, F.col("cut.kept")).otherwise(F.col("text").cast("binary")).alias("kept"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to strings of 100 bytes that stand earlier, and the hash of what it keeps."""
    done = dedup_documents(common.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], size: int = SIZE) -> list[tuple]:
    """The same by a set of all windows, for tests."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            w = data[k : k + size]
            if w in seen:
                gone[k : k + size] = b"\1" * size
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
