"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

A shard file is a run of records. Each record is framed as

    length    8 bytes, little-endian unsigned, of the payload
    check     4 bytes, masked CRC-32 of the length bytes
    payload   key (8 bytes, signed), n (4 bytes), width (1 byte: 2 or 4; 128 more for a null key), then n ids of ``width`` bytes
    check     4 bytes, masked CRC-32 of the payload

All integers are little-endian; ids take two bytes where the vocabulary fits and four otherwise. A masked checksum is
the CRC rotated right by 15 bits plus a constant, so that a checksum stored inside checked data does not look like one.
The offset index is a Parquet table ``(shard, ordinal, doc_id, offset, n_bytes, n_tokens)``: any reader can shuffle the
records by shuffling the index and seeking.

Shards are range-partitioned by key, so that shard order, then record order, is ascending key order; there are as many as
the texts' bytes ask for, ``SHARD_BYTES`` each, and a key on very many rows goes over several. A shard is written
under a name of its own for each task attempt and renamed at its end; only shards of successful attempts are in the
index, so that lost executors and repeated attempts leave nothing that a reader sees.

Defined cases: a null text is empty; null keys come first and are read back as null; every 64-bit key is kept exactly; rows that repeat a key come in the order of their texts' first ``PREFIX`` letters, then
of hashes of the texts; texts of any length are one record; an empty table writes no shards, and index, records and layout are empty; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHARD_BYTES = 64 << 20
MEMO_BYTES = 192 << 20
PREFIX = 64
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
META = struct.Struct("<qIB")
TAIL = struct.Struct("<I")
NULL_KEY = 0x80

INDEX_SCHEMA = "shard string, shard_no int, ordinal int, doc_id long, offset long, n_bytes long, n_tokens long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(key: int | None, ids: bytes, width: int) -> bytes:
    """One record; ``ids`` are little-endian integers of ``width`` bytes."""
    payload = META.pack(key or 0, len(ids) // width, width | NULL_KEY * (key is None)) + ids
    length = len(payload).to_bytes(8, "little")
    return b"".join((HEAD.pack(len(payload), masked_crc(length)), payload, TAIL.pack(masked_crc(payload))))


def unframe(data: bytes, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """Key, ids and the offset after the record at ``offset``. Raises ValueError if a checksum does not match."""
    length, check = HEAD.unpack_from(data, offset)
    if masked_crc(data[offset : offset + 8]) != check:
        raise ValueError(f"length checksum at offset {offset} does not match")
    start = offset + HEAD.size
    payload = data[start : start + length]
    if len(payload) < length or TAIL.unpack_from(data, start + length)[0] != masked_crc(payload):
        raise ValueError(f"payload checksum at offset {offset} does not match")
    key, n, width = META.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width & ~NULL_KEY}", n, META.size)
    return (None if width & NULL_KEY else key), ids, start + length + TAIL.size


def file_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it.

    Names of object stores as Spark writes them (s3a, s3n, abfss, wasbs) are those of Arrow under another scheme.
    """
    scheme, sep, rest = path.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}.get(scheme, scheme) + sep + rest)


class WordEncoder:
    """Encodes whole texts with a word-level BPE file of the tokenizers library and remembers the words it has met.

    The file's pre-tokenizer never joins characters across ASCII white space, so a text's ids are those of its
    white-space-delimited words in order. A word is encoded by the library; its ids are then taken from a memo of
    ``memo_bytes`` at most, whatever the words. Words of plain Latin letters go straight to the library's BPE model: for these the file's normalizer is
    lower-casing and its byte-level step is a fixed byte-to-character map. All other words take the library's full path.
    """

    PLAIN = re.compile("([A-Za-zß-öø-ÿÀ-ÖØ-Þ]*)([.,!?;:*#$%&|()]*)")

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.words = common.Memo(self._word, memo_bytes // 2)
        self.parts = common.Memo(self._part, memo_bytes // 2)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def pack(self, ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(self.width, "little") for i in ids])

    def _part(self, part: str) -> bytes:
        chars = part.encode().decode("latin-1").translate(self.byte_chars)
        return self.pack([t.id for t in self.model.tokenize(chars)])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if m := self.PLAIN.fullmatch(word):
            letters, marks = m.groups()
            return (self.parts[letters.lower()] if letters else b"") + (self.parts[marks] if marks else b"")
        return self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    SPACE = re.compile("[\t-\r ]+")

    def encode(self, text: str) -> bytes:
        """The packed ids of a whole text."""
        split = text.split() if text.isascii() and not re.search("[\x1c-\x1f]", text) else self.SPACE.split(text)
        return b"".join(map(self.words.__getitem__, split))


def ordered_documents(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` range-partitioned and sorted by key, null keys first.

    Rows with equal keys are ordered by the beginnings and hashes of their texts, so that repeated rows have a defined
    place; a last key, which orders nothing that differs, lets ranges part rows that are all equal. Texts are shuffled rather
    than ids: they are smaller, and the sampling for the ranges then needs no tokenizer.
    """
    picked = docs.select(common.column(key).cast("long").alias("doc_id"), common.column(text).cast("string").alias("text"))
    picked = picked.withColumn("spread", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, PREFIX).asc_nulls_first(), F.xxhash64("text")]
    return picked.repartitionByRange(n_shards, *order, "spread").sortWithinPartitions(*order).drop("spread")


def shards_for(docs: DataFrame, shard_bytes: int = SHARD_BYTES, least: int = 8) -> int:
    """Shards for the bytes of the texts."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(least, -(-total // shard_bytes))


def _encoding(tokenizer_path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        end = encoder.pack([end_id])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encoder.encode(t or "") + end for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encoder.width] * len(ids), pa.int32()), pa.array(ids, pa.binary())], schema=schema)

    return run


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``(doc_id, width, ids)`` of ``(doc_id, text)``: the packed ids of every whole text with ``end_id`` after each.

    A null text is empty. The order within partitions stays.
    """
    return docs.select("doc_id", "text").mapInArrow(_encoding(tokenizer_path, end_id), "doc_id long, width int, ids binary")


def write_records(tokens: DataFrame, path: str) -> DataFrame:
    """Write ``(doc_id, width, ids)`` to one shard file per partition under ``path``; return the offset index.

    Records keep the order of partitions and rows. An empty table writes no shards and an empty index. ``path`` is a URI in storage that all executors share.
    """
    return _write(tokens.select("doc_id", "width", "ids"), path)


def write_documents(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> DataFrame:
    """What ``write_records`` makes of ``encode_documents``, by one Python worker a task instead of two."""
    return _write(docs.select("doc_id", "text"), path, _encoding(tokenizer_path, end_id))


def _write(rows: DataFrame, path: str, encode: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> DataFrame:
    schema = pa.schema([("shard", pa.string()), ("shard_no", pa.int32()), ("ordinal", pa.int32()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        no = TaskContext.get().partitionId()
        store, base = file_store(path)
        name = f"shard-{no:06d}-{uuid.uuid4().hex}.rec"
        out, at, ordinal = None, 0, 0
        for batch in encode(batches):
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/_{name}")
            keys, sizes, counts = batch.column(0), [], []
            # Arrow integers, not pandas: beside a null, pandas would make large ids floats.
            for key, width, ids in zip(keys.to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = ids.as_py()
                record = frame(key, ids, width)
                out.write(record)
                sizes.append(len(record))
                counts.append(len(ids) // width)
            n = len(sizes)
            ends = at + np.cumsum(np.array(sizes, np.int64))
            columns = [pa.array([name] * n, pa.string()), pa.array(np.full(n, no, np.int32)), pa.array(np.arange(ordinal, ordinal + n, dtype=np.int32)), keys, pa.array(ends - np.array(sizes, np.int64)), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())]
            if n:
                at, ordinal = int(ends[-1]), ordinal + n
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if out is not None:
            out.close()
            store.move(f"{base}/_{name}", f"{base}/{name}")

    spark = rows.sparkSession
    # The index is written at once: its rows name the shards of the attempts that succeeded.
    rows.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{path}-index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}-index")


def read_records(spark: SparkSession, path: str, index: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """``(shard_no, ordinal, doc_id, n_tokens, ids_crc32)`` of every record, read from the files at the index's offsets.

    Runs of neighbouring records of about ``split_bytes`` are dealt to tasks in random order, as a shuffled reader would.
    ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned 32-bit integers. Both checksums of each record are
    verified; a record that does not match its index row raises ValueError.
    """
    out = "shard_no int, ordinal int, doc_id long, n_tokens long, ids_crc32 long"
    schema = pa.schema([("shard_no", pa.int32()), ("ordinal", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_store(path)
        for batch in batches:
            for run in batch.to_pylist():
                with store.open_input_file(f"{base}/{run['shard']}") as f:
                    f.seek(run["at"])
                    data = f.read(run["n_bytes"])
                at, rows = 0, []
                for k in range(run["n"]):
                    key, ids, at = unframe(data, at)
                    rows.append((run["shard_no"], run["first"] + k, key, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if at != run["n_bytes"]:
                    raise ValueError(f"{run['shard']}: the records at {run['at']} end at {at}, not at {run['n_bytes']}")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    runs = index.groupBy("shard", "shard_no", F.floor(F.col("offset") / split_bytes).alias("run")).agg(
        F.min("offset").alias("at"), F.sum("n_bytes").alias("n_bytes"), F.min("ordinal").alias("first"), F.count("*").alias("n")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(tasks, F.xxhash64("shard", "run")).mapInArrow(read, out)


def token_layout(records: DataFrame) -> DataFrame:
    """Add ``start``: the number of ids of all records before each, over all shards.

    Shard totals go to a running sum of one row per shard; rows of a shard are summed in a window of that shard, whose
    size the number of shards bounds.
    """
    from pyspark.sql import Window

    totals = records.groupBy("shard_no").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard_no", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard_no").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(bases, "shard_no").withColumn("start", F.col("base") + F.col("inside")).drop("inside", "base")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_token_records(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Every document's place, length and checksum, as read back from the record files."""
    docs = common.read_table(spark, sf_dir, "documents")
    path = common.scratch(spark, "records")
    ordered = ordered_documents(docs, shards_for(docs, least=max(8, spark.sparkContext.defaultParallelism)))
    index = write_documents(ordered, tokenizer_path or default_tokenizer(), 1, path)
    records = read_records(spark, path, index)
    return token_layout(records).select("doc_id", "start", F.col("n_tokens").cast(T.LongType()), "ids_crc32")
