"""Point lookups of k-mers, and counts along reads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packing import MAX_K, placed_batches
from ..functions.sequences import canonical, is_valid, packed, windows

#: Up to this length every task holds the database: at most 4^11 k-mers, half of them canonical, whatever the input.
TABLE_K = 11


def lookup(probe: DataFrame, database: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """``probe (kmer)`` with ``cnt``, null where the database has none within the count range; k-mers are taken as given."""
    db = database.select("kmer", "cnt")
    if low is not None:
        db = db.where(F.col("cnt") >= low)
    if high is not None:
        db = db.where(F.col("cnt") <= high)
    return probe.join(db, "kmer", "left")


def contained(probe: DataFrame, database: DataFrame) -> DataFrame:
    """The rows of ``probe (kmer)`` that the database has."""
    return probe.join(database.select("kmer"), "kmer", "left_semi")


def counters(reads: DataFrame, database: DataFrame, k: int, both_strands: bool = True) -> DataFrame:
    """``(read_id, pos, cnt)``: the database's count at each position of each read, 0 where it has none.

    Up to ``TABLE_K`` bases the database is broadcast, which the number of such k-mers bounds, and no window is shuffled.
    For longer k-mers, windows with other symbols have keys that differ from each other and from any k-mer, so that they
    are no hot key of the join; a very frequent k-mer's rows are all on the left side, where Spark may split them.
    """
    own = reads.select("read_id", "seq")
    if k > MAX_K:
        cut = windows(own, k)
        key = canonical(F.col("kmer")) if both_strands else F.col("kmer")
        cut = cut.withColumn("kmer", F.when(is_valid(F.col("kmer")), key).otherwise(F.concat(F.lit("-"), F.col("pos"))))
        db = database.select("kmer", "cnt")
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return placed_batches(batches, k, both_strands, null=k <= TABLE_K)

        out = T.StructType([T.StructField("read_id", reads.schema["read_id"].dataType), T.StructField("pos", T.IntegerType()), T.StructField("kmer", T.LongType())])
        cut = own.mapInArrow(run, out)
        db = database.select("kmer", "cnt")
        if isinstance(database.schema["kmer"].dataType, T.StringType):
            db = db.select(packed(F.col("kmer"), k).alias("kmer"), "cnt")
        if k <= TABLE_K:
            db = F.broadcast(db)
    return cut.join(db, "kmer", "left").select("read_id", "pos", F.coalesce("cnt", F.lit(0).cast("long")).alias("cnt"))


def counter_arrays(found: DataFrame) -> DataFrame:
    """``(read_id, counters)``: counts in the order of positions, one array per read."""
    gathered = found.groupBy("read_id").agg(F.array_sort(F.collect_list(F.struct("pos", "cnt"))).alias("at"))
    return gathered.select("read_id", F.transform("at", lambda x: x["cnt"]).alias("counters"))
