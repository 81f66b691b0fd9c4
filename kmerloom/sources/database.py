"""k-mer count tables on disk: Parquet partitioned by sample, with one row of facts per sample beside it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counting, lookup


def save_database(counts: DataFrame, path: str, k: int, both_strands: bool = True) -> None:
    """Write ``(sample, kmer, cnt)`` and its facts; listing one sample later reads its partition only."""
    counts.select("sample", "kmer", "cnt").write.partitionBy("sample").parquet(f"{path}/counts")
    written = SparkSession.getActiveSession().read.schema("kmer string, cnt long, sample string").parquet(f"{path}/counts")
    counting.database_info(written, k, both_strands).write.parquet(f"{path}/info")


@dataclass(frozen=True)
class KmerDatabase:
    """One sample's k-mers and counts, with an inclusive count range that narrows what is listed, counted and found."""

    counts: DataFrame
    kmer_length: int
    both_strands: bool
    original: tuple[int, int]
    low: int
    high: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, sample: str) -> KmerDatabase:
        """Reads the facts only; raises ValueError where there is no such sample."""
        facts = spark.read.parquet(f"{path}/info").where(F.col("sample") == sample).first()
        if facts is None:
            raise ValueError(f"{path} has no sample {sample!r}")
        table = spark.read.schema("kmer string, cnt long, sample string").parquet(f"{path}/counts").where(F.col("sample") == sample)
        return cls(table.select("kmer", "cnt"), facts["kmer_length"], facts["both_strands"], (facts["min_count"], facts["max_count"]), facts["min_count"], facts["max_count"])

    def with_low(self, low: int) -> KmerDatabase:
        """A lower bound inside the original range and up to the upper bound; otherwise ValueError."""
        if not self.original[0] <= low <= self.high:
            raise ValueError(f"{low} is outside {self.original[0]} to {self.high}")
        return replace(self, low=low)

    def with_high(self, high: int) -> KmerDatabase:
        if not self.low <= high <= self.original[1]:
            raise ValueError(f"{high} is outside {self.low} to {self.original[1]}")
        return replace(self, high=high)

    def full_range(self) -> KmerDatabase:
        return replace(self, low=self.original[0], high=self.original[1])

    def listing(self) -> DataFrame:
        """``(kmer, cnt)`` within the range; the bounds reach the Parquet scan."""
        return counting.count_range(self.counts, self.low, self.high)

    def kmer_count(self) -> int:
        return self.listing().count()

    def find(self, probe: DataFrame) -> DataFrame:
        """``probe (kmer)`` with counts, null where there is none; k-mers are taken as given."""
        self._check(probe)
        return lookup.lookup(probe, self.counts, self.low, self.high)

    def contained(self, probe: DataFrame) -> DataFrame:
        self._check(probe)
        return lookup.contained(probe, self.listing())

    def counters(self, reads: DataFrame) -> DataFrame:
        """``(read_id, counters)``: the count at each position of each read."""
        return lookup.counter_arrays(lookup.counters(reads, self.listing(), self.kmer_length, self.both_strands))

    def _check(self, probe: DataFrame) -> None:
        if "kmer" not in probe.columns:
            raise ValueError("the probe needs a column kmer")
