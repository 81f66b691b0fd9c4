"""The whole analysis as Spark jobs: reads of two groups to significant k-mers, their ranking and contigs."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.packing import MAX_K
from ..functions.parsing import six_digits
from ..functions.sequences import packed
from ..functions.statistics import with_fisher
from ..operators import assembly, counting, matrix, presence, report
from ..sources import binary_database, manifest, reads
from ..sources.blocked_gzip import read_blocked_fastq

HEADER = ("pval", "grp1_high", "grp1_low", "grp2_high", "grp2_low")


@dataclass(frozen=True)
class Settings:
    """Thresholds of an analysis.

    ``legacy``: missing counts as 1, point probabilities, and a cut on the printed p-value that is included. ``matrix``:
    also write the matrix of all counts. ``full_table``: also write the annotated table of all k-mers. ``min_k``: contigs by
    lengths from this one to k; of k alone where k is not above it. ``bins``: parts of a sample's k-mers that are counted on
    their own; at 4,096 a sample of 14 billion bases has some 3 million k-mers in each.
    """

    k: int = 27
    min_count: int = 2
    cmin1: float = 1
    cmin2: float = 0
    p_cut: float = 0.01
    alternative: str = "two"
    count_cap: int | None = None
    legacy: bool = False
    matrix: bool = True
    full_table: bool = False
    min_k: int = 17
    bins: int = 4096


def legacy_settings(**changes) -> Settings:
    return Settings(**({"cmin1": 2, "cmin2": 1, "alternative": "point", "legacy": True} | changes))


@dataclass
class Steps:
    """Rows and seconds of a job's steps; rows are counted while they are written."""

    done: list[tuple[str, int, float]] = field(default_factory=list)

    def write(self, name: str, df: DataFrame, save: Callable[[DataFrame], None]) -> int:
        seen, began = Observation(name), time.time()
        save(df.observe(seen, F.count(F.lit(1)).alias("n")))
        self.done.append((name, seen.get.get("n", 0), round(time.time() - began, 3)))
        return self.done[-1][1]

    def save(self, spark: SparkSession, path: str) -> None:
        """``(step, rows, seconds)`` as JSON lines, in the order of the steps."""
        spark.createDataFrame(self.done, "step string, rows long, seconds double").coalesce(1).write.json(path)


def _counts_schema(k: int) -> str:
    return f"grp int, kmer {'long' if k <= MAX_K else 'string'}, cnt long, sample string"


def count_table(spark: SparkSession, read_table: DataFrame, out: str, settings: Settings, steps: Steps | None = None) -> DataFrame:
    """Counts of all samples, written once: every later step reads this table. k-mers are packed where they fit."""
    counts = counting.count_kmers(read_table, settings.k, settings.min_count, settings.count_cap, keys=("sample", "grp"), packed=settings.k <= MAX_K, bins=settings.bins)
    (steps or Steps()).write("counts", counts, lambda df: df.write.partitionBy("sample").parquet(f"{out}/counts"))
    return open_counts(spark, out, settings.k)


def open_counts(spark: SparkSession, out: str, k: int) -> DataFrame:
    return spark.read.schema(_counts_schema(k)).parquet(f"{out}/counts")


def _text(k: int):
    return (counting.kmer_text("kmer", k) if k <= MAX_K else F.col("kmer")).alias("kmer")


def _annotated(rows: DataFrame, counts: DataFrame, samples: list[str], missing: int, k: int, order: str) -> DataFrame:
    """The table of p, the four cells, the k-mer and every sample's count, with its header."""
    wide = report.annotated(rows, counts, samples, missing)
    cells = [F.col(c).alias(name) for c, name in zip(("p6", *report.CELLS), HEADER, strict=True)]
    return wide.orderBy(order).select(*cells, _text(k), *[F.col("counts")[i].alias(s) for i, s in enumerate(samples)])


def run_association(spark: SparkSession, root: str, out: str, settings: Settings = Settings()) -> dict[str, int]:
    """From ``females/`` and ``males/`` under ``root`` to tables under ``out``; returns numbers of samples and k-mers.

    Block gzip files are read by many tasks each, files of other gzip forms by one.

    Writes ``counts`` and ``tested`` (all k-mers with their tests) as Parquet; ``matrix``, ``significant`` (p, cells, k-mer
    and the counts of all samples), ``top`` and ``averages`` (field and mean of the values above 1 in ``significant``) as
    TSV; ``fasta`` and ``contigs``. Samples without any surviving k-mer still count as samples.
    """
    files = manifest.discover(spark, root)
    # One name per file, as the plan of the scan needs them.
    paths = sorted(r["path"] for r in files.select("path").distinct().collect())
    if not paths:
        raise ValueError(f"{root} has no read files")
    steps = Steps()
    counts = count_table(spark, read_blocked_fastq(spark, paths), out, settings, steps)
    return _analysed(spark, files, counts, out, settings, steps)


def run_databases(spark: SparkSession, root: str, out: str, settings: Settings = Settings()) -> dict[str, int]:
    """As ``run_association``, from the binary databases of external counters under ``root``, whose names start with the group.

    All databases are one scan; counts are as the databases have them. k is theirs and has to be that of the settings.
    """
    files = binary_database.discover_databases(spark, root)
    named = {r["sample"]: r["path"] for r in files.collect()}
    if not named:
        raise ValueError(f"{root} has no databases")
    lengths = {binary_database.read_info(path).kmer_length for path in named.values()}
    if lengths != {settings.k}:
        raise ValueError(f"databases have k-mers of {sorted(lengths)} bases, not {settings.k}")
    listed = binary_database.read_databases(spark, named)
    kmer = packed(F.col("kmer"), settings.k) if settings.k <= MAX_K else F.col("kmer")
    grp = F.when(F.col("sample").startswith("female"), 1).otherwise(2)
    steps = Steps()
    steps.write("counts", listed.select("sample", grp.alias("grp"), kmer.alias("kmer"), "cnt"), lambda df: df.write.partitionBy("sample").parquet(f"{out}/counts"))
    return _analysed(spark, files, open_counts(spark, out, settings.k), out, settings, steps)


def _analysed(spark: SparkSession, files: DataFrame, counts: DataFrame, out: str, settings: Settings, steps: Steps) -> dict[str, int]:
    """What follows the count table: matrix, tests, ranking, tables, contigs, and ``steps``, rows and seconds of each."""
    samples = manifest.sample_order(files)
    sizes = {r["grp"]: r["n"] for r in files.groupBy("grp").agg(F.countDistinct("sample").alias("n")).collect()}
    n1, n2 = sizes.get(1, 0), sizes.get(2, 0)
    missing = 1 if settings.legacy else 0
    if settings.matrix:
        steps.write("matrix", _matrix(spark, out, samples, missing, settings.k), lambda df: reads.write_tsv(df, f"{out}/matrix"))
    tables = presence.presence(counts, n1, n2, settings.cmin1, settings.cmin2, missing=missing)
    n_tested = steps.write("tested", with_fisher(tables, settings.alternative), lambda df: df.write.parquet(f"{out}/tested"))
    tested = spark.read.parquet(f"{out}/tested")
    # p-values are few: each is formatted once.
    digits = tested.select("pval").distinct().withColumn("p6", six_digits("pval"))
    if settings.full_table:
        full = _annotated(tested.join(digits, "pval"), counts, samples, missing, settings.k, "kmer")
        steps.write("full", full, lambda df: reads.write_tsv(df, f"{out}/full"))
    if settings.legacy:
        found = tested.join(digits.where(F.col("p6").cast("double") <= settings.p_cut).drop("p6"), "pval")
    else:
        found = tested.where(F.col("pval") < settings.p_cut)
    n_found = steps.write("ranked", report.ranked(found).select("rank", "pval", "p6", *report.CELLS, "kmer"), lambda df: df.write.parquet(f"{out}/ranked"))
    ranked = spark.read.parquet(f"{out}/ranked")
    steps.write("significant", _annotated(ranked, counts, samples, missing, settings.k, "rank"), lambda df: reads.write_tsv(df, f"{out}/significant"))
    reads.write_tsv(report.top_groups(ranked.withColumn("pval", F.col("p6").cast("double"))), f"{out}/top")
    write_averages(spark, f"{out}/significant", f"{out}/averages")
    text = ranked.withColumn("kmer", _text(settings.k))
    steps.write("fasta", report.fasta_records(text).orderBy("rank"), lambda df: reads.write_fasta(df, f"{out}/fasta"))
    contigs = assembly.iterated_unitigs(text.select(F.col("kmer").alias("seq")), settings.k, min(settings.min_k, settings.k))
    named = contigs.select(F.concat(F.lit("contig_"), F.xxhash64("seq")).alias("name"), "seq")
    steps.write("contigs", named, lambda df: reads.write_fasta(df, f"{out}/contigs"))
    steps.save(spark, f"{out}/steps")
    return {"n1": n1, "n2": n2, "tested": n_tested, "significant": n_found}


def write_averages(spark: SparkSession, table: str, path: str) -> None:
    """``field<TAB>mean`` of an annotated table's fields from the seventh on, means in six digits."""
    lines = spark.read.text(table)
    means = matrix.field_means(lines, header=reads.table_header(spark, table))
    means = means.orderBy("field").select("field", six_digits("avg").alias("avg"))
    means.write.option("sep", "\t").csv(path)


def _matrix(spark: SparkSession, out: str, samples: list[str], missing: int, k: int) -> DataFrame:
    wide = matrix.count_arrays(open_counts(spark, out, k), samples, missing).orderBy("kmer")
    return wide.select(_text(k), *[F.col("counts")[i].alias(s) for i, s in enumerate(samples)])


def export_matrix(spark: SparkSession, out: str, samples: list[str], missing: int = 0, k: int = 27) -> None:
    """The wide matrix of a finished count table as TSV in k-mer order; wide tables are for export only."""
    reads.write_tsv(_matrix(spark, out, samples, missing, k), f"{out}/matrix")


def run_matrix(spark: SparkSession, path: str, n1: int, out: str, settings: Settings = Settings()) -> dict[str, int]:
    """Tests a matrix that is there as TSV with a header: the first ``n1`` samples are group 1.

    Writes ``significant`` (p, cells and each line as it was, with the header brought up to date) and ``averages``.
    """
    lines = spark.read.text(path)
    header = reads.table_header(spark, path)
    tables = matrix.line_tables(lines, n1, settings.cmin1, settings.cmin2, header)
    found = presence.significant(tables, settings.p_cut, settings.alternative, printed=settings.legacy)
    digits = found.select("pval").distinct().withColumn("p6", six_digits("pval"))
    names = [*HEADER, *header.split("\t")]
    fields = F.split("value", "\t", -1)
    wide = found.join(digits, "pval").orderBy("kmer").select(
        *[F.col(c).alias(name) for c, name in zip(("p6", *report.CELLS), HEADER, strict=True)], *[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names[5:])]
    )
    reads.write_tsv(wide, f"{out}/significant")
    write_averages(spark, f"{out}/significant", f"{out}/averages")
    return {"significant": reads.read_tsv(spark, f"{out}/significant").count()}
