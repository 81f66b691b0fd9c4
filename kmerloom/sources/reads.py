"""Sequencing reads as tables, and tables as FASTA and TSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import text_to_bases
from .manifest import GROUPS, sample_of


def read_fastq(spark: SparkSession, paths: str | list[str], groups: tuple[str, str] = GROUPS) -> DataFrame:
    """``(path, grp, sample, seq)`` of four-line FASTQ files, compressed or plain.

    Lines are cut where a line starts with ``@``, which every record does. A quality line that starts so is cut off its
    record, which loses nothing: a piece is a record if its third line starts with ``+``, and its second is the sequence.
    Plain files can thereby be split anywhere and are read by many tasks; gzip cannot be split, so that many files per
    sample, not large ones, spread the work. Files without records give no rows; a truncated last record has none either.
    """
    pieces = spark.read.option("lineSep", "\n@").text(paths).select(F.input_file_name().alias("path"), F.split("value", "\r?\n", 4).alias("lines"))
    records = pieces.where((F.size("lines") >= 3) & F.get("lines", F.lit(2)).startswith("+"))
    grp = F.when(F.col("path").rlike(f"(?:^|/){groups[0]}/"), 1).otherwise(2)
    return records.select("path", grp.alias("grp"), sample_of(F.col("path"), groups).alias("sample"), F.get("lines", F.lit(1)).alias("seq"))


def dealt(df: DataFrame) -> DataFrame:
    """``df``, a plain scan, dealt over the cores where it has fewer splits than there are cores.

    On tables of many splits nothing is shuffled; a single file of one row group would leave all cores but one idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def document_reads(spark: SparkSession, sf_dir: str, deal: bool = False, joined: bool = False) -> DataFrame:
    """``(read_id, grp, sample, seq)``: whole texts of ``documents`` as reads; group 1 is English.

    A sample is a language and a source. Rows without a text, language or source are no reads. ``deal``: see ``dealt``; ``joined``:
    letters only, so that long k-mers do not end with each word.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null and lang is not null and source is not null")
    if deal:
        docs = dealt(docs.select("doc_id", "lang", "source", "text"))
    grp = F.when(F.col("lang") == "en", 1).otherwise(2)
    return docs.select(F.col("doc_id").alias("read_id"), grp.alias("grp"), F.concat_ws("-", "lang", "source").alias("sample"), text_to_bases(F.col("text"), joined).alias("seq"))


def write_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Tab-separated files in the order of the rows' partitions, with one header: the first file by name holds it alone.

    The files one after another, also compressed, are the whole table in order: ``cat part-*`` is one gzip file.
    """
    cells = [F.coalesce(F.col("`" + c.replace("`", "``") + "`").cast("string"), F.lit("")) for c in df.columns]
    header = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string").coalesce(1)
    # A union keeps the order of partitions, and parts are numbered by it.
    header.union(df.select(F.concat_ws("\t", *cells).alias("value"))).write.option("compression", compression).text(path)


def table_header(spark: SparkSession, path: str) -> str:
    """The first line of the first file by name of a tab-separated table."""
    files = sorted(spark.read.text(path).inputFiles())
    first = spark.read.text(files[0]).first() if files else None
    return "" if first is None else first["value"] or ""


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_tsv`` as columns of strings; lines equal to the header are no rows."""
    header = table_header(spark, path)
    cells = F.split("value", "\t", -1)
    return spark.read.text(path).where(F.col("value") != header).select(*[F.get(cells, F.lit(i)).alias(name) for i, name in enumerate(header.split("\t"))])


def write_fasta(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """FASTA files of ``(name, seq)``."""
    records.select(F.concat(F.lit(">"), F.col("name"), F.lit("\n"), F.col("seq")).alias("value")).write.option("compression", compression).text(path)
