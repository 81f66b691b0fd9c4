"""From raw documents to token ids: quality rules, near-duplicates, personal data, mixing, encoding.

Each stage takes what the stage before it kept; all but the last return the columns of ``documents``, whatever their
names. Defined cases: a null or empty text fails the quality rules; of repeated rows and near-duplicates one stays; of
equal doc_ids the text with the smallest fingerprint decides; texts of any length are read whole; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kmerloom.llm import common, mixing, pii, quality, sentencepieces, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_quality(docs, common.read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return pii.replace_entities(docs, pii.session_key(spark, pii.OPEN_KEY), counted=None)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with the words, that the mix takes."""
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text."""
    return sentencepieces.encode_texts(docs, sentencepieces.default_model())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixed_sources),
    ("encoding", encoded),
]

#: Fitted weights, keyed draws and tokenizer files are beyond SQL; the tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what a stage returns is written and read again for the next."""
    docs = common.read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.written(docs, name.replace(" ", "-"))
    return docs
