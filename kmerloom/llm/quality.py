"""Quality rules: base counts of every text and a hashed n-gram logistic regression with calibrated probabilities.

Words are runs of characters other than ASCII white space (space and U+0009 to U+000D). The regression reads word 1- and
2-grams and character 3- and 4-grams, hashed into fixed slots; each family's counts are divided by their sum, so that a
text's length does not move its score. It is fitted on at most ``max_rows`` labelled documents, those with the smallest
hashes of doc_id; a fifth of them is set aside to calibrate the probabilities (Platt scaling). Every document is scored
over its whole text, in Arrow batches, against a fixed threshold.

Defined cases: a null text is an empty one; a label that is null or neither 0 nor 1 is ignored; a document with several
labels takes the smallest; rows that repeat a doc_id are judged each by its own text and count once in the fit; a very
long text is read whole; input columns named like results are replaced by ``score_quality`` and untouched by
``keep_quality``; an empty table gives an empty result; with no labels, or labels of one class only, the model keeps what the base rules keep.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .features import char_slots, counted, word_slots

BITS = 15
MAX_ROWS = 3000
THRESHOLD = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that stand in a window of ``size`` words which the text holds twice or more."""
    windows = list(zip(*(words[k:] for k in range(size)), strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    twice = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return int((np.cumsum(steps) > 0).sum())


def base_counts(text: str, words: list[bytes], n_bytes: int) -> tuple[int, int, int, int, int]:
    """``COUNTS`` of one text; ``words`` are its words as UTF-8."""
    n_space = n_bytes - sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    return len(words), len(text) - n_space, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def families(text: str, words: list[bytes]) -> Iterator[list[np.ndarray]]:
    """Slots of word n-grams, then of character n-grams."""
    yield list(word_slots(words, (1, 2), BITS))
    yield list(char_slots(text, (3, 4), BITS))


@dataclass
class QualityModel:
    """``weights`` per slot; probability = sigmoid(scale * score + shift). ``weights`` None: every text passes."""

    weights: np.ndarray | None
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def probability(self, text: str, words: list[bytes]) -> float:
        if self.weights is None:
            return 1.0
        score = self.bias
        for slots in families(text, words):
            if n := sum(map(len, slots)):
                score += sum(float(self.weights[s].sum()) for s in slots) / n
        return float(1 / (1 + np.exp(-np.clip(self.scale * score + self.shift, -50, 50))))


def _training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Label, slots and values of the sampled documents."""
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most max_rows pairs of numbers, whatever the table's size.
    joined = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, quality, text in pdf.itertuples(index=False):
                words = text.encode().split()
                at, value = [np.empty(0, np.int64)], [np.empty(0)]
                for slots in families(text, words):
                    a, n = counted(slots, BITS)
                    at.append(a)
                    value.append(n / max(1, n.sum()))
                rows.append((doc_id, quality, np.concatenate(at).astype("<u2").tobytes(), np.concatenate(value).astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "quality", "at", "value"])

    features = joined.mapInPandas(run, "doc_id long, quality int, at binary, value binary")
    # Rows that repeat a doc_id become one in Spark: no more than max_rows come to the driver.
    one = features.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct("at", "value")).alias("features"))
    found = one.select("doc_id", "quality", "features.*").toPandas().sort_values("doc_id")
    return [(q, np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for q, a, v in zip(found["quality"], found["at"], found["value"], strict=True)]


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = 4) -> QualityModel:
    """Fit and calibrate the regression on at most ``max_rows`` labelled documents."""
    rows = _training_rows(docs, labels, max_rows)
    if len({q for q, _, _ in rows}) < 2:
        return QualityModel(None)
    order = np.random.default_rng(7).permutation(len(rows))
    held, fitted = order[: len(rows) // 5], order[len(rows) // 5 :]
    if len({rows[k][0] for k in held}) < 2 or len({rows[k][0] for k in fitted}) < 2:
        held = fitted = order
    share = {c: sum(rows[k][0] == c for k in fitted) / len(fitted) for c in (0, 1)}
    w, bias = np.zeros(1 << BITS), 0.0
    seen = np.full(1 << BITS, 1e-6)
    rate = 2.0
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(fitted):
            q, at, value = rows[k]
            score = bias + w[at] @ value
            # Both classes carry the same weight.
            error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - q) * 0.5 / share[q]
            gradient = error * value + 1e-7 * w[at]
            np.add.at(seen, at, gradient * gradient)
            np.subtract.at(w, at, rate * gradient / np.sqrt(seen[at]))
            bias -= 0.05 * error
    scores = np.array([bias + w[rows[k][1]] @ rows[k][2] for k in held])
    labels_ = np.array([rows[k][0] for k in held], float)
    scale, shift = _platt(scores, labels_)
    return QualityModel(w.astype(np.float32), float(bias), scale, shift)


def _platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift by Newton steps on the smoothed log loss."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    goal = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = scores.std() or 1.0
    x = np.stack([scores / spread, np.ones_like(scores)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        g = x.T @ (p - goal) + 1e-3 * theta
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 1e-3) / spread), float(theta[1])


def _scored(docs: DataFrame, model: QualityModel, threshold: float, name: str) -> DataFrame:
    """``docs`` with a struct of counts and verdict in the new column ``name``."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", quality_prob double, base_failed boolean, kept boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                data = text.encode()
                words = data.split()
                counts = base_counts(text, words, len(data))
                failed, p = base_failed(counts[0], counts[4]), model.probability(text, words)
                rows.append((*counts, p, failed, not failed and p >= threshold))
            yield pd.DataFrame(rows, columns=[*COUNTS, "quality_prob", "base_failed", "kept"])

    return docs.withColumn(name, run(F.col("text").cast("string")))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``COUNTS``, ``quality_prob``, ``base_failed`` and ``kept``; columns of these names are replaced."""
    kept = common.without(docs, *COUNTS, "quality_prob", "base_failed", "kept")
    name = common.free_name(kept, "scored")
    return _scored(kept, model, threshold, name).select(*[common.column(c) for c in kept.columns], f"{name}.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, common.read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "quality_prob")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``op4_quality_rules`` that needs no model, by the same code."""
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, QualityModel(None)).select("doc_id", *COUNTS, "base_failed")


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all columns of ``docs`` as they are, whatever their names."""
    name = common.free_name(docs, "scored")
    scored = _scored(docs, fit_quality(docs, labels), THRESHOLD, name)
    return scored.where(F.col(name)["kept"]).select(*[common.column(c) for c in docs.columns])
