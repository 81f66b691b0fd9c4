"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; their character 1- to 3-grams are hashed into fixed slots. Document frequencies cover all
documents that may be learned from. The weights are fitted with follow-the-regularised-leader and elastic-net penalties
on at most ``per_language`` documents of each language, those with the smallest hashes of doc_id; a fifth of them is set
aside to fit the temperature that turns scores into probabilities. The number of languages is taken to be small, since
per-language counts and weights meet on the driver.

Defined cases: a text that is null or has no letter gets ``und`` with score 0; a null doc_id counts as held out; with
nothing to learn from every text gets ``und``; repeated rows are learned from and predicted each on its own; of equal
scores the language that sorts first wins; a very long text is read whole, in pieces; input columns named like results
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .features import char_slots, counted

BITS = 15
SIZES = (1, 2, 3)
PER_LANGUAGE = 1000
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def text_slots(text: str) -> tuple[np.ndarray, np.ndarray]:
    return counted(char_slots(text.lower(), SIZES, BITS), BITS)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots x languages
    bias: np.ndarray
    temperature: float = 1.0

    def scores(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        value = n * self.idf[at]
        norm = np.sqrt(value @ value) or 1.0
        return (value / norm) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0
        s = self.scores(*text_slots(text)) / self.temperature
        p = np.exp(s - s.max())
        k = int(p.argmax())
        return self.languages[k], float(p[k] / p.sum())


def held_out(doc_id: str = "doc_id"):
    """True where a document must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and of texts that hold each slot: summed in tasks, then in Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, texts = np.zeros(1 << BITS, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                at, _ = text_slots(text)
                total[at] += 1
                texts += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(total[at], texts)})

    rows = docs.select("text").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BITS, np.int64)
    known = rows[rows["slot"] >= 0]
    out[known["slot"].to_numpy()] = known["n"].to_numpy()
    return int(rows.loc[rows["slot"] < 0, "n"].sum()), out


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by per-coordinate follow-the-regularised-leader on ``(class, slots, values)`` rows."""
    z, n = np.zeros((1 << BITS, n_classes)), np.zeros((1 << BITS, n_classes))
    bias = np.zeros(n_classes)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            label, at, value = rows[k]
            zk, nk = z[at], n[at]
            w = weights(zk, nk)
            s = value @ w + bias
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = value[:, None] * p
            grown = nk + g * g
            z[at] = zk + g - (np.sqrt(grown) - np.sqrt(nk)) / alpha * w
            n[at] = grown
            bias -= 0.02 * p
    return weights(z, n), bias


def fit_language(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on the documents of ``(doc_id, text, lang)`` that are not held out and have a language and a letter."""
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    counts = sorted((r["lang"], r["count"]) for r in known.groupBy("lang").count().collect())
    languages = [lang for lang, _ in counts]
    if not languages:
        return LanguageModel([], np.ones(1 << BITS), np.zeros((1 << BITS, 0)), np.zeros(0))
    n_texts, df = document_frequencies(known)
    idf = np.log((1 + n_texts) / (1 + df)) + 1
    # A language's documents below a hash bound: about per_language of them, found without sorting or gathering any group.
    spot = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    bounds = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(1 << 30, (per_language << 30) // n + 1))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text, lang in pdf.itertuples(index=False):
                if has_letter(text):
                    at, n = text_slots(text)
                    rows.append((doc_id, lang, at.astype("<u2").tobytes(), n.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "at", "n"])

    picked = known.where(spot < F.element_at(bounds, F.col("lang")))
    found = picked.select("doc_id", "text", "lang").mapInPandas(run, "doc_id long, lang string, at binary, n binary").toPandas()
    found = found.sort_values(["doc_id", "lang", "at"], kind="stable")
    rows = []
    for lang, at, n in zip(found["lang"], found["at"], found["n"], strict=True):
        at = np.frombuffer(at, "<u2").astype(np.int64)
        value = np.frombuffer(n, "<u4") * idf[at]
        rows.append((languages.index(lang), at, value / (np.sqrt(value @ value) or 1.0)))
    order = np.random.default_rng(5).permutation(len(rows))
    held = [rows[k] for k in order[: len(rows) // 5]]
    w, bias = fit_ftrl([rows[k] for k in order[len(rows) // 5 :]] or rows, len(languages))
    model = LanguageModel(languages, idf.astype(np.float32), w.astype(np.float32), bias)
    if held:
        s = np.array([value @ w[at] + bias for _, at, value in held])
        labels = np.array([label for label, _, _ in held])
        model.temperature = fit_temperature(s, labels)
    return model


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on held-out rows."""

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(labels)), labels]))

    return float(min(np.geomspace(0.05, 10, 100), key=loss))


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced. Only ``text`` is read."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = common.without(docs, "lang_pred", "score")
    name = common.free_name(kept, "found")
    return kept.withColumn(name, run(F.col("text").cast("string"))).select(*[common.column(c) for c in kept.columns], f"{name}.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; the model never sees the held-out fifth."""
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs)
    return predict_language(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
