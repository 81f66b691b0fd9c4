import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kmerloom.llm import exact_dedup, hard_negatives, phrases

# Exact duplicates.

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    out = []
    for i, t in rows:
        own = (t or "").translate(FOLD)
        keep = max((x for x in groups[own] if x is not None), default=None)
        out.append((i, keep, len(groups[own]), i == keep, hashlib.sha256(own.encode()).hexdigest()))
    return sorted(map(str, out))


@settings(max_examples=150, deadline=None)
@given(st.integers(4, 60), st.lists(st.tuples(st.integers(0, (1 << 60) - 1), st.integers(1, 9)), max_size=60))
def test_filters_keep_counts(bits, pairs):
    want = Counter()
    for v, n in pairs:
        want[v % (1 << bits)] += n
    parts = [{}, {}, {}]
    for k, v in enumerate(sorted(want)):
        for j in range(3):
            n = want[v] // 3 + (j < want[v] % 3)
            if n:
                parts[(j + k) % 3][v] = n
    filters = []
    for part in parts:
        values = np.array(sorted(part), np.uint64)
        f = exact_dedup.CountingQuotientFilter.of(values, np.array([part[int(v)] for v in values], np.int64), bits)
        filters.append(exact_dedup.CountingQuotientFilter.from_bytes(f.to_bytes()))
    values, counts = exact_dedup.merged(filters).items()
    assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == dict(want) and (np.diff(values.astype(object)) > 0).all()


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_exact_duplicates(docs, broadcast_rows):
    rng = random.Random(5)
    texts = ["Ab c", "ab C", "ÄB", "äb", "", None, "x" * 50_000, "X" * 50_000] + [f"t{k}" for k in range(30)]
    rows = [(k, rng.choice(texts), "en", None, 1) for k in range(200)] + [(None, "only null", None, None, 1), (None, "t3", None, None, 1), (500, "t3", None, None, 1), (500, "T3", None, None, 1)]
    df = docs(rows).withColumn("fp", F.lit("own")).withColumn("keep_id", F.lit(7)).repartition(5)
    found = exact_dedup.exact_duplicates(df, shard=8, broadcast_rows=broadcast_rows)
    got = sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["doc_id"] == r["keep_id"], r["text_sha256"])) for r in found.collect())
    want = brute_copies([r[:2] for r in rows])
    assert got == want and any("500, 500" in x for x in got)
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(x.split(",")[0][1:] for x in want if ", True, " in x)


# Phrases.


def brute_phrases(rows, least=10, top=2000):
    """``rows``: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    often = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    by = defaultdict(list)
    for (lang, p), a in often.items():
        if any(lang == other and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 50 * a for (other, q), b in often.items()):
            continue
        cuts = [((1_000_000 * a * a) // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, found in by.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize(("bits", "modulus"), [(27, 24), (10, 2), (12, 10_000)])
def test_phrases(spark, bits, modulus):
    rng = random.Random(6)
    words = ["a", "b", "B", "c d", "é", "New", "york", "city", "\x1c", "zz9"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))) + rng.choice(["", ".", "\n", " , ", "\t!\r\n?x"]), rng.choice(["en", "de", None])) for _ in range(300)]
    rows = [(a + (" " + b if k % 3 else b), lang) for k, ((a, lang), (b, _)) in enumerate(zip(rows, reversed(rows), strict=True))]
    rows += [(None, "en"), ("", None), ("a " * 3000, "en"), ("same words here again " * 4, "fr"), ("same words here again " * 4, "fr"), ("same words here again\tsame words", "fr")]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit(1)).withColumn("size", F.lit("own")).repartition(3)
    got = sorted(tuple(r) for r in phrases.phrases(df, sketch_bits=bits, modulus=modulus).collect())
    assert got == brute_phrases(rows) and {r[0] for r in got} == {"en", "de", "fr", "und"}
    few = sorted(tuple(r) for r in phrases.phrases(df, top=3, sketch_bits=bits).collect())
    assert few == brute_phrases(rows, top=3)


def test_chunks_overlap_once():
    rng = random.Random(7)
    for modulus in (1, 3, 50):
        text = " ".join(rng.choices("ab cd ef . gh".split(), k=200)).encode()
        tokens = phrases.tokens_of(text)
        chunks = [c.split(b" ") for c in phrases.chunks_of(text, modulus)]
        assert [t for c in chunks for t in c[:-2]] == tokens
        assert all(a[-2:] == b[:2] for a, b in zip(chunks, chunks[1:], strict=False))


def test_scores_beyond_64_bits(spark, monkeypatch):
    grams = [("en", 1, "x", 10**13 + 7), ("en", 1, "y", 10**13 + 1), ("en", 2, "x y", 10**13 - 3)]
    monkeypatch.setattr(phrases, "dictionary", lambda docs, modulus: docs)
    monkeypatch.setattr(phrases, "gram_counts", lambda *_: spark.createDataFrame(grams, "lang string, size int, phrase string, f long"))
    row = phrases.phrases(spark.range(1)).first()
    assert row["score"] == 1_000_000 * (10**13 - 3) ** 2 // ((10**13 + 7) * (10**13 + 1)) and row["n"] == 2 * 10**13 + 8


# Hard negatives.


def brute_negatives(rows, k=5, m=3, every=50):
    """``rows``: (vec_id, label, vector), labels as they take part."""
    good = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    for at, (i, label, q) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(max(-hard_negatives.TOP, min(hard_negatives.TOP, sum(a * b for a, b in zip(q, v, strict=True)))), j, other) for b, (j, other, v) in enumerate(good) if b != at and len(v) == len(q)]
        for p, j, _ in sorted((s for s in scored if s[2] == label), key=order)[:k]:
            window = sorted((s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p), key=order)[:m]
            out += [(i, j, r, n, p, s) for r, (s, n, _) in enumerate(window, 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize(("block_rows", "own_tree", "leaf"), [(10_000, 64, 32), (40, 4, 2)])
def test_hard_negatives(spark, block_rows, own_tree, leaf, monkeypatch):
    monkeypatch.setattr(hard_negatives, "OWN_TREE", own_tree)
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(9, 6))
    rows = [(k, k % 4, [float(x) for x in np.float32(base[k % 9] * (1 + k % 3) + rng.normal(size=6) * 0.3)]) for k in range(600)]
    rows += [(1000 + k, k % 3, rows[50][2]) for k in range(30)] + [rows[100], rows[100], rows[7]]
    rows += [(2000, 1, None), (2050, None, rows[0][2]), (2100, 1, [float("nan")] * 6), (2150, 2, [None] * 6), (2200, 1, []), (2201, 1, []), (2202, 2, []), (2250, 3, [0.0] * 6), (2300, 1, [1.0, 2.0]), (2301, 1, [1.5, 2.0]), (2302, 0, [1.0, 1.0]), (None, 1, rows[0][2]), (None, 0, rows[1][2]), (-50, 2, rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("uid", F.lit("own")).repartition(3)
    got = sorted(str(tuple(r)) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, block_rows=block_rows, anchor_rows=7).collect())
    assert got == brute_negatives(rows) and len(got) > 100


def test_scores_beyond_doubles(spark):
    rows = [(0, 1, [1e12, 3.0]), (1, 1, [1e12, 5.0]), (2, 2, [6e11, 1.0]), (3, 2, [6e11, 2.0]), (50, 1, [1e300, 1.0]), (51, 2, [7e-1, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(str(tuple(r)) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_negatives(rows)


def test_cover_trees_hold_their_rows():
    rng = np.random.default_rng(9)
    x = np.floor(256 * np.concatenate([rng.normal(size=(200, 5)) * 0.05 + c for c in rng.normal(size=(6, 5))]))
    ids = np.arange(len(x))
    f = hard_negatives.build_forest(x, ids, ids, ids < 0, ids % 2, 6)
    assert sorted(f.uid.tolist()) == ids.tolist() and len(f.center) > 20

    def below(node):
        return [*range(f.rows[node], f.rows[node + 1]), *(r for kid in f.kids[f.child[node] : f.child[node + 1]] for r in below(kid))]

    q = np.floor(256 * rng.normal(size=5))
    search = hard_negatives.Search(f, q)
    for node in range(len(f.center)):
        (low,), (high,) = search.bounds(np.array([node]))
        s = f.x[below(node)] @ q
        assert low <= s.min() and s.max() <= high
