import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kmerloom.llm import components, embedding_dedup, simhash, suffix_arrays, suffix_dedup


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)] + [(7, 7)]
    rows = components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()
    want = roots([x for x in links if x[0] != x[1]])
    assert {r["node"] for r in rows} == set(want)
    pairs = {(want[r["node"]], r["root"]) for r in rows}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# Embeddings.


def brute_vectors(rows, threshold):
    good = [(k, np.array(v, float)) for k, v in enumerate(r[1] for r in rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, links = [0] * len(rows), []
    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[a] += 1
                n[b] += 1
                links.append((a, b))
    root = roots(links)
    return sorted((r[0], n[k], rows[root.get(k, k)][0]) for k, r in enumerate(rows))


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_embeddings(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 512 if block_bytes > 300 else 8)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 8))
    rows = [(k, [float(x) for x in np.float32(base[k % 12] + rng.normal(size=8) * 0.25)]) for k in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(10)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [None] + [1.0] * 7), (304, [1.0, 2.0]), (305, [2.0, 4.0]), (306, [float("inf")] * 8), (307, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    got = sorted(tuple(r) for r in embedding_dedup.embedding_components(df, 0.9, block_bytes).collect())
    assert got == brute_vectors([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 0.9)
    assert sum(r[1] for r in got) > 100


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.embedding_components(empty).count() == 0
    only_bad = spark.createDataFrame([(5, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embedding_dedup.embedding_components(only_bad).collect()] == [(5, 0, 5)]


def test_tiles_lose_no_pair():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16))
    x[350:] = x[:350] + rng.normal(size=(350, 16)) * 0.2
    axes, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    found = {(min(int(a), int(b)), max(int(a), int(b))) for i, j in embedding_dedup.tile_pairs(x, x, axes, 0.95, True) for a, b in zip(i, j, strict=True)}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert found == set(zip(*np.nonzero(np.triu(u @ u.T >= 0.95, 1)), strict=True))


    two = {(int(a), int(b)) for i, j in embedding_dedup.tile_pairs(x[:300], x[300:], axes, 0.95, False) for a, b in zip(i, j, strict=True)}
    assert two == {(a, b - 300) for a, b in found if a < 300 <= b}


def test_extreme_components(spark):
    rows = [(1, [1e300, 2e300]), (2, [2e-300, 4e-300]), (3, [1.0, 2.0]), (4, [-1.0, 2.0]), (5, [5e-324, 1e-323])]
    got = embedding_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4), (5, 3, 1)]


# SimHash.


def brute_print(text):
    from xxhash import xxh64

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("chunk", [2048, 4])
def test_simhash(spark, docs, chunk):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(15)]
    rows = []
    for k in range(90):
        t = texts[k % 15].split()
        for _ in range(k // 15):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((k, " ".join(t)))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "Ünï CODE"), (104, "ünï code"), (105, rows[0][1]), (105, rows[0][1]), (106, "x " * 5000)]
    df = docs([(i, t, None, None, 1) for i, t in rows])
    prints = [brute_print(t) for _, t in rows]
    assert [simhash.fingerprint(t) for _, t in rows] == prints
    want = roots([(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3])
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.simhash_components(df, chunk).collect())
    assert got == sorted((rows[k][0], rows[want.get(k, k)][0]) for k in range(len(rows)))
    kept = sorted(r["doc_id"] for r in simhash.keep_first(df, chunk).collect())
    assert kept == sorted({c for _, c in got})


def test_simhash_keeps_columns_and_handles_nulls(spark):
    df = spark.createDataFrame([(None, "a b c", 1, 2), (None, "a b c", 1, 3), (4, None, 5, 6)], "doc_id long, text string, fp int, row int")
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and kept.count() == 2
    assert simhash.keep_first(df.where("false")).count() == 0


def test_members_compared_in_chunks():
    rng = np.random.default_rng(4)
    fp = np.sort((np.uint64(0xABCD << 32) | rng.integers(0, 1 << 12, 200).astype(np.uint64)).view(np.int64))
    fp = np.unique(fp)
    zero = np.zeros(len(fp), np.int64)
    u, v = simhash.compare_members(zero + (32 << 32) + (1 << 38) + 0xABCD, zero, zero.astype(np.int32), fp)
    close = [(int(a), int(b)) for i, a in enumerate(fp) for b in fp[:i] if bin(int(a) ^ int(b)).count("1") <= 3]
    a, b = roots(close), roots(list(zip(u.tolist(), v.tolist(), strict=True)))
    assert {x: a[x] for x in a} == b


# Suffix arrays.


def test_suffix_arrays_against_sorting():
    rng = random.Random(1)
    for trial in range(120):
        runs = [bytes(rng.choices(b"ab\0" if trial % 2 else b"abc", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        laid = suffix_arrays.Runs.of(runs)
        order, _ = suffix_arrays.suffix_array(laid)
        signs = [s for i, r in enumerate(runs) for s in [*(1000 + b for b in r), i]]
        want = sorted(range(len(signs)), key=lambda i: signs[i:])
        assert list(order) == want
        prefix = suffix_arrays.common_prefixes(laid, order)
        for a, b in zip(want, want[1:], strict=False):
            k = 0
            while max(a, b) + k < len(signs) and signs[a + k] == signs[b + k]:
                k += 1
            assert prefix[b] == k
        seen = set()
        laid, (later, _) = suffix_arrays.Runs.of(runs), suffix_arrays.later_windows(suffix_arrays.Runs.of(runs), 4)
        for i, r in enumerate(runs):
            for k in range(len(r) - 3):
                assert later[laid.starts[i] + k] == (r[k : k + 4] in seen)
                seen.add(r[k : k + 4])


def test_merging_shards():
    rng = random.Random(2)
    words = [bytes(rng.choices(b"ab", k=4)) for _ in range(200)]
    groups = [rng.randrange(3) for _ in words]
    got = suffix_arrays.later_rows(np.array(groups), np.array(words, "S4"))
    assert got.tolist() == [(g, w) in set(zip(groups[:k], words[:k], strict=True)) for k, (g, w) in enumerate(zip(groups, words, strict=True))]


@pytest.mark.parametrize("settings", [{}, {"shard_bytes": 500, "hot_runs": 2, "sample": 1}])
def test_repeated_strings(spark, docs, settings):
    rng = random.Random(6)

    def prose(n):
        return "".join(rng.choices("abcdefgh é\n", k=n))

    line, base = prose(180), prose(1500)
    rows = [(k, prose(300) + line + prose(200)) for k in range(12)]
    rows += [(20 + k, base[: 700 + k] + "X" + base[701 + k :]) for k in range(8)] + [(40, base), (41, base), (42, "ab" * 400), (43, prose(120) * 4), (44, None), (45, ""), (46, "z" * 99), (47, "z" * 99), (48, "z" * 100), (49, line[:150])]
    df = docs([(i, t, None, None, 1) for i, t in reversed(rows)])
    done = suffix_dedup.dedup_documents(df, **settings)
    got = sorted(tuple(r) for r in done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())
    assert got == suffix_dedup.brute_force(rows)


def test_repeated_rows_and_null_ids(spark, docs):
    text = "".join(random.Random(8).choices("abcdef ", k=250))
    rows = [(5, text), (5, text), (None, text), (-(1 << 63), text), (7, text + "!")]
    done = suffix_dedup.dedup_documents(docs([(i, t, None, None, 1) for i, t in rows]))
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["n_removed"]) for r in done.collect())
    assert got == [(-(1 << 63), 250), (-1, 0), (5, 250), (5, 250), (7, 250)]
    # The first of all is itself repeated, beside a different text with its passages.
    first = suffix_dedup.dedup_documents(docs([(i, t, None, None, 1) for i, t in [(1, text), (1, text), (2, "x" + text[:200])]]))
    assert sorted((r["doc_id"], r["n_removed"]) for r in first.collect()) == [(1, 0), (1, 250), (2, 200)]
    assert suffix_dedup.dedup_documents(docs([])).count() == 0
