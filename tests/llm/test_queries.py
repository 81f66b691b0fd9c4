"""The registered queries on awkward tables and on empty ones, against plain Python."""

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kmerloom.llm import mixing, pii, quality, registry, suffix_dedup, token_records
from kmerloom.llm import sentencepieces as pieces

from .test_dedup import brute_print, brute_vectors, roots
from .test_mining import brute_copies, brute_negatives, brute_phrases
from .test_text import MAIL, brute_counts
from .test_tokens import brute_targets

RNG = random.Random(12)
WORDS = {"en": "the of and that with from this when house water light under".split(), "de": "der die und nicht mit eine auf Haus Wasser Licht unter über".split()}
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use as names of results or of helpers.
CLASHES = ("kept", "n_words", "n_entities", "fp", "row", "score", "size", "scored", "ord", "ids", "Found", "target")


def prose(lang, n):
    return " ".join(RNG.choices(WORDS[lang], k=n))


@cache
def document_rows():
    line = prose("en", 30)
    rows = [(k, prose(("en", "de")[k % 2], RNG.randint(5, 60)), ("en", "de", None)[k % 3], ("b", "a", None)[k % 4 % 3], 1) for k in range(60)]
    rows += [(100 + k, f"{prose('en', 20)} {line} {prose('en', 20)}", "en", "a", 5) for k in range(8)]
    rows += [(200, None, "en", "a", None), (201, "", None, "b", 0), (202, " \n\t", "de", None, 3), (203, "12 !! 34", "en", "a", 8), (None, prose("de", 40), "de", "b", 1)]
    rows += [(204, prose("en", 20_000), "en", "a", 1), (205, "x" * 60_000, None, None, 1), (206, MAIL, "en", "b", 7), (207, MAIL, "en", "b", 7), (208, "ein Ärger▁mit 日本 😀 <|endoftext|>", "de", "c", 1)]
    return [*rows, rows[3], rows[3], (1 << 60, rows[4][1], "de", "c", 1)]


@cache
def page_rows():
    body = "<div><p>Follow us</p></div><article><h1>A{k}</h1><p>Text {k} &amp; more<br>x</p><ul><li>y{k}</ul></article><footer>f</footer>"
    rows = [(k, f"http://h.example/{k}", body.replace("{k}", str(k))) for k in range(8)]
    return [*rows, rows[0], rows[0], (50, None, None), (51, "nohost", ""), (None, "http://h.example/", "<p>" + "word " * 50_000), (53, "http://x", "<b>" * 3000 + "deep"), (54, "", "plain < text")]


@cache
def vector_rows():
    base = np.random.default_rng(4).normal(size=(6, 8))
    rows = [(k, [float(x) for x in np.float32(base[k % 6] + 0.08 * np.random.default_rng(k).normal(size=8))]) for k in range(40)]
    return [*rows, rows[5], (90, rows[7][1]), (91, None), (92, [0.0] * 8), (93, [float("nan")] + [1.0] * 7), (94, [None] + [1.0] * 7), (95, [1.0, 2.0]), (96, [2.0, 4.0]), (97, [])]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Paths of awkward tables and of empty ones."""
    docs = spark.createDataFrame(document_rows(), DOCUMENTS).select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (3, None, None), (9999, 0, 1), (5, 7, 0)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("host", F.lit(1))
    vectors = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>").withColumn("label", F.when(F.col("vec_id") != 90, F.col("vec_id") % 4).cast("int")).withColumn("class", F.lit("own"))
    full, empty = (str(tmp_path_factory.mktemp(x)) for x in ("full", "empty"))
    for name, df in (("documents", docs), ("labels", labels), ("pages", pages), ("embeddings", vectors)):
        df.repartition(3).write.parquet(f"{full}/{name}.parquet")
        df.where("false").write.parquet(f"{empty}/{name}.parquet")
    return full, empty


def run(spark, tables, name):
    return registry.QUERIES[name](spark, tables[0]).collect()


@pytest.mark.parametrize("name", [*registry.QUERIES, "pipeline"])
def test_empty_tables(spark, tables, name):
    query = corpus_pipeline.run if name == "pipeline" else registry.QUERIES[name]
    assert query(spark, tables[1]).count() == 0


def test_op1(spark, tables):
    rows = vector_rows()
    clean = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in run(spark, tables, "op1_embedding_dedup"))
    assert got == brute_vectors(clean, 0.95) and sum(n for _, n, _ in got) > 50


def test_op2(spark, tables):
    rows = sorted(((i, t) for i, t, *_ in document_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = [tuple(r)[:5] for r in run(spark, tables, "op2_suffix_dedup")]
    assert sorted(map(str, got)) == sorted(map(str, suffix_dedup.brute_force(rows)))
    assert sum(r[2] for r in got) > 1000


def test_op3(spark, tables):
    rows = document_rows()
    prints = [brute_print(t) for _, t, *_ in rows]
    root = roots([(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3])
    least = {}
    for k, (i, *_) in enumerate(rows):
        group = root.get(k, k)
        least[group] = min((x for x in (least.get(group), i) if x is not None), default=None)
    want = [(i, f"{prints[k]:016x}", least[root.get(k, k)]) for k, (i, *_) in enumerate(rows)]
    assert sorted(map(str, map(tuple, run(spark, tables, "op3_simhash")))) == sorted(map(str, want))


def test_op4(spark, tables):
    rows = {(r["doc_id"], r["n_words"]): r for r in run(spark, tables, "op4_quality_rules")}
    docs, labels = (spark.read.parquet(f"{tables[0]}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels)
    kept = 0
    for i, t, *_ in document_rows():
        n = brute_counts(t)
        r = rows[(i, n[0])]
        assert tuple(r[c] for c in quality.COUNTS) == n
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        passed = not failed and model.probability(t or "", (t or "").encode().split()) >= quality.THRESHOLD
        assert (r["base_failed"], r["kept"]) == (failed, passed)
        kept += passed
    assert kept
    base = registry.QUERIES["quality_base_counts"](spark, tables[0])
    assert sorted(map(str, map(tuple, base.collect()))) == sorted(str((i, *(n := brute_counts(t)), n[0] < 10 or 100 * n[4] > 20 * n[0])) for i, t, *_ in document_rows())


def test_op5(spark, tables):
    rows = run(spark, tables, "op5_html_text")
    pages = page_rows()
    assert Counter(r["page_id"] for r in rows) == Counter(r[0] for r in pages)
    got = {r["page_id"]: r for r in rows}
    for k in range(8):
        assert got[k]["text"] == f"A{k}\nText {k} & more x\ny{k}"
    assert got[50]["text"] == got[51]["text"] == "" and got[53]["text"] == "deep" and got[54]["text"] == "plain < text"
    assert got[None]["text"] == " ".join(["word"] * 50_000)
    assert all(r["n_chars"] == len(r["text"]) and r["url"] in {p[1] for p in pages} for r in rows)


def test_op6(spark, tables):
    rows = run(spark, tables, "op6_pii_surrogates")
    texts = Counter((r[0], r[1] is None) for r in document_rows())
    assert Counter((r["doc_id"], r["text"] is None) for r in rows) == texts
    own = {r[0]: r[1] for r in document_rows()}
    new = {r["doc_id"]: r["text"] for r in rows}
    assert new[206] == new[207] != own[206]
    for part in ("Anna.99", "555-7713", "190.137.223.204", "1111", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "Maria", "Schmidt", "Jones"):
        assert part in own[206] and part not in new[206]
    for r in rows:
        found = pii.find_entities(own[r["doc_id"]])
        assert r["n_entities"] == len(found)
        if not found:
            assert r["text"] == own[r["doc_id"]]
        assert all(own[r["doc_id"]][s:e] not in r["text"] for s, e, *_ in found)


def test_op7(spark, tables):
    rows = run(spark, tables, "op7_mixing")
    assert sorted(map(str, rows)) == sorted(map(str, run(spark, tables, "op7_mixing")))
    docs = document_rows()
    sizes = Counter()
    for _, t, _, source, _ in docs:
        sizes[source] += len((t or "").split())
    names = [*sorted(s for s in sizes if s is not None), None]
    goal = brute_targets([sizes[s] for s in names], [1 + k % 3 for k in range(len(names))])
    known = {sizes[s]: (s, g) for s, g in zip(names, goal, strict=True)}
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r[0], len((r[1] or "").split())) for r in docs)
    taken = Counter()
    for r in rows:
        source, target = known[r["source_size"]]
        assert r["target"] == pytest.approx(target) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - g) <= max(2, 0.03 * g) for s, g in zip(names, goal, strict=True))
    parts = registry.QUERIES["mixing_targets"](spark, tables[0]).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 3)) for r in parts) == Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 3)) for r in rows)


def test_op8(spark, tables):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.default_model())
    rows = run(spark, tables, "op8_sentencepieces")
    own = {r[0]: r[1] for r in document_rows()}
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in document_rows())
    for r in rows:
        text = own[r["doc_id"]]
        assert (r["ids"], r["round_trip"]) == (None, None) if text is None else r["round_trip"]
        if text is not None and "▁" not in text:
            assert list(r["ids"]) == library.encode(text)


def test_op9(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_records.default_tokenizer())
    order = sorted(document_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    rows, start = sorted(run(spark, tables, "op9_token_records"), key=lambda r: r["start"]), 0
    assert [r["doc_id"] for r in rows] == [r[0] for r in order]
    for r, (i, t, *_) in zip(rows, order, strict=True):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op10(spark, tables):
    rows = run(spark, tables, "op10_language_id")
    own = {r[0]: r[1] for r in document_rows()}
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in document_rows())
    for r in rows:
        text = own[r["doc_id"]] or ""
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text)) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in ("en", "de", "und")


def test_op11(spark, tables):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{tables[0]}/embeddings.parquet").collect()]
    moved = [(i, (label + 1) % 10 if label is not None and i % 7 == 0 else label, v) for i, label, v in rows]
    got = sorted(str(tuple(r)) for r in run(spark, tables, "op11_hard_negatives"))
    assert got == brute_negatives(moved) and got


def test_op12(spark, tables):
    got = sorted(tuple(r) for r in run(spark, tables, "op12_phrase_mining"))
    assert got == brute_phrases([(t, lang) for _, t, lang, *_ in document_rows()]) and len(got) > 100


def test_op13(spark, tables):
    assert sorted(str(tuple(r)) for r in run(spark, tables, "op13_exact_dedup")) == brute_copies([r[:2] for r in document_rows()])


def test_pipeline_keeps_columns(spark, tables):
    """Every stage but the last returns the input's own columns, whatever their names, and values it does not change."""
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    names, own = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    settings = dict(spark.sparkContext.getConf().getAll()) | {"batch": spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")}
    last = None
    for name, stage in corpus_pipeline.STAGES:
        last, docs = docs, stage(spark, docs, tables[0])
        if name != "encoding":
            docs.write.parquet(path := f"{tables[0]}/{name.replace(' ', '-')}")
            docs = spark.read.parquet(path)
            assert docs.columns == names
            rows = docs.collect()
            assert rows and all(r[c] == own[r["doc_id"]][c] for r in rows for c in CLASHES)
            if name in ("near-duplicates", "personal data"):
                assert max(Counter(r["doc_id"] for r in rows).values()) == 1
    assert docs.count() == last.count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == settings["batch"]
    assert mixing.BLOCK_WORDS == 64
