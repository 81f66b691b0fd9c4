import random
import zlib
from sys import getsizeof

import numpy as np
import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F

from kmerloom.llm import common, mixing, sentencepieces, token_records

TEXTS = ["Hello  World\n\tfoo é日本", "", None, " lead", "a" * 300, "the Öl-Preis, naïve!! 's it's 12½ ǅ <|endoftext|> İstanbul ß́", "x\x1cy z é", "▁ own ▁", "\x00\x01 ok"]


# Records.


def test_words_encode_as_the_library_does():
    from tokenizers import Tokenizer

    path = token_records.default_tokenizer()
    library, own = Tokenizer.from_file(path), token_records.WordEncoder(path)
    rng = random.Random(1)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices("abcÄéß ,.!'\n\t1日😀*AB", k=rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_memo_is_bounded_by_bytes():
    """Long words, and one text with very many words, keep to the memo's bytes; the ids stay the library's."""
    from tokenizers import Tokenizer

    path = token_records.default_tokenizer()
    library, own = Tokenizer.from_file(path), token_records.WordEncoder(path, memo_bytes=200_000)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdeé1", k=n)) for _ in range(words)) for n, words in ((2000, 200), (8, 6000), (5, 10))]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids
        assert sum(getsizeof(k) + getsizeof(v) for memo in (own.words, own.parts) for k, v in memo.items()) <= 200_000
    assert own.words and own.parts


def test_documents_are_written_by_one_worker(spark, docs):
    """One pass writes what encoding and writing one after the other do; each task of the query's writing has one Python worker."""
    df = docs([(k % 5, t, None, None, 1) for k, t in enumerate(TEXTS)])
    ordered, path = token_records.ordered_documents(df, 3), token_records.default_tokenizer()
    folders = [common.scratch(spark, "records") for _ in range(2)]
    indexes = [token_records.write_documents(ordered, path, 1, folders[0]), token_records.write_records(token_records.encode_documents(ordered, path, 1), folders[1])]
    place = ["shard_no", "ordinal"]
    one, two = [i.drop("shard").orderBy(place).collect() for i in indexes]
    assert one == two and len(one) == len(TEXTS)
    one, two = [token_records.read_records(spark, f, i).orderBy(place).collect() for f, i in zip(folders, indexes, strict=True)]
    assert one == two
    empty = token_records.write_documents(token_records.ordered_documents(docs([]), 2), path, 1, common.scratch(spark, "records"))
    assert empty.count() == 0


def test_frames():
    ids = np.array([1, 2, 70000], "<u4").tobytes()
    data = token_records.frame(5, ids, 4) + token_records.frame(None, b"", 2)
    key, got, at = token_records.unframe(data)
    assert (key, got.tolist()) == (5, [1, 2, 70000])
    key, got, at = token_records.unframe(data, at)
    assert key is None and not len(got) and at == len(data)
    for k in range(len(token_records.frame(5, ids, 4))):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(bytes(broken))


def test_records_round_trip(spark, docs):
    rows = [(9 - k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (4, "twice"), (4, "twice")]
    df = docs([(i, t, None, None, 1) for i, t in rows])
    path = common.scratch(spark, "records")
    tokens = token_records.encode_documents(token_records.ordered_documents(df, 3), token_records.default_tokenizer(), 1)
    index = token_records.write_records(tokens, path)
    layout = token_records.token_layout(token_records.read_records(spark, path, index)).orderBy("start").collect()
    own = token_records.WordEncoder(token_records.default_tokenizer())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(layout) == len(order)
    for r, (i, t) in zip(layout, order, strict=True):
        ids = np.append(np.frombuffer(own.encode(t or ""), "<u2"), 1).astype("<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    store, base = fs.FileSystem.from_uri(path)
    assert all(not f.base_name.startswith("_") for f in store.get_file_info(fs.FileSelector(base)))


def test_keys_stay_exact(spark, docs):
    keys = [None, -(1 << 63), -5, (1 << 53) + 1, (1 << 63) - 1]
    df = docs([(k, "some words", None, None, 1) for k in keys])
    path = common.scratch(spark, "records")
    tokens = token_records.encode_documents(token_records.ordered_documents(df, 1), token_records.default_tokenizer(), 1)
    index = token_records.write_records(tokens, path)
    assert [r["doc_id"] for r in index.orderBy("ordinal").collect()] == keys
    found = token_records.token_layout(token_records.read_records(spark, path, index)).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == keys


def test_one_key_goes_over_several_shards(spark, docs):
    """One doc_id and one text on nearly all rows: no shard has them all, and places still add up."""
    df = docs([(7, "the same words", None, None, 1)] * 900 + [(7, f"text {k}", None, None, 1) for k in range(30)] + [(3, "first", None, None, 1), (9, None, None, None, 1)]).repartition(6)
    ordered = token_records.ordered_documents(df, 6)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 500
    path = common.scratch(spark, "records")
    index = token_records.write_records(token_records.encode_documents(ordered, token_records.default_tokenizer(), 1), path)
    rows = token_records.token_layout(token_records.read_records(spark, path, index)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [3, *[7] * 930, 9]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    texts = df.agg(F.sum(F.octet_length("text"))).first()[0]
    assert [token_records.shards_for(df, n, 1) for n in (1 << 20, 1000)] == [1, -(-texts // 1000)]
    assert token_records.shards_for(df.where("false")) == 8


def test_no_records(spark, docs):
    path = common.scratch(spark, "records")
    index = token_records.write_records(token_records.encode_documents(token_records.ordered_documents(docs([]), 2), token_records.default_tokenizer(), 1), path)
    assert token_records.token_layout(token_records.read_records(spark, path, index)).count() == 0


# Pieces.


def best_score(model, scores, text):
    best = [0.0] + [None] * len(text)
    for i in range(len(text)):
        if best[i] is None:
            continue
        for j in range(i + 1, min(len(text), i + 48) + 1):
            s = scores.get(text[i:j])
            if s is not None and (best[j] is None or best[i] + s > best[j]):
                best[j] = best[i] + s
        if text[i] not in model.single and (best[i + 1] is None or best[i] + model.unknown > best[i + 1]):
            best[i + 1] = best[i] + model.unknown
    return best[-1]


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The file's pieces as a model of the unigram type: nothing is trained, scores are drawn by length."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(sentencepieces.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    rng = random.Random(7)
    for p in model.pieces:
        if p.type == 1:
            p.score = -6.0 - rng.random() * 6 - len(p.piece) * 0.25
    path = str(tmp_path_factory.mktemp("pieces") / "unigram.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    return path


def some_texts(n):
    rng = random.Random(3)
    return [t for t in TEXTS if t and "▁" not in t] + ["".join(rng.choices("the inga,.*!é日(1 Q'😀aaa\n\t", k=rng.randint(1, 40))) for _ in range(n)]


def test_unigram_pieces(unigram):
    """The best sum of scores, and the library's ids."""
    from sentencepiece import SentencePieceProcessor

    model, library = sentencepieces.PieceModel(unigram), SentencePieceProcessor(model_file=unigram)
    assert not model.merging
    by_piece = {p: v[2] for p, v in model.automaton.items()}
    by_id = {v[1]: v[2] for v in model.automaton.values()}
    same = 0
    for t in (texts := some_texts(400)):
        ids, theirs = model.encode(t).tolist(), library.encode(t)
        assert model.decode(ids) == t
        # Of equal sums the library's single precision may take another; bytes have no score.
        same += ids == theirs
        assert sum(by_id.get(i, 0) for i in ids) == pytest.approx(sum(by_id.get(i, 0) for i in theirs), rel=1e-5)
        if set(t) <= model.single | {" "}:
            assert sum(by_id[i] for i in ids) == pytest.approx(best_score(model, by_piece, "▁" + t.replace(" ", "▁")))
    assert same >= 0.98 * len(texts)


def test_merged_pieces():
    """BPE models: the library's ids, merge by merge."""
    from sentencepiece import SentencePieceProcessor

    path = sentencepieces.default_model()
    model, library = sentencepieces.PieceModel(path), SentencePieceProcessor(model_file=path)
    assert model.merging
    for t in some_texts(600):
        assert model.encode(t).tolist() == library.encode(t)
        assert model.decode(model.encode(t).tolist()) == t


def test_words_are_segmented_once():
    """A task's words fit the memo; what doesn't fit a small one is segmented anew, within its bytes."""
    from sentencepiece import SentencePieceProcessor

    path = sentencepieces.default_model()
    model, small, library = sentencepieces.PieceModel(path), sentencepieces.PieceModel(path, 10_000), SentencePieceProcessor(model_file=path)
    text = " ".join(f"the{k}" for k in range(210_000))
    first, asked, segment = model.encode(text).tolist(), [], model.segment
    model.segment = lambda t: asked.append(t) or segment(t)
    assert model.encode(text).tolist() == model.encode(text + " more").tolist()[:-1] == first
    assert len(asked) == 1
    for t in [text[:3000], "a" * 5000, *some_texts(100)]:
        assert small.encode(t).tolist() == library.encode(t)
        assert sum(getsizeof(k) + getsizeof(v) for k, v in small.memo.items()) <= 10_000


def test_op8_query(spark, sf):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=sentencepieces.default_model())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sentencepieces.op8_sentencepieces(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["round_trip"] and list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_pieces_round_trip(spark, docs):
    df = docs([(k, t, None, None, 1) for k, t in enumerate(TEXTS)])
    rows = sentencepieces.encode_texts(df, sentencepieces.default_model())
    got = {r["doc_id"]: r for r in sentencepieces.decode_ids(rows, sentencepieces.default_model()).collect()}
    for k, t in enumerate(TEXTS):
        assert got[k]["text"] == t and got[k]["round_trip"] in (True, None)
    assert got[2]["ids"] is None and got[1]["n_tokens"] == 0
    assert sentencepieces.encode_texts(docs([]), sentencepieces.default_model()).count() == 0


# Mixing.


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 190, 100], [1, 2, 3]) == pytest.approx([30, 108, 162])
    assert mixing.targets([0, 60], [1, 1]) == [0, 60]
    assert mixing.targets([], []) == []


def test_permutations():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, "k").tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, "a").tolist() != mixing.permuted(np.arange(1000), 1000, "b").tolist()


def test_shards_add_up():
    slots = [100, 0, 333, 7]
    depth = mixing.shard_depth(slots, 40)
    assert depth == 4 and mixing.shard_depth(slots, 1000) == 0 and mixing.shard_depth([], 10) == 0
    drawn = [mixing.shard_counts(slots, k, depth, 1) for k in range(1 << depth)]
    assert sum(c for c, _ in drawn).tolist() == slots
    before = [0] * 4
    for counts, start in drawn:
        assert start.tolist() == before and counts.min() >= 0
        before = [a + b for a, b in zip(before, counts.tolist(), strict=True)]
    huge = mixing.shard_counts([10**12, 5], 3, 20, 1)[0]
    assert 0.9e12 / 2**20 < huge[0] < 1.1e12 / 2**20


def brute_targets(sizes, weights, most=3):
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left, total = sum(sizes) - sum(out[k] for k in range(len(sizes)) if k not in free), sum(weights[k] for k in free)
        above = {k for k in free if left * weights[k] / total > most * sizes[k]}
        for k in above or free:
            out[k] = most * sizes[k] if above else left * weights[k] / total
        free -= above or free
    return out


def test_targets_against_rounds():
    rng = random.Random(2)
    for _ in range(300):
        sizes = [rng.choice([0, 1, rng.randint(0, 50), rng.randint(0, 5000)]) for _ in range(rng.randint(0, 12))]
        weights = [1 + k % 3 for k in range(len(sizes))]
        assert mixing.targets(sizes, weights) == pytest.approx(brute_targets(sizes, weights))


def test_mix(spark, docs):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{k}.{j}" for j in range(rng.randint(0, 400))), "en", ("b", "a", None)[k % 3 if k % 7 else 0], 3) for k in range(60)]
    rows += [(60, None, "en", "a", None), (61, " \n ", "en", "b", None), (None, "some words", "en", "a", None), (3, "again", "en", "b", None)]
    df = docs(rows).withColumn("row", F.lit(1))
    mixed = mixing.mix_documents(df, 16)
    assert mixed.columns == df.columns
    got = mixed.collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_documents(df, 16).collect()))
    sizes, taken = {}, {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    goal = dict(zip(["a", "b", None], mixing.targets([sizes["a"], sizes["b"], sizes[None]], [1, 2, 3]), strict=True))
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 16, (s, taken, goal)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).extend(r["text"].split())
    for i, t, *_ in rows[:60]:
        if i != 3:
            words = (t or "").split()
            assert set(by_doc.get(i, [])) <= set(words) and all(by_doc[i].count(w) <= 3 for w in by_doc.get(i, []))
    assert mixing.mix_documents(docs([])).count() == 0


def test_cut_words():
    t = "a  b\nc d e"
    assert mixing.cut_words(t, [(0, 2), (2, 1)]) == "a  b\nc"
    assert mixing.cut_words(t, [(0, 1), (3, 2)]) == "a d e"
