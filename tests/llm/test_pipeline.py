import corpus_pipeline
from kmerloom.llm import common, pii, quality, sentencepieces, simhash


def test_pipeline_against_single_steps(spark, sf):
    """Each stage's decisions against the plain functions behind it, document by document."""
    docs = common.read_table(spark, sf, "documents")
    names = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit_quality(docs, common.read_table(spark, sf, "labels"))
    want = set()
    for i, t in texts.items():
        data = t.encode()
        n = quality.base_counts(t, data.split(), len(data))
        if not quality.base_failed(n[0], n[4]) and model.probability(t, data.split()) >= quality.THRESHOLD:
            want.add(i)
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert len(stages) == 5
    docs = common.written(stages[0](spark, docs, sf), "t")
    assert {r["doc_id"] for r in docs.collect()} == want and docs.columns == names
    prints = {i: simhash.fingerprint(texts[i]) for i in sorted(want)}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in prints:
        for j in prints:
            if j < i and bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    docs = common.written(stages[1](spark, docs, sf), "t")
    assert {r["doc_id"] for r in docs.collect()} == {find(i) for i in prints} and docs.columns == names
    docs = common.written(stages[2](spark, docs, sf), "t")
    safe = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, t in safe.items():
        mentions = pii.find_entities(texts[i])
        assert (t == texts[i]) == (not mentions)
        assert all(texts[i][s:e] not in t for s, e, *_ in mentions)
    docs = common.written(stages[3](spark, docs, sf), "t")
    assert docs.columns == names and all(set(r["text"].split()) <= set(safe[r["doc_id"]].split()) for r in docs.collect())
    mixed = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    model = sentencepieces.PieceModel(sentencepieces.default_model())
    last = stages[4](spark, docs, sf).collect()
    assert sorted((r["doc_id"], model.decode(r["ids"])) for r in last) == mixed and all(r["round_trip"] for r in last)
