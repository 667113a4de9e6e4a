from collections import defaultdict

import corpus_pipeline as C
from tests.llm.test_decontaminate import words
from tests.llm.test_ngram_join import shingles


def test_stages_take_effect(spark):
    sf, names = "/root/testdata/sf0.001", ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        out = C.materialise(stage(spark, seen[-1], sf), f"test-{k}")
        assert k + 1 == len(C.STAGES) or out.columns == names
        seen.append(out)
    rows = [{r.doc_id: r.text for r in s.collect()} for s in seen[:-1]]
    assert set(rows[0]) > set(rows[1]) >= set(rows[2]) >= set(rows[3]) and set(rows[3]) == set(rows[4])
    # Near-duplicates: brute force over what the classifier kept.
    sets = {i: shingles(t) for i, t in rows[1].items()}
    kept, order = set(rows[2]), sorted(sets)
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0
    for n, a in enumerate(order):
        if a in kept:
            assert not any(near(a, b) for b in order[:n] if b in kept)
    assert all(any(near(a, b) for b in order if b != a) for a in set(order) - kept)
    # No window of ten item words is left in a document that had one.
    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {tuple(x[k:k + 10]) for x in items for k in range(len(x) - 9)}
    had = lambda t: any(tuple(w[k:k + 10]) in windows for w in [words(t)] for k in range(len(w) - 9))
    assert all(t == rows[2][i] for i, t in rows[3].items() if not had(rows[2][i])) and not any(had(t) for t in rows[3].values())
    assert set(rows[2]) - set(rows[3]) <= {i for i, t in rows[2].items() if had(t)}
    pieces = defaultdict(int)
    for r in seen[-1].collect():
        pieces[r.doc_id] += r.length
        assert r.offset + r.length <= 1024
    assert set(pieces) == set(rows[4])
