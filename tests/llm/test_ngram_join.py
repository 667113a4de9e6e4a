import random
import re

import numpy as np
import pytest

from tillroll.llm import ngram_join as J

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(t):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    n = min(5, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    group, links = list(range(len(docs))), [0] * len(docs)
    find = lambda x: x if group[x] == x else find(group[x])
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k))) for k, (i, _) in enumerate(docs)), key=str)


def test_prefix_depth_keeps_the_target_recall():
    d = J.prefix_depth()
    assert 1 - (1 - 0.8 ** d) ** J.TREES >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** J.TREES


@pytest.mark.parametrize("block", [256, 7])
def test_join_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", block)
    r = random.Random(block)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop") + r.choice("xyzé") + r.choice("0123456789")
    docs = []
    for k in range(30):
        base = [word() for _ in range(r.choice([3, 8, 40, 120]))]
        for _ in range(r.choice([1, 2, 9])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = word()
            docs.append((1000 - len(docs), r.choice([" ", ", "]).join(w)))
    docs += [(5, docs[0][1].upper()), (5, docs[0][1]), (None, docs[9][1]), (None, "only one"), (6, None), (7, ""), (8, "..."), (9, "only one")]
    df = spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, text string, fp string, component int")
    got = sorted((tuple(x) for x in J.join(df).collect()), key=str)
    assert got == brute(docs)
    kept = J.deduplicate(df).collect()
    assert {x.doc_id for x in kept} == {c for i, _, c in got if c == i}
    assert len(kept[0]) == 4


def test_chains_hold_every_shared_prefix(spark):
    """Neighbours' links of a length connect just the labels of one tree that share such a prefix, across tasks too."""
    r = np.random.default_rng(4)
    labels = r.integers(0, 3, (300, 2, J.DEPTH)).astype(">u2")
    reps = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(labels)], "rid long, labels binary")
    links = [tuple(x) for x in J.forest_links(reps, 2).collect()]
    for depth in (1, 2, 4, J.DEPTH):
        group = list(range(300))
        find = lambda x: x if group[x] == x else find(group[x])
        for a, b, d in links:
            if d >= depth:
                group[find(a)] = find(b)
        want = list(range(300))
        root = lambda x: x if want[x] == x else root(want[x])
        for t in range(2):
            first = {}
            for k in range(300):
                want[root(k)] = root(first.setdefault(labels[k, t, :depth].tobytes(), k))
        assert len({(find(k), root(k)) for k in range(300)}) == len({find(k) for k in range(300)}) == len({root(k) for k in range(300)})


def test_depth_adapts_to_the_measured_pairs():
    assert J.adapted_depth({8: 90, 6: 9, 4: 1}, 6) == 4 and J.adapted_depth({8: 90, 6: 9, 4: 1}, 6, 0.99) == 6
    assert J.adapted_depth({}, 6) == 6 and J.adapted_depth({0: 1}, 6) == 1


def test_recall_from_the_threshold_on(spark):
    """All pairs at 0.80 to 0.85 of a corpus of such pairs are found, by an exact count."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    docs = []
    for _ in range(250):
        base = [word() for _ in range(130)]
        near = list(base)
        for k in r.sample(range(10, 120), 2):  # each changed word costs five shingles of some 126
            near[k] = word()
        docs += [" ".join(base), " ".join(near)]
    docs = list(enumerate(docs))
    want = brute(docs)
    close = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(docs[::2], docs[1::2])]
    assert sum(0.8 <= x <= 0.87 for x in close) > 200
    got = sorted((tuple(x) for x in J.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=str)
    assert got == want
    reps = J.classes(spark.createDataFrame(docs, "doc_id long, text string")).count()
    assert reps == 500


def test_deduplicate_by_row(spark):
    r = random.Random(3)
    x, y = (" ".join(r.choice("abcdefghijklmnopqrstuvw") + str(r.randint(0, 99)) for _ in range(80)) for _ in range(2))
    near = x.rsplit(" ", 1)[0] + " other"
    rows = [(2, x), (5, y), (5, near), (None, near + "."), (7, "..."), (7, "..."), (8, None), (None, "")]
    df = spark.createDataFrame([(*d, 1) for d in rows], "doc_id long, text string, component int")
    assert sorted(((k.doc_id, k.text) for k in J.deduplicate(df).collect()), key=str) == sorted([(2, x), (5, y), (7, "..."), (8, None), (None, "")], key=str)


def test_empty(spark):
    assert J.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(x) for x in J.join(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()] == [(1, 0, 1)]
