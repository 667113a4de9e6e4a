import hashlib
import random
import re

import pytest

from tillroll.llm import decontaminate as D

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, it in items:
            x = words(it)
            n = min(window, len(x))
            for s in range(len(x) - n + 1 if x else 0):
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == x[s:s + n]:
                        hit.update(range(k, k + n))
                        ids.add(str(item) if item is not None else "")
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [10**6, 60])
@pytest.mark.parametrize("seed", range(3))
def test_report_equals_brute_force(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(D, "automata", lambda items, window, _=None, f=D.automata: f(items, window, limit))
    r = random.Random(seed)
    text = lambda n: "".join(r.choice(["a", "B", "c", "é", "7"]) + r.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(k, text(r.randint(0, 14))) for k in range(8)] + [(3, text(5)), (None, text(6)), (12, None), (13, "  ,")]
    docs = [(k, text(r.randint(0, 60))) for k in range(40)] + [(1, "a b"), (None, text(30)), (77, None), (78, "")]
    d = spark.createDataFrame([(*x, "z", 1) for x in docs], "doc_id long, text string, spans string, n_words int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, D.report(d, i, 4).collect()), key=str)
    assert got == brute(docs, items, 4)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.report(d, none).collect()] == [(1, 3, 0, 0)]
    assert D.report(d.limit(0), none).count() == 0


def test_clean_cuts_spans_and_drops_covered(spark):
    item = " ".join(f"w{k}" for k in range(12))
    docs = [(1, "Long text before that is clean, so it stays here. " * 3 + item.upper() + "! After.", 5), (2, item, 6), (3, "clean", 7), (4, None, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    got = {r[0]: (r[1], r[2]) for r in D.clean(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    text = docs[0][1].replace(item.upper(), "")
    assert got == {1: (text, len(text)), 3: ("clean", 7), 4: (None, None)}


def test_one_part_of_the_items_at_a_time(spark, monkeypatch):
    import weakref
    alive, most, built = weakref.WeakSet(), [], D.Automaton.__init__

    def build(self, *args):
        most.append(len(alive))
        alive.add(self)
        built(self, *args)

    monkeypatch.setattr(D.Automaton, "__init__", build)
    items = [(k, f"a{k} b{k} c{k} d{k}") for k in range(12)]
    docs = [(k, f"x a{k} b{k} c{k} d{k} y") for k in range(12)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = D.find(d, i, 4, limit=40).collect()
    assert len(most) > 3 and max(most) == 0  # none is left in the driver when the next is built
    assert all([tuple(s) for s in r.spans] == [(1, 5)] and r.item_ids == [str(r.doc_id)] for r in found)


def test_clean_keeps_columns_of_clashing_names(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, "spans 1", -5, f"before {item} after " + "word " * 60, 0, "x"), (2, "spans 2", -6, "clean text", 3, None), (3, None, None, None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, spans string, n_words int, text string, n_chars long, item_ids string")
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    got = {r.doc_id: r for r in D.clean(docs, items).collect()}
    assert D.clean(docs, items).columns == docs.columns and tuple(got[2]) == rows[1] and tuple(got[3]) == rows[2]
    assert got[1].spans == "spans 1" and got[1].n_words == -5 and got[1].item_ids == "x"
    assert "seven" not in got[1].text and got[1].n_chars == len(got[1].text)
