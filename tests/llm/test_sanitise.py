import hashlib
import random
import re
import time

import pytest

from tillroll.llm import sanitise as S

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(d[::-1][0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[::-1][1::2]) and \
                (sum(d[::-1][0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[::-1][1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_plain_patterns(seed):
    r = random.Random(seed)
    parts = ["a", "B.c", "@", "x@y", ".", "..", "1", "25", "256", "0", "4111111111111111", "4111 1111-1111 1111", "+1", "+", "(269)", " ", "-", "555", "%", "é", "é@b.c"]
    for _ in range(6000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 16)))
        assert S.base_spans(t) == brute(t), t


def test_long_runs_are_read_once():
    t = time.time()
    for x in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "@a." * 100_000, "1 " * 150_000):
        S.base_spans(x)
    assert time.time() - t < 20


def test_report(spark):
    leak = "the reviewer Zyxwvut writes from bob@mail.example.com today"
    docs = [(k, f"common words here number{k} again today the reviewer writes") for k in range(60)]
    docs += [(100, leak), (101, leak + " and more"), (102, "alone ann@mail.example.com Qwertyx"), (None, "+1 (269) 555-3296"), (103, None), (104, ""), (104, "")]
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, spans string")
    got = sorted(S.report(df).collect(), key=lambda r: str(r.doc_id))
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    i = leak.index("Zyxwvut")
    assert f"removed:{i}:{i + 7}" in by[100].spans and "removed" in by[101].spans
    assert by[102].spans == "email:6:26" and by[102].n_email == 1  # one document is no evidence
    assert by[None].spans == "phone:0:17" and by[None].n_phone == 1
    assert all(by[k].spans == "" for k in (*range(60), 103, 104))
    assert by[103].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert "Zyxwvut" not in S.sanitise(leak, by[100].spans) and "[EMAIL]" in S.sanitise(leak, by[100].spans)
    assert S.report(df.limit(0)).count() == 0


def test_document_frequencies_count_the_terms_that_pairs_count(spark):
    near = "write to bob@mail.example.com about gamma now"
    forms = ["a-gamma", "gamma/b", "a_gamma", "|gamma|", "[gamma]", "«gamma»", "gamma1", "gamma\u00a0x"]
    docs = [(k, f"other {forms[k % 8]} text") for k in range(80)] + [(100, near), (101, near)]
    got = {r.doc_id: r.spans for r in S.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    i = near.index("gamma")
    assert f":{i}:{i + 5}" not in got[100] and f":{i}:{i + 5}" not in got[101]  # common, in any surroundings


def test_terms_anywhere_in_the_document(spark):
    fill = " ".join(f"w{k % 40}" for k in range(300))
    leak = f"Lee 王小明 {fill} bob@mail.example.com {fill} account AB77312"
    docs = [(k, f"{fill} bob x{k}") for k in range(60)] + [(100, leak), (101, leak)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.report(df).collect()}
    clean = S.sanitise(leak, got[100])
    assert not any(w in clean for w in ("Lee", "王小明", "AB77312", "bob@")) and clean.count("w7 ") == leak.count("w7 ")
    assert all(got[k] == "" for k in range(60))


@pytest.mark.parametrize("common", [0.001, 0.3, 1.0])
def test_disclosures_equal_brute_force(spark, common, monkeypatch):
    from collections import Counter
    from math import log
    monkeypatch.setattr(S, "COMMON", common)
    monkeypatch.setattr(S, "PAIRS", 50)
    r = random.Random(7)
    docs = [" ".join([*(f"t{int(r.random() ** 3 * 60)}" for _ in range(12)), *(f"u{r.randrange(9)}@m.org" for _ in range(r.choice([0, 0, 1, 3])))]) for _ in range(200)]
    ne, nt, n = Counter(), Counter(), Counter()
    for d in docs:
        es, ts = {w for w in d.split() if "@" in w}, {w for w in d.split() if "@" not in w}
        ne.update(es), nt.update(ts), n.update((e, t) for e in es for t in ts)
    share = {k: log(200 * v / (ne[k[0]] * nt[k[1]])) / log(200 / ne[k[0]]) for k, v in n.items() if v >= 2}
    want = {(S._entity("email", e), S._hash(t)): x >= 0.5 for (e, t), x in share.items() if x >= 0.3}
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    seen = S.materialise(S.id_and_text(df).mapInArrow(S._scan, S.SEEN_SQL), "test-seen")
    assert len(want) > 5 and {(x.e, x.t): x.removed for x in S.disclosures(seen, 0.3, 0.5).collect()} == want
