import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.llm import language_model as LM


def brute(docs, K=LM.BACKOFF):
    tok = lambda t: [*re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), "\n"]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    uni, bi = Counter(), Counter()
    for i, t in docs:
        if not held(i):
            w = tok(t)
            uni.update(w)
            bi.update(zip([" ", *w], w))
    N, V = sum(uni.values()), len(uni)
    out = []
    for i, t in docs:
        w, base, score = tok(t), 0, 0
        for u, x in zip([" ", *w], w):
            p = (uni[x] + 0.1) / (N + 0.1 * (V + 1))
            cu = uni["\n"] if u == " " else uni[u]
            base += math.log10(p)
            score += math.log10((bi[u, x] + K * p) / (cu + K))
        out.append((i, held(i), len(w), sum(uni[x] > 0 for x in w), N, base, score))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_brute_force(spark, seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(LM, "BLOCK_CHARS", 300)
    docs = [(k, "".join(r.choice(["a", "B", "é", "cc.", "\x1c"]) + r.choice([" ", "\n", "\x0b", " ", "  "]) for _ in range(r.randint(0, 40)))) for k in range(60)]
    docs += [(None, "b a"), (3, docs[3][1]), (99, None), (100, "")]
    df = spark.createDataFrame([(*d, 0, 1) for d in docs], "doc_id long, text string, kind int, block int").repartition(3)
    got = [tuple(x) for x in LM.score(df).collect()]
    key = lambda x: (str(x[0]), round(x[5], 6), round(x[6], 6))
    got, want = sorted(got, key=key), sorted(brute(docs), key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert [x[5:] for x in got] == [pytest.approx(x[5:], rel=1e-9) for x in want]


def test_no_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    (r,) = LM.score(df, held_out=F.col("doc_id") > 0).collect()
    assert tuple(r) == (1, True, 3, 0, 0, 0.0, 0.0)
    assert LM.score(df.limit(0)).count() == 0
