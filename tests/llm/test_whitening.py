import math
from fractions import Fraction

import numpy as np
import pytest

from tillroll.llm import whitening as W


@pytest.mark.parametrize("rows,dims,span", [(1, 1, 1), (63, 3, 9), (64, 5, 200), (1000, 7, 1), (130, 4, 1 << 52), (5000, 2, 1 << 20)])
def test_cross_products_are_exact(rows, dims, span):
    r = np.random.default_rng(rows)
    x = r.integers(-span, span + 1, (rows, dims))
    sums, products = W.cross_products(x)
    big = [[int(v) for v in row] for row in x]
    assert sums == [sum(row[i] for row in big) for i in range(dims)]
    assert [[int(v) for v in row] for row in products] == [[sum(row[i] * row[j] for row in big) for j in range(dims)] for i in range(dims)]


def usable(v):
    return v is not None and len(v) > 0 and None not in v and all(math.isfinite(c) for c in v)


def brute(rows, dims, components=16):
    """Everything from the definition, with fractions up to the eigenvectors."""
    ok = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if usable(v) and len(v) == dims]
    fit = sorted({x for _, x in ok})
    n = len(fit)
    s = [sum(x[d] for x in fit) for d in range(dims)]
    off = [[Fraction(x[d]) - Fraction(s[d], n) for d in range(dims)] for x in fit]
    cov = np.array([[float(sum(o[i] * o[j] for o in off) / n) for j in range(dims)] for i in range(dims)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > e[0] * 1e-12).sum()))
    out = []
    for i, x in ok:
        centre = np.array([float(Fraction(c) - Fraction(t, n)) for c, t in zip(x, s)])
        dev = sum((n * c - t) ** 2 for c, t in zip(x, s))
        out += [(i, c + 1, n, dev, float(centre @ v[:, c] / math.sqrt(e[c])), float(e[c] / np.trace(cov))) for c in range(k)]
    return out, v[:, :k]


@pytest.mark.parametrize("dims,count", [(5, 300), (20, 400), (3, 2)])
def test_whitening_equals_the_definition(spark, dims, count):
    r = np.random.default_rng(dims)
    mix = r.normal(size=(dims, dims)) * 0.3
    rows = [(k % 250, [float(np.float32(c)) for c in r.normal(size=dims) @ mix]) for k in range(count)]
    rows += [(900, rows[0][1]), (900, rows[0][1]), (None, rows[1][1])]
    bad = [(901, None), (902, []), (903, [None] * dims), (904, [float("nan")] * dims), (905, [float("inf")] * dims), (906, [1.0])]
    df = spark.createDataFrame([(i, v, "c", 1.0) for i, v in rows + bad], "vec_id long, embedding array<float>, component string, x double")
    got = W.report(df).collect()
    want, vectors = brute(rows, dims)
    key = lambda t: (t[0] is not None, t[0] or 0, t[3], t[1], abs(t[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(g)[:4] for g in got] == [w[:4] for w in want]
    sign = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-6:
            sign.setdefault(w[1], round(g[4] / w[4]))
        assert abs(g[4] - sign.get(w[1], 1) * w[4]) < 1e-7 * max(1, abs(w[4]))
        assert abs(g[5] - w[5]) <= 1e-9 * w[5] + 1e-15
    assert set(sign.values()) <= {1, -1} and len({g.identity_error for g in got}) == 1 and got[0].identity_error < 1e-9


def test_no_variance_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.report(spark.createDataFrame([], schema)).count() == 0
    assert W.report(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).count() == 0
    flat = W.report(spark.createDataFrame([(k, [0.5, k / 64, -k / 64]) for k in range(9)], schema))
    assert sorted({r.component for r in flat.collect()}) == [1]


def test_huge_entries_do_not_overflow(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    # The other component's variance is below rounding.
    assert len(got) == 3 and all(math.isfinite(r.whitened) for r in got) and got[0].n == 3
    top = 1 << 53
    x = {1: (top, 0), 2: (-top, 64), 3: (0, 128)}
    s = [sum(v[d] for v in x.values()) for d in (0, 1)]
    assert {r.vec_id: int(r.deviation) for r in got} == {i: sum((3 * c - t) ** 2 for c, t in zip(v, s)) for i, v in x.items()}
    assert all(r.deviation is None for r in W.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("vec_id < 3").collect())
