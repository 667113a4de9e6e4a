import numpy as np
import pytest

from tillroll.llm import vector_join as V


def brute(rows, threshold=0.98):
    ok = [k for k, (_, x, lab) in enumerate(rows) if lab is not None and x is not None and None not in x and np.isfinite(x).all() and np.any(x)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in ok}
    links, group = [0] * len(rows), list(range(len(rows)))
    find = lambda x: x if group[x] == x else find(group[x])
    for n, a in enumerate(ok):
        for b in ok[:n]:
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                group[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(r[0], least.get(find(k), r[0]))
    return sorted((r[0], links[k], least[find(k)], least[find(k)] == r[0]) for k, r in enumerate(rows))


@pytest.mark.parametrize("block,cell", [(512, 64), (7, 3)])
def test_join_equals_brute_force(spark, block, cell, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "CELL", cell)
    r = np.random.default_rng(block)
    rows = []
    for _ in range(60):
        base = r.normal(size=12)
        for _ in range(r.integers(1, 9)):
            x = base + r.normal(size=12) * r.choice([0, 0.05, 0.13, 0.2])
            rows.append((len(rows) * 7 % 1009, [float(v) for v in x * r.choice([1, 3])], int(r.integers(0, 3))))
    rows += [(2000, None, 1), (2001, [0.0] * 12, 1), (2002, [float("nan")] + [1.0] * 11, 1), (2003, [None] + [1.0] * 11, 1),
             (2004, rows[0][1], None), (2005, rows[0][1], rows[0][2]), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1), (2008, [], 1), (2009, [3.0], 0)]
    df = spark.createDataFrame([(*x, "z") for x in rows], "vec_id long, embedding array<double>, label int, cell string")
    got = sorted(map(tuple, V.join(df).collect()))
    assert got == brute(rows)
    few = V.join(df, target_recall=0.9).collect()
    assert sum(x.n_links for x in few) >= 0.9 * sum(x[1] for x in got)
    assert V.join(df.limit(0)).count() == 0


def test_labels_are_not_mixed_with_components(spark):
    rows = [(1, [2.0], "a|1.0"), (2, [1.0, 2.0], "a"), (3, [2.0], "1|a"), (4, [1.0, 2.0], "a")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.join(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (0, 3), 4: (1, 2)}
