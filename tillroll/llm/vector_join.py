"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in two halves with a codebook each (k-means on a bounded
sample); the pairs of nearest codewords are the cells of a product grid. A
vector visits cells in the order of a multi-sequence: by the sum of two
per-half costs, ascending. The cost of a codeword is the squared distance from
the half to the border of the codeword's own region, so a cell whose costs add
up to more than the squared radius of the threshold can hold no partner. The
traversal that stops there has recall 1; a lower target shrinks the radius to
that quantile of the borders between linked pairs of the sample.

Cells are verified in double precision, in blocks of bounded size that return
link counts and a spanning forest, not pairs. Equal vectors of a label are one
representative.

Cases: null, zero and non-finite vectors, and null labels, link with nothing;
vectors of another length than the label's others are compared only with their
like; repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import connected_components, forest, materialise, sql_partitions

THRESHOLD, SAMPLE, ROUNDS = 0.98, 8192, 12
#: Representatives wanted in a cell; the codebooks' size follows from the count of representatives.
CELL, MAX_CODEWORDS = 64, 1024
BLOCK = 512


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centres = x[np.random.default_rng(3).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def border_costs(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, squared distance to the border of each codeword's half-space beyond it)."""
    d = (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)
    own = d.argmin(1)
    apart = np.sqrt(((centres[own][:, None] - centres[None]) ** 2).sum(-1)) if len(x) * centres.size <= 1 << 22 else np.stack(
        [np.sqrt(((centres[own] - c) ** 2).sum(1)) for c in centres], 1)
    gap = np.maximum(d - d[np.arange(len(x)), own][:, None], 0)
    cost = np.where(apart > 0, gap / np.maximum(2 * apart, 1e-12), 0.0) ** 2
    return own, cost


class Index:
    def __init__(self, sample: np.ndarray, count: int, threshold: float, target: float):
        self.width = sample.shape[1]
        half = self.width // 2
        k = int(np.clip(round((count / CELL) ** 0.5), 1, MAX_CODEWORDS))
        self.books = [kmeans(sample[:, :half], k), kmeans(sample[:, half:], k)]
        self.radius = 2 - 2 * threshold + 1e-9
        if target < 1 and len(sample) > 1:
            a, b = np.nonzero(np.triu(sample @ sample.T >= threshold, 1))
            if len(a):
                (_, ca), (_, cb) = border_costs(sample[a, :half], self.books[0]), border_costs(sample[a, half:], self.books[1])
                oa, ob = border_costs(sample[b, :half], self.books[0])[0], border_costs(sample[b, half:], self.books[1])[0]
                need = ca[np.arange(len(a)), oa] + cb[np.arange(len(b)), ob]
                self.radius = min(self.radius, float(np.quantile(need, target)) + 1e-12)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own cell of each vector, vector of each visit, cell of each visit): cells from the own one up,
        in ascending cost; a pair is met from the vector of the smaller cell."""
        half = self.width // 2
        (i, ci), (j, cj) = border_costs(x[:, :half], self.books[0]), border_costs(x[:, half:], self.books[1])
        n = len(self.books[1])
        own = i * n + j
        first, second = np.argsort(ci, 1), np.argsort(cj, 1)
        who, cell = [], []
        for v in range(len(x)):
            a, b = ci[v, first[v]], cj[v, second[v]]
            a, b = a[a <= self.radius], b[b <= self.radius]
            # Sorted costs: each first codeword goes with a prefix of the second ones.
            upto = np.searchsorted(b, self.radius - a, side="right")
            rows = np.repeat(first[v, :len(a)], upto)
            cols = second[v, np.concatenate([np.arange(u) for u in upto])] if upto.sum() else np.zeros(0, np.int64)
            c = rows * n + cols
            c = c[c >= own[v]]
            who.append(np.full(len(c), v))
            cell.append(c)
        return own, np.concatenate(who) if who else np.zeros(0, np.int64), np.concatenate(cell) if cell else np.zeros(0, np.int64)


def _unit(raw) -> np.ndarray:
    x = np.array([np.frombuffer(r, "<f8") if isinstance(r, bytes) else r for r in raw], np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # else squares of tiny or huge parts leave the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _deal(indexes):
    def step(frames):
        for pdf in frames:
            for width, part in pdf.groupby("width"):
                index, x = indexes.value[int(width)], _unit(part["vector"])
                own, who, cell = index.visits(x)
                at = np.concatenate([np.arange(len(x)), who])
                yield pd.DataFrame({"label": part["label"].to_numpy()[at], "width": int(width), "cell": np.concatenate([own, cell]),
                                    "member": np.concatenate([np.ones(len(x), bool), np.zeros(len(who), bool)]), "inside": np.concatenate([own, own[who]]),
                                    "rid": part["rid"].to_numpy()[at], "copies": part["copies"].to_numpy()[at], "vector": part["vector"].to_numpy()[at]})
    return step


def _verify(threshold: float):
    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        m, v = pdf[pdf["member"]], pdf[~pdf["member"]]
        out = {"a": [], "b": [], "links": []}
        if len(m) and len(v):
            near = _unit(v["vector"]) @ _unit(m["vector"]).T >= threshold
            rv, rm = v["rid"].to_numpy(), m["rid"].to_numpy()
            inside = (v["inside"] == v["cell"]).to_numpy()
            near &= ~inside[:, None] | (rv[:, None] < rm[None])  # a cell's own pairs once
            x, y = np.nonzero(near)
            nodes, where = np.unique(np.concatenate([rv, rm]), return_inverse=True)
            links = np.zeros(len(nodes), np.int64)
            left, right = where[x], where[len(rv) + y]
            np.add.at(links, left, m["copies"].to_numpy()[y])
            np.add.at(links, right, v["copies"].to_numpy()[x])
            keep = forest(len(nodes), left, right)
            some = np.flatnonzero(links)
            out = {"a": [*nodes[some], *nodes[left[keep]]], "b": [*[None] * len(some), *nodes[right[keep]]],
                   "links": [*links[some], *[0] * len(keep)]}
        return pd.DataFrame({"a": pd.array(out["a"], "int64"), "b": pd.array(out["b"], "Int64"), "links": pd.array(out["links"], "int64")})
    return step


def join(vectors: DataFrame, threshold: float = THRESHOLD, target_recall: float = 1.0) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("fp", F.when(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)),
                                        F.sha2(F.concat_ws("|", F.length("label"), F.col("label"), F.transform("vector", lambda x: (x + 0.0).cast("string"))).cast("binary"), 256)))
    ids = materialise(rows.select("vec_id", "fp", "label", "vector"), "vectors")
    reps = materialise(ids.filter("fp is not null").groupBy("fp").agg(
        F.min("vec_id").alias("min_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
        .withColumn("rid", F.monotonically_increasing_id()).withColumn("width", F.size("vector")), "vector-reps")
    counts = {r[0]: r[1] for r in reps.groupBy("width", "label").count().groupBy("width").agg(F.max("count")).collect()}  # a row for each vector length
    indexes = {}
    for width, count in counts.items():
        taken = reps.filter(F.col("width") == width).orderBy(F.xxhash64("fp")).limit(SAMPLE).select("vector").collect()
        indexes[width] = Index(_unit([r[0] for r in taken]), count, threshold, target_recall)
    held = spark.sparkContext.broadcast(indexes)
    dealt = reps.select("label", "width", "rid", "copies", "vector").mapInPandas(
        _deal(held), "label string, width int, cell bigint, member boolean, inside bigint, rid bigint, copies bigint, vector array<double>")
    dealt = materialise(dealt.withColumn("vector", F.col("vector")), "vector-visits")
    # Members and visitors of a cell meet in blocks of bounded size.
    key = ["label", "width", "cell"]
    sizes = dealt.groupBy(*key).agg(*[F.greatest(F.lit(1), F.ceil(F.count_if(c) / BLOCK)).alias(n) for n, c in (("ms", F.col("member")), ("vs", ~F.col("member")))])
    ranges = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    spread = dealt.join(sizes, key)
    mine = lambda n: F.pmod(F.xxhash64("rid"), F.col(n))
    spread = spread.filter("member").withColumn("mi", mine("ms")).withColumn("vi", ranges("vs")).unionByName(
        spread.filter("not member").withColumn("vi", mine("vs")).withColumn("mi", ranges("ms")))
    # Dealt by all five, else a hot cell's blocks would stay together as the join by cell left them.
    spread = spread.drop("ms", "vs").repartition(sql_partitions(spark), *key, "mi", "vi")
    found = materialise(spread.groupBy(*key, "mi", "vi").applyInPandas(_verify(threshold), "a bigint, b bigint, links bigint"), "vector-links")
    links = found.filter("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    linked = connected_components(found.filter("b is not null")).withColumnRenamed("node", "rid")
    named = reps.select("rid", "fp", "min_id", "copies").join(linked, "rid", "left").join(links, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    least = named.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = ids.select("vec_id", "fp").join(named, "fp", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("fp").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
