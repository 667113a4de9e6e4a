"""Embedding whitening with exact integer cross-products from bit planes.

Entries become integers x = floor(64 c) + 1,000,000. Each task shifts a block of
distinct x-vectors by the block's least value of every dimension, packs each bit
of the shifted values across the rows into 64-bit words, and gets the sum of
products of two dimensions as the weighted popcounts of ANDed planes. The blocks'
integers are added by Spark, one row for each pair of dimensions, and are centred
as integers, n * sum(xi xj) - Si Sj, before the one division that makes the
covariance; ``eigh`` of it gives the components.

Cases: a vector that is null, empty, or holds null or non-finite entries is
dropped; so is one of another length than most vectors (of lengths equally
frequent, the longest) as no covariance joins the two; entries of 2^53 or more in
size after the factor 64 count as that bound. Repeated rows and null ids give
their rows again. Components whose variance is zero up to rounding can't be
whitened and give no rows, so one distinct vector alone gives none; an empty table
gives none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialise, table_batch

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Rows of a block of bit planes; a plane's words are a 64th of it.
BLOCK_ROWS = 4096
LARGEST = 1 << 53
#: Sums of products travel as high * 2^LIMB + low, so that any number of them fits Spark's numbers.
LIMB = 40


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that count."""
    v = F.col(vector_col).cast("array<double>")

    def fits(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    def whole(c: Column) -> Column:
        y = F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))
        return y.cast("long") + F.lit(SHIFT)

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter((F.size("v") > 0) & F.forall("v", fits))
    return rows.select("vec_id", F.transform("v", whole).alias("x"))


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The x-vectors of a batch, one a row."""
    return _flat(batch.column("x")).reshape(-1, dims)


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


# --------------------------------------------------------- bit-sliced scatter
def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, weight exponent) of each bit plane of non-negative integers; bit r % 64 of word r // 64 is row r."""
    words, dim, bit = [], [], []
    pad = -len(y) % 64
    for d in range(y.shape[1]):
        for b in range(int(y[:, d].max()).bit_length()):
            bits = np.concatenate([(y[:, d] >> b & 1).astype(np.uint8), np.zeros(pad, np.uint8)])
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            dim.append(d)
            bit.append(b)
    return np.array(words, "<u8").reshape(len(words), -(-len(y) // 64)), np.array(dim, np.int64), np.array(bit, np.int64)


def cross_products(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(sums of the dimensions, matrix of their sums of products) of integer rows, exact, as Python integers."""
    low = x.min(0)
    words, dim, bit = planes(x - low)
    d = x.shape[1]
    total = np.zeros(d, object)
    ones = np.bitwise_count(words).sum(1, dtype=np.int64)
    for p in range(len(words)):
        total[dim[p]] += int(ones[p]) << int(bit[p])
    # Of a block, a product sum of two dimensions fits 64 bits if their widths leave room for the row count.
    width = int(bit.max(initial=0)) + 1
    wide = 2 * width + len(x).bit_length() > 62
    out = np.zeros((d, d), object if wide else np.int64)
    for p in range(len(words)):
        both = np.bitwise_count(words[p] & words[p:]).sum(1, dtype=np.int64)
        shift = bit[p] + bit[p:]
        if wide:
            for q, n, s in zip(dim[p:].tolist(), both.tolist(), shift.tolist()):
                out[dim[p], q] += n << s
        else:
            np.add.at(out[dim[p]], dim[p:], both << shift)
        if p + 1 < len(words):  # pairs of two planes of one dimension count twice
            same = dim[p + 1:] == dim[p]
            for n, s in zip(both[1:][same].tolist(), shift[1:][same].tolist()):
                out[dim[p], dim[p]] += n << s
    out = np.triu(out.astype(object))
    out = out + np.triu(out, 1).T
    # Undo the shift: x = y + low.
    low = np.array(low.tolist(), object)
    out = out + np.outer(low, total) + np.outer(total, low) + len(x) * np.outer(low, low)
    return [int(t + len(x) * m) for t, m in zip(total, low)], out


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, sums of products) of the x-vectors of ``fit``. Tasks send one row for each pair of
    dimensions, whatever they hold; the driver gets as many rows as there are pairs."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.int64())])

    def step(batches: Iterator[pa.RecordBatch]):
        n, s, xx = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            x = matrix(b, dims)
            for at in range(0, len(x), BLOCK_ROWS):
                one, two = cross_products(x[at:at + BLOCK_ROWS])
                n, s, xx = n + len(x[at:at + BLOCK_ROWS]), s + np.array(one, object), xx + two
        if n:
            from decimal import Decimal
            cells = [(-1, -1, n), *((-1, j, int(v)) for j, v in enumerate(s)),
                     *((i, j, int(xx[i, j])) for i in range(dims) for j in range(i, dims))]
            i, j, v = zip(*cells)
            yield table_batch({"i": list(i), "j": list(j), "high": [Decimal(k >> LIMB) for k in v],
                               "low": [k & (1 << LIMB) - 1 for k in v]}, schema)

    cells = fit.select("x").mapInArrow(step, "i int, j int, high decimal(38,0), low bigint").groupBy("i", "j").agg(
        F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    n, s, xx = 0, [0] * dims, np.zeros((dims, dims), object)
    for i, j, high, low in cells:
        value = (int(high) << LIMB) + int(low)
        if j < 0:
            n = value
        elif i < 0:
            s[j] = value
        else:
            xx[i, j] = xx[j, i] = value
    return n, s, xx


class Whitener:
    """Centre, components and their scales from exact sums."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        s = np.array(sums, object)
        centred = n * products - np.outer(s, s)  # integers: n^2 times the covariance
        cov = np.array([[c / (n * n) for c in row] for row in centred.tolist()])
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        trace = int(np.trace(centred)) / (n * n)
        real = values > max(values[0], 0.0) * len(values) * np.finfo(float).eps * 16
        self.k = min(components, int(real.sum()))
        self.explained = [float(v / trace) for v in values[:self.k]]
        self.vectors = vectors[:, :self.k] / np.sqrt(values[:self.k])
        self.base = np.array([v // n for v in sums], np.int64)
        self.rest = np.array([v % n / n for v in sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """The whitened values of integer rows: the whole part of the mean goes first, so nothing is rounded away."""
        return ((x - self.base).astype(float) - self.rest) @ self.vectors

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n x - S)^2 of each row, exact."""
        off = x - self.base
        left = np.array([v % self.n for v in self.sums], object)
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return ((off * self.n - left.astype(np.int64)) ** 2).sum(1).tolist()
        return [sum(v * v for v in row) for row in (off.astype(object) * self.n - left).tolist()]


def identity_error(fit: DataFrame, w: Whitener, dims: int) -> float:
    """Largest absolute entry of the fit list's whitened covariance minus the identity."""
    k = w.k
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    def step(batches):
        one, two = np.zeros(k), np.zeros((k, k))
        for b in batches:
            y = w.project(matrix(b, dims))
            one, two = one + y.sum(0), two + y.T @ y
        yield table_batch({"i": [-1] * k + [i for i in range(k) for _ in range(k)], "j": [*range(k)] * (k + 1),
                           "v": np.concatenate([one, two.ravel()])}, schema)

    got = {(i, j): v / w.n for i, j, v in fit.select("x").mapInArrow(step, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect()}
    return max((abs(v - got[-1, i] * got[-1, j] - (i == j)) for (i, j), v in got.items() if i >= 0), default=0.0)


# ----------------------------------------------------------------- operators
def fit(x: DataFrame, components: int = COMPONENTS) -> tuple[int, Whitener | None, float]:
    """(dimensions, whitener of the distinct x-vectors, its identity error); no whitener without vectors of some variance."""
    most = x.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if most is None:
        return 0, None, 0.0
    dims = most["d"]
    distinct = materialise(x.filter(F.size("x") == dims).select("x").distinct(), "whitening-fit")
    w = Whitener(*scatter(distinct, dims), components)
    return (dims, w, identity_error(distinct, w, dims)) if w.k else (dims, None, 0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error of every
    vector that counts and each component up to ``components``."""
    x = integers(vectors, id_col, vector_col)
    dims, w, error = fit(x, components)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.string()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    names = "vec_id bigint, component int, n bigint, deviation string, whitened double, explained double, identity_error double"

    def step(batches):
        for b in batches if w else ():
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                rows, here = matrix(part, dims), part.num_rows
                deviation = pa.array([str(v) for v in w.deviations(rows)], pa.string())
                again = pa.array(np.repeat(np.arange(here), w.k))
                yield table_batch({
                    "vec_id": part.column("vec_id").take(again), "component": np.tile(np.arange(1, w.k + 1, dtype=np.int32), here),
                    "n": np.full(here * w.k, w.n), "deviation": deviation.take(again), "whitened": w.project(rows).ravel(),
                    "explained": np.tile(w.explained, here), "identity_error": np.full(here * w.k, error)}, schema)

    out = x.filter(F.size("x") == dims).mapInArrow(step, names)
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def report(vectors: DataFrame) -> DataFrame:
    """The contract's columns; a deviation beyond a long is null."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("bigint"))
