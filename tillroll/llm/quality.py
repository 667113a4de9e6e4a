"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Random indexing: every feature (a word's letters, or the shape of a token) has
a bucket with a sparse random index vector; a bucket's context vector is the
sum of the index vectors of the features next to it over all documents. A
document is pooled as the mean context vector of its words and of its shapes.
A two-layer network in numpy, fitted on labelled documents, scores the pooled
vectors; its logits are divided by a temperature fitted on labelled documents
that the fit did not see.

Corpus vectors cover all documents and use no label. The network is fitted on
at most ``SAMPLE`` labelled documents, taken by a hash of the id, of those whose
crc32(doc_id as text) modulo 4 is not 2.

Cases: a null or empty text pools to zero and gets the score of that; null or
repeated labels: null ones are ignored, repeated ones count once each; without
two classes the score is the share of label 1 (0.5 without labels); repeated
rows and null ids are scored like others.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import crc_mod, id_and_text, row_chunks, sql_partitions, table_batch
from tillroll.llm.words import split_words

BUCKETS, WIDTH, NONZERO, WINDOW = 1 << 14, 48, 4, 2
SAMPLE, HIDDEN, EPOCHS, CUTOFF = 20_000, 32, 60, 0.7
SHARDS = 16
#: Bytes of text that a task turns into features at once.
CHUNK_BYTES = 3 << 20
LETTERS = re.compile(r"[^\W\d_]+")
REPEATED = zlib.crc32(b"\x00repeated") % BUCKETS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero parts of each bucket's index vector."""
    rng = np.random.default_rng(17)
    return rng.integers(0, WIDTH, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def shape(token: str) -> str:
    """Runs of capitals, small letters and digits as A, a and 0; other characters as they are."""
    out = []
    for c in token[:64]:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or k != out[-1]:
            out.append(k)
    return "".join(out)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, offsets) of the texts' tokens. A token that equals the one
    before it has a shape of its own."""
    words = split_words(texts, None)
    strings = words.strings()
    crc = lambda s: zlib.crc32(s.encode()) % BUCKETS
    word = np.array([crc("".join(LETTERS.findall(w)).lower()) for w in strings] or [0], np.int64)[words.ids]
    shapes = np.array([crc("\x00" + shape(w)) for w in strings] or [0], np.int64)[words.ids]
    same = np.flatnonzero(words.ids[1:] == words.ids[:-1]) + 1
    shapes[same] = REPEATED
    return word, shapes, words.offsets


SLICES = pa.schema([("shard", pa.int32()), ("vectors", pa.binary())])


def _accumulate(batches):
    """Context vectors of this task's documents, in SHARDS slices of buckets."""
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * WIDTH)
    for _, texts in row_chunks(batches, CHUNK_BYTES):
        word, shapes, offsets = features(texts)
        n = len(word)
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        for stream in (word, shapes):
            for d in range(1, WINDOW + 1):
                near = np.flatnonzero(text[d:] == text[:n - d]) if n > d else np.zeros(0, np.int64)
                for a, b in ((near, near + d), (near + d, near)):
                    for k in range(NONZERO):
                        total += np.bincount(stream[a] * WIDTH + place[stream[b], k], sign[stream[b], k], BUCKETS * WIDTH)
    cut = total.reshape(SHARDS, -1).astype("<f8")
    yield table_batch({"shard": range(SHARDS), "vectors": [x.tobytes() for x in cut]}, SLICES)


def _sum(batches):
    """Slices of this task added up by shard, as they stream in."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for shard, raw in zip(b.column("shard").to_pylist(), b.column("vectors").to_pylist()):
            x = np.frombuffer(raw, "<f8")
            total[shard] = total[shard] + x if shard in total else x
    yield table_batch({"shard": list(total), "vectors": [x.tobytes() for x in total.values()]}, SLICES)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x WIDTH unit vectors (6 MB at any corpus size), summed over all documents.

    Tasks' sums are added in two steps, so no task reads those of all tasks."""
    kind = "shard int, vectors binary"
    parts = id_and_text(docs).mapInArrow(_accumulate, kind).withColumn("group", F.spark_partition_id() % 256)
    some = parts.repartition(sql_partitions(docs.sparkSession), "shard", "group").select("shard", "vectors").mapInArrow(_sum, kind)
    parts = some.repartition(SHARDS, "shard").mapInArrow(_sum, kind)
    got = {r[0]: np.frombuffer(r[1], "<f8") for r in parts.collect()}
    if not got:
        return np.zeros((BUCKETS, WIDTH), np.float32)
    v = np.concatenate([got[k] for k in range(SHARDS)]).reshape(BUCKETS, WIDTH)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of words and of shapes of each text, with signed square roots: small shares count."""
    word, shapes, offsets = features(texts)
    n = np.diff(offsets)
    out = np.zeros((len(texts), 2 * WIDTH), np.float32)
    for k, stream in enumerate((word, shapes)):
        for i, (b, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if e - b > BUCKETS:  # a long text: its buckets' counts, not a vector for each token
                out[i, k * WIDTH:(k + 1) * WIDTH] = np.bincount(stream[b:e], minlength=BUCKETS).astype(np.float32) @ vectors / n[i]
            elif e > b:
                out[i, k * WIDTH:(k + 1) * WIDTH] = vectors[stream[b:e]].sum(0) / n[i]
    return np.sign(out) * np.sqrt(np.abs(out))


class Network:
    """Standardised input, one hidden layer, one logit over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray):
        rng = np.random.default_rng(5)
        self.constant = None
        fit = ~calibrate
        if len(np.unique(y)) < 2 or len(np.unique(y[fit])) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x[fit].mean(0), x[fit].std(0) + 1e-3
        self.w1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN))
        self.w2 = rng.normal(0, HIDDEN ** -0.5, HIDDEN)
        self.b1, self.b2, self.temperature = np.zeros(HIDDEN), np.zeros(1), 1.0
        params = [self.w1, self.b1, self.w2, self.b2]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        xs, ys = (x[fit] - self.mean) / self.scale, y[fit]
        weight = np.where(ys == 1, 0.5 / max(ys.mean(), 1e-6), 0.5 / max(1 - ys.mean(), 1e-6))
        t = 0
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(len(ys)), max(1, len(ys) // 256)):
                h = np.maximum(xs[at] @ self.w1 + self.b1, 0)
                g = weight[at] * (1 / (1 + np.exp(-(h @ self.w2 + self.b2))) - ys[at]) / len(at)
                back = np.outer(g, self.w2) * (h > 0)
                t += 1
                for k, d in enumerate((xs[at].T @ back + 1e-4 * self.w1, back.sum(0), h.T @ g, g.sum(keepdims=True))):
                    first[k] += 0.1 * (d - first[k])
                    second[k] += 0.001 * (d * d - second[k])
                    params[k] -= 0.005 * first[k] / (1 - 0.9 ** t) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        held = calibrate if calibrate.any() else fit
        z, want = self.logits(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        self.temperature = float(grid[int(np.argmin([np.logaddexp(0, np.where(want == 1, -z, z) / t).mean() for t in grid]))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def held_out(doc_id):
    return crc_mod(doc_id, 4) == 2


def fit(docs: DataFrame, labels: DataFrame, vectors, sample: int = SAMPLE) -> Network:
    """``vectors``: a broadcast of context_vectors(docs)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = id_and_text(docs).join(F.broadcast(taken), "doc_id")  # ``sample`` rows at most
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("x", pa.binary())])

    def step(batches):
        for b, texts in row_chunks(batches, CHUNK_BYTES):
            yield table_batch({"doc_id": b.column("doc_id"), "quality": b.column("quality"),
                               "x": [r.tobytes() for r in pool(texts, vectors.value)]}, schema)

    # A repeated document row would make the sample longer than its bound; of several texts the least counts.
    got = rows.mapInArrow(step, "doc_id bigint, quality int, x binary").groupBy("doc_id", "quality").agg(F.min("x")).collect()
    got.sort(key=lambda r: (r[0], r[1]))
    x = np.array([np.frombuffer(r[2], np.float32) for r in got], np.float64).reshape(len(got), 2 * WIDTH)
    return Network(x, np.array([r[1] for r in got], np.float64), np.array([zlib.crc32(b"t%d" % r[0]) % 5 == 0 for r in got], bool))


def score(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` with score and predicted."""
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(context_vectors(docs))
    network = spark.sparkContext.broadcast(fit(docs, labels, vectors))
    docs = docs.drop("score", "predicted")

    def step(batches):
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            s = network.value.scores(pool(texts, vectors.value).astype(np.float64))
            yield rows.append_column("score", pa.array(s, pa.float64())).append_column("predicted", pa.array((s >= cutoff).astype(np.int32), pa.int32()))

    from pyspark.sql import types as T
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(step, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(id_and_text(docs), labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without those that are predicted 0. Columns of any names pass through."""
    work = [c if c in ("doc_id", "text") else f"__c{k}" for k, c in enumerate(docs.columns)]
    return score(docs.toDF(*work), labels, cutoff).filter("predicted = 1").select(*work).toDF(*docs.columns)
