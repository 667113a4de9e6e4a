"""Packing by cutting-stock column generation.

A document's tokens are cut into full sequences and one remainder. The
histogram of remainder lengths (at most ``size`` - 1 numbers, whatever the
corpus) is packed by a linear program over patterns: a knapsack dynamic
program prices new columns until none improves much, the solution is rounded
down, then up where the demand allows it, and the few remainders left over are
placed first-fit decreasing. Patterns are handed to pieces by their rank
within their length, so the assignment is a join with a bounded table.

A sequence that sums to a power of two needs no padding, so such patterns cost
what they hold.

Cases: a null text is empty and holds its end id alone; repeated rows and null
ids are packed like others; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, materialise, row_chunks, sql_partitions, table_batch
from tillroll.llm.tokenise import encoder

SIZE = 1024
#: Bytes of text that a task tokenises at once.
CHUNK_BYTES = 4 << 20
#: The program stops at this relative distance from its lower bound, or after this many columns.
GAP, COLUMNS = 0.002, 300


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, ids (unsigned, little-endian) of every piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def step(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype)
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            out = {c: [] for c in schema.names}
            for i, x in zip(rows.column("doc_id").to_pylist(), enc.ids_of(texts)):
                x = np.concatenate([x, end])
                for at in range(0, len(x), size):
                    cut = x[at:at + size]
                    for c, v in zip(schema.names, (i, at, len(cut), zlib.crc32(cut.astype("<u4").tobytes()), len(x), cut.tobytes())):
                        out[c].append(v)
            yield table_batch(out, schema)
        enc.memo.rest()

    return id_and_text(docs).mapInArrow(step, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")


def _knapsack(lengths: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of exact fill of each capacity (-inf: none), and the item that ends it."""
    best = np.full(size + 1, -np.inf)
    best[0], last = 0.0, np.full(size + 1, -1)
    for c in range(int(lengths[0]), size + 1):
        n = np.searchsorted(lengths, c, side="right")
        got = best[c - lengths[:n]] + value[:n]
        k = int(got.argmax())
        best[c], last[c] = got[k], k
    return best, last


def _first_basis(lengths: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """A feasible start: greedy patterns, each used until one of its lengths runs out. A length is in no
    pattern after the one that used it up, so the columns are triangular and the basis is regular."""
    m = len(lengths)
    base, done = np.zeros((m, m)), np.zeros(m, bool)
    for r in range(m):
        column, room = np.zeros(m), size
        for i in np.flatnonzero(~done)[::-1].tolist():
            if lengths[i] <= room:
                column[i] = min(room // lengths[i], max(1, np.ceil(left[i])))
                room -= int(column[i] * lengths[i])
        used = np.flatnonzero(column)
        i = int(used[(left[used] / column[used]).argmin()])
        left = left - left[i] / column[i] * column
        done[i] = True
        base[:, r] = column
    return base


def patterns(lengths: np.ndarray, demand: np.ndarray, size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each length index, times)] from the rounded linear program; never more than the demand."""
    m = len(lengths)
    if not m:
        return []
    powers = [1 << k for k in range(size.bit_length()) if 1 << k < size]
    base = _first_basis(lengths, demand.astype(float), size)
    total = lengths @ base
    cost = np.where(np.isin(total, powers), total, float(size))
    inverse = np.linalg.inv(base)
    x = np.maximum(inverse @ demand, 0)
    for _ in range(COLUMNS):
        dual = cost @ inverse
        best, last = _knapsack(lengths, dual, size)
        ends = [int(best.argmax()), *(p for p in powers if best[p] > -np.inf)]
        price = [float(p if p in powers else size) for p in ends]
        ratio = [best[e] / p for e, p in zip(ends, price)]
        k = int(np.argmax(ratio))
        if ratio[k] <= 1 + GAP:  # dividing the dual by the ratio makes it feasible: the bound is within GAP
            break
        column, c = np.zeros(m), ends[k]
        while c:
            column[last[c]] += 1
            c -= int(lengths[last[c]])
        d = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(d > 1e-9, x / d, np.inf)
        r = int(step.argmin())
        x = np.maximum(x - step[r] * d, 0)
        x[r] = step[r]
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        base[:, r], cost[r] = column, price[k]
    times = np.floor(x + 1e-9).astype(np.int64)
    left = demand.astype(np.int64) - base.astype(np.int64) @ times
    while (left < 0).any():  # by rounding errors of the inverse only
        r = int(np.flatnonzero((base[int(left.argmin())] > 0) & (times > 0))[0])
        times[r] -= 1
        left = left + base[:, r].astype(np.int64)
    for r in np.argsort(times - x, kind="stable"):
        column = base[:, r].astype(np.int64)
        if x[r] > times[r] and (column <= left).all():
            times[r] += 1
            left -= column
    return [({int(i): int(base[i, r]) for i in np.flatnonzero(base[:, r])}, int(times[r])) for r in range(m) if times[r]]


def first_fit(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Sequences of the given pieces, longest first, each into the fullest sequence that takes it."""
    room: list[list[list[int]]] = [[] for _ in range(size + 1)]
    for x in sorted(lengths, reverse=True):
        k = next((k for k in range(x, size) if room[k]), size)
        seq = room[k].pop() if k < size else []
        seq.append(x)
        room[k - x].append(seq)
    return [s for r in room for s in r]


def slots(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, per sequence, first sequence, offset): where the pieces of a length go.

    Rank r of the interval lies in sequence first + (r - rank) // per at offset + (r - rank) % per * length.
    At most a row for each length of each pattern: bounded by ``size``, not by the corpus.
    """
    lengths = np.array(sorted(x for x, n in histogram.items() if n and x < size), np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], np.int64)
    rank = dict.fromkeys(histogram, 0)
    out, sequence = [], 0

    def place(parts: list[tuple[int, int]], times: int):
        nonlocal sequence
        offset = 0
        for x, per in parts:
            out.append((x, rank[x], per * times, per, sequence, offset))
            rank[x] += per * times
            offset += per * x
        sequence += times

    for pattern, times in patterns(lengths, demand, size):
        place([(int(lengths[i]), per) for i, per in pattern.items()], times)
    rest = [x for x in map(int, lengths) for _ in range(histogram[x] - rank[x])]
    for seq in first_fit(rest, size):
        place([(x, seq.count(x)) for x in dict.fromkeys(seq)], 1)
    if histogram.get(size):
        place([(size, 1)], histogram[size])
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """Every piece with sequence_id, offset and its token ids."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, end_id, size), "pieces")
    # Ranks within a length, in buckets: a length that holds most rows is still spread.
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(sql_partitions(spark)))
    cut = cut.withColumn("bucket", bucket)
    counts = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(counts.select("length", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # ``size`` rows at most
    table = spark.createDataFrame(slots(histogram, size), "slot_length bigint, first bigint, ranks bigint, per bigint, sequence bigint, at bigint")
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("row", F.row_number().over(inner) - 1).join(counts.drop("n").hint("merge"), ["length", "bucket"]) \
        .withColumn("r", F.col("row") + F.col("before"))
    k = F.col("r") - F.col("first")
    return ranked.join(F.broadcast(table), (F.col("length") == F.col("slot_length")) & (k >= 0) & (k < F.col("ranks"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.expr("(r - first) div per")).alias("sequence_id"),
        (F.col("at") + F.expr("(r - first) % per") * F.col("length")).alias("offset"), "ids")
