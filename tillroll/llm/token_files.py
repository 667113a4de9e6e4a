"""Token-id files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

An id is replaced by its rank in the corpus counts, so frequent ids take one
byte. Four values share a control byte (two bits each: bytes minus one); the
data bytes follow in a block of their own, and a reader looks the lengths of
four values up in a table of 256 rows.

Files are Parquet tables in the shared folder (the container every executor
and any store Spark reads can use); each row holds one self-contained block:
magic, sizes, document ids and lengths, control bytes, data bytes.

Cases: a null text is empty and yields the end id alone; a null doc_id comes
first; repeated rows are kept, equal ids ordered by the checksum of their tokens.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, materialise, row_chunks, sql_partitions, table_batch
from tillroll.llm.tokenise import encoder
from tillroll.llm.words import ragged

MAGIC = b"RVB1"
#: Bytes of text that a task tokenises at once.
CHUNK_BYTES = 4 << 20
#: Values of a block (a longer document makes a larger block of its own).
BLOCK_VALUES = 1 << 18
#: Bytes of each of the four values of a control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[:len(v)] = size
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begin = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= np.where(size > k, raw[begin + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(doc_ids: list[int | None], lengths: list[int], values: np.ndarray) -> bytes:
    control, data = encode_values(values)
    ids = np.array([0 if x is None else x for x in doc_ids], "<i8")
    null = np.array([x is None for x in doc_ids], np.uint8)
    head = MAGIC + struct.pack("<IQQQ", len(ids), len(values), len(control), len(data))
    return b"".join([head, ids.tobytes(), null.tobytes(), np.array(lengths, "<u8").tobytes(), control, data])


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their lengths, all values)."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    n, m, c, d = struct.unpack_from("<IQQQ", block, 4)
    at = 32
    ids = np.frombuffer(block, "<i8", n, at)
    null = np.frombuffer(block, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(block, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    values = decode_values(block[at:at + c], block[at + c:at + c + d], m)
    return [None if x else y for x, y in zip(null.tolist(), ids.tolist())], lengths, values


def tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, crc, ids) of every document; ids end with ``end_id``."""
    schema = pa.schema([("doc_id", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])

    def step(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype)
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            ids = [np.concatenate([x, end]) for x in enc.ids_of(texts)]
            yield table_batch({"doc_id": rows.column("doc_id"), "crc": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                               "ids": [x.astype("<u4").tobytes() if enc.dtype.itemsize == 4 else x.tobytes() for x in ids]}, schema)

    return id_and_text(docs).mapInArrow(step, "doc_id bigint, crc bigint, ids binary")


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """(id, n): how often each id occurs, summed within each task first."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def step(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype)
            n = np.bincount(flat, minlength=len(total))
            n[:len(total)] += total
            total = n
        at = np.flatnonzero(total)
        yield table_batch({"id": at, "n": total[at]}, schema)

    return tokens.select("ids").mapInArrow(step, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(docs: DataFrame, tokenizer: str, end_id: int, block_values: int = BLOCK_VALUES) -> tuple[DataFrame, DataFrame]:
    """Write a corpus; returns (files, dictionary) as read back from the shared folder.

    files: part, n_values, start (values before the block in its part), block.
    dictionary: rank, id, n; at most one row for each id of the vocabulary.
    """
    dtype = encoder(tokenizer).dtype.str
    spark = docs.sparkSession
    ids = materialise(tokens(docs, tokenizer, end_id), "token-ids")
    by_rank = Window.orderBy(F.col("n").desc(), "id")  # a row for each id of the vocabulary at most
    dictionary = materialise(id_counts(ids, dtype).select((F.row_number().over(by_rank) - 1).cast("bigint").alias("rank"), "id", "n"), "token-dictionary")
    table = {r["id"]: r["rank"] for r in dictionary.collect()}
    rank = np.zeros(max(table, default=0) + 1, np.uint32)
    rank[list(table)] = list(table.values())
    held = spark.sparkContext.broadcast(rank)
    schema = pa.schema([("part", pa.int64()), ("n_values", pa.int64()), ("start", pa.int64()), ("block", pa.binary())])

    def step(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        part, start = TaskContext.get().partitionId(), 0
        ids, arrays, size = [], [], 0

        def flush():
            nonlocal start, ids, arrays, size
            block = write_block(ids, [len(x) for x in arrays], held.value[np.concatenate(arrays)])
            row = table_batch({"part": [part], "n_values": [size], "start": [start], "block": [block]}, schema)
            start, ids, arrays, size = start + size, [], [], 0
            return row

        for b in batches:
            for i, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                x = np.frombuffer(raw, dtype)
                if size and size + len(x) > block_values:
                    yield flush()
                ids.append(i)
                arrays.append(x)
                size += len(x)
        if size:
            yield flush()

    ordered = ids.repartitionByRange(sql_partitions(spark), F.col("doc_id").asc_nulls_first(), "crc") \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "crc").select("doc_id", "ids")
    return materialise(ordered.mapInArrow(step, "part bigint, n_values bigint, start bigint, block binary"), "token-files"), dictionary


def read_files(files: DataFrame, dictionary: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document in the files."""
    table = {r["rank"]: r["id"] for r in dictionary.select("rank", "id").collect()}
    ids = np.zeros(max(table, default=0) + 1, "<u4")
    ids[list(table)] = list(table.values())
    held = files.sparkSession.sparkContext.broadcast(ids)
    schema = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def step(batches):
        for b in batches:
            for part, start, block in zip(*(b.column(c).to_pylist() for c in ("part", "start", "block"))):
                doc, n, values = read_block(block)
                raw = held.value[values].tobytes()
                ends = np.cumsum(n)
                cut = [raw[4 * i:4 * j] for i, j in zip((ends - n).tolist(), ends.tolist())]
                yield table_batch({"part": [part] * len(doc), "doc_id": doc, "start": start + ends - n, "n_tokens": n,
                                   "ids_crc32": list(map(zlib.crc32, cut)), "ids": cut}, schema)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote
    base = files.groupBy("part").agg(F.sum("n_values").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.select("part", "start", "block").mapInArrow(
        step, "part bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "ids")
