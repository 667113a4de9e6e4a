"""Helpers that the operators share: shared scratch tables, Arrow batches, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# ------------------------------------------------------------ shared storage
def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="llm-scratch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


#: While a step is written: the driver keeps the plan texts of past queries, which in a long session of
#: many steps would be most of its memory.
SHORT_PLANS = {"spark.sql.ui.explainMode": "simple", "spark.sql.maxPlanStringLength": "2000"}

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back: lineage ends there,
    so a lost executor repeats reads, not the steps before."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    with settings(spark, SHORT_PLANS):
        w.parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------- inputs
#: Rows are whole texts: batches of Spark's usual 10,000 rows would fill the Python workers' memory.
BATCH_ROWS = 2500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string); a null text becomes empty. Other columns, also ones
    with names that a stage uses itself, never get in the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def crc_mod(doc_id, n: int):
    """crc32 of the id's decimal text, modulo n (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sql_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# -------------------------------------------------------------------- Arrow
def table_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def row_chunks(batches: Iterable[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, their texts) of at most about ``limit`` bytes of text each; a longer text comes
    alone, a null text as empty. Only the texts of one chunk are Python objects at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        begin = size = 0
        for i, n in enumerate([*sizes.tolist(), limit + 1]):
            if (size + n > limit or i == len(sizes)) and i > begin:
                rows = batch.slice(begin, i - begin)
                yield rows, [t or "" for t in rows.column("text").to_pylist()]
                begin, size, rows = i, 0, None
                release_memory()
            size += n


def replace_column(batch: pa.RecordBatch, name: str, values) -> pa.RecordBatch:
    k = batch.schema.get_field_index(name)
    return batch.set_column(k, batch.schema.field(k), pa.array(values, batch.schema.field(k).type))


def release_memory() -> None:
    """Give memory that a block has used back to the system: Python workers live on between tasks."""
    import ctypes
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


# --------------------------------------------------------------- components
def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; component is its smallest node.

    Alternates large-star and small-star steps. Each step reduces to one
    minimum per node (combined before the shuffle) and joins it back, so a hub
    is a hot key of a join that AQE can split, never a group in one task. Each
    round is written to the shared folder. Null ends and loops are ignored.
    """
    def both(e):
        return e.select(F.col("u"), F.col("v")).union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(e, large: bool):
        e = both(e) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = e.join(low, "u")
        if large:
            out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v")))
        return out.filter(F.col("u") != F.col("v"))

    def written(e):
        """The distinct edges as written, and their count and digest, observed while they are."""
        seen = Observation()
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        with settings(spark, NO_BROADCAST):  # every round would leave one or more of them in the driver
            out = materialise(e.distinct().observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "cc")
        return out, (seen.get["n"], seen.get["digest"])

    spark = edges.sparkSession
    cur = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    cur, before = written(cur.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    for _ in range(max_rounds):
        if not before[0]:
            break
        cur, after = written(star(star(cur, True), False))
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not converge")
    low = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return low.union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Indices of links that connect the same nodes 0..n-1 as all links do (at most n - 1 of them)."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for k, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(k)
    return np.array(keep, dtype=np.int64)
