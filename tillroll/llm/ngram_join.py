"""N-gram Jaccard join by a MinHash LSH forest.

Every set has a label of ``DEPTH`` MinHash values in each of ``TREES`` trees. A
tree is its labels in sorted order, which is its trie read from left to right:
the sets below a prefix stand side by side, and neighbours are linked with the
length of the prefix that they share. Long prefixes come first; they are
shortened until every true pair of a sample meets. That is measured: a bounded
sample of sets is compared exactly with all sets, and of each pair at the
threshold the longest prefix shared in some tree is counted. The length is never
above the one at which a pair at the threshold meets with the probability
``TARGET_RECALL`` in theory (6: a pair of similarity J then misses all trees
with the probability (1 - J**6)**24), and lower where the data ask for it.
Links of that prefix length are candidates, as chains of neighbours; their
components are then verified exactly, all pairs, in blocks of bounded size, so
nothing emits the pairs of a group. Sets that are equal count as one
representative.

Shingles are 48-bit hashes of five consecutive words (a text with fewer is one
shingle); two sets of 1000 share a value by chance with a probability under
10**-8.

Cases: rows without words (null and empty texts too) link with nothing and are
classes of their own; repeated rows are copies of each other; a null doc_id
takes part, and its class is null only if it holds no other id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import connected_components, forest, id_and_text, materialise, release_memory, row_chunks, sql_partitions, table_batch
from tillroll.llm.words import ragged, split_words

SHINGLE, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.999
TREES, DEPTH = 24, 7
#: Sets that are compared with all others to measure recall, and the shingles that one of them may have.
SAMPLE, SAMPLE_SHINGLES = 256, 20_000
#: Representatives of one side of a block that is verified at once.
BLOCK = 256
#: Bytes of text that a task turns into shingles at once.
CHUNK_BYTES = 4 << 20
_P = np.uint64(0x9E3779B97F4A7C15)


def prefix_depth(threshold: float = THRESHOLD, target: float = TARGET_RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of the threshold's similarity meet in a tree with the target probability."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    import xxhash
    words = split_words(texts)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words.binary()] or [0], np.uint64)[words.ids]
    out = []
    for i, j in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        n = min(size, j - i)
        x = np.zeros(max(0, j - i - n + 1) if n else 0, np.uint64)
        for k in range(n):
            x = x * _P + h[i + k:i + k + len(x)]
        out.append(np.unique(_mix(x + np.uint64(n)) >> np.uint64(16)))
    return out


def tree_labels(sets: list[np.ndarray], depth: int = DEPTH, trees: int = TREES) -> np.ndarray:
    """[set, tree, place]: the labels of (non-empty) sets, 16 bits of each MinHash value."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    x = _mix(np.concatenate(sets))
    rng = np.random.default_rng(20240229)
    out = np.empty((len(sets), trees, depth), ">u2")  # bytes in the order of the values
    for t in range(trees):
        for d in range(depth):
            seed, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            v = (x ^ seed) * (odd << np.uint64(1) | np.uint64(1))
            out[:, t, d] = _mix(np.minimum.reduceat(v, starts)) >> np.uint64(48)
    return out


def shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix along the last axis."""
    return np.cumprod(a == b, axis=-1).sum(-1)


def _pack(s: np.ndarray) -> bytes:
    """Sorted 48-bit numbers: the byte planes of their differences."""
    import zstandard
    d = np.diff(s, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.T).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :6] = planes.T
    return np.cumsum(wide.view("<u8").reshape(-1), dtype=np.uint64)


SETS = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("fp", pa.string()), ("labels", pa.binary()),
                  ("n_shingles", pa.int64()), ("shingles", pa.binary())])
SETS_SQL = "doc_id bigint, digest string, fp string, labels binary, n_shingles bigint, shingles binary"


def _sets(trees: int):
    def step(batches):
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            sets = shingle_sets(texts)
            full = [k for k, s in enumerate(sets) if len(s)]
            fp, labels, packed = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                for k, row in zip(full, tree_labels([sets[k] for k in full], trees=trees)):
                    fp[k], labels[k], packed[k] = hashlib.md5(sets[k].tobytes()).hexdigest(), row.tobytes(), _pack(sets[k])
            yield table_batch({"doc_id": rows.column("doc_id"), "digest": [hashlib.md5(t.encode()).hexdigest() for t in texts], "fp": fp,
                               "labels": labels, "n_shingles": [len(s) for s in sets], "shingles": packed}, SETS)
    return step


def _grow(trees: int):
    """Rows (tree, label, rid) of a batch of representatives."""
    schema = pa.schema([("tree", pa.int32()), ("label", pa.binary()), ("rid", pa.int64())])

    def step(batches):
        for b in batches:
            raw, width = b"".join(b.column("labels").to_pylist()), 2 * DEPTH
            n = b.num_rows * trees
            yield table_batch({"tree": np.tile(np.arange(trees, dtype=np.int32), b.num_rows),
                               "label": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(raw)]),
                               "rid": np.repeat(b.column("rid").to_numpy(zero_copy_only=False), trees)}, schema)
    return step


def _neighbours(least: int):
    """Links (a, b, depth) of neighbours in one task's sorted labels that share at least that prefix, and its
    first and last row with b null."""
    return lambda batches: _neighbours_of(batches, least)


def _neighbours_of(batches, least):
    from pyspark import TaskContext
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int32()), ("tree", pa.int32()), ("label", pa.binary()), ("part", pa.int32())])
    part, last = TaskContext.get().partitionId(), None

    def end(tree, label, rid):
        return table_batch({"a": [rid], "b": [None], "depth": [0], "tree": [tree], "label": [label], "part": [part]}, schema)

    for b in batches:
        if not b.num_rows:
            continue
        tree, rid = b.column("tree").to_numpy(), b.column("rid").to_numpy()
        raw = b.column("label").to_pylist()
        label = np.frombuffer(b"".join(raw), ">u2").reshape(-1, DEPTH)
        if last is None:
            yield end(int(tree[0]), raw[0], int(rid[0]))
        else:
            tree, rid = np.append(last[0], tree), np.append(last[2], rid)
            label = np.concatenate([np.frombuffer(last[1], ">u2")[None], label])
        depth = shared_prefix(label[1:], label[:-1]) * (tree[1:] == tree[:-1])
        at = np.flatnonzero(depth >= least)
        yield table_batch({"a": rid[at + 1], "b": rid[at], "depth": depth[at].astype(np.int32), "tree": tree[at].astype(np.int32),
                           "label": pa.nulls(len(at), pa.binary()), "part": np.full(len(at), part, np.int32)}, schema)
        last = int(tree[-1]), raw[-1], int(rid[-1])
    if last is not None:
        yield end(*last)


def forest_links(reps: DataFrame, trees: int, least: int = 1) -> DataFrame:
    """(a, b, depth) of neighbours of all trees with prefixes of ``least`` values or more; written to the shared folder."""
    spark = reps.sparkSession
    rows = reps.select("rid", "labels").mapInArrow(_grow(trees), "tree int, label binary, rid bigint")
    ordered = rows.repartitionByRange(sql_partitions(spark), "tree", "label", "rid").sortWithinPartitions("tree", "label", "rid")
    links = materialise(ordered.mapInArrow(_neighbours(least), "a bigint, b bigint, depth int, tree int, label binary, part int"), "jaccard-forest")
    # Neighbours across tasks: two rows of each task.
    ends = sorted(links.filter("b is null").select("part", "tree", "label", "a").collect(), key=lambda r: (r.part, r.tree, bytes(r.label), r.a))
    across = []
    for x, y in zip(ends, ends[1:]):
        if x.part != y.part and x.tree == y.tree:
            depth = int(shared_prefix(np.frombuffer(x.label, ">u2"), np.frombuffer(y.label, ">u2")))
            if depth >= least:
                across.append((y.a, x.a, depth))
    more = spark.createDataFrame(across, "a bigint, b bigint, depth int")
    return links.filter("b is not null").select("a", "b", "depth").unionByName(more)


def depth_counts(sets: DataFrame, reps: DataFrame, threshold: float, trees: int) -> dict[int, int]:
    """Of all pairs at the threshold between a sample of representatives and any other row's set, how many share
    which longest prefix."""
    # First which, by id alone: a task would send its own least rows whole.
    least = reps.filter(F.col("n_shingles") <= SAMPLE_SHINGLES).select("pick", "fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    taken = sets.filter(F.col("row").isin([r.pick for r in least])).select("fp", "labels", "shingles").collect() if least else []
    if not taken:
        return {}
    parts = [_unpack(r.shingles) for r in taken]
    values, which = np.unique(np.concatenate(parts), return_inverse=True)
    owner = np.repeat(np.arange(len(parts)), [len(s) for s in parts])
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(values) + 1))
    held = reps.sparkSession.sparkContext.broadcast((
        values, first, owner[order], np.array([len(s) for s in parts]), np.array([r.fp for r in taken]),
        np.array([np.frombuffer(r.labels, ">u2").reshape(trees, DEPTH) for r in taken])))
    schema = pa.schema([("depth", pa.int32()), ("n", pa.int64())])

    def step(batches):
        values, first, owner, size, own, labels = held.value
        total = np.zeros(DEPTH + 1, np.int64)
        for b in batches:
            for raw, mine, fp in zip(*(b.column(c).to_pylist() for c in ("shingles", "labels", "fp"))):
                x = _unpack(raw)
                at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                at = at[values[at] == x]
                both = np.bincount(owner[ragged(first[at], first[at + 1] - first[at])], minlength=len(size))
                hit = np.flatnonzero((both > 0) & (both >= threshold * (size + len(x) - both) - 1e-6) & (own != fp))
                if len(hit):
                    deep = shared_prefix(labels[hit], np.frombuffer(mine, ">u2").reshape(1, *labels.shape[1:])).max(1)
                    total += np.bincount(deep, minlength=DEPTH + 1)
        yield table_batch({"depth": np.arange(DEPTH + 1, dtype=np.int32), "n": total}, schema)
        release_memory()

    got = sets.filter("fp is not null").select("fp", "labels", "shingles").mapInArrow(step, "depth int, n bigint").groupBy("depth").agg(F.sum("n")).collect()
    held.destroy()
    return {d: n for d, n in got if n}


def adapted_depth(counts: dict[int, int], most: int, recall: float = 1.0) -> int:
    """The longest prefix up to ``most`` at which that share of the counted pairs meets (1 at least)."""
    total = sum(counts.values())
    return max((d for d in range(1, most + 1) if sum(n for k, n in counts.items() if k >= d) >= recall * total), default=1)


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs (of a with b, or within a) with exact Jaccard similarity of the threshold or more."""
    sets = a + (b or [])
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    value, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[which] > 1
    column = (np.cumsum(n > 1) - 1)[which[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width, m = 4096, len(a)
    both = np.zeros((m, len(b) if b else m), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[i:j], column[i:j] - at] = 1
        both += part[:m] @ (part[m:] if b else part).T
    left, right = size[:m, None], size[None, m:] if b else size[None]
    hit = both >= threshold * (left + right - both) - 1e-6
    if not b:
        hit = np.triu(hit, 1)
    return np.nonzero(hit)


def _verify(threshold: float):
    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["component", "rid"]).sort_values(["component", "chunk", "rid"], kind="stable")
        rid, copies = pdf["rid"].to_numpy(), pdf["copies"].to_numpy()
        comp, chunk = pdf["component"].to_numpy(), pdf["chunk"].to_numpy()
        packed, first, second = pdf["shingles"].tolist(), pdf["ci"].iloc[0], pdf["cj"].iloc[0]
        links, edges = np.zeros(len(rid), np.int64), []
        begins = np.flatnonzero(np.concatenate([[True], comp[1:] != comp[:-1]])).tolist()
        for i, j in zip(begins, [*begins[1:], len(rid)]):
            sets = [_unpack(x) for x in packed[i:j]]
            cut = int((chunk[i:j] == first).sum()) if first != second else 0
            if first != second:
                if cut in (0, j - i):
                    continue
                x, y = _linked(sets[:cut], sets[cut:], threshold)
                y = y + cut
            else:
                x, y = _linked(sets, None, threshold)
            np.add.at(links, i + x, copies[i + y])
            np.add.at(links, i + y, copies[i + x])
            edges += [(rid[i + x[k]], rid[i + y[k]]) for k in forest(j - i, x, y)]
        some = np.flatnonzero(links)
        del pdf, packed
        release_memory()
        return pd.DataFrame({"a": np.concatenate([rid[some], [e[0] for e in edges]]).astype(np.int64),
                             "b": pd.array([*[None] * len(some), *(int(e[1]) for e in edges)], "Int64"),
                             "links": np.concatenate([links[some], np.zeros(len(edges))]).astype(np.int64)})
    return step


def classes(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, trees: int = TREES) -> DataFrame:
    """Per row: doc_id, digest (of the text), n_links, class_id, and component, which names its class (null: its own)."""
    sets = id_and_text(docs).mapInArrow(_sets(trees), SETS_SQL).withColumn("row", F.monotonically_increasing_id())
    sets = materialise(sets, "jaccard-sets")
    reps = materialise(sets.filter("fp is not null").groupBy("fp").agg(
        F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels"),
        F.first("n_shingles").alias("n_shingles"), F.min("row").alias("pick"))
        .withColumn("rid", F.monotonically_increasing_id()), "jaccard-reps")
    depth = adapted_depth(depth_counts(sets, reps, threshold, trees), prefix_depth(threshold, target_recall, trees))
    members = materialise(connected_components(forest_links(reps, trees, depth)).withColumnRenamed("node", "rid"), "jaccard-candidates")

    # Small components share a bin of bounded size; large ones are dealt as pairs of chunks.
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    total = members.count()
    chunks = F.ceil(F.col("size") / F.lit(BLOCK))
    dealt = members.join(sizes, "component").withColumn("chunks", chunks) \
        .withColumn("chunk", F.pmod(F.xxhash64("rid"), F.col("chunks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))) \
        .withColumn("ci", F.least("chunk", "other")).withColumn("cj", F.greatest("chunk", "other")) \
        .withColumn("bin", F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("component"), F.lit(total // BLOCK + 1))).otherwise(-1 - F.col("component")))
    # Shingles stay with one row of each representative.
    held = members.select("rid").join(reps.select("rid", "copies", "pick"), "rid").join(
        sets.select(F.col("row").alias("pick"), "shingles"), "pick").drop("pick")
    verified = materialise(dealt.select("rid", "component", "chunk", "bin", "ci", "cj").join(held, "rid")
                           .groupBy("bin", "ci", "cj").applyInPandas(_verify(threshold), "a bigint, b bigint, links bigint"), "jaccard-links")

    links = verified.filter("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    linked = connected_components(verified.filter("b is not null")).withColumnRenamed("node", "rid")
    named = reps.select("rid", "fp", "min_id", "copies").join(linked, "rid", "left").join(links, "rid", "left") \
        .withColumn("component", F.coalesce("component", "rid"))
    class_ids = named.groupBy("component").agg(F.min("min_id").alias("class_id"))
    named = named.join(class_ids, "component").select("fp", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sets.select("doc_id", "digest", "fp").join(named, "fp", "left").select(
        "doc_id", "digest", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "component")


def join(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, trees: int = TREES) -> DataFrame:
    """Per document: doc_id, n_links (other documents at the threshold or above) and class_id
    (smallest doc_id reachable by links, itself included)."""
    return classes(docs, threshold, target_recall, trees).select("doc_id", "n_links", "class_id")


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class: of its smallest doc_id (a null id comes last), and of several texts of that
    id the one with the least digest. Rows without words are classes of their own; of equal rows one stays."""
    rows = materialise(classes(docs, threshold).withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "digest")), "jaccard-classes")
    first = rows.filter("component is not null").groupBy("component").agg(F.min("order").alias("order")).select("order.doc_id", "order.digest")
    keep = first.unionByName(rows.filter("component is null").select("doc_id", "digest").distinct()) \
        .select(F.col("doc_id").alias("__keep"), F.col("digest").alias("__digest"))
    own = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.join(keep, (own == F.col("__digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)
