"""Language-model scoring by a weighted backoff automaton over word bigrams.

States are the one-word contexts and the root. A state has an arc for each
word seen after it in training, and a failure arc to the root, whose arcs are
the smoothed word probabilities. With c(u) the tokens after u, an arc weighs
(c(u, w) + K p(w)) / (c(u) + K) and the failure arc K / (c(u) + K): every state's
probabilities sum to 1, one unknown word type included. A text is read once
from left to right, carrying the state and adding log10 weights.

The automaton grows with the corpus, so no task holds it. Documents are read
in blocks; a block sends the distinct n-grams it holds, with its training
counts, to shards by n-gram hash; a shard adds them up and answers each block;
the block is scored with the part of the automaton it can reach. Words and
their pairs are hashes of 64 and 56 bits.

Cases: a null or empty text is the end token alone; repeated rows count each
time; with no training rows every count is 0; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import crc_mod, id_and_text, materialise, release_memory, row_chunks, sql_partitions, table_batch
from tillroll.llm.words import LOWER, split_words

#: Mass K of the failure arc.
BACKOFF = 20.0
#: Added to word counts at the root.
SMOOTHING = 0.1
#: Characters of a block of documents.
BLOCK_CHARS = 8 << 20
END, START = b"\n", b" "  # no word holds white space


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (u * np.uint64(0x9E3779B97F4A7C15)) ^ (w + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    # 56 bits: a clash of bigrams moves a weight by little, and their differences pack well.
    return (x ^ (x >> np.uint64(32))) & np.uint64(0xFFFFFFFFFFFFFF00)


def _squeeze(a: np.ndarray) -> bytes:
    """Sorted numbers as differences, or counts, by byte planes: their high bytes are mostly equal."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _expand(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """Positions where each shard's range of hashes begins among sorted keys, and the end."""
    edges = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _save(**arrays) -> bytes:
    """Whole numbers of any kind, each squeezed."""
    import pickle
    return pickle.dumps({k: _squeeze(np.asarray(a).astype("<i8").view("<u8")) for k, a in arrays.items()})


def _load(raw: bytes) -> dict[str, np.ndarray]:
    import pickle
    return {k: _expand(a).view("<i8") for k, a in pickle.loads(raw).items()}


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(local word ids with ends, offsets of texts, hash of each local word; the last one is END)."""
    words = split_words(texts, LOWER)
    n, v = len(words.offsets) - 1, len(words.distinct)
    by_count = np.argsort(-np.bincount(words.ids, minlength=v), kind="stable")  # small numbers for frequent words
    number = np.empty(v, np.int32)
    number[by_count] = np.arange(v, dtype=np.int32)
    ids = np.insert(number[words.ids], words.offsets[1:], v)
    return ids, words.offsets + np.arange(n + 1), np.concatenate([_hash(words.binary())[by_count], _hash([END])])


def _bigrams(ids: np.ndarray, offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    w = hashes[ids]
    u = np.concatenate([w[:1], w[:-1]])
    u[offsets[:-1]] = _hash([START])[0]
    return _pair(u, w)


BLOCKS = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int32()), ("payload", pa.binary()), ("counts", pa.binary())])


def _read_blocks(shards: int):
    def step(batches):
        from pyspark import TaskContext
        part, k = TaskContext.get().partitionId(), 0
        for rows, texts in row_chunks(batches, BLOCK_CHARS):
            block, k = part << 32 | k, k + 1
            ids, offsets, hashes = _tokens(texts)
            held = np.array(rows.column("held_out").to_pylist(), bool)
            doc = rows.column("doc_id")
            train = np.repeat(~held, np.diff(offsets))
            yield table_batch(dict(zip(BLOCKS.names, zip((0, block, -1, _save(ids=ids, offsets=offsets, hashes=hashes.view(np.int64), held=held, doc=doc.fill_null(0).to_numpy(),
                                        null=doc.is_null().to_numpy(zero_copy_only=False)), None)))), BLOCKS)
            del texts
            for kind in (1, 2):
                if kind == 1:
                    order = np.argsort(hashes)
                    keys, counts = hashes[order], np.bincount(ids, train, len(hashes))[order].astype(np.uint64)
                else:
                    at = _bigrams(ids, offsets, hashes)
                    keys, counts = np.unique(at, return_counts=True)
                    counts = counts.astype(np.uint64)
                    kept_out, n = np.unique(at[~train], return_counts=True)
                    counts[np.searchsorted(keys, kept_out)] -= n.astype(np.uint64)
                    del at
                cut, out = _shards(keys, shards), []
                for s, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                    if i < j:
                        out.append((kind, block, s, _squeeze(np.diff(keys[i:j], prepend=np.uint64(0))), _squeeze(counts[i:j])))
                yield table_batch(dict(zip(BLOCKS.names, zip(*out))), BLOCKS)
                del out, keys, counts
            del ids, offsets, hashes, train, rows, doc
            release_memory()
    return step


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard of one n-gram length: totals of its keys, returned to every block that asked."""
    keys = [np.cumsum(_expand(x), dtype=np.uint64) for x in pdf["payload"]]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(which, np.concatenate([_expand(x) for x in pdf["counts"]]), len(distinct)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in keys])
    answers = [_squeeze(totals[which[e - len(x):e]]) for x, e in zip(keys, ends.tolist())]
    n = len(answers)
    rows = {"kind": pdf["kind"].tolist() + [-int(pdf["kind"].iloc[0])], "block": pdf["block"].tolist() + [-1], "shard": pdf["shard"].tolist() + [0],
            "answer": [*answers, None], "total": [0] * n + [int(totals.sum())], "types": [0] * n + [int((totals > 0).sum())]}
    del keys, distinct, which, totals, answers
    release_memory()
    return pd.DataFrame(rows)


class Automaton:
    """The part of the backoff automaton that a block can reach.

    States are the block's words as contexts, then START; the root is the state
    after a failure. An arc is a bigram seen in training: (state, word) leads to
    the word's state. What has no arc takes the state's failure arc to the root,
    which has an arc for every word. Weights are log10 probabilities.
    """

    def __init__(self, words: np.ndarray, total: int, types: int, backoff: float):
        """``words``: training counts of the block's words, END last."""
        p = (words + SMOOTHING) / (total + SMOOTHING * (types + 1))
        context = np.append(words, words[-1])  # START has gone on as often as END came
        self.root, self.fail = np.log10(p), np.log10(backoff / (context + backoff))
        self._p, self._context, self._backoff, self.start = p, context, backoff, len(words)

    def states(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The state carried to each token, from left to right: its text's start, then the last word's."""
        state = np.concatenate([ids[:1], ids[:-1]])
        state[offsets[:-1]] = self.start
        return state

    def add_arcs(self, state: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Weights of the arcs (state, word) seen ``count`` times; NaN: no arc."""
        weight = np.log10((count + self._backoff * self._p[word]) / (self._context[state] + self._backoff))
        return np.where(count > 0, weight, np.nan)

    def traverse(self, state: np.ndarray, word: np.ndarray, arc: np.ndarray) -> np.ndarray:
        """What each token adds: its arc's weight, or the failure arc's and the root's."""
        return np.where(np.isnan(arc), self.fail[state] + self.root[word], arc)


def _score(total: int, types: int, backoff: float):
    def step(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values(["kind", "shard"])
        count = {k: np.concatenate([_expand(x) for x in answers["answer"][answers["kind"] == k]]).astype(np.float64) for k in (1, 2)}
        d = _load(blocks["payload"].iloc[0])
        ids, offsets, hashes = d["ids"].astype(np.int32), d["offsets"], d["hashes"].view(np.uint64)
        known = np.zeros(len(hashes))
        known[np.argsort(hashes)] = count[1]
        machine = Automaton(known, total, types, backoff)
        state = machine.states(ids, offsets)
        bigrams = _bigrams(ids, offsets, hashes)
        which = np.searchsorted(np.unique(bigrams), bigrams).astype(np.int32)
        del bigrams
        some = np.empty(len(count[2]), np.int32)  # a place of each bigram
        some[which] = np.arange(len(which), dtype=np.int32)
        arcs = machine.add_arcs(state[some], ids[some], count[2])
        base, weight = machine.root[ids], machine.traverse(state, ids, arcs[which])
        begins = offsets[:-1]
        out = pd.DataFrame({"doc_id": pd.array(d["doc"], "Int64"), "held_out": d["held"] > 0, "n_tokens": np.diff(offsets),
                            "n_known": np.add.reduceat((known[ids] > 0).astype(np.int64), begins), "train_tokens": total,
                            "base_score": np.add.reduceat(base, begins), "score": np.add.reduceat(weight, begins)})
        out.loc[d["null"] > 0, "doc_id"] = pd.NA
        del machine, state, some, which, arcs, base, weight, ids, known, count
        release_memory()
        return out
    return step


def score(docs: DataFrame, held_out=None, backoff: float = BACKOFF) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score (words alone) and score.

    ``held_out``: a boolean column over doc_id of rows not to learn from (default: crc32 modulo 10 is 0).
    """
    spark = docs.sparkSession
    rows = id_and_text(docs)
    rows = rows.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 10) == 0 if held_out is None else held_out, F.lit(False)))
    sent = materialise(rows.mapInArrow(_read_blocks(sql_partitions(spark)), "kind int, block bigint, shard int, payload binary, counts binary"),
                       "lm-blocks")
    answers = materialise(sent.filter("kind > 0").groupBy("kind", "shard").applyInPandas(
        _add_up, "kind int, block bigint, shard int, answer binary, total bigint, types bigint"), "lm-answers")
    r = answers.filter("kind = -1").agg(F.sum("total"), F.sum("types")).first()
    return sent.filter("kind = 0").select("block", "payload").groupBy("block").cogroup(
        answers.filter("kind > 0").select("kind", "block", "shard", "answer").groupBy("block")).applyInPandas(
        _score(r[0] or 0, r[1] or 0, backoff),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
