"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton is built over item words; a stream of document words is run
through it, keeping the longest matching length. Where that length reaches the
window, the last window of words lies in an item.

Cases: a null or empty text has no words; a null item id counts as the empty
id; items without words match nothing; repeated items and rows count as they
stand; an empty item table leaves every document clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import id_and_text, materialise, replace_column, row_chunks, table_batch
from tillroll.llm.words import split_words

#: Words of an item that is shorter than this are one window.
WINDOW = 10
#: Item characters in one automaton. A larger item table is split, and documents pass once for each part.
#: One of 1,000,000 characters (176,504 states) was measured at 165 MB; every Python worker holds one.
AUTOMATON_CHARS = 2_000_000
#: A document of which more than this part was hit is dropped by ``clean``.
COVERAGE_LIMIT = 0.5
#: Words in the text as it stands (the lower-cased form has them at the same places).
WORD_RE = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        words = split_words([t or "" for _, t in items])
        self.vocab = {w: k for k, w in enumerate(words.binary())}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(items[k][0] or "", words.ids[words.offsets[k]:words.offsets[k + 1]].tolist()) for k in range(len(items))]
        sequences = [(i, s) for i, s in sequences if s]
        for _, s in sequences:
            last = 0
            for w in s:
                last = self._extend(last, w)
        self.shortest = min([window, *(len(s) for _, s in sequences)])
        # The state whose strings include the last `window` words of a longer match.
        self.at_window = list(range(len(self.length)))
        for v in range(len(self.length)):
            u = v
            while self.length[u] >= window and self.link[u] > 0 and self.length[self.link[u]] >= window:
                u = self.link[u]
            self.at_window[v] = u
        self.items: dict[int, set[str]] = {}
        short: dict[int, set[str]] = {}
        pairs = set()
        for i, s in sequences:
            v = 0
            for k, w in enumerate(s):
                v = self.next[v][w]
                if k + 1 >= window:
                    self.items.setdefault(self.at_window[v], set()).add(i)
                if k:
                    pairs.add((s[k - 1], w))
            if len(s) < window:
                short.setdefault(v, set()).add(i)
        # Whole short items that end wherever a state's strings end: (words, ids), longest first.
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        if short:
            for v in range(len(self.length)):
                u, found = v, []
                while u > 0:
                    if u in short:
                        found.append((self.length[u], short[u]))
                    u = self.link[u]
                if found:
                    self.short[v] = found
        n = len(self.vocab) + 1
        self.pairs = np.array(sorted(a * n + b for a, b in pairs), np.int64)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, w, q)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def run(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """(merged hit intervals, ids of items with an occurring window) of a word sequence."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        hits, items, v, n = [], set(), 0, 0

        def add(begin, end):
            while hits and hits[-1][1] >= begin:
                begin = min(begin, hits.pop()[0])
            hits.append((begin, end))

        for k, w in enumerate(ids):
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                n += 1
            else:
                n = 0
            if n >= window:
                add(k + 1 - n, k + 1)
                items |= self.items.get(self.at_window[v], set())
            for m, found in self.short.get(v, ()):
                if m <= n:
                    add(k + 1 - m, k + 1)
                    items |= found
        return hits, items

    def find(self, texts: list[str]) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set[str]]]]:
        """(words of each text, {text: (intervals of word positions, item ids)})."""
        words = split_words(texts)
        code = np.array([self.vocab.get(w, -1) for w in words.binary()] or [0], np.int64)
        ids = code[words.ids]
        out: dict[int, tuple[list, set]] = {}
        if not len(ids) or not self.vocab:
            return words.counts, out
        # The automaton leaves its root for good only where word pairs occur in items, so
        # it is run over stretches of such pairs; elsewhere its length is at most 1.
        if self.shortest == 1:
            joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
        else:
            pair = ids[:-1] * (len(self.vocab) + 1) + ids[1:]
            at = np.searchsorted(self.pairs, pair)
            joined = (ids[:-1] >= 0) & (ids[1:] >= 0) & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair)
        ends = words.offsets[1:-1]
        joined[ends[(ends > 0) & (ends < len(ids))] - 1] = False
        breaks = np.flatnonzero(~joined) + 1
        begins = np.concatenate([[0], breaks])
        stops = np.concatenate([breaks, [len(ids)]])
        long = stops - begins >= self.shortest
        begins, stops = begins[long], stops[long]
        owner = np.searchsorted(words.offsets, begins, side="right") - 1
        for b, e, k in zip(begins.tolist(), stops.tolist(), owner.tolist()):
            hits, items = self.run(ids[b:e].tolist())
            if hits:
                d = b - int(words.offsets[k])
                have = out.setdefault(k, ([], set()))
                have[0].extend((x + d, y + d) for x, y in hits)
                have[1].update(items)
        return words.counts, out


def automata(items: DataFrame, window: int = WINDOW, limit: int = AUTOMATON_CHARS) -> Iterator[tuple[Automaton, bool]]:
    """(automaton, whether it is the last) for each part of the items of about ``limit`` characters, by their
    measured size; each is read and built when it is asked for."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // limit))
    cell = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return ((Automaton([(r[0], r[1]) for r in items.filter(cell == k).collect()], window), k + 1 == parts) for k in range(parts))


SPANS = "array<struct<start:bigint,end:bigint>>"


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = AUTOMATON_CHARS, then=None) -> DataFrame:
    """The rows of ``docs`` with n_words, spans (of hit words, merged) and item_ids. ``then``: a function of
    these rows' batches and the schema that it gives, run in the same tasks.

    Each part of a large item table is one more pass, which adds to both."""
    base = [f for f in docs.schema.fields if f.name not in ("n_words", "spans", "item_ids")]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in base])
    schema = T.StructType([*base, T.StructField("n_words", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("item_ids", T.ArrayType(T.StringType()))])
    spark = docs.sparkSession
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    parts, held = automata(items, window, limit), None
    for automaton, last in parts:
        first = held is None
        if not first:  # the pass before ends, and its part goes
            docs = materialise(docs, "decontaminate")
            held.destroy()
        held = spark.sparkContext.broadcast(automaton)
        del automaton

        def step(batches, held=held, first=first):
            for rows, texts in row_chunks(batches):
                n, found = held.value.find(texts)
                spans, ids = [[] for _ in texts], [[] for _ in texts]
                if not first:
                    spans = [[(x["start"], x["end"]) for x in s] for s in rows.column("spans").to_pylist()]
                    ids = rows.column("item_ids").to_pylist()
                    rows = rows.select([c for c in rows.schema.names if c not in ("n_words", "spans", "item_ids")])
                for at, (hits, got) in found.items():
                    merged = []
                    for b, e in sorted([*spans[at], *hits]):
                        if merged and b <= merged[-1][1]:
                            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
                        else:
                            merged.append((b, e))
                    spans[at], ids[at] = merged, sorted({*ids[at], *got})
                rows = rows.append_column("n_words", pa.array(n, pa.int64()))
                rows = rows.append_column("spans", pa.array([[{"start": b, "end": e} for b, e in s] for s in spans], span_type))
                yield rows.append_column("item_ids", pa.array(ids, pa.list_(pa.string())))

        if last and then:
            return docs.mapInArrow(lambda batches, step=step: then[0](step(batches)), then[1])
        docs = docs.mapInArrow(step, schema)
    return docs


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    found = find(id_and_text(docs), items, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage_limit: float = COVERAGE_LIMIT) -> DataFrame:
    """``docs`` without the hit spans; documents hit beyond the limit are dropped. n_chars, if
    there, follows the text. Clean documents stay as they are."""
    # Other columns pass through under names of their own, whatever the work columns are called.
    names = [c if c in ("doc_id", "text") else f"__c{k}" for k, c in enumerate(docs.columns)]
    chars = names[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    work = docs.toDF(*names)

    def cut(batches):
        for rows, texts in row_chunks(batches):
            spans = rows.column("spans").to_pylist()
            if any(spans):
                n, keep, out = rows.column("n_words").to_pylist(), [], []
                for text, hit, total in zip(texts, spans, n):
                    keep.append(sum(x["end"] - x["start"] for x in hit) <= coverage_limit * total)
                    if hit and keep[-1]:
                        at = [m.span() for m in WORD_RE.finditer(text)]
                        for x in reversed(hit):
                            text = text[:at[x["start"]][0]] + text[at[x["end"] - 1][1]:]
                    out.append(text)
                held = rows.column("text").is_null().to_pylist()
                rows = replace_column(rows, "text", [None if h else t for h, t in zip(held, out)])
                if chars:
                    was = rows.column(chars).to_pylist()
                    rows = replace_column(rows, chars, [len(t) if s else c for t, s, c in zip(out, spans, was)])
                rows = rows.filter(pa.array(keep))
            yield rows.select(names)

    return find(work, items, window, then=(cut, work.schema)).toDF(*docs.columns)
