"""Personal data by patterns, and terms that disclose it by corpus statistics.

Patterns find the base spans (e-mail, IP, card, phone). Each value found is a
protected entity. All terms (runs of letters and digits, of any length) of the
documents that hold an entity are counted with it over the corpus;
from document frequencies, PMI(entity, term) = log(N n(e, t) / (n(e) n(t))) is the
information the term gives about the entity, and log(N / n(e)) is all there is.
A term that gives ``DISCLOSE`` of it or more, in ``SUPPORT`` documents at least,
is generalised in every document that holds the entity; from ``REMOVE`` on it
is removed.

Document frequencies cover every term of every document, by the same function
as the joint counts; terms are shuffled as 64-bit hashes after adding up within
each task's chunks. Only what can't reach the threshold is left out of the joint
counts: entities in fewer documents than the support, and terms so common that
even in all of an entity's documents they would give less.

Cases: a null or empty text has no spans; documents without base spans get no
term spans; repeated rows count each time; null ids are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, materialise, row_chunks, table_batch

KINDS = ("email", "ip", "card", "phone")
DISCLOSE, REMOVE, SUPPORT = 0.8, 0.95, 2
#: Terms in more than this share of the documents have their frequencies sent to all tasks (as many terms as a
#: document has on average, divided by it, at most); pairs that a task counts before it passes them on.
COMMON, PAIRS = 0.001, 1_000_000
#: The patterns, written so that a long run of their characters is read once: starts inside a
#: run that has failed would fail alike.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+$")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    if "@" in text:
        last, at = 0, 0
        while m := DOMAIN.search(text, at):
            start = m.start()
            while start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                last = at = m.end()
            else:
                at = m.start() + 1
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _hash(word: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word.encode()) - (1 << 63)


def _terms(text: str, spans: list) -> list[tuple[str, int, int]]:
    """Words outside the base spans: (lower-cased, start, end)."""
    taken = sorted((b, e) for _, b, e in spans)
    out, k = [], 0
    for m in TERM.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if not any(b < m.end() and e > m.start() for b, e in taken[k:k + 4]):
            out.append((m[0].lower(), m.start(), m.end()))
    return out


def _entity(kind: str, value: str) -> int:
    return _hash(f"{kind} " + (value.lower() if kind == "email" else re.sub("[^0-9.]", "", value)))


def _distinct(text: str, spans: list) -> set[str]:
    """The distinct terms of a document: what document frequencies and joint counts both count."""
    return {w.lower() for w in set(TERM.findall(text))} if not spans else {t[0] for t in _terms(text, spans)}


SEEN = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("spans", pa.string()), ("text", pa.string()),
                  ("entities", pa.list_(pa.int64())),
                  ("terms", pa.list_(pa.int64())), ("dfs", pa.list_(pa.int64()))])
SEEN_SQL = "row bigint, doc_id bigint, spans string, text string, entities array<bigint>, terms array<bigint>, dfs array<bigint>"


def _scan(batches):
    """A row for each document; the first of a chunk also holds the chunk's document frequencies."""
    from pyspark import TaskContext
    n = TaskContext.get().partitionId() << 33
    for rows, texts in row_chunks(batches):
        spans = [base_spans(t) for t in texts]
        df = Counter()
        for t, x in zip(texts, spans):
            df.update(_distinct(t, x))
        first = [None] * (len(texts) - 1)
        yield table_batch({
            "row": np.arange(n, n + len(texts)), "doc_id": rows.column("doc_id"),
            "spans": [",".join(f"{k}:{b}:{e}" for k, b, e in s) for s in spans],
            "text": [t if s else None for t, s in zip(texts, spans)], "entities": [list({_entity(k, t[b:e]) for k, b, e in s}) for t, s in zip(texts, spans)],
            "terms": [list(map(_hash, df)), *first], "dfs": [list(df.values()), *first]}, SEEN)
        n += len(texts)


PAIR = pa.schema([("e", pa.int64()), ("t", pa.int64()), ("n", pa.int64())])


def _pairs(total: int, disclose: float, common: np.ndarray, frequency: np.ndarray):
    """(e, t, n) of each chunk's documents. ``common``: sorted hashes of common terms, with ``frequency``."""
    def counted(es, ts):
        e, t = np.concatenate(es), np.concatenate(ts)
        order = np.lexsort((t, e))
        e, t = e[order], t[order]
        first = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]) | (t[1:] != t[:-1])]))
        return table_batch({"e": e[first], "t": t[first], "n": np.diff(first, append=len(e))}, PAIR)

    def step(batches):
        for rows, texts in row_chunks(batches):
            es, ts, size = [], [], 0
            for text, base, held in zip(texts, rows.column("spans").to_pylist(), rows.column("held").to_pylist()):
                spans = [(kind, int(i), int(j)) for kind, i, j in (x.split(":") for x in base.split(","))]
                terms = np.array([_hash(w) for w in _distinct(text, spans)], np.int64)
                at = np.minimum(np.searchsorted(common, terms), max(0, len(common) - 1))
                nt = np.where(common[at] == terms, frequency[at], 0) if len(common) else np.zeros(len(terms), np.int64)
                for x in held:
                    # Reaching the threshold takes n / nt >= (N / ne) ** (disclose - 1), and n is ne at most.
                    own = terms[nt <= x["ne"] * (total / x["ne"]) ** (1 - disclose) * (1 + 1e-9)]
                    es.append(np.full(len(own), x["e"], np.int64))
                    ts.append(own)
                    size += len(own)
                    if size > PAIRS:
                        yield counted(es, ts)
                        es, ts, size = [], [], 0
            if size:
                yield counted(es, ts)
    return step


def disclosures(seen: DataFrame, disclose: float = DISCLOSE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """(e, t, removed): terms that disclose entities, from the scan's counts."""
    total = seen.count()
    of_entity = seen.select(F.explode("entities").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("ne")).filter(F.col("ne") >= support)
    of_term = materialise(seen.filter("terms is not null").select(F.explode(F.arrays_zip("terms", "dfs")).alias("x"))
                          .select(F.col("x.terms").alias("t"), F.col("x.dfs").alias("df")).groupBy("t").agg(F.sum("df").alias("nt"))
                          .filter(F.col("nt") >= support), "pii-terms")
    known = of_term.filter(F.col("nt") > COMMON * total).toArrow()
    common, frequency = known.column("t").to_numpy(), known.column("nt").to_numpy()
    order = np.argsort(common)
    held = seen.select("row", F.explode("entities").alias("e")).join(of_entity, "e").groupBy("row").agg(F.collect_list(F.struct("e", "ne")).alias("held"))
    joint = seen.filter("spans <> ''").select("row", "spans", "text").join(held, "row").select("spans", "text", "held") \
        .mapInArrow(_pairs(total, disclose, common[order], frequency[order]), "e bigint, t bigint, n bigint") \
        .groupBy("e", "t").agg(F.sum("n").alias("n")).filter(F.col("n") >= support)
    x = joint.join(of_entity, "e").join(of_term, "t")
    pmi = F.log(F.lit(float(max(1, total))) * F.col("n") / (F.col("ne") * F.col("nt")))
    share = F.when(F.col("ne") >= total, F.lit(0.0)).otherwise(pmi / F.log(F.lit(float(max(1, total))) / F.col("ne")))
    return x.withColumn("share", share).filter(F.col("share") >= disclose).select("e", "t", (F.col("share") >= remove).alias("removed"))


def _mark(batches):
    for b in batches:
        spans = b.column("spans").to_pylist()
        for k, (text, terms) in enumerate(zip(b.column("text").to_pylist(), b.column("terms").to_pylist())):
            kinds = {x["t"]: "removed" if x["removed"] else "general" for x in terms or []}
            if kinds:
                base = [(kind, int(i), int(j)) for kind, i, j in (s.split(":") for s in spans[k].split(","))]
                found = [(kinds[_hash(w)], i, j) for w, i, j in _terms(text, base) if _hash(w) in kinds]
                spans[k] = ",".join([spans[k], *(f"{x}:{i}:{j}" for x, i, j in sorted(found))])
        yield b.select(["doc_id", "base", "text"]).append_column("spans", pa.array(spans, pa.string()))


def find(docs: DataFrame, disclose: float = DISCLOSE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """doc_id, base and spans (kind:start:end, by kind as listed with general and removed last) of
    every document; text too, of those with base spans."""
    seen = materialise(id_and_text(docs).mapInArrow(_scan, SEEN_SQL), "pii-scan")
    rows = seen.select("row", "doc_id", F.col("spans").alias("base"), "text", "entities")
    per_row = rows.select("row", F.explode("entities").alias("e")).join(disclosures(seen, disclose, remove, support), "e") \
        .groupBy("row", "t").agg(F.max("removed").alias("removed")).groupBy("row").agg(F.collect_list(F.struct("t", "removed")).alias("terms"))
    with_data = rows.filter("base <> ''").drop("entities").join(per_row, "row", "left").select(
        "doc_id", "base", "text", F.col("base").alias("spans"), "terms")
    marked = with_data.mapInArrow(_mark, "doc_id bigint, base string, text string, spans string")
    return marked.union(rows.filter("base = ''").select("doc_id", "base", "text", F.col("base").alias("spans")))


def sanitise(text: str, spans: str) -> str:
    """The text with base values named by kind, general terms as [TERM], removed terms gone."""
    for kind, i, j in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)), key=lambda x: -x[1]):
        text = text[:i] + ("" if kind == "removed" else "[TERM]" if kind == "general" else f"[{kind.upper()}]") + text[j:]
    return text


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = find(docs)
    def count(kind: str):
        return F.size(F.filter(F.split("base", ","), lambda s: s.startswith(f"{kind}:"))).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
