"""Conversation repair: the cheapest edits to alternating turns, by Knuth's lightest derivations.

A conversation should read ``(system)? (user assistant)+``, or be empty. Its rows,
by turn, are kept (0), re-roled to user or assistant (2) or deleted (3; what is
blank or repeats an earlier row must be), empty user or assistant turns are
inserted (2), and a truncated row that stays adds 1.

Items of the deduction are (rows consumed, state of the role grammar). Every edit
is a hyperedge whose function adds its cost and appends its letter to the audit; in
the order of (cost, audit) these functions are monotone and superior (audits of
equal cost over the same rows are never prefixes of each other, as a longer one
holds costly insertions), so items popped from the agenda are final, the first
time the goal is popped it is the cheapest repair with the ASCII-least audit.

A conversation may hold any share of all rows. Rows are sorted across tasks by
(conversation, turn), cut into blocks of at most BLOCK rows, and a block that may
not be its whole conversation gives the lightest span from each state to each
state; spans of neighbouring blocks are the second antecedents of the deduction
that joins them, and hold letters, no texts. Texts stay in their blocks, which are
read in order once the audit is known; a task holds one block of them at a time.

Cases: a null role or text is one space; null turns come first, rows of one turn go
by role, then by the SHA-256 of their texts; equal rows of one conversation and turn
follow each other; a null conversation id is a conversation; a role other than
s..., u..., a... can't be kept; an empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialise, sql_partitions, table_batch

BLOCK, BLOCK_BYTES = 256, 1 << 20
SPACE = " \t\n\v\f\r"
#: (state, role initial) -> state. 0: nothing yet, 1: system, 2: user, 3: assistant.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
GOAL = 4
#: The role that the grammar wants next, of those that may be given.
WANTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
LEGAL = {"su", "ua", "au"}
#: Repaired signatures that a Python worker keeps.
MEMO = 1 << 15

Weight = tuple[int, str]


# ---------------------------------------------------------------- deduction
def lightest(axioms: dict[Hashable, Weight], deduce: Callable[[Hashable], Iterable[tuple[Hashable, int, str]]],
             goal: Hashable = None) -> dict[Hashable, Weight]:
    """Items with their lightest (cost, audit), up to the goal if one is given. ``deduce`` gives the
    hyperedges that an item completes: (head, cost, letters)."""
    agenda = [(cost, audit, item) for item, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: dict[Hashable, Weight] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item == goal:
            break
        for head, more, letters in deduce(item):
            if head not in final:
                heapq.heappush(agenda, (cost + more, audit + letters, head))
    return final


def edits(initial: str, fault: str, n: int) -> list[tuple[str, int, str | None]]:
    """(letters, cost, initial given) of the edits of one signature element."""
    if fault in "bd":
        return [("D" * n, 3 * n, None)]
    late = int(fault == "t")
    return [*([("K", late, initial)] if initial in ("s", "u", "a") else []), ("R", 2 + late, "u"), ("R", 2 + late, "a"), ("D", 3, None)]


Signature = tuple[tuple[str, str, int], ...]


def rules(signature: Signature, goal: bool):
    """Hyperedges over (rows consumed, state)."""
    table = [edits(*e) for e in signature]

    def deduce(item):
        k, state = item
        for given in "ua":
            if (state, given) in STEP:
                yield (k, STEP[state, given]), 2, "I"
        if k < len(table):
            for letters, cost, given in table[k]:
                if given is None:
                    yield (k + 1, state), cost, letters
                elif (state, given) in STEP:
                    yield (k + 1, STEP[state, given]), cost, letters
        elif goal and state in ACCEPT:
            yield (k, GOAL), 0, ""

    return deduce


@lru_cache(MEMO)
def whole(signature: Signature) -> Weight:
    """The lightest repair of a whole conversation."""
    goal = (len(signature), GOAL)
    return lightest({(0, 0): (0, "")}, rules(signature, True), goal)[goal]


@lru_cache(MEMO >> 4)
def spans(signature: Signature) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a block."""
    out = []
    for p in range(4):
        got = lightest({(0, p): (0, "")}, rules(signature, False))
        out += [(p, q, *got[len(signature), q]) for q in range(4) if (len(signature), q) in got]
    return out


def join_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """(cost, [(state before, audit) of each block]) of the lightest repair of a conversation in blocks."""
    by_state = [{p: [s for s in b if s[0] == p] for p in range(4)} for b in blocks]

    def deduce(item):
        k, state = item
        if k < len(blocks):
            for _, q, cost, audit in by_state[k][state]:
                yield (k + 1, q), cost, audit
        elif state in ACCEPT:
            yield (k, GOAL), 0, ""

    goal = (len(blocks), GOAL)
    final = lightest({(0, 0): (0, "")}, deduce, goal)
    cost, audit = final[goal]
    # Read the path off the final items, last block first.
    path, state, end = [], next(q for q in ACCEPT if final.get((len(blocks), q)) == (cost, audit)), audit
    left = cost
    for k in range(len(blocks) - 1, -1, -1):
        p, w, letters = next((p, w, a) for p, q, w, a in blocks[k] if q == state and end.endswith(a)
                             and final.get((k, p)) == (left - w, end[:len(end) - len(a)]))
        path.append((p, letters))
        state, left, end = p, left - w, end[:len(end) - len(letters)]
    return cost, path[::-1]


def lines(signature: Signature, rows: list[tuple[str, str]], state: int, audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired turns of a block."""
    at, left = 0, [n for _, _, n in signature]
    for letter in audit:
        if letter == "I":
            role, text = WANTED[state], ""
        else:
            role, text = rows[at]
            role = WANTED[state] if letter == "R" else role
            left[at] -= 1
            at += not left[at]
        if letter != "D":
            state = STEP[state, role[0]]
            yield role, text


# -------------------------------------------------------------------- blocks
def element(role: str, text: str, copies: int, seen: bool) -> list[tuple[str, str, int]]:
    """A row and its equal followers as signature elements (initial, fault, rows); '.': no fault."""
    bare = text.rstrip(SPACE)
    if not bare:
        return [(role[:1], "b", copies)]
    if seen:
        return [(role[:1], "d", copies)]
    first = (role[:1], "." if bare[-1] in ".!?" else "t", 1)
    return [first] if copies == 1 else [first, (role[:1], "d", copies - 1)]


BLOCKS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("alone", pa.bool_()),
                    ("initials", pa.list_(pa.string())), ("faults", pa.string()), ("copies", pa.list_(pa.int64())),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                    *((c, pa.list_(pa.int64())) for c in ("before", "after", "costs")), ("audits", pa.list_(pa.string()))])
BLOCKS_SQL = ("conv_id bigint, part bigint, seq bigint, alone boolean, initials array<string>, faults string, copies array<bigint>, "
              "roles array<string>, texts array<string>, before array<bigint>, after array<bigint>, costs array<bigint>, audits array<string>")


def flush_at(rows: Iterator[dict], schema: pa.Schema, limit: int, size: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    """Record batches of rows that hold about ``limit`` bytes each."""
    held, used = [], 0
    for r in rows:
        held.append(r)
        used += size(r)
        if used > limit:
            yield table_batch({c: [h[c] for h in held] for c in schema.names}, schema)
            held, used = [], 0
    if held:
        yield table_batch({c: [h[c] for h in held] for c in schema.names}, schema)


def block_rows(part: int, rows: Iterator[tuple[int | None, str, str, int, bool]], most: int = BLOCK) -> Iterator[dict]:
    """The blocks of one task's sorted rows. A block is alone if its conversation has surely no other."""
    seq, first, conv, sig, held, size, pieces = 0, True, None, [], [], 0, 0

    def block(ended: bool):
        nonlocal seq
        alone = ended and not first and not pieces
        found = [(0, GOAL, *whole(tuple(sig)))] if alone else spans(tuple(sig))
        before, after, costs, audits = zip(*found)
        out = {"conv_id": conv, "part": part, "seq": seq, "alone": alone, "initials": [e[0] for e in sig],
               "faults": "".join(e[1] for e in sig), "copies": [e[2] for e in sig], "roles": [r for r, _ in held],
               "texts": [t for _, t in held], "before": before, "after": after, "costs": costs, "audits": audits}
        seq += 1
        return out

    for i, role, text, copies, seen in rows:
        if sig and (i != conv or len(sig) >= most or size > BLOCK_BYTES):
            yield block(i != conv)
            pieces = pieces + 1 if i == conv else 0
            first = first and i == conv
            sig, held, size = [], [], 0
        conv = i
        for e in element(role, text, copies, seen):
            sig.append(e)
            held.append((role, text if e[1] in ".t" else ""))  # texts that go are not kept
        size += len(text)
    if sig:
        yield block(False)


def blocks(rows: DataFrame, most: int = BLOCK) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) in blocks of about ``most`` rows, written to the shared folder."""
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")) \
        .withColumn("digest", F.sha2("text", 256))
    # Texts of a role that occur at several turns: all but the first are duplicates.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = equal.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")) \
        .agg(F.min(place).alias("start"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
    marked = equal.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    marked = marked.select("conv_id", "turn", "role", "text", "copies", "digest",
                           F.coalesce(~F.col("turn").eqNullSafe(F.col("start.turn")) & F.col("start").isNotNull(), F.lit(False)).alias("seen"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    ordered = marked.repartitionByRange(sql_partitions(rows.sparkSession), *order).sortWithinPartitions(*order) \
        .select("conv_id", "role", "text", "copies", "seen")

    def step(batches):
        from pyspark import TaskContext

        def each():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "seen")))

        yield from flush_at(block_rows(TaskContext.get().partitionId(), each(), most), BLOCKS, BLOCK_BYTES,
                            lambda r: sum(map(len, r["texts"])) + 60 * len(r["texts"]) + sum(map(len, r["audits"])))

    return materialise(ordered.mapInArrow(step, BLOCKS_SQL), "conversation-blocks")


def by_conversation(batches: Iterable[pa.RecordBatch]) -> Iterator[Iterator[dict]]:
    """The rows of each conversation of sorted batches, to be read one after the other."""
    from itertools import groupby
    rows = ({c: b.column(c)[k].as_py() for c in b.schema.names} for b in batches for k in range(b.num_rows))
    for _, group in groupby(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"])):
        yield group


def decide(cut: DataFrame) -> DataFrame:
    """For each block that isn't alone the state before it and its part of the audit; for each of their
    conversations its cost, and the illegal neighbours on both sides of a cut, at its first block."""
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("state", pa.int64()), ("audit", pa.string()),
                        ("cost", pa.int64()), ("across", pa.int64())])

    def decided(batches):
        for group in by_conversation(batches):
            rows = list(group)
            cost, path = join_blocks([list(zip(r["before"], r["after"], r["costs"], r["audits"])) for r in rows])
            across = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows, rows[1:]))
            for k, (r, (state, audit)) in enumerate(zip(rows, path)):
                yield {"part": r["part"], "seq": r["seq"], "state": state, "audit": audit,
                       "cost": cost if not k else 0, "across": across if not k else 0}

    def step(batches):
        yield from flush_at(decided(batches), schema, BLOCK_BYTES, lambda r: len(r["audit"]) + 50)

    narrow = cut.filter("not alone").select("conv_id", "part", "seq", "before", "after", "costs", "audits",
                        F.element_at("initials", 1).alias("first"), F.element_at("initials", -1).alias("last"))
    return materialise(sorted_blocks(narrow).mapInArrow(
        step, "part bigint, seq bigint, state bigint, audit string, cost bigint, across bigint"), "conversation-audits")


def sorted_blocks(cut: DataFrame) -> DataFrame:
    return cut.repartition(sql_partitions(cut.sparkSession), "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "part", "seq")


def read_in_order(cut: DataFrame, audits: DataFrame, read, schema: str) -> DataFrame:
    """``read`` over blocks with their decisions, the blocks of a conversation in order. A block that is
    alone is read where it lies; only the others' texts are shuffled once more."""
    cut = cut.withColumn("state", F.lit(0).cast("long")).withColumn("audit", F.element_at("audits", 1))
    columns = ["conv_id", "part", "seq", "initials", "faults", "copies", "roles", "texts", "state", "audit"]
    rest = cut.filter("not alone").drop("state", "audit").join(audits.select("part", "seq", "state", "audit"), ["part", "seq"])
    return cut.filter("alone").select(*columns).mapInArrow(read, schema).union(
        sorted_blocks(rest.select(*columns)).mapInArrow(read, schema))


def turns_of(row: dict) -> Iterator[tuple[str, str]]:
    signature = tuple(zip(row["initials"], row["faults"], row["copies"]))
    return lines(signature, list(zip(row["roles"], row["texts"])), row["state"], row["audit"])


# ----------------------------------------------------------------- operators
def plain_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies; a null role or text is one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(1).cast("long").alias("copies"))


class Repair:
    """The repair of rows (conv_id, turn, role, text, copies): ``messages`` and ``report``."""

    def __init__(self, rows: DataFrame, block: int = BLOCK):
        self.rows = rows
        self.blocks = blocks(rows, block)
        self.audits = decide(self.blocks)

    def messages(self) -> DataFrame:
        """conv_id, position (from 0), role, text of the repaired turns."""
        schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

        def each(batches):
            for group in by_conversation(batches):
                position = 0
                for row in group:
                    for role, text in turns_of(row):
                        yield {"conv_id": row["conv_id"], "position": position, "role": role, "text": text}
                        position += 1

        def step(batches):
            yield from flush_at(each(batches), schema, BLOCK_BYTES, lambda r: len(r["text"]) + 30)

        return read_in_order(self.blocks, self.audits, step, "conv_id bigint, position bigint, role string, text string")

    def digests(self) -> DataFrame:
        """conv_id, audit, repaired_sha256 of ``role:text`` lines. The digest is fed line by line: by its
        definition one task must read a conversation, but none holds more than a block of it."""
        schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

        def each(batches):
            for group in by_conversation(batches):
                digest, audit, conv, glue = hashlib.sha256(), [], None, ""
                for row in group:
                    conv = row["conv_id"]
                    audit.append(row["audit"])
                    for role, text in turns_of(row):
                        digest.update(f"{glue}{role}:{text}".encode())
                        glue = "\n"
                yield {"conv_id": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        def step(batches):
            yield from flush_at(each(batches), schema, BLOCK_BYTES, lambda r: len(r["audit"]) + 80)

        return read_in_order(self.blocks, self.audits, step, "conv_id bigint, audit string, repaired_sha256 string")

    def report(self, ids: DataFrame) -> DataFrame:
        """One row for each conv_id of ``ids``: gaps, the faults, illegal neighbours, cost, audit and digest."""
        exact = lambda c: F.col(c).cast("decimal(38,0)")
        turns = self.rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
            F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("distinct")).select(
            "conv_id", F.coalesce(exact("high") - exact("low") + 1 - F.col("distinct"), F.lit(0)).cast("long").alias("gaps"))
        # Neighbours within a block; the copies of an element are neighbours of their own kind.
        legal = F.array(*map(F.lit, sorted(LEGAL)))
        pairs = F.zip_with(F.slice("initials", 1, F.size("initials") - 1), F.slice("initials", 2, F.size("initials")), lambda a, b: F.concat(a, b))
        inner = F.size(F.filter(pairs, lambda p: ~F.array_contains(legal, p))) + F.aggregate("copies", F.lit(0).cast("long"), lambda s, n: s + n - 1)
        of = lambda fault: F.sum(F.aggregate(F.filter(F.arrays_zip(
            F.split("faults", "").alias("f"), F.col("copies").alias("n")), lambda e: e["f"] == fault), F.lit(0).cast("long"), lambda s, e: s + e["n"]))
        own_cost = F.when(F.col("alone"), F.element_at("costs", 1)).otherwise(F.coalesce("cost", F.lit(0)))
        counted = self.blocks.select("conv_id", "part", "seq", "alone", "initials", "faults", "copies", "costs").join(
            self.audits.select("part", "seq", "cost", "across"), ["part", "seq"], "left").groupBy("conv_id").agg(
            of("b").alias("blank"), of("d").alias("duplicate"), of("t").alias("truncated"),
            F.sum(inner + F.coalesce("across", F.lit(0))).alias("illegal"), F.sum(own_cost).alias("cost"))
        out = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        for other in (turns, counted, self.digests()):
            out = out.join(other.withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
        empty = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
        empty |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
        return out.select("conv_id", *(F.coalesce(F.col(c).cast("long") if c in list(empty)[:6] else F.col(c), v).alias(c) for c, v in empty.items()))


def damage(rows: DataFrame) -> DataFrame:
    """Faults planted by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its ``.!?`` away, 3 doubles it, 4 makes it a user's. A null id or turn counts as one space there."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    return rows.withColumn("kind", kind).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("copies") * F.when(F.col("kind") == 3, 2).otherwise(1)).alias("copies"))


def report(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Damage, repair and report of every conversation."""
    rows = plain_rows(conversations)
    return Repair(damage(rows), block).report(rows)
