import hashlib
import itertools
import random
import re
import zlib

import pytest

from tillroll.llm import conversation_repair as C

BARE = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """First fault of each (role, text) of a conversation, in order."""
    out, seen = [], set()
    for role, text in rows:
        said = BARE.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """(cost, audit, repaired) by a table over (rows used, turns put out) that keeps whole repairs: every
    choice of edits of rows, any insertions, the pattern checked at the end."""
    kind = faults(rows)
    best = {(): (0, "")}  # role initials put out -> (cost, audit), for the rows used so far
    most = 2 * len(rows) + 2
    fits = lambda done: re.fullmatch(r"s?(ua)*u?", "".join(done))

    def inserted(table):
        todo = list(table.items())
        while todo:
            done, (cost, audit) = todo.pop()
            if len(done) < most:
                for x in "ua":
                    new = (cost + 2, audit + "I")
                    if fits(done + (x,)) and new < table.get(done + (x,), (1 << 60, "")):
                        table[done + (x,)] = new
                        todo.append((done + (x,), new))
        return table

    best = inserted(best)
    for (role, _), fault in zip(rows, kind):
        after = {}

        def offer(done, weight):
            if fits(done) and weight < after.get(done, (1 << 60, "")):
                after[done] = weight

        late = int(fault == "truncated")
        for done, (cost, audit) in best.items():
            offer(done, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                if role:
                    offer(done + (role[0],), (cost + late, audit + "K"))
                for x in "ua":
                    offer(done + (x,), (cost + 2 + late, audit + "R"))
        best = inserted(after)
    (cost, audit), done = min((w, d) for d, w in best.items() if re.fullmatch(r"(s?(ua)+)?", "".join(d)))
    out, at = [], 0
    for letter in audit:
        x = {"u": "user", "a": "assistant", "s": "s"}[done[len(out)]] if letter != "D" else None
        if letter == "I":
            out.append((x, ""))
            continue
        role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((role if letter == "K" else x, text))
    assert at == len(rows)
    return cost, audit, out


def brute_report(table):
    """The contract by hand, for rows (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            rows += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {t for t, *_ in rows if t is not None}
        said = [r[1:] for r in rows]
        kind = faults(said)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
        cost, audit, fixed = brute_repair(said)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, kind.count("blank"), kind.count("duplicate"),
                    kind.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_whole_equals_every_choice(n):
    """All signatures of n rows, against trying all edit strings in order of cost and spelling."""
    kinds = [(i, f, 1) for i in ("s", "u", "a", "x", "") for f in ".tbd"]
    for sig in itertools.product(kinds, repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product(kinds, repeat=3)), 400):
        best = None
        for size in range(n, n + 4):
            for audit in map("".join, itertools.product("DIKR", repeat=size)):
                if sum(c != "I" for c in audit) != n:
                    continue
                cost, made, rows = 0, [], iter(sig)
                for c in audit:
                    i, f, _ = next(rows) if c != "I" else ("", ".", 1)
                    if f in "bd" and c != "D":
                        break
                    cost += {"K": 0, "R": 2, "D": 3, "I": 2}[c] + (f == "t" and c in "KR")
                    made += [] if c == "D" else [i or "-"] if c == "K" else ["ua"]
                else:
                    if (best is None or (cost, audit) < best) and any(
                            re.fullmatch("(s?(ua)+)?", "".join(m)) for m in itertools.product(*made)):
                        best = cost, audit
        assert C.whole(sig) == best, sig


def test_blocks_join_to_the_whole():
    r = random.Random(4)
    for _ in range(300):
        sig = tuple((r.choice(["s", "u", "u", "a", "a", "", "x"]), r.choice("...tbd"), 1) for _ in range(r.randint(1, 14)))
        cuts = sorted(r.sample(range(1, len(sig)), min(len(sig) - 1, r.randint(0, 4))))
        parts = [sig[i:j] for i, j in zip([0, *cuts], [*cuts, len(sig)])]
        cost, path = C.join_blocks([C.spans(p) for p in parts])
        assert (cost, "".join(a for _, a in path)) == C.whole(sig)


def table(seed, n):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "half", " \t", "", "What?", "Deux  mots. \n", "日本", None, "Yes.", "a.b", "…"]
    out = []
    for conv in [*range(n), None]:
        for turn in range(r.randint(1, 9)):
            role = r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            out += [(conv, r.choice([turn, turn, turn, turn * 3, None]), role, r.choice(texts))] * r.choice([1, 1, 1, 1, 3])
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_report_equals_brute_force(spark, block):
    rows = table(block, 120)
    df = spark.createDataFrame([(t, c, r, x, "z", 7) for c, t, r, x in rows], "turn long, conv_id long, role string, text string, audit string, copies int")
    got = C.report(df, block)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_report(rows)
    assert C.report(df.limit(0)).count() == 0


def test_messages_are_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "user", "Again?"), (2, 0, "tool", "x"), (3, 0, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    fixed = C.Repair(C.plain_rows(df)).messages()
    got = {}
    for r in fixed.orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {1: [("system", "Be kind."), ("user", "Hi!"), ("assistant", "Again?")]}


def test_one_conversation_over_many_blocks_and_tasks(spark):
    r = random.Random(9)
    rows = [(5, k, ["user", "assistant"][k % 2], f"turn {k}" + r.choice([".", "!", ""])) for k in range(3000)]
    rows += [(5, 4000, "user", "same.")] * 2000 + [(c, k, "user", "ok.") for c in range(40) for k in range(2) if c != 5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plan = C.Repair(C.plain_rows(df), 16)
    sizes = plan.blocks.filter("conv_id = 5").groupBy("part").count().collect()
    assert len(sizes) > 1 and sum(x["count"] for x in sizes) > 180
    got = plan.report(df).filter("conv_id = 5").first()
    said = [(a, b) for _, _, a, b in sorted(rows[:3000], key=lambda x: x[1])] + [("user", "same.")] * 2000
    sig = tuple((a[0], "t" if b[-1] not in ".!" else ".", 1) for a, b in said[:3001]) + (("u", "d", 1999),)
    assert (got.cost, got.audit) == C.whole(sig) and got.duplicate == 1999 and got.illegal == 1999
    assert got.gaps == 4001 - 3001
