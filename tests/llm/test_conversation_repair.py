"""Conversation repair against plain enumeration, in one run and in many."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import product

import pytest
from texts import CLASHING

from tidemark.llm.conversation_repair import Audits, audit_table, classified, cheapest_audits, repair, run_audits

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = "\x20\t\n\x0b\x0c\r"


def faults(rows):
    """Rows of one conversation, in order: (role, text, fault)."""
    known = [("" if t is None else t, t is not None, r or (" " if r is None else ""), " " if x is None else x) for t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
    order = sorted(known, key=lambda k: (k[1], k[0] if k[1] else 0, k[2], digest(k[2], k[3])))
    seen, out = set(), []
    for _, _, role, text in order:
        left = text.strip(SPACE)
        fault = 2 if not left else 3 if (role, text) in seen else 1 if left[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, lines) by carrying the best strings through all rows."""

    def insertions(best):
        for role, states in (("user", (0, 1, 3)), ("assistant", (2,))):
            to = 2 if role == "user" else 3
            for s in states:
                if s in best:
                    c, a, o = best[s]
                    found = (c + 5, a + "I", o + [f"{role}:"])
                    best[to] = min(best.get(to, found), found)
        return best

    best = insertions({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}

        def offer(to, found):
            after[to] = min(after.get(to, found), found)

        for s, (c, a, o) in best.items():
            offer(s, (c + 2, a + "D", o))
            if fault < 2:
                extra = 5 * (fault == 1)
                to = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
                if to is not None:
                    offer(to, (c + extra, a + "K", o + [f"{role}:{text}"]))
                new = "assistant" if s == 2 else "user"
                offer(3 if s == 2 else 2, (c + extra + 1, a + "R", o + [f"{new}:{text}"]))
        best = insertions(after)
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows, every=()):
    groups = defaultdict(list)
    for conv, *rest in rows:
        groups[conv].append(tuple(rest))
    out = []
    for conv in {*groups, *every}:
        mine = faults(groups.get(conv, []))
        turns = [t for t, _, _ in groups.get(conv, []) if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == k for _, _, f in mine) for k in (2, 3, 1)]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest(mine)
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward():
    r = random.Random(4)
    texts = ["Yes.", "No!", "cut off", "", None, " \n", "Why? \t", "été 日本語.", "long " * 9000 + "end."]
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."), (2, 5, "user", "alone.")]
    rows += [(3, None, None, None), (4, 1, "system", "s."), (4, 2, "system", "t."), (None, 1, "user", "q?"), (None, 2, "assistant", "a.")]
    rows += [(5, 1, "user", "same."), (5, 1, "user", "same."), (5, 1, "user", "same."), (5, 1, "assistant", "tie."), (5, None, "tool", "x.")]
    for conv in range(10, 60):
        for _ in range(r.randrange(1, 9)):
            rows.append((conv, r.choice([None, *range(9)]), r.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), r.choice(texts)))
    for turn in range(700):  # one conversation of many runs
        rows.append((99, turn // 2, r.choice(["user", "assistant", "system"]), r.choice(["Go on.", "and", f"t{turn}.", f"u{turn}"])))
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("run_rows", [4096, 3])
@pytest.mark.parametrize("clash", [False, True])
def test_audit_table(spark, run_rows, clash):
    df = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in (*CLASHING, "fault", "key", "n", "first", "audit", "cost", "part")})
    gone = spark.createDataFrame([(1000, 1, "user", "dropped.")], SCHEMA)
    got = rows_of(audit_table(df.select("conv_id").union(gone.select("conv_id")), df, run_rows))
    assert got == brute(awkward(), every=[1000])


def test_lines_are_the_digested_ones(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    audits, lines = repair(df)
    by = defaultdict(list)
    for r in sorted(lines.collect(), key=lambda r: r.line):
        by[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, lines in by.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in by.items()}.items() <= {r[0]: r[-1] for r in brute(awkward())}.items()
    assert audits.count() == len({r[0] for r in awkward()})


def test_no_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert audit_table(nothing, nothing).count() == 0
    one = spark.createDataFrame([(7, 1, "user", "x")], SCHEMA)
    assert rows_of(audit_table(one, nothing)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_other_keys(spark):
    df = spark.createDataFrame([("a", 1, "user", "x."), ("a", 2, "user", "y."), (None, 1, "system", "z.")], SCHEMA.replace("conv_id long", "conv_id string"))
    assert [r[:8] for r in rows_of(audit_table(df, df))] == [("a", 0, 0, 0, 0, 1, 1, "KR"), (None, 0, 0, 0, 0, 0, 2, "D")]


def test_a_conversation_in_many_partitions(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"turn {t}." if t % 5 else f"turn {t}") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = cheapest_audits(classified(df), run_rows=100).collect()
        assert rows_of(audit_table(df, df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [(r.cost, r.audit) for r in found] == [cheapest(faults([r[1:] for r in rows]))[:2]]


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7, 2])
def test_comparison_of_audits_survives_collisions(modulus):
    audits, r = Audits(modulus=modulus), random.Random(2)
    nodes = {0: ""}
    for _ in range(400):
        parent, letter, run = r.choice(list(nodes)), r.choice("DK"), r.choice([1, 1, 1, 2, 5])
        nodes[audits.add(parent, letter, run)] = nodes[parent] + letter * run
    for a, b in product(r.sample(list(nodes), 60), repeat=2):
        assert audits.less(a, b) == (nodes[a] < nodes[b])
        n = audits.common(a, b)
        assert nodes[a][:n] == nodes[b][:n] and audits.spelled(a) == nodes[a]


def test_small_cases_by_every_sequence_of_edits():
    """Every audit of up to three rows and three insertions, none left out."""

    def every(rows, i=0, state=0):
        if i == len(rows) and state in (0, 3):
            yield 0, ""
        role, fault = rows[i] if i < len(rows) else (None, None)
        moves = [(5, "I", 3 if state == 2 else 2, i)]
        if role:
            moves.append((2, "D", state, i + 1))
            if fault < 2:
                extra = 5 * fault
                moves.append((1 + extra, "R", 3 if state == 2 else 2, i + 1))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role, state))
                if to:
                    moves.append((extra, "K", to, i + 1))
        for cost, letter, to, j in moves:
            if letter == "I" and depth[0] >= 3:
                continue
            depth[0] += letter == "I"
            for c, a in every(rows, j, to):
                yield cost + c, letter + a
            depth[0] -= letter == "I"

    depth = [0]
    for rows in product([("s", 0), ("u", 0), ("u", 1), ("a", 0), ("a", 2), ("t", 0)], repeat=3):
        audits = Audits()
        best = run_audits([(r, f, 1) for r, f in rows], 0, audits)
        got = min((c, audits.spelled(n)) for s, (c, n) in best.items() if s in (0, 3))
        assert got == min(every(list(rows)))
