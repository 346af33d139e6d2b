"""Conversations put into the order `(s?(ua)+)?` of role initials by the cheapest edits.

Every row is kept (cost 0), given another role (1) or deleted (2); a turn without text may
be inserted anywhere (5). Blank and repeated rows must be deleted, and a truncated row that
stays costs 5. The audit of a conversation names its edits by their initials; among the
cheapest audits the least in ASCII counts.

Rows are sorted by range, so a long conversation lies in many tasks; each cuts it into runs
of at most `RUN_ROWS` rows and finds, for every state before and after a run, the best audit
of the run. Runs are then put together per conversation. Inside a run audits are linked
nodes that share their prefixes (`Audits`). What a task holds of a conversation is its
audit letters, never its texts; the digest of a conversation's lines is made while they
stream by, for SHA-256 can only be taken in order.

Defined cases. A null role or text counts as one space. Rows follow their turn, nulls first,
then role, then the SHA-256 of role and text; equal rows are counted, not repeated, and all
but the first are duplicates. A null conv_id is a conversation like any other. Very long texts
cross the shuffle but reach Python one batch at a time. No rows give no rows. Other columns,
of whatever name, are not looked at.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import stored

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
FINE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
LEGAL = frozenset(["su", "ua", "au"])
# Rows whose audits are found at once.
RUN_ROWS = 4096
SPACE = r"\x20\x09-\x0D"

Best = dict[int, tuple[int, int]]


class Audits:
    """Audit prefixes as a tree of nodes: each adds a letter, or a run of one letter, to its parent.

    A node keeps its ancestors at powers of two and a rolling hash of all its letters. Two
    audits are compared at the end of their longest common prefix, which is searched for by
    hashes and then confirmed letter by letter back to the node that both share.
    """

    def __init__(self, base: int = 0x1F3D5B79A7C6E4, modulus: int = (1 << 61) - 1):
        self.base, self.modulus = base, modulus
        self.up: list[tuple[int, ...]] = [()]
        self.letter, self.length, self.hash = [""], [0], [0]

    def add(self, parent: int, letter: str, run: int = 1) -> int:
        if not run:
            return parent
        up, at = [parent], 0
        while at < len(self.up[up[-1]]):
            up.append(self.up[up[-1]][at])
            at += 1
        self.up.append(tuple(up))
        self.letter.append(letter)
        self.length.append(self.length[parent] + run)
        self.hash.append(self._longer(self.hash[parent], letter, run))
        return len(self.up) - 1

    def _longer(self, value: int, letter: str, run: int) -> int:
        code, m = ord(letter), self.modulus
        if run == 1:
            return (value * self.base + code) % m
        # base**run and 1 + base + ... + base**(run - 1), by doubling
        power, total, p, t = 1, 0, self.base % m, 1
        while run:
            if run & 1:
                power, total = power * p % m, (total * p + t) % m
            p, t, run = p * p % m, (t * p + t) % m, run >> 1
        return (value * power + code * total) % m

    def _holder(self, node: int, n: int) -> int:
        """The node on the way to `node` that adds the n-th letter."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            while k < len(self.up[node]) and self.length[self.up[node][k]] >= n:
                node = self.up[node][k]
        return node

    def _prefix_hash(self, node: int, n: int) -> int:
        if not n:
            return 0
        node = self._holder(node, n)
        if self.length[node] == n:
            return self.hash[node]
        parent = self.up[node][0]
        return self._longer(self.hash[parent], self.letter[node], n - self.length[parent])

    def common(self, a: int, b: int) -> int:
        """Letters at the start of both."""
        low, high = 0, min(self.length[a], self.length[b])
        while low < high:
            n = (low + high + 1) // 2
            low, high = (n, high) if self._prefix_hash(a, n) == self._prefix_hash(b, n) else (low, n - 1)
        return self._confirmed(a, b, low)

    def _confirmed(self, a: int, b: int, n: int) -> int:
        """n, or the first place before it where the letters differ though the hashes agree."""
        first, end = n, n
        a, b = self._holder(a, n), self._holder(b, n)
        while a != b and end:
            start_a, start_b = self.length[self.up[a][0]], self.length[self.up[b][0]]
            start = max(start_a, start_b)
            if self.letter[a] != self.letter[b]:
                first = start
            a = self.up[a][0] if start == start_a else a
            b = self.up[b][0] if start == start_b else b
            end = start
        return first

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n == min(self.length[a], self.length[b]):
            return self.length[a] < self.length[b]
        return self.letter[self._holder(a, n + 1)] < self.letter[self._holder(b, n + 1)]

    def spelled(self, node: int) -> str:
        out = []
        while node:
            parent = self.up[node][0]
            out.append(self.letter[node] * (self.length[node] - self.length[parent]))
            node = parent
        return "".join(reversed(out))


def _offer(audits: Audits, best: Best, state: int, cost: int, parent: int, letter: str) -> None:
    now = best.get(state)
    if now is None or cost < now[0]:
        best[state] = (cost, audits.add(parent, letter))
    elif cost == now[0]:
        node = audits.add(parent, letter)
        if audits.less(node, now[1]):
            best[state] = (cost, node)


def _inserted(audits: Audits, best: Best) -> Best:
    """Turns put in where a run of edits stands; two at most are of use in one place."""
    for before in (NONE, SYSTEM, ASSISTANT):
        if before in best:
            _offer(audits, best, USER, best[before][0] + INSERT_COST, best[before][1], INSERT)
    if USER in best:
        _offer(audits, best, ASSISTANT, best[USER][0] + INSERT_COST, best[USER][1], INSERT)
    return best


def next_state(state: int, initial: str) -> int | None:
    """The state after a turn of this initial, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return USER if initial == "u" and state != USER else None


def run_audits(rows: list[tuple[str, int, int]], entry: int, audits: Audits) -> Best:
    """Exit state -> (cost, audit) of (initial, fault, copies) rows met in state `entry`."""
    best = _inserted(audits, {entry: (0, 0)})
    for initial, fault, copies in rows:
        if fault in (FINE, TRUNCATED):
            after: Best = {}
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            for state, (cost, node) in best.items():
                _offer(audits, after, state, cost + DELETE_COST, node, DELETE)
                kept = next_state(state, initial)
                if kept is not None:
                    _offer(audits, after, kept, cost + extra, node, KEEP)
                _offer(audits, after, ASSISTANT if state == USER else USER, cost + extra + REROLE_COST, node, REROLE)
            best, copies = after, copies - 1
        if copies:
            best = {s: (cost + DELETE_COST * copies, audits.add(node, DELETE, copies)) for s, (cost, node) in best.items()}
        best = _inserted(audits, best)
    return best


def classified(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, key, n, text, fault): distinct rows, how often each occurs, the first copy's fault."""
    spoken = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = conversations.select("conv_id", "turn", *spoken)
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    distinct = rows.groupBy("conv_id", "turn", "role", key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = distinct.groupBy(F.col("conv_id").alias("_conv"), F.col("key").alias("_said")).agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_said"))
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK)
        .when(place > F.col("first"), DUPLICATE)
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED)
        .otherwise(FINE)
    )
    return distinct.join(said, same, "left").select("conv_id", "turn", "role", "key", "n", "text", fault.alias("fault"))


def fault_counts(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) of classified rows."""
    first = F.col("fault")
    counts = {
        "blank": F.when(first == BLANK, F.col("n")).otherwise(0),
        "duplicate": F.when(first == DUPLICATE, F.col("n")).when(first == BLANK, 0).otherwise(F.col("n") - 1),
        "truncated": F.when(first == TRUNCATED, 1).otherwise(0),
    }
    turns = rows.groupBy("conv_id", "turn").agg(*[F.sum(c).alias(name) for name, c in counts.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return turns.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in counts])


def _run_schema(conv: T.DataType) -> T.StructType:
    found = "part int, seq long, entry int, exit int, cost long, audit string, illegal long, first string, last string, whole boolean"
    return T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(found)])


def _cut(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """(conv_id, rows, ends): consecutive rows of a conversation, `size` at most; ends: nothing of it follows here."""
    conv, rows, started = None, [], False
    for batch in batches:
        for c, initial, fault, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if rows and (c != conv or len(rows) == size):
                yield conv, rows, c != conv
                rows = []
            conv, started = c, True
            rows.append((initial, fault, n))
    if started:
        yield conv, rows, False


def _audited_runs(size: int, kind: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held, opened = TaskContext.get().partitionId(), [], 0, True
        for seq, (conv, rows, ends) in enumerate(_cut(batches, size)):
            initials = [r[0] for r in rows]
            illegal = sum(n - 1 for _, _, n in rows) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            whole = ends and not opened
            for entry in range(4) if opened else (NONE,):
                audits = Audits()
                best = run_audits(rows, entry, audits)
                if whole:
                    best = {-1: _cheapest(audits, best)}
                for state, (cost, node) in best.items():
                    audit = audits.spelled(node)
                    out.append((conv, part, seq, entry, state, cost, audit, illegal, initials[0], initials[-1], whole))
                    held += len(audit) + 64
            opened = not ends
            if held > 1 << 22:
                yield _batch(out, kind)
                out, held = [], 0
        if out:
            yield _batch(out, kind)

    return run


def _cheapest(audits: Audits, best: Best) -> tuple[int, int]:
    ends = [best[s] for s in ENDS if s in best]
    least = min(cost for cost, _ in ends)
    found = [node for cost, node in ends if cost == least]
    return least, found[1] if len(found) > 1 and audits.less(found[1], found[0]) else found[0]


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)


def _joined(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
    """One conversation's runs, each with its best audits between states, put together in order."""
    runs = runs.sort_values(["part", "seq"], kind="stable")
    best, illegal, last = {NONE: (0, "")}, 0, None
    for _, run in runs.groupby(["part", "seq"], sort=True):
        at = run.iloc[0]
        illegal += int(at.illegal) + (last is not None and last + at["first"] not in LEGAL)
        after: dict[int, tuple[int, str]] = {}
        for entry, state, cost, audit in zip(run.entry, run["exit"], run.cost, run.audit):
            if entry in best:
                found = (best[entry][0] + int(cost), best[entry][1] + audit)
                after[state] = min(after.get(state, found), found)
        best, last = after, at["last"]
    cost, audit = min(best[s] for s in ENDS if s in best)
    conv = pd.Series([None if pd.isna(key[0]) else key[0]], dtype=object)
    return pd.DataFrame({"conv_id": conv, "illegal": [illegal], "cost": [cost], "audit": [audit]})


def cheapest_audits(rows: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(conv_id, illegal, cost, audit) of classified rows."""
    conv = rows.schema["conv_id"].dataType
    order = ["conv_id", "turn", "role", "key"]
    initial = F.substring("role", 1, 1)
    codes = rows.select(*order, initial.alias("initial"), "fault", "n").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _run_schema(conv)
    found = codes.select("conv_id", "initial", "fault", "n").mapInArrow(_audited_runs(run_rows, to_arrow_schema(schema)), schema)
    runs = stored(found, "runs")
    done = T.StructType([schema["conv_id"], *T.StructType.fromDDL("illegal long, cost long, audit string")])
    apart = runs.filter(~F.col("whole")).groupBy("conv_id").applyInPandas(_joined, done)
    return runs.filter("whole").select("conv_id", "illegal", "cost", "audit").union(apart)


def _repaired_lines(kind: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, line, state, out, held = None, "", 0, 0, NONE, [], 0

        def write(edit: str, role: str, text: str) -> None:
            nonlocal line, state, held
            line, state = line + 1, next_state(state, role[:1])
            out.append((conv, line, edit, role, text))
            held += len(text) + 32

        def wanted() -> str:
            return "assistant" if state == USER else "user"

        def insert() -> None:
            nonlocal at
            while audit[at : at + 1] == INSERT:
                at += 1
                write(INSERT, wanted(), "")

        for batch in batches:
            for c, head, role, text, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if head == 0:  # the audit comes before the rows that it is about
                    insert()
                    conv, audit, at, line, state = c, text, 0, 0, NONE
                    continue
                insert()
                edit = audit[at]
                if edit != DELETE:
                    write(edit, role if edit == KEEP else wanted(), text)
                at += n  # the copies' deletions follow at once: an insertion before them would not be least
                if held > 1 << 22:
                    yield _batch(out, kind)
                    out, held = [], 0
        insert()
        if out:
            yield _batch(out, kind)

    return run


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, line, edit, role, text): the lines of every conversation after its edits, line from 1."""
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, *T.StructType.fromDDL("line long, edit string, role string, text string")])
    order = ["conv_id", "head", "turn", "role", "key"]
    turn = F.lit(None).cast(rows.schema["turn"].dataType).alias("turn")
    heads = audits.select("conv_id", F.lit(0).alias("head"), turn, F.lit("").alias("role"), F.lit("").alias("key"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"))
    told = heads.union(rows.select("conv_id", F.lit(1).alias("head"), "turn", "role", "key", "text", "n"))
    dealt = told.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "head", "role", "text", "n")
    return dealt.mapInArrow(_repaired_lines(to_arrow_schema(schema)), schema)


def _digested(kind: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, out = None, None, []
        for batch in batches:
            for c, line, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if line == 1:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                digest.update(f"{chr(10) * (line > 1)}{role}:{text}".encode())
            if out:
                yield _batch(out, kind)
                out = []
        if digest is not None:
            yield _batch([(conv, digest.hexdigest())], kind)

    return run


def line_digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of each conversation's `role:text` lines, newline-joined."""
    schema = T.StructType([lines.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    dealt = lines.select("conv_id", "line", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "line")
    return dealt.mapInArrow(_digested(to_arrow_schema(schema)), schema)


EMPTY_SHA256 = hashlib.sha256().hexdigest()


def repair(conversations: DataFrame, run_rows: int = RUN_ROWS) -> tuple[DataFrame, DataFrame]:
    """The audit table, one row per conversation, and the repaired lines."""
    rows = stored(classified(conversations), "turns")
    audits = stored(cheapest_audits(rows, run_rows), "audits")
    counts = fault_counts(rows).withColumnRenamed("conv_id", "_conv")
    table = audits.join(counts, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return table.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), repaired(rows, audits)


def audit_table(conv_ids: DataFrame, conversations: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per conv_id of `conv_ids` with its audit and digest; zeros where no row of it is left."""
    audits, lines = repair(conversations, run_rows)
    every = conv_ids.select(F.col("conv_id").alias("_every")).distinct()
    digests = line_digests(lines).withColumnRenamed("conv_id", "_conv")
    told = every.join(audits, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    told = told.join(digests, F.col("_every").eqNullSafe(F.col("_conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select(
        F.col("_every").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
