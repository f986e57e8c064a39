"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`: nothing, or a
system turn that may be missing, then pairs of a user and an assistant turn. Edits: keep a row,
rerole it to user or assistant, delete it, insert an empty user or assistant turn. Blank and
repeated rows must be deleted; a truncated row that stays costs extra.

Items [i, q] say that the first i rows are edited and what is left stands in state q of that
pattern. A hyperedge derives an item from two premises, an item and the fact known of the row
it edits (insertions have the item alone); [n, even] and [n, empty] derive the goal. An item's
value is (cost, audit), the audit being its edits' initials; a hyperedge adds its cost and
appends its letter, which is monotone and never gives less than a premise had (superior). So
the agenda pops items in the order of their values, the first pop of an item is final, and the
search ends as soon as the goal is popped. Two audits of one item and one cost are never
prefixes of each other, since an insertion costs, so appending keeps their order.

Rows are numbered by one global range sort, which spreads a conversation over as many tasks as
its size needs, and taken in chunks of `CHUNK` places. A conversation within a chunk is solved
there. One that may run over a border is solved per chunk from every state to every state; what
the chunks say is folded in order, as a stream that holds at most four part solutions and commits
what they share, so that a conversation with a third of all rows is neither collected nor solved in one task.
Texts stay out of all that: only a row's initial and fault go there. In the end the audit meets
the rows again, streamed in order; the only thing of a conversation's size that is ever held is its audit.

Defined cases: null roles and texts count as one space; null turns come first; rows of one turn
are ordered by role, then text; a null conversation id is a conversation of its own; roles count
by their first letter; a row that is blank isn't also repeated, and so on, the first fault counts; other
columns are not looked at; an empty table gives empty results.
"""
from __future__ import annotations

import hashlib
import heapq
import os.path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_keys
from ..operators.numbering import global_position

CHUNK = 512
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
NONE, SYSTEM, USER, EVEN = range(4)  # nothing yet, after the system turn, after a user turn, after a whole pair
_KEEP = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): EVEN, (EVEN, "u"): USER}
_TURN = {NONE: USER, SYSTEM: USER, USER: EVEN, EVEN: USER}  # the state after the turn that must follow
# what a state's completions cost more from another state, at most: how far behind a part solution can matter
_BEHIND = {(NONE, EVEN): DELETE, (SYSTEM, EVEN): 0, (USER, EVEN): INSERT, (EVEN, USER): INSERT}


# ---- the agenda --------------------------------------------------------------------

def lightest(codes: str, start: int = NONE, goals: tuple = (NONE, EVEN)):
    """(cost, audit) of the lightest derivation of the goal; {state: (cost, audit)} at the end if `goals` is empty.

    `codes` holds the fact of each row: x if it must go, else its role's initial (o: any other), in capitals if truncated.
    """
    n, final, agenda = len(codes), {}, [(0, "", 0, start)]
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = cost, audit
        if i == n and state in goals:
            return cost, audit
        heapq.heappush(agenda, (cost + INSERT, audit + "I", i, _TURN[state]))
        if i < n:
            fact = codes[i]
            heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, state))
            if fact != "x":
                late = TRUNCATED if fact.isupper() else 0
                heapq.heappush(agenda, (cost + REROLE + late, audit + "R", i + 1, _TURN[state]))
                kept = _KEEP.get((state, fact.lower()))
                if kept is not None:
                    heapq.heappush(agenda, (cost + late, audit + "K", i + 1, kept))
    return {q: final[n, q] for q in range(4) if (n, q) in final}


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_WAY = (T.StructType().add("p", T.IntegerType()).add("q", T.IntegerType())
        .add("cost", T.LongType()).add("audit", T.StringType()))
_SOLVED = (T.StructType().add("illegal", T.LongType()).add("cost", T.LongType())
           .add("audit", T.StringType()).add("ways", T.ArrayType(_WAY)))


@F.pandas_udf(_SOLVED)
def _solve(codes: pd.Series, initials: pd.Series, whole: pd.Series) -> pd.DataFrame:
    rows, seen = [], {}  # conversations often look alike: a batch solves each sort once
    for c, i, w in zip(codes, initials, whole):
        if (c, w) not in seen:
            seen[c, w] = ((*lightest(c), None) if w else
                          (None, None, [{"p": p, "q": q, "cost": k, "audit": a} for p in range(4)
                                        for q, (k, a) in lightest(c, p, ()).items()]))
        rows.append((illegal_pairs(i), *seen[c, w]))
    return pd.DataFrame(rows, columns=["illegal", "cost", "audit", "ways"])


class _Fold:
    """Part solutions of a conversation's chunks so far: at most one a state, and the audit all of them begin with."""

    def __init__(self):
        self.common, self.part, self.illegal, self.last = [], {NONE: (0, "")}, 0, ""

    def add(self, ways: list, illegal: int, first: str, last: str) -> None:
        new: dict = {}
        for w in ways:
            if w["p"] in self.part:
                cost, audit = self.part[w["p"]]
                value = cost + w["cost"], audit + w["audit"]
                if w["q"] not in new or value < new[w["q"]]:
                    new[w["q"]] = value
        self.part = {q: v for q, v in new.items()
                     if not any(q == a and b in new and v[0] > new[b][0] + more for (a, b), more in _BEHIND.items())}
        shared = os.path.commonprefix([a for _, a in self.part.values()])
        self.common.append(shared)
        self.part = {q: (c, a[len(shared):]) for q, (c, a) in self.part.items()}
        self.illegal += illegal + (illegal_pairs(self.last + first) if self.last else 0)
        self.last = last

    def result(self):
        cost, audit = min(self.part[q] for q in (NONE, EVEN) if q in self.part)
        return cost, "".join(self.common) + audit, self.illegal


def _fold(batches):
    """Chunks, ordered by conversation and place -> a row per conversation."""
    key, fold, kind = None, None, None

    def row(k, f):
        cost, audit, illegal = f.result()
        return pa.RecordBatch.from_arrays([pa.array([k], kind), pa.array([cost], pa.int64()), pa.array([audit], pa.string()),
                                           pa.array([illegal], pa.int64())], names=["conv", "cost", "audit", "illegal"])
    for b in batches:
        kind = b.column("conv").type
        for k, ways, illegal, first, last in zip(*(b.column(c).to_pylist() for c in ("conv", "ways", "illegal", "first", "last"))):
            if fold is None or k != key:
                if fold is not None:
                    yield row(key, fold)
                key, fold = k, _Fold()
            fold.add(ways, illegal, first, last)
    if fold is not None:
        yield row(key, fold)


# ---- rows, facts and the repaired conversation -----------------------------------------

def _numbered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    return global_position(rows, ["conv asc nulls first", "turn asc nulls first", "role asc", "text asc"], "pos", start=0)


def facts(numbered: DataFrame) -> DataFrame:
    """conv, turn, pos, initial, fault (blank, duplicate, truncated or null) of each row."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    light = numbered.select("conv", "turn", "pos", "role", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
                            F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").alias("f"),
                            F.sha2("text", 256).alias("digest"))
    same = ["conv", "role", "digest"]
    seen = (light.where(F.coalesce(F.col("f") != "blank", F.lit(True))).groupBy(*same)
            .agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"))
    fault = F.when(F.col("f") == "blank", "blank").when(F.col("pos") > F.col("first_pos"), "duplicate").otherwise(F.col("f"))
    return join_keys(light, seen, same, "left", null_safe=True).select("conv", "turn", "pos", "initial", fault.alias("fault"))


def _in_order(c: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda x: x[c]), "")


def solve(found: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv, cost, audit, illegal of every conversation."""
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial"))
            .otherwise(F.col("initial")))
    chunks = (found.withColumn("code", code).groupBy("conv", F.floor(F.col("pos") / chunk).alias("chunk"))
              .agg(_in_order("code").alias("codes"), _in_order("initial").alias("initials"),  # at most `chunk` rows a group
                   ((F.min("pos") % chunk != 0) & (F.max("pos") % chunk != chunk - 1)).alias("whole")))
    parts = (chunks.withColumn("r", _solve("codes", "initials", "whole"))
             .select("conv", "chunk", "whole", "r.*", F.left("initials", F.lit(1)).alias("first"), F.right("initials", F.lit(1)).alias("last"))
             .checkpoint())
    cut = parts.where("not whole").repartition("conv").sortWithinPartitions("conv", "chunk")
    kind = found.schema["conv"].dataType.simpleString()
    folded = cut.mapInArrow(_fold, f"conv {kind}, cost bigint, audit string, illegal bigint")
    return parts.where("whole").select("conv", "cost", "audit", "illegal").union(folded)


def _edit(batches):
    """Each conversation's audit (pos -1), then its rows in order -> the edited rows, in order."""
    audit, at, state, seq, key = "", 0, NONE, 0, None
    out: list = []

    def inserts():
        nonlocal at, state, seq
        while at < len(audit) and audit[at] == "I":
            state = _TURN[state]
            out.append((key, seq, "I", ROLES["a" if state == EVEN else "u"], ""))
            at, seq = at + 1, seq + 1

    def flush(schema):
        cols = list(zip(*out)) or [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema)], names=["conv", "seq", "edit", "role", "text"])
    schema = None
    for b in batches:
        schema = [b.column("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
        for k, pos, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "pos", "role", "text"))):
            if pos < 0:
                inserts()
                audit, at, state, seq, key = text, 0, NONE, 0, k
                continue
            inserts()
            edit = audit[at]
            if edit == "K":
                state = _KEEP[state, role[0]]
            elif edit == "R":
                state = _TURN[state]
                role = ROLES["a" if state == EVEN else "u"]
            out.append((key, seq, edit, role, text))
            at, seq = at + 1, seq + 1
        yield flush(schema)
    if schema is not None:
        inserts()
        yield flush(schema)


def edited(numbered: DataFrame, solved: DataFrame) -> DataFrame:
    """conv, seq, edit, role, text: the repaired rows (K, R, I) and the deleted ones (D), ordered within partitions."""
    audits = solved.select("conv", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    kind = numbered.schema["conv"].dataType.simpleString()
    return (numbered.select("conv", "pos", "role", "text").union(audits).repartition("conv").sortWithinPartitions("conv", "pos")
            .mapInArrow(_edit, f"conv {kind}, seq bigint, edit string, role string, text string"))


def _digest(batches):
    key, sha, begun, kind = None, None, False, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"])
    for b in batches:
        kind = b.column("conv").type
        for k, seq, edit, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "seq", "edit", "role", "text"))):
            if seq == 0:
                if sha is not None:
                    yield row()
                key, sha, begun = k, hashlib.sha256(), False
            if edit != "D":
                sha.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
    if sha is not None:
        yield row()


def digests(repaired: DataFrame) -> DataFrame:
    """conv, repaired_sha256 over the lines `role:text` of what `edited` gives, in its order, without holding a conversation."""
    kind = repaired.schema["conv"].dataType.simpleString()
    return repaired.mapInArrow(_digest, f"conv {kind}, repaired_sha256 string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(report, repaired): per conversation gaps, faults, cost, audit and digest; and the edited rows (see `edited`)."""
    numbered = _numbered(rows, conv, turn, role, text)
    found = facts(numbered).checkpoint()
    solved = solve(found, chunk).checkpoint()
    repaired = edited(numbered, solved)
    counts = found.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    report = (counts.unionByName(solved, allowMissingColumns=True).unionByName(digests(repaired), allowMissingColumns=True)
              .groupBy("conv").agg(*[F.max(c).alias(c) for c in names]))
    return report.withColumnRenamed("conv", conv), repaired.withColumnRenamed("conv", conv)
