"""Conversation structure repair over a suffix-shared automaton.

A conversation's rows give a signature: per row the role's initial and its
fault.  Signatures are read from the end: all conversations that end alike
share the automaton nodes of that ending (a node is a distinct suffix), and
each node holds, per state of the grammar ``(s?(ua)+)?``, the cost to go, the
best audit of the suffix and the state it leaves behind.  The cheapest edits
have an optimal substructure in which every edit has a letter of its own, so
ties are settled by one letter and a node never compares texts.

Spark sorts the reversed signatures by range, so equal endings of all
conversations lie side by side; a task walks them with a stack of the current
signature's nodes (at most ``SEGMENT`` of them) and builds each node once.  A
signature that thousands of conversations share is solved once a partition.

Long conversations are cut into segments of ``SEGMENT`` rows.  A first walk
gives each of their segments its 4 x 4 table of costs from state to state; one
stream over these tables, last segment first, gives the costs to go at each
cut; the second walk then solves all segments alike.  Finally one stream per
conversation, row by row, applies the audit and hashes the repaired rows (a
SHA-256 of the whole conversation can only be taken in order; no row is held).

Edge cases: a null of any column counts as one space (so a null text is blank,
a null role has a foreign initial); rows of null conv_id are one conversation;
a null turn comes first, turns of equal number go by the MD5 of role and text
after damage; repeated rows are duplicates of the first; a very long text is
one row of the stream; a conversation without rows after damage has zeros, an
empty audit and the empty string's hash; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, checkpointed, placed, read

#: Rows of one conversation whose signature is one string.
SEGMENT = 1024
#: Costs of the edits, of an undeleted truncated row, and the damage rule's modulus.
REROLE, DELETE, INSERT, TRUNCATED, DAMAGE = 1, 2, 5, 5, 20
#: Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
EXPECTED = (2, 2, 3, 2)  # the state after the user or assistant turn that comes next
ROLES = {2: "user", 3: "assistant"}
#: Cost to go, audit and last state at the end of a conversation.
END = ([0, 2 * INSERT, INSERT, 0], ["", "II", "I", ""], [0, 3, 3, 3])
NEVER = 1 << 40


# the automaton -------------------------------------------------------------

def best_edits(symbol: str, after: list[int]) -> tuple[list[int], list[tuple[str, int]]]:
    """Per state the cost to go before a row and the first edit (letter, state
    after it), from the costs after the row.

    Symbols: initial of the role (``o`` for any other), upper case where the
    row is truncated; ``X`` for a row that must go."""
    cost, move = [0] * 4, [("", 0)] * 4
    for s in range(4):
        options = [(DELETE + after[s], "D", s)]
        if symbol != "X":
            extra, role = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
            options.append((REROLE + extra + after[EXPECTED[s]], "R", EXPECTED[s]))
            if role in KEEPS[s]:
                options.append((extra + after[KEEPS[s][role]], "K", KEEPS[s][role]))
        cost[s], letter, to = min(options)
        move[s] = (letter, to)
    own = cost[2], cost[3]
    for s, other in ((2, own[1]), (3, own[0])):
        if (INSERT + other, "I") < (cost[s], move[s][0]):
            cost[s], move[s] = INSERT + other, ("I", EXPECTED[s])
    for s in (0, 1):
        if (INSERT + cost[2], "I") < (cost[s], move[s][0]):
            cost[s], move[s] = INSERT + cost[2], ("I", 2)
    return cost, move


class Suffixes:
    """Nodes of the suffixes of one signature after another; what a signature
    shares with the one before it is kept."""

    def __init__(self, cost: list[int], audit: list[str], state: list[int]):
        self.nodes, self.read = [(cost, audit, state)], ""
        self.made = 0

    def solve(self, backwards: str) -> tuple[list[int], list[str], list[int]]:
        shared, most = 0, min(len(self.read), len(backwards))
        while shared < most and self.read[shared] == backwards[shared]:
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            after, audits, states = self.nodes[-1]
            cost, move = best_edits(symbol, after)
            audit, state = [""] * 4, [0] * 4
            for s in sorted(range(4), key=lambda s: (move[s][0] == "I", s < 2)):
                letter, to = move[s]
                audit[s] = letter + (audit[to] if letter == "I" else audits[to])
                state[s] = state[to] if letter == "I" else states[to]
            self.nodes.append((cost, audit, state))
            self.made += 1
        self.read = backwards
        return self.nodes[-1]


UNITS = "void long, c long, seg long, marks string, goal string"


def walk(units: DataFrame) -> DataFrame:
    """Solves each unit's signature (``marks``) towards its ``goal`` (costs
    after it, comma-joined; empty: the conversation ends): ``audits`` and
    ``states`` for each state it may start in."""
    need = ["void", "c", "seg", "marks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal, suffixes = None, None
        for b in batches:
            audits, states = [], []
            for g, backwards in zip(b.column("goal").to_pylist(), b.column("backwards").to_pylist(), strict=True):
                if g != goal:
                    goal = g
                    suffixes = Suffixes(*(END if not g else ([int(x) for x in g.split(",")], [""] * 4, [0, 1, 2, 3])))
                _, audit, state = suffixes.solve(backwards)
                audits.append(audit)
                states.append(state)
            cols = [*[b.column(c) for c in need], pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, [*need, "audits", "states"])

    keyed = units.withColumn("backwards", F.reverse(F.translate("marks", "BD", "XX")))
    order = ["goal", "backwards", "void", "c", "seg"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "void long, c long, seg long, marks string, audits array<string>, states array<long>")


def tables(units: DataFrame) -> DataFrame:
    """Each unit's cost from every state (4 rows of 4) to every state after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goals = [[0 if s == e else NEVER for s in range(4)] for e in range(4)]
        ways = [Suffixes(g, [""] * 4, [0] * 4) for g in goals]
        for b in batches:
            found = []
            for backwards in b.column("backwards").to_pylist():
                by_end = [w.solve(backwards)[0] for w in ways]
                found.append([by_end[e][s] for s in range(4) for e in range(4)])
            cols = [*[b.column(c) for c in ("void", "c", "seg")], pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["void", "c", "seg", "costs"])

    keyed = units.select("void", "c", "seg", F.reverse(F.translate("marks", "BD", "XX")).alias("backwards"))
    order = ["backwards", "void", "c", "seg"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "void long, c long, seg long, costs array<long>")


def goals(costs: DataFrame) -> DataFrame:
    """void, c, seg, goal: what it costs to go on after each segment, less the least of the four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, after = None, None
        for b in batches:
            out = []
            for v, c, table in zip(*(b.column(x).to_pylist() for x in ("void", "c", "costs")), strict=True):
                if (v, c) != conv:
                    conv, after = (v, c), None
                out.append("" if after is None else ",".join(map(str, after)))
                here = (np.array(table).reshape(4, 4) + np.array(END[0] if after is None else after)).min(axis=1)
                after = (here - here.min()).tolist()
            cols = [*[b.column(x) for x in ("void", "c", "seg")], pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["void", "c", "seg", "goal"])

    back = costs.repartition("void", "c").sortWithinPartitions("void", "c", F.desc("seg"))
    return back.mapInArrow(run, "void long, c long, seg long, goal string")


# rows ----------------------------------------------------------------------

def _blanked(text: Column) -> Column:
    return F.rtrim(F.translate(text, BLANKS, " " * len(BLANKS)))


def conversation_rows(conv: DataFrame) -> DataFrame:
    """void, c, turn, role, text with nulls of role and text as one space
    (``void`` is 1 for the rows of null conv_id)."""
    c = F.col("conv_id").cast("long")
    texts = [F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")]
    return conv.select(c.isNull().cast("long").alias("void"), F.coalesce(c, F.lit(0)).alias("c"), F.col("turn").cast("long").alias("turn"), *texts)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the damage rule: dropped, emptied, without sentence ends, repeated, or made the user's."""
    c = F.when(F.col("void") == 1, F.lit(" ")).otherwise(F.col("c").cast("string"))
    name = F.concat(c, F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % DAMAGE
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(kind != 0).select("void", "c", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """With ``key``, a hash of role and text: tells rows apart and orders those of one turn."""
    return rows.withColumn("key", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


def signatures(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """void, c, seg, marks: one letter per row, in order.  ``B`` blank, ``D``
    duplicate, else the initial of the role, upper case if truncated."""
    bare = _blanked(F.col("text"))
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))
    mark = F.when(bare == "", F.lit("B")).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), initial).otherwise(F.upper(initial))
    at = placed(keyed(rows).select("void", "c", "turn", "key", mark.alias("mark")), ["void", "c"], ["turn", "key"])
    again = at.groupBy("void", "c", "key").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = at.join(again, ["void", "c", "key"], "left").select(
        "void", "c", "pos", F.when((F.col("mark") != "B") & (F.col("pos") > F.col("first")), F.lit("D")).otherwise(F.col("mark")).alias("mark")
    )
    letters = F.array_sort(F.collect_list(F.struct("pos", "mark")))
    return marked.groupBy("void", "c", F.expr(f"pos DIV {segment}").alias("seg")).agg(F.array_join(F.transform(letters, lambda x: x["mark"]), "").alias("marks"))


def solved(units: DataFrame) -> DataFrame:
    """``walk`` of every unit, towards the goals of its own conversation."""
    units = checkpointed(units)
    longer = units.where("seg > 0").select("void", "c").distinct()
    cut = units.join(longer, ["void", "c"], "left_semi")
    aim = goals(tables(cut))
    aimed = units.join(aim, ["void", "c", "seg"], "left").withColumn("goal", F.coalesce("goal", F.lit("")))
    return walk(aimed.select("void", "c", "seg", "marks", "goal"))


REPORT = [("conv_id", pa.int64()), *[(x, pa.int64()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())]


class Repair:
    """One conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.marks, self.pieces, self.state = conv_id, [], [], 0
        self.audit, self.at, self.row, self.here, self.written = "", 0, 0, 0, False
        self.sha, self.illegal, self.before, self.cost = hashlib.sha256(), 0, None, 0
        self.turns, self.low, self.high = 0, None, None

    def unit(self, marks: str, audits: list[str], states: list[int]) -> None:
        self.marks.append(marks)
        self.pieces.append(audits[self.state])
        self.state = states[self.state]

    def _start(self) -> None:
        self.marks, self.audit = "".join(self.marks), "".join(self.pieces)
        self.pieces = None

    def _write(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written = True

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.here = EXPECTED[self.here]
            self._write(ROLES[self.here], "")
            self.at += 1
            self.cost += INSERT

    def add(self, turn: int | None, role: str, text: str) -> None:
        if self.pieces is not None:
            self._start()
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        first = role[:1]
        self.illegal += self.before is not None and self.before + first not in ("su", "ua", "au")
        self.before = first
        self._inserts()
        edit, mark = self.audit[self.at], self.marks[self.row]
        self.at, self.row = self.at + 1, self.row + 1
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if mark.isupper() else 0
        if edit == "K":
            self.here = KEEPS[self.here][first]
            self._write(role, text)
        else:
            self.here = EXPECTED[self.here]
            self._write(ROLES[self.here], text)
            self.cost += REROLE

    def report(self) -> tuple:
        if self.pieces is not None:
            self._start()
        self._inserts()
        if self.row != len(self.marks) or self.at != len(self.audit):
            raise ValueError("signature and rows of a conversation differ")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [self.marks.count("B"), self.marks.count("D"), sum(map(self.marks.count, "SUAO"))]
        return (self.conv_id, gaps, *counts, self.illegal, self.cost, self.audit, self.sha.hexdigest())


def apply_audits(every: DataFrame, units: DataFrame, rows: DataFrame) -> DataFrame:
    """Report of every conversation (``void``, ``c``) from its solved units and its rows."""
    none = {"kind": "int", "seg": "long", "marks": "string", "audits": "array<string>", "states": "array<long>", "turn": "long", "key": "string", "role": "string", "text": "string"}

    def side(df: DataFrame, kind: int) -> DataFrame:
        have = {"kind": F.lit(kind)} | {c: F.col(c) for c in df.columns}
        return df.select("void", "c", *[(have.get(n, F.lit(None))).cast(t).alias(n) for n, t in none.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [n for n, _ in REPORT], [t for _, t in REPORT]

        def batch(done):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names)

        open_ = None
        for b in batches:
            done, col = [], {n: b.column(n) for n in b.schema.names}
            kinds, voids, ids = (col[n].to_pylist() for n in ("kind", "void", "c"))
            for i, kind in enumerate(kinds):
                if kind == 0:  # a new conversation
                    if open_:
                        done.append(open_.report())
                    open_ = Repair(None if voids[i] else ids[i])
                elif kind == 1:
                    open_.unit(col["marks"][i].as_py(), col["audits"][i].as_py(), col["states"][i].as_py())
                else:
                    open_.add(col["turn"][i].as_py(), col["role"][i].as_py(), col["text"][i].as_py())
            if done:
                yield batch(done)
        if open_:
            yield batch([open_.report()])

    stacked = side(every, 0).unionByName(side(units, 1)).unionByName(side(rows, 2))
    order = ["void", "c", "kind", "seg", "turn", "key"]
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return stacked.repartition("void", "c").sortWithinPartitions(*order).mapInArrow(run, schema)


def repair(conv: DataFrame, segment: int = SEGMENT, damage: bool = True) -> DataFrame:
    """The report of every conversation of ``conv`` (after the damage rule, unless ``damage`` is false)."""
    source = conversation_rows(conv)
    rows = damaged(source) if damage else source
    return apply_audits(source.select("void", "c").distinct(), solved(signatures(rows, segment)), keyed(rows))


def repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest edits and repaired hash."""
    return repair(read(spark, sf_dir, "conversations"))
