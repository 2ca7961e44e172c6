"""Conversation structure repair: the cheapest edits that make roles alternate, by run-length dynamic programming."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, join_groups, partitions, sliced, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: More than any repair costs: there is none.
NEVER = 1 << 60

#: What the repaired roles have come to: nothing yet, a system row, a user row that waits for its answer, an answer.
NONE, SYSTEM, USER, ANSWER = range(4)
STATES = range(4)
_TAKES = {NONE: "su", SYSTEM: "u", USER: "a", ANSWER: "u"}
_AFTER = {"s": SYSTEM, "u": USER, "a": ANSWER}
_GIVEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

#: A row's symbol: a role initial (``o``: another) of a sound row, in capitals of a truncated one, ``x`` for one that must go.
BLANK, DUPLICATE, CUT, SOUND = range(4)


def symbol(role: str, fault: int) -> str:
    if fault in (BLANK, DUPLICATE):
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == CUT else initial


def edits(sym: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits of a row of this symbol, in the order of their initials; insertions are none of a row."""
    out = [("D", DELETE, state)]
    if sym != "x":
        more, role = (TRUNCATED if sym.isupper() else 0), sym.lower()
        if role in _TAKES[state]:
            out.append(("K", KEEP + more, _AFTER[role]))
        out += [("R", REROLE + more, _AFTER[r]) for r in "ua" if r in _TAKES[state]]
    return out


def insertion(state: int) -> tuple[int, int]:
    """(cost, state after) of an inserted row: the one role of user and assistant that may follow."""
    return INSERT, (ANSWER if state == USER else USER)


Matrix = list[list[int]]


def _times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the cheapest way through a, then b."""
    return [[min(a[i][k] + b[k][j] for k in STATES) for j in STATES] for i in STATES]


def _insertions() -> Matrix:
    """Costs of going between states by insertions alone (two come back to where one was)."""
    m = [[0 if i == j else NEVER for j in STATES] for i in STATES]
    step = [[NEVER] * 4 for _ in STATES]
    for i in STATES:
        cost, j = insertion(i)
        step[i][j] = cost
    for _ in STATES:
        m = [[min(m[i][j], min(m[i][k] + step[k][j] for k in STATES)) for j in STATES] for i in STATES]
    return m


INSERTED = _insertions()


class Powers:
    """The transition of each symbol and its cached binary powers: powers[sym][b] is that of 2**b rows."""

    def __init__(self) -> None:
        self.powers: dict[str, list[Matrix]] = {}

    def power(self, sym: str, b: int) -> Matrix:
        if sym not in self.powers:
            m = [[NEVER] * 4 for _ in STATES]
            for i in STATES:
                for _, cost, j in edits(sym, i):
                    m[i][j] = min(m[i][j], cost)
            self.powers[sym] = [_times(INSERTED, m)]
        own = self.powers[sym]
        while len(own) <= b:
            own.append(_times(own[-1], own[-1]))
        return own[b]

    def before(self, sym: str, n: int, after: list[int]) -> list[int]:
        """Costs to the end by state before a run of n rows, from those after it."""
        b = 0
        while n:
            if n & 1:
                m = self.power(sym, b)
                after = [min(m[i][j] + after[j] for j in STATES) for i in STATES]
            n, b = n >> 1, b + 1
        return after


#: Costs to the end after the last row: nothing, or whole pairs after at most one system row, are in order.
END = [min(INSERTED[i][j] for j in (NONE, ANSWER)) for i in STATES]


class Runs:
    """Equal symbols in a row as one (symbol, n), nine bytes each."""

    def __init__(self) -> None:
        self.symbols, self.lengths = bytearray(), array("q")

    def add(self, sym: str, n: int) -> None:
        if self.symbols and self.symbols[-1] == ord(sym):
            self.lengths[-1] += n
        else:
            self.symbols.append(ord(sym))
            self.lengths.append(n)

    def __len__(self) -> int:
        return len(self.symbols)

    def __getitem__(self, i: int) -> tuple[str, int]:
        return chr(self.symbols[i]), self.lengths[i]


def solve(runs: Runs, powers: Powers) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation; of several the one whose audit is the least in ASCII order.

    Going back, each run moves the costs to the end by its binary powers; they are kept for
    every BLOCK-th run.  Going forward, the first edit in ASCII order that keeps to the least
    cost is chosen, row by row, with the costs of a block of runs, and of a block of rows of a
    long run, at hand.  So memory beside the runs and the audit doesn't grow.
    """
    n_runs, kept, costs = len(runs), {}, END
    for i in range(n_runs - 1, -1, -1):
        if (i + 1) % BLOCK == 0 or i == n_runs - 1:
            kept[i + 1] = costs
        costs = powers.before(*runs[i], costs)
    total, audit, state = costs[NONE], bytearray(), NONE
    for start in range(0, n_runs, BLOCK):
        stop = min(start + BLOCK, n_runs)
        after = [kept[stop]]
        for i in range(stop - 1, start, -1):
            after.append(powers.before(*runs[i], after[-1]))
        for i in range(start, stop):
            (sym, n), end, done = runs[i], after[stop - 1 - i], 0
            while done < n:
                block = min(BLOCK, n - done)
                within = [powers.before(sym, n - done - block, end)]
                for _ in range(block):
                    within.append(powers.before(sym, 1, within[-1]))
                for k in range(block, 0, -1):
                    state = _choose(audit, sym, state, within[k], within[k - 1])
                done += block
    while END[state]:
        _, state = insertion(state)
        audit.append(ord("I"))
    return total, audit.decode()


#: Runs, and rows of a run, whose costs are held at a time.
BLOCK = 4096


def _choose(audit: bytearray, sym: str, state: int, now: list[int], then: list[int]) -> int:
    """Append a row's edits, insertions before it among them; returns the state after it. now, then: costs to the end before and after the row."""
    while True:
        left = now[state]
        options = [(c, cost, j, then) for c, cost, j in edits(sym, state)] + [("I", *insertion(state), now)]
        c, _, j, costs = min(o for o in options if o[1] + o[3][o[2]] == left)
        audit.append(ord(c))
        state = j
        if costs is then:
            return state


@dataclass
class _Conversation:
    """What is known of a conversation so far: counts and runs from its symbols, then the hash of its repaired text.  Its texts pass by one at a time."""

    id: object
    runs: Runs = field(default_factory=Runs)
    last_initial: str | None = None
    last_turn: int | None = None
    low: int | None = None
    high: int | None = None
    distinct: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    cost: int = 0
    audit: str | None = None
    at: int = 0
    state: int = NONE
    written: bool = False
    hash: object = field(default_factory=hashlib.sha256)

    def symbols(self, turn: int | None, role: str, fault: int, n: int, first: bool) -> None:
        """n equal rows; only the first of them, if any of the conversation, is no duplicate."""
        if not n:
            return
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last_turn = turn
        initial = role[:1]
        self.illegal += (self.last_initial is not None and self.last_initial + initial not in LEGAL) + (n - 1) * (2 * initial not in LEGAL)
        self.last_initial = initial
        own = [(fault, n)] if fault == BLANK else [(fault, 1), (DUPLICATE, n - 1)] if first else [(DUPLICATE, n)]
        for f, k in own:
            if k:
                self.faults[f] += k
                self.runs.add(symbol(role, f), k)

    def settle(self, powers: Powers) -> None:
        self.cost, self.audit = solve(self.runs, powers)
        self.runs = Runs()

    def _write(self, role: str, text: str) -> None:
        self.hash.update(b"\n" * self.written + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written = True

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            _, self.state = insertion(self.state)
            self._write(_GIVEN["a" if self.state == ANSWER else "u"], "")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        self._insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return
        given = role[:1] if edit == "K" else "a" if self.state == USER else "u"
        self.state = _AFTER[given]
        self._write(role if edit == "K" else _GIVEN[given], text)

    def row(self, powers: Powers) -> tuple:
        if self.audit is None:
            self.settle(powers)
        self._insertions()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return self.id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost, self.audit, self.hash.hexdigest()


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in order, each with its symbols, then its texts."""
    now, powers, out = None, Powers(), []

    def batch() -> pa.RecordBatch:
        kinds = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], COLUMNS)
        out.clear()
        return made

    for b in sliced(batches, 500):
        ids = b.schema.field("conv_id").type
        for conv, is_text, turn, role, text, fault, n, first in zip(*(b.column(c).to_pylist() for c in ("conv_id", "is_text", "turn", "role", "text", "fault", "n", "first")), strict=True):
            if now is None or now.id != conv:
                if now is not None:
                    out.append(now.row(powers))
                now = _Conversation(conv)
            if not is_text:
                now.symbols(turn, role, fault, n, first)
            else:
                if now.audit is None:
                    now.settle(powers)
                now.text(role, text)
        if len(out) >= 1000:
            yield batch()
    if now is not None:
        out.append(now.row(powers))
    if out:
        yield batch()


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows stand by turn, nulls first; of one turn by role and the MD5 of the text, so that the
    result doesn't depend on how they are stored.  A row's first fault counts: blank (nothing
    but white space), duplicate (role and text seen earlier in the conversation), truncated
    (the last other character is none of ``.!?``).  Null role or text is one space.  The edits
    (Keep 0, Rerole 1, Delete 2, Insert 5; 5 more for a truncated row that stays) are the
    cheapest that give ``(s?(ua)+)?``, ties by the ASCII order of the audit.

    Rows that are equal in all count as often as they stand.  With copies_col a row counts that
    often; 0 leaves a conversation that has no rows.  A null conversation is one of its own.  An
    empty table gives none; other columns are ignored, whatever their names.

    Duplicates are found by grouping digests.  A conversation's symbols come to one task as runs
    of equal rows, then its texts, sorted by Spark, one batch at a time: the task holds a
    conversation's audit (a byte a row, which is a cell of the result) and its runs, no text.
    SHA-256 of one text goes from its start to its end, so it can't be taken in several tasks.
    """
    text = F.coalesce(F.col(text_col), F.lit(" "))
    own = rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("int").alias("n"),
    ).withColumn("digest", F.unhex(F.md5("text")))
    grouped = own.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.max(fault(F.col("text"))).alias("fault"))
    grouped = stored(grouped.withColumn("key", F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "role", "digest")), "turns")
    present = grouped.filter("n > 0")
    # By the whole of conversation, role and digest; the hash only deals them out.
    same = ["key", "conv_id", "role", "digest"]
    seen = present.groupBy(*same).agg(F.min(_place("turn")).alias("first_place"), F.count("*").alias("turns")).filter("turns > 1")
    renamed = seen.select("key", "turns", "first_place", *[F.col(c).alias(f"__{c}") for c in same[1:]])
    repeated = stored(renamed.groupBy("key").agg(F.sum("turns").alias("turns"), F.collect_list(F.struct("__conv_id", "__role", "__digest", "first_place")).alias("groups")), "repeated-turns")
    marked = join_groups(grouped, repeated, ["key"], "turns", grouped.count(), "left")
    mine = F.filter("groups", lambda g: g["__conv_id"].eqNullSafe(F.col("conv_id")) & (g["__role"] == F.col("role")) & (g["__digest"] == F.col("digest")))
    first = F.coalesce(F.size(mine), F.lit(0)) <= 0
    first = first | F.get(mine, F.lit(0))["first_place"].eqNullSafe(_place("turn"))
    symbols = marked.select("conv_id", F.lit(False).alias("is_text"), "turn", "role", "digest", F.lit(None).cast("string").alias("text"), "fault", "n", first.alias("first"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))
    texts = own.filter("n > 0").select("conv_id", F.lit(True).alias("is_text"), "turn", "role", "digest", "text", F.lit(None).cast("int").alias("fault"), copies.alias("n"), F.lit(None).cast("boolean").alias("first"))
    both = symbols.unionByName(texts).repartition(partitions(rows), "conv_id").sortWithinPartitions("conv_id", "is_text", F.col("turn").asc_nulls_first(), "role", "digest")
    kind = {f.name: f.dataType.simpleString() for f in own.schema.fields}["conv_id"]
    return both.mapInArrow(_repair, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _place(turn: str) -> Column:
    """A turn's place: null first."""
    return F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"))


def fault(text: Column) -> Column:
    """A text's own fault: blank, truncated or none."""
    return F.when(~text.rlike(WORD), BLANK).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(SOUND)


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n): rows damaged by crc32 of ``conversation:turn`` modulo 20; n is 0 for a dropped row, 2 for a repeated one.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role
    user, others leave it.  Nulls are one space, in the hashed name too.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.pmod(F.crc32(F.concat(spaced(id_col), F.lit(":"), spaced(turn_col)).cast("binary")), F.lit(20))
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(spaced(text_col), "[.!?]", "")).otherwise(spaced(text_col))
    return rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.when(case == 4, "user").otherwise(spaced(role_col)).alias("role"), text.alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("n"),
    )
