"""Conversation structure repair: cheapest edits that make a conversation legal, by Four-Russians block tables.

Rows become symbols (role class and fault). Going backwards over a conversation,
the costs to finish from each grammar state form a vector; up to a constant only
a few vectors exist. Their transitions under every block of ``BLOCK`` symbols are
computed once, so a conversation takes a lookup per block. Edits are traced
forwards, block by block: the vectors inside a block are expanded backwards from
the one at its end, so the least of all cheapest edit strings is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.common import small_batches, table

BLOCK = 4
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to from each state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = "sua"
#: Symbols: four role classes whole, the same truncated, and a row that has to go.
GONE = 8
SYMBOLS = 9
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1


def _kept(state: int, symbol: int) -> int | None:
    """The state after keeping a row, or None where its role may not follow."""
    role = symbol % 4
    if role == 0:
        return SYSTEM if state == START else None
    if role in (1, 2):
        return NEXT[state] if NEXT[state] == role + 1 else None
    return None


def _options(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of each way to consume a row, letters ascending."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        late = TRUNCATED if symbol >= 4 else 0
        after = _kept(state, symbol)
        if after is not None:
            found.append(("K", KEEP + late, after))
        found.append(("R", REROLE + late, NEXT[state]))
    return found


def _settle(costs: list[int]) -> list[int]:
    """Costs to finish, where rows may be inserted first."""
    costs = list(costs)
    for _ in range(4):
        for state in range(4):
            costs[state] = min(costs[state], INSERT + costs[NEXT[state]])
    return costs


class Tables:
    """Transitions of normalised cost vectors for every block, and the letters of every step.

    A vector holds the costs to finish from each state, less their minimum. Vector 0 is that of the end.
    """

    def __init__(self, block: int = BLOCK):
        self.block = block
        far = 1 << 20
        self.vectors = [self._normal(_settle([0, far, far, 0]))]
        known, steps = {self.vectors[0]: 0}, []
        for vector in self.vectors:  # grows while new ones are found
            row = []
            for symbol in range(SYMBOLS):
                before = [min(c + vector[s] for _, c, s in _options(state, symbol)) for state in range(4)]
                normal = self._normal(_settle(before))
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append(known[normal])
            steps.append(row)
        self.step = steps
        one = np.array(steps, np.int32)
        codes = np.array(list(product(range(SYMBOLS), repeat=block)), np.int32)
        jump = np.tile(np.arange(len(self.vectors), dtype=np.int32)[:, None], (1, len(codes)))
        for k in range(block - 1, -1, -1):
            jump = one[jump, codes[:, k]]
        #: jump[vector after a block, block] is the vector before it.
        self.jump = jump
        self.weights = [SYMBOLS ** (block - 1 - k) for k in range(block)]
        self.letters = [
            [[self._letters(v, state, symbol) for symbol in range(SYMBOLS)] for state in range(4)] for v in self.vectors
        ]

    @staticmethod
    def _normal(costs: list[int]) -> tuple[int, ...]:
        low = min(costs)
        return tuple(c - low for c in costs)

    @staticmethod
    def _letters(vector: tuple[int, ...], state: int, symbol: int) -> tuple[str, int]:
        """Least letters of cheapest edits up to and with a row, given the costs after it; and the state then."""
        said = ""
        while True:
            here = {s: min(c + vector[t] for _, c, t in _options(s, symbol)) for s in range(4)}
            best = _settle([here[s] for s in range(4)])
            ways = [(letter, c + vector[t], t) for letter, c, t in _options(state, symbol)]
            ways.append(("I", INSERT + best[NEXT[state]], None))
            letter, _, after = min((w for w in ways if w[1] == best[state]), key=lambda w: w[0])
            said += letter
            if letter != "I":
                return said, after
            state = NEXT[state]

    def code(self, symbols: list[int]) -> int:
        return sum(w * s for w, s in zip(self.weights, symbols))

    def ends(self, symbols: list[int], last: int) -> list[int]:
        """The vector after each whole block, from the one after the last row."""
        whole, vector, found = len(symbols) // self.block * self.block, last, []
        for symbol in reversed(symbols[whole:]):
            vector = self.step[vector][symbol]
        for k in range(whole - self.block, -1, -self.block):
            found.append(vector)
            vector = int(self.jump[vector, self.code(symbols[k : k + self.block])])
        return found[::-1]

    def trace(self, symbols: list[int], state: int, last: int) -> tuple[list[str], int]:
        """Letters of each row, from ``state`` and the vector after the last row; and the state after it."""
        ends, said = [*self.ends(symbols, last), last], []
        for n, low in enumerate(range(0, len(symbols), self.block)):
            part, vector, inside = symbols[low : low + self.block], ends[n], []
            for symbol in reversed(part):
                inside.append(vector)
                vector = self.step[vector][symbol]
            for symbol, after in zip(part, reversed(inside)):
                letters, state = self.letters[after][state][symbol]
                said.append(letters)
        return said, state

    def settled(self, symbols: list[int]) -> tuple[int, int] | None:
        """(rows, vector) such that the vector after that many rows is the same whatever follows the symbols."""
        open_ = np.arange(len(self.vectors))
        whole = len(symbols) // self.block * self.block
        for k in range(whole - self.block, 0, -self.block):
            open_ = np.unique(self.jump[open_, self.code(symbols[k : k + self.block])])
            if len(open_) == 1:
                return k, int(open_[0])
        return None


ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Rows that wait for their edits before a try is made to settle the first of them.
WAITING = 4_096


class _Conversation:
    """One conversation, read row by row; memory holds the rows whose edits later rows can still change."""

    def __init__(self, tables: Tables, conv_id):
        self.tables, self.conv_id = tables, conv_id
        self.symbols, self.rows, self.state, self.cost, self.next_try = [], [], START, 0, WAITING
        self.audit, self.sha, self.wrote = [], hashlib.sha256(), False
        self.low = self.high = self.previous = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.n = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if turn is not None and (self.high is None or turn != self.high):
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.n and self.previous + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.previous, self.n = initial, self.n + 1
        kind = ROLES.find(initial) if initial else -1
        symbol = kind if kind >= 0 else 3
        if fault == "blank" or fault == "duplicate":
            symbol = GONE
            self.blank += fault == "blank"
            self.duplicate += fault == "duplicate"
        elif fault == "truncated":
            symbol += 4
            self.truncated += 1
        self.symbols.append(symbol)
        self.rows.append((role, text))
        if len(self.symbols) >= self.next_try:
            found = self.tables.settled(self.symbols)
            if found:
                self._write(*found)
            self.next_try = max(WAITING, 2 * len(self.symbols))

    def _line(self, role: str, text: str) -> None:
        self.sha.update((b"\n" if self.wrote else b"") + role.encode() + b":" + text.encode())
        self.wrote = True

    def _write(self, count: int, vector: int) -> None:
        letters, after = self.tables.trace(self.symbols[:count], self.state, vector)
        state = self.state
        for (role, text), symbol, said in zip(self.rows, self.symbols, letters):
            for letter in said:
                if letter == "I":
                    state = NEXT[state]
                    self._line(ROLE_NAMES[state], "")
                    self.cost += INSERT
                elif letter == "D":
                    self.cost += DELETE
                else:
                    late = TRUNCATED if 4 <= symbol < GONE else 0
                    if letter == "K":
                        state, role_now, paid = _kept(state, symbol), role, KEEP
                    else:
                        state = NEXT[state]
                        role_now, paid = ROLE_NAMES[state], REROLE
                    self._line(role_now, text)
                    self.cost += paid + late
        assert state == after
        self.audit.append("".join(letters))
        self.state = state
        del self.symbols[:count], self.rows[:count]

    def close(self) -> tuple:
        self._write(len(self.symbols), 0)
        while self.state in (SYSTEM, USER):
            self.state = NEXT[self.state]
            self._line(ROLE_NAMES[self.state], "")
            self.cost += INSERT
            self.audit.append("I")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            "".join(self.audit), self.sha.hexdigest(),
        )


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, gone) with ``fault``: blank, duplicate, truncated or null.

    Of rows with one role and text in a conversation the first by turn stands; rows are dealt
    by conversation, role and text, so a large conversation is spread.
    """
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    return rows.withColumn("nth", F.when(~F.col("gone"), F.row_number().over(same))).withColumn(
        "fault",
        F.when(F.col("gone"), None)
        .when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"),
    )


def repair(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``conversations`` has conv_id, turn, role and text; other columns are not read. ``gone``
    names a boolean column of rows that only bear witness that their conversation exists.
    Null roles and texts are one space (so such a text is blank); a null conv_id is a
    conversation of its own, null turns come first. Rows of one turn go by role, then text;
    repeated rows are duplicates. Empty tables give no rows. A conversation may be of any
    length: rows are sorted by Spark and read once, and a task holds only those whose edits
    rows to come can change. Its edit string and its digest, which are one value each, are
    made by one task in order.
    """
    read = {c.lower(): c for c in conversations.columns}
    rows = conversations.select(
        F.col(read["conv_id"]).alias("conv_id"),
        F.col(read["turn"]).alias("turn"),
        F.coalesce(F.col(read["role"]), F.lit(" ")).alias("role"),
        F.coalesce(F.col(read["text"]), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.col(gone)).alias("gone"),
        (F.col("copy") if gone is not None else F.lit(0)).alias("copy"),
    )
    sorted_ = (
        faults(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy")
        .select("conv_id", "turn", "role", "text", "gone", "fault")
    )
    kind = conversations.schema[read["conv_id"]].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, open_, done, schema = Tables(), None, [], None

        def packed() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[] for _ in NAMES]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [schema, *[pa.int64()] * 6, pa.string(), pa.string()])], names=NAMES
            )

        for batch in batches:
            schema = batch.schema.field(0).type
            for conv_id, turn, role, text, away, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or conv_id != open_.conv_id:
                    if open_ is not None:
                        done.append(open_.close())
                    open_ = _Conversation(tables, conv_id)
                if not away:
                    open_.add(turn, role, text, fault)
            if len(done) >= 1_000:
                yield packed()
                done.clear()
        if open_ is not None:
            done.append(open_.close())
        if done:
            yield packed()

    return sorted_.mapInArrow(run, f"conv_id {kind.simpleString()}, {RESULT}")


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults of ``crc32('conv_id:turn') % 20``; dropped ones stay, marked ``gone``."""
    blank = F.lit(" ")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(F.concat(
            F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
        )) % 20).alias("kind"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return repair(damaged(table(spark, sf, "conversations")), gone="gone")
