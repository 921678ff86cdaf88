"""Conversation structure repair by iterative-deepening A*.

A conversation is repaired when the initials of its roles read
`(s?(ua)+)?`: nothing, or an optional system row and then user and assistant in
turn.  Row by row, in order, an edit keeps a row (K), gives it the role user or
assistant (R, cost 1), deletes it (D, cost 2), or inserts an empty row of either
role before it or at the end (I, cost 5).  Rows that are blank, or repeat the
role and text of an earlier row, must be deleted; a row whose text breaks off
(its last character that is no white space is none of `.!?`) costs 5 more unless
it is deleted.  The cheapest edits count; of several, the ASCII-least.

`search` goes depth first through the edits in ASCII order (D, I, K, R) under a
cost bound that starts at an admissible estimate (2 for each faulty row that is
left) and grows to the least cost not yet ruled out.  A transposition table
keeps, for each state (rows read, role expected) that failed, the cost it is
known to need, so no state is searched again under a bound that it failed.  The
first path that is accepted is the cheapest, and the first of these in order.
From a state, a letter leads to one role only, so the letters are the edits.

A conversation of more than SEGMENT rows is searched segment by segment, from
each state that can be reached to each state it may end in, as bounds grow with
the rows; the best path per state is carried on.  Equal-cost paths over the same
rows and between the same states are never prefixes of each other (the longer
one would hold more insertions), so the least prefix stays least.

Spark partitions by conversation and sorts by turn (nulls first), role and text.
A task streams its rows: it holds one byte and one 16-byte digest per row of one
conversation, and the texts of one conversation beyond HELD_BYTES in a temporary
file of the task, because a hash over the whole repaired text is sequential.  No
conversation meets in the driver, and none is held as one value but its result.

Cases: a null role or text reads as one space (so a null text is blank and a null
role none of the three); a null turn sorts first and takes no part in the gaps;
null conversation ids are one conversation; rows of equal turn are taken by role
and text, equal rows are duplicates; empty and very long texts are ordinary;
a conversation of which `present` is true on no row has zeros, an empty audit and
the hash of the empty string; an empty table gives no rows; further columns take
no part and cannot clash, as the columns used get names of their own.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = 128
HELD_BYTES = 64 << 20
OUT_ROWS = 5000

# States: nothing yet, after system, after user, after assistant; what a user or
# assistant row leads to from each, and its role.
START, SYSTEM, USER, ASSISTANT = range(4)
GOES = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
ACCEPTED = frozenset((START, ASSISTANT))
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL_PAIRS = {"su", "ua", "au"}
# A row's code: state of its role's initial (0: none of the three) + 4 x fault.
SOUND, TRUNCATED, GONE = range(3)
COST_DELETE, COST_INSERT, COST_REROLE, COST_TRUNCATED = 2, 5, 1, 5
NEVER = 1 << 60
WHITE = " \t\n\x0b\x0c\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def keeps_to(state: int, own: int) -> bool:
    """May a row with this role stay as it is after `state`?"""
    return own == GOES[state] or (own == SYSTEM and state == START)


def _hopeful(targets: frozenset) -> tuple:
    """Per state: can any of the targets still be reached from it?"""
    far = bool(targets & {USER, ASSISTANT})
    return (True, far or SYSTEM in targets, far, far)


def search(codes: bytes, start: int, targets: frozenset) -> tuple[int, str, int] | None:
    """(cost, letters, state at the end) of the cheapest and ASCII-least edits of
    these rows from `start` to one of `targets`; None if there are none."""
    n, hopeful = len(codes), _hopeful(targets)
    if not hopeful[start]:
        return None
    if targets == {SYSTEM} and start == START and SYSTEM not in codes and SYSTEM + 4 * TRUNCATED not in codes:
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (COST_DELETE if codes[i] >= 4 else 0)
    needs: dict[tuple[int, int], int] = {}

    def edits(i: int, state: int) -> list:
        out = []
        to = GOES[state]
        if i < n:
            own, fault = codes[i] & 3, codes[i] >> 2
            out.append(("D", COST_DELETE, i + 1, state))
        if hopeful[to]:
            out.append(("I", COST_INSERT, i, to))
        if i < n and fault != GONE:
            more = COST_TRUNCATED if fault else 0
            if own and keeps_to(state, own) and hopeful[own]:
                out.append(("K", more, i + 1, own))
            if hopeful[to]:
                out.append(("R", COST_REROLE + more, i + 1, to))
        return out

    bound = least[0]
    while True:
        letters: list[str] = []
        frames = [(0, start, bound, iter(edits(0, start)))]
        while frames:
            i, state, left, options = frames[-1]
            if i == n and state in targets:
                return bound - left, "".join(letters), state
            for letter, cost, to, then in options:
                if cost + needs.get((to, then), least[to]) <= left:
                    frames.append((to, then, left - cost, iter(edits(to, then))))
                    letters.append(letter)
                    break
            else:
                needs[i, state] = min((c + needs.get((to, then), least[to]) for _, c, to, then in edits(i, state)),
                                      default=NEVER)
                frames.pop()
                if letters:
                    letters.pop()
        bound = needs[0, start]


def cheapest_edits(codes: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, letters) of the best repair of a conversation."""
    best = {START: (0, "")}
    settled: list[str] = []
    cuts = range(0, len(codes), segment) or (0,)
    for a in cuts:
        last = a + segment >= len(codes)
        reached: dict[int, tuple[int, str]] = {}
        for start, (cost, letters) in best.items():
            for targets in ([ACCEPTED] if last else [frozenset((t,)) for t in range(4)]):
                found = search(codes[a:a + segment], start, targets)
                if found:
                    end = START if last else found[2]
                    path = (cost + found[0], letters + found[1])
                    reached[end] = min(path, reached.get(end, path))
        common = os.path.commonprefix([p for _, p in reached.values()])
        settled.append(common)
        best = {s: (c, p[len(common):]) for s, (c, p) in reached.items()}
    cost, rest = best[START]
    return cost, "".join(settled) + rest


class _Rows:
    """The rows of one conversation, in order, within HELD_BYTES of memory."""

    def __init__(self):
        self.held, self.size, self.file = [], 0, None

    def add(self, role: str, text: str) -> None:
        self.held.append((role, text))
        self.size += len(role) + len(text) + 100
        if self.size > HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.held, self.file)
            self.held, self.size = [], 0

    def __iter__(self):
        if self.file:
            self.file.seek(0)
            while True:
                try:
                    yield from pickle.load(self.file)
                except EOFError:
                    break
            self.file.close()
        yield from self.held


class Conversation:
    """What is known of a conversation while its rows come in, and its repair."""

    def __init__(self):
        self.rows, self.codes, self.seen = _Rows(), bytearray(), set()
        self.low = self.high = self.at = None
        self.turns = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        shown = text.rstrip(WHITE)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = SOUND
        if not shown:
            fault = GONE
            self.faults["blank"] += 1
        elif key in self.seen:
            fault = GONE
            self.faults["duplicate"] += 1
        elif shown[-1] not in ".!?":
            fault = TRUNCATED
            self.faults["truncated"] += 1
        self.seen.add(key)
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL_PAIRS:
            self.faults["illegal"] += 1
        self.before = initial
        self.codes.append(STATE_OF.get(initial, 0) + 4 * fault)
        self.rows.add(role, text)

    def repair(self, solve) -> tuple[dict, Iterator[tuple[str, str, str]]]:
        """The counts and letters, and the (letter, role, text) of each row that
        the repaired conversation has."""
        cost, audit = solve(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(self.faults, gaps=gaps, cost=cost, audit=audit), self._repaired(audit)

    def _repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        rows, state = iter(self.rows), START
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(rows)
            if letter == "D":
                continue
            if letter == "K":
                state = STATE_OF[role[:1]]
            else:
                state = GOES[state]
                role = ROLES[state]
            yield letter, role, text


def _in_order(df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    def shown(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     shown(role).alias("role"), shown(text).alias("text"), here.alias("here"))
    # A row that only names its conversation carries no text through the shuffle.
    rows = rows.select("conv", "here", *[F.when(F.col("here"), F.col(c)).alias(c) for c in ("turn", "role", "text")])
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Conversation]]:
    """Each conversation of a sorted partition, once its last row is read."""
    now, made = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "here", "turn", "role", "text")]
        for conv, here, turn, role, text in zip(*columns):
            if made is None or conv != now:
                if made is not None:
                    yield now, made
                now, made = conv, Conversation()
            if here:
                made.add(turn, role, text)
    if made is not None:
        yield now, made


def _solver():
    return lru_cache(maxsize=1 << 16)(cheapest_edits)


def audits(df: DataFrame, conv: str, turn: str, role: str, text: str,
           present: Column | None = None) -> DataFrame:
    """One row per conversation: `gaps`, `blank`, `duplicate`, `truncated`,
    `illegal`, `cost`, `audit` (the edits' letters) and `repaired_sha256` (of
    `role:text` of the repaired rows, joined by newlines).  `conv` may have none
    of these names."""
    rows = _in_order(df, conv, turn, role, text, present)
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *[T.StructField(c, T.LongType(), False) for c in COUNTS],
                           T.StructField("audit", T.StringType(), False),
                           T.StructField("repaired_sha256", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve, out, arrow = _solver(), [], None

        def flush():
            names = [f.name for f in schema.fields]
            return pa.RecordBatch.from_pydict(
                {n: pa.array([r[n] for r in out], arrow if n == "conv" else None) for n in names})

        def watched():
            nonlocal arrow
            for b in batches:
                arrow = b.schema.field("conv").type
                yield b

        for name, made in _conversations(watched()):
            found, repaired = made.repair(solve)
            digest, between = hashlib.sha256(), b""
            for _, r, t in repaired:
                digest.update(between + r.encode() + b":")
                digest.update(t.encode())
                between = b"\n"
            out.append(dict(found, conv=name, repaired_sha256=digest.hexdigest()))
            if len(out) >= OUT_ROWS:
                yield flush()
                out.clear()
        if out:
            yield flush()

    return rows.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def repaired_rows(df: DataFrame, conv: str, turn: str, role: str, text: str,
                  present: Column | None = None) -> DataFrame:
    """The rows of the repaired conversations: conversation, `position` (from 0),
    `edit` (K, R or I), `role` and `text`."""
    rows = _in_order(df, conv, turn, role, text, present)
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), T.StructField("position", T.LongType(), False),
                           *[T.StructField(c, T.StringType(), False) for c in ("edit", "role", "text")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve, out, size, arrow = _solver(), [], 0, None

        def flush():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], arrow), *[pa.array(c) for c in cols[1:]]],
                                              names=[f.name for f in schema.fields])

        def watched():
            nonlocal arrow
            for b in batches:
                arrow = b.schema.field("conv").type
                yield b

        for name, made in _conversations(watched()):
            for i, (letter, r, t) in enumerate(made.repair(solve)[1]):
                out.append((name, i, letter, r, t))
                size += len(t)
                if len(out) >= OUT_ROWS or size > HELD_BYTES:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    return rows.mapInArrow(run, schema).withColumnRenamed("conv", conv)
