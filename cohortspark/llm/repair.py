"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate, found by a
dynamic programme whose weights are whole numbers.

A weight's high digits are the cost; its low digits have a fixed number of places and hold the letters of the edits in
order, zeros after the last.  So the smallest weight is the cheapest audit, and of equally cheap audits the one that
comes first as text: nothing but a minimum of whole numbers decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import unused

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
LETTERS = "DIKR"  # in text order; their digits are 1 to 4, and 0 stands after the last
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
BITS = 3

#: States of ``(s?(ua)+)?``: what came last.  ``MOVES`` gives the state after a role; an end may follow ``ENDS``.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}

#: Faults of a row, and the characters that no word has.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACES = " \t\n\v\f\r"
STOPS = ".!?"


def cheapest(initials: str, faults: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation, of equally cheap ones the audit that is first as text.

    Rows are taken from the last to the first; ``best[q]`` is the weight of the cheapest way from state ``q`` before the
    row to a permitted end.  Putting a letter in front moves the others one place down: their last place is always
    empty, since no cheapest way has so many edits.  Work grows with the square of the number of rows.
    """
    # a way that only deletes costs 4 a row and at most two insertions, so no best one has more than this
    places = (7 * len(initials)) // 3 + 8
    low = BITS * places
    mask = (1 << low) - 1
    digit = {c: (i + 1) << (low - BITS) for i, c in enumerate(LETTERS)}

    def before(letter: str, cost: int, weight: int | None) -> int | None:
        if weight is None:
            return None
        return (((weight >> low) + cost) << low) | digit[letter] | ((weight & mask) >> BITS)

    def least(*weights: int | None) -> int | None:
        return min((w for w in weights if w is not None), default=None)

    def with_inserts(best: list[int | None]) -> list[int | None]:
        """One or two rows may be put in; more would lead back to where they began."""
        for _ in range(2):
            best = [
                least(best[q], *(before(INSERT, INSERT_COST, best[to]) for role, to in MOVES[q].items() if role in ROLES))
                for q in range(len(MOVES))
            ]
        return best

    best = with_inserts([0 if q in ENDS else None for q in range(len(MOVES))])
    for initial, fault in zip(reversed(initials), reversed(faults)):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        must_go = fault in (BLANK, DUPLICATE)
        now = []
        for q in range(len(MOVES)):
            ways = [before(DELETE, DELETE_COST, best[q])]
            if not must_go:
                if initial in MOVES[q]:
                    ways.append(before(KEEP, extra, best[MOVES[q][initial]]))
                ways += [before(REROLE, REROLE_COST + extra, best[to]) for role, to in MOVES[q].items() if role in ROLES]
            now.append(least(*ways))
        best = with_inserts(now)
    weight = best[START]
    audit = []
    for place in range(places):
        d = weight >> (low - BITS * (place + 1)) & (1 << BITS) - 1
        if not d:
            break
        audit.append(LETTERS[d - 1])
    return weight >> low, "".join(audit)


_short = lru_cache(maxsize=100_000)(cheapest)  # of conversations up to ``SHORT`` rows
SHORT = 64


def repaired(rows: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The rows (role, text) after the edits.  Where a role is put in or changed, the state leaves one choice."""
    state, at = START, 0
    for letter in audit:
        if letter == DELETE:
            at += 1
            continue
        role, text = ("", "") if letter == INSERT else rows[at]
        at += letter != INSERT
        if letter != KEEP:
            initial = next(r for r in MOVES[state] if r in ROLES)
            role = ROLES[initial]
        state = MOVES[state][role[:1]]
        yield role, text


def faults_of(rows: list[tuple[str, str]]) -> bytes:
    """The first fault of each row (role, text): blank, duplicate (role and text were seen earlier), truncated."""
    seen: set[bytes] = set()
    faults = bytearray()
    for role, text in rows:
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        rest = text.rstrip(SPACES)
        ended = rest[-1:] in (*STOPS,)
        faults.append(BLANK if not rest else DUPLICATE if mark in seen else FINE if ended else TRUNCATED)
        seen.add(mark)
    return bytes(faults)


def repair(rows: list[tuple[int | None, str, str]]) -> dict:
    """Report and repair of one conversation, given as rows (turn, role, text) in order."""
    told = [(role, text) for _, role, text in rows]
    faults = faults_of(told)
    initials = [role[:1] for role, _ in told]
    turns = {t for t, _, _ in rows if t is not None}
    code = "".join(i if i in ("s", "u", "a") else "-" for i in initials)
    cost, audit = (_short if len(rows) <= SHORT else cheapest)(code, faults)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "turns": [{"role": r, "text": t} for r, t in repaired(told, audit)],
    }


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
OUTPUT = (
    "conv_id bigint, " + ", ".join(f"{n} bigint" for n in _NUMBERS) + ", audit string, turns array<struct<role:string,text:string>>"
)
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_YIELD = 4 << 20  # characters of text that are passed on at once
_NONE = object()  # before the first conversation; None is one


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs of conversations whose rows come one after the other; one conversation is held at a time."""
    made: list[dict] = []
    size = 0

    def out() -> pa.RecordBatch:
        columns = {"conv_id": pa.array([m["conv_id"] for m in made], pa.int64())}
        columns |= {n: pa.array([m[n] for m in made], pa.int64()) for n in _NUMBERS}
        columns |= {"audit": pa.array([m["audit"] for m in made], pa.string()), "turns": pa.array([m["turns"] for m in made], _TURNS)}
        return pa.RecordBatch.from_pydict(columns)

    held: list[tuple] = []
    current: object = _NONE
    for batch in batches:
        for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if conv != current:
                if current is not _NONE:
                    made.append({"conv_id": current, **repair(held)})
                if size >= _YIELD or len(made) >= 5_000:
                    yield out()
                    made, size = [], 0
                current, held = conv, []
            if role is not None:  # a row without a role only says that the conversation exists
                held.append((turn, role, text))
                size += len(text)
    if current is not _NONE:
        made.append({"conv_id": current, **repair(held)})
    yield out()


def repair_conversations(
    rows: DataFrame,
    conversations: DataFrame | None = None,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    null: str = " ",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps`` (missing turn numbers), ``blank``, ``duplicate``, ``truncated``,
    ``illegal`` (neighbours that may not follow each other), ``cost``, ``audit`` and the repaired ``turns``.

    ``conversations`` (distinct ids) adds those that have no rows: zeros, an empty audit and no turns.  Rows go by turn
    (nulls first), then role and text.  A null role or text is ``null``.  Rows without an id are one conversation.  Other
    columns are not read; an empty table gives an empty result.  One shuffle by conversation; a task sorts its rows on
    disk and holds the rows of one conversation at a time, whose audit and repaired text are one row anyway.
    """
    told = rows.select(
        F.col(conv_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit(null)).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit(null)).alias("text"),
    )
    if conversations is not None:
        none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "bigint"), ("role", "string"), ("text", "string"))]
        told = told.unionByName(conversations.select(F.col(conv_column).cast("bigint").alias("conv_id"), *none))
    ordered = told.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_repairs, OUTPUT)


def damaged(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20, for tests of a repair: 0 drops the row, 1 empties its text, 2
    removes its sentence ends, 3 repeats it, 4 makes its role ``user``.  Nulls (ids, turns, roles, texts) are one space."""

    def told(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = unused(rows, "_kind")
    out = rows.withColumn(kind, F.crc32(F.concat(told(conv_column), F.lit(":"), told(turn_column)).cast("binary")) % 20)
    text = told(text_column)
    text = F.when(F.col(kind) == 1, "").when(F.col(kind) == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text)
    role = F.when(F.col(kind) == 4, "user").otherwise(told(role_column))
    out = out.filter(F.col(kind) != 0).withColumns({text_column: text, role_column: role})
    copies = F.when(F.col(kind) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn(kind, F.explode(copies)).drop(kind)
