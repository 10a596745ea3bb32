"""Chat formatting with role repair of least cost.

A conversation is legal if it goes: a system message at most, then user and assistant in
turn, an assistant last. Turns that don't fit are merged with the message before (cost 1),
preceded by an inserted empty message (2) or relabelled (3; 1 if the role is unknown). The
cheapest repair is found by dynamic programming over the automaton of legal turns.

The states are four, so a stretch of turns acts as a 4 x 4 matrix of least costs. A
conversation is cut into chunks of turn numbers; the matrices of its chunks are combined,
which fixes the states at the chunks' borders, and each chunk is then repaired on its own.
However long a conversation, a task holds the turns of one chunk and one matrix per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import stored

CHUNK = 256
MERGE, INSERT, RELABEL, UNKNOWN = 1.0, 2.0, 3.0, 1.0
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
_INF = float("inf")

# What may follow what without repair.
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _moves() -> dict[int, list[tuple[int, int, float, str]]]:
    """For each effective role: (state before, inserted role, cost, kind of join)."""
    out: dict[int, list[tuple[int, int, float, str]]] = {r: [] for r in (SYSTEM, USER, ASSISTANT)}
    for r, moves in out.items():
        for s in range(4):
            if (s, r) in LEGAL:
                moves.append((s, 0, 0.0, "new"))
            elif s == r:
                moves.append((s, 0, MERGE, "merge"))
            else:
                moves += [(s, x, INSERT, "insert") for x in (USER, ASSISTANT) if (s, x) in LEGAL and (x, r) in LEGAL][:1]
    return out


MOVES = _moves()


def _label_costs(role: str | None) -> list[tuple[int, float]]:
    known = (role or "").strip().lower()
    other = RELABEL if known in ROLES[1:] else UNKNOWN
    return [(r, 0.0 if ROLES[r] == known else other) for r in (SYSTEM, USER, ASSISTANT)]


def step(cost: np.ndarray, role: str | None) -> np.ndarray:
    """Least costs after a turn, for each state before the stretch (rows)."""
    new = np.full(cost.shape, _INF)
    for r, label in _label_costs(role):
        for s, _, move, _ in MOVES[r]:
            new[:, r] = np.minimum(new[:, r], cost[:, s] + move + label)
    return new


def matrix(roles: list[str | None]) -> np.ndarray:
    cost = np.where(np.eye(4, dtype=bool), 0.0, _INF)
    for role in roles:
        cost = step(cost, role)
    return cost


def borders(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """States before and after each chunk on the cheapest repair; of equals, the smaller state."""
    value = np.array([0.0, _INF, _INF, _INF])
    came = []
    for m in matrices:
        ways = value[:, None] + m
        came.append(ways.argmin(0))
        value = ways.min(0)
    after = int((value + np.array([0.0, 0.0, INSERT, 0.0])).argmin())
    out = []
    for pick in reversed(came):
        out.append((int(pick[after]), after))
        after = int(pick[after])
    return out[::-1]


def repair(roles: list[str | None], before: int, after: int) -> list[tuple[int, str, int]]:
    """(role, kind of join, inserted role) of each turn on the cheapest way between two states."""
    value = np.full(4, _INF)
    value[before] = 0.0
    came: list[dict[int, tuple[int, str, int]]] = []
    for role in roles:
        new, pick = np.full(4, _INF), {}
        for r, label in _label_costs(role):
            for s, inserted, move, kind in MOVES[r]:
                if value[s] + move + label < new[r]:
                    new[r] = value[s] + move + label
                    pick[r] = (s, kind, inserted)
        came.append(pick)
        value = new
    out = []
    for pick in reversed(came):
        s, kind, inserted = pick[after]
        out.append((after, kind, inserted))
        after = s
    return out[::-1]


def message(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


END = "<|end|>\n"


def rendered(text: str | None, state: int, role: int, kind: str, inserted: int, last: bool) -> str:
    """A turn's piece of the conversation's text; the pieces in order are the whole."""
    body = text or ""
    if kind == "merge":
        out = "\n" + body
    else:
        opening = (END if state != START else "") + (message(inserted) + END if inserted else "")
        out = opening + message(role) + body
    if last:
        out += END + (message(ASSISTANT) + END if role == USER else "")
    return out


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal first columns, from batches in which they stand together."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield key, rows


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _batched(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) >= size:
            yield _table(some, names, kinds)
            some = []
    yield _table(some, names, kinds)


def format_chats(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Repaired and rendered turns of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    One row per distinct turn: ``conv_id``, ``turn``, ``place`` (order among the chunk's
    turns), ``old_role``, ``role``, ``action`` (keep or relabel, and merge or insert where it
    applies), ``inserted`` (role of the empty message before it, if any), ``copies``,
    ``text`` and ``rendered``; a conversation's pieces, by turn and place, make its text.
    Turns stand by number, then role and text; a null number goes last, a null text is empty,
    an unknown or null role is given the cheapest legal one, rows repeated in full are one
    turn. A null conversation id is a conversation of its own. Other columns are not read.
    """
    ids = conversations.schema["conv_id"].dataType
    arrow_id = pa.int64() if ids.simpleString() in ("bigint", "int") else pa.string()
    turns = conversations.select(F.col("conv_id").cast("bigint" if arrow_id == pa.int64() else "string").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    turns = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    turns = stored(turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(2**62))), "turns")
    order = [F.asc_nulls_last(c) for c in ("turn", "role", "text")]
    kind = turns.schema["conv_id"].dataType.simpleString()

    def chunk_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((*key, matrix([r[2] for r in rows]).ravel().tolist()) for key, rows in _runs(batches, 2))
        yield from _batched(found, ["conv_id", "chunk", "costs"], [arrow_id, pa.int64(), pa.list_(pa.float64())])

    dealt = turns.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", *order)
    matrices = dealt.select("conv_id", "chunk", "role").mapInArrow(chunk_matrices, f"conv_id {kind}, chunk bigint, costs array<double>")

    def chunk_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv,), rows in _runs(batches, 1):
                states = borders([np.array(r[2]).reshape(4, 4) for r in rows])
                for n, (row, (before, after)) in enumerate(zip(rows, states, strict=True)):
                    yield conv, row[1], before, after, n == len(rows) - 1

        yield from _batched(found(), ["conv_id", "chunk", "before", "after", "last"], [arrow_id, pa.int64(), pa.int32(), pa.int32(), pa.bool_()])

    states = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    states = stored(states.mapInArrow(chunk_states, f"conv_id {kind}, chunk bigint, before int, after int, last boolean"), "turns")
    s = states.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "before", "after", "last")
    joined = turns.join(s, turns["conv_id"].eqNullSafe(F.col("c")) & (turns["chunk"] == F.col("k")))
    joined = joined.select("conv_id", "chunk", "turn", "role", "text", "copies", "before", "after", "last")
    joined = joined.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", *order)
    names = ["conv_id", "turn", "place", "old_role", "role", "action", "inserted", "copies", "text", "rendered"]
    kinds = [arrow_id, pa.int64(), pa.int32(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 2]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv, _), rows in _runs(batches, 2):
                state, after, last = rows[0][6:9]
                for n, (row, (role, join, inserted)) in enumerate(zip(rows, repair([r[3] for r in rows], state, after), strict=True)):
                    _, _, turn, old, text, copies, *_ = row
                    kept = "keep" if (old or "").strip().lower() == ROLES[role] else "relabel"
                    piece = rendered(text, state, role, join, inserted, last and n == len(rows) - 1)
                    yield conv, turn, n, old, ROLES[role], kept + ("" if join == "new" else f", {join}"), ROLES[inserted] or None, copies, text, piece
                    state = role

        yield from _batched(found(), names, kinds)

    out = joined.mapInArrow(repaired, f"conv_id {kind}, turn bigint, place int, old_role string, role string, action string, inserted string, copies bigint, text string, rendered string")
    return out
