"""Repair of conversations by Knuth's lightest derivation.

An item (i, q) says that the rows from the i-th on can be edited so that what follows state q
is in order.  Edits derive items from items: each adds its cost and puts its letter before
the audit of what it derives from.  Both only grow with (cost, rows derived), so the agenda
pops items in that order and an item is final once it is popped; equal ones go by letter.

Rows are dealt into ranges of (conversation, turn), so a conversation of any length is cut
into pieces of bounded size.  A piece inside one range is repaired at once.  For the others,
each piece tells its costs between all states, they are added up per conversation from its
end, and every piece is then repaired on its own, knowing what comes after it.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import tasks
from skyledger.shared import setting, written

#: A piece has at most so many rows or, but for its last row, characters.
PIECE_ROWS = 2048
PIECE_CHARACTERS = 1 << 18
#: Bytes of text in a range of conversations, about.
TASK_BYTES = 64 << 20

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT = 1, 2, 3
NEVER = 1 << 40

#: Initials of roles as numbers; the last one is any other.
_INITIAL = {"s": 0, "u": 1, "a": 2}
_OTHER = 3
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What leads into each state: the initial it takes and the states it can follow.
_INTO = {
    START: (_OTHER, ()),
    SYSTEM: (0, (START,)),
    USER: (1, (START, SYSTEM, ASSISTANT)),
    ASSISTANT: (2, (USER,)),
}
_ADDED = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Costs from each state at the end of a conversation, and the rows that have to follow.
AT_END = [0, 2 * INSERT_COST, INSERT_COST, 0]
_END_ROWS = [[], [USER, ASSISTANT], [ASSISTANT], []]

_BLANKS = "\t\n\x0b\x0c\r "


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: dropped (``gone``), emptied,
    without ``.!?``, repeated, or given the role user.  A null counts as one space, but
    orders and counts as a null turn.  Other columns are left."""
    name = F.concat_ws(":", _spaced("conv_id"), _spaced("turn"))
    hit = F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("hit")
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), hit,
        _spaced("role").alias("role"), _spaced("text").alias("text"),
    )
    hit = F.col("hit")
    text = (
        F.when(hit.isin(0, 1), "")
        .when(hit == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    copies = F.sequence(F.lit(1), F.when(hit == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (hit == 0).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def lightest(codes: bytes, after: list[int], goals: Iterable[int]) -> dict[int, tuple]:
    """Items and their derivations: item -> (cost, letter, item it derives from).

    ``codes`` has a row's initial, 4 for a row that has to go, 8 for a truncated one;
    ``after`` is what follows from each state after the last row.  Item 4 * i + q.  Ends
    when all ``goals`` (states before the first row) are final.
    """
    n = len(codes)
    agenda = [(cost, 0, "", 4 * n + q, -1) for q, cost in enumerate(after) if cost < NEVER]
    heapq.heapify(agenda)
    final: dict[int, tuple] = {}
    best: dict[int, tuple] = {}
    wanted = set(goals)

    def derive(cost: int, done: int, letter: str, item: int, source: int) -> None:
        key = (cost, done, letter)
        if item not in final and (item not in best or key < best[item]):
            best[item] = key
            heapq.heappush(agenda, (*key, item, source))

    while agenda and wanted:
        cost, done, letter, item, source = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, letter, source)
        i, state = divmod(item, 4)
        if i == 0:
            wanted.discard(state)
        initial, followed = _INTO[state]
        if i < n and state in _ADDED:
            for before in followed:
                derive(cost + INSERT_COST, done, INSERT, 4 * i + before, item)
        if i == 0:
            continue
        row, above = codes[i - 1], 4 * (i - 1)
        derive(cost + DELETE_COST, done + 1, DELETE, above + state, item)
        if row & 4 or state == START:
            continue
        more = TRUNCATED_COST if row & 8 else 0
        if row & 3 == initial:
            for before in followed:
                derive(cost + more, done + 1, KEEP, above + before, item)
        if state in _ADDED:
            for before in followed:
                derive(cost + more + REROLE_COST, done + 1, REROLE, above + before, item)
    return final


def _walk(
    final: dict[int, tuple], entry: int, roles: list[str], texts: list[str]
) -> tuple[str, list[str], int]:
    """Audit, repaired rows and last state of a derivation."""
    audit, lines, item = [], [], entry
    end = 4 * len(roles)
    while item < end:
        _, letter, source = final[item]
        i, state = item // 4, source % 4
        audit.append(letter)
        if letter == KEEP:
            lines.append(f"{roles[i]}:{texts[i]}")
        elif letter == REROLE:
            lines.append(f"{_ADDED[state]}:{texts[i]}")
        elif letter == INSERT:
            lines.append(f"{_ADDED[state]}:")
        item = source
    return "".join(audit), lines, item - end


def _ended(state: int) -> tuple[str, list[str]]:
    rows = _END_ROWS[state]
    return INSERT * len(rows), [f"{_ADDED[q]}:" for q in rows]


class _Piece:
    """Rows of one conversation, one after the other."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = self.size = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = _INITIAL.get(role[:1], _OTHER)
        if self.codes and (self.codes[-1] & 3, initial) not in _LEGAL:
            self.illegal += 1
        must_go = fault in (BLANK_FAULT, DUPLICATE_FAULT)
        self.codes.append(initial | 4 * must_go | 8 * (fault == TRUNCATED_FAULT))
        self.roles.append(role)
        self.texts.append(text)
        self.faults[fault] += 1
        self.size += len(text)
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def result(self) -> dict:
        final = lightest(bytes(self.codes), AT_END, [START])
        audit, lines, state = _walk(final, START, self.roles, self.texts)
        more, added = _ended(state)
        return {
            "gaps": _gaps(self.first_turn, self.last_turn, self.turns),
            "cost": final[START][0],
            "audit": audit + more,
            "repaired_sha256": hashlib.sha256("\n".join(lines + added).encode()).hexdigest(),
        }

    def part(self) -> dict:
        """What the other pieces of the conversation have to know, and its rows."""
        costs = []
        for last in range(4):
            after = [0 if q == last else NEVER for q in range(4)]
            final = lightest(bytes(self.codes), after, range(4))
            costs.append([final[q][0] if q in final else NEVER for q in range(4)])
        return {
            "costs": [costs[last][q] for q in range(4) for last in range(4)],
            "codes": bytes(self.codes),
            "roles": self.roles,
            "texts": self.texts,
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            "turns": self.turns,
        }


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else last - first + 1 - turns


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_RESULT = ["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"]
_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("whole", pa.bool_()),
        *((name, pa.int64()) for name in _COUNTS),
        ("gaps", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
        ("costs", pa.list_(pa.int64())), ("codes", pa.binary()), ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
        ("turns", pa.int64()),
    ]
)
_PIECES_SQL = (
    "conv_id long, part long, seq long, whole boolean, blank long, duplicate long, truncated long,"
    " illegal long, gaps long, cost long, audit string, repaired_sha256 string, costs array<long>,"
    " codes binary, roles array<string>, texts array<string>, first_turn long, last_turn long, turns long"
)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows of a range; those of its first and last conversation, and
    of long ones, are open."""
    context = TaskContext.get()
    part = 0 if context is None else context.partitionId()
    made: list[dict] = []
    piece: _Piece | None = None
    is_open, seq = True, 0

    def close(opened: bool) -> None:
        nonlocal seq
        told = dict(zip(_COUNTS, [*piece.faults[1:], piece.illegal], strict=True))
        made.append(
            {"conv_id": piece.conv_id, "part": part, "seq": seq, "whole": not opened}
            | told
            | (piece.part() if opened else piece.result())
        )
        seq += 1

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_PIECES)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "gone")]
        for conv_id, turn, role, text, fault, gone in zip(*columns, strict=True):
            if piece is None:
                piece = _Piece(conv_id)
            elif piece.conv_id != conv_id:
                close(is_open)
                piece, is_open = _Piece(conv_id), False
            elif len(piece.codes) >= PIECE_ROWS or piece.size >= PIECE_CHARACTERS:
                close(True)
                piece, is_open = _Piece(conv_id), True
            if not gone:
                piece.add(turn, role, text, fault)
            if len(made) >= 500 or (made and "texts" in made[-1]):
                yield batch_of(made)
                made = []
    if piece is not None:
        close(True)
    if made:
        yield batch_of(made)


def _sorted_rows(group: pa.Table) -> list[dict]:
    return sorted(group.to_pylist(), key=lambda row: (row["part"], row["seq"]))


def _backward(group: pa.Table) -> pa.Table:
    """What comes after each piece of a conversation: costs from each state."""
    after, last, told = AT_END, True, []
    for row in reversed(_sorted_rows(group)):
        told.append({"part": row["part"], "seq": row["seq"], "after": after, "last": last})
        costs = np.array(row["costs"]).reshape(4, 4) + np.array(after)
        after, last = np.minimum(costs.min(axis=1), NEVER).tolist(), False
    return pa.Table.from_pylist(told, _AFTER)


_AFTER = pa.schema(
    [("part", pa.int64()), ("seq", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())]
)


def _exits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each piece is left, for each state it may be entered in."""
    for batch in batches:
        states = []
        for codes, after in zip(batch.column("codes"), batch.column("after"), strict=True):
            held = codes.as_py()
            final = lightest(held, after.as_py(), range(4))
            none = [""] * len(held)
            states.append([_walk(final, q, none, none)[2] if q in final else -1 for q in range(4)])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "part", "seq")), pa.array(states, pa.list_(pa.int64()))],
            ["conv_id", "part", "seq", "exits"],
        )


def _forward(group: pa.Table) -> pa.Table:
    state, told = START, []
    for row in _sorted_rows(group):
        told.append({"part": row["part"], "seq": row["seq"], "entry": state})
        state = row["exits"][state]
    kinds = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("entry", pa.int64())])
    return pa.Table.from_pylist(told, kinds)


_SPELT = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()),
        *((name, pa.int64()) for name in _COUNTS),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
        ("first", pa.int64()), ("final", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
        ("lines", pa.string()),
    ]
)
_SPELT_SQL = (
    "conv_id long, part long, seq long, blank long, duplicate long, truncated long, illegal long,"
    " first_turn long, last_turn long, turns long, first long, final long, cost long, audit string,"
    " lines string"
)


def _spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each open piece repaired: its audit and its rows, null if none is left."""
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            codes, entry = row["codes"], row["entry"]
            final = lightest(codes, row["after"], [entry])
            audit, lines, state = _walk(final, entry, row["roles"], row["texts"])
            cost = final[entry][0] - row["after"][state]
            if row["last"]:
                more, added = _ended(state)
                audit, lines, cost = audit + more, lines + added, final[entry][0]
            row |= {
                "first": codes[0] & 3 if codes else None,
                "final": codes[-1] & 3 if codes else None,
                "cost": cost,
                "audit": audit,
                "lines": "\n".join(lines) if lines else None,
            }
            made.append({name: row[name] for name in _SPELT.names})
        yield pa.RecordBatch.from_pylist(made, schema=_SPELT)


def _finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, one conversation after the other, put together as they come."""
    done: dict | None = None

    def told() -> pa.RecordBatch:
        row = {name: done[name] for name in ("conv_id", *_COUNTS, "cost")}
        row["gaps"] = _gaps(done["first_turn"], done["last_turn"], done["turns"])
        row["audit"] = "".join(done["audit"])
        row["repaired_sha256"] = done["sha"].hexdigest()
        return pa.RecordBatch.from_pylist([row], schema=_RESULTS)

    for batch in batches:
        for row in batch.to_pylist():
            if done is None or done["conv_id"] != row["conv_id"]:
                if done is not None:
                    yield told()
                done = dict.fromkeys((*_COUNTS, "cost", "turns"), 0) | {
                    "conv_id": row["conv_id"], "first_turn": None, "last_turn": None, "final": None,
                    "audit": [], "sha": hashlib.sha256(), "any": False,
                }
            for name in (*_COUNTS, "cost", "turns"):
                done[name] += row[name]
            if row["first_turn"] is not None:
                if done["first_turn"] is None:
                    done["first_turn"] = row["first_turn"]
                done["turns"] -= row["first_turn"] == done["last_turn"]
                done["last_turn"] = row["last_turn"]
            if row["first"] is not None:
                met = done["final"] is not None
                done["illegal"] += met and (done["final"], row["first"]) not in _LEGAL
                done["final"] = row["final"]
            done["audit"].append(row["audit"])
            if row["lines"] is not None:
                done["sha"].update(("\n" * done["any"] + row["lines"]).encode())
                done["any"] = True
    if done is not None:
        yield told()


_RESULTS = pa.schema(
    [
        (name, pa.string() if name in ("audit", "repaired_sha256") else pa.int64())
        for name in ("conv_id", *_COUNTS, "cost", "gaps", "audit", "repaired_sha256")
    ]
)
_RESULTS_SQL = ", ".join(
    f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _RESULTS
)


def _with_faults(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Add ``fault``, the first one of each row, and ``key``, which orders rows of one turn
    and role.  A row is a duplicate if its role and text come earlier in the conversation."""
    told = F.struct(F.coalesce(F.col("conv_id"), F.lit(0)), F.col("conv_id").isNull(), "role", "text")
    rows = rows.withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "key": F.xxhash64(told),
            "other": F.xxhash64(F.lit(1), told),
        }
    )
    rows = written(rows, "turns")
    place = F.struct(
        F.col("turn").isNotNull(), F.coalesce(F.col("turn"), F.lit(0)), F.col("row")
    )
    # Partial aggregation leaves one row a task of a text that is everywhere.  Only texts that
    # are there more than once are joined; a hot one's rows are what a skewed join may split.
    firsts = (
        rows.filter(~F.col("gone"))
        .groupBy("key", "other")
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .filter("_times > 1")
        .drop("_times")
    )
    rows = rows.join(firsts, ["key", "other"], "left").drop("other")
    solid = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(solid == "", BLANK_FAULT)
        .when(F.col("_first") != place, DUPLICATE_FAULT)
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), TRUNCATED_FAULT)
        .otherwise(0)
    )
    return rows.withColumn("fault", fault).drop("_first")


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of
    every conversation: the cheapest edits that make its roles ``(s?(ua)+)?``.

    Rows are taken by turn, nulls first, then by role and a hash of the text.  A null role or
    text is one space, a null conv_id one conversation.  A role that starts with none of s, u
    and a, or is empty, cannot be kept.  Rows that a boolean column ``gone`` marks count for
    nothing, but their conversation is told: zeros, an empty audit and the hash of an empty
    text if nothing else is left.  No rows give no rows; other columns are left.
    """
    spark = rows.sparkSession
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    read = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        _spaced("role").alias("role"), _spaced("text").alias("text"), gone.alias("gone"),
    )
    read = _with_faults(read, spark)
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "key", "row")]
    dealt = read.repartitionByRange(max(tasks(spark), size // TASK_BYTES + 1), *order)
    dealt = dealt.sortWithinPartitions(*order)
    pieces = written(dealt.mapInArrow(_cut, _PIECES_SQL), "pieces")
    at_once = pieces.filter("whole").select(*_RESULT)
    # Open pieces hold up to PIECE_CHARACTERS each, so few of them make a batch.
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "64", "10000"):
        opened = pieces.filter("NOT whole")
        after = opened.select("conv_id", "part", "seq", "costs").groupBy("conv_id")
        after = written(
            after.applyInArrow(_backward, "part long, seq long, after array<long>, last boolean"),
            "pieces-after",
        )
        known = opened.join(after, ["part", "seq"])
        exits = known.select("conv_id", "part", "seq", "codes", "after").mapInArrow(
            _exits, "conv_id long, part long, seq long, exits array<long>"
        )
        entries = written(
            exits.groupBy("conv_id").applyInArrow(_forward, "part long, seq long, entry long"),
            "pieces-entry",
        )
        spelt = known.join(entries, ["part", "seq"]).mapInArrow(_spell, _SPELT_SQL)
        # The hash of a conversation runs over its text from first to last, so its pieces
        # end in one task, which holds a few of them at a time.
        ordered = spelt.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
        joined = written(ordered.mapInArrow(_finish, _RESULTS_SQL), "conversations")
    return at_once.unionByName(joined.select(*_RESULT))
