"""Repair of the turn structure of conversations by Hirschberg's divide and conquer.

A conversation is well formed if the first letters of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn. Edits repair it: keep a row, give it
another role, delete it, insert an empty turn. The cheapest edits are a path through four
states (nothing yet, after s, after u, after a), one step a row; of equally cheap ones the
audit, the string of the edits' letters, is to be the least.

The path is found in linear space. Forward cost vectors over the first half of the rows and
backward ones over the second half meet in the middle. Where several states are optimal
there, the one whose least audit comes first is taken; the forward vector carries that order
beside the costs. Both halves are then solved alone, between known states.

The same step over *pieces* of a conversation, each reduced to a matrix of costs from state
to state, solves conversations that are longer than a task should hold: their rows are
range-partitioned, pieces are reduced, the few matrices of a conversation name the states
in which its pieces meet, and each piece is solved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage, null_safe, ship_package, spread

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"  # in ASCII order
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
#: Rows of a conversation that one task solves at once.
LONG = 10_000
FAR = 1 << 40
#: A state that costs so much more than another is on no cheapest path: three edits lead from
#: any state to where another one's path goes on.
HOPELESS = 64
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
_SPACE = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")


def _next(state: int, letter: str) -> int | None:
    """The state after a turn of that first letter, if it may stand there."""
    if letter == "s":
        return SYSTEM if state == START else None
    if letter == "u":
        return USER if state != USER else None
    if letter == "a":
        return ASSISTANT if state == USER else None
    return None


class Kind(NamedTuple):
    """What the repair needs to know of a row: first letter of its role, and its fault."""

    letter: str
    gone: bool
    truncated: bool


def kind_of(letter: str, fault: str | None) -> Kind:
    must_go = fault in (BLANK, DUPLICATE)
    return Kind("" if must_go or letter not in ("s", "u", "a") else letter, must_go, fault == TRUNCATED)


#: Every kind of row; a row's kind is stored as its place in this list.
KINDS = [Kind("", True, False), *(Kind(a, False, b) for a in ("", "s", "u", "a") for b in (False, True))]
_PLACE = {kind: k for k, kind in enumerate(KINDS)}


def kind_code(letter: str, fault: str | None) -> int:
    return _PLACE[kind_of(letter, fault)]


class Piece(NamedTuple):
    """Rows in a row: least cost from state to state, and the order of the audits by end state."""

    cost: tuple[tuple[int, ...], ...]
    order: tuple[tuple[int, ...], ...]


def _edits(kind: Kind, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, audit and state after one row from a state, with inserts before it."""
    cost, audit = 0, ""
    for _ in range(4):  # two inserts reach every state; more come back to one
        yield cost + DELETE_COST, audit + DELETE, state
        if not kind.gone:
            extra = TRUNCATED_COST if kind.truncated else 0
            after = _next(state, kind.letter)
            if after is not None:
                yield cost + KEEP_COST + extra, audit + KEEP, after
            yield cost + REROLE_COST + extra, audit + REROLE, ASSISTANT if state == USER else USER
        cost, audit, state = cost + INSERT_COST, audit + INSERT, ASSISTANT if state == USER else USER


def _ranked(keys: list) -> tuple[int, ...]:
    place = {key: k for k, key in enumerate(sorted(set(keys)))}
    return tuple(place[key] for key in keys)


def _row_table(kind: Kind) -> tuple[Piece, tuple[tuple[str, ...], ...]]:
    costs, orders, audits = [], [], []
    for state in STATES:
        best = [(FAR, "~")] * 4
        for cost, audit, after in _edits(kind, state):
            best[after] = min(best[after], (cost, audit))
        costs.append(tuple(c for c, _ in best))
        audits.append(tuple(a for _, a in best))
        orders.append(_ranked([a for _, a in best]))
    return Piece(tuple(costs), tuple(orders)), tuple(audits)


_ROWS = [_row_table(kind) for kind in KINDS]
#: Inserts that end a conversation well from each state: least cost and audit.
TAIL = tuple({START: (0, ""), SYSTEM: (2 * INSERT_COST, INSERT * 2), USER: (INSERT_COST, INSERT), ASSISTANT: (0, "")}[s] for s in STATES)


class Front(NamedTuple):
    """Least cost to reach each state, and the order of the least audits that do.

    Audits of one front cover the same rows and end with a row's letter, so none begins
    another and their order decides whatever follows.
    """

    cost: tuple[int, ...]
    order: tuple[int, ...]


def front_at(state: int) -> Front:
    return Front(tuple(0 if s == state else FAR for s in STATES), (0,) * 4)


def advance(front: Front, piece: Piece) -> Front:
    cost, order = [], []
    for after in STATES:
        best = min((front.cost[s] + piece.cost[s][after], front.order[s], s) for s in STATES)
        cost.append(min(best[0], FAR))
        order.append((best[0] >= FAR, best[1], piece.order[best[2]][after]))
    return Front(tuple(cost), _ranked(order))


def retreat(back: tuple[int, ...], piece: Piece) -> tuple[int, ...]:
    """Least cost from each state before a piece to the end, from that after it."""
    return tuple(min(FAR, min(piece.cost[s][t] + back[t] for t in STATES)) for s in STATES)


@lru_cache(maxsize=100_000)
def _advance_row(front: Front, code: int) -> tuple[int, Front]:
    """``advance`` over one row; costs come back less their least, which is given beside."""
    after = advance(front, _ROWS[code][0])
    low = min(after.cost)
    return low, Front(tuple(c - low if c - low <= HOPELESS else FAR for c in after.cost), after.order)


@lru_cache(maxsize=100_000)
def _retreat_row(back: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    before = retreat(back, _ROWS[code][0])
    low = min(before)
    return low, tuple(c - low if c < FAR else FAR for c in before)


def _forward(codes: np.ndarray, low: int, high: int, state: int) -> tuple[int, Front]:
    total, front = 0, front_at(state)
    for code in codes[low:high].tolist():
        more, front = _advance_row(front, code)
        total += more
    return total, front


def _backward(codes: np.ndarray, low: int, high: int, back: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    total = 0
    for code in codes[low:high][::-1].tolist():
        more, back = _retreat_row(back, code)
        total += more
    return total, back


def crossing(front: Front, back: tuple[int, ...]) -> int:
    """The state in which the cheapest path of the least audit meets."""
    return min(STATES, key=lambda s: (front.cost[s] + back[s], front.order[s]))


def solve(codes: np.ndarray, start: int, back: tuple[int, ...]) -> tuple[int, int, list[str]]:
    """Cost, end state and the letters of each row, from ``start`` to an end of cost ``back``.

    Letters of a row are the inserts before it and its own edit. Space is linear in the
    rows: cost vectors are kept for the two halves at hand only.
    """
    letters = [""] * len(codes)
    n = len(codes)
    if n == 0:
        return back[start], start, letters
    total, front = _forward(codes, 0, n, start)
    end = crossing(front, back)
    cost = total + front.cost[end] + back[end]
    todo = [(0, n, start, end)]
    while todo:
        low, high, first, last = todo.pop()
        if high - low == 1:
            letters[low] = _ROWS[codes[low]][1][first][last]
            continue
        middle = (low + high) // 2
        _, front = _forward(codes, low, middle, first)
        _, behind = _backward(codes, middle, high, tuple(0 if s == last else FAR for s in STATES))
        meet = crossing(front, behind)
        todo += [(low, middle, first, meet), (middle, high, meet, last)]
    return cost, end, letters


def piece_of(codes: np.ndarray) -> Piece:
    """The rows reduced to least costs from state to state and the order of their audits."""
    costs, orders = [], []
    for state in STATES:
        total, front = _forward(codes, 0, len(codes), state)
        costs.append(tuple(min(FAR, total + c) for c in front.cost))
        orders.append(front.order)
    return Piece(tuple(costs), tuple(orders))


def meet(pieces: list[Piece]) -> list[tuple[int, int]]:
    """The states before and after each of a conversation's pieces."""
    backs = [tuple(c for c, _ in TAIL)]
    for piece in reversed(pieces):
        backs.append(retreat(backs[-1], piece))
    backs.reverse()
    out, state = [], START
    for piece, back in zip(pieces, backs[1:], strict=True):
        after = crossing(advance(front_at(state), piece), back)
        out.append((state, after))
        state = after
    return out


def turns_of(state: int, letters: str, role: str, text: str) -> tuple[int, list[tuple[str, str, str]]]:
    """The state after a row's letters, and (letter, role, text) of each; deleted rows as they were."""
    out = []
    for letter in letters:
        if letter == DELETE:
            out.append((letter, role, text))
            continue
        if letter == KEEP:
            state = _next(state, role[:1])
            out.append((letter, role, text))
            continue
        state = ASSISTANT if state == USER else USER
        out.append((letter, ROLES[state], "" if letter == INSERT else text))
    return state, out


def faults(role_texts: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each row of a conversation, in order."""
    seen, out = set(), []
    for role, text in role_texts:
        words = text.strip(_SPACE)
        if not words:
            out.append(BLANK)
        elif (role, text) in seen:
            out.append(DUPLICATE)
        else:
            out.append(None if words.endswith(_ENDS) else TRUNCATED)
        seen.add((role, text))
    return out


EDITS = (
    "conv_id long, step long, edit string, turn long, role_before string, fault string, role string, text string, "
    "cost long"
)
_EDIT_COST = {KEEP: KEEP_COST, REROLE: REROLE_COST, DELETE: DELETE_COST, INSERT: INSERT_COST}


class _Edits:
    """Edit rows of a partition, given out some at a time."""

    SCHEMA = pa.schema([
        ("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role_before", pa.string()),
        ("fault", pa.string()), ("role", pa.string()), ("text", pa.string()), ("cost", pa.int64()),
    ])
    BYTES = 4_000_000

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in self.SCHEMA]
        self.size = 0

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.size += 100 + len(row[7] or "")

    def row(self, conv_id, step, turn, role, fault, turns) -> int:
        """The edits of one row, inserts before it included; the next step."""
        for letter, new_role, text in turns:
            if letter == INSERT:
                self.add(conv_id, step, INSERT, None, None, None, new_role, text, INSERT_COST)
            else:
                extra = TRUNCATED_COST if fault == TRUNCATED and letter != DELETE else 0
                self.add(conv_id, step, letter, turn, role, fault, new_role, text, _EDIT_COST[letter] + extra)
            step += 1
        return step

    def nothing(self, conv_id) -> None:
        self.add(conv_id, 0, None, None, None, None, None, None, 0)

    def full(self) -> bool:
        return self.size >= self.BYTES

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.SCHEMA, strict=True)], schema=self.SCHEMA)
        self.__init__()
        return out


def _groups(batches: Iterator[pa.RecordBatch], columns: int = 1) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Runs of rows that agree in the first columns, of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    value = None
    for batch in batches:
        keys = list(zip(*(c.to_pylist() for c in batch.columns[:columns]), strict=True))
        at = 0
        while at < len(keys):
            to = at + 1
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            if held and value != keys[at]:
                yield value, held
                held = []
            value = keys[at]
            held.append(batch.slice(at, to - at))
            at = to
    if held:
        yield value, held


def _rows(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edit rows of whole conversations: (conv_id, turn, role, text, copies) sorted by all."""
    out = _Edits()
    for (conv_id,), parts in _groups(batches):
        rows = [(turn, role, text) for _, turn, role, text, copies in _rows(parts) for _ in range(copies)]
        found = faults([r[1:] for r in rows])
        codes = np.array([kind_code(r[1][:1], f) for r, f in zip(rows, found, strict=True)], dtype=np.uint8)
        _, end, letters = solve(codes, START, tuple(c for c, _ in TAIL))
        state, step = START, 0
        for (turn, role, text), fault, some in zip(rows, found, letters, strict=True):
            state, turns = turns_of(state, some, role, text)
            step = out.row(conv_id, step, turn, role, fault, turns)
        _, turns = turns_of(end, TAIL[end][1], "", "")
        out.row(conv_id, step, None, None, None, turns)
        if not rows:
            out.nothing(conv_id)
        if out.full():
            yield out.batch()
    yield out.batch()


def _first_letter(role: Column) -> Column:
    return F.substring(role, 1, 1)


def _solve_long(rows: DataFrame) -> DataFrame:
    """Edit rows of long conversations, none of which is held by one task.

    ``rows`` has conv_id, turn, role, text and copies, equal rows as one.
    """
    parts = spread(rows)
    order = ["conv_id", "turn", "role", "text"]
    nulls_first = [F.col(c).asc_nulls_first() for c in order]
    rows = rows.where("copies > 0")
    same = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("th")).agg(
        F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("first")
    )
    hashed = rows.withColumn("th", F.sha2("text", 256))
    marked = hashed.join(same.toDF("conv2", "role2", "th2", "first"), F.col("conv_id").eqNullSafe(F.col("conv2"))
                         & (F.col("role") == F.col("role2")) & (F.col("th") == F.col("th2")))
    words = F.btrim("text", F.lit(_SPACE))
    fault = (
        F.when(words == "", BLANK)
        .when(F.struct(F.col("turn").isNotNull(), F.col("turn")) != F.col("first"), DUPLICATE)
        .when(~F.substring(words, -1, 1).isin(*_ENDS), TRUNCATED)
    )
    placed = cut_lineage(
        marked.select(*order, "copies", fault.alias("fault")).repartitionByRange(parts, *nulls_first)
        .sortWithinPartitions(*nulls_first)
        .select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("place"))
    )
    # A row that its copies follow is one row with its own fault, the copies are duplicates or blank.
    lean = placed.select("conv_id", "piece", "place", _first_letter(F.col("role")).alias("letter"), "fault", "copies")
    keys = ["conv_id", "piece"]

    def in_order(df: DataFrame, *more: str) -> DataFrame:
        return df.repartition(parts, *keys).sortWithinPartitions(*keys, *more)

    def codes_of(group: list[tuple]) -> np.ndarray:
        runs = [(kind_code(r[3], r[4]), r[5]) for r in group]
        codes = np.repeat(np.array([c for c, _ in runs], np.uint8), [k for _, k in runs])
        again = kind_code("", DUPLICATE)
        firsts = np.cumsum([0, *[k for _, k in runs][:-1]])
        others = np.ones(len(codes), dtype=bool)
        others[firsts] = False
        codes[others] = again
        return codes

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv_id, piece), found in _groups(batches, 2):
            found = piece_of(codes_of(list(_rows(found))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv_id], pa.int64()), pa.array([piece], pa.int32()),
                 pa.array([[x for row in found.cost for x in row]], pa.list_(pa.int64())),
                 pa.array([[x for row in found.order for x in row]], pa.list_(pa.int64()))],
                ["conv_id", "piece", "cost", "order"],
            )

    reduced = in_order(lean, "place").mapInArrow(reduce, "conv_id long, piece int, cost array<long>, order array<long>")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = lambda flat: tuple(tuple(flat[4 * s : 4 * s + 4]) for s in STATES)
        for (conv_id,), found in _groups(batches):
            rows = list(_rows(found))
            states = meet([Piece(fold(r[2]), fold(r[3])) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv_id] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([a for a, _ in states], pa.int32()), pa.array([b for _, b in states], pa.int32()),
                 pa.array([k == len(rows) - 1 for k in range(len(rows))])],
                ["conv_id", "piece", "before", "after", "last"],
            )

    # A conversation has no more pieces than the range shuffle has partitions.
    states = cut_lineage(
        reduced.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
        .mapInArrow(join, "conv_id long, piece int, before int, after int, last boolean")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _groups(batches, 2):
            group = list(_rows(found))
            before, after, last = group[0][6:]
            codes = codes_of(group)
            _, end, letters = solve(codes, before, tuple(0 if s == after else FAR for s in STATES))
            at, state, places, entry, edits = 0, before, [], [], []
            for row in group:
                some = letters[at : at + row[5]]
                places.append(row[2])
                entry.append(state)
                edits.append("".join(some))
                # Only the first of equal rows can be anything but deleted.
                state, _ = turns_of(state, some[0], row[3], "")
                at += row[5]
            if last:
                edits[-1] += TAIL[end][1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(entry, pa.int32()), pa.array(edits)], ["at", "entry", "letters"]
            )

    dealt = lean.join(states.toDF("conv2", "piece2", "before", "after", "last"),
                      F.col("conv_id").eqNullSafe(F.col("conv2")) & (F.col("piece") == F.col("piece2")))
    solved = in_order(dealt.select(*lean.columns, "before", "after", "last"), "place").mapInArrow(
        finish, "at long, entry int, letters string"
    )
    whole = placed.join(solved, F.col("place") == F.col("at")).select(
        "conv_id", "place", "turn", "role", "text", "fault", "entry", "letters"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Edits()
        conv_id, step = object(), 0
        for batch in batches:
            for conv, _, turn, role, text, fault, entry, letters in _rows([batch]):
                if conv != conv_id:
                    conv_id, step = conv, 0
                state, first = entry, True
                for letter in letters:
                    state, turns = turns_of(state, letter, role, text)
                    step = out.row(conv, step, turn, role, fault if first or fault == BLANK else DUPLICATE, turns)
                    first = first and letter == INSERT
                    if out.full():
                        yield out.batch()
        yield out.batch()

    # One task writes a conversation, row by row; the sort spills.
    return whole.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(write, EDITS)


def repair_edits(rows: DataFrame, long: int = LONG) -> DataFrame:
    """The cheapest repair of every conversation, one row an edit, sorted inside partitions.

    ``rows`` has conv_id, turn, role and text, and may have copies (how often a row stands
    there; 0 for a row that only names its conversation). Rows follow each other by turn, null
    first, ties by role and text. conv_id, step (from 0), edit (D, I, K or R), turn,
    role_before and fault of the row (null for an insert), role and text after the edit, and
    its cost. A row's first fault counts: blank, duplicate (role and text came earlier),
    truncated. A conversation without rows has one row with a null edit. All of a
    conversation's edits are in one partition, in order.

    A null role or text is one space; rows without conv_id are one conversation. Roles count
    by their first letter; other letters than s, u and a stand nowhere. Repeated rows follow
    each other. Other columns play no part. An empty table gives an empty table.
    Conversations of more than ``long`` rows are solved in pieces, with the same result.
    """
    ship_package(rows.sparkSession)
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    blank = lambda c: F.coalesce(c, F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), blank("role"), blank("text"), copies.alias("copies"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    crowded = cut_lineage(
        rows.groupBy("conv_id").agg(F.sum("copies").alias("n")).where(F.col("n") > long).select("conv_id")
    )
    whole, any_long = rows, not crowded.isEmpty()
    if any_long:
        whole = rows.join(crowded, null_safe(rows, crowded, ["conv_id"]), "left_anti")
    solved = whole.repartition(spread(rows), "conv_id").sortWithinPartitions(*order).mapInArrow(_solve_whole, EDITS)
    if not any_long:
        return solved
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("int").alias("copies"))
    return solved.unionByName(_solve_long(equal.join(crowded, null_safe(equal, crowded, ["conv_id"]), "left_semi")))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults that follow from the CRC-32 of ``conv_id:turn``, for ``repair_edits``.

    Modulo 20: 0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets
    the role user. Nulls of any column count as one space.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))), F.lit(20))
    text = said("text")
    return rows.select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(said("role")).alias("role"),
        F.when(draw.isin(0, 1), "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )


DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its edits in order; no text is held."""
    rows: list[tuple] = []

    def close() -> None:
        low, high, distinct = span
        gaps = 0 if low is None else high - low + 1 - distinct
        rows.append((conv, gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost, "".join(audit), digest.hexdigest()))

    names = [part.split()[0] for part in DIGEST.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    started = False
    for batch in batches:
        for conv_id, step, edit, turn, role_before, fault, role, text, paid in _rows([batch]):
            if step == 0:
                if started:
                    close()
                started, conv = True, conv_id
                span, counts = (None, None, 0), {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
                illegal, cost, audit, digest, previous, turns = 0, 0, [], hashlib.sha256(), None, 0
            if edit is None:
                continue
            audit.append(edit)
            cost += paid
            if fault is not None:
                counts[fault] += 1
            if role_before is not None:
                if previous is not None:
                    illegal += previous + role_before[:1] not in ("su", "ua", "au")
                previous = role_before[:1]
                if turn is not None:  # turns ascend
                    low, high, distinct = span
                    span = (turn if low is None else low, turn, distinct + (turn != high))
            if edit != DELETE:
                digest.update(f"{chr(10) if turns else ''}{role}:{text}".encode())
                turns += 1
        if len(rows) > 10_000:
            yield out()
            rows.clear()
    if started:
        close()
    yield out()


def repair_digest(rows: DataFrame, long: int = LONG) -> DataFrame:
    """Faults, cost, audit and hash of the repaired turns of every conversation, after damage."""
    return repair_edits(damaged(rows), long).mapInArrow(_digest, DIGEST)
