"""Conversations with broken turns, mended by the cheapest edits.

A repaired conversation has role initials ``(s?(ua)+)?``. Its rows and the four
states of that pattern span a lattice: keeping a row is free, a new role costs 3, an
inserted empty turn 3, a deletion 4, and an unfinished text that stays 3 more; blank
and repeated rows have to go. A forward and a reverse heap search the lattice until
they meet, go on while other crossings may cost the same, and of all crossings the
least string of edits is taken.

Conversations are sorted by range, so a very long one lies in several tasks. There it
is cut into segments, each solved for all states it may begin and end in, and the
segments' answers are put together in order. Texts do not take part in this; they
meet the edits in one sorted pass that holds a batch at a time.

Nulls and extras: a null role or text counts as one space, a null conversation id is a
conversation of its own, null turns come first; rows of one turn are taken by role,
then by a digest of role and text, repeats next to each other; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.llm.land import land

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
NEW_ROLE = INSERTED = UNFINISHED = 3
DELETED = 4
#: Rows of a conversation that are solved at once where it is cut.
SEGMENT_ROWS = 512

#: States: nothing yet, after the system turn, after a user turn, after an answer.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: What a new or inserted turn has to be in each state.
_MADE = ("u", "u", "a", "u")
_ROLES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)

_WORD = "[^\\x20\\x09-\\x0D]"


# The lattice


def _edges(symbol: str, state: int) -> Iterator[tuple[int, int, str]]:
    """``(state after, cost, edit)`` that take one row.

    Symbols: the role's initial or ``o``, capital for an unfinished text, ``x`` for a
    row that has to go.
    """
    yield state, DELETED, DELETE
    if symbol == "x":
        return
    more = UNFINISHED if symbol.isupper() else 0
    kept = _NEXT[state].get(symbol.lower())
    if kept is not None:
        yield kept, more, KEEP
    yield _NEXT[state][_MADE[state]], NEW_ROLE + more, REROLE


_BACK = {
    symbol: [[(q, cost, edit) for q in range(4) for to, cost, edit in _edges(symbol, q) if to == p] for p in range(4)]
    for symbol in "suaoSUAOx"
}
_AHEAD = {symbol: [list(_edges(symbol, q)) for q in range(4)] for symbol in _BACK}
_MADE_NEXT = [_NEXT[q][_MADE[q]] for q in range(4)]
_MADE_BACK = [[q for q in range(4) if _MADE_NEXT[q] == p] for p in range(4)]


def _successors(symbols: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    at, state = node
    if at < len(symbols):
        for to, cost, edit in _AHEAD[symbols[at]][state]:
            yield (at + 1, to), cost, edit
    yield (at, _MADE_NEXT[state]), INSERTED, INSERT


def _predecessors(symbols: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    at, state = node
    if at:
        for q, cost, edit in _BACK[symbols[at - 1]][state]:
            yield (at - 1, q), cost, edit
    for q in _MADE_BACK[state]:
        yield (at, q), INSERTED, INSERT


@lru_cache(maxsize=1 << 15)
def cheapest(symbols: str, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Least cost and, of its edits, the least string from ``start`` to one of ``ends``.

    A node is settled when it leaves its heap. Free edges only lead on by a row, so
    with the row next to the cost in the heap all equal ways into a node are seen
    before it is settled, on both sides. Every cheapest way has an edge from a node
    settled forward to one settled in reverse once the tops sum to more than its cost.
    """
    n = len(symbols)
    far = float("inf")
    ahead: dict = {(0, start): (0, "")}
    back: dict = {(n, q): (0, "") for q in ends}
    done_ahead: dict = {}
    done_back: dict = {}
    heap_ahead: list = [(0, 0, (0, start))]
    heap_back: list = [(0, -n, (n, q)) for q in ends]
    best = far

    def settle(reverse: bool) -> None:
        nonlocal best
        heap, labels, done, other = (
            (heap_back, back, done_back, done_ahead) if reverse else (heap_ahead, ahead, done_ahead, done_back)
        )
        _, _, node = heappop(heap)
        if node in done:
            return
        cost, audit = done[node] = labels[node]
        if node in other:
            best = min(best, cost + other[node][0])
        for to, more, edit in (_predecessors if reverse else _successors)(symbols, node):
            if to in other:
                best = min(best, cost + more + other[to][0])
            if to not in done:
                label = (cost + more, edit + audit if reverse else audit + edit)
                if to not in labels or label < labels[to]:
                    labels[to] = label
                    heappush(heap, (label[0], -to[0] if reverse else to[0], to))

    for _ in ends:
        settle(True)
    turn = False
    while heap_ahead and heap_ahead[0][0] + (heap_back[0][0] if heap_back else 0) <= best:
        if turn and not heap_back:
            turn = False
        settle(turn)
        turn = not turn
    if best == far:
        return None
    crossings = []
    for node, (cost, audit) in done_ahead.items():
        if node in done_back and cost + done_back[node][0] == best:
            crossings.append(audit + done_back[node][1])
        for to, more, edit in _successors(symbols, node):
            if to in done_back and cost + more + done_back[to][0] == best:
                crossings.append(audit + edit + done_back[to][1])
    return best, min(crossings)


def join_segments(parts: Iterator[list[tuple[int, str] | None]]) -> tuple[int, str]:
    """The whole answer from the sixteen answers, by states before and after, of each segment."""
    held: dict[int, tuple[int, str]] = {0: (0, "")}
    for part in parts:
        now: dict[int, tuple[int, str]] = {}
        for q, (cost, audit) in held.items():
            for p in range(4):
                step = part[4 * q + p]
                if step is not None:
                    label = (cost + step[0], audit + step[1])
                    if p not in now or label < now[p]:
                        now[p] = label
        held = now
    return min(held[p] for p in ENDS if p in held)


# Rows


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, conv_id, turn, role, text, same`` of any conversations."""
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("conv"),
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return rows.withColumn("same", same)


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows of each conversation with their number ``n``, whether the first of
    them is the first with its role and text, and the faults of the text alone."""
    last = F.regexp_extract("text", f"({_WORD})[\\x20\\x09-\\x0D]*\\z", 1)
    slim = rows.select(
        "conv", "conv_id", "turn", "same",
        F.substring("role", 1, 1).alias("initial"),
        F.col("role"),
        (~F.col("text").rlike(_WORD)).alias("blank"),
        (~last.isin(".", "!", "?")).alias("unfinished"),
    )
    keys = ["conv", "conv_id", "turn", "same", "initial", "role", "blank", "unfinished"]
    distinct = slim.groupBy(*keys).agg(F.count("*").alias("n"))
    distinct = land(distinct.withColumn("_turn", F.coalesce(F.col("turn").cast("string"), F.lit(""))), "turns")
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("low")
    firsts = distinct.groupBy("conv", "same").agg(earliest).select(
        "conv", "same", F.coalesce(F.col("low.turn").cast("string"), F.lit("")).alias("_turn"), F.lit(True).alias("new")
    )
    return distinct.join(firsts, ["conv", "same", "_turn"], "left").drop("_turn")


_SEGMENT = (
    "part int, place long, whole boolean, n long, blank long, duplicate long, truncated long, illegal long, "
    "initials array<string>, low long, high long, turns long, first long, last long, "
    "costs array<long>, audits array<string>"
)


class _Segment:
    """Consecutive rows of one conversation, counted."""

    def __init__(self, conv: str, conv_id, start: bool) -> None:
        self.conv, self.conv_id, self.start = conv, conv_id, start
        self.symbols: list[str] = []
        self.initials: list[str] = []
        self.turns: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.known = 0

    def add(self, turn, initial: str, blank: bool, unfinished: bool, new: bool) -> None:
        if self.initials and self.initials[-1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initials.append(initial)
        if turn is not None:
            self.turns.append(turn)
            self.known += len(self.turns) == 1 or turn != self.turns[-2]
        if blank or not new:
            self.blank += blank
            self.duplicate += not blank
            self.symbols.append("x")
        else:
            symbol = initial if initial and initial in "sua" else "o"
            self.truncated += unfinished
            self.symbols.append(symbol.upper() if unfinished else symbol)

    def row(self, part: int, place: int, whole: bool) -> tuple:
        symbols = "".join(self.symbols)
        if whole:
            answers = [cheapest(symbols)]
        else:
            answers = [cheapest(symbols, q, (p,)) for q in range(4) for p in range(4)]
        some = self.turns
        return (
            self.conv, self.conv_id, part, place, whole, len(symbols), self.blank, self.duplicate, self.truncated,
            self.illegal, [self.initials[0], self.initials[-1]], min(some, default=None), max(some, default=None),
            self.known, some[0] if some else None, some[-1] if some else None,
            [None if a is None else a[0] for a in answers], [None if a is None else a[1] for a in answers],
        )


def _solve(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        out: list[tuple] = []
        held: _Segment | None = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for conv, conv_id, turn, initial, blank, unfinished, new, n in zip(*columns):
                for copy in range(n):
                    if held is None or held.conv != conv:
                        if held is not None:
                            # Only the first and the last one of a task may go on elsewhere.
                            out.append(held.row(part, place, held.start))
                            place += 1
                        held = _Segment(conv, conv_id, held is not None)
                    elif len(held.symbols) >= SEGMENT_ROWS:
                        out.append(held.row(part, place, False))
                        place += 1
                        held = _Segment(conv, conv_id, False)
                    held.add(turn, initial, blank, unfinished, bool(new) and copy == 0)
                    if len(out) >= 1000:
                        yield flush()
        if held is not None:
            out.append(held.row(part, place, False))
        if out:
            yield flush()

    return run


def _fold(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments in order to one row per conversation; only one conversation is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(rows: list[dict]) -> tuple:
            illegal = sum(r["illegal"] for r in rows)
            turns = sum(r["turns"] for r in rows)
            before = None
            for k, r in enumerate(rows):
                if k:
                    illegal += rows[k - 1]["initials"][1] + r["initials"][0] not in ("su", "ua", "au")
                if r["first"] is not None:
                    turns -= before is not None and before == r["first"]
                    before = r["last"]
            cost, audit = join_segments(
                [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])] for r in rows
            )
            lows, highs = [[r[k] for r in rows if r[k] is not None] for k in ("low", "high")]
            gaps = max(highs) - min(lows) + 1 - turns if lows else 0
            counts = [sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated")]
            return (rows[0]["conv"], rows[0]["conv_id"], gaps, *counts, illegal, cost, audit)

        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["conv"] != row["conv"]:
                    out.append(whole(held))
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[whole(held)]), schema)], schema=schema)

    return run


PLAN = ("conv", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _arrow(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def plan_repairs(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation its faults, the least cost and the edits, columns ``PLAN``."""
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    kind = rows.schema["conv_id"].dataType.simpleString()
    faults = land(_faults(rows), "faults")
    ordered = faults.repartitionByRange("conv", "turn", "role", "same").sortWithinPartitions(
        "conv", "turn", "role", "same"
    ).select("conv", "conv_id", "turn", "initial", "blank", "unfinished", "new", "n")
    shape = f"conv string, conv_id {kind}, {_SEGMENT}"
    spark = turns.sparkSession
    schema = spark.createDataFrame([], shape).schema
    solved = land(ordered.mapInArrow(_solve(_arrow(schema)), schema), "segments")
    done = solved.where("whole").select(
        "conv", "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal",
        F.get("costs", F.lit(0)).alias("cost"), F.get("audits", F.lit(0)).alias("audit"),
    )
    counts = ", ".join(f"{c} long" for c in PLAN[2:8])
    folded = spark.createDataFrame([], f"conv string, conv_id {kind}, {counts}, audit string").schema
    cut = solved.where("not whole").repartition("conv").sortWithinPartitions("conv", "part", "place")
    return done.unionByName(cut.mapInArrow(_fold(_arrow(folded)), folded))


def apply_repairs(
    turns: DataFrame,
    plans: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired turns ``conv, conv_id, place, edit, role, text``, in order within partitions.

    Plan and rows of a conversation come one after the other in a sorted task, which
    holds a batch of them at a time.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    none = F.lit(None)
    both = rows.withColumn("audit", none.cast("string")).unionByName(
        plans.select(
            "conv", "conv_id", none.cast("long").alias("turn"), none.cast("string").alias("role"),
            none.cast("string").alias("text"), none.cast("string").alias("same"), "audit",
        )
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = turns.sparkSession.createDataFrame(
        [], f"conv string, conv_id {kind}, place long, edit string, role string, text string"
    ).schema
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def inserts(conv, conv_id) -> None:
                nonlocal at, state, place
                while audit[at : at + 1] == INSERT:
                    out.append((conv, conv_id, place, INSERT, _ROLES[_MADE[state]], ""))
                    at, state, place = at + 1, _MADE_NEXT[state], place + 1

            for conv, conv_id, role, text, plan in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if plan is not None:
                    audit, at, state, place = plan, 0, 0, 0
                    inserts(conv, conv_id)
                    continue
                edit = audit[at]
                at += 1
                if edit == KEEP:
                    out.append((conv, conv_id, place, edit, role, text))
                    state = _NEXT[state][role[:1]]
                elif edit == REROLE:
                    out.append((conv, conv_id, place, edit, _ROLES[_MADE[state]], text))
                    state = _MADE_NEXT[state]
                place += edit != DELETE
                inserts(conv, conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    ordered = both.repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), "turn", "role", "same"
    )
    return ordered.select("conv", "conv_id", "role", "text", "audit").mapInArrow(run, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of the turns as ``role:text`` lines, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, hashlib.sha256()
        names = ["conv", "repaired_sha256"]
        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if conv != held:
                    if held is not None:
                        out.append((held, digest.hexdigest()))
                    held, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([digest.hexdigest()])], names)

    lines = repaired.select("conv", "role", "text")
    return lines.mapInArrow(run, "conv string, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` broken by a rule on their id and turn."""
    space = F.lit(" ")

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", ""))
        .otherwise(text_of("text"))
    )
    copies = F.when(kind == 0, F.expr("array()").cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2)))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        text.alias("text"),
        F.explode(copies.otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def damaged_report(turns: DataFrame) -> DataFrame:
    """Damage, repair and digest every conversation of ``conv_id, turn, role, text``."""
    broken = damage(turns)
    plans = land(plan_repairs(broken), "plans")
    found = digests(apply_repairs(broken, plans))
    asked = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "conv_id"
    ).distinct()
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in PLAN[2:8]]
    empty = hashlib.sha256().hexdigest()
    return (
        asked.join(plans.drop("conv_id"), "conv", "left")
        .join(found, "conv", "left")
        .select(
            "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
        )
    )
