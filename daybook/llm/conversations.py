"""Conversation repair by a generalised LR parse over the role grammar.

A conversation is legal where the initials of its roles read `(s?(ua)+)?`. The parser has four
stack tops: nothing yet, a system turn, an open user turn, a closed pair. From each top it keeps,
deletes or reroles the next row and may insert turns before it. All stacks live in one graph: where
two have the same top after a row they are merged, and the one of least (cost, audit) stays.

No audit is the beginning of another one that ends after the same row, so their order after a row
follows from their order before it. Tops thus hold a cost and a rank, not a text, and what a row
does to all tops at once depends on few things and is remembered.

Rows are dealt to tasks by ranges of (conversation, turn). A conversation inside one task is parsed
there. One that goes on in the next task, whatever its length, is parsed in pieces: each gives its
least costs from every top to every top, the pieces are chained, and each is then repaired alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from daybook.llm.frames import stored, tasks

# Costs, and the letters of the edits in an audit.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WIDEST = 2 * INSERT  # no top leads to an end that much cheaper than any other top does
NOTHING, SYSTEM, USER, PAIR = range(4)
TOPS = range(4)
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
LEGAL = {(0, 1), (1, 2), (2, 1)}
SOUND, GONE, CUT = range(3)  # what a row's fault means to the parser
# (top, turns inserted) in reach of each top, and the turns that close each one.
REACH = {
    NOTHING: ((NOTHING, 0), (USER, 1), (PAIR, 2)),
    SYSTEM: ((SYSTEM, 0), (USER, 1), (PAIR, 2)),
    USER: ((USER, 0), (PAIR, 1)),
    PAIR: ((PAIR, 0), (USER, 1)),
}
CLOSING = {NOTHING: 0, SYSTEM: 2, USER: 1, PAIR: 0}
PREFIX = 64  # characters of a text that deal equal turns to tasks

Tops = tuple[tuple[int, int] | None, ...]  # (cost, rank) of each top
Back = tuple[tuple[int, str] | None, ...]  # (top before, edits) of each top


def _turn(top: int) -> int:
    """The initial that the next turn must have if it is no system turn."""
    return INITIALS["a"] if top == USER else INITIALS["u"]


def _after(top: int) -> int:
    return PAIR if top == USER else USER


def _edits(top: int, initial: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, top after) of what may happen to a row."""
    yield "D", DELETE, top
    if state == GONE:
        return
    more = TRUNCATED if state == CUT else 0
    if initial == _turn(top):
        yield "K", more, _after(top)
    elif initial == INITIALS["s"] and top == NOTHING:
        yield "K", more, SYSTEM
    yield "R", REROLE + more, _after(top)


@cache
def step(tops: Tops, initial: int, state: int) -> tuple[Tops, int, Back]:
    """The tops after a row, what all of them cost more than before, and where each came from."""
    best: list = [None] * len(TOPS)
    for top, held in enumerate(tops):
        if held is None:
            continue
        for reached, inserted in REACH[top]:
            for edit, cost, after in _edits(reached, initial, state):
                way = (held[0] + INSERT * inserted + cost, (held[1], "I" * inserted + edit), top)
                if best[after] is None or way[:2] < best[after][:2]:
                    best[after] = way
    least = min(way[0] for way in best if way)
    best = [way if way and way[0] <= least + WIDEST else None for way in best]
    order = sorted({way[1] for way in best if way})
    new = tuple((way[0] - least, order.index(way[1])) if way else None for way in best)
    return new, least, tuple((way[2], way[1][1]) if way else None for way in best)


class Parse:
    """The graph of stacks over some rows, from one top on."""

    def __init__(self, kinds: list[tuple[int, int]], start: int = NOTHING):
        self.tops: Tops = tuple((0, 0) if top == start else None for top in TOPS)
        self.cost, self.backs = 0, []
        for initial, state in kinds:
            self.tops, more, back = step(self.tops, initial, state)
            self.cost += more
            self.backs.append(back)

    def audit(self, top: int) -> str:
        edits = []
        for back in reversed(self.backs):
            top, edit = back[top]
            edits.append(edit)
        return "".join(reversed(edits))

    def ends(self) -> dict[int, int]:
        """Cost of each top that is left."""
        return {top: self.cost + held[0] for top, held in enumerate(self.tops) if held}


def closed(tops: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """(cost, top) of the best end, from the (cost, rank) of each top."""
    ways = [(cost + INSERT * CLOSING[top], (rank, "I" * CLOSING[top]), top) for top, (cost, rank) in tops.items()]
    cost, _, top = min(ways)
    return cost, top


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    copies: int
    seen: bool | None  # whether an earlier task has its role and text; None: look here


class Facts:
    """What a run of rows of one conversation is like."""

    def __init__(self, rows: list[Row]):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.kinds: list[tuple[int, int]] = []
        known: set[tuple[str, str]] = set()
        for row in rows:
            if not row.copies:
                continue
            if row.turn is not None and row.turn != self.high:
                self.low = row.turn if self.low is None else self.low
                self.high = row.turn
                self.turns += 1
            initial = INITIALS.get(row.role[:1], OTHER)
            end = row.text.rstrip(" \t\n\v\f\r")[-1:]
            seen = row.seen
            if seen is None:
                seen = (row.role, row.text) in known
                known.add((row.role, row.text))
            # The first copy may be sound, the others repeat it.
            if not end:
                self.blank += row.copies
                states = [GONE] * row.copies
            else:
                self.duplicate += row.copies - (not seen)
                self.truncated += not seen and end not in ".!?"
                first = GONE if seen else SOUND if end in ".!?" else CUT
                states = [first] + [GONE] * (row.copies - 1)
            for state in states:
                if self.kinds and (self.kinds[-1][0], initial) not in LEGAL:
                    self.illegal += 1
                self.kinds.append((initial, state))

    def counts(self) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": min(gaps, (1 << 63) - 1), **{n: getattr(self, n) for n in FAULTS}}


FAULTS = ("blank", "duplicate", "truncated", "illegal")
COUNTS = ("gaps", *FAULTS, "cost")


def applied(rows: list[Row], audit: str, top: int = NOTHING) -> tuple[list[str], int]:
    """The lines `role:text` that an audit leaves of the rows, and the top after them."""
    lines = []
    each = (row for row in rows for _ in range(row.copies))
    for edit in audit:
        row = None if edit == "I" else next(each)
        if edit == "D":
            continue
        if edit == "K" and row.role[:1] == "s":
            lines.append(f"{row.role}:{row.text}")
            top = SYSTEM
            continue
        role = row.role if edit == "K" else ("assistant" if top == USER else "user")
        lines.append(f"{role}:{row.text if row else ''}")
        top = _after(top)
    return lines, top


def _whole(rows: list[Row]) -> dict:
    """The repair of a conversation whose rows are all here."""
    facts = Facts(rows)
    parse = Parse(facts.kinds)
    ranked = {top: (parse.cost + held[0], held[1]) for top, held in enumerate(parse.tops) if held}
    cost, top = closed(ranked)
    audit = parse.audit(top) + "I" * CLOSING[top]
    return {**facts.counts(), "cost": cost, "audit": audit, "repaired": "\n".join(applied(rows, audit)[0])}


def _runs(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple, list[Row], dict]]:
    """(key, rows, further columns of the first row) of each run of rows with equal `by`."""
    key, rows, more = None, [], {}
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        seen = columns.get("seen") or [None] * batch.num_rows
        fields = zip(columns["turn"], columns["role"], columns["text"], columns["copies"], seen)
        for at, (own, row) in enumerate(zip(zip(*[columns[n] for n in by]), fields)):
            if own != key:
                if rows:
                    yield key, rows, more
                key, rows = own, []
                more = {n: columns[n][at] for n in ("start", "end", "last") if n in columns}
            rows.append(Row(*row))
    if rows:
        yield key, rows, more


def _parser(schema: pa.Schema) -> Callable:
    """Repairs the conversations that lie whole in a task; rows of its first and its last one,
    which others may go on with, pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def passed(key: tuple, rows: list[Row]) -> list[dict]:
            return [{"conv_id": key[0], "part": part, **row._asdict()} for row in rows]

        made: list[dict] = []
        held = None
        for number, (key, rows, _) in enumerate(_runs(batches, "conv_id")):
            if held is not None:
                made.append({"conv_id": held[0][0], **_whole(held[1])})
                held = None
            if number == 0:
                yield pa.RecordBatch.from_pylist(passed(key, rows), schema)
            else:
                held = key, rows
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
        if held is not None:
            made += passed(*held)
        yield pa.RecordBatch.from_pylist(made, schema)

    return run


def _pieces(schema: pa.Schema) -> Callable:
    """Of each piece its facts, and (cost, rank of the audit) from every top to every top."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), rows, _ in _runs(batches, "part", "conv_id"):
            facts = Facts(rows)
            parses = {start: Parse(facts.kinds, start) for start in TOPS}
            ways = {(s, e): (c, p.audit(e)) for s, p in parses.items() for e, c in p.ends().items()}
            order = sorted({audit for _, audit in ways.values()})
            table = [{"start": s, "end": e, "cost": c, "rank": order.index(a)} for (s, e), (c, a) in ways.items()]
            piece = {
                "conv_id": conv, "part": part, "low": facts.low, "high": facts.high, "turns": facts.turns,
                "opens": facts.kinds[0][0] if facts.kinds else None,
                "closes": facts.kinds[-1][0] if facts.kinds else None,
                **{n: getattr(facts, n) for n in FAULTS}, "ways": table,
            }
            yield pa.RecordBatch.from_pylist([piece], schema)

    return run


def chained(pieces: pd.DataFrame) -> pd.DataFrame:
    """The tops at which each piece of one conversation begins and ends in the best parse, and
    the whole conversation's counts."""
    pieces = pieces.sort_values("part")
    sums = {n: int(pieces[n].sum()) for n in FAULTS}
    turns, low, high, closes = 0, None, None, None
    tops = {NOTHING: (0, 0)}
    backs = []
    for piece in pieces.to_dict("records"):
        if not pd.isna(piece["opens"]):
            sums["illegal"] += closes is not None and (closes, int(piece["opens"])) not in LEGAL
            closes = int(piece["closes"])
        if not pd.isna(piece["low"]):
            turns += int(piece["turns"]) - (int(piece["low"]) == high)
            low = int(piece["low"]) if low is None else low
            high = int(piece["high"])
        best: dict[int, tuple] = {}
        for way in piece["ways"]:
            if way["start"] in tops:
                cost, rank = tops[way["start"]]
                found = (cost + way["cost"], (rank, way["rank"]), way["start"])
                if way["end"] not in best or found[:2] < best[way["end"]][:2]:
                    best[way["end"]] = found
        order = sorted({found[1] for found in best.values()})
        tops = {end: (found[0], order.index(found[1])) for end, found in best.items()}
        backs.append({end: found[2] for end, found in best.items()})
    cost, top = closed(tops)
    starts, ends = [], []
    for back in reversed(backs):
        ends.append(top)
        top = back[top]
        starts.append(top)
    gaps = 0 if low is None else min(high - low + 1 - turns, (1 << 63) - 1)
    made = pieces[["conv_id", "part"]].assign(start=starts[::-1], end=ends[::-1], gaps=gaps, cost=cost, **sums)
    return made.assign(last=[*[False] * (len(made) - 1), True])


def _repairs(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), rows, chosen in _runs(batches, "part", "conv_id"):
            audit = Parse(Facts(rows).kinds, chosen["start"]).audit(chosen["end"])
            if chosen["last"]:
                audit += "I" * CLOSING[chosen["end"]]
            lines, _ = applied(rows, audit, chosen["start"])
            made = {"conv_id": conv, "part": part, "audit": audit, "lines": "".join(f"{x}\n" for x in lines)}
            yield pa.RecordBatch.from_pylist([made], schema)

    return run


def _map(rows: DataFrame, task: Callable, schema: str) -> DataFrame:
    """`task(arrow schema)` over the rows; `schema` begins with conv_id, which keeps its type."""
    made = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL(schema)])
    return rows.mapInArrow(task(to_arrow_schema(made)), made)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of each
    conversation of `rows` (conv_id, turn, role, text, copies).

    Rows go by turn, NULL first; rows of one turn by role and text. `copies` is how often a row
    stands there, one after the other; rows of none only make their conversation known. A NULL
    conv_id names a conversation of its own, NULL roles and texts are one space. `repaired` has a
    line `role:text` for each turn left, and is one cell, of 2 GB at most. A conversation without
    rows has zeros and empty texts.
    """
    spark = rows.sparkSession
    n = tasks(spark)
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        "copies",
    )
    # Repeated rows leave a task as one row.
    summed = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("bigint").alias("copies"))
    ordered = summed.repartitionByRange(
        n, "conv_id", "turn", F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX)
    ).sortWithinPartitions("conv_id", "turn", "role", "text")
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    row = "part int, turn bigint, role string, text string, copies bigint, seen boolean"
    parsed = stored(_map(ordered, _parser, f"{counts}, audit string, repaired string, {row}"), "parsed")
    results = ["conv_id", *COUNTS, "audit", "repaired"]
    whole = parsed.where("part is null").select(*results)

    parted = parsed.where("part is not null").select("conv_id", "part", "turn", "role", "text", "copies")
    same = ["conv_id", "role", "text"]
    first = stored(
        parted.where("copies > 0").groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).turn.alias("__turn")),
        "first",
    )
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in same]
    seen = F.col("copies") > 0
    seen = F.coalesce(seen & ~F.col("turn").eqNullSafe(F.col("__turn")), F.lit(False)).alias("seen")
    known = stored(parted.alias("p").join(first.alias("f"), on, "left").select("p.*", seen), "known")

    def by_piece(found: DataFrame) -> DataFrame:
        return found.repartition(n, "part").sortWithinPartitions("part", "conv_id", "turn", "role", "text")

    faults = ", ".join(f"{c} bigint" for c in FAULTS)
    ways = "ways array<struct<start: int, end: int, cost: bigint, rank: int>>"
    facts = f"part int, low bigint, high bigint, turns bigint, opens int, closes int, {faults}, {ways}"
    pieces = _map(by_piece(known), _pieces, facts)
    places = f"part int, start int, end int, gaps bigint, cost bigint, {faults}, last boolean"
    key = T.StructType([pieces.schema["conv_id"], *T.StructType.fromDDL(places)])
    chosen = stored(pieces.groupBy("conv_id").applyInPandas(chained, key), "chosen")
    on = [F.col("k.conv_id").eqNullSafe(F.col("c.conv_id")), F.col("k.part") == F.col("c.part")]
    told = known.alias("k").join(chosen.alias("c"), on).select("k.*", "start", "end", "last")
    texts = _map(by_piece(told), _repairs, "part int, audit string, lines string")
    # A row for each piece: as many as tasks at most, in one conversation.
    listed = texts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "audit", "lines"))).alias("all"))
    totals = chosen.where("last").alias("c").join(
        listed.alias("l"), F.col("c.conv_id").eqNullSafe(F.col("l.conv_id"))
    )
    joined = totals.select(
        "c.conv_id",
        *[F.col(c) for c in COUNTS],
        F.array_join("all.audit", "").alias("audit"),
        F.regexp_replace(F.array_join("all.lines", ""), r"\n\z", "").alias("repaired"),
    )
    return whole.unionByName(joined)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) of `conversations` with planted faults.

    crc32 of `conv_id:turn` modulo 20 tells which: 0 drops the row, 1 empties its text, 2 takes
    its `.!?` away, 3 repeats it, 4 makes its role `user`. NULL counts as one space.
    """

    def plain(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.col("__fault")
    text, role = plain("text"), plain("role")
    return conversations.withColumn(
        "__fault", F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    ).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
