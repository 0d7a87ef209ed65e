"""Cheapest repair of the structure of conversations, by Knuth's agenda of lightest derivations.

A repaired conversation is empty, or an optional system turn followed by pairs of a user's and an assistant's
turn: its role initials match ``(s?(ua)+)?``. A row may be kept (K, cost 0), given the role that fits (R, 1) or
deleted (D, 2), and a turn with an empty text may be inserted anywhere (I, 5). A blank row, and one whose role and
text were seen before, must be deleted; a truncated one that stays costs 5 more. Of the cheapest repairs that with
the least audit, the edits' letters in order, is taken. Audit and rows determine the repaired turns.

An item (i, state) says that the first i rows can be repaired so that the turns so far end in ``state``; its weight
is (cost, audit). A deduction takes an item and a row's edit, or an insertion, to the next item: it adds to the
cost and appends to the audit, so a conclusion is never lighter than its premise, and lighter premises give lighter
conclusions (two derivations of an item with one cost cannot be prefixes of each other, as the letters set the cost).
So the agenda may finalise an item when it is popped, and stops when all goals are final.

A conversation of any length is repaired in blocks of ``ROWS`` rows, each a task's small unit: a block's own
agenda gives the lightest way from every state to every state. In a block, insertions come before a row and never
last, so no audit of a block is the prefix of another, and joined audits compare as their ranks within the blocks do.
A block is thus an edge with a cost and a rank, and ``FAN`` blocks are joined by the same agenda, level by level.
Choices then go down again. No task holds more than a block's rows or ``FAN`` summaries of constant size.

Odd rows: NULL roles and texts are taken as one space. Rows go by turn, NULL turns first, rows of equal turns by role
and text. A NULL conversation id is an id like others. Roles other than those that begin with s, u or a cannot be kept.
Repeated rows are duplicates. An empty table gives empty results. Further columns of the input take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import Scratch
from racecast.operators.ordered import DEFAULT_SPLIT, Split, running_total

ROWS = 1024
FAN = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States by what the turns so far end in: nothing, or the turn of that initial.
STATES = " sua"
NEW_ROLE = {"u": "user", "a": "assistant"}
FOLLOWING = {" ": "u", "s": "u", "u": "a", "a": "u"}
FITTING = {(" ", "s"), (" ", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
# What must still be inserted for the turns to be complete.
TAIL = {" ": "", "a": "", "u": "I", "s": "II"}

Option = tuple[str, str, int]  # what is appended to the audit, state after it, cost
Way = tuple[int, str, str]  # cost, audit, state after each letter

SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def lightest(n: int, options: Callable[[int, str], Iterable[Option]], start: str, inserts: bool) -> dict[str, Way]:
    """The lightest way from ``start`` over n edges to each state that can be reached."""
    final: dict[tuple[int, str], Way] = {}
    agenda: list[tuple[int, str, int, str, str]] = [(0, "", 0, start, "")]
    while agenda:
        cost, audit, i, state, trail = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = cost, audit, trail
        if i == n:
            continue
        for letter, after, more in options(i, state):
            if (i + 1, after) not in final:
                heapq.heappush(agenda, (cost + more, audit + letter, i + 1, after, trail + after))
        if inserts and (i, FOLLOWING[state]) not in final:
            after = FOLLOWING[state]
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after, trail + after))
    return {state: way for (i, state), way in final.items() if i == n}


def edits(initial: str, fault: str, state: str) -> Iterator[Option]:
    """What may be done with a row when the turns so far end in ``state``."""
    if fault in "bd":
        yield "D", state, DELETE
        return
    extra = TRUNCATED if fault == "t" else 0
    if (state, initial) in FITTING:
        yield "K", initial, KEEP + extra
    yield "R", FOLLOWING[state], REROLE + extra
    yield "D", state, DELETE


def block_ways(codes: str, first: bool) -> list[dict[str, object]]:
    """All lightest ways through a block of rows, given as initial and fault of each, with ranks of their audits."""
    rows = list(zip(codes[::2], codes[1::2]))
    out = []
    for start in STATES[:1] if first else STATES:
        ways = lightest(len(rows), lambda i, state: edits(*rows[i], state), start, inserts=True)
        out += ranked(start, ways)
    return out


def joined_ways(nodes: list[list[dict[str, object]]], first: bool) -> list[dict[str, object]]:
    """The same for a row of blocks (or of joined blocks), each given by its ways."""
    by_start: list[dict[str, list[Option]]] = []
    for node in nodes:
        by_start.append({})
        for way in node:
            by_start[-1].setdefault(way["start"], []).append((chr(48 + way["rank"]), way["end"], way["cost"]))
    out = []
    for start in STATES[:1] if first else STATES:
        ways = lightest(len(nodes), lambda i, state: by_start[i].get(state, ()), start, inserts=False)
        out += ranked(start, ways)
    return out


def ranked(start: str, ways: dict[str, Way]) -> list[dict[str, object]]:
    order = {audit: rank for rank, audit in enumerate(sorted(audit for _, audit, _ in ways.values()))}
    return [
        {"start": start, "end": end, "cost": cost, "rank": order[audit], "audit": audit, "trail": trail}
        for end, (cost, audit, trail) in ways.items()
    ]


WAY_FIELDS = [("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("rank", pa.int32()),
              ("audit", pa.string()), ("trail", pa.string())]
WAYS_ARROW = pa.list_(pa.struct(WAY_FIELDS))
WAYS = "array<struct<start:string,end:string,cost:bigint,rank:int,audit:string,trail:string>>"
SUMMARY = "transform(ways, w -> struct(w.start AS start, w.end AS end, w.cost AS cost, w.rank AS rank))"


def with_ways(df: DataFrame, column: str, solve: Callable[[object, bool], list[dict[str, object]]]) -> DataFrame:
    """``ways`` in the place of ``column``, solved from it; node 0 can only start from nothing."""
    names = [c for c in df.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(column).to_pylist(), batch.column("node").to_pylist())
            ways = pa.array([solve(value, node == 0) for value, node in pairs], WAYS_ARROW)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ways], [*names, "ways"])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)
    return df.mapInArrow(run, f"{fields}, ways {WAYS}")


def same(*names: str) -> Callable[[str, str], Column]:
    """The condition that two aliased tables agree in columns, NULL being equal to NULL."""

    def condition(a: str, b: str) -> Column:
        tests = [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out

    return condition


def numbered(turns: DataFrame, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """``turns`` (conv, turn, role, text) with ``at``, the place in the conversation from 0.

    Equal rows are counted before anything is sorted, and a long conversation is sorted in segments.
    """
    counted = running_total(turns, ["conv"], ["turn", "role", "text"], {"n": F.lit(1)}, split)
    copies = F.explode(F.sequence(F.col("cum_n") - F.col("n"), F.col("cum_n") - 1))
    return counted.select("conv", "turn", "role", "text", copies.alias("at"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``initial`` (x for a role that cannot stay) and ``fault``: b(lank), d(uplicate), t(runcated) or -."""
    digest = F.md5(F.concat_ws(":", F.char_length("role"), "role", "text"))
    rows = rows.withColumn("digest", digest)
    firsts = rows.groupBy("conv", "digest").agg(F.min("at").alias("first")).alias("f")
    joined = rows.alias("r").join(firsts, same("conv", "digest")("r", "f"))
    initial, text = F.substring("r.role", 1, 1), F.col("r.text")
    fault = (
        F.when(~text.rlike(SOLID), "b").when(F.col("at") > F.col("first"), "d").when(~text.rlike(ENDED), "t").otherwise("-")
    )
    return joined.select("r.*", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), fault.alias("fault"))


@dataclass(frozen=True)
class Repair:
    """``rows``: the rows with place and fault. ``repaired``: the turns after repair (conv, at, seq, edit, role, text),
    in order of (at, seq), deleted ones with a NULL role. ``totals``: per conversation n, blank, duplicate, truncated,
    illegal, cost and audit."""

    rows: DataFrame
    repaired: DataFrame
    totals: DataFrame


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row per block: its codes, ends and counts of faults."""
    code = F.struct("at", F.concat("initial", "fault").alias("code"))
    blocks = rows.groupBy("conv", F.floor(F.col("at") / size).alias("node")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(code)), lambda x: x["code"]), "").alias("codes"),
        *(F.count(F.when(F.col("fault") == f, 1)).alias(name) for name, f in FAULTS.items()),
    )
    # Neighbouring initials, of which the first of a block has its own in the block before.
    initials = F.regexp_replace("codes", "(.).", "$1")
    pairs = F.size(F.filter(
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(initials) - 1)), lambda i: F.substring(initials, i, F.lit(2))),
        lambda p: (F.char_length(p) == 2) & ~p.isin(*LEGAL),
    ))
    return blocks.withColumns({"illegal": pairs.cast("long"), "ends": F.concat(F.left(initials, F.lit(1)), F.right(initials, F.lit(1)))})


FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t"}
LEGAL = ("su", "ua", "au")


def _between_blocks(blocks: DataFrame) -> DataFrame:
    """Illegal pairs of the last row of a block and the first of the next, per conversation."""
    after = blocks.select("conv", (F.col("node") - 1).alias("node"), F.col("ends").alias("next")).alias("b")
    pairs = blocks.select("conv", "node", "ends").alias("a").join(after, same("conv", "node")("a", "b"))
    pair = F.concat(F.right("ends", F.lit(1)), F.left("next", F.lit(1)))
    return pairs.groupBy("a.conv").agg(F.count(F.when(~pair.isin(*LEGAL), 1)).alias("between"))


def _choices(blocks: DataFrame, scratch: Scratch, fan: int) -> DataFrame:
    """(conv, node, start, end, tail) of each block: the ways that make up the lightest repair."""
    levels = [blocks.select("conv", "node", "ways")]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        part = F.struct("node", F.expr(SUMMARY).alias("ways"))
        joined = levels[-1].groupBy("conv", F.floor(F.col("node") / fan).alias("node")).agg(
            F.transform(F.array_sort(F.collect_list(part)), lambda x: x["ways"]).alias("parts")
        )
        levels.append(scratch.keep(with_ways(joined, "parts", joined_ways)))
    tail = F.create_map(*(F.lit(x) for item in TAIL.items() for x in item))
    best = F.array_min(F.transform("ways", lambda w: F.struct(
        (w["cost"] + INSERT * F.char_length(tail[w["end"]])).alias("cost"), w["rank"].alias("rank"), w["end"].alias("end"))))
    chosen = levels[-1].select("conv", "node", F.lit(STATES[0]).alias("start"), best["end"].alias("end"))
    chosen = chosen.withColumn("tail", tail[F.col("end")])
    for level in reversed(levels[1:]):
        way = F.filter("ways", lambda w: (w["start"] == F.col("c.start")) & (w["end"] == F.col("c.end")))[0]
        found = level.alias("l").join(chosen.alias("c"), same("conv", "node")("l", "c"))
        found = found.select("l.conv", "l.node", "c.start", "c.tail", way["trail"].alias("trail"))
        steps = F.sequence(F.lit(1), F.char_length("trail"))
        found = found.select("*", F.explode(steps).alias("i")).select(
            "conv",
            (F.col("node") * fan + F.col("i") - 1).alias("node"),
            F.when(F.col("i") == 1, F.col("start")).otherwise(F.substring("trail", F.col("i") - 1, F.lit(1))).alias("start"),
            F.substring("trail", F.col("i"), F.lit(1)).alias("end"),
            F.when((F.col("i") == F.char_length("trail")), F.col("tail")).otherwise("").alias("tail"),
        )
        chosen = scratch.keep(found)
    return chosen


def _letters(solved: DataFrame, size: int) -> DataFrame:
    """(conv, at, seq, edit, initial) of every edit. Insertions stand at the row before which they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, at, seq, edit, initial = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("node", "audit", "trail"))
            for k, (node, audit, trail) in enumerate(zip(*columns)):
                place, order = node * size, 0
                for letter, state in zip(audit, trail):
                    conv.append(k)
                    at.append(place)
                    seq.append(order)
                    edit.append(letter)
                    initial.append(None if letter == "D" else state)
                    place, order = (place, order + 1) if letter == "I" else (place + 1, 0)
            arrays = [batch.column("conv").take(pa.array(conv, pa.int64())), pa.array(at, pa.int64()), pa.array(seq, pa.int32()),
                      pa.array(edit, pa.string()), pa.array(initial, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "at", "seq", "edit", "initial"])

    kind = solved.schema["conv"].dataType.simpleString()
    return solved.mapInArrow(run, f"conv {kind}, at bigint, seq int, edit string, initial string")


def repair(
    turns: DataFrame,
    scratch: Scratch,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rows_per_block: int = ROWS,
    fan: int = FAN,
    split: Split = DEFAULT_SPLIT,
) -> Repair:
    """Repair every conversation of ``turns``; see the module for the rules and for odd rows."""
    space = F.lit(" ")
    plain = turns.select(
        turns[conv].alias("conv"),
        turns[turn].alias("turn"),
        F.coalesce(turns[role], space).alias("role"),
        F.coalesce(turns[text], space).alias("text"),
    )
    rows = scratch.keep(with_faults(numbered(plain, split)))
    blocks = scratch.keep(with_ways(_blocks(rows, rows_per_block), "codes", block_ways))
    chosen = _choices(blocks, scratch, fan)

    way = F.filter("ways", lambda w: (w["start"] == F.col("c.start")) & (w["end"] == F.col("c.end")))[0]
    ends = F.substring(F.lit("ua"), 3 - F.char_length("tail"), F.lit(2))  # a tail ends in an assistant's turn
    solved = scratch.keep(
        blocks.alias("b")
        .join(chosen.alias("c"), same("conv", "node")("b", "c"))
        .select("b.conv", "b.node", *(f"b.{name}" for name in (*FAULTS, "illegal")), way.alias("way"), "c.tail")
        .select(
            "conv", "node", *FAULTS, "illegal",
            (F.col("way.cost") + INSERT * F.char_length("tail")).alias("cost"),
            F.concat("way.audit", "tail").alias("audit"),
            F.concat("way.trail", ends).alias("trail"),
        )
    )
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "audit"))), lambda x: x["audit"]), "")
    totals = solved.groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in (*FAULTS, "illegal", "cost")), audit.alias("audit")
    ).alias("t")
    between = _between_blocks(blocks).alias("p")
    totals = totals.join(between, same("conv")("t", "p"), "left").select(
        "t.conv", *FAULTS, (F.col("illegal") + F.coalesce("between", F.lit(0))).alias("illegal"), "cost", "audit"
    )

    letters = _letters(solved, rows_per_block).alias("e")
    # An insertion finds no row: its place is that of a row, but its letter is not that row's.
    place = (F.col("e.edit") != "I") & same("conv", "at")("e", "r")
    new_role = F.element_at(F.create_map(*(F.lit(x) for item in NEW_ROLE.items() for x in item)), F.col("initial"))
    repaired = letters.join(rows.select("conv", "at", "role", "text").alias("r"), place, "left").select(
        "e.conv", "e.at", "e.seq", "e.edit",
        F.when(F.col("e.edit") == "K", F.col("r.role")).when(F.col("e.edit") != "D", new_role).alias("role"),
        F.coalesce("r.text", F.lit("")).alias("text"),
    )
    return Repair(rows, repaired, totals)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's repaired ``role:text`` lines, joined by line ends.

    A digest takes its bytes one after the other, so a conversation is read by one task, in sorted batches, of which
    none is kept.
    """
    import hashlib

    lines = repaired.filter("edit <> 'D'").select("conv", "at", "seq", F.concat_ws(":", "role", "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "at", "seq").select("conv", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now: object = none
        state = hashlib.sha256()
        for batch in batches:
            convs, sums = [], []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if conv != now or now is none:
                    if now is not none:
                        convs.append(now)
                        sums.append(state.hexdigest())
                    now, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(sums, pa.string())], ["conv", "sha256"])
        if now is not none:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()], pa.string())], ["conv", "sha256"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(lines.schema["conv"].dataType)
    return lines.mapInArrow(run, f"conv {lines.schema['conv'].dataType.simpleString()}, sha256 string")
