"""Chat formatting: the cheapest repair of each conversation's roles, then its rendering.

A legal conversation is an optional system turn, then user and assistant turns that alternate, the
last one from the assistant. A repair reads the turns in order; each may keep its role or be
relabelled, be merged into the turn before it of the same role or open a turn of its own, and empty
turns may be put in where the automaton needs them. Each step has a cost; dynamic programming over
the automaton's states finds the least sum, and ties keep the first choice in the order keep, merge,
relabel, insert.

One turn's costs from state to state are a small matrix, and a run of turns is the product of its
matrices where plus is the minimum and times the sum. So a conversation of any length is cut into
blocks of ``BLOCK`` turn numbers, or, where one of those holds more than twice as many rows (turns without a number, or
of one number), of ``BLOCK`` rows by a counted rank: each block is reduced to one matrix, the matrices of a
conversation give the state at each border, and every block is then repaired on its own between
its two states. Conversations that fit one block skip the first two steps.

Rendering gives each turn ``<|im_start|>role``, its text and ``<|im_end|>``; the marks, where a text
holds them, are taken apart so that no text can open a turn. A block's fragment closes the turn that
an earlier block left open; the fragments of a conversation in order of their block are its rendering.

Edge cases: rows without a conversation are left out; rows equal in all four columns count once; turns
of one number are ordered by role and text, those without a number come last; unknown and null roles
are free to relabel; a null text is empty; an empty table gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import stage

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
BLOCK = 4_096  # turn numbers, or rows
PREFIX = 256  # characters of a text by which turns of one number and role are dealt
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Costs:
    """What a merge, a relabelled turn and an inserted empty turn cost."""

    merge: int = 1
    relabel: int = 2
    insert: int = 3


@dataclass(frozen=True)
class Step:
    """One way through a turn: from a state to a state, at a cost."""

    source: int
    target: int
    cost: int
    merged: bool
    inserted: tuple[int, ...]  # empty turns put in before it


# Empty turns needed before a new turn of the second role may follow the first state.
_BETWEEN = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, USER): (ASSISTANT,), (USER, ASSISTANT): (),
    (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}
# Empty turns needed to end a conversation; one without a turn at all cannot occur.
_TO_END = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def steps(role: int | None, costs: Costs) -> list[Step]:
    """All ways to read one turn of the role; None is an unknown one."""
    out = []
    for target in (SYSTEM, USER, ASSISTANT):
        change = 0 if role in (None, target) else costs.relabel
        for source in (START, SYSTEM, USER, ASSISTANT):
            if source == target:
                out.append(Step(source, target, change + costs.merge, True, ()))
            empty = _BETWEEN.get((source, target))
            if empty is not None:
                out.append(Step(source, target, change + costs.insert * len(empty), False, empty))
    # The order in which equally dear ways are preferred.
    return sorted(out, key=lambda s: (s.cost, len(s.inserted), s.merged, s.target != role, s.target, s.source))


def role_number(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else None


def matrix(roles, costs: Costs) -> np.ndarray:
    """Least cost from state to state over a run of turns."""
    total = np.full((4, 4), np.inf)
    np.fill_diagonal(total, 0)
    single = {}
    for role in roles:
        if role not in single:
            single[role] = np.full((4, 4), np.inf)
            for s in steps(role, costs):
                single[role][s.source, s.target] = min(single[role][s.source, s.target], s.cost)
        total = (total[:, :, None] + single[role][None, :, :]).min(axis=1)
    return total


def end_cost(costs: Costs) -> np.ndarray:
    return np.array([0.0] + [costs.insert * len(_TO_END[s]) for s in (SYSTEM, USER, ASSISTANT)])


def repair(roles, costs: Costs, entry: int = START, leave: int | None = None) -> list[Step]:
    """The cheapest way through the turns from ``entry``, to ``leave`` or to the conversation's end."""
    best = [float("inf")] * 4
    best[entry] = 0.0
    back: list[list[Step | None]] = []
    ways = {role: steps(role, costs) for role in set(roles)}
    for role in roles:
        now: list[float] = [float("inf")] * 4
        by: list[Step | None] = [None] * 4
        for s in ways[role]:
            if best[s.source] + s.cost < now[s.target]:
                now[s.target], by[s.target] = best[s.source] + s.cost, s
        back.append(by)
        best = now
    if leave is None:
        final = end_cost(costs)
        leave = min(range(4), key=lambda s: (best[s] + final[s], -s))
    out = []
    for by in reversed(back):
        out.append(by[leave])
        leave = by[leave].source
    return out[::-1]


def _plain(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def render(path: list[Step], texts, entry: int, last: bool) -> tuple[str, int]:
    """The fragment of a repaired block, and how many turns it opens."""
    out, opened = [], 0

    def close():
        if out or entry != START:
            out.append(f"{CLOSE}\n")

    def turn(state, text):
        nonlocal opened
        close()
        out.append(f"{OPEN}{ROLES[state - 1]}\n{text}")
        opened += 1

    for step, text in zip(path, texts):
        if step.merged:
            out.append(f"\n{_plain(text)}")
            continue
        for state in step.inserted:
            turn(state, "")
        turn(step.target, _plain(text))
    if last:
        for state in _TO_END[path[-1].target] if path else ():
            turn(state, "")
        out.append(f"{CLOSE}\n")
    return "".join(out), opened


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    ).where("conv_id IS NOT NULL").distinct()
    # The last block is that of the turns without a number.
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(1 << 62)).cast("long")
    rows = rows.withColumn("block", block)
    full = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")).where(F.col("n") > 2 * BLOCK)
    full = stage(full.select(F.col("conv_id").alias("_full")).distinct(), "full")
    if full.isEmpty():
        return rows
    apart = rows.join(full, F.col("conv_id") == F.col("_full"), "left_semi")
    return rows.join(full, F.col("conv_id") == F.col("_full"), "left_anti").unionByName(_ranked(apart))


def _ranked(rows: DataFrame) -> DataFrame:
    """The rows in blocks of ``BLOCK`` by their rank in the conversation.

    Rows are sorted by ranges, so a conversation may lie in any number of partitions; the rows that it has in earlier
    ones are added to a row's place in its own.
    """
    order = ["conv_id", F.asc_nulls_last("turn"), F.asc("role")]
    dealt = rows.repartitionByRange(*order, F.asc(F.substring("text", 1, PREFIX)))
    placed = dealt.sortWithinPartitions(*order, F.asc("text")).select(
        "*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m")
    )
    placed = stage(placed, "ranked")  # places depend on how the ranges fell
    parts = placed.groupBy("conv_id", "_p").agg(F.count("*").alias("n"), F.min("_m").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col("conv_id").alias("_c"), F.col("_p").alias("_q"), (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift")
    )
    # Both sides are dealt by conversation and range: no task gets a whole long conversation.
    met = placed.repartition("conv_id", "_p").join(
        parts.repartition("_c", "_q"), (F.col("conv_id") == F.col("_c")) & (F.col("_p") == F.col("_q"))
    )
    rank = F.col("_m") + F.col("shift")
    return met.select(*[c for c in rows.columns if c != "block"], F.floor(rank / BLOCK).alias("block"))


def _by_block(rows: DataFrame, columns: list[str], function, schema: str) -> DataFrame:
    """Calls ``function(rows of one block)`` with the block's turns in order; yields its rows."""
    order = ["conv_id", "block", F.asc_nulls_last("turn"), "role", "text"]
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions(*order).select("conv_id", "block", *columns)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(_parsed(schema))
        kept, key, ready = [], None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    if kept:
                        ready.append(function(key, kept))
                    kept, key = [], row[:2]
                kept.append(row[2:])
            if len(ready) >= 1_000:
                yield _batch(ready, target)
                ready = []
        if kept:
            ready.append(function(key, kept))
        if ready:
            yield _batch(ready, target)

    return dealt.mapInArrow(run, schema)


def _parsed(schema: str):
    from pyspark.sql.types import LongType, StringType, ArrayType, DoubleType, StructField, StructType

    kinds = {"long": LongType(), "string": StringType(), "array<double>": ArrayType(DoubleType())}
    return StructType([StructField(*(lambda n, k: (n, kinds[k]))(*part.split(" "))) for part in schema.split(", ")])


def _batch(rows, target):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], target.field(k).type) for k in range(len(target))], schema=target
    )


def _borders(turns: DataFrame, costs: Costs, kind: str) -> DataFrame:
    """State before and after each block of the conversations that have several."""
    spans = turns.groupBy("conv_id").agg(F.min("block").alias("u"), F.max("block").alias("v")).where("u < v")
    several = turns.join(spans.select("conv_id"), "conv_id", "left_semi")

    def reduce(key, rows):
        return (*key, matrix([role_number(r[0]) for r in rows], costs).ravel().tolist())

    reduced = _by_block(several, ["role"], reduce, f"conv_id {kind}, block long, m array<double>")
    listed = reduced.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "m"))).alias("blocks"))

    def trace(batches):
        for batch in batches:
            out = []
            for conv, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                ahead = [np.array([0.0, np.inf, np.inf, np.inf])]
                products = [np.array(b["m"]).reshape(4, 4) for b in blocks]
                for m in products:
                    ahead.append((ahead[-1][:, None] + m).min(axis=0))
                state = int(np.lexsort((-np.arange(4), ahead[-1] + end_cost(costs)))[0])
                for k in range(len(blocks) - 1, -1, -1):
                    before = int(np.argmin(ahead[k] + products[k][:, state]))
                    out.append((conv, blocks[k]["block"], before, state, k == len(blocks) - 1))
                    state = before
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], batch.column(0).type), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64()),
                 pa.array([int(o[4]) for o in out], pa.int64())],
                ["c", "b", "entry", "leave", "last"],
            )

    return listed.mapInArrow(trace, f"c {kind}, b long, entry long, leave long, last long")


def format_chats(
    df: DataFrame, costs: Costs = Costs(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation, or per block of a long one: the repair in numbers and the rendering."""
    rows = _turns(df, conv_col, turn_col, role_col, text_col)
    original = rows.schema["conv_id"].dataType
    kind = "long" if original.simpleString() in ("tinyint", "smallint", "int", "bigint") else "string"
    turns = rows.withColumn("conv_id", F.col("conv_id").cast(kind))
    ends = turns.agg(F.min("block").alias("u"), F.max("block").alias("v")).first()
    if ends["u"] == ends["v"]:  # every conversation lies in one block
        placed = turns.withColumns({k: F.lit(None).cast("long") for k in ("entry", "leave", "last")})
    else:
        borders = stage(_borders(turns, costs, kind), "borders")
        same = (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("b"))
        placed = turns.join(borders, same, "left").drop("c", "b")

    def solve(key, rows):
        entry, leave, last = rows[0][2:5]
        alone = entry is None
        entry = START if alone else entry
        last = 1 if alone else last
        roles = [role_number(r[0]) for r in rows]
        path = repair(roles, costs, entry, None if last else leave)
        text, opened = render(path, [r[1] for r in rows], entry, bool(last))
        tail = _TO_END[path[-1].target] if last else ()
        inserted = sum(len(s.inserted) for s in path) + len(tail)
        relabelled = sum(s.target != r for s, r in zip(path, roles))
        cost = sum(s.cost for s in path) + costs.insert * len(tail)
        merged = sum(s.merged for s in path)
        return (*key, len(rows), opened, merged, relabelled, inserted, int(cost), text)

    names = ["conv_id", "block", "n_turns", "n_opened", "n_merged", "n_relabelled", "n_inserted", "cost", "rendered"]
    schema = f"conv_id {kind}, " + ", ".join(f"{n} long" for n in names[1:-1]) + ", rendered string"
    done = _by_block(placed, ["role", "text", "entry", "leave", "last"], solve, schema)
    return done.withColumn("conv_id", F.col("conv_id").cast(original)).withColumnRenamed("conv_id", conv_col)
