"""Chat formatting by minimum-cost role repair.

Legal turns: an optional system turn, then user and assistant in turn, user
first, assistant last.  Each message is kept, merged into the turn before it
(same role), relabelled, or preceded by inserted empty turns; dynamic
programming over the automaton's states finds the cheapest sequence, which is
rendered with one marked segment per turn.

A conversation of any length: its messages are numbered in order, whatever
their turns (rows are dealt by range of the whole order and numbered within a
task; a conversation that goes on from one task to the next carries its count
over), and cut into blocks of ``BLOCK`` messages.  A block's costs from each entry state to each exit state form a
small matrix, and matrices combine (minimum of sums), level by level, up to
the conversation; the states chosen at the top go down to the blocks, which
are then repaired on their own.  So no task holds more than one block, and a
block's text is a part of the conversation's: parts in order, joined, are the
whole.

Defined cases: messages are in order of (turn, role, text), nulls first;
an exactly repeated row is a message of its own each time; a null text is empty; roles are trimmed and
lower-cased, known aliases are free, and an unknown or null role must be
relabelled; a null conversation id is a conversation; other columns are
ignored; ties go to the earlier of system, user, assistant; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.util import by_value, stage

BLOCK = 512
#: Copies of one row that a task makes at a time.
RUN = 65_536
MERGE, INSERT, RELABEL = 4, 6, 10

# Fixed values.
ROLES = ("", "system", "user", "assistant")  # by state; state 0: nothing yet
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FAR = 1 << 60


def _paths() -> dict:
    """(state, state) -> roles between them that must be inserted."""
    out = {}
    for s in range(4):
        todo = [(s, ())]
        while todo:  # breadth first: the fewest insertions
            at, inner = todo.pop(0)
            for q in NEXT[at]:
                if (s, q) not in out:
                    out[s, q] = inner
                    todo.append((q, (*inner, q)))
    return out


PATHS = _paths()


def step(state: int, role: int | None, new: int) -> int:
    """Cost of a message of ``role`` that becomes ``new`` after ``state``."""
    relabel = 0 if role == new else RELABEL
    if state == new:
        return MERGE + relabel
    inner = PATHS.get((state, new))
    return FAR if inner is None else INSERT * len(inner) + relabel


def ending(state: int) -> int:
    """Cost of the empty turns that make ``state`` a legal end."""
    return 0 if state == 3 else INSERT * (len(PATHS[state, 3]) + 1)


def role_state(role: str | None) -> int | None:
    r = (role or "").strip().lower()
    r = ALIASES.get(r, r)
    return ROLES.index(r) if r in ROLES[1:] else None


def transfer(roles: list) -> list[list[int]]:
    """Least cost from each entry state to each exit state."""
    rows = []
    for entry in range(4):
        cost = [FAR] * 4
        cost[entry] = 0
        for r in roles:
            cost = [FAR, *(min(min(cost[s] + step(s, r, q) for s in range(4)), FAR) for q in (1, 2, 3))]
        rows.append(cost)
    return rows


def combine(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(min(a[s][m] + b[m][t] for m in range(4)), FAR) for t in range(4)] for s in range(4)]


def trace(roles: list, entry: int, leave: int) -> list[int]:
    """The cheapest new roles from ``entry`` to ``leave``."""
    back, cost = [], [FAR] * 4
    cost[entry] = 0
    for r in roles:
        new, came = [FAR] * 4, [0] * 4
        for q in (1, 2, 3):
            new[q], came[q] = min((cost[s] + step(s, r, q), s) for s in range(4))
        back.append(came)
        cost = new
    out = []
    for came in reversed(back):
        out.append(leave)
        leave = came[leave]
    return out[::-1]


def states_between(matrices: list, entry: int, leave: int) -> list[tuple[int, int]]:
    """Entry and exit state of each of a run of matrices."""
    ahead = [None] * len(matrices)
    cost = [0 if t == leave else FAR for t in range(4)]
    for k in range(len(matrices) - 1, -1, -1):
        ahead[k] = cost
        cost = [min(min(matrices[k][s][t] + cost[t] for t in range(4)), FAR) for s in range(4)]
    out = []
    for m, rest in zip(matrices, ahead):
        t = min(range(4), key=lambda t: (m[entry][t] + rest[t], t))
        out.append((entry, t))
        entry = t
    return out


def render(rows: list[tuple], entry: int, leave: int, last: bool) -> dict:
    """Rows ``(role, text)`` of a block as a part of the rendered text.  A
    turn is ended by what follows it, so that a merge can go on across parts."""
    roles = [role_state(r) for r, _ in rows]
    new = trace(roles, entry, leave)
    out, n = [], {"merged": 0, "relabelled": 0, "inserted": 0, "turns": 0}
    state = entry

    def begin(q: int):
        out.append(("<|im_end|>\n" if state else "") + f"<|im_start|>{ROLES[q]}\n")
        n["turns"] += 1

    for (_, text), r, q in zip(rows, roles, new):
        n["relabelled"] += r != q
        if q == state:
            n["merged"] += 1
            out.append("\n")
        else:
            for x in PATHS[state, q]:
                begin(x)
                n["inserted"] += 1
                state = x
            begin(q)
            state = q
        out.append(text or "")
    if last:
        if state != 3:
            for x in (*PATHS[state, 3], 3):
                begin(x)
                n["inserted"] += 1
                state = x
        out.append("<|im_end|>\n")
    cost = MERGE * n["merged"] + RELABEL * n["relabelled"] + INSERT * n["inserted"]
    return {"cost": cost, "text": "".join(out), **n}


_MATRIX = "m array<bigint>"


def _flat(m):
    return [min(x, FAR) for row in m for x in row]


def _square(flat):
    return [list(flat[i:i + 4]) for i in (0, 4, 8, 12)]


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order with their task and, within it, the number of the first of
    their copies in the conversation."""
    task, last, n = TaskContext.get().partitionId(), None, 0
    for b in batches:
        numbers = []
        for conv, copies in zip(b.column("conv").to_pylist(), b.column("copies").to_pylist()):
            n = n if last == (conv,) else 0
            last = (conv,)
            numbers.append(n)
            n += copies
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([task] * b.num_rows, pa.int32()), pa.array(numbers, pa.int64())],
                                         [*b.schema.names, "task", "n"])


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) with their position ``n`` in the
    conversation, from 0.  Equal rows are counted first and travel as one, so
    that no task holds a whole conversation."""
    order = ("conv", "turn", "role", "text")
    rows = rows.groupBy(*order).agg(F.count("*").alias("copies"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in order)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(rows.mapInArrow(_numbered, f"{kinds}, copies bigint, task int, n bigint"), "chat-rows")
    # a conversation's count before each task: beyond 0 for a task's first conversation alone
    w = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv", "task").agg(F.sum("copies").alias("count")).withColumn("before", F.sum("count").over(w)).where("before > 0")
    before = F.broadcast(before.select(F.col("conv").alias("c2"), F.col("task").alias("t2"), "before"))  # a row a task at most
    out = rows.join(before, (rows["task"] == F.col("t2")) & rows["conv"].eqNullSafe(F.col("c2")), "left")
    first = F.col("n") + F.coalesce("before", F.lit(0))
    out = out.select(*order, first.alias("n"), "copies")
    # rows with very many copies are first dealt out in runs of RUN
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN).cast("bigint"))).alias("r")
    many = out.where(F.col("copies") > RUN).select("*", run).repartition("n", "r").select(
        *order, (F.col("n") + F.col("r") * RUN).alias("n"), F.least(F.col("copies") - F.col("r") * RUN, F.lit(RUN)).alias("copies"))
    out = out.where(F.col("copies") <= RUN).union(many)
    return out.select(*order, F.explode(F.sequence(F.col("n"), F.col("n") + F.col("copies") - 1)).alias("n"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(conv_col, part, messages, turns, merged, relabelled, inserted, cost,
    text)``: one row per block, numbered from 0 in order."""
    conv_type = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = positions(rows).select("conv", "turn", "role", "text", F.floor(F.col("n") / block).cast("bigint").alias("b"))

    def order(t):
        got = zip(*(t[c].to_pylist() for c in ("turn", "role", "text")))
        return [r[1:] for r in sorted(got, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))]

    # up: one matrix per block, then per run of blocks, until a conversation has few
    def leaf(key, t):
        m = transfer([role_state(r) for r, _ in order(t)])
        return pa.table({"conv": pa.array([key[0].as_py()], t.schema.field("conv").type), "b": pa.array([key[1].as_py()]),
                         "m": pa.array([_flat(m)], pa.list_(pa.int64()))})

    def parent(key, t):
        kids = sorted(zip(t["b"].to_pylist(), t["m"].to_pylist()))
        m = reduce(combine, (_square(f) for _, f in kids))
        return pa.table({"conv": pa.array([key[0].as_py()], t.schema.field("conv").type), "b": pa.array([key[1].as_py()]),
                         "m": pa.array([_flat(m)], pa.list_(pa.int64()))})

    ddl = f"conv {conv_type}, b bigint, {_MATRIX}"
    # most tables have one block per conversation: no matrices are needed then
    many = rows.groupBy("conv").agg(F.count_distinct("b").alias("n")).agg(F.max("n")).first()[0] or 0
    if many <= 1:
        states = rows.select("conv", "b").distinct().select(
            F.col("conv").alias("conv"), F.col("b").alias("b"), F.lit(0).alias("s"), F.lit(-1).alias("t"), F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("last"))
    else:
        levels = [stage(rows.groupBy("conv", "b").applyInArrow(leaf, ddl), "chat-costs")]
        while (levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > block:
            up = levels[-1].withColumn("up", F.floor(F.col("b") / block).cast("bigint"))
            levels.append(stage(up.groupBy("conv", "up").applyInArrow(parent, ddl), "chat-costs"))

        # down: entry and exit states, from the conversation to its blocks
        def spread(conv, kids, entry, leave, part, last, kind):
            chosen = states_between([_square(f) for _, f, _ in kids], entry, leave)
            n = [c for _, _, c in kids]
            return pa.table({
                "conv": pa.array([conv] * len(kids), kind), "b": pa.array([b for b, _, _ in kids]),
                "s": pa.array([s for s, _ in chosen], pa.int32()), "t": pa.array([t for _, t in chosen], pa.int32()),
                "part": pa.array([part + sum(n[:k]) for k in range(len(kids))], pa.int64()),
                "last": pa.array([last and k == len(kids) - 1 for k in range(len(kids))])})

        state_ddl = f"conv {conv_type}, b bigint, s int, t int, part bigint, last boolean"

        def top(key, t):
            kids = sorted(zip(t["b"].to_pylist(), t["m"].to_pylist(), t["n"].to_pylist()))
            whole = reduce(combine, (_square(f) for _, f, _ in kids))
            leave = min(range(1, 4), key=lambda q: (whole[0][q] + ending(q), q))
            return spread(key[0].as_py(), kids, 0, leave, 0, True, t.schema.field("conv").type)

        def down(key, t):
            kids = sorted(zip(t["b"].to_pylist(), t["m"].to_pylist(), t["n"].to_pylist()))
            first = lambda c: t[c][0].as_py()
            return spread(key[0].as_py(), kids, first("s"), first("t"), first("part"), first("last"),
                          t.schema.field("conv").type)

        # blocks under each matrix, for numbering
        counted = [levels[0].withColumn("n", F.lit(1).cast("bigint"))]
        for lower, upper in zip(levels, levels[1:]):
            n = counted[-1].groupBy("conv", F.floor(F.col("b") / block).cast("bigint").alias("b")).agg(F.sum("n").alias("n"))
            n = n.withColumnsRenamed({"conv": "c2", "b": "b2"})
            counted.append(upper.join(n, upper["conv"].eqNullSafe(n["c2"]) & (upper["b"] == n["b2"])).drop("c2", "b2"))
        states = stage(counted[-1].groupBy("conv").applyInArrow(top, state_ddl), "chat-states")
        for lower in reversed(counted[:-1]):
            over = states.withColumnsRenamed({"conv": "c2", "b": "b2"})
            kids = lower.withColumn("up", F.floor(F.col("b") / block).cast("bigint"))
            kids = kids.join(over, kids["conv"].eqNullSafe(over["c2"]) & (kids["up"] == over["b2"]))
            states = stage(kids.drop("c2", "b2").groupBy("conv", "up").applyInArrow(down, state_ddl), "chat-states")

    counts = ("turns", "merged", "relabelled", "inserted", "cost")

    def repair(key, left, right):
        kind = left.schema.field("conv").type
        got = order(left)
        one = {c: right[c][0].as_py() for c in ("s", "t", "part", "last")}
        leave = one["t"]
        if leave < 0:  # the whole conversation: any legal end
            whole = transfer([role_state(r) for r, _ in got])
            leave = min(range(1, 4), key=lambda q: (whole[0][q] + ending(q), q))
        out = render(got, one["s"], leave, one["last"])
        return pa.table({"conv": pa.array([key[0].as_py()], kind), "part": pa.array([one["part"]], pa.int64()),
                         "messages": pa.array([len(got)], pa.int64()),
                         **{c: pa.array([out[c]], pa.int64()) for c in counts}, "text": pa.array([out["text"]], pa.string())})

    out = rows.groupBy("conv", "b").cogroup(states.groupBy("conv", "b")).applyInArrow(
        repair, f"conv {conv_type}, part bigint, messages bigint, " + ", ".join(f"{c} bigint" for c in counts) + ", text string")
    return out.withColumnRenamed("conv", conv_col)


by_value(__name__)
