"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in
turn, and it ends with the assistant.  A conversation that is not is repaired by
merging a turn into the one before, giving a turn another role, or putting in
empty turns, at the least total cost: a shortest path through the automaton of
legal turns, turn by turn.

Conversations are sorted over the cluster by id and turn and cut into chunks of
at most ``CHUNK_TURNS`` turns and about ``CHUNK_CHARS`` characters.  Each chunk
gives its costs from every state to every state, a small matrix; per
conversation the matrices are multiplied (least sums) to find the states at the
cuts, and each chunk then repairs and renders its turns by itself.  Matrices of
a conversation of more than ``2 ** RUN_BITS`` chunks are multiplied run by run,
the products again, and the states are found from the whole down to the chunks.
So a conversation of any length is never held whole by a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import stored

STATES = ("start", "system", "user", "assistant")
#: Which turn may follow which state, and the state to end in.
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
LAST = 3
#: Costs; the lower digits settle ties: rather merge, then insert, then relabel.
MERGE, INSERT, RELABEL, NAME = 1001, 2002, 3003, 1000
#: Other names of the roles.
ROLES = {"system": 1, "developer": 1, "user": 2, "human": 2, "assistant": 3, "bot": 3, "gpt": 3, "model": 3}
CHUNK_TURNS, CHUNK_CHARS = 1000, 1_000_000
#: At most two to this power matrices are multiplied by one task.
RUN_BITS = 8
NEVER = 1 << 60


def _paths() -> dict[tuple[int, int], tuple[int, ...] | None]:
    """The empty turns to put between a state and a turn that follows it."""
    out: dict = {}
    for state in LEGAL:
        reached, edge = {}, [(x, ()) for x in LEGAL[state]]
        while edge:
            turn, between = edge.pop(0)
            if turn not in reached:
                reached[turn] = between
                edge += [(x, (*between, turn)) for x in LEGAL[turn]]
        out |= {(state, x): reached.get(x) for x in (1, 2, 3)}
    return out


PATHS = _paths()


def role_of(name: str | None) -> int:
    """Number of the role; 0 for null and unknown names."""
    return ROLES.get((name or "").strip().lower(), 0)


def steps(role: int) -> list[tuple[int, int, int, str]]:
    """``state, next state, cost, action`` for a turn of that role."""
    out = []
    for state in LEGAL:
        for turn in (1, 2, 3):
            named = 0 if turn == role else RELABEL if role else NAME
            action = "keep" if turn == role else "relabel"
            if state == turn:
                out.append((state, turn, named + MERGE, "merge" if turn == role else "relabel+merge"))
            between = PATHS[state, turn]
            if between is not None and (state != turn or between):
                out.append((state, turn, named + INSERT * len(between), action))
    return out


_STEPS = {role: steps(role) for role in range(4)}


def end_cost(state: int) -> int:
    """Cost of the empty turns that bring a state to the end."""
    return 0 if state == LAST else INSERT * (len(PATHS[state, LAST]) + 1)


def chunk_costs(roles: list[int]) -> list[list[int]]:
    """Least cost of the chunk's turns from each state to each state."""
    out = []
    for start in LEGAL:
        cost = [NEVER] * 4
        cost[start] = 0
        for role in roles:
            after = [NEVER] * 4
            for state, turn, price, _ in _STEPS[role]:
                if cost[state] + price < after[turn]:
                    after[turn] = cost[state] + price
            cost = after
        out.append(cost)
    return out


def repair(roles: list[int], start: int, end: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """Each turn's role, action and the empty turns before it on the cheapest way from one state to another."""
    cost, back = [NEVER] * 4, []
    cost[start] = 0
    for role in roles:
        after, came = [NEVER] * 4, [None] * 4
        for state, turn, price, action in _STEPS[role]:
            if cost[state] + price < after[turn]:
                after[turn], came[turn] = cost[state] + price, (state, action)
        cost = after
        back.append(came)
    out, state = [], end
    for came in reversed(back):
        before, action = came[state]
        out.append((state, action, () if "merge" in action else PATHS[before, state]))
        state = before
    return out[::-1]


def opened(turn: int) -> str:
    return f"<|{STATES[turn]}|>\n"


CLOSED = "<|end|>\n"


def escaped(text: str | None) -> str:
    """A text that holds no marks of its own."""
    return (text or "").replace("<|", "< |")


def _chunks(turns: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, key, roles, texts, chars = TaskContext.get().partitionId(), 0, None, [], [], 0

        def chunk() -> pa.RecordBatch:
            costs = [c for row in chunk_costs([role_of(r) for r in roles]) for c in row]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], key_type), pa.array([part << 32 | count], pa.int64()), pa.array([costs], pa.list_(pa.int64())),
                 pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string()))], names=["conv", "chunk", "costs", "roles", "texts"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                if roles and ((conv,) != key or len(roles) >= CHUNK_TURNS or chars >= CHUNK_CHARS):
                    yield chunk()
                    roles, texts, chars, count = [], [], 0, count + 1
                key = (conv,)
                roles.append(role)
                texts.append(text)
                chars += len(text or "")
        if roles:
            yield chunk()

    conv = turns.schema["conv"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv {conv}, chunk long, costs array<long>, roles array<string>, texts array<string>")


def _through(costs: list[np.ndarray], reach: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Least costs at the end of a run of matrices, and each matrix's cheapest way back."""
    back = []
    for matrix in costs:
        through = np.minimum(reach[:, None] + matrix, NEVER)
        back.append(through.argmin(0))
        reach = through.min(0)
    return reach, back


def _matrices(group: pa.Table) -> list[np.ndarray]:
    return [_matrix(c) for c in group.column("costs").to_pylist()]


def _matrix(costs: list[int]) -> np.ndarray:
    return np.array(costs, "i8").reshape(4, 4)


def _states(back: list[np.ndarray], leave: int) -> list[int]:
    """States at the cuts of a run that is left in a state."""
    out = [leave]
    for came in reversed(back):
        out.append(int(came[out[-1]]))
    return out[::-1]


def _ends(reach: np.ndarray) -> tuple[int, int]:
    """The state in which a conversation is best left, and its cost."""
    total = [min(int(c) + end_cost(s), NEVER) for s, c in enumerate(reach)]
    return int(np.argmin(total)), min(total) // 1000


_FROM_START = np.array([0, NEVER, NEVER, NEVER])
_CUTS = [("chunk", pa.int64()), ("enters", pa.int32()), ("leaves", pa.int32()), ("before", pa.int64()), ("last", pa.bool_()), ("cost", pa.int64())]


def _cuts(chunks: DataFrame) -> DataFrame:
    """``conv, chunk, enters, leaves, before, last, cost``: each chunk's states and the turns before it."""
    def cuts(rows: list[dict]) -> list[dict]:
        reach, back = _through([_matrix(r["costs"]) for r in rows], _FROM_START)
        leave, cost = _ends(reach)
        states, before, out = _states(back, leave), 0, []
        for i, r in enumerate(rows):
            out.append({"conv": r["conv"], "chunk": r["chunk"], "enters": states[i], "leaves": states[i + 1], "before": before, "last": i == len(rows) - 1, "cost": cost})
            before += r["n"]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows = None, []
        for batch in batches:
            schema, done = pa.schema([("conv", batch.schema.field("conv").type), *_CUTS]), []
            for row in batch.to_pylist():
                if rows and row["conv"] != rows[0]["conv"]:
                    done += cuts(rows)
                    rows = []
                rows.append(row)
            yield pa.RecordBatch.from_pylist(done, schema)
        if rows:
            yield pa.RecordBatch.from_pylist(cuts(rows), schema)

    def by_conversation(small: DataFrame) -> DataFrame:
        """Conversations one behind the other, in as many tasks as a shuffle has: their cost rows are too few bytes for Spark to tell."""
        parts = int(small.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return small.repartition(parts, "conv").sortWithinPartitions("conv", "chunk").mapInArrow(run, shape)

    conv = chunks.schema["conv"].dataType.simpleString()
    small = chunks.select("conv", "chunk", "costs", F.size("roles").cast("long").alias("n"))
    many = stored(small.groupBy("conv").agg(F.count(F.lit(1)).alias("chunks")).where(F.col("chunks") > 1 << RUN_BITS).select(F.col("conv").alias("of")), "long")
    shape = f"conv {conv}, chunk long, enters int, leaves int, before long, last boolean, cost long"
    if many.isEmpty():
        return by_conversation(small)
    same = F.col("conv").eqNullSafe(F.col("of"))
    return by_conversation(small.join(many, same, "left_anti")).unionByName(_long_cuts(small.join(many, same, "left_semi"), conv))


def _long_cuts(small: DataFrame, conv: str) -> DataFrame:
    """The same for conversations of very many chunks, in levels of bounded groups."""
    def multiplied(group: pa.Table) -> pa.Table:
        group = group.sort_by([("hi", "ascending"), ("lo", "ascending")])
        costs = _matrices(group)
        product = [int(c) for state in range(4) for c in _through(costs, np.where(np.arange(4) == state, 0, NEVER))[0]]
        return pa.table({"conv": group.column("conv").slice(0, 1), "hi": group.column("up_hi").slice(0, 1), "lo": group.column("up_lo").slice(0, 1),
                         "costs": pa.array([product], pa.list_(pa.int64())), "n": pa.array([sum(group.column("n").to_pylist())], pa.int64())})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [_ends(_through([m], _FROM_START)[0]) for m in _matrices(batch)]
            k = len(ends)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([0] * k, pa.int32()), pa.array([s for s, _ in ends], pa.int32()), pa.array([0] * k, pa.int64()),
                 pa.array([True] * k), pa.array([c for _, c in ends], pa.int64())], names=["conv", "hi", "lo", *states])

    def divided(group: pa.Table) -> pa.Table:
        group = group.sort_by([("hi", "ascending"), ("lo", "ascending")])
        enter, leave, before, last, cost = (group.column(c)[0].as_py() for c in states)
        at = _states(_through(_matrices(group), np.where(np.arange(4) == enter, 0, NEVER))[1], leave)
        n = np.array(group.column("n").to_pylist())
        return pa.table({
            "conv": group.column("conv"), "hi": group.column("hi"), "lo": group.column("lo"), "enters": pa.array(at[:-1], pa.int32()), "leaves": pa.array(at[1:], pa.int32()),
            "before": pa.array(before + np.cumsum(n) - n, pa.int64()), "last": pa.array([last and i == len(n) - 1 for i in range(len(n))]),
            "cost": pa.array([cost] * len(n), pa.int64())})

    states = ["enters", "leaves", "before", "last", "cost"]
    shape = f"conv {conv}, hi long, lo long, enters int, leaves int, before long, last boolean, cost long"
    table, levels = stored(small.select("conv", F.shiftright("chunk", 32).alias("hi"), F.expr("chunk & 4294967295").alias("lo"), "costs", "n"), "costs"), []
    while any(top := table.agg(F.max("hi"), F.max("lo")).first()):
        up_hi, up_lo = ("hi", f"shiftright(lo, {RUN_BITS})") if top[1] else (f"shiftright(hi, {RUN_BITS})", "lo")
        levels.append(table.withColumn("up_hi", F.expr(up_hi)).withColumn("up_lo", F.expr(up_lo)))
        table = stored(levels[-1].groupBy("conv", "up_hi", "up_lo").applyInArrow(multiplied, f"conv {conv}, hi long, lo long, costs array<long>, n long"), "costs")
    found = table.select("conv", "hi", "lo", "costs").mapInArrow(whole, shape)
    for level in reversed(levels):
        above = stored(found, "cuts").select(F.col("conv").alias("of"), F.col("hi").alias("of_hi"), F.col("lo").alias("of_lo"), *states)
        met = level.join(above, F.col("conv").eqNullSafe(F.col("of")) & (F.col("up_hi") == F.col("of_hi")) & (F.col("up_lo") == F.col("of_lo")))
        found = met.groupBy("conv", "up_hi", "up_lo").applyInArrow(divided, shape)
    return found.select("conv", F.expr("shiftleft(hi, 32) | lo").alias("chunk"), *states)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: ``conv_col, position, role, action, inserted, rendered, cost``.

    The ``rendered`` pieces of a conversation, in order of ``position``, are its
    chat text: ``<|role|>``, the text, ``<|end|>``; a merged text follows a blank
    line, empty turns are rendered before the turn they were put in for (at the
    end, behind the last).  ``action`` is keep, merge, relabel or both,
    ``inserted`` counts the empty turns, ``cost`` is that of the conversation.
    Turns stand in the order of ``turn_col`` (null first), then role and text;
    rows that agree in all four columns are one turn.  A null or unknown role
    gets the one that is cheapest, a null text is empty, ``<|`` in a text is
    written ``< |``.  Rows with a null id are one conversation.
    """
    named = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    order = ["conv", "turn", "role", "text"]
    spark = turns.sparkSession
    in_order = named.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    chunks = stored(_chunks(in_order), "chats")
    cuts = _cuts(chunks).withColumnRenamed("conv", "of").withColumnRenamed("chunk", "number")
    ready = chunks.join(cuts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("number")))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                repaired = repair([role_of(r) for r in row["roles"]], row["enters"], row["leaves"])
                pieces, inserted = [], []
                for i, ((turn, action, between), text) in enumerate(zip(repaired, row["texts"])):
                    first = row["before"] + i == 0
                    close = "" if first else CLOSED
                    empty = "".join(opened(x) + CLOSED for x in between)
                    pieces.append(("\n\n" if "merge" in action else close + empty + opened(turn)) + escaped(text))
                    inserted.append(len(between))
                if row["last"]:
                    ends = (*PATHS[row["leaves"], LAST], LAST) if row["leaves"] != LAST else ()
                    pieces[-1] += CLOSED + "".join(opened(x) + CLOSED for x in ends)
                    inserted[-1] += len(ends)
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["conv"]] * n, batch.schema.field("conv").type), pa.array([row["before"] + i for i in range(n)], pa.int64()),
                     pa.array([STATES[t] for t, _, _ in repaired]), pa.array([a for _, a, _ in repaired]), pa.array(inserted, pa.int32()),
                     pa.array(pieces), pa.array([row["cost"]] * n, pa.int64())],
                    names=[conv_col, "position", "role", "action", "inserted", "rendered", "cost"])

    conv = chunks.schema["conv"].dataType.simpleString()
    return ready.select("conv", "roles", "texts", "enters", "leaves", "before", "last", "cost").mapInArrow(
        render, f"`{conv_col}` {conv}, position long, role string, action string, inserted int, rendered string, cost long")
