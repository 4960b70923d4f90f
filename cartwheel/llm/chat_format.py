"""Chat formatting with minimum-cost role repair.

A legal conversation may open with a system message and then alternates user
and assistant, ending with the assistant.  Each turn may be kept, relabelled,
merged into the message before it, or have empty messages inserted before it;
dynamic programming over the automaton of legal turns picks the repairs of
least total cost.

The program's steps compose as matrices over (min, +), so a conversation of
any length is cut into chunks of CHUNK_TURNS turns by rank: rows are sorted
over range partitions (which split a conversation, a turn number or a run of
equal rows wherever they must), numbered in their task, and one row per
partition gives the rank.  The chunks' matrices are folded in order, first to
blocks of FOLD chunks, then per conversation, and each chunk is repaired
between its known entry and exit states.  The rendered text comes as pieces,
one row per turn; their concatenation in order is the chat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwheel.llm.common import ship, table

ROLES = ("system", "user", "assistant")
#: States: nothing yet, then the role of the last message.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FAR = 1 << 40
#: Costs: joining a message to the one before, inserting an empty one, and
#: relabelling by (given role, chosen role); a role that is none of ROLES
#: fits user and assistant alike.
MERGE, INSERT = 1, 2
RELABEL = {
    "system": {"system": 0, "user": 3, "assistant": 4},
    "user": {"system": 6, "user": 0, "assistant": 3},
    "assistant": {"system": 6, "user": 3, "assistant": 0},
    None: {"system": 4, "user": 1, "assistant": 1},
}
#: Empty messages needed between a state and a new message; no entry: illegal.
BETWEEN = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,),
    (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}
#: Empty messages that end a conversation.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
CHUNK_TURNS, FOLD = 512, 512


def _moves(role):
    """(cost, from, to, merged) of every legal way to take a turn."""
    out = []
    for state in range(STATES):
        for to in (SYSTEM, USER, ASSISTANT):
            change = RELABEL[role][ROLES[to - 1]]
            if state == to:
                out.append((change + MERGE, state, to, True))
            if (state, to) in BETWEEN:
                out.append((change + INSERT * len(BETWEEN[state, to]), state, to, False))
    return sorted(out)


MOVES = {role: _moves(role) for role in RELABEL}


def known(role):
    role = role.strip().lower() if role else None
    return role if role in ROLES else None


def step_matrix(role) -> np.ndarray:
    m = np.full((STATES, STATES), FAR, dtype=np.int64)
    for cost, a, b, _ in MOVES[role]:
        m[a, b] = min(m[a, b], cost)
    return m


STEPS = {role: step_matrix(role) for role in RELABEL}


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), FAR)


def repair(roles, entry: int = START, leave: int | None = None) -> list[tuple[int, int, bool]]:
    """(from, to, merged) of every turn on a cheapest path from ``entry`` to
    ``leave``, or to the cheapest end; of equal paths the one whose last
    states, cheapest moves first, come first."""
    cost = [FAR] * STATES
    cost[entry] = 0
    back = []
    for role in roles:
        now, how = [FAR] * STATES, [None] * STATES
        for c, a, b, merged in MOVES[role]:
            if cost[a] + c < now[b]:
                now[b], how[b] = cost[a] + c, (a, b, merged)
        back.append(how)
        cost = now
    if leave is None:
        leave = min(range(STATES), key=lambda s: (cost[s] + INSERT * len(CLOSING[s]), s))
    path, state = [], leave
    for how in reversed(back):
        path.append(how[state])
        state = how[state][0]
    return path[::-1]


def open_tag(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


END = "<|end|>\n"


def pieces(turns, entry: int, leave: int | None, last: bool):
    """(k, action, role, cost, piece) of a chunk's (role, text) turns; ``last``
    closes the conversation."""
    roles = [known(r) for r, _ in turns]
    state, out = entry, []
    path = repair(roles, entry, leave)
    for k, ((given, text), role, (a, b, merged)) in enumerate(zip(turns, roles, path)):
        text = text or ""
        change = RELABEL[role][ROLES[b - 1]]
        name = "keep" if ROLES[b - 1] == role else "relabel"
        if merged:
            out.append((k, "merge" if name == "keep" else "relabel and merge", ROLES[b - 1], change + MERGE, "\n\n" + text))
        else:
            empty = BETWEEN[a, b]
            made = (END if a != START else "") + "".join(open_tag(r) + END for r in empty)
            out.append((k, name if not empty else f"insert and {name}", ROLES[b - 1], change + INSERT * len(empty), made + open_tag(b) + text))
        state = b
    if last:
        empty = CLOSING[state]
        made = END * (state != START) + "".join(open_tag(r) + END for r in empty)
        out.append((len(turns), "insert and close" if empty else "close", None, INSERT * len(empty), made))
    return out


def _groups(batches, columns, part="chunk"):
    """Consecutive rows of one (conv_id, ``part``), or of one conv_id, which
    the sort has joined."""
    key, rows = None, []
    for batch in batches:
        t = batch.to_pydict()
        for conv, chunk, *rest in zip(t["conv_id"], t[part] if part else [None] * batch.num_rows, *(t[c] for c in columns)):
            if (conv, chunk) != key:
                if rows:
                    yield key, rows
                key, rows = (conv, chunk), []
            rows.append(rest)
    if rows:
        yield key, rows


def _matrices(batches):
    out = []
    for (conv, chunk), rows in _groups(batches, ["role"]):
        m = None
        for (role,) in rows:
            m = STEPS[known(role)] if m is None else compose(m, STEPS[known(role)])
        out.append((conv, chunk, m.ravel().tolist()))
        if len(out) >= 2000:
            yield _batch(out, ["conv_id", "chunk", "matrix"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])
            out = []
    if out:
        yield _batch(out, ["conv_id", "chunk", "matrix"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def _batch(rows, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _number(batches):
    """Position of a row among the consecutive rows of its conversation in
    this task."""
    conv, n = (), 0
    for batch in batches:
        at = []
        for c in batch.column("conv_id").to_pylist():
            conv, n = (c, n + 1) if c == conv else (c, 0)
            at.append(n)
        yield batch.append_column("at", pa.array(at, pa.int64()))


def _compose_blocks(batches):
    """One matrix per (conv_id, block) from those of its chunks, in order."""
    out = []
    for (conv, block), rows in _groups(batches, ["matrix"], "block"):
        m = None
        for (flat,) in rows:
            x = np.array(flat, dtype=np.int64).reshape(STATES, STATES)
            m = x if m is None else compose(m, x)
        out.append((conv, block, m.ravel().tolist()))
        if len(out) >= 2000:
            yield _batch(out, ["conv_id", "chunk", "matrix"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])
            out = []
    if out:
        yield _batch(out, ["conv_id", "chunk", "matrix"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def _places(parts, entry: int, leave: int | None):
    """(number, entry, leave) of the (number, matrix) parts on a cheapest way
    from ``entry`` to ``leave``, or to the cheapest end: forward costs, then
    traced back."""
    cost = np.full(STATES, FAR, dtype=np.int64)
    cost[entry] = 0
    before = []
    for _, flat in parts:
        before.append(cost)
        cost = np.minimum((cost[:, None] + np.array(flat, dtype=np.int64).reshape(STATES, STATES)).min(0), FAR)
    if leave is None:
        leave = min(range(STATES), key=lambda s: (int(cost[s]) + INSERT * len(CLOSING[s]), s))
    out = []
    for (number, flat), cost in zip(reversed(parts), reversed(before)):
        entry = int((cost + np.array(flat, dtype=np.int64).reshape(STATES, STATES)[:, leave]).argmin())
        out.append((number, entry, leave))
        leave = entry
    return out[::-1]


def _fold_blocks(batches):
    """Entry and exit state of every block of a conversation; the last ends it."""
    names, kinds = ["conv_id", "block", "from", "to", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    out = []
    for (conv, _), rows in _groups(batches, ["chunk", "matrix"], None):
        placed = _places(rows, START, None)
        out += [(conv, block, a, b, block == placed[-1][0]) for block, a, b in placed]
        if len(out) >= 20_000:
            yield _batch(out, names, kinds)
            out = []
    if out:
        yield _batch(out, names, kinds)


def _fold_chunks(batches):
    """Entry and exit state of every chunk inside its block."""
    names, kinds = ["conv_id", "chunk", "entry", "leave", "last"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    out = []
    for (conv, _), rows in _groups(batches, ["chunk", "matrix", "from", "to", "end"], "block"):
        _, _, entry, leave, end = rows[0]
        out += [(conv, chunk, a, b, end and chunk == rows[-1][0]) for chunk, a, b in _places([r[:2] for r in rows], entry, leave)]
        if len(out) >= 20_000:
            yield _batch(out, names, kinds)
            out = []
    if out:
        yield _batch(out, names, kinds)


def _render(batches):
    names = ["conv_id", "chunk", "k", "turn", "action", "role", "cost", "piece"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    out, size = [], 0
    for (conv, chunk), rows in _groups(batches, ["turn", "role", "text", "entry", "leave", "last"]):
        _, _, _, entry, leave, last = rows[0]
        for k, action, role, cost, piece in pieces([(r[1], r[2]) for r in rows], entry, leave, last):
            out.append((conv, chunk, k, rows[k][0] if k < len(rows) else None, action, role, cost, piece))
            size += len(piece)
        if size >= 1_000_000 or len(out) >= 5000:
            yield _batch(out, names, kinds)
            out, size = [], 0
    if out:
        yield _batch(out, names, kinds)


def format_chats(turns: DataFrame) -> DataFrame:
    """Rendered pieces of the repaired conversations: conv_id, chunk, k (their
    order), turn (null for the closing piece), action, role, cost, piece.

    Turns stand in order of turn (nulls last), equal turns in order of a hash
    of role and text, then role and text.  Roles are read trimmed and in lower
    case; null or other roles fit user or assistant at a small cost.  Null text is an
    empty message; repeated rows are turns of their own; a null conv_id is a
    conversation, too.  Ties between repairs fall to a fixed order within
    chunks of CHUNK_TURNS turns.  An empty table gives no rows; other columns
    are ignored.
    """
    spark = turns.sparkSession
    ship(spark)
    order = F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    base = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    # the row's number only lets the ranges cut runs of equal rows, whose order doesn't matter
    base = base.withColumns({"loose": F.col("turn").isNull(), "tie": order, "row": F.monotonically_increasing_id()})
    inside = ["conv_id", "loose", "turn", "tie", "role", "text"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = table(base.repartitionByRange(ranges, "conv_id", "loose", "turn", "tie", "row").sortWithinPartitions(*inside)
                     .select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("part"))
                     .mapInArrow(_number, "conv_id long, turn long, role string, text string, part int, at long"), "chat-turns")
    # rows of a conversation in earlier partitions; a partition goes on with one conversation at most, so it has one row here
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("shift", F.sum("n").over(earlier))
             .filter("shift is not null").select("conv_id", "part", "shift"))
    shift = table(shift, "chat-shifts")
    n, s = numbered.alias("n"), F.broadcast(shift).alias("s")
    rank = F.col("at") + F.coalesce("shift", F.lit(0))
    ranked = (n.join(s, F.col("n.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("n.part") == F.col("s.part")), "left")
              .select("n.conv_id", "turn", "role", "text", rank.alias("rank"), F.floor(rank / F.lit(CHUNK_TURNS)).cast("long").alias("chunk")))
    key = ["conv_id", "chunk"]
    short = ranked.select("conv_id", "chunk", "rank", "role").repartition(*key).sortWithinPartitions(*key, "rank")
    matrices = table(short.select("conv_id", "chunk", "role").mapInArrow(_matrices, "conv_id long, chunk long, matrix array<long>")
                     .withColumn("block", F.floor(F.col("chunk") / F.lit(FOLD)).cast("long")), "chat-matrices")
    by_block = matrices.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "chunk")
    blocks = by_block.mapInArrow(_compose_blocks, "conv_id long, chunk long, matrix array<long>")
    ends = table(blocks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
                 .mapInArrow(_fold_blocks, "conv_id long, block long, `from` int, `to` int, end boolean"), "chat-blocks")
    m, e = matrices.alias("m"), ends.alias("e")
    bounded = (m.join(e, F.col("m.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("m.block") == F.col("e.block")))
               .select("m.*", "e.from", "e.to", "e.end"))
    places = table(bounded.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "chunk")
                   .mapInArrow(_fold_chunks, "conv_id long, chunk long, entry int, leave int, last boolean"), "chat-places")
    b, p = ranked.alias("b"), places.alias("p")
    placed = b.join(p, F.col("b.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("b.chunk") == F.col("p.chunk"))).select("b.*", "entry", "leave", "last")
    return (placed.repartition(*key).sortWithinPartitions(*key, "rank")
            .select("conv_id", "chunk", "turn", "role", "text", "entry", "leave", "last")
            .mapInArrow(_render, "conv_id long, chunk long, k long, turn long, action string, role string, cost long, piece string"))


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
