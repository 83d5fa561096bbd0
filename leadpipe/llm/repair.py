"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation is right if the initials of its roles read `(s?(ua)+)?`.  Its
rows and the states of that grammar span a lattice: keeping a row, giving it
another role, deleting it and inserting one lead from node to node at a cost in
whole numbers, and the cheapest way to the end is the repair.

The auction keeps a price for each node and a path from an origin.  The path's
last node compares its price with the least of cost and price over its arcs: if
it is lower, it is raised to that and the path contracts by the node, else the
path extends along that arc.  Prices stay below what any arc allows, so a path
that arrives is a shortest one, and its prices are the lengths of the rest.  All
nodes are origins, from the last row to the first; a path has arrived when it
meets a node settled before.  So a row's auction is about its four nodes alone.

A row's costs depend on its initial and fault only, and prices may be moved up
all together.  So the auction of a row is held once for each such kind and
difference of prices, and the repair takes a step per row.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.llm import words as W
from leadpipe.session import scratch_path

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States of the grammar by the initial read last; a conversation may end in two of them.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = (BEGIN, SYSTEM, USER, ASSISTANT)
FINAL = (BEGIN, ASSISTANT)
AFTER = {
    BEGIN: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# What a row is to the lattice: an initial in small letters, or in capitals if it is truncated;
# FAULTY for one that has to go, OTHER and CUT for roles the grammar does not know.
FAULTY, OTHER, CUT = "x", "o", "O"

Arc = tuple[int, str, object]


def arcs(kind: str, state: int) -> list[tuple[int, str, int]]:
    """Costs, edits and next states of the ways on from a state over a row."""
    ways = [(DELETE, "D", state)]
    if kind != FAULTY:
        more = TRUNCATED if kind.isupper() else 0
        for initial, following in AFTER[state].items():
            if initial == kind.lower():
                ways.append((more, "K", following))
            if initial in ROLES:
                ways.append((RELABEL + more, "R", following))
    return ways


def inserts(state: int) -> list[tuple[int, str, int]]:
    return [(INSERT, "I", following) for initial, following in AFTER[state].items() if initial in ROLES]


def auction(graph: dict[object, list[Arc]], price: dict[object, int], settled: set, origin: object) -> None:
    """Raise prices until a path from the origin meets a settled node; its nodes are settled then.

    `graph` has the arcs of each node as cost, name and end.  Prices of settled
    nodes are the lengths of their shortest paths; no other price may be more
    than cost and price over any arc, and no cycle may cost nothing.
    """
    path = [origin]
    while path[-1] not in settled:
        node = path[-1]
        best, following = min(((cost + price[end], end) for cost, _, end in graph[node]), key=lambda way: way[0])
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(following)
    settled.update(path)


@functools.lru_cache(maxsize=1 << 14)
def _layer(kind: str, later: tuple[int, ...]) -> tuple[int, ...]:
    """Prices of the four states before a row, given those behind it; no row at the end, an empty kind."""
    graph = {("now", s): [(cost, edit, ("now", end)) for cost, edit, end in inserts(s)] for s in STATES}
    for s in STATES:
        if kind:
            graph["now", s] += [(cost, edit, ("then", end)) for cost, edit, end in arcs(kind, s)]
        elif s in FINAL:
            graph["now", s].append((0, "", ("then", s)))
    price = {("then", s): later[s] for s in STATES} | {("now", s): 0 for s in STATES}
    settled = {("then", s) for s in STATES}
    for s in STATES:
        auction(graph, price, settled, ("now", s))
    return tuple(price["now", s] for s in STATES)


def prices(kinds: str) -> list[tuple[int, tuple[int, ...]]]:
    """Prices of the states before each row and at the end, as the least one and what each is above it."""
    end = _layer("", (0, 0, 0, 0))
    found = [(0, end)]
    for kind in reversed(kinds):
        low, above = found[-1]
        now = _layer(kind, above)
        least = min(now)
        found.append((low + least, tuple(p - least for p in now)))
    found.reverse()
    return found


@functools.lru_cache(maxsize=1 << 16)
def _first_tight(kind: str, state: int, now: tuple[int, ...], then: tuple[int, ...], step: int) -> tuple[str, int]:
    """The tight arc of the least edit; prices behind the row are `step` higher than they say."""
    ways = [(edit, end) for cost, edit, end in inserts(state) if now[state] == cost + now[end]]
    if kind:
        ways += [(edit, end) for cost, edit, end in arcs(kind, state) if now[state] == cost + then[end] + step]
    return min(ways)


def cheapest(kinds: str) -> tuple[int, str]:
    """The least cost and, of the cheapest edits, the least in ASCII order.

    Converged prices make exactly the arcs of cheapest paths tight, those where
    the price is cost and price of the end.  In a state, edits of one name
    lead to one node, so taking the least name at each node gives the least string.
    """
    found, state, row, edits = prices(kinds), BEGIN, 0, []
    while row < len(kinds) or state not in FINAL:
        low, now = found[row]
        if row < len(kinds):
            then_low, then = found[row + 1]
            edit, state = _first_tight(kinds[row], state, now, then, then_low - low)
            row += edit != "I"
        else:
            edit, state = _first_tight("", state, now, now, 0)
        edits.append(edit)
    return found[0][0] + found[0][1][BEGIN], "".join(edits)


BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with some dropped, emptied, cut, repeated or given to the user.

    What happens to a row hangs on the CRC-32 of its conversation and turn; a null in any column is
    one blank to that hash, and a null role or text becomes one blank.  Other columns are left out.
    """
    blank = F.lit(" ")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in (conv, turn)))
    chance = F.crc32(named.cast("binary")) % 20
    said, by = (F.coalesce(F.col(c).cast("string"), blank) for c in (text, role))
    rows = turns.select(
        F.col(conv).alias(conv),
        F.col(turn).alias(turn),
        F.when(chance == 4, "user").otherwise(by).alias(role),
        F.when(chance == 1, "").when(chance == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias(text),
        F.when(chance == 0, 0).when(chance == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.withColumn("_times", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times")


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows as conv, turn, role, text and a digest that stands for role and text in their order."""
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def plan(
    turns: DataFrame,
    conversations: DataFrame | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation, those of `conversations` without a row too: what is wrong and the repair.

    Rows go by turn, nulls first, those of one turn by role and then by the digest of the text; a null
    role or text is one blank; rows without a conversation id are one conversation.  `gaps` are the
    turns missing between the least and the greatest; `blank`, `duplicate` and `truncated` count the
    rows by their first fault; `illegal` counts neighbours whose initials may not follow each other;
    `cost` is that of the cheapest repair and `audit` has the initials of its edits (Keep, Rerole,
    Delete, Insert), the least in ASCII order.  A conversation without rows has zeros and an empty
    audit, an empty table no rows; other columns are left out.

    One shuffle brings the rows of a conversation together, without their texts.  They pass in order;
    of a conversation its kinds of rows are held, a character each, as its audit is.
    """
    rows = _rows(turns, conv, turn, role, text)
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    narrow = rows.select(
        "conv", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")
    ).withColumn("row", F.lit(True))
    if conversations is not None:
        named = conversations.select(F.col(conv).alias("conv")).distinct()
        narrow = narrow.unionByName(named.withColumn("row", F.lit(False)), allowMissingColumns=True)
    # All but the first of a role and text in a conversation repeat it; the partitions serve the window too.
    same = Window.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    together = narrow.repartition("conv").withColumn("again", F.row_number().over(same) > 1)
    fault = F.when(F.col("blank"), FAULTS[0]).when(F.col("again"), FAULTS[1]).when(F.col("truncated"), FAULTS[2])
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    kind = F.when(fault.isin(*FAULTS[:2]), FAULTY).when(fault == FAULTS[2], F.upper(known)).otherwise(known)
    told = together.sortWithinPartitions(F.asc_nulls_first("conv"), *_order()).select(
        "conv", "row", "turn", initial.alias("initial"), fault.alias("fault"), kind.alias("kind")
    )
    key = T.StructField("conv", rows.schema["conv"].dataType)
    schema = T.StructType([key, *T.StructType.fromDDL(PLAN).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.string()]
        made, talk = [], None
        key, batches = _key_type(batches)
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if talk is None or talk.conv != row[0]:
                    if talk is not None:
                        made.append(talk.plan())
                    talk = _Talk(row[0])
                if row[1]:
                    talk.add(*row[2:])
            if len(made) >= 1000:
                yield _batch(made, key, types, schema)
                made = []
        if talk is not None:
            yield _batch([*made, talk.plan()], key, types, schema)

    return told.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def _batch(rows: list[tuple], key: pa.DataType, types: list[pa.DataType], schema: T.StructType) -> pa.RecordBatch:
    columns = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), [key, *types], strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())


class _Talk:
    """What is gathered of a conversation while its rows pass in order."""

    def __init__(self, conv: object):
        self.conv, self.kinds, self.faults = conv, [], dict.fromkeys(FAULTS, 0)
        self.least = self.turn = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: str | None, kind: str) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn = turn
            self.turns += 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.kinds.append(kind)

    def plan(self) -> tuple:
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        cost, audit = cheapest("".join(self.kinds))
        return (self.conv, gaps, *self.faults.values(), self.illegal, cost, audit)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str | None, str | None]]:
    """Conversation, role and text of the repaired rows in order, behind a row of nulls for each conversation.

    Rows come in order, behind the one with the audit of their conversation.
    """
    conv, audit, at, last, left = None, "", 0, 0, 0

    def made_role() -> str:
        # Roles alternate, and the assistant has the last word.
        return ROLES["a" if left % 2 else "u"]

    for batch in batches:
        for key, edits, own, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if edits is not None:
                conv, audit, at, last = key, edits, 0, len(edits.rstrip("I"))
                left = len(edits) - edits.count("D")
                yield conv, None, None
                continue
            while audit[at] == "I":
                yield conv, made_role(), ""
                at, left = at + 1, left - 1
            if audit[at] != "D":
                yield conv, own if audit[at] == "K" else made_role(), text
                left -= 1
            at += 1
            while at >= last and at < len(audit):
                yield conv, made_role(), ""
                at, left = at + 1, left - 1


def _in_order(turns: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversation, audit, role and text: each conversation's plan and then its rows."""
    rows = _rows(turns, conv, turn, role, text)
    audits = plans.select(F.col(conv).alias("conv"), "audit")
    both = rows.unionByName(audits, allowMissingColumns=True).repartition("conv")
    return both.sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_last("audit"), *_order()).select(
        "conv", "audit", "role", "text"
    )


def saved(plans: DataFrame) -> DataFrame:
    """The plans as a table in the shared folder, for the steps that read them twice."""
    path = scratch_path(plans.sparkSession, "plans")
    plans.write.parquet(path)
    return plans.sparkSession.read.parquet(path)


def repaired(
    turns: DataFrame,
    plans: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The rows after the edits of the plans as conversation, `nth` from 0, role and text.

    `plans` is what `plan` makes of the same rows; nulls, ties and repeated rows are taken as there.
    Rows pass in the order of their conversation, and none is held.
    """
    source = _in_order(turns, plans, conv, turn, role, text)
    schema = T.StructType([source.schema["conv"], *T.StructType.fromDDL("nth long, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, made, size, nth = [pa.int64(), pa.string(), pa.string()], [], 0, 0
        key, batches = _key_type(batches)
        for row in _edited(batches):
            if row[1] is None:
                nth = 0
                continue
            made.append((row[0], nth, *row[1:]))
            nth, size = nth + 1, size + len(row[2])
            if size > W.SLICE_BYTES or len(made) >= 10_000:
                yield _batch(made, key, types, schema)
                made, size = [], 0
        if made:
            yield _batch(made, key, types, schema)

    W.bound_batches(turns.sparkSession)
    return source.mapInArrow(run, schema).withColumnsRenamed({"conv": conv, "role": role, "text": text})


def digests(
    turns: DataFrame,
    plans: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The plans with `repaired_sha256`, the SHA-256 of the repaired rows as `role:text`, one per line.

    Rows pass in the order of their conversation, and none is held.
    """
    source = _in_order(turns, plans, conv, turn, role, text)
    schema = T.StructType([source.schema["conv"], *T.StructType.fromDDL("repaired_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, digest, begun = [], None, False
        key, batches = _key_type(batches)
        for conv, role, text in _edited(batches):
            if role is None:
                if digest is not None:
                    made.append((talk, digest.hexdigest()))
                if len(made) >= 1000:
                    yield _batch(made, key, [pa.string()], schema)
                    made = []
                talk, digest, begun = conv, hashlib.sha256(), False
                continue
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        if digest is not None:
            yield _batch([*made, (talk, digest.hexdigest())], key, [pa.string()], schema)

    W.bound_batches(turns.sparkSession)
    found = source.mapInArrow(run, schema).withColumnRenamed("conv", "conv_")
    return plans.join(found, F.col(conv).eqNullSafe(F.col("conv_"))).drop("conv_")


def _key_type(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the first column, and the batches again."""
    first = next(batches, None)
    if first is None:
        return None, iter(())
    return first.schema.field(0).type, itertools.chain([first], batches)
