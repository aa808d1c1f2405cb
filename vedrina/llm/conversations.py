"""Repair of conversations whose turns are missing, empty, repeated, cut off or given to the wrong role.

1. Equal turns (same conversation, number, role and text) become one row with a count, so that a turn repeated any number
   of times is one row. The first of the turns with one role and text is found by an aggregate without texts.
2. Turns are put in order by range partitions, so that a conversation of any length lies over many tasks, none of
   which holds more than a partition. A task repairs every conversation that it has whole. Of one that goes on in another
   task (the first and the last of a partition may) it finds the cheapest ways from each state to each state.
3. The pieces of these conversations, at most two a partition and without texts, are chained by conversation, and each piece
   learns which of its 16 ways was taken. The search itself is in ``edit_lattice``.

The order in a conversation is that of the turn number (nulls first), then role and text. A turn's first fault counts: blank (no
visible character), duplicate (role and text seen earlier), truncated (its last visible character is not one of
``.!?``). Blank and duplicate turns are deleted.

Defined results: a null role or text is one space, so such turns are of no known role, or blank. Rows without a conversation id
are one conversation. Rows repeated in full are turns of their own, all but the first duplicates. Other columns of the input,
whatever their names, are left out. An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm import edit_lattice as lattice
from vedrina.shared import new_path, written

BLANKS = " \t\n\v\f\r"
ENDINGS = ".!?"
# Characters of a text that place it among other partitions' rows; the rest decides within a partition.
PLACED_BY = 64

_SUMMARY = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least_turn bigint, most_turn bigint"
_PIECE = f"struct<open: boolean, costs: array<bigint>, ranks: array<int>, audits: array<string>, after: string, " \
    f"first_initial: string, last_initial: string, {_SUMMARY.replace(' bigint', ': bigint')}>"
# Of each turn: the edits, the initials of the roles inserted in front, and the new role, for each way. The last turn
# of a piece also has the piece's figures.
_EDITS = f"edits array<string>, inserted array<string>, roles array<string>, piece {_PIECE}"
_EDITS_TYPE = [
    ("edits", pa.list_(pa.string())), ("inserted", pa.list_(pa.string())), ("roles", pa.list_(pa.string())),
    ("piece", pa.struct([
        ("open", pa.bool_()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
        ("after", pa.string()), ("first_initial", pa.string()), ("last_initial", pa.string()),
        *[(part.split()[0], pa.int64()) for part in _SUMMARY.split(", ")],
    ])),
]
_LEGAL = ("su", "ua", "au")


@dataclass(frozen=True)
class Repair:
    """``conversations``: a row per id with the counts of faults, ``gaps``, ``illegal``, ``cost`` and ``audit``. ``turns``: the
    repaired turns: the id, ``part`` and ``place`` (which order them), and ``lines``, the inserted turns in
    front, the turn itself and what is inserted after it, each with role and text. Deleted turns have what is inserted
    around them only. Both as plans over written tables."""

    conversations: DataFrame
    turns: DataFrame


def collapsed(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """The distinct turns with their number of ``copies``, what is wrong with each by itself, and a ``digest`` of role
    and text."""
    plain = rows.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    counted = plain.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    ending = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    return counted.select(
        "*",
        F.substring("role", 1, 1).alias("initial"),
        (F.length(ending) == 0).alias("blank"),
        (~ending.isin(*ENDINGS)).alias("truncated"),
        F.sha2(F.concat(F.sha2("role", 256), "text"), 256).alias("digest"),
    )


def with_duplicates(turns: DataFrame) -> DataFrame:
    """``turns`` (a written table) with ``duplicate``: the same role and text are in an earlier turn."""
    seen = turns.groupBy("conv", "digest").agg(
        F.count("*").alias("n"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    # Without texts, and only of what is there more than once; the planner knows the written table's size.
    seen = written(seen.filter("n > 1").drop("n"), new_path(turns.sparkSession, "conversation-seen"))
    seen = seen.select(F.col("conv").alias("seen_conv"), F.col("digest").alias("seen_digest"), "first", "unnumbered")
    joined = turns.join(seen, F.col("conv").eqNullSafe(F.col("seen_conv")) & (F.col("digest") == F.col("seen_digest")), "left")
    duplicate = F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first")))
    return joined.select(*turns.columns, F.coalesce(duplicate, F.lit(False)).alias("duplicate"))


def _summary(rows: dict[str, list]) -> dict:
    """The counts over the turns of a piece, in order."""
    found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    numbers = [number for number in rows["turn"] if number is not None]
    found["turns"] = len(set(numbers))
    found["least_turn"], found["most_turn"] = (numbers[0], numbers[-1]) if numbers else (None, None)
    before = None
    for copies, initial, blank, duplicate, truncated in zip(
        rows["copies"], rows["initial"], rows["blank"], rows["duplicate"], rows["truncated"]
    ):
        if blank:
            found["blank"] += copies
        elif duplicate:
            found["duplicate"] += copies
        else:
            # The copies of a turn are duplicates of it.
            found["truncated"] += truncated
            found["duplicate"] += copies - 1
        # Two turns of one role are never legal.
        found["illegal"] += copies - 1 + (before is not None and before + initial not in _LEGAL)
        before = initial
    return found | {"first_initial": rows["initial"][0], "last_initial": before}


def _forced(rows: dict[str, list]) -> list[int]:
    """How many copies of each turn must go."""
    return [
        copies if blank or duplicate else copies - 1
        for copies, blank, duplicate in zip(rows["copies"], rows["blank"], rows["duplicate"])
    ]


def repaired_piece(rows: dict[str, list], open_piece: bool) -> list[list]:
    """The columns ``edits``, ``inserted``, ``roles`` and ``piece`` for the turns of a conversation, or of a piece of one."""
    forced, n = _forced(rows), len(rows["copies"])
    free = [k for k in range(n) if forced[k] < rows["copies"][k]]
    turns = [(rows["initial"][k], rows["truncated"][k]) for k in free]
    cost = lattice.DELETE * sum(forced)
    ways = lattice.between(turns) if open_piece else [lattice.whole(turns)]
    edits, inserted, roles = ([[None] * len(ways) for _ in range(n)] for _ in range(3))
    audits, after = [None] * len(ways), ""
    for number, way in enumerate(ways):
        if way is None:
            continue
        own, after = lattice.by_turn(turns, way[1], number // 4 if open_piece else lattice.NOTHING)
        own = dict(zip(free, own))
        for k in range(n):
            letters, front, role = own.get(k, ("", "", ""))
            edits[k][number], inserted[k][number], roles[k][number] = letters + "D" * forced[k], front, role
        audits[number] = "".join(row[number] for row in edits) + "I" * len(after)
    piece = {
        "open": open_piece, "costs": [-1 if way is None else way[0] + cost for way in ways], "ranks": lattice.ranks(ways),
        "audits": audits, "after": after, **_summary(rows),
    }
    return [edits, inserted, roles, [None] * (n - 1) + [piece]]


_READ = ("turn", "copies", "initial", "blank", "duplicate", "truncated")


def _repaired_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns come in order, so a conversation is a run of rows, which batches may cut. The first and the last one of
    the partition may go on in another."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    place, first, held = 0, True, []

    def repaired(table: pa.Table, cuts: list[int], whole_until: int) -> Iterator[pa.RecordBatch]:
        nonlocal place, first
        columns = {name: table[name].to_pylist() for name in _READ}
        found = [[], [], [], []]
        for start, end in zip(cuts[:-1], cuts[1:]):
            rows = {name: values[start:end] for name, values in columns.items()}
            for column, values in zip(found, repaired_piece(rows, first or end > whole_until)):
                column.extend(values)
            first = False
        n = table.num_rows
        texts = pa.table({
            "conv": table["conv"], "part": pa.array([part] * n, pa.int32()), "place": pa.array(range(place, place + n), pa.int64()),
            "role": table["role"], "text": table["text"],
            **{name: pa.array(values, kind) for (name, kind), values in zip(_EDITS_TYPE, found)},
        })
        place += n
        yield from texts.to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(batch.schema.get_field_index("conv"))
        starts = [k for k, same in enumerate(_same_as_before(conv, held)) if not same]
        if not starts:
            held.append(batch)
            continue
        head = held + ([batch.slice(0, starts[0])] if starts[0] else [])
        if head:
            table = pa.Table.from_batches(head)
            yield from repaired(table, [0, table.num_rows], table.num_rows)
        if len(starts) > 1:
            table = pa.Table.from_batches([batch.slice(starts[0], starts[-1] - starts[0])])
            yield from repaired(table, [at - starts[0] for at in starts], table.num_rows)
        held = [batch.slice(starts[-1])]
    if held:
        table = pa.Table.from_batches(held)
        yield from repaired(table, [0, table.num_rows], 0)


def _same_as_before(conv: pa.Array, held: list[pa.RecordBatch]) -> list[bool]:
    """For each row whether it is of the conversation of the row before it."""
    values = conv.to_pylist()
    if not held:
        return [False] + [a == b for a, b in zip(values[1:], values[:-1])]
    last = held[-1].column(held[-1].schema.get_field_index("conv"))[-1].as_py()
    return [value == before for value, before in zip(values, [last, *values[:-1]])]


def _chained(conversations: pa.Table) -> pa.Table:
    """The way taken through each piece of a conversation, what is inserted after the last one, and what its neighbours
    add to the counts."""
    table = conversations.sort_by("part")
    rows = table.to_pylist()
    taken, state = lattice.chained([row["costs"] for row in rows], [row["ranks"] for row in rows])
    closing, audit = lattice.CLOSING[state]
    _, after = lattice.by_turn([], audit, state)
    last = [False] * (len(rows) - 1) + [True]
    joints = [0] + [int(a["last_initial"] + b["first_initial"] not in _LEGAL) for a, b in zip(rows, rows[1:])]
    most, again = None, []
    for row in rows:
        again.append(int(most is not None and row["least_turn"] == most))
        most = row["most_turn"] if row["most_turn"] is not None else most
    return pa.table({
        "conv": table["conv"], "part": table["part"], "way": pa.array([way + 1 for way in taken], pa.int32()),
        "closing": pa.array([closing * end for end in last], pa.int64()), "end": pa.array([after * end for end in last], pa.string()),
        "joint": pa.array(joints, pa.int64()), "again": pa.array(again, pa.int64()),
    })


def _of_pieces(edited: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces, and for those that may go on in another partition the way taken through them."""
    pieces = edited.filter("piece is not null").select("conv", "part", "piece.*")
    kind = edited.schema["conv"].dataType.simpleString()
    open_pieces = pieces.filter("open").select(
        "conv", "part", "costs", "ranks", "first_initial", "last_initial", "least_turn", "most_turn"
    )
    chained = open_pieces.groupBy("conv").applyInArrow(
        _chained, f"conv {kind}, part int, way int, closing bigint, end string, joint bigint, again bigint"
    )
    return pieces, written(chained, new_path(edited.sparkSession, "conversation-ways"))


def _with_way(rows: DataFrame, ways: DataFrame, *columns: str) -> DataFrame:
    ways = ways.select(F.col("conv").alias("way_conv"), F.col("part").alias("way_part"), "way", *columns)
    same = F.col("conv").eqNullSafe(F.col("way_conv")) & (F.col("part") == F.col("way_part"))
    return rows.join(ways, same, "left").withColumn("way", F.coalesce("way", F.lit(1))).drop("way_conv", "way_part")


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repair:
    """The cheapest repair of each conversation in ``rows``. Turn numbers are whole numbers."""
    spark = rows.sparkSession
    turns = written(collapsed(rows, conversation, turn, role, text), new_path(spark, "conversation-turns"))
    in_order = (
        with_duplicates(turns)
        .repartitionByRange("conv", "turn", "role", F.substring("text", 1, PLACED_BY))
        .sortWithinPartitions("conv", "turn", "role", "text")
    )
    kind = turns.schema["conv"].dataType.simpleString()
    edited = in_order.drop("digest").mapInArrow(
        _repaired_partition, f"conv {kind}, part int, place bigint, role string, text string, {_EDITS}"
    )
    edited = written(edited, new_path(spark, "conversation-edits"))
    pieces, ways = _of_pieces(edited)

    known = _with_way(pieces, ways, "closing", "end", "joint", "again")
    cost = F.element_at("costs", F.col("way")) + F.coalesce("closing", F.lit(0))
    audit = F.concat(F.element_at("audits", F.col("way")), F.repeat(F.lit("I"), F.length(F.coalesce("end", F.lit("")))))
    gaps = F.max("most_turn") - F.min("least_turn") + 1 - (F.sum("turns") - F.sum(F.coalesce("again", F.lit(0))))
    conversations = known.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.coalesce("joint", F.lit(0))).alias("illegal"),
        F.sum(cost).alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", audit.alias("audit")))), lambda x: x["audit"]), "").alias("audit"),
    )
    return Repair(
        conversations.withColumnRenamed("conv", conversation),
        _with_way(edited, ways, "end").select(
            F.col("conv").alias(conversation), "part", "place", _lines().alias("lines")
        ),
    )


def _inserted(initials: Column) -> Column:
    """Empty turns of the roles with these initials."""
    role = lambda initial: F.when(initial == "u", F.lit("user")).otherwise(F.lit("assistant"))
    return F.transform(
        F.filter(F.split(initials, ""), lambda initial: initial != ""), lambda initial: F.struct(role(initial).alias("role"), F.lit("").alias("text"))
    )


def _lines() -> Column:
    role = F.element_at("roles", F.col("way"))
    own = F.struct(F.when(role == "=", F.col("role")).otherwise(role).alias("role"), F.col("text"))
    after = F.when(F.col("piece").isNotNull(), F.coalesce("end", F.col("piece.after"))).otherwise("")
    none = F.filter(F.array(own), lambda _: F.lit(False))
    return F.concat(
        _inserted(F.element_at("inserted", F.col("way"))), F.when(role != "", F.array(own)).otherwise(none), _inserted(after)
    )


def repaired_rows(repair: Repair) -> DataFrame:
    """The repaired turns, a row each: the conversation, ``part``, ``place``, ``nth`` (these order them), ``role``, ``text``."""
    [conversation, *_] = repair.turns.columns
    return repair.turns.select(conversation, "part", "place", F.posexplode("lines").alias("nth", "line")).select(
        conversation, "part", "place", "nth", "line.role", "line.text"
    )


def digests(repair: Repair) -> DataFrame:
    """The SHA-256 of each conversation's ``role:text`` lines, joined by ``\\n``, as ``repaired_sha256``.

    A digest takes its bytes in order, so a conversation's turns stream through one task, which holds a batch
    of them and the digest so far.
    """
    [conversation, *_] = repair.turns.columns
    lines = F.transform("lines", lambda line: F.concat(line["role"], F.lit(":"), line["text"]))
    texts = repair.turns.filter(F.size("lines") > 0).select(F.col(conversation).alias("conv"), "part", "place", F.array_join(lines, "\n").alias("lines"))
    texts = texts.repartition("conv").sortWithinPartitions("conv", "part", "place").select("conv", "lines")
    kind = texts.schema["conv"].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(text.as_buffer())
            if done:
                yield _pairs(done, batch.schema.field(0).type)
        if digest is not None:
            yield _pairs([(now, digest.hexdigest())], batch.schema.field(0).type)

    return texts.mapInArrow(digested, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conversation)


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], kind), pa.array([b for _, b in rows])], ["conv", "repaired_sha256"])
