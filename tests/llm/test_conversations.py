"""The repair of conversations against a plain search over every edit, turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from tests.conftest import SF_DIR
from vedrina.llm import conversations, edit_lattice, queries
from vedrina.llm.conversations import digests, repair, repaired_rows

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    """Of each (turn, role, text) in order: b, d, t or nothing."""
    seen, found = set(), []
    for _, role, text in rows:
        visible = text.strip(" \t\n\v\f\r")
        fault = "b" if not visible else "d" if (role, text) in seen else "" if visible[-1] in ".!?" else "t"
        seen.add((role, text))
        found.append(fault)
    return found


def by_hand(rows):
    """The counts, the cheapest audit and the repaired turns of a conversation's rows, all edits tried in turn."""
    rows = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
    faults = faults_of(rows)
    # For each end of the roles so far: cost, audit and turns.
    best = {"": (0, "", ())}

    def step(end, initial):
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[end]
        return initial if initial and initial in allowed else None

    def insert(best):
        for _ in range(3):
            for end, (cost, audit, turns) in list(best.items()):
                for role in ("user", "assistant"):
                    after = step(end, role[0])
                    if after:
                        new = (cost + 3, audit + "I", (*turns, (role, "")))
                        best[after] = min(best.get(after, new), new)

    for (_, role, text), fault in zip(rows, faults):
        insert(best)
        now = {}

        def offer(end, new):
            now[end] = min(now.get(end, new), new)

        for end, (cost, audit, turns) in best.items():
            offer(end, (cost + 4, audit + "D", turns))
            if fault not in ("b", "d"):
                extra = 3 if fault == "t" else 0
                after = step(end, role[:1])
                if after:
                    offer(after, (cost + extra, audit + "K", (*turns, (role, text))))
                for other in ("user", "assistant"):
                    after = step(end, other[0])
                    if after:
                        offer(after, (cost + 3 + extra, audit + "R", (*turns, (other, text))))
        best = now
    insert(best)
    cost, audit, turns = min(best[end] for end in ("", "a") if end in best)
    assert PATTERN.fullmatch("".join(role[0] for role, _ in turns))
    numbers = {turn for turn, _, _ in rows if turn is not None}
    initials = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit,
        "sha": hashlib.sha256("\n".join(f"{role}:{text}" for role, text in turns).encode()).hexdigest(),
        "turns": list(turns),
    }


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: by_hand(own) for conv, own in groups.items()}


def found(rows):
    fixed = repair(rows)
    shas = {row[0]: row[1] for row in digests(fixed).collect()}
    turns = {}
    for row in sorted(repaired_rows(fixed).collect(), key=lambda row: (row.part, row.place, row.nth)):
        turns.setdefault(row.conv_id, []).append((row.role, row.text))
    empty = hashlib.sha256(b"").hexdigest()
    all_rows = [row.asDict() for row in fixed.conversations.collect()]
    assert len({row["conv_id"] for row in all_rows}) == len(all_rows)
    return {
        row.pop("conv_id"): row | {"sha": shas.get(id, empty), "turns": turns.get(id, [])} for row in all_rows for id in [row["conv_id"]]
    }


def invented(seed, conversations, most):
    dice = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(dice.randrange(most)):
            if dice.random() < 0.9:
                role = dice.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
                text = dice.choice(["Yes.", "No!", "cut off", "", " \n", f"Number {dice.randrange(5)}?", "ends. \t", None, "é…"])
                number = None if dice.random() < 0.05 else turn - 3
                rows += [(conv, number, role, text)] * dice.choice([1, 1, 1, 2, 4])
    dice.shuffle(rows)
    return rows


def lattice_turns(seed, most):
    dice = random.Random(seed)
    return [(dice.choice("suaauax"), dice.random() < 0.2) for _ in range(dice.randrange(most))]


@pytest.mark.parametrize("seed", range(300))
def test_lattice(seed):
    turns = lattice_turns(seed, 10)
    rows = [(k, {"s": "system", "u": "user", "a": "assistant", "x": "x"}[initial], f"{k}{'' if cut else '.'}") for k, (initial, cut) in enumerate(turns)]
    plain = by_hand(rows)
    assert edit_lattice.whole(turns) == (plain["cost"], plain["audit"])


@pytest.mark.parametrize("seed", range(40))
def test_pieces_chain_to_the_whole(seed, monkeypatch):
    turns = lattice_turns(seed, 60) + [("u", False)] * 4
    way = edit_lattice.whole(turns)
    monkeypatch.setattr(edit_lattice, "SEGMENT", 7)
    assert edit_lattice.whole(turns) == way
    dice = random.Random(seed)
    cuts = [0, *sorted(dice.sample(range(1, len(turns)), 3)), len(turns)]
    pieces = [edit_lattice.between(turns[a:b]) for a, b in zip(cuts, cuts[1:])]
    taken, state = edit_lattice.chained([[-1 if w is None else w[0] for w in p] for p in pieces], [edit_lattice.ranks(p) for p in pieces])
    closing = edit_lattice.CLOSING[state]
    assert sum(p[k][0] for p, k in zip(pieces, taken)) + closing[0] == way[0]
    assert "".join(p[k][1] for p, k in zip(pieces, taken)) + closing[1] == way[1]


@pytest.mark.parametrize("seed, conversations, most", [(1, 60, 8), (2, 3, 120), (3, 25, 20)])
def test_conversations(spark, seed, conversations, most):
    rows = invented(seed, conversations, most)
    assert found(spark.createDataFrame(rows, COLUMNS).repartition(5)) == expected(rows)


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    """Two thirds of the rows in one conversation, of which no task sees more than a part; batches are cut, too."""
    rows = invented(4, 1, 400) + [(7, turn, role, text) for _, turn, role, text in invented(5, 1, 12)] + [(None, 1, "user", "x.")]
    monkeypatch.setattr(edit_lattice, "SEGMENT", 16)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "9"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fixed = repair(spark.createDataFrame(rows, COLUMNS).repartition(3))
        assert repaired_rows(fixed).filter("conv_id = 0").select("part").distinct().count() > 4
        assert found(spark.createDataFrame(rows, COLUMNS).repartition(3)) == expected(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None), (None, None, None, None), (None, 3, "user", "Hello."), (1, None, "user", "b."), (1, None, "user", "a."),
        (1, 2, "user", "a."), (2, 5, "", "text"), (3, -(2**62), "user", "x." * 50_000), (3, 2**61, "assistant", "日本語。"), (4, 1, "assistant", "only."),
        (5, 1, "system", "only."), (6, 9, "user", " "),
    ]
    frame = spark.createDataFrame([(*row, 0, "x", "y", 1, "z", "w", "v") for row in rows], COLUMNS + ", part int, conv string, digest string, way int, lines string, copies string, piece string")
    answers = found(frame)
    assert answers == expected(rows)
    assert answers[4]["audit"] == "IK" and answers[5]["audit"] == "D" and answers[6]["audit"] == "D" and answers[6]["turns"] == []


def test_no_rows(spark):
    assert found(spark.createDataFrame([], COLUMNS)) == {}


def test_query(spark):
    """The damaged table, whole, against the plain search."""
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    damaged = []
    for conv, turn, role, text in rows:
        damage = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        if damage == 4:
            role = "user"
        damaged += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(damage, 1)
    plain = expected(damaged)
    answers = queries.repaired_conversations(spark, SF_DIR).collect()
    assert sorted(row.conv_id for row in answers) == sorted({row[0] for row in rows})
    nothing = by_hand([])
    for row in answers:
        own = plain.get(row.conv_id, nothing)
        assert row.asDict() == {"conv_id": row.conv_id, "repaired_sha256": own["sha"]} | {k: own[k] for k in own if k not in ("sha", "turns")}
