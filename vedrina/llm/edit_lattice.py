"""The cheapest repair of a conversation: bidirectional Dijkstra over its edit lattice.

A node is (turns handled, state of the roles kept so far). A turn can be kept, given another role or deleted; in front of a
turn, and after the last one, empty turns can be inserted. The roles must come out as ``(s?(ua)+)?``.

A forward heap grows from the start and a reverse heap from the end. A path is found where an edge joins a node settled by one
side with one settled by the other; the search ends when no crossing as cheap as the best can be left, and of the cheapest
paths the one with the least audit (letters of the edits in order, by ASCII) is taken. Labels are (cost, audit). Two audits of one
node and one cost are never a prefix of each other, as both handle the same turns, so the least audit of a path is
made of least audits of its parts.

Turns that must be deleted anyway have one way through the lattice and are no nodes of it. Long conversations are searched in
segments from each state to each state, and the segments' results are put together in the same order of (cost, audit).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

# What the roles kept so far end with: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
ACCEPTING = (NOTHING, ASSISTANT)
# The state after a turn with a role's initial, and the state after a turn made to fit.
_STEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_FITTING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Turns searched at once; bounds the length of the labels.
SEGMENT = 128

# A turn: its role's initial and whether its text is truncated. A way: what it costs and its audit.
Turn = tuple[str, bool]
Way = tuple[int, str]


def _edits(turn: Turn, state: int) -> Iterable[tuple[str, int, int]]:
    """The letter, the state after, and the cost of each edit of a turn."""
    initial, truncated = turn
    extra = TRUNCATED if truncated else 0
    yield "D", state, DELETE
    yield "R", _FITTING[state], REROLE + extra
    kept = _STEPS.get(initial, {}).get(state)
    if kept is not None:
        yield "K", kept, extra


def _edges(turns: list[Turn], at_end: bool) -> tuple[list, list]:
    """For each node (numbered 4 * turns handled + state) the edges out of it and into it: (node, letter, cost)."""
    n = len(turns)
    out, into = [[] for _ in range(4 * n + 4)], [[] for _ in range(4 * n + 4)]

    def add(a: int, b: int, letter: str, cost: int) -> None:
        out[a].append((b, letter, cost))
        into[b].append((a, letter, cost))

    for place in range(n + 1):
        for state in STATES:
            if place < n or at_end:
                add(4 * place + state, 4 * place + _FITTING[state], "I", INSERT)
            if place < n:
                for letter, after, cost in _edits(turns[place], state):
                    add(4 * place + state, 4 * place + 4 + after, letter, cost)
    return out, into


def cheapest(turns: list[Turn], entry: int, exits: tuple[int, ...], at_end: bool) -> Way | None:
    """The cheapest way from a state before the turns to one of the states after them. Turns can be inserted after
    the last one only ``at_end``: else that is in front of the next segment's first turn."""
    out, into = _edges(turns, at_end)
    last = 4 * len(turns)
    # Edges without cost lead to the next turn only, so among labels of one cost the place goes first.
    forward: list = [(0, 0, "", entry)]
    reverse: list = [(0, 0, "", last + state) for state in exits]
    heapq.heapify(reverse)
    ahead: dict[int, Way] = {}
    behind: dict[int, Way] = {}
    best = (0, "") if not turns and entry in exits else None
    while forward or reverse:
        if best is not None and (forward[0][0] if forward else 0) + (reverse[0][0] if reverse else 0) > best[0]:
            break
        if forward and (not reverse or forward[0][0] <= reverse[0][0]):
            cost, _, audit, node = heapq.heappop(forward)
            if node in ahead:
                continue
            ahead[node] = cost, audit
            for other, letter, more in out[node]:
                if other in behind:
                    rest = behind[other]
                    found = cost + more + rest[0], audit + letter + rest[1]
                    best = found if best is None else min(best, found)
                if other not in ahead:
                    heapq.heappush(forward, (cost + more, other >> 2, audit + letter, other))
        else:
            cost, _, audit, node = heapq.heappop(reverse)
            if node in behind:
                continue
            behind[node] = cost, audit
            for other, letter, more in into[node]:
                if other in ahead:
                    start = ahead[other]
                    found = start[0] + more + cost, start[1] + letter + audit
                    best = found if best is None else min(best, found)
                if other not in behind:
                    heapq.heappush(reverse, (cost + more, (last - other) >> 2, letter + audit, other))
    return best


def _least(ways: Iterable[Way | None]) -> Way | None:
    return min((way for way in ways if way is not None), default=None)


def _together(first: Way | None, rest: Way | None) -> Way | None:
    return None if first is None or rest is None else (first[0] + rest[0], first[1] + rest[1])


def _segments(turns: list[Turn]) -> list[list[Turn]]:
    return [turns[at : at + SEGMENT] for at in range(0, len(turns), SEGMENT)] or [[]]


def whole(turns: list[Turn]) -> Way:
    """The cheapest way through a whole conversation."""
    *before, last = _segments(turns)
    entries = STATES if before else (NOTHING,)
    rest = {entry: cheapest(last, entry, ACCEPTING, True) for entry in entries}
    for number, segment in reversed(list(enumerate(before))):
        entries = STATES if number else (NOTHING,)
        rest = {
            entry: _least(_together(cheapest(segment, entry, (to,), False), rest[to]) for to in STATES) for entry in entries
        }
    return rest[NOTHING]


def between(turns: list[Turn]) -> list[Way | None]:
    """The cheapest ways through a piece of a conversation, from each state to each state (16 in that order)."""
    found = {}
    *before, last = _segments(turns)
    for end in STATES:
        rest = {entry: cheapest(last, entry, (end,), False) for entry in STATES}
        for segment in reversed(before):
            rest = {
                entry: _least(_together(cheapest(segment, entry, (to,), False), rest[to]) for to in STATES) for entry in STATES
            }
        for entry in STATES:
            found[entry, end] = rest[entry]
    return [found[entry, end] for entry in STATES for end in STATES]


# What is inserted after a conversation's last turn, by the state there.
CLOSING: dict[int, Way] = {state: cheapest([], state, ACCEPTING, True) for state in STATES}


def ranks(ways: list[Way | None]) -> list[int]:
    """The place of each way's audit among them all in ASCII order; equal audits have equal places."""
    order = {audit: place for place, audit in enumerate(sorted({way[1] for way in ways if way is not None}))}
    return [-1 if way is None else order[way[1]] for way in ways]


def chained(costs: list[list[int]], places: list[list[int]]) -> tuple[list[int], int]:
    """For a conversation in several pieces, each with the costs (-1: no way) and ranks of its 16 ways: the way to
    take through each piece, and the last state.

    From the last piece backwards each state keeps its cheapest rest. Rests are compared as their audits would be: by the
    first piece in which they differ.
    """
    rest = {state: (CLOSING[state][0], CLOSING[state][1]) for state in STATES}
    order = sorted({audit for _, audit in rest.values()})
    rest = {state: (cost, order.index(audit)) for state, (cost, audit) in rest.items()}
    chosen: list[dict[int, int]] = []
    for own, ranked in zip(reversed(costs), reversed(places)):
        now, way = {}, {}
        for entry in STATES:
            options = [
                (own[4 * entry + to] + rest[to][0], ranked[4 * entry + to], rest[to][1], to)
                for to in STATES
                if own[4 * entry + to] >= 0
            ]
            cost, first, then, way[entry] = min(options)
            now[entry] = cost, (first, then)
        order = sorted({audit for _, audit in now.values()})
        rest = {entry: (cost, order.index(audit)) for entry, (cost, audit) in now.items()}
        chosen.append(way)
    taken, state = [], NOTHING
    for way in reversed(chosen):
        taken.append(4 * state + way[state])
        state = way[state]
    return taken, state


def by_turn(turns: list[Turn], audit: str, state: int) -> tuple[list[tuple[str, str, str]], str]:
    """An audit, turn by turn: the letters up to the turn's own edit, the roles' initials inserted in front of it, and its new
    role (empty: deleted; ``=``: its own). Then the initials inserted after the last turn."""
    found, at = [], 0
    for initial, _ in turns:
        start, inserted = at, ""
        while audit[at] == "I":
            state = _FITTING[state]
            inserted += ROLES[state][0]
            at += 1
        role = ""
        if audit[at] == "R":
            state = _FITTING[state]
            role = ROLES[state]
        elif audit[at] == "K":
            state = _STEPS[initial][state]
            role = "="
        at += 1
        found.append((audit[start:at], inserted, role))
    after = ""
    for _ in audit[at:]:
        state = _FITTING[state]
        after += ROLES[state][0]
    return found, after
