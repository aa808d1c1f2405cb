"""Token counts by dynamic programming over a trie of the distinct units.

The distinct units (pre-tokens) of a part of a batch are inserted in a trie, level by level. A node stands for
a prefix, and its forward score, the best score of segmenting that prefix into pieces, is computed once, however
many units share it: every walk through the trie of pieces that is under way at a node goes on to each of the
node's children, and a new walk begins at every node. The node where a unit ends holds its token count.

The model and the rules on ties and on characters without a piece are those of ``sentencepiece``, so counts equal
the number of ids there. Defined results: a null or empty text has no tokens; rows stay one to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vedrina.llm.batches import parts
from vedrina.llm.pieces import VOCABULARY, Pieces, code_points, received, shared, units_of


def unit_counts(pieces: Pieces, units: list[str]) -> np.ndarray:
    """The number of tokens of each (distinct) unit."""
    if not units:
        return np.empty(0, np.int64)
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    points = code_points(units).astype(np.int64)
    result = np.zeros(len(units), np.int64)

    # Of the nodes of one level: the forward score and the count. Earlier levels stay reachable by number.
    score, count = [np.zeros(1, np.float32)], [np.zeros(1, np.int64)]
    first = 0  # number of the level's first node
    node = np.zeros(len(units), np.int64)  # of each unit that goes on, in this level
    going = np.flatnonzero(lengths > 0)
    # Walks under way, ordered by node and then by start: node, number of the start, state.
    walk_node, walk_start, walk_state = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int32)
    walk_score, walk_count = np.zeros(1, np.float32), np.zeros(1, np.int64)
    depth = 0
    while len(going):
        point = points[begin[going] + depth]
        pairs, node = np.unique(node[going] * 0x110000 + point, return_inverse=True)
        parent, point = pairs // 0x110000, pairs % 0x110000
        letter = pieces.code[point]

        # The walks of a parent, once for each child.
        low = np.searchsorted(walk_node, parent, side="left")
        width = np.searchsorted(walk_node, parent, side="right") - low
        child = np.repeat(np.arange(len(pairs)), width)
        ends = np.cumsum(width)
        walk = np.arange(ends[-1]) - np.repeat(ends - width - low, width)
        state, there = pieces.step(walk_state[walk], letter[child])
        child, walk, state = child[there], walk[there], state[there]
        from_score, from_count = walk_score[walk], walk_count[walk]

        # The best way into each child; the first (with the longest piece) of equal ones.
        done = np.flatnonzero(pieces.piece[state] >= 0)
        to = child[done]
        value = from_score[done] + pieces.score[pieces.piece[state[done]]]
        tokens = from_count[done] + 1
        new_score, new_count = np.full(len(pairs), -np.inf, np.float32), np.zeros(len(pairs), np.int64)
        if len(to):
            heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, heads)
            sizes = np.diff(np.concatenate([heads, [len(to)]]))
            is_top = value == np.repeat(top, sizes)
            place = np.minimum.reduceat(np.where(is_top, np.arange(len(to)), len(to)), heads)
            new_score[to[heads]], new_count[to[heads]] = top, tokens[place]
        # A character without a piece of its own becomes its bytes.
        single = np.zeros(len(pieces.code) and int(letter.max()) + 1, bool)
        distinct = np.unique(letter)
        root_state, exists = pieces.step(np.zeros(len(distinct), np.int32), distinct)
        single[distinct] = exists & (pieces.piece[root_state] >= 0)
        lone = np.flatnonzero(~single[letter])
        if len(lone):
            value = score[-1][parent[lone]] + pieces.unknown_score
            better = value > new_score[lone]
            lone, value = lone[better], value[better]
            n_bytes = 1 + (point[lone] > 0x7F) + (point[lone] > 0x7FF) + (point[lone] > 0xFFFF)
            new_score[lone], new_count[lone] = value, count[-1][parent[lone]] + n_bytes
        score[:], count[:] = [new_score], [new_count]

        depth += 1
        over = lengths[going] == depth
        result[going[over]] = new_count[node[over]]
        going, node_left = going[~over], node[~over]
        full = np.empty(len(units), np.int64)
        full[going] = node_left
        node = full

        # Walks go on, and one begins at each node.
        own = np.arange(len(pairs))
        walk_node = np.concatenate([child, own])
        order = np.argsort(walk_node, kind="stable")
        walk_node = walk_node[order]
        walk_state = np.concatenate([state, np.zeros(len(pairs), state.dtype)])[order]
        walk_score = np.concatenate([from_score, new_score])[order]
        walk_count = np.concatenate([from_count, new_count])[order]
    return result


def count_tokens(pieces: Pieces, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the tokens and the units."""
    per_text = [units_of(text) for text in texts]
    number: dict[str, int] = {}
    n_units = np.fromiter(map(len, per_text), np.int64, len(per_text))
    which = np.fromiter(
        (number.setdefault(unit, len(number)) for unit in chain.from_iterable(per_text)), np.int64, int(n_units.sum())
    )
    counts = unit_counts(pieces, list(number))
    so_far = np.concatenate([[0], np.cumsum(counts[which])])
    ends = np.concatenate([[0], np.cumsum(n_units)])
    return np.diff(so_far[ends]), n_units


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The id, ``n_tokens`` and ``n_units`` of each row."""
    fields = shared(docs.sparkSession, path)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = received(fields)
        for part in parts(batches, 1):
            tokens, units = count_tokens(pieces, part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens), pa.array(units)], [id, "n_tokens", "n_units"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(of_batches, f"`{id}` {kind}, n_tokens bigint, n_units bigint")
