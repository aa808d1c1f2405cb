"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The distinct units of a part of a batch are segmented together: all walks through the trie at once, then the
best paths position by position. On equal scores the path whose last piece is longer wins. A character
that no single-character piece covers becomes its UTF-8 bytes. Decoding joins the pieces, turns
markers into spaces and drops the one in front; it gives back every text exactly.

Defined results: a null or empty text has no tokens. Rows stay one to one with the input, in any order; ids may be
null or repeated. Memory is bounded by a part of a batch (or the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vedrina.llm.batches import parts
from vedrina.llm.pieces import VOCABULARY, Pieces, code_points, received, shared, units_of


def segment(pieces: Pieces, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all units one after another, and where each unit's begin (one place more than units)."""
    if not units:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    # Longest first, laid out by position: the units that reach a position are always the first ones.
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    reach = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # units longer than the position
    offset = np.concatenate([[0], np.cumsum(reach)])
    rank, position = _by_position(sizes, reach)
    begin = np.concatenate([[0], np.cumsum(lengths)])[order]
    points = code_points(units)[begin[rank] + position]
    letters = pieces.code[points]

    best = np.full(offset[-1] + len(units), -np.inf, np.float32)  # the last ones: position 0
    start_at = offset[-1]
    best[start_at:] = 0
    # Before position 0 stands the unit's own start; after position p its p-th entry.
    before = np.where(position == 0, start_at + rank, offset[np.maximum(position - 1, 0)] + rank)
    length = np.ones(offset[-1], np.int32)
    token = np.full(offset[-1], -1, np.int32)

    # All walks through the trie, step by step; in each step the starts stay ordered by position.
    arcs = []
    starts = np.arange(offset[-1])
    state = np.zeros(len(starts), np.int32)
    step = 0
    single = np.zeros(offset[-1], bool)
    while len(starts):
        where, unit = position[starts] + step, rank[starts]
        inside = where < sizes[unit]
        starts, state, where, unit = starts[inside], state[inside], where[inside], unit[inside]
        at = offset[where] + unit
        state, there = pieces.step(state, letters[at])
        starts, state, at = starts[there], state[there], at[there]
        ends = pieces.piece[state] >= 0
        ids = pieces.piece[state[ends]]
        if step == 0:
            single[starts[ends]] = True
        arcs.append((starts[ends], at[ends], ids, np.searchsorted(starts[ends], offset)))
        step += 1
    # A character without a piece of its own.
    lone = np.flatnonzero(~single)
    lone_cuts = np.searchsorted(lone, offset)

    for p in range(len(reach)):
        for k in range(min(p + 1, len(arcs)), 0, -1):
            from_start, to, ids, cuts = arcs[k - 1]
            low, high = cuts[p - k + 1], cuts[p - k + 2]
            if low < high:
                here = to[low:high]
                found = best[before[from_start[low:high]]] + pieces.score[ids[low:high]]
                better = found > best[here]
                here = here[better]
                best[here], length[here], token[here] = found[better], k, ids[low:high][better]
        here = lone[lone_cuts[p] : lone_cuts[p + 1]]
        if len(here):
            found = best[before[here]] + pieces.unknown_score
            better = found > best[here]
            here = here[better]
            best[here], length[here], token[here] = found[better], 1, -1

    # Back from the ends.
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    active = np.arange(len(units))
    left = sizes.copy()
    n_tokens = np.zeros(len(units), np.int64)
    unknown = False
    while True:
        active = active[left[active] > 0]
        if not len(active):
            break
        at = offset[left[active] - 1] + active
        ids = token[at]
        if (ids < 0).any():
            unknown = True
            ids = np.where(ids < 0, -1 - points[at].astype(np.int64), ids)
        taken.append((active, ids))
        n_tokens[active] += 1
        left[active] -= length[at]
    ends = np.cumsum(n_tokens[np.argsort(order, kind="stable")])
    cuts = np.concatenate([[0], ends])
    out = np.empty(cuts[-1], np.int64)
    end_of = cuts[1:][order]
    for back, (active, ids) in enumerate(taken, 1):
        out[end_of[active] - back] = ids
    return _with_bytes(pieces, out, cuts) if unknown else (out.astype(np.int32), cuts)


def _by_position(sizes: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit and the position of each entry of the layout."""
    position = np.repeat(np.arange(len(reach)), reach)
    first = np.concatenate([[0], np.cumsum(reach)])[:-1]
    return np.arange(len(position)) - np.repeat(first, reach), position


def _with_bytes(pieces: Pieces, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters (numbers below 0) as the ids of their bytes."""
    lone = np.flatnonzero(ids < 0)
    encoded = [chr(int(-1 - i)).encode("utf-8", "surrogatepass") for i in ids[lone]]
    width = np.ones(len(ids), np.int64)
    width[lone] = [len(e) for e in encoded]
    ends = np.concatenate([[0], np.cumsum(width)])
    out = np.empty(ends[-1], np.int32)
    out[ends[:-1]] = np.where(ids < 0, 0, ids)
    spots = np.concatenate([np.arange(s, s + len(e)) for s, e in zip(ends[:-1][lone], encoded)])
    out[spots] = pieces.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
    return out, ends[cuts]


def encode_texts(pieces: Pieces, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all texts one after another, and where each text's begin."""
    per_text = [units_of(text) for text in texts]
    number: dict[str, int] = {}
    which = np.fromiter(
        (number.setdefault(unit, len(number)) for unit in chain.from_iterable(per_text)),
        np.int64,
        sum(map(len, per_text)),
    )
    ids, cuts = segment(pieces, list(number))
    width = np.diff(cuts)[which]
    ends = np.concatenate([[0], np.cumsum(width)])
    # Place j of a unit's copy comes from place j of the unit.
    source = np.arange(ends[-1]) - np.repeat(ends[:-1] - cuts[which], width)
    text_ends = np.cumsum([0, *map(len, per_text)])
    return ids[source], ends[text_ends]


def decode_ids(pieces: Pieces, ids: np.ndarray) -> str:
    """The text of some token ids."""
    raw = b"".join([pieces.bytes_of[i] for i in ids.tolist()])
    return raw[1:].decode("utf-8", "surrogatepass")


def encode(docs: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with the column ``ids`` (array of int) in place of the text (and of a column of that name)."""
    fields = shared(docs.sparkSession, path)
    others = [name for name in docs.columns if name not in (text, "ids")]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = received(fields)
        for part in parts(batches, 0):
            ids, cuts = encode_texts(pieces, part.column(0).to_pylist())
            listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], listed], [*others, "ids"])

    schema = StructType([*docs.select(*others).schema, StructField("ids", ArrayType(IntegerType()))])
    return docs.select(text, *others).mapInArrow(of_batches, schema)


def decode(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``tokens`` with the column ``text`` in place of ``ids`` (and of a column of that name)."""
    fields = shared(tokens.sparkSession, path)
    others = [name for name in tokens.columns if name not in ("ids", "text")]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = received(fields)
        for batch in batches:
            texts = [decode_ids(pieces, value.values.to_numpy()) if value.is_valid else None for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*others, "text"])

    schema = StructType([*tokens.select(*others).schema, StructField("text", StringType())])
    return tokens.select("ids", *others).mapInArrow(of_batches, schema)


def encoded_and_checked(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The id, ``ids``, ``n_tokens``, ``n_byte_tokens`` and ``round_trip``: whether decoding gives the text back."""
    fields = shared(docs.sparkSession, path)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = received(fields)
        for part in parts(batches, 1):
            texts = part.column(1).to_pylist()
            ids, cuts = encode_texts(pieces, texts)
            is_byte = np.zeros(len(pieces.bytes_of), np.int64)
            is_byte[pieces.byte_ids] = 1
            n_bytes = np.diff(np.concatenate([[0], np.cumsum(is_byte[ids])])[cuts])
            same = [decode_ids(pieces, ids[a:b]) == (t or "") for t, a, b in zip(texts, cuts[:-1], cuts[1:])]
            listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), listed, pa.array(np.diff(cuts)), pa.array(n_bytes), pa.array(same)],
                [id, "ids", "n_tokens", "n_byte_tokens", "round_trip"],
            )

    kind = docs.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, ids array<int>, n_tokens bigint, n_byte_tokens bigint, round_trip boolean"
    return docs.select(id, text).mapInArrow(of_batches, schema)
