"""A vocabulary of pieces in a double-array trie, with log scores.

The pieces come from a SentencePiece file (its path is a parameter; nothing is trained or copied). A unigram file has the
log scores of its pieces, and these are taken. A BPE file has merge ranks instead of probabilities: there the log score of a piece is
that of its rank under Zipf's law.

Texts are cut into units, which no piece crosses: a run of spaces with the characters up to the next
space or line break, or a line break. Spaces are the marker U+2581 of the pieces, and a text gets one in front.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

MARKER = "▁"
UNIT = re.compile(r" *[^ \n]+|\n| +")
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
ZIPF_OFFSET = 2.7


@dataclass(frozen=True)
class Pieces:
    """``code`` maps code points to the letters of the trie (0: in no piece). From state s the letter c leads to
    ``base[s] + c`` if ``check`` there is s; ``piece[s]`` is the id of the piece that ends there, or -1."""

    code: np.ndarray
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    byte_ids: np.ndarray
    bytes_of: list[bytes]
    unknown_score: np.float32

    def codes(self, units: list[str]) -> np.ndarray:
        """The code points of all units as trie letters, one after another."""
        return self.code[code_points(units)]

    def step(self, state: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them exist."""
        to = self.base[state] + letter
        return to, (self.check[to] == state) & (letter > 0)


def code_points(units: list[str]) -> np.ndarray:
    return np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)


def units_of(text: str | None) -> list[str]:
    return UNIT.findall(" " + text) if text else []


def double_array(words: dict[str, int], letters: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and the value at each state (-1: none)."""
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for word, value in words.items():
        node = 0
        for letter in word:
            next_node = children[node].get(letters[letter])
            if next_node is None:
                next_node = children[node][letters[letter]] = len(children)
                children.append({})
                values.append(-1)
            node = next_node
        values[node] = value
    width = len(letters) + 2
    size = 2 * len(children) + 2 * width
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    place = {0: 0}
    first_free = 1
    # Nodes with many children first, while there is room in one piece.
    queue = [0]
    while queue:
        later = []
        for node in sorted(queue, key=lambda n: -len(children[n])):
            at = place[node]
            value[at] = values[node]
            if not children[node]:
                continue
            labels = sorted(children[node])
            slot = taken.find(0, max(first_free, labels[0] + 1))
            while True:
                start = slot - labels[0]
                if start + width >= len(taken):
                    grow = len(taken)
                    taken += bytearray(grow)
                    base, check, value = (np.concatenate([a, np.full(grow, f, np.int32)]) for a, f in ((base, 0), (check, -1), (value, -1)))
                if not any(taken[start + label] for label in labels):
                    break
                slot = taken.find(0, slot + 1)
            base[at] = start
            for label in labels:
                taken[start + label] = 1
                check[start + label] = at
                place[children[node][label]] = start + label
                later.append(children[node][label])
            first_free = taken.find(0, first_free)
        queue = later
    # A step never leaves the arrays.
    most = int(base.max()) + width
    return tuple(np.concatenate([a[:most], np.full(max(0, most - len(a)), f, np.int32)]) for a, f in ((base, 0), (check, -1), (value, -1)))


def build(entries: list[tuple[str, float]], byte_ids: list[int], ids: list[int], size: int, bytes_of: list[bytes]) -> Pieces:
    """From pieces with scores, their ids, and the ids of the 256 byte pieces."""
    for piece, _ in entries:
        if MARKER in piece.lstrip(MARKER) or (len(piece) > 1 and "\n" in piece):
            raise ValueError(f"the piece {piece!r} would cross units")
    letters = {letter: n for n, letter in enumerate(sorted({c for piece, _ in entries for c in piece}), 1)}
    base, check, piece = double_array({p: i for (p, _), i in zip(entries, ids)}, letters)
    code = np.zeros(0x110000, np.int32)
    for letter, n in letters.items():
        code[ord(letter)] = n
    # A space is the marker; a marker in the text itself is not, and falls back to bytes.
    code[ord(" ")], code[ord(MARKER)] = code[ord(MARKER)], 0
    score = np.zeros(size, np.float32)
    score[ids] = [s for _, s in entries]
    unknown = np.float32(min(s for _, s in entries) - UNKNOWN_PENALTY)
    return Pieces(code, base, check, piece, score, np.array(byte_ids, np.int32), bytes_of, unknown)


# Kinds of model, the place of the kind in a model file (a message of fields), and that of its trainer's settings.
UNIGRAM, BPE = 1, 2
_SETTINGS, _KIND = 2, 3


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _field(data: bytes, wanted: int) -> int | bytes | None:
    """The last value of a field of a serialized message."""
    at, found = 0, None
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        if key >> 3 == wanted:
            found = value
    return found


def model_kind(data: bytes) -> int:
    """The kind of a SentencePiece file; a file that does not say is a unigram one."""
    settings = _field(data, _SETTINGS)
    return UNIGRAM if not settings else _field(settings, _KIND) or UNIGRAM


@lru_cache(maxsize=4)
def load(path: str = VOCABULARY) -> Pieces:
    """The pieces of a SentencePiece file with byte fallback."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    size = file.get_piece_size()
    byte_ids, ids, names, bytes_of = [0] * 256, [], [], [b""] * size
    for i in range(size):
        name = file.id_to_piece(i)
        if file.is_byte(i):
            byte_ids[int(name[1:-1], 16)] = i
            bytes_of[i] = bytes([int(name[1:-1], 16)])
        elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)):
            ids.append(i)
            names.append(name)
            bytes_of[i] = name.replace(MARKER, " ").encode()
    scores = [file.get_score(i) for i in ids]
    if model_kind(file.serialized_model_proto()) == BPE:
        norm = math.log(math.fsum(1 / (rank + ZIPF_OFFSET) for rank in range(len(ids))))
        scores = [-math.log(rank + ZIPF_OFFSET) - norm for rank in range(len(ids))]
    return build(list(zip(names, scores)), byte_ids, ids, size, bytes_of)


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The fields of the pieces (as large as the vocabulary file) on all executors; see ``received``."""
    return spark.sparkContext.broadcast(dict(vars(load(path))))


def received(fields: Broadcast) -> Pieces:
    return Pieces(**fields.value)
