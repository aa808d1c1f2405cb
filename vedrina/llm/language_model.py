"""A log-bilinear language model, trained in numpy by noise-contrastive estimation, and the scores it gives.

A leaf is a word that occurs often enough, at least sqrt(tokens) / SHARE times, so that there are SHARE * sqrt(tokens) at most and
more of them as the corpus grows; or an ending that stands for its rarer words; or, for words with a rare ending, one of HASHED. Every
leaf has vectors of its own, as context and as target. Leaves lie in groups of about the square root of their number,
neighbours by spelling from the end. The model predicts the leaf of a token from the leaves of the two before it:

    h = r[l1] C1 + r[l2] C2
    P(token | context) = softmax(h . U + a)[group] * softmax(h . T + b, within the group)[leaf] * (c + 1) / (tokens + words + 1)

where the last factor (1 for leaves of one word) is over the words of the leaf and leaves the mass of one more word to all unseen
ones, so that probabilities sum to one.

The counts of words grow with the corpus and are never gathered. Documents are grouped in blocks, and a block's distinct words
are dealt by a hash to buckets, one row per block and bucket. Bucket by bucket the words are counted over all blocks,
and each block is answered with the counts and leaves of its words; then it is stored as numbers of leaves, from which the model is
trained and the documents are scored. So words move once per block that has them, packed, and documents as numbers.

Training goes over all training documents in rounds: every task goes from the same model over the tokens of its blocks, in steps up
the noise-contrastive objective of both softmaxes with drawn noise; Spark adds up the tasks' moves, weighted by their tokens. There are
about tokens / (TOKENS_A_LEAF * leaves) tasks, so that the moves stay a small part of the corpus. A small corpus is passed over
several times, VISITS tokens in addition to its own.

Defined results: a null or empty text has the end as its only token. A null id counts as any other. Without
training documents all counts are zero and all leaves are equally likely but for the sizes of groups. Rows stay one to one with the input.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm.batches import parts
from vedrina.shared import LARGE_ROWS, new_path, small_batches, written

# The end of a text, as a word. Words are never empty.
END = ""
SHARE, HASHED = 8, 16
ENDING_CHARS = 2
WIDTH = 16
# Noise per token in each softmax, and the choices drawn for it for all tokens of a step.
NOISE, DRAWN_GROUPS, DRAWN_LEAVES = 10.0, 16, 8
ROUNDS, RATE = 3, 0.1
VISITS, MOST_PASSES = 8 << 20, 24
LEAST_TASKS, TOKENS_A_LEAF = 4, 512
# A block of documents has about this many bytes of text or one longer text, and at most so many documents.
BLOCK_BYTES, BLOCK_ROWS = 12 << 20, 50_000
# A bucket has the words that fall to it in about this many bytes of text.
BUCKET_BYTES, LEAST_BUCKETS = 64 << 20, 128
# Blocks are gathered in partitions of about so many tokens.
GATHERED, LEAST_GATHERED = 4 << 20, 16
# Numbers of leaves in one row (or those of one longer document), and rows of a matrix.
ROW_TOKENS, ROWS = 1 << 18, 1 << 13
# Numbers of the model in one row of moves.
PIECE = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """The words in small letters (A-Z only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending(word: str) -> str:
    return word[-ENDING_CHARS:]


@dataclass(frozen=True)
class Leaves:
    """The leaves of the frequent words and of endings, by name; ``tokens`` and ``words`` of each leaf."""

    words: dict[str, int]
    endings: dict[str, int]
    tokens: np.ndarray
    n_words: np.ndarray

    def of(self, word: bytes) -> int:
        text = word.decode("utf-8", "surrogatepass")
        found = self.words.get(text)
        if found is None:
            found = self.endings.get(ending(text))
        if found is None:
            found = 1 + zlib.crc32(ending(text).encode("utf-8", "surrogatepass")) % HASHED
        return found

    @property
    def divisors(self) -> np.ndarray:
        """The logarithm of what a word's count is divided by within its leaf; nan for leaves of one word."""
        found = np.log10(self.tokens + self.n_words + 1.0)
        found[list(self.words.values())] = np.nan
        return found


# --- blocks and buckets -------------------------------------------------------------------------


def _planes(numbers: np.ndarray) -> bytes:
    """Small numbers, first bytes first: the planes of high bytes are nearly empty and compress well."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class _Block:
    """Documents whose words are numbered together."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {END.encode(): 0}
        self.which: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.held_out: list[pa.Array] = []
        self.bytes = self.rows = 0

    def add(self, part: pa.RecordBatch) -> None:
        """Rows of id, text, held_out."""
        number = self.number
        per_text = [words_of(text) for text in part.column(1).to_pylist()]
        sizes = np.fromiter(map(len, per_text), np.int32, len(per_text))
        words = (number.setdefault(w, len(number)) for ws in per_text for w in ws)
        self.which.append(np.fromiter(words, np.int32, int(sizes.sum())))
        self.sizes.append(sizes)
        self.ids.append(part.column(0))
        self.held_out.append(part.column(2))
        self.bytes += part.column(1).nbytes
        self.rows += part.num_rows

    def packed(self, block: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """Rows (buckets below -1) with about ROW_TOKENS tokens of documents each, or one longer document, and their words by number (in order
        of appearance, so that frequent words have small ones); one row (bucket -1) with the place of each number in the order by bucket; and
        one row for each bucket that has words, with these and their counts in documents that are not held out."""
        which, sizes = np.concatenate(self.which), np.concatenate(self.sizes)
        held_out = pa.concat_arrays(self.held_out)
        teaches = ~held_out.to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(which[np.repeat(teaches, sizes)], minlength=len(self.number))
        counts[0] += teaches.sum()
        words = list(self.number)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        counts, bucket = counts[order], bucket[order]
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        cuts = [*heads.tolist(), len(words)]
        order = order.tolist()
        packed = [b"\n".join([words[n] for n in order[low:high]]) for low, high in zip(cuts, cuts[1:])]
        numbers = [counts[low:high].astype("<i8").tobytes() for low, high in zip(cuts, cuts[1:])]
        documents = pa.StructArray.from_arrays([pa.concat_arrays(self.ids), held_out, pa.array(sizes)], ["id", "held_out", "size"])
        names = ["block", "bucket", "words", "numbers", "documents"]
        ends = np.cumsum(sizes, dtype=np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff((ends + np.arange(len(sizes))) // ROW_TOKENS)) + 1, [len(sizes)]]).tolist()
        for number, (low, high) in enumerate(zip(cuts, cuts[1:]), -len(cuts)):
            listed = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), pa.concat_arrays([documents.slice(low, high - low)]))
            own = which[ends[low] - sizes[low] : ends[high - 1]]
            columns = [pa.array([block]), pa.array([number]), pa.nulls(1, pa.binary()), pa.array([_planes(own)], pa.binary()), listed]
            yield pa.RecordBatch.from_arrays(columns, names)
        n = len(packed)
        columns = [
            pa.array(np.full(n + 1, block)),
            pa.array(np.concatenate([[-1], bucket[heads]])),
            pa.array([_planes(place), *packed], pa.binary()),
            pa.array([None, *numbers], pa.binary()),
            pa.nulls(n + 1, listed.type),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


def _blocks(buckets: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for part in parts(batches, 1):
            if block.rows and (block.bytes + part.column(1).nbytes > BLOCK_BYTES or block.rows + part.num_rows > BLOCK_ROWS):
                yield from block.packed(number, buckets)
                number, block = number + 1, _Block()
            block.add(part)
        if block.rows:
            yield from block.packed(number, buckets)

    return of_batches


def blocks_of(rows: DataFrame) -> DataFrame:
    """Rows (id, text, held_out) in blocks, see ``_Block.packed``."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / BUCKET_BYTES))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"block bigint, bucket bigint, words binary, numbers binary, documents array<struct<id:{kind},held_out:boolean,size:int>>"
    return rows.mapInArrow(_blocks(buckets), schema)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, list[bytes], np.ndarray]]]]:
    """Rows (block, bucket, words, numbers), sorted by bucket, as buckets with their blocks' words and counts."""
    current, found = -1, []
    for batch in batches:
        for row in range(batch.num_rows):
            block, bucket, words, numbers = (column[row].as_py() for column in batch.columns)
            if bucket != current:
                if found:
                    yield current, found
                current, found = bucket, []
            found.append((block, words.split(b"\n"), np.frombuffer(numbers, "<i8")))
    if found:
        yield current, found


def _counted(blocks: list[tuple[int, list[bytes], np.ndarray]]) -> Counter:
    counts: Counter = Counter()
    for _, words, numbers in blocks:
        for word, c in zip(words, numbers.tolist()):
            counts[word] += c
    return counts


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, blocks in _buckets(batches):
        known = [(w.decode("utf-8", "surrogatepass"), c) for w, c in _counted(blocks).items() if c]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in known], pa.string()), pa.array([c for _, c in known], pa.int64())], ["word", "c"])


def _answer_buckets(leaves: Broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in _buckets(batches):
            counts = _counted(blocks)
            answers = {word: (c, leaves.value.of(word)) for word, c in counts.items()}
            for block, words, _ in blocks:
                answer = np.array([answers[word] for word in words], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bucket]), pa.array([answer.tobytes()], pa.binary())], ["block", "bucket", "numbers"])

    return of_batches


def _by_bucket(blocks: DataFrame) -> DataFrame:
    rows = blocks.filter("bucket >= 0").select("block", "bucket", "words", "numbers")
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def word_counts(blocks: DataFrame) -> DataFrame:
    """``word`` and ``c`` of the documents that are not held out; the end is the empty word."""
    return _by_bucket(blocks).mapInArrow(_count_buckets, "word string, c bigint")


# --- leaves -------------------------------------------------------------------------------------


def least_count(n_tokens: int) -> float:
    """How often a word occurs that has a leaf of its own."""
    return max(2.0, math.sqrt(n_tokens) / SHARE)


def leaves_of(counts: DataFrame, n_tokens: int) -> Leaves:
    """The leaves from the word counts; at most 2 * SHARE * sqrt(n_tokens) + HASHED rows come to the driver."""
    least = least_count(n_tokens)
    ends = [row["c"] for row in counts.filter(F.col("word") == END).collect()]
    spelled = counts.filter(F.col("word") != END)
    frequent = [(row["word"], row["c"]) for row in spelled.filter(F.col("c") >= least).collect()]
    rare = spelled.filter(F.col("c") < least).groupBy(F.right("word", F.lit(ENDING_CHARS)).alias("ending"))
    rare = rare.agg(F.sum("c").alias("c"), F.count("*").alias("words"))
    own = F.when(F.col("c") >= least, F.col("ending"))
    hashed = F.when(F.col("c") < least, F.pmod(F.crc32("ending"), F.lit(HASHED)))
    shared = rare.groupBy(own.alias("ending"), hashed.alias("hashed")).agg(F.sum("c").alias("c"), F.sum("words").alias("words")).collect()
    endings = [(row["ending"], row["c"], row["words"]) for row in shared if row["ending"] is not None]
    listed = sorted([(word[::-1], 0, c, 1) for word, c in frequent] + [(end[::-1], 1, c, n) for end, c, n in endings])
    tokens, words = (np.zeros(1 + HASHED + len(listed), np.int64) for _ in range(2))
    tokens[0], words[0] = sum(ends), len(ends)
    for row in shared:
        if row["ending"] is None:
            tokens[1 + row["hashed"]], words[1 + row["hashed"]] = row["c"], row["words"]
    found: tuple[dict[str, int], dict[str, int]] = ({END: 0}, {})
    for leaf, (backwards, is_ending, c, n) in enumerate(listed, 1 + HASHED):
        found[is_ending][backwards[::-1]] = leaf
        tokens[leaf], words[leaf] = c, n
    return Leaves(*found, tokens, words)


def with_ends(word_leaves: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two leaves before each token and its own, the ends among them; ``start`` stands before the first."""
    ends = np.cumsum(sizes + 1) - 1
    token = np.zeros(len(word_leaves) + len(sizes), np.int32)
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word] = word_leaves
    before, second = np.full_like(token, start), np.full_like(token, start)
    before[1:], second[2:] = token[:-1], token[:-2]
    starts = ends - sizes
    before[starts] = start
    second[starts] = start
    second[(starts + 1)[sizes > 0]] = start
    return before, second, token


def _answered(
    pieces: list[tuple[pa.StructArray, bytes]], counts: np.ndarray, leaf: np.ndarray, n_ends: int, divisors: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """A block in rows, as it was packed: of each document what the counts alone decide, and the leaves of all words. ``pieces``: documents
    and their words by number; ``counts`` and ``leaf`` of the block's words by number."""
    log_c = np.log10(counts + 1.0)
    within = np.nan_to_num(log_c - divisors[leaf], nan=0.0)
    for documents, which in pieces:
        ids, held_out, sizes = documents.flatten()
        words = _from_planes(which)
        heads = np.concatenate([[0], np.cumsum(sizes.to_numpy(), dtype=np.int64)])
        sums = [np.concatenate([[0], np.cumsum(values[words], dtype=kind)])[heads] for values, kind in ((counts > 0, np.int64), (log_c, float), (within, float))]
        known, logs, inside = (np.diff(total) for total in sums)
        measured = {
            "id": ids, "held_out": held_out, "size": sizes,
            "n_known": pa.array(known + int(n_ends > 0)), "log_counts": pa.array(logs + math.log10(n_ends + 1)), "within": pa.array(inside),
        }
        rows = pa.StructArray.from_arrays(list(measured.values()), list(measured))
        listed = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        yield pa.RecordBatch.from_arrays([listed, pa.array([_planes(leaf[words])], pa.binary())], ["documents", "leaves"])


def _answer_blocks(fixed: Broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (bucket, words, numbers, documents) come sorted by block and bucket: a block's documents, the places, then the answers."""
        pieces, place, answers = [], None, []

        def done() -> Iterator[pa.RecordBatch]:
            found = np.concatenate(answers)[place]
            return _answered(pieces, found[:, 0], found[:, 1], *fixed.value)

        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column(0)[row].as_py()
                if bucket < -1:
                    if answers:
                        yield from done()
                        pieces, answers = [], []
                    # A copy, as a slice would keep the batch.
                    documents = pa.concat_arrays([batch.column(3).slice(row, 1).flatten()])
                    pieces.append((documents, batch.column(2)[row].as_py()))
                elif bucket == -1:
                    place = _from_planes(batch.column(1)[row].as_py())
                else:
                    answers.append(np.frombuffer(batch.column(2)[row].as_py(), "<i8").reshape(-1, 2))
        if answers:
            yield from done()

    return of_batches


def numbered(blocks: DataFrame, leaves: Leaves, n_tokens: int, kind: str) -> DataFrame:
    """The blocks (of ``blocks_of``) with leaves in place of words, in rows (``documents``, ``leaves``)."""
    context = blocks.sparkSession.sparkContext
    # As many words and endings as leaves_of allows.
    answered = _by_bucket(blocks).mapInArrow(_answer_buckets(context.broadcast(leaves)), "block bigint, bucket bigint, numbers binary")
    gathered = blocks.filter("bucket < 0").unionByName(answered, allowMissingColumns=True)
    gathered = gathered.repartition(max(LEAST_GATHERED, n_tokens // GATHERED), "block").sortWithinPartitions("block", "bucket")
    fixed = context.broadcast((int(leaves.tokens[0]), leaves.divisors))
    measured = f"id:{kind},held_out:boolean,size:int,n_known:bigint,log_counts:double,within:double"
    schema = f"documents array<struct<{measured}>>, leaves binary"
    return gathered.select("bucket", "words", "numbers", "documents").mapInArrow(_answer_blocks(fixed), schema)


# --- the model ----------------------------------------------------------------------------------


@dataclass
class LogBilinear:
    """``given``: vectors of the leaves as context (the last one: before the first token); ``near`` and ``far``: matrices of
    the two places; ``group``, ``group_bias`` and ``target``, ``bias``: of predicted groups and leaves."""

    given: np.ndarray
    near: np.ndarray
    far: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @property
    def size(self) -> int:
        """Leaves in a group; the last group may have fewer."""
        return math.ceil(math.sqrt(len(self.target)))

    def predicted(self, before: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.given[before] @ self.near + self.given[second] @ self.far

    def group_scores(self, predicted: np.ndarray) -> np.ndarray:
        return predicted @ self.group.T + self.group_bias

    def leaf_scores(self, predicted: np.ndarray, group: int) -> np.ndarray:
        low = group * self.size
        return predicted @ self.target[low : low + self.size].T + self.bias[low : low + self.size]

    def log_probabilities(self, before: np.ndarray, second: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Natural logarithms of each token's leaf after its context, normalised, by batches of matrix products."""
        order = np.argsort(token, kind="stable")
        token = token[order]
        groups = token // self.size
        found = np.empty(len(token), np.float32)
        cuts = np.searchsorted(groups, np.arange(len(self.group) + 1))
        for group, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            for at in range(low, high, ROWS):
                part = slice(at, min(at + ROWS, high))
                predicted = self.predicted(before[order[part]], second[order[part]])
                found[part] = _chosen(self.group_scores(predicted), groups[part])
                found[part] += _chosen(self.leaf_scores(predicted, group), token[part] - group * self.size)
        back = np.empty_like(found)
        back[order] = found
        return back

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    def moved(self, moves: np.ndarray) -> LogBilinear:
        arrays = [getattr(self, f.name) for f in fields(self)]
        cuts = np.cumsum([a.size for a in arrays])[:-1]
        return LogBilinear(*(a + part.reshape(a.shape).astype(np.float32) for a, part in zip(arrays, np.split(moves, cuts))))


def _chosen(scores: np.ndarray, choice: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax at each row's choice."""
    scores -= scores.max(axis=1, keepdims=True)
    at = scores[np.arange(len(scores)), choice]
    np.exp(scores, out=scores)
    return at - np.log(scores @ np.ones(scores.shape[1], np.float32))


def shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The noise: smoothed shares of the groups of leaves, and of each leaf in its group."""
    size = math.ceil(math.sqrt(len(counts)))
    smooth = counts + 1.0
    group = np.add.reduceat(smooth, np.arange(0, len(counts), size))
    return (group / group.sum()).astype(np.float32), (smooth / group[np.arange(len(counts)) // size]).astype(np.float32)


def untrained(counts: np.ndarray, seed: int = 0) -> LogBilinear:
    """The unigram shares of the leaves with these counts, whatever the context."""
    group, leaf = shares(counts)
    given = (0.1 * np.random.default_rng(seed).standard_normal((len(counts) + 1, WIDTH))).astype(np.float32)
    eye = np.eye(WIDTH, dtype=np.float32)
    zeros = [np.zeros((rows, WIDTH), np.float32) for rows in (len(group), len(leaf))]
    return LogBilinear(given, eye, 0.5 * eye, zeros[0], np.log(group), zeros[1], np.log(leaf))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _added(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order, and the sum of the values of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[heads], np.add.reduceat(values[order], heads, axis=0)


class Training:
    """Steps of one task from a model: each a move up log p(data) + NOISE E[log p(noise)] of some tokens in both softmaxes, with
    p(data) = logistic(s - log(NOISE q)) and the expectation over drawn choices. AdaGrad, so that rare leaves move as far as
    frequent ones."""

    def __init__(self, model: LogBilinear, noise: tuple[np.ndarray, np.ndarray], rate: float, seed: int) -> None:
        self.model = LogBilinear(*(getattr(model, f.name).copy() for f in fields(model)))
        self.seen = {f.name: np.full(getattr(model, f.name).shape, 1e-6, np.float32) for f in fields(model)}
        self.rate, self.dice = rate, np.random.default_rng(seed)
        self.below = [np.log(NOISE * q) for q in noise]
        # Draws are places on one line, where every group has its leaves side by side.
        self.groups_line = np.cumsum(noise[0], dtype=float)
        self.leaves_line = np.cumsum(noise[1], dtype=float)
        size = model.size
        self.firsts = np.arange(0, len(noise[1]), size)
        self.lasts = np.minimum(self.firsts + size, len(noise[1])) - 1

    def _move(self, name: str, gradient: np.ndarray, rows: slice | np.ndarray = slice(None)) -> None:
        seen = self.seen[name][rows] + gradient * gradient
        self.seen[name][rows] = seen
        getattr(self.model, name)[rows] += self.rate * gradient / np.sqrt(seen)

    def _data(self, names: tuple[str, str], below: np.ndarray, predicted: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The push of the data: on what was predicted, and how strong it is."""
        vectors, bias = (getattr(self.model, name) for name in names)
        own = vectors[chosen]
        push = 1 - _logistic(np.einsum("ij,ij->i", predicted, own) + (bias - below)[chosen])
        return push[:, None] * own, push

    def _noise(self, names: tuple[str, str], below: np.ndarray, predicted: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vectors, bias = (getattr(self.model, name) for name in names)
        push = _logistic(predicted @ vectors[drawn].T + (bias[drawn] - below[drawn]))
        push *= -NOISE / len(drawn)
        return push @ vectors[drawn], push

    def _finish(self, names: tuple[str, str], predicted: np.ndarray, chosen: np.ndarray, push: np.ndarray, drawn: np.ndarray, back: np.ndarray, n: np.ndarray) -> None:
        """Moves the choices: ``push`` of the data for each token, ``back`` and ``n`` of each drawn choice."""
        heads = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        pushed = np.concatenate([push[:, None] * predicted, push[:, None]], axis=1)
        own = np.add.reduceat(pushed, heads, axis=0)
        rows, sums = _added(np.concatenate([chosen[heads], drawn]), np.concatenate([own, np.concatenate([back, n[:, None]], axis=1)]))
        sums /= len(chosen)
        self._move(names[0], sums[:, :-1], rows)
        self._move(names[1], sums[:, -1], rows)

    def step(self, before: np.ndarray, second: np.ndarray, token: np.ndarray) -> None:
        model = self.model
        order = np.argsort(token, kind="stable")
        before, second, token = before[order], second[order], token[order]
        groups = token // model.size
        given_near, given_far = model.given[before], model.given[second]
        predicted = given_near @ model.near + given_far @ model.far

        names, below = ("group", "group_bias"), self.below[0]
        back, push = self._data(names, below, predicted, groups)
        drawn = np.searchsorted(self.groups_line, self.dice.random(DRAWN_GROUPS) * self.groups_line[-1])
        drawn = np.minimum(drawn, len(self.firsts) - 1)
        more, noise = self._noise(names, below, predicted, drawn)
        back += more
        moves = [(names, groups, push, drawn, noise.T @ predicted, noise.sum(axis=0))]

        names, below = ("target", "bias"), self.below[1]
        more, push = self._data(names, below, predicted, token)
        back += more
        heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        present = groups[heads]
        low, high = self.firsts[present], self.lasts[present]
        under = np.where(low > 0, self.leaves_line[low - 1], 0.0)
        places = under[:, None] + self.dice.random((len(present), DRAWN_LEAVES)) * (self.leaves_line[high] - under)[:, None]
        drawn = np.clip(np.searchsorted(self.leaves_line, places), low[:, None], high[:, None])
        backs, sums = np.empty((*drawn.shape, WIDTH), np.float32), np.empty(drawn.shape, np.float32)
        for k, (first, last) in enumerate(zip(heads.tolist(), [*heads[1:].tolist(), len(token)])):
            part = predicted[first:last]
            more, noise = self._noise(names, below, part, drawn[k])
            back[first:last] += more
            backs[k], sums[k] = noise.T @ part, noise.sum(axis=0)
        moves.append((names, token, push, drawn.ravel(), backs.reshape(-1, WIDTH), sums.ravel()))

        for names, chosen, push, drawn, pushed, n in moves:
            self._finish(names, predicted, chosen, push, drawn, pushed, n)
        back /= len(token)
        contexts, pushes = _added(np.concatenate([before, second]), np.concatenate([back @ model.near.T, back @ model.far.T]))
        self._move("near", given_near.T @ back)
        self._move("far", given_far.T @ back)
        self._move("given", pushes, contexts)

    def steps(self, before: np.ndarray, second: np.ndarray, token: np.ndarray) -> None:
        """Once over the tokens: as many steps as keep one about twice the leaves, each with tokens from everywhere."""
        n = math.ceil(len(token) / (1024 + 2 * len(self.model.target)))
        for k in range(n):
            self.step(before[k::n], second[k::n], token[k::n])


def passes_over(n_tokens: int) -> int:
    """How often the training goes over the corpus."""
    return min(MOST_PASSES, max(1, round((n_tokens + VISITS) / max(1, n_tokens))))


def _train_round(given: Broadcast, round: int, passes: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (documents, leaves). The passes over a row are dealt over the rounds."""
        model, noise = given.value
        task = TaskContext.get().partitionId()
        training, trained, number = Training(model, noise, RATE * (1 - round / ROUNDS), task), 0, task
        for batch in batches:
            for row in range(batch.num_rows):
                number += 1
                times = sum((at + number) % ROUNDS == round for at in range(passes))
                documents = batch.column(0).slice(row, 1).flatten()
                teaches = ~documents.field("held_out").to_numpy(zero_copy_only=False).astype(bool)
                if not times or not teaches.any():
                    continue
                sizes = documents.field("size").to_numpy().astype(np.int64)
                leaves = _from_planes(batch.column(1)[row].as_py())[np.repeat(teaches, sizes)]
                tokens = with_ends(leaves, sizes[teaches], len(model.target))
                for _ in range(times):
                    training.steps(*tokens)
                    trained += len(tokens[2])
        if trained:
            moves = (training.model.flat() - model.flat()).astype("<f2")
            pieces = [moves[at : at + PIECE].tobytes() for at in range(0, len(moves), PIECE)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(pieces)), pa.int64()), pa.array([trained] * len(pieces), pa.int64()), pa.array(pieces, pa.binary())], ["piece", "trained", "moves"]
            )

    return of_batches


def _sum_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' moves of each piece, averaged by the tokens that made them."""
    sums: dict[int, np.ndarray] = {}
    weights: Counter = Counter()
    for batch in batches:
        for piece, trained, moves in zip(*(column.to_pylist() for column in batch.columns)):
            sums[piece] = sums.get(piece, 0) + trained * np.frombuffer(moves, "<f2").astype(float)
            weights[piece] += trained
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([(sums[p] / weights[p]).astype("<f4").tobytes() for p in sums], pa.binary())], ["piece", "moves"]
    )


def train(rows: DataFrame, counts: np.ndarray, n_tokens: int) -> LogBilinear:
    """The model of leaves with these counts, from ``numbered`` blocks. What comes to the driver is of the size of the model."""
    model, noise = untrained(counts), shares(counts)
    tasks = LEAST_TASKS + n_tokens // (TOKENS_A_LEAF * len(counts))
    for round in range(ROUNDS if n_tokens else 0):
        given = rows.sparkSession.sparkContext.broadcast((model, noise))
        moves = rows.coalesce(tasks).mapInArrow(_train_round(given, round, passes_over(n_tokens)), "piece bigint, trained bigint, moves binary")
        found = moves.repartition("piece").mapInArrow(_sum_moves, "piece bigint, moves binary").toArrow()
        given.unpersist()
        pieces = dict(zip(found["piece"].to_pylist(), found["moves"].to_pylist()))
        if pieces:
            model = model.moved(np.frombuffer(b"".join(pieces[k] for k in range(len(pieces))), "<f4"))
    return model


# --- scoring ------------------------------------------------------------------------------------


def _score_blocks(given: Broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (documents, leaves)."""
        model = given.value
        for batch in batches:
            for row in range(batch.num_rows):
                documents = batch.column(0).slice(row, 1).flatten()
                leaves = _from_planes(batch.column(1)[row].as_py())
                sizes = documents.field("size").to_numpy().astype(np.int64)
                tokens = with_ends(leaves, sizes, len(model.target))
                logs = model.log_probabilities(*tokens).astype(float) / math.log(10)
                score = np.add.reduceat(logs, np.cumsum(sizes + 1) - sizes - 1) + documents.field("within").to_numpy()
                columns = [documents.field(name) for name in ("id", "held_out", "n_known", "log_counts")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes + 1), pa.array(score)], ["id", "held_out", "n_known", "log_counts", "n_tokens", "score"])

    return of_batches


def lm_scores(docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``held_out`` (from the id) tells which documents the model does not learn from. ``base_score`` is the sum of
    log10((c + 1) / (all + words + 1)), ``score`` the model's log10 probability.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    kind = rows.schema["id"].dataType.simpleString()
    with small_batches(spark):
        blocks = written(blocks_of(rows), new_path(spark, "lm-blocks"), **LARGE_ROWS)
        counts = written(word_counts(blocks), new_path(spark, "lm-counts"))
        n_tokens, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        leaves = leaves_of(counts, n_tokens)
        leaved = written(numbered(blocks, leaves, n_tokens, kind), new_path(spark, "lm-leaves"), **LARGE_ROWS)
        model = spark.sparkContext.broadcast(train(leaved, leaves.tokens, n_tokens))
        scores = leaved.mapInArrow(
            _score_blocks(model), f"id {kind}, held_out boolean, n_known bigint, log_counts double, n_tokens bigint, score double"
        )
        scores = written(scores, new_path(spark, "lm-scores"))
    return scores.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * math.log10(n_tokens + n_words + 1)).alias("base_score"),
        "score",
    )
