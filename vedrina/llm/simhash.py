"""SimHash near-duplicates, found with an inverted index over the positional bytes of the fingerprints.

1. A fingerprint has 64 bits: bit i is set if over half of the shingles' XXH64 hashes have it set.
2. Equal fingerprints are one entry of the index, however many documents have them.
3. Two fingerprints that differ in at most d bits differ in at most d of the 8 bytes. The positions are cut into d + 2 groups, of
   which such a pair has at least two in common, so the index has a list for each choice of two groups and their bytes (four bytes
   for d = 2). A list by a single byte would hold a 256th of all fingerprints, and its pairs grow with the square of the input.
4. A list that is longer than ``LONG`` is cut once more: a pair that reaches the guaranteed minimum of 8 - d bytes shares so many
   beyond those of the list, so there is a shorter list for each choice of these positions. Such a list has at most 256^d
   members, whatever the input's size.
5. In a list the shared positional bytes of each pair are tallied, block by block. Pairs with fewer than 8 - d are dropped, and the
   bits of the others are compared. The links of a list leave it as a forest, never as all pairs.
6. The components are found over the links of all lists.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked like any other. Documents
without an id link as all others do; a component's id is the smallest one in it, null if none of its documents has one. Rows that
repeat an id are in the result once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm.components import connected_components
from vedrina.llm.text import filled
from vedrina.shared import new_path, written

SHINGLE_WORDS, MAX_BITS = 3, 2
SEED = 42
# Hashes handled at once, so that a very long text needs no more memory than its words.
HASHES = 1 << 16
# Longer lists are cut by more bytes.
LONG = 2048
# Pairs tallied at once.
BLOCK_PAIRS = 1 << 20

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)])


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number."""
    # Bytes are lowered and split as the contract says: A-Z only, and at space and \t\n\v\f\r only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, dtype=np.int64)
    hash_of = xxhash.xxh64_intdigest
    for start in range(0, n, HASHES):
        part = words[start : min(start + HASHES, n) + width - 1]
        if len(words) < width:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*[part[k:] for k in range(width)]))
        counts += _bit_counts(np.array([hash_of(s, SEED) for s in shingles], dtype="<u8"))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, carry: list[str] | None = None
) -> DataFrame:
    """The id and ``fp`` (bigint) of each row and, if ``carry`` names it, ``text_key``, the MD5 of the text."""
    extra = carry or []

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(value.as_py(), width) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64()), *batch.columns[2:]], [id, "fp", *extra])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(id, text, *[_text_key(F.col(text)).alias(name) for name in extra])
    return rows.mapInArrow(of_batch, ", ".join([f"`{id}` {kind}", "fp bigint", *[f"{name} string" for name in extra]]))


def position_groups(max_bits: int) -> list[tuple[int, ...]]:
    """The 8 positions in ``max_bits`` + 2 groups of nearly equal size."""
    return [tuple(int(k) for k in part) for part in np.array_split(np.arange(8), max_bits + 2)]


def _masked(fp: Column, positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << (8 * k) for k in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def _key(fp: Column, positions: tuple[int, ...]) -> Column:
    """A list: its positions, as the bits of a number, and the bytes there."""
    return F.struct(F.lit(sum(1 << k for k in positions)).cast("int").alias("positions"), _masked(fp, positions).alias("bytes"))


def index_keys(fp: Column, max_bits: int) -> Column:
    """The lists a fingerprint is in."""
    return F.explode(F.array(*[_key(fp, (*a, *b)) for a, b in combinations(position_groups(max_bits), 2)]))


def finer_keys(fp: Column, positions: Column, max_bits: int) -> Column:
    """The shorter lists that a fingerprint is in instead of the list with these positions."""
    chosen = F.lit(None)
    for a, b in combinations(position_groups(max_bits), 2):
        own = (*a, *b)
        others = [k for k in range(8) if k not in own]
        keys = [_key(fp, tuple(sorted((*own, *more)))) for more in combinations(others, max(0, 8 - max_bits - len(own)))]
        chosen = F.when(positions == sum(1 << k for k in own), F.array(*keys)).otherwise(chosen)
    return chosen


def links_in_list(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each member of a list (distinct fingerprints) the first one that it is linked with, over others if need be."""
    n = len(fps)
    step = max(1, BLOCK_PAIRS // n)
    a, b = [], []
    for start in range(0, n, step):
        block = fps[start : start + step]
        # Pairs with earlier blocks were compared there.
        differing = block[:, None] ^ fps[None, start:]
        shared = (differing[..., None].view(np.uint8) == 0).sum(axis=-1)
        retained = np.nonzero(shared >= 8 - max_bits)
        near = np.bitwise_count(differing[retained]) <= max_bits
        a.append(retained[0][near] + start)
        b.append(retained[1][near] + start)
    a, b = np.concatenate(a), np.concatenate(b)
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        # A member's label is a member, whose own label may be smaller by now.
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _links(max_bits: int):
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by list, so a list is a run of rows, which batches may cut."""
        rest: list[pa.RecordBatch] = []

        def found(fps: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if end - start > 1:
                    own = fps[start:end]
                    first = links_in_list(own, max_bits)
                    linked = first != np.arange(len(own))
                    a.append(own[linked])
                    b.append(own[first[linked]])
            ends = [pa.array(np.concatenate(side).view(np.int64)) for side in (a, b)]
            return pa.RecordBatch.from_arrays(ends, ["a", "b"])

        def column(parts: list[pa.RecordBatch], name: str) -> np.ndarray:
            return np.concatenate([part.column(part.schema.get_field_index(name)).to_numpy() for part in parts])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            positions, at = column([batch], "positions"), column([batch], "bytes")
            cuts = np.flatnonzero((positions[1:] != positions[:-1]) | (at[1:] != at[:-1])) + 1
            if rest and (positions[0], at[0]) != last:
                fps = column(rest, "fp").view(np.uint64)
                yield found(fps, np.array([0, len(fps)]))
                rest = []
            if len(cuts):
                head = column([*rest, batch.slice(0, int(cuts[-1]))], "fp").view(np.uint64)
                before = len(head) - int(cuts[-1])
                yield found(head, np.concatenate([[0], cuts + before]))
                rest = []
            rest.append(batch.slice(int(cuts[-1]) if len(cuts) else 0))
            last = (positions[-1], at[-1])
        if rest:
            fps = column(rest, "fp").view(np.uint64)
            yield found(fps, np.array([0, len(fps)]))

    return of_partition


def fingerprint_links(entries: DataFrame, max_bits: int, long: int | None = None) -> DataFrame:
    """Links ``a``, ``b`` between the fingerprints of ``entries`` (distinct ``fp``): enough of them that every pair within
    ``max_bits`` bits is connected."""
    listed = entries.select("fp", index_keys(F.col("fp"), max_bits).alias("key")).select("key.positions", "key.bytes", "fp")
    # Lists of one member link nothing, and most are such.
    sizes = listed.groupBy(F.col("positions").alias("p"), F.col("bytes").alias("b")).agg(F.count("*").alias("n")).filter("n > 1")
    sizes = written(sizes, new_path(entries.sparkSession, "simhash-lists"))
    members = listed.join(sizes, (F.col("positions") == F.col("p")) & (F.col("bytes") == F.col("b")))
    finer = F.when(F.col("n") > (long or LONG), finer_keys(F.col("fp"), F.col("positions"), max_bits))
    keys = F.coalesce(finer, F.array(F.struct("positions", "bytes")))
    members = members.select("fp", F.explode(keys).alias("key")).select("key.positions", "key.bytes", "fp").distinct()
    members = members.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes")
    return members.mapInArrow(_links(max_bits), "a bigint, b bigint")


def _labelled(prints: DataFrame, id: str, max_bits: int) -> DataFrame:
    """``fp`` and ``component_id`` of each fingerprint, written."""
    spark = prints.sparkSession
    entries = prints.groupBy("fp").agg(F.min(F.col(id).cast("bigint")).alias("least"))
    entries = written(entries, new_path(spark, "simhash-entries"))
    components = connected_components(fingerprint_links(entries.select("fp"), max_bits), "a", "b")
    placed = entries.join(components, entries["fp"] == components["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    placed = written(placed, new_path(spark, "simhash-placed"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = placed.join(written(ids, new_path(spark, "simhash-ids")), "component").select("fp", "component_id")
    return written(labels, new_path(spark, "simhash-labels"))


def _checked(max_bits: int) -> None:
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3: beyond that the lists have no useful bound")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The id, ``fp`` and ``component_id`` of each row. Ids are whole numbers."""
    _checked(max_bits)
    prints = written(fingerprints(docs, id, text, width), new_path(docs.sparkSession, "simhash-fps"))
    return prints.join(_labelled(prints, id, max_bits), "fp").select(id, "fp", "component_id")


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of the document with the smallest id of each component, and those without an id. Rows are dropped by id and
    text together: another text under the same id, which is in another component, has its own fate."""
    _checked(max_bits)
    spark = docs.sparkSession
    prints = fingerprints(docs.select(F.col(id).cast("bigint").alias("own_id"), F.col(text).alias("own_text")), "own_id", "own_text", width, ["text_key"])
    prints = written(prints, new_path(spark, "simhash-fps"))
    found = prints.join(_labelled(prints, "own_id", max_bits), "fp")
    gone = found.filter(F.col("own_id") != F.col("component_id")).select("own_id", "text_key").distinct()
    gone = written(gone, new_path(spark, "simhash-gone"))
    gone = gone.select(F.col("own_id").alias("__own_id"), F.col("text_key").alias("__text_key"))
    same = (F.col(f"`{id}`").cast("bigint") == F.col("__own_id")) & (_text_key(F.col(f"`{text}`")) == F.col("__text_key"))
    return docs.join(gone, same, "left_anti")


def _text_key(text: Column) -> Column:
    return F.md5(filled(text))
