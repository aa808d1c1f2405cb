"""Ranked lexical search over a length-stratified inverted index.

The index: documents with the same length normaliser m form a stratum. A stratum is cut into blocks of about ``block_terms``
terms, by a hash of the row's place, so that a stratum of any size lies over many tasks. A block is one row: its documents in
order of id, its terms, and of each term the postings in order of tf. All of it is a table in the shared folder.

The search: a task takes the postings of the wanted terms from its blocks. For each tf of a block the impact is computed once,
as m is the same in all of it. The greatest tf of each term bounds what an item can score in a block; an item visits
the blocks in order of this bound and stops when no bound reaches its k-th score so far. The best k of the tasks are ranked
together.

Scores are whole numbers: the sum over an item's terms, once each, of w * ((10^9 * tf) div (10^3 * tf + 20 * m)), where w is
floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m is 50 + (50 * n * N) div L, for N documents with terms, L terms in them, df
documents that hold the term, and n terms of the document.

Items are taken in blocks of a bounded number of terms, so only a bounded part of them is in the driver at once.

Defined results: a term is a run of ASCII letters and digits and of all characters beyond ASCII, with A-Z lowered. A null text
has no terms; documents without terms are not counted, and found by no item. Rows are documents of their own, also where
they repeat an id. Equal scores are in order of the id, nulls last. Rows of items that share an id are one item with the terms of
all; an item without terms, or whose terms are nowhere, gets no rows. Other columns of both tables are left out, so
their names don't matter. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vedrina.llm.batches import parts
from vedrina.shared import LARGE_ROWS, new_path, small_batches, written

BEST = 50
# Terms of a block, about: a few megabytes. A longer document is a block of its own.
BLOCK_TERMS = 1 << 19
# Terms of items handled at once, about; an item is not cut.
ITEM_TERMS = 1 << 20

# Bytes that are no part of a term become a space, capital letters small ones.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


@dataclass(frozen=True)
class Index:
    """``blocks``: the table of blocks; ``documents`` and ``terms``: N and L."""

    blocks: DataFrame
    documents: int
    terms: int


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document with terms: the id, n, the distinct terms (joined by spaces) and their counts."""
    for batch in parts(batches, 1):
        ids, lengths, terms, counts = [], [], [], []
        for id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = terms_of(text.as_py())
            if found:
                counted = Counter(found)
                ids.append(id)
                lengths.append(len(found))
                terms.append(b" ".join(counted))
                counts.append(np.fromiter(counted.values(), "<u4", len(counted)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
            ["id", "n", "terms", "counts"],
        )


def _terms_array(joined: bytes) -> pa.Array:
    """Terms joined by single spaces, as an array."""
    data = np.frombuffer(joined, np.uint8)
    space = data == 32
    ends = np.append(np.flatnonzero(space), len(data))
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[~space].tobytes())])


def _block(rows: list[dict]) -> dict:
    """The block of documents of one stratum."""
    rows.sort(key=lambda row: (row["id"] is None, row["id"] or 0))
    codes = _terms_array(b" ".join(row["terms"] for row in rows)).dictionary_encode()
    counts = [np.frombuffer(row["counts"], "<u4") for row in rows]
    places = np.repeat(np.arange(len(rows), dtype="<u4"), [len(own) for own in counts])
    tfs = np.concatenate(counts)
    in_order = pc.array_sort_indices(codes.dictionary).to_numpy()
    rank = np.empty(len(in_order), np.int64)
    rank[in_order] = np.arange(len(in_order))
    ranks = rank[codes.indices.to_numpy()]
    order = np.lexsort((places, tfs, ranks))
    ends = np.cumsum(np.bincount(ranks)).astype("<u4")
    return {
        "m": rows[0]["m"],
        "ids": np.array([row["id"] or 0 for row in rows], "<i8").tobytes(),
        "no_id": sum(row["id"] is None for row in rows),
        "terms": b" ".join(codes.dictionary.take(pa.array(in_order)).to_pylist()),
        "ends": ends.tobytes(), "tfs": tfs[order].tobytes(), "places": places[order].tobytes(),
    }


_BLOCK_TYPE = pa.schema([
    ("m", pa.int64()), ("ids", pa.binary()), ("no_id", pa.int64()), ("terms", pa.binary()), ("ends", pa.binary()),
    ("tfs", pa.binary()), ("places", pa.binary()),
])
_BLOCK = "m bigint, ids binary, no_id bigint, terms binary, ends binary, tfs binary, places binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors come sorted by block, so a block is a run of rows, which batches may cut."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["m"], row["shard"]) != now:
                if rows:
                    yield pa.RecordBatch.from_pylist([_block(rows)], _BLOCK_TYPE)
                now, rows = (row["m"], row["shard"]), []
            rows.append(row)
    if rows:
        yield pa.RecordBatch.from_pylist([_block(rows)], _BLOCK_TYPE)


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> Index:
    """The index over all documents. Ids are whole numbers."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    with small_batches(spark):
        vectors = written(plain.mapInArrow(_vectors, "id bigint, n bigint, terms binary, counts binary"), new_path(spark, "lexical-vectors"), **LARGE_ROWS)
        documents, terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            return Index(written(spark.createDataFrame([], _BLOCK), new_path(spark, "lexical-blocks")), 0, 0)
        m = F.expr(f"50 + (50L * n * {documents}L) div {terms}L")
        # The place of a row in the written table tells equal rows apart, too, and stays the same when a task is repeated.
        placed = vectors.select("*", m.alias("m"), F.xxhash64(F.monotonically_increasing_id()).alias("place"))
        strata = placed.groupBy(F.col("m").alias("stratum")).agg(F.ceil(F.sum("n") / block_terms).alias("shards"))
        strata = written(strata, new_path(spark, "lexical-strata"))
        dealt = placed.join(strata, F.col("m") == F.col("stratum")).select(
            "m", F.pmod("place", "shards").alias("shard"), "id", "terms", "counts"
        )
        dealt = dealt.repartition("m", "shard").sortWithinPartitions("m", "shard")
        return Index(written(dealt.mapInArrow(_blocks, _BLOCK), new_path(spark, "lexical-blocks"), **LARGE_ROWS), documents, terms)


def _item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """The distinct terms of each item, written."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            ids, terms = [], []
            for place, text in enumerate(batch.column(1)):
                own = set(terms_of(text.as_py()))
                ids.extend([place] * len(own))
                terms.extend(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())], ["item", "term"])

    kind = items.schema[id].dataType.simpleString()
    terms = items.select(F.col(id).alias("item"), F.col(text).alias("text")).mapInArrow(split, f"item {kind}, term binary")
    return written(terms.distinct(), new_path(items.sparkSession, "lexical-items"))


def document_counts(blocks: DataFrame, terms: list[bytes]) -> dict[int, int]:
    """How many documents hold each of the terms (by its place in the list)."""
    wanted = pa.array(terms, pa.large_binary())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms), np.int64)
        for batch in batches:
            for joined, ends in zip(batch.column(0), batch.column(1)):
                own, lengths = _found(joined.as_py(), ends.as_py(), wanted)[:2]
                counts[own] += lengths
        places = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(counts[places])], ["term", "n"])

    found = blocks.select("terms", "ends").mapInArrow(counted, "term bigint, n bigint")
    return {row.term: row.n for row in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _found(joined: bytes, ends: bytes, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the wanted terms that a block has: their places in the list, the lengths of their postings, and where these start."""
    at = pc.index_in(_terms_array(joined), value_set=wanted)
    here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    ends = np.frombuffer(ends, "<u4").astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    return at.take(pa.array(here)).to_numpy(), (ends - starts)[here], starts[here]


@dataclass
class _Wanted:
    """What a block has for the wanted terms: for each term the bounds of its postings, then document places and
    weighted impacts; and for each item a bound on its scores."""

    starts: dict[int, tuple[int, int]]
    places: np.ndarray
    gains: np.ndarray
    bounds: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray


def _wanted_of(block: dict, wanted: pa.Array, weights: np.ndarray, item_terms: np.ndarray, item_starts: np.ndarray) -> _Wanted | None:
    own, lengths, starts = _found(block["terms"], block["ends"], wanted)
    if not len(own):
        return None
    take = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    tfs = np.frombuffer(block["tfs"], "<u4")[take].astype(np.int64)
    distinct, which = np.unique(tfs, return_inverse=True)
    impacts = (1_000_000_000 * distinct) // (1000 * distinct + 20 * block["m"])
    ends = np.cumsum(lengths)
    # Postings are in order of tf, so a term's last one has its greatest impact.
    gains = impacts[which] * np.repeat(weights[own], lengths)
    most = np.zeros(len(weights), np.int64)
    most[own] = gains[ends - 1]
    ids = np.frombuffer(block["ids"], "<i8")
    return _Wanted(
        {term: (int(end - length), int(end)) for term, end, length in zip(own.tolist(), ends, lengths)},
        np.frombuffer(block["places"], "<u4")[take], gains, np.add.reduceat(most[item_terms], item_starts), ids,
        np.arange(len(ids)) >= len(ids) - block["no_id"],
    )


def _best_of(blocks: list[_Wanted], item: int, terms: list[int], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, whether there is none, and scores of the item's best k documents in some blocks."""
    ids, no_id, scores = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
    least = 1
    for block in sorted(blocks, key=lambda block: -block.bounds[item]):
        if block.bounds[item] < least:
            break
        sums = np.zeros(len(block.ids), np.int64)
        for term in terms:
            if term in block.starts:
                start, end = block.starts[term]
                # A term has one posting a document.
                sums[block.places[start:end]] += block.gains[start:end]
        found = np.flatnonzero(sums >= least)
        if not len(found):
            continue
        ids, no_id = np.concatenate([ids, block.ids[found]]), np.concatenate([no_id, block.no_id[found]])
        scores = np.concatenate([scores, sums[found]])
        order = np.lexsort((ids, no_id, -scores))[:k]
        ids, no_id, scores = ids[order], no_id[order], scores[order]
        if len(scores) == k:
            least = int(scores[-1])
    return ids, no_id, scores


def search(index: Index, items: DataFrame, id: str = "item_id", text: str = "text", k: int = BEST, item_terms: int = ITEM_TERMS) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: the item's id, ``rank``, ``doc_id``, ``score``."""
    spark = items.sparkSession
    with small_batches(spark):
        pairs = _item_terms(items, id, text)
        n_blocks = max(1, math.ceil(pairs.count() / item_terms))
        kind = pairs.schema["item"].dataType.simpleString()
        result = None
        for number in range(n_blocks):
            own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == number).collect()
            found = _searched(index, [(row.item, bytes(row.term)) for row in own], k, kind)
            found = written(found.toDF(id, "doc_id", "score"), new_path(spark, "lexical-found"))
            result = found if result is None else result.unionByName(found)
    best = Window.partitionBy(id).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = result.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(id, "rank", "doc_id", "score")


def _searched(index: Index, pairs: list[tuple], k: int, kind: str) -> DataFrame:
    """The best ``k`` of each task for the items of a block."""
    terms = sorted({term for _, term in pairs})
    held = document_counts(index.blocks, terms)
    # Terms that no document holds add nothing.
    known = {terms[place]: place for place in held}
    by_item: dict = {}
    for item, term in pairs:
        if term in known:
            by_item.setdefault(item, []).append(known[term])
    spark = index.blocks.sparkSession
    if not by_item:
        return spark.createDataFrame([], f"item {kind}, doc_id bigint, score bigint")
    items = list(by_item)
    lists = [sorted(by_item[item]) for item in items]
    flat = np.array([term for own in lists for term in own], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(own) for own in lists])[:-1]]).astype(np.int64)
    weights = np.zeros(len(terms), np.int64)
    for place, count in held.items():
        weights[place] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * count + 1)))
    wanted = pa.array(terms, pa.large_binary())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for row in range(batch.num_rows):
                [block] = batch.slice(row, 1).to_pylist()
                found = _wanted_of(block, wanted, weights, flat, starts)
                if found is not None:
                    blocks.append(found)
        for number, (item, own) in enumerate(zip(items, lists)):
            ids, no_id, scores = _best_of(blocks, number, own, k)
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), kind_in_arrow), pa.array(ids, mask=no_id), pa.array(scores)], ["item", "doc_id", "score"]
                )

    kind_in_arrow = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    return index.blocks.mapInArrow(best, f"item {kind}, doc_id bigint, score bigint")
