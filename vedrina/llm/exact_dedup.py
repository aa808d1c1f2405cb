"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Rows go on to the next step only while another row agrees with them so far, and only rows that
agree in length and prefix have their whole text hashed. Nothing is lost: a step sends on all rows of
every group of two or more. Between the steps travel lengths and hashes, never texts; the last
filter is a bitmap of fixed size, so the texts stay where they are read.

Defined results: a null text counts as empty; texts are equal when their UTF-8 bytes are. Of equal
texts the one with the largest id stays. Rows that repeat both id and text are one document: one row
in the result, each counted in ``group_size``. Null ids are smaller than all others. An empty table gives
an empty result. Columns of the input may have any names but those of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm.bitmap import bitmap_of, with_membership
from vedrina.llm.text import filled
from vedrina.shared import new_path, written

PREFIX_CHARS = 64


def _length(text: str) -> Column:
    return F.octet_length(filled(text))


def _prefix(text: str, chars: int) -> Column:
    return F.xxhash64(F.substring(filled(text), 1, chars))


def with_full_hash(docs: DataFrame, text: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` with ``_full``: the text's SHA-256 where another row may have the same text, else null."""
    heads = docs.select(_length(text).alias("_length"), _prefix(text, prefix_chars).alias("_prefix"))
    heads = heads.groupBy("_length", "_prefix").agg(F.count("*").alias("_rows"))
    heads = written(heads, new_path(docs.sparkSession, "dedup-heads"))
    lengths = heads.groupBy("_length").agg(F.sum("_rows").alias("_all")).filter("_all > 1")
    prefixes = heads.filter("_rows > 1").join(lengths, "_length", "left_semi")
    bitmap = bitmap_of(prefixes, F.xxhash64("_length", "_prefix"))
    key = F.xxhash64(_length(text), _prefix(text, prefix_chars))
    marked = with_membership(docs, key, bitmap, "_candidate")
    return marked.withColumn("_full", F.when(F.col("_candidate"), F.sha2(filled(text), 256))).drop("_candidate")


def exact_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per document: its id, ``keep_id`` (the document that stays), ``group_size``, ``kept``.

    ``carry`` adds columns that depend on the id and the text only.
    """
    extra = list(carry or {})
    hashed = with_full_hash(docs, text).select(id, "_full", *[c.alias(n) for n, c in (carry or {}).items()])
    hashed = written(hashed, new_path(docs.sparkSession, "dedup-hashed"))
    alone = hashed.filter("_full is null").select(
        id, F.col(id).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), *extra
    )
    members = hashed.filter("_full is not null").groupBy(id, "_full", *extra).agg(F.count("*").alias("_rows"))
    members = written(members, new_path(docs.sparkSession, "dedup-members"))
    groups = members.groupBy("_full").agg(F.max(id).alias("keep_id"), F.sum("_rows").alias("group_size"))
    groups = written(groups, new_path(docs.sparkSession, "dedup-groups"))
    together = members.join(groups, "_full").select(
        id, "keep_id", "group_size", F.col(id).eqNullSafe(F.col("keep_id")).alias("kept"), *extra
    )
    return alone.unionByName(together)


def distinct_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one per text. Of rows with one id and text, the one
    whose other columns come last as JSON. Only texts that may have copies are shuffled."""
    # The input's columns travel as one, whatever their names are.
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{id}`").alias("own_id"), F.col(f"`{text}`").alias("own_text"))
    hashed = with_full_hash(rows, "own_text")
    others = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in (id, text)]
    order = F.struct("own_id", F.to_json(F.struct(*others)) if others else F.lit(""))
    copies = hashed.filter("_full is not null").groupBy("_full").agg(F.max_by("row", order).alias("row"))
    kept = hashed.filter("_full is null").select("row").unionByName(copies.select("row"))
    return kept.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
