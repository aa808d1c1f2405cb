"""Mixing sources to target weights: Sainte-Lague quotas of equal blocks of words, in DataFrame functions only.

1. Each source gets a target in words: its share by weight of ``share`` times all words, at most
   ``most`` times its own size; what is cut off goes to the others by weight until none is above.
2. The targets are dealt out in whole blocks of ``block_words`` words: the next block always goes to the
   source with the highest quotient target / (2 * blocks + 1).
3. A source is split by a seeded hash of the id into shards of about ``shard_words`` words, so that no task
   handles a whole source, and the source's blocks are dealt to its shards in the same way, by size.
4. In a shard the documents follow one another in seeded random order and are cut into equal blocks. The quota
   takes all blocks as often as it can and then the first ones in that order, so all but one document of
   a shard are taken whole.

Sources may be any number: rows per source, and per shard of a source, pass through one task; documents go by shard.

Defined results: a null text has no words; a null source is a source of its own, the last in order; of a null id the
text is hashed. Rows that repeat an id follow one another. Documents without words are never
taken. An empty table gives an empty result. Reruns give the same rows, as only ids, sizes and the seed decide.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vedrina.llm.text import WORD, filled, words
from vedrina.shared import new_path, written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
# At most so many shards a source, so that dealing out its blocks stays a small job; they grow instead.
MOST_SHARDS = 4096
# The table of shards (some 50 bytes a row) is broadcast up to this many rows, and joined by a shuffle beyond.
BROADCAST_SHARDS = 200_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """For each row (``source``, ``source_size``): its ``ordinal`` by code point, nulls last, and ``target``.

    The sources that stop at their bound are those with the smallest bound per weight. With the first j
    of these at their bounds the others share the rest by weight; the right j is the first for which
    none of the others is above its bound.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("ordinal", F.row_number().over(in_order)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("ordinal") - 1, F.lit(len(weights))) + 1)
    )
    bounded = weighted.withColumn("bound", F.col("source_size") * most)
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "ordinal").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = bounded.select(
        "*",
        F.coalesce(F.sum("bound").over(by_bound), F.lit(0)).alias("bounds_before"),
        F.coalesce(F.sum("weight").over(by_bound), F.lit(0)).alias("weights_before"),
        F.sum("weight").over(everyone).alias("all_weights"),
        (F.sum("source_size").over(everyone) * share).alias("all_words"),
    )
    level = (F.col("all_words") - F.col("bounds_before")) / (F.col("all_weights") - F.col("weights_before"))
    fits = before.withColumn("level", F.when(level * F.col("weight") <= F.col("bound"), level))
    # The first level that fits, in order of bound / weight. Later ones fit too, and are lower: there sources that
    # would not have reached their bounds are at them.
    fitting = fits.withColumn("level", F.max("level").over(everyone))
    target = F.least(F.col("bound").cast("double"), F.col("level") * F.col("weight"))
    return fitting.select("source", "source_size", "ordinal", F.coalesce(target, F.col("bound").cast("double")).alias("target"))


def dealt(rows: DataFrame, group: list[str], weight: str, blocks: str, order: str, name: str) -> DataFrame:
    """``rows`` with the number of ``blocks`` (the same in all rows of a group) that each one gets.

    Blocks go one by one to the highest quotient weight / (2 * got + 1), the first by ``order`` on a tie. Only the
    quotients near the end are compared. With n rows, dealing by rounded shares misses the number by n / 2 at most, and
    setting this right moves the shares by 1.5 n at most in all, of which a row has its part.
    """
    everyone = Window.partitionBy(*group)
    share = F.col(weight) / F.sum(weight).over(everyone)
    slack = F.ceil(share * F.count("*").over(everyone) * 2) + 1
    shares = rows.withColumn("_share", share * F.col(blocks)).withColumn("_slack", slack)
    sure = F.greatest(F.floor("_share") - F.col("_slack"), F.lit(0))
    shares = shares.withColumn("_sure", sure).withColumn("_left", F.col(blocks) - F.sum("_sure").over(everyone))
    each = shares.select(
        *group, order, "_sure", "_left", weight, F.explode(F.sequence(F.col("_sure"), F.floor("_share") + F.col("_slack"))).alias("_got")
    )
    highest = Window.partitionBy(*group).orderBy((F.col(weight) / (F.col("_got") * 2 + 1)).desc(), order, "_got")
    won = each.withColumn("_rank", F.row_number().over(highest)).groupBy(*group, order).agg(
        (F.first("_sure") + F.count_if(F.col("_rank") <= F.col("_left"))).alias(name)
    )
    return rows.join(won, [*group, order])


def _hash(id: str, text: str, seed: int) -> Column:
    """A hash of the id (without one, of the text) that splits into shards by its first digits and orders by the others."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id).cast("string"), F.md5(filled(text)))))


def _shard(n_shards: Column) -> Column:
    return F.pmod(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint"), n_shards)


def _order() -> Column:
    return F.substring("_hash", 9, 24)


@dataclass(frozen=True)
class Mix:
    """``quotas``: by ``source``, what the source gets; ``laid``: by document, with ``_times`` that all of its shard
    is taken, and the words of it that are taken once more (``_again``). Both as written tables."""

    quotas: DataFrame
    laid: DataFrame


def _mix(
    docs: DataFrame, id: str, text: str, source: str, weights: tuple[int, ...], share: float, most: int, seed: int,
    block_words: int, shard_words: int,
) -> Mix:
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id).alias("_id"), F.col(source).alias("_source"), F.size(words(text)).cast("bigint").alias("size"), _hash(id, text, seed).alias("_hash")
    )
    sized = written(sized, new_path(spark, "mix-sizes"))
    sizes = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), new_path(spark, "mix-targets"))
    targets = targets.withColumn("_one", F.lit(1)).withColumn(
        "_blocks", F.round(F.sum("target").over(Window.partitionBy("_one")) / block_words).cast("bigint")
    )
    n_shards = F.least(F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)), F.lit(MOST_SHARDS))
    quotas = dealt(targets, ["_one"], "target", "_blocks", "ordinal", "source_blocks").select(
        "source", "ordinal", "source_size", "target", "source_blocks", n_shards.alias("n_shards")
    )
    quotas = written(quotas, new_path(spark, "mix-quotas"))

    placed = sized.join(quotas, F.col("_source").eqNullSafe(F.col("source"))).select(
        "_id", "size", "source_size", "target", "ordinal", "source_blocks", _shard(F.col("n_shards")).alias("shard"), _order().alias("_order")
    )
    shards = placed.groupBy("ordinal", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks"))
    shards = dealt(shards.filter("shard_size > 0"), ["ordinal"], "shard_size", "source_blocks", "shard", "quota")
    n_blocks = F.greatest(F.round(F.col("shard_size") / block_words), F.lit(1)).cast("bigint")
    shards = shards.withColumn("n_blocks", n_blocks).withColumn("quota", F.least("quota", F.col("n_blocks") * most))
    shards = shards.select(
        "ordinal", "shard",
        F.floor(F.col("quota") / F.col("n_blocks")).alias("_times"),
        F.floor(F.pmod("quota", "n_blocks") * F.col("shard_size") / F.col("n_blocks")).alias("_once_more"),
    )
    shards = written(shards, new_path(spark, "mix-shards"))

    so_far = Window.partitionBy("ordinal", "shard").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.withColumn("_end", F.sum("size").over(so_far)).join(shards, ["ordinal", "shard"], "left")
    again = F.least(F.col("size"), F.greatest(F.col("_once_more") - (F.col("_end") - F.col("size")), F.lit(0)))
    return Mix(quotas, laid.withColumn("_again", again))


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document: its id, ``size``, ``source_size``, ``target`` (of its source), ``taken``."""
    mix = _mix(docs, id, text, source, weights, share, most, seed, block_words, shard_words)
    taken = F.coalesce(F.col("_times") * F.col("size") + F.col("_again"), F.lit(0)).cast("bigint")
    return mix.laid.select(F.col("_id").alias(id), "size", "source_size", "target", taken.alias("taken"))


def mixture(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The rows of the mix with all their columns: a document as often as the mix takes its words, to the nearest
    whole number. Documents are not cut: a shard's one partly taken document goes in or not.

    The documents that a shard takes once more are the first ones in its order, so one place in that order per shard tells
    them, and the texts are not shuffled.
    """
    spark = docs.sparkSession
    mix = _mix(docs, id, text, source, weights, share, most, seed, block_words, shard_words)
    once_more = F.when((F.col("size") > 0) & (F.col("_again") * 2 >= F.col("size")), F.col("_order"))
    cuts = mix.laid.groupBy(F.col("ordinal").alias("_ordinal"), F.col("shard").alias("_shard")).agg(
        F.max("_times").cast("int").alias("_times"), F.max(once_more).alias("_cut")
    )
    cuts = written(cuts.filter("_times > 0 or _cut is not null"), new_path(spark, "mix-cuts"))
    if cuts.count() <= BROADCAST_SHARDS:
        cuts = F.broadcast(cuts)
    sources = mix.quotas.select(F.col("source").alias("_source"), F.col("ordinal").alias("_ordinal_of"), "n_shards")
    # The input's columns travel as one, whatever their names are.
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    found = docs.filter(filled(F.col(f"`{text}`")).rlike(WORD)).select(row, F.col(f"`{source}`").alias("own_source"), _hash(id, text, seed).alias("_hash"))
    found = found.join(sources.withColumnRenamed("n_shards", "_n_shards"), F.col("own_source").eqNullSafe(F.col("_source")))
    found = found.join(cuts, (F.col("_ordinal_of") == F.col("_ordinal")) & (_shard(F.col("_n_shards")) == F.col("_shard")))
    times = F.col("_times") + F.coalesce((_order() <= F.col("_cut")).cast("int"), F.lit(0))
    taken = found.filter(times > 0).select("row", F.explode(F.sequence(F.lit(1), times)).alias("_copy"))
    return taken.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
