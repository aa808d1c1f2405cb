"""Translation through a dictionary that is itself a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _entries(dictionary: DataFrame, word: str, meaning: str) -> DataFrame:
    entries = dictionary.select(F.col(word).alias("_word"), F.col(meaning).alias("_meaning"))
    return entries.filter(F.col("_word").isNotNull())


def check_dictionary(dictionary: DataFrame, word: str = "word", meaning: str = "meaning") -> None:
    """Raises an error if the dictionary holds a word more than once. It runs one aggregation, so a job calls it once
    and not for every translation."""
    repeated = _entries(dictionary, word, meaning).groupBy("_word").count().filter("count > 1").select("_word").take(1)
    if repeated:
        raise ValueError(f"the dictionary holds {repeated[0][0]!r} more than once")


def translate_with(
    df: DataFrame, column: str, dictionary: DataFrame, word: str = "word", meaning: str = "meaning"
) -> DataFrame:
    """Replace ``column`` by its meaning; values the dictionary lacks stay as they are.

    The dictionary must hold a word once (see ``check_dictionary``). No hint is given: Spark broadcasts the
    dictionary when it is small, and otherwise shuffles both plain inputs, the form in which adaptive
    execution splits the partition of a hot word.
    """
    joined = df.join(_entries(dictionary, word, meaning), F.col(column) == F.col("_word"), "left")
    return joined.withColumn(column, F.coalesce("_meaning", column)).drop("_word", "_meaning")
