"""City lists: consolidation, and enrichment with captured replies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.functions.text import fold, translate_words
from vedrina.operators.asof import asof_join
from vedrina.operators.latest import latest_per_key
from vedrina.operators.rows import extract_columns, with_values
from vedrina.schemas import COUNTRY_WORDS

CITY_LINE = r"^([^,]+),(.*)$"


def city_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``city,country`` lines to columns; for the other lines see ``other_lines``."""
    cities = extract_columns(lines, column, CITY_LINE, ["city", "country"])
    return cities.filter("city is not null").select(F.trim("city").alias("city"), F.trim("country").alias("country"))


def other_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that ``city_lines`` leaves out, null ones too, with all their columns."""
    return lines.filter(~F.coalesce(F.col(column).rlike(CITY_LINE), F.lit(False)))


def consolidate_cities(lists: list[DataFrame], countries: dict[str, str] = COUNTRY_WORDS) -> DataFrame:
    """One row per city of all lists, accents and country suffixes ignored.

    The most frequent spelling is kept, the smallest of equally frequent ones; ``listed`` counts the
    city's lines. Spellings are counted first, by a hash aggregate that shuffles each spelling once
    per task; only distinct spellings reach the second grouping.
    """
    every = reduce(DataFrame.unionByName, [cities.select("city", "country") for cities in lists])
    every = every.withColumn("country", translate_words(F.col("country"), countries))
    spellings = every.groupBy("city", "country").agg(F.count("*").alias("lines"))
    picks = spellings.groupBy(fold(F.col("city")).alias("city_key"), "country").agg(
        F.min(F.struct((-F.col("lines")).alias("rank"), "city")).alias("first"),
        F.sum("lines").alias("listed"),
    )
    return picks.select("city_key", "country", F.col("first.city").alias("city"), "listed")


def enrich_cities(
    cities: DataFrame,
    replies: DataFrame,
    keys: list[str],
    order: list[str | Column],
    values_path: str | None = None,
) -> DataFrame:
    """Every city with its latest captured reply; cities without one keep nulls.

    ``cities`` holds a city once. Replies are cut to one row per city before the join, so the join
    itself sees no repeated key on either side. ``values_path`` as in ``latest_per_key``.
    """
    latest = latest_per_key(with_values(replies, keys), keys, order, values_path=values_path)
    return cities.join(latest, keys, "left")


def enrich_as_of(
    observations: DataFrame, replies: DataFrame, keys: list[str], time: str, columns: list[str], order: list[str] | None = None
) -> DataFrame:
    """Every observation with ``columns`` of the reply that was the city's last one at its time (see ``operators.asof``)."""
    return asof_join(observations, replies, keys, time, columns, order)
