"""Cities that are listed under spellings one letter apart.

Two spellings differ by one letter (another one, one more, one less) if deleting a letter from each, or from the longer one only,
leaves the same text. So every spelling is filed under the texts that it leaves, a row per letter:

* spellings that leave the same text at the same place differ in that letter only. They all differ so from one another, and each
  is linked to one of them, not to all;
* a spelling that leaves a text which is a spelling itself has one letter more.

No pair is compared, and the rows grow with the letters of the distinct spellings. Chains of links make one city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vedrina.operators.cities import consolidate_cities
from vedrina.operators.components import connected_components
from vedrina.schemas import COUNTRY_WORDS
from vedrina.shared import new_path, written

# Short names one letter apart are seldom one city.
LEAST_CHARS = 5


def spelling_links(names: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Links ``a``, ``b`` between the ``node`` numbers of ``names`` (``city_key``, ``country``, each pair once): enough of them that
    all spellings of a country which are one letter apart are connected. Shorter spellings link nothing."""
    long = names.filter(F.length("city_key") >= least_chars).select("node", "country", "city_key")
    left = long.select("node", "country", "city_key", F.explode(F.sequence(F.lit(1), F.length("city_key"))).alias("place"))
    rest = F.concat(F.expr("substring(city_key, 1, place - 1)"), F.expr("substring(city_key, place + 1)"))
    left = left.select("node", "country", "place", rest.alias("rest"))
    alike = left.groupBy("country", "rest", "place").agg(F.min("node").alias("a"), F.collect_set("node").alias("nodes"))
    alike = alike.filter(F.size("nodes") > 1).select("a", F.explode("nodes").alias("b")).filter("a <> b")
    whole = long.select(F.col("node").alias("a"), F.col("country").alias("own_country"), F.col("city_key").alias("own_key"))
    same = (F.col("rest") == F.col("own_key")) & F.col("country").eqNullSafe(F.col("own_country"))
    longer = left.join(whole, same).select("a", F.col("node").alias("b"))
    return alike.unionByName(longer)


def consolidate_spellings(
    lists: list[DataFrame], countries: dict[str, str] = COUNTRY_WORDS, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """One row per city of all lists, accents, country suffixes and spellings one letter apart ignored.

    ``city`` is the spelling with the most lines, the smallest of equally frequent ones; ``listed`` counts the city's lines, and
    ``spellings`` how many there are without regard to accents. Null names are left out.
    """
    names = consolidate_cities(lists, countries).filter("city_key is not null")
    # Numbered as written, so that the numbers stay.
    spark = names.sparkSession
    names = written(names.withColumn("node", F.monotonically_increasing_id()), new_path(spark, "spellings"))
    components = connected_components(spelling_links(names, least_chars), "a", "b").withColumnRenamed("node", "linked")
    placed = names.join(components, F.col("node") == F.col("linked"), "left")
    groups = placed.groupBy("country", F.coalesce("component", "node").alias("group")).agg(
        F.min(F.struct((-F.col("listed")).alias("rank"), "city")).alias("first"), F.sum("listed").alias("listed"), F.count("*").alias("spellings")
    )
    return groups.select("country", F.col("first.city").alias("city"), "listed", "spellings")
