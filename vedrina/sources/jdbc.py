"""Database tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def range_options(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    """Options for a read split into equal ranges of a date, time or number column. The bounds only
    place the splits: rows outside them, and rows with null, are read as well."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def bucket_predicates(expression: str, partitions: int) -> list[str]:
    """Predicates that split a table into buckets of a whole-number SQL expression.

    For tables where one date holds much of the rows: a range split would read it in one task. Use
    a hash of the key columns in the database's own dialect as the expression. Every row falls under
    exactly one predicate; null goes to the first.
    """
    bucket = f"abs(mod({expression}, {partitions}))"
    return [f"({bucket} = 0 OR ({expression}) IS NULL)"] + [f"{bucket} = {n}" for n in range(1, partitions)]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: dict[str, str] | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A database table, read in parallel by ``split`` (see ``range_options``) or by ``predicates``
    (see ``bucket_predicates``). Filters such as an IN list are pushed into the database."""
    properties = {"fetchsize": "10000", **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    options = {"url": url, "dbtable": table, **properties, **(split or {})}
    return spark.read.format("jdbc").options(**options).load()
