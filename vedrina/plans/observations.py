"""Observations and messages derived from the check tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A check table. Its schema is looked up in the files once; they are never rewritten."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream. The pattern matches the one path whether it is a file or a folder; a
    file stream takes no single file as its path."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and region, as cities with country and region."""
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.col("c_name").alias("grad"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("drzava"),
            F.col("c_acctbal").alias("osecaj"),
        )
    )


def observations(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events as observations of the city that sent them; ``event_id`` is the order of arrival."""
    events = table(spark, sf_dir, "events") if events is None else events
    return events.join(cities(spark, sf_dir), F.col("user_id") == F.col("c_custkey")).select(
        "event_id",
        "grad",
        "region",
        "drzava",
        F.col("value").alias("temperatura"),
        "osecaj",
        F.get_json_object("props", "$.k").cast("int").alias("vlaznost"),
        F.col("event_type").alias("stanje"),
        F.col("ts").alias("lokalno_vreme"),
        F.to_date("ts").alias("datum"),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations of a stored table: the supplier observes a price per ship date."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("datum"),
        F.col("l_returnflag").alias("drzava"),
        F.col("l_suppkey").cast("string").alias("grad"),
        F.col("l_extendedprice").alias("temperatura"),
        F.col("l_linestatus").alias("stanje"),
        F.col("l_shipdate").alias("lokalno_vreme"),
    )


def envelope(rows: DataFrame, text: Column) -> DataFrame:
    """Rows as messages of a log; the event gives the offset and its time the timestamp."""
    return rows.select(
        text.cast("binary").alias("value"),
        F.lit("observations").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("lokalno_vreme").alias("timestamp"),
        "stanje",
    )


def flat_text() -> Column:
    """An observation as a flat message."""
    return F.to_json(
        F.struct(
            "grad",
            "region",
            "drzava",
            "temperatura",
            "osecaj",
            "vlaznost",
            "stanje",
            F.col("lokalno_vreme").cast("string").alias("lokalno_vreme"),
            F.col("datum").cast("string").alias("datum"),
        )
    )


def nested_text() -> Column:
    """An observation as a nested message."""
    location = F.struct(
        F.col("grad").alias("name"),
        F.col("region").alias("region"),
        F.col("drzava").alias("country"),
        F.col("lokalno_vreme").cast("string").alias("localtime"),
    )
    current = F.struct(
        F.col("temperatura").alias("temp_c"),
        F.col("osecaj").alias("feelslike_c"),
        F.col("vlaznost").alias("humidity"),
        F.struct(F.col("stanje").alias("text")).alias("condition"),
    )
    return F.to_json(F.struct(location.alias("location"), current.alias("current")))
