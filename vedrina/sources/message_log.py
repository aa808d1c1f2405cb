"""Message-log topics as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns a message-log stream has, and the order in which its messages arrived.
ENVELOPE = "value binary, topic string, partition int, offset bigint, timestamp timestamp"
ARRIVAL = ["timestamp", "partition", "offset"]


def log_options(
    servers: str,
    topic: str,
    starting: str | None = None,
    group: str | None = None,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Connector options.

    ``starting`` is ``earliest`` or ``latest``; left out, the connector starts at the latest offset.
    ``max_per_batch`` bounds one micro-batch, so that a first run over a long topic goes in steps.
    ``min_partitions`` splits busy topic partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.group.id": group,
        "maxOffsetsPerTrigger": max_per_batch,
        "minPartitions": min_partitions,
        **(extra or {}),
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def read_log(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """A topic as a stream; ``settings`` as in ``log_options``. Needs Spark's Kafka connector."""
    return spark.readStream.format("kafka").options(**log_options(servers, topic, **settings)).load()
