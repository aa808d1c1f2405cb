"""Messages delivered more than once, over batches and restarts."""

import datetime as dt

import pytest

from vedrina.streaming.redelivery import CONTENT, PLACE, without_redelivered
from vedrina.streaming.run import run_stream

LOG = "value binary, topic string, partition int, offset bigint, timestamp timestamp"


def message(text, offset, minute=0, topic="t", partition=0):
    return (text.encode(), topic, partition, offset, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute))


@pytest.fixture
def stream(spark, path):
    def run(by=CONTENT, within="1 day"):
        log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path("log"))

        def store(batch, stream_id, batch_id):
            batch.selectExpr("cast(value as string) as value", "topic", "offset").write.mode("overwrite").parquet(f"{path('out')}/b={batch_id}")

        run_stream(without_redelivered(log, within, by), store, path("checkpoint")).awaitTermination()
        return sorted(row.value for row in spark.read.parquet(path("out")).collect())

    def deliver(*messages):
        spark.createDataFrame(messages, LOG).coalesce(1).write.mode("append").parquet(path("log"))

    return run, deliver


def test_a_second_delivery_is_left_out(stream):
    run, deliver = stream
    deliver(message("a", 0), message("b", 1), message("a", 2))
    deliver(message("b", 3), message("c", 4, minute=10_000))
    assert run() == ["a", "b", "c"]
    # After a restart, and with a time far behind that of other messages: neither stored twice nor lost.
    deliver(message("a", 5), message("c", 6), message("late", 7, minute=-100_000))
    deliver(message("late", 8, minute=-100_000), message("a", 9, topic="other"))
    assert run() == ["a", "a", "b", "c", "late"]


def test_by_place(stream):
    run, deliver = stream
    deliver(message("a", 0), message("a", 1), message("b", 1, partition=1))
    deliver(message("a", 0), message("c", 2))
    assert run(PLACE) == ["a", "a", "b", "c"]


def test_columns_stay_and_other_words_are_refused(spark, path):
    spark.createDataFrame([message("a", 0)], LOG).write.parquet(path("log"))
    log = spark.readStream.schema(LOG).parquet(path("log"))
    assert without_redelivered(log, "1 hour").columns == log.columns
    with pytest.raises(ValueError, match="content or place"):
        without_redelivered(log, "1 hour", "luck")
