"""The append, upsert and specified-ingestion streams."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vedrina.operators.parsing import PROBLEMS, RAW, READABLE, accepted, rejected, without_key
from vedrina.schemas import FLAT_MESSAGE, OBSERVATION_KEYS, OBSERVATIONS
from vedrina.sinks.append import append_batch, append_jdbc
from vedrina.sinks.jdbc import upsert_table
from vedrina.sinks.merge import upsert
from vedrina.sinks.versions import upsert_files
from vedrina.sources.ingestion_spec import DAY, IngestionSpec, parse_specified
from vedrina.sources.message_log import ARRIVAL
from vedrina.streaming.run import run_stream


def append_stream(
    parsed: DataFrame, table: str, checkpoint: str, quarantine: str | None, counts: str | None = None, **settings
) -> StreamingQuery:
    """Append parsed messages (``operators.parsing``) to the parquet table at ``table``.

    Messages with problems go to ``quarantine``; unreadable ones are not appended to the table, so
    with None for ``quarantine`` they are given up. ``counts`` is a place for the numbers of each batch (``read_counts``),
    which come with the pass that writes the quarantine. ``settings`` go to ``run_stream``.
    """

    def store(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        append_batch(accepted(batch), table, stream_id, batch_id)

    return run_stream(parsed, _with_quarantine(store, quarantine, counts=counts), checkpoint, **settings)


def append_stream_jdbc(
    parsed: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    quarantine: str | None,
    execute: Callable[[str], None],
    properties: dict[str, str] | None = None,
    **settings,
) -> StreamingQuery:
    """Append parsed messages to a database table (``sinks.append.append_jdbc``)."""

    def store(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        append_jdbc(accepted(batch), url, table, stream_id, batch_id, execute, properties)

    return run_stream(parsed, _with_quarantine(store, quarantine), checkpoint, **settings)


def upsert_stream(
    parsed: DataFrame,
    table: str,
    checkpoint: str,
    quarantine: str,
    by_event_time: bool = False,
    counts: str | None = None,
    by_file: bool = False,
    **settings,
) -> StreamingQuery:
    """Upsert parsed messages into the parquet table at ``table`` by city and date.

    The message that arrived last counts or, ``by_event_time``, the one with the latest local time,
    whichever batch it came in. ``parsed`` must carry the arrival columns (``keep`` of the parser).
    Messages with problems, and those without city or date, go to ``quarantine``, their numbers to ``counts``. The state of
    the upsert is kept with the checkpoint. ``by_file`` makes it a table of versions (``sinks.versions``), read by
    ``read_version``: a batch rewrites the files of its keys only, and readers see it in full or not at all.
    """
    time = ["lokalno_vreme"] if by_event_time else []

    def store(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        state = f"{checkpoint}/upsert/{stream_id}"
        rows, order = accepted(batch), [*time, *ARRIVAL]
        if by_file:
            upsert_files(rows, table, OBSERVATIONS, OBSERVATION_KEYS, "datum", order, batch_id, time, stream_id=stream_id)
            return
        upsert(rows, table, OBSERVATIONS, OBSERVATION_KEYS, "datum", order, state, batch_id, time)

    settings = {"output_mode": "update", **settings}
    return run_stream(parsed, _with_quarantine(store, quarantine, OBSERVATION_KEYS, counts), checkpoint, **settings)


def upsert_stream_jdbc(
    parsed: DataFrame,
    url: str,
    table: str,
    staging: str,
    checkpoint: str,
    quarantine: str,
    execute: Callable[[str], None],
    properties: dict[str, str] | None = None,
    **settings,
) -> StreamingQuery:
    """Upsert parsed messages into a database table by city and date (``sinks.jdbc.upsert_table``);
    otherwise as ``upsert_stream``. The message that arrived last counts."""
    columns = [name for _, name, _ in FLAT_MESSAGE]

    def store(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        rows = accepted(batch)
        upsert_table(rows, url, table, staging, OBSERVATION_KEYS, ARRIVAL, execute, columns, properties)

    settings = {"output_mode": "update", **settings}
    return run_stream(parsed, _with_quarantine(store, quarantine, OBSERVATION_KEYS), checkpoint, **settings)


def ingest(
    messages: DataFrame,
    spec: IngestionSpec,
    table: str,
    checkpoint: str,
    quarantine: str | None,
    **settings,
) -> StreamingQuery:
    """Ingest messages as a specification asks, one directory per day; rows whose time cannot be
    read go to ``quarantine`` only."""

    def store(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        rows = accepted(batch).filter(f"`{spec.time_column}` is not null")
        append_batch(rows, table, stream_id, batch_id, DAY, spec.max_rows_per_file)

    parsed = parse_specified(messages, spec)
    return run_stream(parsed, _with_quarantine(store, quarantine), checkpoint, **settings)


COUNTS = "messages bigint, accepted bigint, misfits bigint, unreadable bigint, keyless bigint"


def _with_quarantine(
    store: Callable[[DataFrame, str, int], None], quarantine: str | None, keys: list[str] | None = None, counts: str | None = None
) -> Callable[[DataFrame, str, int], None]:
    """Store a batch and, if a place is given, the messages with problems or without a key, and the batch's numbers.

    The batch is then read twice, so it is pinned meanwhile. The numbers are observed in the second reading, which
    is whole whenever a batch is done, and repeated with it.
    """
    if quarantine is None:
        if counts:
            raise ValueError("the numbers come with the quarantine")
        return store

    def store_both(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        batch.persist()
        try:
            store(batch, stream_id, batch_id)
            place = f"stream={stream_id}/batch_id={batch_id}"
            observation = Observation()
            seen = batch.observe(observation, *_numbers(keys or [])) if counts else batch
            aside = rejected(seen).select(PROBLEMS, RAW)
            if keys:
                aside = without_key(batch, keys).unionByName(aside)
            aside.write.mode("overwrite").parquet(f"{quarantine}/{place}")
            if counts:
                row = batch.sparkSession.createDataFrame([observation.get], COUNTS)
                row.coalesce(1).write.mode("overwrite").parquet(f"{counts}/{place}")
        finally:
            batch.unpersist()

    return store_both


def _numbers(keys: list[str]) -> list[Column]:
    """All messages; those stored; of these those with misfit fields; those that cannot be read; and those
    without problems that lack a key."""
    readable, clean = F.col(READABLE), F.size(PROBLEMS) == 0
    complete = reduce(and_, [F.col(key).isNotNull() for key in keys], F.lit(True))
    return [
        F.count(F.lit(1)).alias("messages"), F.count_if(readable & complete).alias("accepted"),
        F.count_if(readable & complete & ~clean).alias("misfits"), F.count_if(~readable).alias("unreadable"),
        F.count_if(readable & clean & ~complete).alias("keyless"),
    ]


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    """The numbers of each batch, with ``stream`` and ``batch_id``."""
    return spark.read.schema(f"{COUNTS}, stream string, batch_id bigint").parquet(counts)
