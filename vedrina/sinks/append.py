"""Appending micro-batches so that a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.sinks.compaction import fresh_rows, is_packed, packed_rows, packed_state
from vedrina.sinks.jdbc import write_table
from vedrina.sinks.landing import write_partitioned


def append_batch(
    rows: DataFrame,
    table: str,
    stream_id: str,
    batch_id: int,
    partition_by: str = "datum",
    max_rows_per_file: int | None = None,
) -> None:
    """Store a micro-batch in a directory of its own; repeating the batch replaces that directory.

    ``stream_id`` belongs to the checkpoint, so a stream started over, whose batches count from 0
    again, does not touch what an earlier one stored. A batch that is in a pack (``sinks.compaction``) is stored already.
    """
    if is_packed(rows.sparkSession, table, stream_id, batch_id):
        return
    path = f"{table}/stream={stream_id}/batch_id={batch_id}"
    write_partitioned(rows, path, partition_by, "parquet", max_rows_per_file)


def read_appended(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows of an appended table, packed or not, in the columns of ``schema``."""
    state = packed_state(spark, table)
    fresh = fresh_rows(spark, table, schema, state).drop("stream", "batch_id")
    if not state.packs:
        return fresh
    return packed_rows(spark, table, schema, state.paths(table)).unionByName(fresh)


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    stream_id: str,
    batch_id: int,
    execute: Callable[[str], None],
    properties: dict[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Append a micro-batch to a database table that has the columns ``stream_id`` and ``batch_id``
    besides those of the rows. ``execute`` runs a statement on the caller's connection: a repeated
    batch first removes what it had appended before."""
    execute(f"DELETE FROM {table} WHERE stream_id = '{stream_id}' AND batch_id = {batch_id}")
    numbered = rows.withColumns(
        {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    write_table(numbered, url, table, "append", properties, connections)
