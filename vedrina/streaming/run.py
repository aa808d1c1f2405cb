"""Starting micro-batch queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# A scheduled run: work through what has arrived, in as many batches as the source bounds call for,
# and end.
SCHEDULED = {"availableNow": True}


def run_stream(
    rows: DataFrame,
    write_batch: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``write_batch(batch, stream_id, batch_id)``.

    ``stream_id`` is the query's id. It stays the same when the query restarts on its checkpoint,
    as do the numbers of its batches, so a sink can recognise a repeated batch.
    """
    spark = rows.sparkSession
    name = name or f"stream-{uuid.uuid4().hex}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stream_id = next(query.id for query in spark.streams.active if query.name == name)
        write_batch(batch, stream_id, batch_id)

    return (
        rows.writeStream.queryName(name)
        .foreachBatch(on_batch)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or SCHEDULED))
        .start()
    )
