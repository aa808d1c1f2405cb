"""Partitioned files, as in the landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vedrina.sources.files import TIME_PATTERN


def rebalanced(rows: DataFrame, by: str) -> DataFrame:
    """Rows brought together by a column, for partitioned writes: adaptive execution joins small
    groups in one task and splits a group that holds much of the rows. Without adaptive execution a
    hot group would end in one task, so the rows then stay where they are."""
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")
    return rows.hint("rebalance", by) if adaptive.lower() == "true" else rows


def write_partitioned(
    rows: DataFrame,
    path: str,
    partition_by: str,
    file_format: str,
    max_rows_per_file: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write one directory per value of ``partition_by``, without a small file per task in each."""
    writer = rebalanced(rows, partition_by).write.mode(mode).partitionBy(partition_by)
    # Overwriting replaces the whole path, whatever the session's default for partitions is.
    writer = writer.option("partitionOverwriteMode", "static")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if file_format == "json":
        writer = writer.options(**TIME_PATTERN)
    writer.format(file_format).save(path)


def write_landing(
    records: DataFrame, path: str, partition_by: str = "datum", file_format: str = "json", mode: str = "append"
) -> None:
    """Put records into the landing zone."""
    write_partitioned(records, path, partition_by, file_format, mode=mode)
