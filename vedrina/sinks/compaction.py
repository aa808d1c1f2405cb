"""Packing the many small files of an appended table into few large ones.

``sinks.append`` gives every batch a directory. ``compact`` puts the finished batches into a pack: a directory of the table
in which each date has files of about a wanted size. A log beside the packs says which packs count and up to which batch
each stream is in them, so readers (``sinks.append.read_appended``) see every row once at any moment, and a batch that is
repeated after it was packed is known and not stored again.

Packs have levels. Once a level would have ``fanout`` packs they are packed anew into one of the next level, in the run that
would have added the last of them. So a row is rewritten about log(batches) times, and the number of packs stays small.

A run that ends before its log entry is written leaves the table as it was; the next one writes the pack anew. What a run
replaces stays until the next run, for readers that began before. One run at a time may compact a table, while its streams go on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vedrina.shared import read_if_exists

# Spark skips names that begin with an underscore when it lists a table.
PACKS, LOG = "_packs", "_packs_log"
LOG_ROWS = "stream string, batch_id bigint, pack int, level int, version int"
TARGET_BYTES = 256 << 20
FANOUT = 8


@dataclass
class Packed:
    """The state of a table's packs: the version of the log, the levels of the packs that count, and the last
    packed batch of each stream."""

    version: int = 0
    packs: dict[int, int] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def paths(self, table: str) -> list[str]:
        return [f"{table}/{PACKS}/pack={pack}" for pack in sorted(self.packs)]


def packed_state(spark: SparkSession, table: str) -> Packed:
    """What the log says. It has a row per stream and per pack, so it is small."""
    log = read_if_exists(spark, f"{table}/{LOG}", LOG_ROWS)
    rows = [] if log is None else log.collect()
    version = max((row.version for row in rows), default=0)
    rows = [row for row in rows if row.version == version]
    return Packed(
        version,
        {row.pack: row.level for row in rows if row.pack is not None},
        {row.stream: row.batch_id for row in rows if row.stream is not None},
    )


def is_packed(spark: SparkSession, table: str, stream_id: str, batch_id: int) -> bool:
    """Whether a batch is in a pack, so that its directory no longer counts."""
    return batch_id <= packed_state(spark, table).streams.get(stream_id, -1)


def fresh_rows(spark: SparkSession, table: str, schema: str, state: Packed) -> DataFrame:
    """The rows of batches that are in no pack, with ``stream`` and ``batch_id``."""
    stored = spark.read.schema(f"{schema}, stream string, batch_id bigint").parquet(table)
    for stream, batch_id in state.streams.items():
        # A test of partition columns alone: the directories are not opened.
        stored = stored.filter((F.col("stream") != stream) | (F.col("batch_id") > batch_id))
    return stored


def packed_rows(spark: SparkSession, table: str, schema: str, paths: list[str]) -> DataFrame:
    """The rows of some packs."""
    return spark.read.schema(f"{schema}, pack int").option("basePath", f"{table}/{PACKS}").parquet(*paths).drop("pack")


def compact(
    spark: SparkSession,
    table: str,
    schema: str,
    partition_by: str = "datum",
    target_bytes: int = TARGET_BYTES,
    fanout: int = FANOUT,
    ended: bool = False,
) -> bool:
    """Pack the batches that are in no pack yet; returns False if there are none.

    A stream's last batch may still be written, so it is left out unless all streams have ``ended``.
    """
    state = packed_state(spark, table)
    remove_replaced(spark, table, state)
    fresh = fresh_rows(spark, table, schema, state)
    last = {row.stream: row.last for row in fresh.groupBy("stream").agg(F.max("batch_id").alias("last")).collect()}
    upto = {stream: batch_id if ended else batch_id - 1 for stream, batch_id in last.items()}
    taken = F.lit(False)
    for stream, batch_id in upto.items():
        taken = taken | ((F.col("stream") == stream) & (F.col("batch_id") <= batch_id))
    fresh = fresh.filter(taken)
    if fresh.isEmpty():
        return False

    level, replaced = 0, []
    while len(peers := [pack for pack, own in state.packs.items() if own == level]) + 1 >= fanout:
        replaced += peers
        level += 1
    pack = max(state.packs, default=0) + 1
    sources = [_with_file(fresh, schema)]
    if replaced:
        paths = [f"{table}/{PACKS}/pack={pack}" for pack in replaced]
        sources.append(_with_file(packed_rows(spark, table, schema, paths), schema))
    rows = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    binned(rows, partition_by, target_bytes).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        partition_by
    ).parquet(f"{table}/{PACKS}/pack={pack}")

    packs = {old: own for old, own in state.packs.items() if old not in replaced} | {pack: level}
    # An older batch may have had no rows left to take.
    streams = state.streams | {stream: max(batch_id, state.streams.get(stream, -1)) for stream, batch_id in upto.items()}
    _write_log(spark, table, Packed(state.version + 1, packs, streams))
    return True


_FILE, _BYTES, _BIN = "_file", "_bytes", "_bin"


def _with_file(rows: DataFrame, schema: str) -> DataFrame:
    names = [name for name in rows.columns if name not in ("stream", "batch_id")]
    return rows.select(*names, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_size").alias(_BYTES))


def bins(rows: DataFrame, partition_by: str, target_bytes: int) -> DataFrame:
    """The bin of each file: the files of a date one after the other, a new bin at every ``target_bytes``.

    Reads no column of the table. The window runs over a date's files, not over its rows.
    """
    files = rows.groupBy(partition_by, _FILE).agg(F.max(_BYTES).alias(_BYTES))
    before = Window.partitionBy(partition_by).orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    return files.select(
        F.col(_FILE).alias("_binned"), F.floor(F.coalesce(F.sum(_BYTES).over(before), F.lit(0)) / target_bytes).alias(_BIN)
    )


def binned(rows: DataFrame, partition_by: str, target_bytes: int) -> DataFrame:
    """Rows brought together by date and bin, so that a bin becomes a file, and a hot date many."""
    # Two dates' rows never share a file, so the file alone names the bin; the planner knows no size here and
    # adaptive execution broadcasts the list of files where it is small.
    found = rows.join(bins(rows, partition_by, target_bytes), F.col(_FILE) == F.col("_binned"))
    return found.repartition(partition_by, _BIN).drop(_FILE, _BYTES, _BIN, "_binned")


def _write_log(spark: SparkSession, table: str, state: Packed) -> None:
    rows = [(stream, batch_id, None, None) for stream, batch_id in state.streams.items()]
    rows += [(None, None, pack, level) for pack, level in state.packs.items()]
    log = spark.createDataFrame(rows, "stream string, batch_id bigint, pack int, level int")
    # One file: it is there in full or not at all.
    log.coalesce(1).write.mode("overwrite").parquet(f"{table}/{LOG}/version={state.version}")


def remove_replaced(spark: SparkSession, table: str, state: Packed) -> None:
    """Remove the directories that the state no longer counts: packed batches, replaced packs, earlier log entries."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(table)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbered(folder: str, prefix: str) -> dict[int, object]:
        at = path(folder)
        if not store.exists(at):
            return {}
        names = {entry.getPath().getName(): entry.getPath() for entry in store.listStatus(at)}
        return {int(name.removeprefix(prefix)): own for name, own in names.items() if name.startswith(prefix)}

    for stream, last in state.streams.items():
        for batch_id, own in numbered(f"{table}/stream={stream}", "batch_id=").items():
            if batch_id <= last:
                store.delete(own, True)
    for pack, own in numbered(f"{table}/{PACKS}", "pack=").items():
        if pack not in state.packs:
            store.delete(own, True)
    for version, own in numbered(f"{table}/{LOG}", "version=").items():
        if version < state.version:
            store.delete(own, True)
