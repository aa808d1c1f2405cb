"""Keyed upsert that rewrites the files of its keys only, and readers that see a batch in full or not at all.

A table is a folder of data files and a log. An entry of the log lists the files that count and the last batch in them; writing it,
one small file, publishes a batch. An upsert finds the files that hold its keys by reading key columns alone, in the
dates of the batch, writes the rows of these files anew with the batch's, and lists the new files in their place. In each date
files hold ranges of the key, so a batch of few keys touches few files. Keys that are new to the table make files of their own,
so a table that mostly grows wants fewer and larger batches.

A run that ends before its entry is written leaves the table as it was. Files that no longer count stay for readers that
began before, and are removed by the next upsert. One writer at a time may upsert a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vedrina.operators.latest import latest_per_key
from vedrina.operators.rows import with_values
from vedrina.shared import new_path, read_if_exists, written
from vedrina.sinks.landing import rebalanced
from vedrina.sources.pickup import exact_path

DATA, LOG = "data", "log"
LOG_ROWS = "file string, stream string, batch_id bigint, version int"
ROWS_PER_FILE = 1_000_000


@dataclass
class Version:
    """The files that count, relative to the data folder, and the last batch of each stream in them."""

    number: int = 0
    files: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)


def last_version(spark: SparkSession, table: str) -> Version:
    """The last published entry of the log."""
    log = read_if_exists(spark, f"{table}/{LOG}", LOG_ROWS)
    number = None if log is None else log.agg(F.max("version")).first()[0]
    if number is None:
        return Version()
    rows = log.filter(F.col("version") == number).collect()
    files = sorted(row.file for row in rows if row.file is not None)
    return Version(number, files, {row.stream: row.batch_id for row in rows if row.stream is not None})


def read_version(spark: SparkSession, table: str, schema: str, version: Version | None = None, files: list[str] | None = None) -> DataFrame:
    """The rows of the table's last version, or of some of its files. The files are named to the reader, which lists no folder."""
    version = version or last_version(spark, table)
    files = version.files if files is None else files
    if not files:
        return spark.createDataFrame([], schema)
    paths = [exact_path(f"{table}/{DATA}/{file}") for file in files]
    stored = spark.read.schema(f"{schema}, run int").option("basePath", f"{table}/{DATA}").parquet(*paths)
    return stored.drop("run")


def _file() -> Column:
    """The file of a row, relative to the data folder, as a URI writes it."""
    return F.regexp_extract("_metadata.file_path", r"/(run=\d+/.*)$", 1).alias("_file")


def upsert_files(
    batch: DataFrame,
    table: str,
    schema: str,
    keys: list[str],
    partition_by: str,
    order: list[str | Column],
    batch_id: int | None = None,
    stored_order: list[str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    stream_id: str = "",
) -> bool:
    """Replace or insert the batch's rows by key, as ``sinks.merge.upsert`` does; returns False for a batch merged before. Batches
    count by stream: one that is started over begins at 0 again."""
    spark = batch.sparkSession
    now = last_version(spark, table)
    remove_unlisted(spark, table, now)
    done = now.batches.get(stream_id, -1)
    if batch_id is None:
        batch_id = done + 1
    elif batch_id <= done:
        return False
    columns = StructType.fromDDL(schema).names
    values = [name for name in columns if name not in keys]
    latest = latest_per_key(with_values(batch, keys), keys, order, values).select(*columns)
    latest = written(latest, new_path(spark, "upsert-batch"))

    touched = _touched_files(spark, table, schema, now, latest, keys, partition_by)
    merged = latest
    if touched:
        stored = read_version(spark, table, schema, now, touched).select(*columns)
        kept = stored.join(latest.select(*keys), keys, "left_anti").select(*columns)
        if stored_order:
            rivals = stored.join(latest.select(*keys), keys, "left_semi").select(*columns)
            rivals = rivals.withColumn("_new", F.lit(0)).unionByName(latest.withColumn("_new", F.lit(1)))
            latest = latest_per_key(rivals, keys, [*stored_order, "_new"], values).select(*columns)
        merged = kept.unionByName(latest)
    # Sorted by key, so that the files a task writes one after the other hold ranges of it.
    in_order = rebalanced(merged, partition_by).sortWithinPartitions(partition_by, *[key for key in keys if key != partition_by])
    path = f"{table}/{DATA}/run={now.number + 1}"
    writer = in_order.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(partition_by).parquet(path)
    made = spark.read.schema(f"{schema}, run int").option("basePath", f"{table}/{DATA}").parquet(path)
    new = [unquote(row[0]) for row in made.select(_file()).distinct().collect()]
    files = sorted({*now.files, *new}.difference(touched))
    _write_entry(spark, table, Version(now.number + 1, files, now.batches | {stream_id: batch_id}))
    return True


def _touched_files(
    spark: SparkSession, table: str, schema: str, now: Version, latest: DataFrame, keys: list[str], partition_by: str
) -> list[str]:
    """The files that hold a key of the batch. Of the dates in the batch key columns alone are read."""
    dates = {row["date"] for row in latest.select(F.col(partition_by).cast("string").alias("date")).distinct().collect()}
    candidates = [file for file in now.files if unquote(file.split(f"/{partition_by}=", 1)[-1].split("/", 1)[0]) in dates]
    if not candidates:
        return []
    stored = read_version(spark, table, schema, now, candidates).select(*keys, _file())
    found = stored.join(latest.select(*keys), keys, "left_semi").select("_file").distinct()
    return [unquote(row[0]) for row in found.collect()]


def _write_entry(spark: SparkSession, table: str, version: Version) -> None:
    rows = [(file, None, None) for file in version.files] + [(None, stream, batch_id) for stream, batch_id in version.batches.items()]
    # One file: it is there in full or not at all.
    log = spark.createDataFrame(rows, "file string, stream string, batch_id bigint").coalesce(1)
    log.write.mode("overwrite").parquet(f"{table}/{LOG}/version={version.number}")


def remove_unlisted(spark: SparkSession, table: str, version: Version) -> None:
    """Remove data files that the version does not list, and earlier entries of the log."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    data, log = path(f"{table}/{DATA}"), path(f"{table}/{LOG}")
    store = data.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(data):
        root, listed = store.makeQualified(data).toUri().getPath(), set(version.files)
        files = store.listFiles(data, True)
        while files.hasNext():
            own = files.next().getPath()
            name = own.toUri().getPath().removeprefix(root).lstrip("/")
            if name.endswith(".parquet") and name not in listed:
                store.delete(own, False)
    if store.exists(log):
        for entry in store.listStatus(log):
            name = entry.getPath().getName()
            if name.startswith("version=") and int(name.removeprefix("version=")) < version.number:
                store.delete(entry.getPath(), True)
