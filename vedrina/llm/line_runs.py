"""Lines that many documents share, found with levelled sorted runs of line hashes, and dropped.

``LineRuns`` is a log-structured table of line keys in the shared folder. A run is a table of (``key``, ``documents``): the hash of a
line and in how many documents it was, written in buckets of the hash and sorted in each, so that runs are merged and joined
bucket by bucket without being shuffled again.

1. A batch of documents is counted: each document counts once for each of its keys.
2. The batch is merge-anti-joined with the runs' keys that have reached the threshold: nothing more need be known of those,
   so a line in a third of all documents is written once per run at most. The rest of the batch is a new run of level 0.
3. When a level has ``fanout`` runs they are merged into one of the next level, so a key is in few runs, and a batch
   meets a number of runs that grows with the logarithm of the number of batches.

At the end the counts of all runs are added up; keys at the threshold are common. Lines of common keys are dropped from
every document, also from those of earlier batches. Texts are taken apart once, and shuffled once to meet the marks of their
lines; everything else is hashes, and equal texts share their marks.

Defined results: a text is split at \\n; a null or empty text is one empty line. A line's key is the line without spaces and
\\t \\n \\v \\f \\r at both ends, with A-Z lowered. Keys shorter than ``least_chars`` code points are never dropped. Rows are documents of
their own, also where they repeat an id or have none. Other columns stay, whatever their names. An empty table gives an empty
result. Hashes have 128 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.llm.batches import parts
from vedrina.llm.text import filled
from vedrina.shared import new_path, shared_folder, written

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
# Runs of a level that are merged into one of the next.
FANOUT = 2
# Batches of a table that is taken apart for the runs.
BATCHES = 8


def keyed_lines(docs: DataFrame, text: str = "text", least_chars: int = LEAST_CHARS, batches: int = 1) -> DataFrame:
    """A row per line: ``batch`` (these take the documents in turn), ``text_key`` (the hash of the text), ``place``, ``key`` (null
    if too short), and ``first``: no line before in the document has the key. Written."""

    def keyed(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in parts(tables, 1):
            own_batch, text_keys, places, keys, first = [], [], [], [], []
            for batch, text in zip(table.column(0).to_pylist(), table.column(1)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                found = [_key(line, least_chars) for line in data.lower().split(b"\n")]
                own_batch.extend([batch] * len(found))
                text_keys.extend([hashlib.md5(data).digest()] * len(found))
                places.extend(range(len(found)))
                keys.extend(found)
                seen: set[bytes | None] = {None}
                # Adding to a set says nothing; a key is new if the set grows.
                first.extend(len(seen) < (seen.add(key) or len(seen)) for key in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own_batch, pa.int32()), pa.array(text_keys, pa.binary()), pa.array(places, pa.int32()), pa.array(keys, pa.binary()), pa.array(first, pa.bool_())],
                ["batch", "text_key", "place", "key", "first"],
            )

    numbered = docs.select(F.pmod(F.monotonically_increasing_id(), F.lit(batches)).cast("int").alias("batch"), F.col(text).alias("text"))
    rows = numbered.mapInArrow(keyed, "batch int, text_key binary, place int, key binary, first boolean")
    return written(rows, new_path(docs.sparkSession, "line-keys"))


def _key(line: bytes, least_chars: int) -> bytes | None:
    """The hash of a line whose A-Z are lowered (bytes are lowered in ASCII only, and stripped of the six blanks)."""
    key = line.strip()
    # A code point has a byte at least, so few need to be counted.
    if len(key) < least_chars or (least_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < least_chars):
        return None
    return hashlib.md5(key).digest()


class LineRuns:
    """The runs of a corpus that comes in batches."""

    def __init__(self, spark: SparkSession, least_documents: int = LEAST_DOCUMENTS, fanout: int = FANOUT, buckets: int | None = None):
        """``buckets`` is the number of sorted parts of a run, the session's number of shuffle partitions if not given."""
        self.spark, self.least_documents, self.fanout = spark, least_documents, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The tables' names of the runs, by level.
        self.levels: list[list[str]] = []

    def _written(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{shared_folder(self.spark)}/vedrina/{name}"
        counts.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, counts: DataFrame) -> None:
        """Add a batch, given as (``key``, ``documents``) with every key once."""
        for run in self.runs():
            known = run.filter(F.col("documents") >= self.least_documents).select("key")
            counts = counts.join(known.hint("merge"), "key", "left_anti")
        # Dealt by the buckets' hash, so that a bucket is one file.
        self._place(0, self._written(counts.repartition(self.buckets, "key")))

    def _place(self, level: int, name: str) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self._written(self._merged(self.levels[level]))
            self._dropped(self.levels[level])
            self.levels[level] = []
            self._place(level + 1, merged)

    def _merged(self, names: list[str]) -> DataFrame:
        """The keys of several runs, each with its counts added up. Two runs are merged bucket by bucket where they lie."""
        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnRenamed("documents", "more")
            added = F.coalesce("documents", F.lit(0)) + F.coalesce("more", F.lit(0))
            return a.hint("merge").join(b, "key", "full").select("key", added.alias("documents"))

        return reduce(both, [self.spark.table(name) for name in names])

    def _dropped(self, names: list[str]) -> None:
        # The files stay: a run of the next level may still have to be made anew from them.
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def common(self) -> DataFrame:
        """The keys that are in at least ``least_documents`` documents, written."""
        names = [name for level in self.levels for name in level]
        if not names:
            return self.spark.createDataFrame([], "key binary")
        keys = self._merged(names).filter(F.col("documents") >= self.least_documents).select("key")
        return written(keys, new_path(self.spark, "line-common"))

    def close(self) -> None:
        """Take the runs out of the session's catalog."""
        for level in self.levels:
            self._dropped(level)
        self.levels = []


def document_counts(lines: DataFrame) -> DataFrame:
    """In how many ``documents`` of a ``batch`` each ``key`` of ``keyed_lines`` is."""
    return lines.filter("first and key is not null").groupBy("batch", "key").agg(F.count("*").alias("documents"))


def common_lines(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS, fanout: int = FANOUT, batches: int = 1) -> DataFrame:
    """The keys to drop of ``keyed_lines``, whose batches go through ``LineRuns``."""
    spark = lines.sparkSession
    path = new_path(spark, "line-batches")
    document_counts(lines).write.partitionBy("batch").parquet(path)
    counts = spark.read.schema("key binary, documents bigint, batch int").parquet(path)
    runs = LineRuns(spark, least_documents, fanout)
    for batch in range(batches):
        runs.add(counts.filter(F.col("batch") == batch).select("key", "documents"))
    keys = runs.common()
    runs.close()
    return keys


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(filled(text)))


def marks(lines: DataFrame, common: DataFrame) -> DataFrame:
    """Of each different text (``text_key``) that has common lines, which of its lines they are: ``dropped``, an array of
    booleans. Written."""
    spark = lines.sparkSession
    # Lines that are never dropped have no key in common, so they lie over all tasks.
    key = F.coalesce("key", F.concat(F.lit("-").cast("binary"), F.col("text_key")))
    placed = lines.select("text_key", "place", key.alias("key")).distinct()
    placed = written(placed, new_path(spark, "line-places"))
    known = common.select("key", F.lit(True).alias("common"))
    joined = placed.join(known, "key", "left").select("text_key", F.struct("place", F.col("common").isNotNull().alias("common")).alias("line"))
    flags = joined.groupBy("text_key").agg(F.array_sort(F.collect_list("line")).alias("line"))
    dropped = flags.select("text_key", F.col("line.common").alias("dropped")).filter(F.exists("dropped", lambda flag: flag))
    return written(dropped, new_path(spark, "line-marks"))


def without_marked_lines(
    docs: DataFrame, marked: DataFrame, text: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped"
) -> DataFrame:
    """``docs`` without the lines that ``marks`` found in ``text``, and two more columns: the numbers of lines before, and of
    dropped lines. These columns replace ones of their names."""
    # The input's columns travel as one, whatever their names are.
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), _text_key(text).alias("own_key"), filled(text).alias("whole"))
    joined = rows.join(marked, F.col("own_key") == F.col("text_key"), "left")
    kept = F.zip_with(F.split("whole", "\n", -1), "dropped", lambda line, dropped: F.when(~dropped, line))
    left = F.when(F.col("dropped").isNull(), F.col("whole")).otherwise(F.array_join(kept, "\n"))
    n_all = (F.length("whole") - F.length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    gone = F.coalesce(F.size(F.filter("dropped", lambda flag: flag)), F.lit(0)).cast("bigint")
    new = {text: left, n_lines: n_all, n_dropped: F.when(F.col("dropped").isNull(), F.lit(0).cast("bigint")).otherwise(gone)}
    others = [name for name in docs.columns if name not in (n_lines, n_dropped)]
    return joined.select(
        *[new[name].alias(name) if name == text else F.col("row").getField(name).alias(name) for name in others],
        *[new[name].alias(name) for name in (n_lines, n_dropped)],
    )


def deduplicated(
    docs: DataFrame, text: str = "text", least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS, batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` without the lines that at least ``least_documents`` of them have, with ``n_lines`` and ``n_dropped``."""
    lines = keyed_lines(docs, text, least_chars, batches)
    return without_marked_lines(docs, marks(lines, common_lines(lines, least_documents, fanout, batches)), text)
