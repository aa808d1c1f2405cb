"""Where jobs keep intermediate tables, so that they outlive a lost executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Of the files that a job writes more than once, row by row; it halves digests in hexadecimal, which snappy leaves as they are.
STORED_CODEC = "zstd"


# Temporary folders of local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A local session that names none (as in tests) gets a temporary folder. On a cluster such a folder
    would exist on one machine only, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="vedrina-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/vedrina/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, codec: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: cuts the lineage, and the planner then knows the
    real size of the table when it chooses between a broadcast and a shuffle join. ``codec`` is that of the
    files, by default the session's; ``options`` are others of the write."""
    df.write.mode("overwrite").options(**options).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Files of rows that may have megabytes each: the writer looks at the sizes of pages and row groups after each row, not only after
# a hundred, and ends a row group at 16 MB, which is what a reader holds.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}

# Bytes of a batch that goes to Python, and rows that a reader of files takes at once.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20, "spark.sql.parquet.columnarReaderBatchSize": 16}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Small batches for what runs meanwhile on rows that may have megabytes each, which the default limits (64 MB, 4096 rows) would gather,
    several times over, in the memory of both the JVM and Python. A lower setting of the session stays."""
    before = {name: spark.conf.get(name) for name in BATCH_LIMITS}
    for name, most in BATCH_LIMITS.items():
        if _in_bytes(before[name]) > most:
            spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _in_bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


SPLIT_SETTING, SPLIT_MB = "spark.sql.files.maxPartitionBytes", 32


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Tasks that read at most 32 MB of files each, for what runs meanwhile: well packed files hold so many rows that a task
    which sorts them would spill. A lower setting of the session stays."""
    before = spark.conf.get(SPLIT_SETTING)
    if _in_bytes(before) <= SPLIT_MB * 1024**2:
        yield
        return
    spark.conf.set(SPLIT_SETTING, f"{SPLIT_MB}m")
    try:
        yield
    finally:
        spark.conf.set(SPLIT_SETTING, before)


def read_if_exists(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame | None:
    """A parquet table, or None while nothing has been written to ``path``."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
