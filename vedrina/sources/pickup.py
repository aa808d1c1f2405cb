"""Reading only the files that have come in since the last run.

A run's ledger lists the files it read: path, size and time of change. A file counts as new unless a finished run has it
with the same three, so a file that was replaced is read again. Names and sizes are listed by Spark, without opening the files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vedrina.shared import read_if_exists

FILE = ["path", "length", "modified"]
LEDGER = "path string, length bigint, modified timestamp, run bigint"


def listed_files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """The files under ``folder`` whose names match a pattern: path, length, time of change. None of them is opened, as the content
    is not asked for."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    return reader.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def new_files(spark: SparkSession, folder: str, ledger: str, last_run: int, names: str = "*") -> DataFrame:
    """The files that no run up to ``last_run`` has read as they are now."""
    files = listed_files(spark, folder, names)
    seen = read_if_exists(spark, ledger, LEDGER)
    if seen is None:
        return files
    # Of a run that did not finish the ledger says nothing.
    return files.join(seen.filter(F.col("run") <= last_run), FILE, "left_anti")


def record_files(files: DataFrame, ledger: str, run_id: int) -> DataFrame:
    """Write the files of a run, before it reads them, and return them as written. They count once the run is finished; repeated,
    the run writes its list anew."""
    path = f"{ledger}/run={run_id}"
    files.write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(StructType.fromDDL(LEDGER)).parquet(path).select(*FILE)


def exact_path(path: str) -> str:
    """A path whose special characters stand for themselves, not for patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)
