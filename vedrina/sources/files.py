"""Text files and the landing zone.

Landed JSON is read as text and goes through the message parser, so that a line that is no record, or has a field
that does not fit, is reported (``read_landing_lines`` with ``parsing.rejected``) instead of becoming nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vedrina.operators.parsing import accepted, parse_messages
from vedrina.sources.pickup import exact_path

# The reader's default pattern would cut local times to milliseconds.
TIME_PATTERN = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (ended by \\n) of the text files under ``path``, with the name of its file."""
    return spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_name").alias("file_name"))


def _line_schema(schema: str, partition_by: str | None) -> str:
    kinds = {field.name: field.dataType.simpleString() for field in StructType.fromDDL(schema)}
    return "value string" + (f", `{partition_by}` {kinds[partition_by]}" if partition_by else "")


def parse_landing(lines: DataFrame, schema: str, partition_by: str | None = "datum") -> DataFrame:
    """Landed lines (``value``, and the partition column) to the columns of ``schema`` and the findings of the parser."""
    fields = [(field.name, field.name, field.dataType.simpleString()) for field in StructType.fromDDL(schema)]
    keep = [partition_by] if partition_by else []
    parsed = parse_messages(lines, [field for field in fields if field[1] != partition_by], keep=keep)
    names = [name for _, name, _ in fields]
    return parsed.select(*names, *[name for name in parsed.columns if name not in names])


def read_landing_lines(spark: SparkSession, path: str, schema: str, partition_by: str | None = "datum") -> DataFrame:
    """All landed JSON lines, parsed, with the findings. A filter on the partition column skips directories."""
    lines = spark.read.schema(_line_schema(schema, partition_by)).text(path)
    return parse_landing(lines, schema, partition_by)


def read_landing_files(
    spark: SparkSession, files: DataFrame, path: str, schema: str, partition_by: str | None = "datum"
) -> DataFrame | None:
    """The lines of some of the landed files (``sources.pickup``), parsed, with the findings; None if there are no files.

    The driver names the files to the reader, as it does for those it lists itself.
    """
    paths = [exact_path(row["path"]) for row in files.select("path").collect()]
    if not paths:
        return None
    lines = spark.read.schema(_line_schema(schema, partition_by)).option("basePath", path).text(paths)
    return parse_landing(lines, schema, partition_by)


def stream_landing_lines(
    spark: SparkSession,
    path: str,
    schema: str,
    partition_by: str | None = "datum",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """The same as a stream of newly landed files; it goes to ``streaming.streams`` as parsed messages."""
    reader = spark.readStream.schema(_line_schema(schema, partition_by))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return parse_landing(reader.text(path), schema, partition_by)


def read_landing(
    spark: SparkSession, path: str, schema: str, file_format: str = "json", partition_by: str | None = "datum"
) -> DataFrame:
    """Landed records with a declared schema; of JSON the readable lines, misfit fields as null."""
    if file_format == "json":
        return accepted(read_landing_lines(spark, path, schema, partition_by))
    return spark.read.schema(schema).options(**TIME_PATTERN).format(file_format).load(path)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "json",
    max_files_per_batch: int | None = None,
    partition_by: str | None = "datum",
) -> DataFrame:
    """The landing zone as a stream of newly landed records; as ``read_landing``."""
    if file_format == "json":
        return accepted(stream_landing_lines(spark, path, schema, partition_by, max_files_per_batch))
    reader = spark.readStream.schema(schema).options(**TIME_PATTERN).format(file_format)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)
