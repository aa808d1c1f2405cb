"""Stream ingestion described by a JSON specification."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vedrina.functions.times import auto_time, date_of
from vedrina.operators.parsing import PROBLEMS, RAW, READABLE, parse_messages
from vedrina.sources.message_log import log_options

DAY = "day"


@dataclass(frozen=True)
class IngestionSpec:
    """What a specification asks for.

    Its numbers of tasks and replicas are left to Spark and to the storage. Rows per segment become
    rows per file, and the rows held before they are published become rows per micro-batch.
    """

    table: str
    topic: str
    servers: str
    group: str | None
    time_column: str
    dimensions: list[str]
    max_rows_per_file: int | None
    max_rows_per_batch: int | None

    @classmethod
    def read(cls, spec: dict | str) -> IngestionSpec:
        """From a parsed specification or its JSON text."""
        body = (json.loads(spec) if isinstance(spec, str) else spec)["spec"]
        parse = body["parser"]["parseSpec"]
        time = parse["timestampSpec"]
        if time.get("format", "auto") != "auto":
            raise ValueError(f"time format {time['format']!r} is not supported, only 'auto'")
        dimensions = parse["dimensionsSpec"]["dimensions"]
        columns = parse.get("columns", [time["column"], *dimensions])
        missing = {time["column"], *dimensions} - set(columns)
        if missing:
            raise ValueError(f"the specification uses columns it does not list: {sorted(missing)}")
        consumer = body["ioConfig"]["consumerProperties"]
        tuning = body.get("tuningConfig", {})
        return cls(
            table=body["dataSource"],
            topic=body["ioConfig"]["topic"],
            servers=consumer["bootstrap.servers"],
            group=consumer.get("group.id"),
            time_column=time["column"],
            dimensions=list(dimensions),
            max_rows_per_file=tuning.get("maxRowsPerSegment"),
            max_rows_per_batch=tuning.get("maxTotalRows"),
        )

    def log_options(self) -> dict[str, str]:
        """Connector options for the specified topic."""
        return log_options(
            self.servers, self.topic, group=self.group, max_per_batch=self.max_rows_per_batch
        )

    def schema(self) -> str:
        """The stored columns: the time, the dimensions as text, and the day of the time."""
        dimensions = [f"`{name}` string" for name in self.dimensions]
        return ", ".join([f"`{self.time_column}` timestamp_ntz", *dimensions, f"{DAY} date"])


def parse_specified(messages: DataFrame, spec: IngestionSpec, value: str = "value") -> DataFrame:
    """Messages to the specified columns; ``problems`` names the time when it cannot be read."""
    names = [spec.time_column, *spec.dimensions]
    # Under a name of its own: a dimension may be called like the message column.
    texts = messages.select(F.col(value).cast("string").alias("_message"))
    rows = parse_messages(texts, [(name, name, "string") for name in names], "_message", ["_message"])
    time = auto_time(F.col(spec.time_column))
    unread_time = F.col(READABLE) & time.isNull()
    problems = F.when(unread_time, F.array(F.lit(spec.time_column))).otherwise(F.col(PROBLEMS))
    return rows.select(
        time.alias(spec.time_column),
        *spec.dimensions,
        date_of(time).alias(DAY),
        READABLE,
        problems.alias(PROBLEMS),
        F.when(F.size(problems) > 0, F.col("_message")).alias(RAW),
    )
