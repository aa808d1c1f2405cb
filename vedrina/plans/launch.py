"""Starts a job from the command line, as for spark-submit:

    spark-submit vedrina/plans/launch.py append --servers log:9092 --topic daily --table /data/daily ...
    python -m vedrina.plans.launch report --observations /data/stream --report /data/report --state /cp/report

Settings of Spark (master, packages of the connector, spark.checkpoint.dir) are spark-submit's.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

if __name__ == "__main__" and __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vedrina.plans import jobs
from vedrina.schemas import COUNTRY_WORDS, OBSERVATIONS, REPORT_COUNTRIES
from vedrina.sinks.compaction import TARGET_BYTES, compact
from vedrina.sources.files import read_landing
from vedrina.sources.ingestion_spec import IngestionSpec
from vedrina.sources.message_log import read_log
from vedrina.streaming.streams import ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vedrina", description="Jobs over observations per place and day.")
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        made = commands.add_parser(name, help=text)
        for option in options:
            made.add_argument(f"--{option}", required=True)
        return made

    for name, text in (("append", "flat messages of a log, appended"), ("upsert", "nested messages of a log, by city and date")):
        made = command(name, text, "servers", "topic", "table", "checkpoint", "quarantine")
        made.add_argument("--starting", default="earliest" if name == "append" else "latest", choices=["earliest", "latest"])
        made.add_argument("--max-per-batch", type=int)
        if name == "append":
            made.add_argument("--redelivered-within", help="leave out messages that come again within this interval")
        if name == "upsert":
            made.add_argument("--report-countries", action="store_true", help="country names as the report selects by them")
            made.add_argument("--by-event-time", action="store_true")
            made.add_argument("--by-file", action="store_true", help="a table of versions, of which a batch rewrites few files")

    made = command("ingest", "messages as an ingestion specification asks", "spec", "table", "checkpoint", "quarantine")
    made.add_argument("--starting", default="earliest", choices=["earliest", "latest"])

    made = command("compact", "an appended observation table's small files into large ones", "table")
    made.add_argument("--target-bytes", type=int, default=TARGET_BYTES)
    made.add_argument("--ended", action="store_true", help="no stream writes to the table any more")

    made = command("landing", "the landing zone into the table by city and date", "landing", "table", "quarantine", "state")
    made.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"))
    made.add_argument("--run-id", type=int)
    made.add_argument("--only-new", action="store_true", help="only files that no such run has read")

    made = command("wide", "messages in text files into the wide table", "messages", "table", "quarantine", "state")
    made.add_argument("--run-id", type=int)
    made.add_argument("--period", default="day", choices=["day", "week", "month", "quarter", "year"])

    made = command("report", "the daily extremes", "observations", "report", "state")
    made.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"))
    made.add_argument("--countries", nargs="*", default=REPORT_COUNTRIES, help="none: all of them")
    made.add_argument("--one-pass", action="store_true")

    made = command("report-new", "new observations of an appended table into the running report", "observations", "report", "state")
    made.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"), help="of the new observations")
    made.add_argument("--countries", nargs="*", default=REPORT_COUNTRIES, help="none: all of them")
    made.add_argument("--batch-id", type=int)
    return top


def run(spark: SparkSession, arguments: Sequence[str]) -> None:
    """Runs the job to its end."""
    given = parser().parse_args(arguments)
    dates = tuple(given.dates) if getattr(given, "dates", None) else None
    if given.job in ("append", "upsert"):
        log = read_log(spark, given.servers, given.topic, starting=given.starting, max_per_batch=given.max_per_batch)
        if given.job == "append":
            query = jobs.append_job(log, given.table, given.checkpoint, given.quarantine, given.redelivered_within)
        else:
            countries = COUNTRY_WORDS if given.report_countries else None
            query = jobs.upsert_job(
                log, given.table, given.checkpoint, given.quarantine, countries=countries, by_event_time=given.by_event_time, by_file=given.by_file
            )
        query.awaitTermination()
    elif given.job == "ingest":
        # The specification may be in any store that Spark reads.
        text = "\n".join(row["value"] for row in spark.read.text(given.spec, wholetext=True).collect())
        spec = IngestionSpec.read(text)
        log = read_log(spark, spec.servers, spec.topic, starting=given.starting, max_per_batch=spec.max_rows_per_batch)
        ingest(log, spec, given.table, given.checkpoint, given.quarantine).awaitTermination()
    elif given.job == "compact":
        compact(spark, given.table, OBSERVATIONS, target_bytes=given.target_bytes, ended=given.ended)
    elif given.job == "landing":
        jobs.landing_job(spark, given.landing, given.table, given.quarantine, given.state, given.run_id, dates, only_new=given.only_new)
    elif given.job == "wide":
        messages = spark.read.text(given.messages, lineSep="\n")
        jobs.wide_job(messages, given.table, given.quarantine, given.state, given.run_id, period=given.period)
    elif given.job == "report":
        observations = read_landing(spark, given.observations, OBSERVATIONS, "parquet")
        jobs.daily_extremes_job(
            observations, given.report, given.state, given.countries or None, dates=dates, two_passes=not given.one_pass
        )
    elif given.job == "report-new":
        observations = read_landing(spark, given.observations, OBSERVATIONS, "parquet")
        if dates:
            observations = observations.filter(F.col("datum").between(*[F.lit(date).cast("date") for date in dates]))
        jobs.report_increment(observations, given.report, given.state, given.countries or None, given.batch_id)


def main() -> None:
    spark = SparkSession.builder.appName("vedrina").getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
