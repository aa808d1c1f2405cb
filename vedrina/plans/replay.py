"""Messages that were set aside and repaired enter the appended table, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.operators.parsing import PROBLEMS, RAW, UNREADABLE, accepted, parse_flat
from vedrina.shared import new_path, read_if_exists, written
from vedrina.sinks.append import append_batch

# Beside the directories of the streams; Spark skips the name when it lists the quarantine.
DONE = "_replayed"
DONE_ROWS = "digest string, run bigint"
SET_ASIDE = f"{PROBLEMS} array<string>, {RAW} string, stream string, batch_id bigint"
STREAM = "replay"


def pending(spark: SparkSession, quarantine: str, last_run: int | None = None) -> DataFrame:
    """The unreadable messages of a quarantine that no run up to ``last_run`` (by default, none at all) has replayed: ``raw`` and
    its ``digest``, each text once. Messages with misfit fields are in the table already, with nulls, and do not count."""
    aside = spark.read.schema(SET_ASIDE).parquet(quarantine).filter(F.array_contains(PROBLEMS, UNREADABLE))
    texts = aside.filter(F.col(RAW).isNotNull()).select(RAW, F.sha2(RAW, 256).alias("digest")).dropDuplicates(["digest"])
    done = read_if_exists(spark, f"{quarantine}/{DONE}", DONE_ROWS)
    if done is None:
        return texts
    if last_run is not None:
        done = done.filter(F.col("run") <= last_run)
    return texts.join(done.select("digest"), "digest", "left_anti").select(RAW, "digest")


def replay_job(
    spark: SparkSession,
    quarantine: str,
    table: str,
    repair: Callable[[Column], Column],
    parse: Callable[..., DataFrame] = parse_flat,
) -> int:
    """Repair the pending messages (``repair`` makes a text of a text) and append those that can be read now; returns the number
    of the run.

    The digests of what entered are kept with the quarantine, so a message enters once, also if it was set aside several times
    or repaired again by a later run. Those that still cannot be read stay pending. A run that ends before its digests
    are written is done anew under its number, in the same directory of the table.
    """
    done = read_if_exists(spark, f"{quarantine}/{DONE}", DONE_ROWS)
    last = None if done is None else done.agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1
    messages = pending(spark, quarantine, last).select(repair(F.col(RAW)).alias("value"), "digest")
    # Written, so that the rows and the digests are of the same messages.
    parsed = written(parse(messages, keep=["digest"]), new_path(spark, "replayed"))
    append_batch(accepted(parsed).drop("digest"), table, STREAM, run)
    accepted(parsed).select("digest").write.mode("overwrite").parquet(f"{quarantine}/{DONE}/run={run}")
    return run
