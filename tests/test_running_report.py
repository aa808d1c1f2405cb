"""The report that goes on from what it has, against the report over all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from vedrina.operators.extremes import daily_extremes, extreme_state, from_state, merged_state
from vedrina.operators.parsing import parse_flat
from vedrina.plans import launch
from vedrina.plans.jobs import read_running_report, report_increment, report_stream
from vedrina.plans.observations import envelope, event_stream, flat_text, observations
from vedrina.schemas import OBSERVATIONS
from vedrina.sinks import merge

ROWS = "datum date, drzava string, temperatura double, grad string, lokalno_vreme timestamp_ntz, stanje string"


def invented(seed, n):
    """Few values, so that most groups have ties; nulls, NaN and infinities; three months."""
    dice = random.Random(seed)
    values = [1.0, 1.0, 2.0, -3.5, -0.0, 0.0, float("nan"), float("inf"), None]
    return [
        (
            dice.choice([dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1), None]),
            dice.choice(["A", "B", "B", "B", None]), dice.choice(values), dice.choice(["x", "y", None]),
            dt.datetime(2024, 1, 1, dice.randrange(3)), dice.choice(["s", "t", None]),
        )
        for _ in range(n)
    ]


def shown(frame):
    return sorted(map(repr, frame.collect()))


def full(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    counted = df.filter("datum is not null and drzava is not null and temperatura is not null").groupBy("datum", "drzava").agg(F.count("*").alias("n"))
    report = daily_extremes(df, None).join(counted, ["datum", "drzava"])
    names = [name for name in report.columns if name not in ("datum", "drzava", "n")]
    return shown(report.select("datum", "drzava", "n", *names))


def test_equals_the_full_report_after_appended_late_and_tied_rows(spark, path):
    rows = []
    for batch_id in range(4):
        new = invented(batch_id, 60)
        rows += new
        assert report_increment(spark.createDataFrame(new, ROWS).repartition(3), path("r"), path("s"), None)
        assert shown(read_running_report(spark, path("r"))) == full(spark, rows)


def test_a_repeated_batch_changes_nothing(spark, path):
    new = spark.createDataFrame(invented(7, 50), ROWS)
    assert report_increment(new, path("r"), path("s"), None, 0)
    before = shown(read_running_report(spark, path("r")))
    assert not report_increment(new, path("r"), path("s"), None, 0)
    assert shown(read_running_report(spark, path("r"))) == before


def test_a_run_that_ends_in_between_is_counted_once(spark, path, monkeypatch):
    first, second = invented(1, 40), invented(2, 40)
    report_increment(spark.createDataFrame(first, ROWS), path("r"), path("s"), None, 0)

    def end(*_):
        raise RuntimeError("ended")

    for name in ("_set_number", "_publish"):
        with monkeypatch.context() as patch:
            patch.setattr(merge, name, end)
            with pytest.raises(RuntimeError, match="ended"):
                report_increment(spark.createDataFrame(second, ROWS), path("r"), path("s"), None, 1)
    report_increment(spark.createDataFrame(second, ROWS), path("r"), path("s"), None, 1)
    assert shown(read_running_report(spark, path("r"))) == full(spark, first + second)


def test_only_groups_of_the_new_rows_are_read_and_written(spark, path):
    days = [(dt.date(2024, month, 1), "A", 1.0, "x", dt.datetime(2024, month, 1), "s") for month in range(1, 7)]
    report_increment(spark.createDataFrame(days, ROWS), path("r"), path("s"), None)
    late = [(dt.date(2024, 2, 1), "A", 5.0, "y", dt.datetime(2024, 2, 1), "s")]
    report_increment(spark.createDataFrame(late, ROWS), path("r"), path("s"), None)
    staged = spark.read.parquet(path("s") + "/merge/rows").collect()
    assert [(row.datum, row.n) for row in staged] == [(dt.date(2024, 2, 1), 2)]
    assert {row.najtopliji_grad for row in read_running_report(spark, path("r")).collect()} == {"x", "y"}


def test_states_merge_in_any_order(spark):
    rows = invented(3, 90)
    frames = [spark.createDataFrame(rows[k::3], ROWS) for k in range(3)]
    keys, order = ["datum", "drzava"], ["grad", "lokalno_vreme", "stanje"]
    states = [extreme_state(frame, keys, "temperatura", order) for frame in frames]
    kind = frames[0].schema["temperatura"].dataType
    found = [
        shown(from_state(merged_state(merged_state(a.unionByName(b), keys).unionByName(c), keys), keys, order, kind))
        for a, b, c in (states, states[::-1])
    ]
    whole = extreme_state(spark.createDataFrame(rows, ROWS), keys, "temperatura", order)
    assert found[0] == found[1] == shown(from_state(whole, keys, order, kind))


def test_stream(spark, path):
    rows = observations(spark, SF_DIR, event_stream(spark, SF_DIR))
    for _ in range(2):
        report_stream(parse_flat(envelope(rows, flat_text())), path("r"), path("c"), None).awaitTermination()
    stored = observations(spark, SF_DIR)
    expected = daily_extremes(stored, None)
    found = read_running_report(spark, path("r"))
    assert shown(found.select(*expected.columns)) == shown(expected)
    assert found.agg(F.sum("n")).first()[0] == stored.count()


def test_from_the_command_line(spark, path):
    names = ", ".join(part.split()[0] for part in OBSERVATIONS.split(", "))
    observations(spark, SF_DIR).selectExpr(*names.split(", ")).write.partitionBy("datum").parquet(path("o"))

    def run(name, *dates):
        places = ["--observations", path("o"), "--report", path(name), "--state", path(f"{name}-state")]
        launch.run(spark, ["report-new", *places, *(["--dates", *dates] if dates else []), "--countries"])
        return shown(read_running_report(spark, path(name)))

    whole = run("whole")
    run("parts", "2024-01-16", "2024-02-28")
    assert run("parts", "2023-12-01", "2024-01-15") == whole
