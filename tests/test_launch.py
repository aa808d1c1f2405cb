import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from vedrina.plans import launch
from vedrina.plans.jobs import read_report, read_wide
from vedrina.plans.observations import observations
from vedrina.schemas import OBSERVATIONS
from vedrina.sinks.landing import write_landing
from vedrina.sources.files import read_landing


def test_landing_then_report(spark, path):
    rows = observations(spark, SF_DIR).drop("event_id")
    write_landing(rows, path("landing"))
    launch.run(
        spark,
        ["landing", "--landing", path("landing"), "--table", path("table"), "--quarantine", path("aside"), "--state", path("s1"),
         "--dates", "2024-01-03", "2024-01-05"],
    )
    table = read_landing(spark, path("table"), OBSERVATIONS, "parquet")
    assert sorted(str(row.datum) for row in table.select("datum").distinct().collect()) == ["2024-01-03", "2024-01-04", "2024-01-05"]
    launch.run(
        spark,
        ["report", "--observations", path("table"), "--report", path("report"), "--state", path("s2"), "--dates", "2024-01-04", "2024-01-04",
         "--countries"],
    )
    report = read_report(spark, path("report"))
    assert report.count() == table.filter("datum = date'2024-01-04'").select("drzava").distinct().count() > 0


def test_wide(spark, path):
    spark.createDataFrame([(json.dumps({"city": "Nis", "last_updated_epoch": 5}),), ("junk",)], "value string").write.text(path("in"))
    for _ in range(2):
        launch.run(
            spark, ["wide", "--messages", path("in"), "--table", path("t"), "--quarantine", path("q"), "--state", path("s"), "--run-id", "3"]
        )
    assert [row.city for row in read_wide(spark, path("t")).collect()] == ["Nis"]
    assert spark.read.parquet(path("q")).filter(F.col("raw") == "junk").count() == 1


@pytest.mark.parametrize("job", ["append", "upsert", "ingest"])
def test_streams_read_the_log(spark, path, job, monkeypatch):
    """The connector is not installed: what is asked of it is recorded."""
    asked = []

    class Query:
        def awaitTermination(self):
            asked.append("ended")

    monkeypatch.setattr(launch, "read_log", lambda spark, servers, topic, **settings: asked.append((servers, topic, settings)))
    for module, name in ((launch.jobs, "append_job"), (launch.jobs, "upsert_job"), (launch, "ingest")):
        monkeypatch.setattr(module, name, lambda *args, **settings: Query())
    places = ["--table", "t", "--checkpoint", "c", "--quarantine", "q"]
    if job == "ingest":
        from vedrina.plans.checks import EVENT_SPEC

        spark.createDataFrame([(json.dumps(EVENT_SPEC),)], "value string").coalesce(1).write.text(path("spec"))
        launch.run(spark, [job, "--spec", path("spec"), *places])
        assert asked == [("log:9092", "events", {"starting": "earliest", "max_per_batch": 700000}), "ended"]
    else:
        launch.run(spark, [job, "--servers", "log:1", "--topic", "x", *places])
        starting = "earliest" if job == "append" else "latest"
        assert asked == [("log:1", "x", {"starting": starting, "max_per_batch": None}), "ended"]


def test_missing_argument(spark):
    with pytest.raises(SystemExit):
        launch.run(spark, ["report"])
