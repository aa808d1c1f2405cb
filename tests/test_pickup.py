"""Runs that read only the files that came in since the last one."""

import json
import os

import pytest

from vedrina.plans import jobs, launch
from vedrina.plans.jobs import landing_job
from vedrina.schemas import OBSERVATIONS
from vedrina.sources.files import read_landing, read_landing_files
from vedrina.sources.pickup import exact_path, listed_files, new_files, record_files


def line(city, time, **more):
    return json.dumps({"grad": city, "region": "r", "drzava": "Srbija", "temperatura": 1.0, "lokalno_vreme": time, **more})


def land(folder, name, *lines, date="2024-01-01"):
    os.makedirs(f"{folder}/datum={date}", exist_ok=True)
    with open(f"{folder}/datum={date}/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture
def zone(spark, path):
    """The landing zone, a run over its new files, and the lines that the last run read."""

    class Zone:
        folder = path("landing")

        def run(self, **settings):
            return landing_job(spark, self.folder, path("table"), path("aside"), path("state"), words={}, only_new=True, **settings)

        def read(self):
            return spark.read.parquet(path("state") + "/parsed").count()

        def table(self):
            return {row.grad: str(row.lokalno_vreme) for row in read_landing(spark, path("table"), OBSERVATIONS, "parquet").collect()}

    return Zone()


def test_the_second_run_reads_new_files_only(zone):
    land(zone.folder, "a.json", line("Nis", "2024-01-01 05:00"), line("Uzice", "2024-01-01 06:00"))
    assert zone.run() and zone.read() == 2
    assert not zone.run()
    land(zone.folder, "b.json", line("Nis", "2024-01-01 09:00"))
    land(zone.folder, "c {odd}[1].json", line("Sid", "2024-01-02 01:00"), date="2024-01-02")
    assert zone.run() and zone.read() == 2
    assert zone.table() == {"Nis": "2024-01-01 09:00:00", "Uzice": "2024-01-01 06:00:00", "Sid": "2024-01-02 01:00:00"}
    assert not zone.run()


def test_a_replaced_file_is_read_again(zone):
    land(zone.folder, "a.json", line("Nis", "2024-01-01 05:00"))
    land(zone.folder, "b.json", line("Sid", "2024-01-01 05:00"))
    assert zone.run() and zone.read() == 2
    land(zone.folder, "a.json", line("Nis", "2024-01-01 07:00"))
    os.utime(f"{zone.folder}/datum=2024-01-01/a.json", (4_000_000_000, 4_000_000_000))
    assert zone.run() and zone.read() == 1
    assert zone.table()["Nis"] == "2024-01-01 07:00:00"


@pytest.mark.parametrize("step", ["upsert", "written"])
def test_a_run_that_ends_in_between_reads_its_files_again(zone, monkeypatch, step):
    land(zone.folder, "a.json", line("Nis", "2024-01-01 05:00"))
    assert zone.run()
    land(zone.folder, "b.json", line("Sid", "2024-01-01 05:00"))

    def end(*_, **__):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, step, end)
        with pytest.raises(RuntimeError, match="ended"):
            zone.run()
    land(zone.folder, "c.json", line("Uzice", "2024-01-01 05:00"))
    assert zone.run() and zone.read() == 2
    assert set(zone.table()) == {"Nis", "Sid", "Uzice"}


def test_a_run_that_was_staged_counts_as_read(spark, path, zone, monkeypatch):
    from vedrina.sinks import merge

    land(zone.folder, "a.json", line("Nis", "2024-01-01 05:00"))

    def end(*_):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "_publish", end)
        with pytest.raises(RuntimeError, match="ended"):
            zone.run()
    # The next run publishes what was staged and has nothing new to read.
    assert not zone.run()
    assert zone.table() == {"Nis": "2024-01-01 05:00:00"}


def test_dates_cannot_be_asked_for_as_well(zone):
    land(zone.folder, "a.json", line("Nis", "2024-01-01 05:00"))
    with pytest.raises(ValueError, match="some dates"):
        zone.run(dates=("2024-01-01", "2024-01-01"))


def test_files_are_listed_without_opening_them(spark, path, zone):
    land(zone.folder, "a.json", "x")
    land(zone.folder, "b.txt", "y")
    files = listed_files(spark, zone.folder, "*.json")
    assert [os.path.basename(row.path) for row in files.collect()] == ["a.json"]
    os.chmod(f"{zone.folder}/datum=2024-01-01/a.json", 0)
    [row] = files.collect()
    assert row.length == 2
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    os.chmod(f"{zone.folder}/datum=2024-01-01/a.json", 0o644)
    recorded = record_files(files, path("ledger"), 0)
    assert new_files(spark, zone.folder, path("ledger"), -1).count() == 2
    assert [os.path.basename(row.path) for row in new_files(spark, zone.folder, path("ledger"), 0).collect()] == ["b.txt"]
    assert read_landing_files(spark, recorded.limit(0), zone.folder, OBSERVATIONS) is None


def test_special_characters_stand_for_themselves():
    assert exact_path("/a{b}/[c]*?\\d") == "/a\\{b\\}/\\[c\\]\\*\\?\\\\d"


def test_from_the_command_line(spark, path):
    land(path("landing"), "a.json", line("Nis", "2024-01-01 05:00"))
    for city in ("Nis", "Sid"):
        land(path("landing"), f"{city}.json", line(city, "2024-01-01 06:00"))
        launch.run(
            spark,
            ["landing", "--landing", path("landing"), "--table", path("t"), "--quarantine", path("q"), "--state", path("s"), "--only-new"],
        )
    assert spark.read.parquet(path("s") + "/parsed").count() == 1
    assert {row.grad for row in read_landing(spark, path("t"), OBSERVATIONS, "parquet").collect()} == {"Nis", "Sid"}
