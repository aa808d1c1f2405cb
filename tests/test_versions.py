"""Upserts that rewrite the files of their keys only, against a dictionary."""

import datetime as dt
import os
import random

import pytest

from tests.conftest import SF_DIR
from vedrina.operators.parsing import parse_nested
from vedrina.plans.observations import envelope, event_stream, nested_text, observations
from vedrina.schemas import OBSERVATIONS
from vedrina.sinks import versions
from vedrina.sinks.versions import last_version, read_version, upsert_files
from vedrina.sources.message_log import ARRIVAL
from vedrina.streaming.streams import upsert_stream

SCHEMA = "city string, temp double, at int, day date"


def day(n):
    return dt.date(2024, 1, 1 + n)


@pytest.fixture
def target(spark, path):
    class Target:
        table = path("a table")

        def merge(self, rows, batch_id=None, by_time=False, rows_per_file=10):
            batch = spark.createDataFrame(rows, SCHEMA).repartition(3)
            return upsert_files(batch, self.table, SCHEMA, ["city", "day"], "day", ["at"], batch_id, ["at"] if by_time else None, rows_per_file)

        def rows(self):
            return {(row.city, row.day): (row.temp, row.at) for row in read_version(spark, self.table, SCHEMA).collect()}

        def files(self):
            return last_version(spark, self.table).files

        def count(self):
            return read_version(spark, self.table, SCHEMA).count()

    return Target()


@pytest.mark.parametrize("by_time", [False, True])
def test_equals_a_dictionary(target, by_time):
    dice, expected = random.Random(4), {}
    for batch_id in range(5):
        rows = [(f"c{dice.randrange(60)}", float(k), dice.randrange(40), day(dice.randrange(4))) for k in range(70)]
        assert target.merge(rows, batch_id, by_time)
        latest = {}
        for city, temp, at, own in rows:
            key = (city, own)
            latest[key] = max(latest.get(key, (-1, -1.0)), (at, temp))
        for key, (at, temp) in latest.items():
            if not (by_time and key in expected and expected[key][1] > at):
                expected[key] = (temp, at)
        assert target.rows() == expected and target.count() == len(expected)


def test_ten_keys_rewrite_ten_files_at_most(target, spark):
    target.merge([(f"c{n:04}", 0.0, 0, day(0)) for n in range(1000)])
    before = target.files()
    assert len(before) >= 100
    target.merge([(f"c{n:04}", 1.0, 1, day(0)) for n in range(0, 1000, 100)])
    gone = set(before) - set(target.files())
    assert 0 < len(gone) <= 10
    assert target.count() == 1000 and sum(temp for temp, _ in target.rows().values()) == 10
    # Keys that are nowhere rewrite nothing; other dates' files are not even candidates.
    before = target.files()
    target.merge([("new", 1.0, 1, day(0)), ("c0001", 1.0, 1, day(1))])
    assert set(before) < set(target.files()) and target.count() == 1002


def test_a_repeated_batch_changes_nothing(target):
    assert target.merge([("a", 1.0, 1, day(0))], 3)
    before = target.files()
    assert not target.merge([("a", 2.0, 2, day(0))], 3) and not target.merge([("a", 2.0, 2, day(0))], 1)
    assert target.files() == before and target.rows() == {("a", day(0)): (1.0, 1)}


def test_readers_see_a_batch_in_full_or_not_at_all(target, spark, monkeypatch):
    target.merge([("a", 1.0, 1, day(0)), ("b", 1.0, 1, day(1))], 0)
    reader = read_version(spark, target.table, SCHEMA)

    def end(*_):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_write_entry", end)
        with pytest.raises(RuntimeError, match="ended"):
            target.merge([("a", 2.0, 2, day(0)), ("b", 2.0, 2, day(1))], 1)
    assert set(target.rows().values()) == {(1.0, 1)}
    assert target.merge([("a", 3.0, 3, day(0)), ("b", 3.0, 3, day(1))], 1)
    assert set(target.rows().values()) == {(3.0, 3)}
    # A reader that began before still finds its files; the next upsert removes them.
    assert {row.temp for row in reader.collect()} == {1.0}
    target.merge([("c", 4.0, 4, day(0))], 2)
    stored = [name for folder, _, names in os.walk(f"{target.table}/data") for name in names if name.endswith(".parquet")]
    # The files of the first batch are gone; a new key has a file of its own.
    assert len(target.files()) == len(stored) == 3


def test_rows_without_keys_and_empty_batches(target):
    assert target.merge([("a", 1.0, 1, day(0)), (None, 1.0, 1, day(0)), ("b", 1.0, 1, None)])
    assert target.rows() == {("a", day(0)): (1.0, 1)}
    assert target.merge([(None, 1.0, 1, day(0))])
    assert target.rows() == {("a", day(0)): (1.0, 1)}


def test_nothing_stored(target):
    assert target.rows() == {}
    assert target.merge([(None, 1.0, 1, day(0))], 0) and target.rows() == {} and not target.merge([("a", 1.0, 1, day(0))], 0)


def test_streams_count_their_own_batches(spark, path):
    """A stream started over on a new checkpoint begins at 0 again and is not taken for the first one."""
    rows = observations(spark, SF_DIR, event_stream(spark, SF_DIR))
    parsed = parse_nested(envelope(rows, nested_text()), keep=ARRIVAL)
    for checkpoint in ("c1", "c1", "c2"):
        upsert_stream(parsed, path("t"), path(checkpoint), path("q"), by_file=True).awaitTermination()
    assert sorted(last_version(spark, path("t")).batches.values()) == [0, 0]
    keys = observations(spark, SF_DIR).select("grad", "datum").distinct().count()
    assert read_version(spark, path("t"), OBSERVATIONS).count() == keys
