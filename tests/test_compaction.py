"""Packing an appended table: the same rows in few files, whatever comes in between."""

import os

import pytest
from pyspark.sql import functions as F

from vedrina.plans import launch
from vedrina.schemas import OBSERVATIONS
from vedrina.sinks import compaction
from vedrina.sinks.append import append_batch, read_appended
from vedrina.sinks.compaction import LOG, PACKS, compact, packed_state

SCHEMA = "n bigint, datum date"


def numbers(spark, first, last):
    dates = "date_add(date'2024-01-01', cast(id % 3 as int))"
    # The first date has most of the rows, one row has no date.
    date = f"CASE WHEN id = 5 THEN NULL WHEN id % 10 < 6 THEN date'2024-01-01' ELSE {dates} END"
    return spark.range(first, last).selectExpr("id AS n", f"{date} AS datum")


def batches(spark, table, count, stream="a", rows=20):
    """Many batches at once, in the directories that ``append_batch`` makes."""
    every = numbers(spark, 0, count * rows).withColumn("stream", F.lit(stream)).withColumn("batch_id", F.floor(F.col("n") / rows))
    every.repartition(4, "batch_id").write.mode("append").partitionBy("stream", "batch_id", "datum").parquet(table)


def stored(spark, table):
    return sorted((row.n, str(row.datum)) for row in read_appended(spark, table, SCHEMA).collect())


def files(table):
    return [f"{folder}/{name}" for folder, _, names in os.walk(table) for name in names if name.endswith(".parquet")]


def counted(table):
    """The data files that count."""
    return [name for name in files(table) if LOG not in name]


def test_many_batches_end_in_few_files(spark, path):
    table = path("t")
    batches(spark, table, 200)
    before = stored(spark, table)
    assert len(before) == 4000 and len(files(table)) >= 600
    assert compact(spark, table, SCHEMA)
    assert stored(spark, table) == before
    # The last batch may still be written; the run after that removes what was packed.
    assert packed_state(spark, table).streams == {"a": 198}
    assert compact(spark, table, SCHEMA, ended=True)
    assert stored(spark, table) == before
    assert not compact(spark, table, SCHEMA, ended=True)
    assert stored(spark, table) == before
    # Two packs of four dates (one of them null).
    assert len(counted(table)) <= 8


def test_files_have_about_the_wanted_size(spark, path):
    table = path("t")
    batches(spark, table, 60)
    sizes = [os.path.getsize(name) for name in files(table)]
    # Adaptive execution would bring bins together that are smaller than its own wanted size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compact(spark, table, SCHEMA, target_bytes=sum(sizes) // 8, ended=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    packed = [name for name in files(table) if PACKS in name]
    hot = [name for name in packed if "2024-01-01" in name]
    assert len(hot) >= 3 and len(packed) <= 12


def test_packs_are_merged_by_level(spark, path):
    table = path("t")
    levels = []
    for batch_id in range(9):
        append_batch(numbers(spark, 10 * batch_id, 10 * batch_id + 10), table, "a", batch_id)
        compact(spark, table, SCHEMA, fanout=2, ended=True)
        levels.append(sorted(packed_state(spark, table).packs.values()))
        assert len(stored(spark, table)) == 10 * batch_id + 10
    assert levels == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2], [3], [0, 3]]


def test_a_packed_batch_that_is_repeated_changes_nothing(spark, path):
    table = path("t")
    for batch_id in range(3):
        append_batch(numbers(spark, 10 * batch_id, 10 * batch_id + 10), table, "a", batch_id)
    before = stored(spark, table)
    compact(spark, table, SCHEMA)
    for batch_id in range(3):
        append_batch(numbers(spark, 10 * batch_id, 10 * batch_id + 10), table, "a", batch_id)
        assert stored(spark, table) == before
    # A stream started over counts from 0 again.
    append_batch(numbers(spark, 100, 110), table, "b", 0)
    assert len(stored(spark, table)) == 40
    compact(spark, table, SCHEMA, ended=True)
    assert len(stored(spark, table)) == 40 and packed_state(spark, table).streams == {"a": 2, "b": 0}


@pytest.mark.parametrize("step", ["pack", "log", "removal"])
def test_a_run_that_ends_in_between_is_completed_by_the_next(spark, path, monkeypatch, step):
    table = path("t")
    batches(spark, table, 12)
    before = stored(spark, table)
    compact(spark, table, SCHEMA)
    batches(spark, path("more"), 5, "b")
    extra = numbers(spark, 1000, 1010)
    append_batch(extra, table, "b", 0)
    whole = stored(spark, table)

    def end(*_):
        raise RuntimeError("ended")

    names = {"pack": "binned", "log": "_write_log", "removal": "remove_replaced"}
    with monkeypatch.context() as patch:
        patch.setattr(compaction, names[step], end)
        with pytest.raises(RuntimeError, match="ended"):
            compact(spark, table, SCHEMA, fanout=2, ended=True)
    assert stored(spark, table) == whole and len(whole) == len(before) + 10
    assert compact(spark, table, SCHEMA, fanout=2, ended=True)
    assert stored(spark, table) == whole
    compact(spark, table, SCHEMA, fanout=2, ended=True)
    assert stored(spark, table) == whole and len(counted(table)) <= 4


def test_dates_are_pruned_in_packs_and_batches(spark, path):
    table = path("t")
    batches(spark, table, 8)
    compact(spark, table, SCHEMA)
    rows = read_appended(spark, table, SCHEMA).filter("datum = date'2024-01-02'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(datum") + plan.count("datum#") >= 2 and "PartitionFilters: []" not in plan
    assert rows.count() == sum(date == "2024-01-02" for _, date in stored(spark, table))


def test_nothing_to_pack(spark, path):
    table = path("t")
    append_batch(numbers(spark, 0, 10), table, "a", 0)
    assert not compact(spark, table, SCHEMA)
    append_batch(numbers(spark, 0, 0), table, "a", 1)
    assert not compact(spark, table, SCHEMA)
    assert len(stored(spark, table)) == 10


def test_from_the_command_line(spark, path):
    row = "SELECT 'Nis' grad, 'r' region, 'Srbija' drzava, 1D temperatura, 2D osecaj, 3 vlaznost, 'Vedro' stanje, timestamp_ntz'2024-01-01 05:00:00' lokalno_vreme, date'2024-01-01' datum"
    for batch_id in range(2):
        append_batch(spark.sql(row), path("t"), "a", batch_id)
    launch.run(spark, ["compact", "--table", path("t"), "--ended"])
    assert packed_state(spark, path("t")).streams == {"a": 1}
    assert read_appended(spark, path("t"), OBSERVATIONS).count() == 2
