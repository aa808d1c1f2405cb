"""As-of joins against a search row by row."""

import datetime as dt
import random

import pytest

from vedrina.operators.asof import asof_join

ROWS = "id int, city string, country string, time timestamp_ntz"
HISTORY = "city string, country string, time timestamp_ntz, n int, reply string"


def at(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def invented(seed, n, hot):
    dice = random.Random(seed)
    cities = ["hot"] * hot + ["a", "b", "c", None]
    rows = [(k, dice.choice(cities), dice.choice(["x", "y"]), at(dice.choice([None, *range(200)]))) for k in range(n)]
    history = [
        (dice.choice(cities), dice.choice(["x", "y"]), at(dice.choice([None, *range(0, 200, 3)])), k, dice.choice([None, "r", "s"])) for k in range(n // 2)
    ]
    return rows, history


def by_hand(rows, history):
    found = []
    for id, city, country, time in rows:
        past = [h for h in history if None not in (city, country, time, h[2]) and h[:2] == (city, country) and h[2] <= time]
        n, reply = max(past, key=lambda h: (h[2], h[3]))[3:] if past else (None, None)
        found.append((id, city, country, time, n, reply))
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed, hot, batch", [(1, 1, 10_000), (2, 8, 10_000), (3, 8, 3), (4, 0, 1)])
def test_every_row_meets_the_reply_of_its_time(spark, seed, hot, batch):
    rows, history = invented(seed, 300, hot)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left, right = spark.createDataFrame(rows, ROWS).repartition(4), spark.createDataFrame(history, HISTORY).repartition(3)
        joined = asof_join(left, right, ["city", "country"], "time", ["n", "reply"], ["n"])
        assert joined.columns == ["id", "city", "country", "time", "n", "reply"]
        assert sorted(map(tuple, joined.collect()), key=repr) == by_hand(rows, history)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_hot_city_is_split(spark, monkeypatch):
    """A city with most of the rows lies over several tasks, which hand the last reply on."""
    from vedrina.operators import asof

    kept = {}
    real = asof.written
    monkeypatch.setattr(asof, "written", lambda frame, path: kept.setdefault(path.split("/")[-1].rsplit("-", 1)[0], real(frame, path)))
    rows = [(k, "hot" if k % 3 else f"c{k}", "x", at(k)) for k in range(900)]
    history = [("hot", "x", at(5), 1, "first"), ("hot", "x", at(450), 2, "second")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = asof_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(history, HISTORY), ["city", "country"], "time", ["n", "reply"])
        assert sorted(map(tuple, joined.collect()), key=repr) == by_hand(rows, history)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["count"] for row in kept["asof"].filter("__k0 = 'hot'").groupBy("part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 300
    # What is handed over is a row per partition at most.
    assert kept["asof-handed"].count() <= 8


def test_columns_of_any_name_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", at(1), "own", "b.c")], "id int, city string, time timestamp_ntz, row string, `d.e` string")
    right = spark.createDataFrame([("a", at(1), "r")], "city string, made timestamp_ntz, found string")
    joined = asof_join(left, right, ["city"], "time", ["found"], history_time="made")
    assert joined.columns == ["id", "city", "time", "row", "d.e", "found"]
    assert [tuple(row) for row in joined.collect()] == [(1, "a", at(1), "own", "b.c", "r")]
    assert asof_join(left, right.limit(0), ["city"], "time", ["found"], history_time="made").first().found is None
    assert asof_join(left.limit(0), right, ["city"], "time", ["found"], history_time="made").count() == 0
