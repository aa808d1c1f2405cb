"""JSON texts read once for many paths."""

import datetime as dt

import pytest

from vedrina.operators.documents import explode_array, select_paths

PATHS = [("$.a", "a", "int"), ("$.b.c", "c", "string"), ("$.list[1]", "second", "double"), ("$.t", "t", "timestamp_ntz"), ("$.b", "b", "string")]


def read(spark, *texts):
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, text string").repartition(2)
    return select_paths(df, "text", PATHS, ["n"]).orderBy("n").collect()


def test_values(spark):
    [row] = read(spark, ' {"a": 65.0, "b": {"c": "x"}, "list": [1, "2.5"], "t": "2024-01-01 9:05"} ')
    assert (row.a, row.c, row.second, row.t, row.b) == (65, "x", 2.5, dt.datetime(2024, 1, 1, 9, 5), '{"c":"x"}')
    assert row.readable and row.problems == [] and row.raw is None


@pytest.mark.parametrize(
    "text, problems",
    [
        ('{"a": "many"}', ["a"]), ('{"a": 3000000000, "t": "junk", "list": [0, "warm"]}', ["a", "second", "t"]), ('{"a": null}', []),
        ("{}", []), ("[]", []), ("7", []),
    ],
)
def test_misfits(spark, text, problems):
    [row] = read(spark, text)
    assert row.readable and row.problems == problems and row.raw == (text if problems else None)


@pytest.mark.parametrize("text", ['{"a": 1', '{"a": 1} junk', '{"a": 1},{"a": 2}', '{"a": 1}],["x"', '{"a": 1},"x"] []', "", "junk", None])
def test_texts_that_are_no_document(spark, text):
    [row] = read(spark, text)
    assert (row.readable, row.problems, row.raw, row.a) == (False, ["message"], text, None)


def test_one_parse_for_all_paths(spark):
    df = spark.createDataFrame([(1, "{}")], "n int, text string")
    for frame in (select_paths(df, "text", PATHS, ["n"]).filter("a > 1 and c = 'x'"), explode_array(df, "text", "$.list", PATHS).filter("a > 1")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parse_json") + plan.count("parseJson") == 1


def test_elements(spark):
    df = spark.createDataFrame([(1, '{"list": [{"a": 1}, 5, null, {"a": "x"}]}'), (2, '{"list": []}'), (3, '{"list": 7}'), (4, "junk"), (5, None)], "n int, text string")
    rows = explode_array(df, "text", "$.list", [("$.a", "a", "int"), ("$", "whole", "string")], ["n"]).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 1, '{"a":1}'), (1, 1, None, "5"), (1, 2, None, None), (1, 3, None, '{"a":"x"}')]
