import datetime as dt
import json
import math

import pytest

from vedrina.operators.parsing import accepted, parse_flat, parse_nested, rejected, without_key

FLAT = {
    "grad": "Nis", "region": "", "drzava": "Srbija", "temperatura": 10.5, "osecaj": 9.1, "vlaznost": 65,
    "stanje": "Vedro", "lokalno_vreme": "2025-03-26 14:05", "datum": "2025-03-26",
}
NESTED = {
    "location": {"name": "Nis", "region": "", "country": "Serbia", "localtime": "2025-03-26 9:05"},
    "current": {"temp_c": 10.5, "feelslike_c": 9.1, "humidity": 65, "condition": {"text": "Sunny"}},
}


def messages(spark, *texts):
    rows = [(None if text is None else bytearray(text.encode()), n) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "value binary, n int")


def flat(**changes):
    return json.dumps({**FLAT, **changes})


def parsed_flat(spark, text):
    [row] = parse_flat(messages(spark, text)).collect()
    return row


def test_flat_message(spark):
    [row] = accepted(parse_flat(messages(spark, flat()))).collect()
    assert row.asDict() == {
        **FLAT, "lokalno_vreme": dt.datetime(2025, 3, 26, 14, 5), "datum": dt.date(2025, 3, 26),
    }


def test_nested_message(spark):
    [row] = accepted(parse_nested(messages(spark, json.dumps(NESTED)), keep=["n"])).collect()
    assert row.asDict() == {
        "n": 0, "grad": "Nis", "region": "", "drzava": "Serbia", "temperatura": 10.5, "osecaj": 9.1,
        "vlaznost": 65, "stanje": "Sunny", "lokalno_vreme": dt.datetime(2025, 3, 26, 9, 5),
        "datum": dt.date(2025, 3, 26),
    }


@pytest.mark.parametrize("text", ["not json", "null", "[1]", '[{"grad":"Nis"}]', "", "  ", None, '{"grad":', "5"])
def test_unreadable_messages_are_set_aside(spark, text):
    parsed = parse_flat(messages(spark, text, flat()), keep=["n"])
    assert [row.n for row in accepted(parsed).collect()] == [1]
    [row] = rejected(parsed).collect()
    assert (row.n, row.readable, row.problems, row.raw) == (0, False, ["message"], text)


@pytest.mark.parametrize(
    "text, time, problems",
    [
        ("2025-03-26 9:05", dt.datetime(2025, 3, 26, 9, 5), []),
        ("2025-03-26 14:05", dt.datetime(2025, 3, 26, 14, 5), []),
        ("2025-03-30 02:30", dt.datetime(2025, 3, 30, 2, 30), []),
        ("junk", None, ["lokalno_vreme"]),
        ("", None, ["lokalno_vreme"]),
        (None, None, []),
    ],
)
def test_times(spark, text, time, problems):
    row = parsed_flat(spark, flat(lokalno_vreme=text))
    assert (row.lokalno_vreme, row.problems) == (time, problems)


def test_local_time_keeps_its_wall_clock_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Belgrade")
    try:
        row = parsed_flat(spark, flat(lokalno_vreme="2025-03-30 02:30"))
        assert row.lokalno_vreme == dt.datetime(2025, 3, 30, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "written, number, problems",
    [
        ("65", 65, []), ("65.0", 65, []), ('"65"', 65, []), ("-3", -3, []), ("null", None, []),
        ("3000000000", None, ["vlaznost"]), ("65.7", None, ["vlaznost"]), ('"many"', None, ["vlaznost"]),
        ("NaN", None, ["vlaznost"]), ("[1]", None, ["vlaznost"]),
    ],
)
def test_whole_numbers(spark, written, number, problems):
    row = parsed_flat(spark, flat().replace('"vlaznost": 65', f'"vlaznost": {written}'))
    assert (row.vlaznost, row.problems) == (number, problems)


@pytest.mark.parametrize("written, number", [("1.5", 1.5), ('"1.5"', 1.5), ("1e2", 100.0), ("-0.25", -0.25), ("7", 7.0)])
def test_real_numbers(spark, written, number):
    row = parsed_flat(spark, flat().replace('"temperatura": 10.5', f'"temperatura": {written}'))
    assert (row.temperatura, row.problems) == (number, [])


@pytest.mark.parametrize("written", ["NaN", '"NaN"'])
def test_not_a_number(spark, written):
    row = parsed_flat(spark, flat().replace('"temperatura": 10.5', f'"temperatura": {written}'))
    assert math.isnan(row.temperatura) and row.problems == []


def test_row_with_misfit_field_is_stored_and_reported(spark):
    parsed = parse_flat(messages(spark, flat(vlaznost=3000000000)))
    [row] = accepted(parsed).collect()
    assert row.grad == "Nis" and row.vlaznost is None
    [row] = rejected(parsed).collect()
    assert row.problems == ["vlaznost"] and json.loads(row.raw)["vlaznost"] == 3000000000


def test_missing_side_of_a_nested_message_gives_nulls(spark):
    without_current = json.dumps({"location": NESTED["location"]})
    without_location = json.dumps({"current": NESTED["current"]})
    first, second = parse_nested(messages(spark, without_current, without_location), keep=["n"]).orderBy("n").collect()
    assert first.grad == "Nis" and first.temperatura is None and first.stanje is None and first.problems == []
    assert second.grad is None and second.datum is None and second.temperatura == 10.5 and second.problems == []


def test_field_names_are_case_sensitive(spark):
    row = parsed_flat(spark, flat().replace('"grad"', '"Grad"'))
    assert row.grad is None and row.readable


@pytest.mark.parametrize("text", [json.dumps(NESTED), "{}", '{"other": 1}', '{"grad": null}'])
def test_messages_of_another_shape_are_set_aside(spark, text):
    row = parsed_flat(spark, text)
    assert (row.readable, row.problems, row.raw) == (False, ["message"], text)
    assert accepted(parse_flat(messages(spark, text))).count() == 0


def test_rows_without_key(spark):
    parsed = parse_flat(messages(spark, flat(), flat(grad=None, datum=None), "junk"))
    [row] = without_key(parsed, ["grad", "datum"]).collect()
    assert row.problems == ["grad", "datum"] and json.loads(row.raw)["temperatura"] == 10.5


def test_each_message_is_parsed_once(spark):
    plan = accepted(parse_flat(messages(spark, flat())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
