import datetime as dt

import pytest
from pyspark.sql import functions as F

from vedrina.functions import text, times
from vedrina.functions.json_fields import json_path, typed
from vedrina.functions.numbers import whole_from_text
from vedrina.operators.cities import consolidate_cities, enrich_cities
from vedrina.operators.dictionary import check_dictionary, translate_with
from vedrina.operators.rows import extract_columns, set_columns, split_json, split_json_rejected, split_lines
from vedrina.schemas import CONDITION_WORDS, COUNTRY_WORDS, REPORT_COUNTRIES


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(content).alias(name) for name, content in inputs.items()])
    return row.select(column).first()[0]


@pytest.fixture(params=["UTC", "Europe/Belgrade", "America/New_York"])
def any_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "written, time",
    [
        ("1711450000123", dt.datetime(2024, 3, 26, 10, 46, 40, 123000)),
        ("-1", dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
        ("0", dt.datetime(1970, 1, 1)),
        ("2024-03-26T10:46:40", dt.datetime(2024, 3, 26, 10, 46, 40)),
        ("2024-03-26 9:05", dt.datetime(2024, 3, 26, 9, 5)),
        ("2025-03-30 02:30", dt.datetime(2025, 3, 30, 2, 30)),
        ("2024-03-26T10:46:40Z", dt.datetime(2024, 3, 26, 10, 46, 40)),
        ("2024-03-26T10:46:40.5+02:00", dt.datetime(2024, 3, 26, 8, 46, 40, 500000)),
        ("2024-10-27 01:30:00+00:00", dt.datetime(2024, 10, 27, 1, 30)),
        ("2024-03-26", dt.datetime(2024, 3, 26)), ("25:00:00Z", None),
        ("2025-03-26T14:05:00+02", dt.datetime(2025, 3, 26, 12, 5)), ("2025-03-26T14:05:00+2:00", dt.datetime(2025, 3, 26, 12, 5)),
        ("2025-03-26 14:05:00 UTC", dt.datetime(2025, 3, 26, 14, 5)), ("2025-03-26T14:05:00+0200", dt.datetime(2025, 3, 26, 12, 5)),
        ("2025-03-26 14:05:00 Europe/Belgrade", dt.datetime(2025, 3, 26, 13, 5)),
        ("2025-03-26 14:05 Europe/Belgrade", dt.datetime(2025, 3, 26, 13, 5)),
        ("2025-03-26T14:05+02:00", dt.datetime(2025, 3, 26, 12, 5)), ("2025-03-26T14:05:00z", dt.datetime(2025, 3, 26, 14, 5)),
        ("2025-03-26T14:05:00-0530", dt.datetime(2025, 3, 26, 19, 35)),
        ("2025-03-26 14:05:00 Nowhere/Land", None), ("2025-03-26 14:05:00 later", None), ("2025-03-26Z", None),
        ("2025-03-26 14:05:00+99:00", None), ("2025-13-26 14:05:00", None),
        ("9999999999999999", None), ("99999999999999999999999", None), ("junk", None), ("", None), (None, None),
    ],
)
def test_auto_time(spark, any_zone, written, time):
    assert value(spark, times.auto_time(F.col("v").cast("string")), v=written) == time


@pytest.mark.parametrize("seconds", [0, 1, -1, 1743305400, -62135596800, 253402300799])
def test_epoch_and_back(spark, any_zone, seconds):
    assert value(spark, times.to_epoch(times.from_epoch(F.col("s"))), s=seconds) == seconds


def test_epoch_rounds_down(spark):
    time = F.col("t").cast("timestamp_ntz")
    assert value(spark, times.to_epoch(time), t="1969-12-31 23:59:59.5") == -1
    assert value(spark, times.to_epoch(time), t="1970-01-01 00:00:00.999999") == 0
    assert value(spark, times.to_epoch(time), t="9999-12-31 23:59:59.999999") == 253402300799


def test_epoch_beside_the_wall_clock_of_a_zone(spark, any_zone):
    local = times.local_from_epoch(F.col("s"), F.col("zone"))
    assert value(spark, local, s=1742979900, zone="Europe/Belgrade") == dt.datetime(2025, 3, 26, 10, 5)
    assert value(spark, times.epoch_from_local(local, F.col("zone")), s=1742979900, zone="Europe/Belgrade") == 1742979900


@pytest.mark.parametrize(
    "written, translated",
    [("Sunny", "Sunčano"), ("Light rain", "Slaba kiša"), ("sunny", "sunny"), ("Sunny ", "Sunny "), ("Fog", "Fog"), (None, None)],
)
def test_conditions(spark, written, translated):
    assert value(spark, text.translate_words(F.col("v").cast("string"), CONDITION_WORDS), v=written) == translated
    assert value(spark, text.translate_words(F.col("v").cast("string"), {}), v=written) == written


def test_every_report_country_has_a_name_in_the_lists():
    assert set(COUNTRY_WORDS.values()) == set(REPORT_COUNTRIES)


def test_dictionary_table(spark):
    words = spark.createDataFrame([("a", "A"), ("b", None), (None, "N")], "word string, meaning string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, v string")
    found = translate_with(df, "v", words)
    assert found.columns == ["id", "v"]
    assert sorted(map(tuple, found.collect())) == [(1, "A"), (2, "b"), (3, "c"), (4, None)]
    check_dictionary(words)
    with pytest.raises(ValueError, match="'a'"):
        check_dictionary(words.union(words))


@pytest.mark.parametrize(
    "city, folded", [("Šibenik", "Sibenik"), ("Čačak", "Cacak"), ("Đakovo", "Dakovo"), ("Niš", "Nis"), ("Pula", "Pula")]
)
def test_fold(spark, city, folded):
    assert value(spark, text.fold(F.col("c")), c=city) == folded


def test_consolidated_cities(spark):
    first = spark.createDataFrame([("Varazdin", "Croatia"), ("Belgrade", "Serbia RS"), ("Nis", "Serbia")], "city string, country string")
    second = spark.createDataFrame([("Varaždin", "Croatia"), ("Belgrade", "Serbia"), ("Niš", "Serbia"), ("Niš", "Serbia")], "city string, country string")
    found = consolidate_cities([first, second])
    assert sorted(map(tuple, found.collect())) == [
        ("Belgrade", "Srbija", "Belgrade", 2), ("Nis", "Srbija", "Niš", 3), ("Varazdin", "Hrvatska", "Varazdin", 2),
    ]


def test_spellings_are_counted_by_hash_before_they_are_grouped(spark):
    df = spark.createDataFrame([("a", "b")], "city string, country string")
    plan = consolidate_cities([df, df])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_enriched_cities(spark):
    cities = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "grad string, drzava string")
    replies = spark.createDataFrame(
        [("a", "x", 1, "old"), ("a", "x", 2, None), ("c", "y", 1, "other"), (None, "x", 1, "none")],
        "grad string, drzava string, n int, reply string",
    )
    found = enrich_cities(cities, replies, ["grad", "drzava"], ["n"])
    assert sorted(map(tuple, found.collect()), key=str) == [("a", "x", 2, None), ("b", "x", None, None), ("c", "x", None, None)]


def test_extracted_and_set_columns(spark):
    df = spark.createDataFrame([("Nis,Serbia",), ("nothing",), (",x",), (None,)], "line string")
    found = extract_columns(df, "line", r"^([^,]+),(.*)$", ["city", "country"])
    found = set_columns(found, source="list", upper=F.upper("city"))
    assert [tuple(row)[1:] for row in found.collect()] == [
        ("Nis", "Serbia", "list", "NIS"), (None, None, "list", None), (None, None, "list", None), (None, None, "list", None),
    ]


def test_lines_keep_empty_ones(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n"), (2, ""), (3, None)], "id int, text string")
    assert [tuple(row) for row in split_lines(df).collect()] == [
        (1, 0, "a"), (1, 1, ""), (1, 2, "b"), (1, 3, ""), (2, 0, ""),
    ]


def test_json_array(spark):
    texts = ['[{"a":1},{"a":2,"b":"x"}]', "[]", "junk", None, '[{"a":3},{"a"', '{"a":4}', '[{"a":"many","b":"y"},5,null,{"c":6}]', "", "null"]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "id int, body string")
    fields = [("a", "a", "int"), ("b", "b", "string")]
    assert sorted(map(tuple, split_json(df, "body", fields).collect())) == [(1, 0, 1, None), (1, 1, 2, "x"), (7, 0, None, "y")]
    aside = sorted((row.id, -1 if row.element_no is None else row.element_no, row.problems, row.raw) for row in split_json_rejected(df, "body", fields).collect())
    assert [row[:3] for row in aside] == [
        (3, -1, ["message"]), (5, -1, ["message"]), (6, -1, ["message"]),
        (7, 0, ["a"]), (7, 1, ["message"]), (7, 2, ["message"]), (7, 3, ["message"]), (8, -1, ["message"]), (9, -1, ["message"]),
    ]
    assert aside[0][3] == "junk" and aside[2][3] == '{"a":4}' and aside[4][3] == "5"


@pytest.mark.parametrize(
    "written, whole",
    [
        ("65", 65), ("65.0", 65), ("6.5e1", 65), (" -7 ", -7), ("+8", 8), ("1e3", 1000), ("65.5", None), ("1f", None), ("1d", None),
        ("0x1p3", None), ("1L", None), ("", None), ("NaN", None), ("Infinity", None), ("junk", None), (None, None),
    ],
)
def test_whole_numbers_read_alike(spark, written, whole):
    for kind in ("int", "bigint"):
        assert value(spark, whole_from_text(F.col("v").cast("string"), kind), v=written) == whole


def test_range_of_whole_numbers(spark):
    for kind, bits in (("int", 31), ("bigint", 63)):
        for number, fits in ((2**bits - 1, True), (-(2**bits), True), (2**bits, False), (-(2**bits) - 1, False)):
            assert value(spark, whole_from_text(F.col("v"), kind), v=f"{number}.0") == (number if fits else None)


@pytest.mark.parametrize("written, real", [("1.5", 1.5), ('"1.5"', 1.5), ("1e2", 100.0), ("1.5d", None), ("0x1p3", None), ("warm", None)])
def test_written_reals(spark, written, real):
    assert value(spark, typed(F.col("v"), "double"), v=written) == real


def test_json_path(spark):
    body = '{"a":{"b":1.5,"c":null},"d":[{"e":"x"}]}'
    for path, found in (("$.a.b", "1.5"), ("$.a.c", None), ("$.z", None), ("$.d[0].e", "x")):
        assert value(spark, json_path(F.col("v"), path), v=body) == found


@pytest.mark.parametrize(
    "written",
    ["1e-30", "5.0000000000000000000001", "-0.5e0", "65e-1", "1234e-3", "0.00000000000000000001", "1.05e1", "10.5", "5e-324", "1e-999"],
)
def test_a_fraction_however_small_is_no_whole_number(spark, written):
    for kind in ("int", "bigint"):
        assert value(spark, whole_from_text(F.col("v").cast("string"), kind), v=written) is None


@pytest.mark.parametrize(
    "written, whole",
    [
        ("650e-1", 65), ("0.65e2", 65), (".5e1", 5), ("0e-30", 0), ("-0.000", 0), ("00012", 12), ("5.000000000000000000000000000000", 5),
        ("1000000000000000000000e-20", 10), ("0.0e-5", 0), ("\t12\n", 12), ("12.", 12),
    ],
)
def test_whole_numbers_in_other_forms(spark, written, whole):
    for kind in ("int", "bigint"):
        assert value(spark, whole_from_text(F.col("v").cast("string"), kind), v=written) == whole


def test_json_arrays_with_something_behind_them_are_set_aside(spark):
    clean = ['[{"line":"a"}]', ' [ {"line":"a"} , {"line":"b"} ] ', "[]"]
    spoiled = [
        '[{"line":"a"}],"z":1', '[{"line":"b"}]} junk', '[{"line":"d"}],"items":[{"line":"e"}]', '[{"line":"a"}] junk', '[{"line":"a"}],[1]',
        '[{"line":"a"}],["x"]] []', '[{"line":"a"}]]', '[[{"line":"a"}]', "null", '"[]"', "",
    ]
    df = spark.createDataFrame([(n, text) for n, text in enumerate(clean + spoiled)], "id int, body string").repartition(3)
    fields = [("line", "line", "string")]
    assert sorted(map(tuple, split_json(df, "body", fields).collect())) == [(0, 0, "a"), (1, 0, "a"), (1, 1, "b")]
    aside = split_json_rejected(df, "body", fields).orderBy("id").collect()
    assert [(row.id, row.raw, row.problems) for row in aside] == [(n + 3, text, ["message"]) for n, text in enumerate(spoiled)]
