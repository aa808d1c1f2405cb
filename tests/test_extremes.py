import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from vedrina.operators import extremes as ex
from vedrina.operators.dictionary import translate_with
from vedrina.operators.rows import in_countries
from vedrina.plans.observations import observations
from vedrina.schemas import REPORT_COUNTRIES

SCHEMA = "datum date, drzava string, grad string, temperatura double, stanje string, lokalno_vreme timestamp_ntz"
DAY = dt.date(2025, 3, 26)


def at(hour):
    return dt.datetime(2025, 3, 26, hour)


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def report(df, path, form, countries=None):
    values_path = path("values") if form == "two_pass" else None
    return ex.daily_extremes(df, countries, values_path=values_path)


both_forms = pytest.mark.parametrize("form", ["one_pass", "two_pass"])


@both_forms
def test_tie_goes_to_smallest_city_then_earliest_time(spark, path, form):
    df = rows_of(
        spark,
        (DAY, "Srbija", "Nis", 20.0, "b", at(3)),
        (DAY, "Srbija", "Beograd", 20.0, "late", at(9)),
        (DAY, "Srbija", "Beograd", 20.0, "early", at(2)),
        (DAY, "Srbija", "Uzice", 1.0, "x", at(1)),
        (DAY, "Srbija", "Sombor", 1.0, "y", at(4)),
    )
    [row] = report(df, path, form).collect()
    assert (row.najtopliji_grad, row.max_temperatura, row.stanje_najtoplijeg) == ("Beograd", 20.0, "early")
    assert (row.najhladniji_grad, row.min_temperatura, row.stanje_najhladnijeg) == ("Sombor", 1.0, "y")


@both_forms
def test_null_and_nan_measures(spark, path, form):
    df = rows_of(
        spark,
        (DAY, "A", "one", None, "s", at(1)),
        (DAY, "A", "two", 5.0, "s", at(1)),
        (DAY, "B", "all null", None, "s", at(1)),
        (DAY, "C", "nan", math.nan, "s", at(1)),
        (DAY, "C", "real", 9.0, "s", at(1)),
        (DAY, "D", "nan only", math.nan, "s", at(1)),
        (DAY, "E", "minus", -3.0, "s", at(1)),
        (DAY, "E", "zero", 0.0, "s", at(1)),
    )
    found = {row.drzava: row for row in report(df, path, form).collect()}
    assert set(found) == {"A", "C", "D", "E"}
    assert found["A"].najtopliji_grad == found["A"].najhladniji_grad == "two"
    assert found["C"].najtopliji_grad == "nan" and math.isnan(found["C"].max_temperatura)
    assert found["C"].najhladniji_grad == "real"
    assert math.isnan(found["D"].max_temperatura) and math.isnan(found["D"].min_temperatura)
    assert (found["E"].max_temperatura, found["E"].min_temperatura) == (0.0, -3.0)


@both_forms
def test_null_keys_and_other_countries_are_absent(spark, path, form):
    df = rows_of(
        spark,
        (None, "Srbija", "no date", 50.0, "s", at(1)),
        (DAY, None, "no country", 50.0, "s", at(1)),
        (DAY, "Italija", "Rim", 50.0, "s", at(1)),
        (DAY, "Srbija", "Nis", 5.0, None, at(1)),
    )
    [row] = report(df, path, form, REPORT_COUNTRIES).collect()
    assert row.asDict() == {
        "datum": DAY,
        "drzava": "Srbija",
        "najtopliji_grad": "Nis",
        "max_temperatura": 5.0,
        "stanje_najtoplijeg": None,
        "najhladniji_grad": "Nis",
        "min_temperatura": 5.0,
        "stanje_najhladnijeg": None,
    }


def rough(spark):
    """The check observations with ties, nulls and NaN worked in."""
    value = F.round("temperatura", -1)
    return (
        observations(spark, SF_DIR)
        .withColumn("temperatura", F.when(F.col("vlaznost") == 3, None).when(F.col("vlaznost") == 7, math.nan).otherwise(value))
        .withColumn("drzava", F.when(F.col("vlaznost") != 11, F.col("drzava")))
    )


def comparable(rows):
    """NaN equals itself here."""
    return sorted(tuple(repr(value) for value in row) for row in rows)


def by_hand(rows):
    """The report worked out row by row: NaN above all numbers, ties to the first by name, time, condition."""
    groups = {}
    for row in rows:
        if None not in (row.datum, row.drzava, row.temperatura):
            groups.setdefault((row.datum, row.drzava), []).append(row)
    found = []
    for key, members in groups.items():
        ranked = [((math.isnan(r.temperatura), 0 if math.isnan(r.temperatura) else r.temperatura), r) for r in members]
        picked = []
        for extreme in (max(rank for rank, _ in ranked), min(rank for rank, _ in ranked)):
            tied = [r for rank, r in ranked if rank == extreme]
            first = min(tied, key=lambda r: (r.grad, r.lokalno_vreme, r.stanje))
            picked += [first.grad, first.temperatura, first.stanje]
        found.append((*key, *picked))
    return found


@both_forms
def test_same_report_as_by_hand(spark, path, form):
    df = rough(spark)
    assert comparable(report(df, path, form).collect()) == comparable(by_hand(df.collect()))


def test_columns_called_like_those_inside_the_plans(spark, path):
    df = rough(spark)
    clashing = df.withColumns({name: F.lit(7) for name in ("max_value", "min_value", "is_highest", "is_lowest")})
    for values_path in (None, path("values")):
        assert comparable(ex.daily_extremes(clashing, None, values_path=values_path).collect()) == comparable(
            ex.daily_extremes(df, None).collect()
        )
    ties = ex.extreme_ties(clashing, ["datum", "drzava"], "temperatura", path("ties"))
    assert ties.columns == [*df.columns, "max_value", "min_value", "is_highest", "is_lowest"]
    assert ties.filter("is_highest").count() > 0
    joined = ex.agg_join_back(clashing, ["datum", "drzava"], "temperatura", path("joined"))
    assert joined.columns.count("max_value") == 1 and joined.filter("max_value > 7").count() > 0


def test_forms_agree_and_partitioning_does_not_matter(spark, path):
    df = rough(spark)
    one = comparable(ex.daily_extremes(df, None).collect())
    assert one == comparable(ex.daily_extremes(df.repartition(13), None).collect())
    assert one == comparable(ex.daily_extremes(df, None, values_path=path("values")).collect())


def test_other_measure_types(spark, path):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a', 5, CAST(1.5 AS DECIMAL(5,2))), (1, 'b', 7, CAST(2.5 AS DECIMAL(5,2))) AS t(k, n, i, d)"
    )
    for measure, high in (("i", 7), ("d", 2.5)):
        for values_path in (None, path(measure)):
            [row] = ex.group_extremes(df, ["k"], measure, ["n"], values_path).collect()
            assert (row.top_n, row.bottom_n, float(row.max_value)) == ("b", "a", high)


def test_smallest_whole_numbers(spark, path):
    for kind, least in (("int", -(2**31)), ("bigint", -(2**63))):
        df = spark.createDataFrame([("a", least), ("b", 5), ("c", 2)], f"n string, v {kind}").withColumn("k", F.lit(1))
        for values_path in (None, path(kind)):
            [row] = ex.group_extremes(df, ["k"], "v", ["n"], values_path).collect()
            assert (row.max_value, row.top_n, row.min_value, row.bottom_n) == (5, "b", least, "a")


def test_ties_keep_every_tied_row(spark, path):
    df = rows_of(
        spark,
        (DAY, "A", "x", 2.0, "s", at(1)),
        (DAY, "A", "y", 2.0, "s", at(2)),
        (DAY, "A", "z", 1.0, "s", at(3)),
        (DAY, "A", "w", 1.5, "s", at(3)),
        (DAY, "A", "v", None, "s", at(3)),
    )
    found = ex.extreme_ties(df, ex.EXTREMES_KEYS, "temperatura", path("values")).collect()
    assert sorted((r.grad, r.is_highest, r.is_lowest) for r in found) == [
        ("x", True, False), ("y", True, False), ("z", False, True),
    ]


def test_join_back_keeps_rows_without_measure(spark, path):
    df = rows_of(spark, (DAY, "A", "x", 2.0, "s", at(1)), (DAY, "A", "v", None, "s", at(3)))
    found = ex.agg_join_back(df, ex.EXTREMES_KEYS, "temperatura", path("values")).collect()
    assert sorted((r.grad, r.max_value, r.min_value) for r in found) == [("v", 2.0, 2.0), ("x", 2.0, 2.0)]


# Plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, path):
    target = path("observations")
    observations(spark, SF_DIR).write.partitionBy("datum").parquet(target)
    return spark.read.parquet(target)


def test_one_pass_has_one_shuffle_and_pushes_the_country_filter(spark, path):
    plan = plan_of(ex.daily_extremes(stored(spark, path), ["NATION_3", "NATION_7"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastExchange" not in plan
    assert "partial_min" in plan
    assert "In(drzava, [NATION_3,NATION_7])" in plan and "IsNotNull(temperatura)" in plan
    assert "vlaznost" not in plan and "region" not in plan


def test_two_pass_counts_by_hash_and_leaves_the_table_in_place(spark, path):
    df = stored(spark, path)
    values = plan_of(ex.extreme_values(df, ex.EXTREMES_KEYS, "temperatura"))
    assert values.count("HashAggregate") == 2 and "SortAggregate" not in values
    plan = plan_of(ex.daily_extremes(df, None, values_path=path("values")))
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_joining_two_reports_moves_nothing_more(spark, path):
    df = stored(spark, path)
    plan = plan_of(ex.join_sides(ex.hottest(df), ex.coldest(df)))
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.fixture
def joins_by_shuffle(spark):
    """No broadcast, and small limits above which a partition counts as hot."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_rows(spark, path, keys):
    """200,000 rows, a third of them under the key 0."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % keys)
    pad = F.sha2(F.col("id").cast("string"), 256).alias("pad")
    rows = spark.range(0, 200_000, 1, 8).select("id", hot.alias("k"), F.rand(1).alias("v"), pad)
    rows.write.parquet(path("hot"))
    return spark.read.parquet(path("hot"))


def test_hot_group_is_split_when_joined_back_by_shuffle(spark, path, joins_by_shuffle):
    joined = ex.agg_join_back(hot_rows(spark, path, 500), ["k"], "v", path("values"))
    assert len(joined.collect()) == 200_000
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_hot_word_is_split_when_translated_by_shuffle(spark, path, joins_by_shuffle):
    rows = hot_rows(spark, path, 500).withColumn("k", F.col("k").cast("string"))
    words = spark.range(400).select(F.col("id").cast("string").alias("word"), F.concat(F.lit("w"), "id").alias("meaning"))
    translated = translate_with(rows, "k", words)
    found = translated.collect()
    assert len(found) == 200_000
    assert sum(row.k == "w0" for row in found) == rows.filter("k = '0'").count()
    assert "SortMergeJoin(skew=true)" in plan_of(translated)


def test_hot_city_is_split_when_observations_are_joined_by_shuffle(spark, path, joins_by_shuffle):
    events = hot_rows(spark, path, 1500).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.col("k").alias("user_id"),
        F.col("pad").alias("event_type"),
        F.col("v").alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    joined = observations(spark, SF_DIR, events)
    assert len(joined.select("event_id", "grad", "stanje").collect()) == 200_000
    report = ex.daily_extremes(joined, None)
    assert len(report.collect()) == 25
    assert "SortMergeJoin(skew=true)" in plan_of(report)


def test_country_filter_drops_null(spark):
    df = rows_of(spark, (DAY, None, "x", 1.0, "s", at(1)), (DAY, "BiH", "y", 1.0, "s", at(1)))
    assert [row.grad for row in in_countries(df).collect()] == ["y"]
