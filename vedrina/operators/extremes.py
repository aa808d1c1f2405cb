"""The rows that hold a group's largest and smallest measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vedrina.operators.rows import in_countries, with_values
from vedrina.schemas import EXTREMES_KEYS, REPORT_COUNTRIES
from vedrina.shared import written

# Ties go to the smallest name, then the earliest time, then the smallest condition.
TIE_ORDER = ["grad", "lokalno_vreme", "stanje"]
HIGHEST, LOWEST = "max_value", "min_value"
# Names inside the plans that an input does not use.
_AT_TOP, _AT_BOTTOM = "_at_top", "_at_bottom"
_HIGHEST, _LOWEST = "_highest", "_lowest"
_COUNTED = "_counted"


def _measured(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """The rows that take part: those with all keys and the measure."""
    return with_values(df, [*keys, measure])


def extreme_values(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Largest and smallest measure per group: a hash aggregate over the keys and one number."""
    return _measured(df, keys, measure).groupBy(*keys).agg(
        F.max(measure).alias(HIGHEST), F.min(measure).alias(LOWEST)
    )


def _with_values(df: DataFrame, keys: list[str], measure: str, values_path: str) -> DataFrame:
    """Every row of ``df`` with its group's values under names of their own.

    The values are written to ``values_path`` (in the shared folder) first. The planner then sees
    their real size: it broadcasts them below its threshold and leaves ``df`` in place, and above it
    shuffles two plain inputs, where adaptive execution splits a hot group's partition.
    """
    values = extreme_values(df, keys, measure)
    values = values.withColumnsRenamed({HIGHEST: _HIGHEST, LOWEST: _LOWEST})
    return df.join(written(values, values_path), keys)


def agg_join_back(df: DataFrame, keys: list[str], measure: str, values_path: str) -> DataFrame:
    """Every row of ``df`` with its group's largest and smallest measure, as ``max_value`` and ``min_value``. Columns of
    the input with these names are replaced."""
    rows = _with_values(df.drop(HIGHEST, LOWEST) if measure not in (HIGHEST, LOWEST) else df, keys, measure, values_path)
    kept = [name for name in df.columns if name not in (HIGHEST, LOWEST)]
    return rows.select(*kept, F.col(_HIGHEST).alias(HIGHEST), F.col(_LOWEST).alias(LOWEST))


def _tied(df: DataFrame, keys: list[str], measure: str, values_path: str) -> DataFrame:
    rows = _with_values(_measured(df, keys, measure), keys, measure, values_path)
    at_top, at_bottom = F.col(measure) == F.col(_HIGHEST), F.col(measure) == F.col(_LOWEST)
    return rows.filter(at_top | at_bottom).select(*df.columns, at_top.alias(_AT_TOP), at_bottom.alias(_AT_BOTTOM))


def extreme_ties(df: DataFrame, keys: list[str], measure: str, values_path: str) -> DataFrame:
    """All rows that hold their group's largest or smallest measure, tied rows included, with ``is_highest`` and
    ``is_lowest``. Columns of the input with these names are replaced."""
    kept = [name for name in df.columns if name not in ("is_highest", "is_lowest")]
    tied = _tied(df, keys, measure, values_path)
    return tied.select(*kept, F.col(_AT_TOP).alias("is_highest"), F.col(_AT_BOTTOM).alias("is_lowest"))


def _one_pass(df: DataFrame, keys: list[str], measure: str, order: list[str], *more) -> DataFrame:
    """Both picks in one aggregation: the least of (rank of the measure, tie order) per group."""
    value, kind = F.col(measure), df.schema[measure].dataType
    # NaN is the largest number; negated it would come last, so it is ranked by a flag.
    not_nan = ~F.isnan(value) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.lit(True)
    reverse = _reversed(kind)
    # Aliases by position: a struct may not repeat a name, and the order columns may include any.
    ties = [F.col(name).alias(f"by{n}") for n, name in enumerate(order)]
    top = F.min(F.struct(not_nan.alias("not_nan"), reverse(value).alias("reversed"), *ties))
    bottom = F.min(F.struct(value.alias("value"), *ties))
    picks = _measured(df, keys, measure).groupBy(*keys).agg(top.alias("top"), bottom.alias("bottom"), *more)
    others = [name for name in picks.columns if name not in keys]
    return picks.select(*keys, reverse(F.col("top.reversed")).alias(HIGHEST), F.col("bottom.value").alias(LOWEST), *others)


def extreme_state(df: DataFrame, keys: list[str], measure: str, order: list[str]) -> DataFrame:
    """Per group what ``merged_state`` needs to go on from: ``top`` and ``bottom``, the row at each extreme as a struct that is
    least where the row is picked, and ``n``, the number of rows."""
    picks = _one_pass(df.withColumn(_COUNTED, F.lit(1)), keys, measure, order, F.count(_COUNTED).alias("n"))
    return picks.select(*keys, "top", "bottom", "n")


def merged_state(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of the same groups over different rows, as one state over all of them."""
    return states.groupBy(*keys).agg(F.min("top").alias("top"), F.min("bottom").alias("bottom"), F.sum("n").alias("n"))


def from_state(states: DataFrame, keys: list[str], order: list[str], kind: T.DataType) -> DataFrame:
    """The result of ``group_extremes`` from states, and ``n``; ``kind`` is the type of the measure."""
    top, bottom = _chosen("top", order), _chosen("bottom", order)
    highest = _reversed(kind)(F.col("top.reversed")).alias(HIGHEST)
    return states.select(*keys, highest, F.col("bottom.value").alias(LOWEST), *top, *bottom, "n")


def _chosen(side: str, order: list[str]) -> list:
    return [F.col(f"{side}.by{n}").alias(f"{side}_{name}") for n, name in enumerate(order)]


def _reversed(kind: T.DataType):
    # Turns the order round and is its own inverse; the smallest whole number has no negative.
    return F.bitwise_not if isinstance(kind, T.IntegralType) else F.negative


def _two_pass(df: DataFrame, keys: list[str], measure: str, order: list[str], values_path: str) -> DataFrame:
    """The values first, by a hash aggregate; then the tie order, among the rows that hold them."""
    at_extreme = _tied(df, keys, measure, values_path)
    ties = F.struct(*[F.col(name).alias(f"by{n}") for n, name in enumerate(order)])
    value = F.col(measure)
    return at_extreme.groupBy(*keys).agg(
        F.max(value).alias(HIGHEST),
        F.min(F.when(F.col(_AT_TOP), ties)).alias("top"),
        F.min(value).alias(LOWEST),
        F.min(F.when(F.col(_AT_BOTTOM), ties)).alias("bottom"),
    )


def group_extremes(
    df: DataFrame, keys: list[str], measure: str, order: list[str], values_path: str | None = None
) -> DataFrame:
    """Per group: the largest and smallest measure, and the ``order`` columns of the row that holds
    each, as ``top_<column>`` and ``bottom_<column>``.

    Rows without key or measure are left out. Ties go to the row that is least by ``order``. Tasks
    pre-aggregate in both forms, so a hot group shuffles one row per task:

    * without ``values_path``, one aggregation over one scan. Its buffers hold text, so Spark sorts
      each task's rows. Best when ``df`` is costly to compute twice (joins) or small.
    * with ``values_path``, two scans and no sort: a hash aggregate of the numbers, then a join that
      keeps the rows at an extreme. Best for a large stored table, one that does not change
      between the scans. The result reads ``values_path``: give each result a path of its own.
    """
    order = list(order)
    if values_path is None:
        picks = _one_pass(df, keys, measure, order)
    else:
        picks = _two_pass(df, keys, measure, order, values_path)
    return picks.select(*keys, HIGHEST, LOWEST, *_chosen("top", order), *_chosen("bottom", order))


def hottest(df: DataFrame, keys: list[str] = EXTREMES_KEYS, values_path: str | None = None) -> DataFrame:
    """The hottest city per group."""
    picks = group_extremes(df, keys, "temperatura", TIE_ORDER, values_path)
    return picks.select(
        *keys,
        F.col("top_grad").alias("najtopliji_grad"),
        F.col(HIGHEST).alias("max_temperatura"),
        F.col("top_stanje").alias("stanje_najtoplijeg"),
    )


def coldest(df: DataFrame, keys: list[str] = EXTREMES_KEYS, values_path: str | None = None) -> DataFrame:
    """The coldest city per group."""
    picks = group_extremes(df, keys, "temperatura", TIE_ORDER, values_path)
    return picks.select(
        *keys,
        F.col("bottom_grad").alias("najhladniji_grad"),
        F.col(LOWEST).alias("min_temperatura"),
        F.col("bottom_stanje").alias("stanje_najhladnijeg"),
    )


def join_sides(hot: DataFrame, cold: DataFrame, keys: list[str] = EXTREMES_KEYS) -> DataFrame:
    """Two per-group results side by side. Both are already spread by the keys, so nothing moves."""
    return hot.join(cold, keys)


def daily_extremes(
    df: DataFrame,
    countries: list[str] | None = REPORT_COUNTRIES,
    keys: list[str] = EXTREMES_KEYS,
    values_path: str | None = None,
) -> DataFrame:
    """The daily report: hottest and coldest city per date and country, of the listed countries
    (all of them for None)."""
    rows = df if countries is None else in_countries(df, countries)
    return report_columns(group_extremes(rows, keys, "temperatura", TIE_ORDER, values_path), keys)


def report_columns(picks: DataFrame, keys: list[str] = EXTREMES_KEYS) -> DataFrame:
    """The extremes of groups in the columns of the report."""
    return picks.select(
        *keys,
        F.col("top_grad").alias("najtopliji_grad"),
        F.col(HIGHEST).alias("max_temperatura"),
        F.col("top_stanje").alias("stanje_najtoplijeg"),
        F.col("bottom_grad").alias("najhladniji_grad"),
        F.col(LOWEST).alias("min_temperatura"),
        F.col("bottom_stanje").alias("stanje_najhladnijeg"),
    )
