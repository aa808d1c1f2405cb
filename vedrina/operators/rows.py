"""Filters and row-wise reshaping."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.functions.json_fields import read_elements, whole_array
from vedrina.functions.text import extract
from vedrina.operators.parsing import FINDINGS, PROBLEMS, RAW, READABLE, UNREADABLE, parse_messages
from vedrina.schemas import REPORT_COUNTRIES


def with_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that have a value in every listed column. Plain null tests, which a scan can push
    down; ``dropna`` counts nulls instead, which it cannot."""
    return df.filter(reduce(and_, [F.col(name).isNotNull() for name in columns]))


def in_countries(df: DataFrame, countries: list[str] = REPORT_COUNTRIES, column: str = "drzava") -> DataFrame:
    """The rows of the listed countries; rows without a country drop out."""
    return df.filter(F.col(column).isin(*countries))


def split_lines(df: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of a text column, numbered from 0; empty lines count."""
    others = [name for name in df.columns if name != column]
    lines = F.posexplode(F.split(F.col(column), "\n", -1)).alias("line_no", "line")
    return df.select(*others, lines)


def parse_json_arrays(df: DataFrame, column: str, fields: list[tuple[str, str, str]]) -> DataFrame:
    """One row per element of a JSON array of objects, numbered from 0, and one (without number) for a text that is
    no array; none is dropped here. ``fields`` and the columns of the findings are those of ``parse_messages``; the
    problem of a text that is no array is ``message``, too. An empty array and a null give no row."""
    others = [name for name in df.columns if name != column]
    read = df.select(*others, F.col(column).alias("_array"), F.explode(F.array(read_elements(F.col(column)))).alias("_read"))
    whole = whole_array(F.col("_read"), F.col("_array"))
    # A text that is no array takes the place of its one element, which cannot be read either.
    items = F.when(whole, F.element_at("_read", 1)).otherwise(F.array(F.col("_array")))
    elements = read.filter(F.col("_array").isNotNull()).select(*others, whole.alias("_whole"), F.posexplode(items).alias("_place", "_element"))
    parsed = parse_messages(elements, fields, "_element", [*others, "_whole", "_place", "_element"])
    readable = F.col("_whole") & F.col(READABLE)
    return parsed.select(
        *others,
        F.when(F.col("_whole"), F.col("_place")).alias("element_no"),
        *[name for _, name, _ in fields],
        readable.alias(READABLE),
        F.when(F.col("_whole"), F.col(PROBLEMS)).otherwise(F.array(F.lit(UNREADABLE))).alias(PROBLEMS),
        F.when(F.col("_whole"), F.col(RAW)).otherwise(F.col("_element")).alias(RAW),
    )


def split_json(df: DataFrame, column: str, fields: list[tuple[str, str, str]]) -> DataFrame:
    """The readable elements of JSON arrays, misfit fields as null; see ``split_json_rejected`` for the others."""
    return parse_json_arrays(df, column, fields).filter(READABLE).drop(*FINDINGS)


def split_json_rejected(df: DataFrame, column: str, fields: list[tuple[str, str, str]]) -> DataFrame:
    """The texts that are no arrays, the elements that are no such objects, and those with misfit fields."""
    return parse_json_arrays(df, column, fields).filter(F.size(PROBLEMS) > 0)


def extract_columns(df: DataFrame, column: str, pattern: str, names: list[str]) -> DataFrame:
    """One new column per group of the pattern; null where the text does not match."""
    groups = {name: extract(F.col(column), pattern, n) for n, name in enumerate(names, start=1)}
    return df.withColumns(groups)


def set_columns(df: DataFrame, **values: Any) -> DataFrame:
    """Add or replace columns by constants or expressions."""
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()}
    )
