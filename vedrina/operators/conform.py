"""Rows cast to a table's column types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vedrina.functions.numbers import decimal, whole_from_real, whole_from_text

MISFITS = "misfits"

# The casts of a wide table, as one method of whole-stage code, exceed what the JVM compiles (8000 bytes) and would run
# as bytecode; beyond this limit Spark runs the operators one by one, in methods that are compiled.
METHOD_LIMIT_SETTING, METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", 8000


def conform_column(value: Column, source: T.DataType, data_type: str) -> Column:
    """The value, of type ``source``, in the given SQL type; null where it does not fit."""
    text_type = re.fullmatch(r"varchar\((\d+)\)", data_type)
    if text_type:
        text = value.cast("string")
        return F.when(F.char_length(text) <= int(text_type.group(1)), text)
    if data_type.startswith("decimal"):
        return decimal(value, data_type)
    if data_type in ("int", "bigint"):
        if isinstance(source, T.StringType):
            return whole_from_text(value, data_type)
        if isinstance(source, (T.FloatType, T.DoubleType)):
            return whole_from_real(value, data_type)
    return value.try_cast(data_type)


def conform(df: DataFrame, columns: list[tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """The listed (name, type) columns, absent ones as null.

    ``misfits`` names the columns whose value did not fit; it is empty for a clean row.
    """
    keep = keep or []
    sources = {field.name.lower(): field.dataType for field in df.schema.fields}
    present = [(name, data_type) for name, data_type in columns if name in sources]
    fitted = F.struct(
        *[conform_column(F.col(name), sources[name], data_type).alias(name) for name, data_type in present]
    )
    # Of the given values only whether there is one; the values themselves would be copied twice more.
    given = F.struct(*[F.col(name).isNotNull().alias(name) for name, _ in present])
    # Exploding the one struct keeps its casts from being repeated in ``misfits`` and in filters on it. The casts
    # stand in a projection before, since a generator outside of whole-stage code is interpreted.
    _limit_methods(df.sparkSession)
    cast = df.select(*keep, given.alias("_given"), fitted.alias("_cast"))
    rows = cast.select(*keep, "_given", F.explode(F.array("_cast")).alias("_fitted"))
    misfits = [
        F.when(F.col(f"_given.{name}") & F.col(f"_fitted.{name}").isNull(), F.lit(name))
        for name, _ in present
    ]
    return rows.select(
        *keep,
        *[
            F.col(f"_fitted.{name}") if name in sources else F.lit(None).cast(_plain(data_type)).alias(name)
            for name, data_type in columns
        ],
        # Not ``array_compact``, whose argument would be interpreted.
        F.array_except(F.array(*misfits), F.array(F.lit(None).cast("string"))).alias(MISFITS),
    )


def _limit_methods(spark: SparkSession) -> None:
    """Set the session's limit, which its other queries then have too; a lower one stays."""
    if int(spark.conf.get(METHOD_LIMIT_SETTING, "65535")) > METHOD_LIMIT:
        spark.conf.set(METHOD_LIMIT_SETTING, str(METHOD_LIMIT))


def _plain(data_type: str) -> str:
    return "string" if data_type.startswith("varchar") else data_type
