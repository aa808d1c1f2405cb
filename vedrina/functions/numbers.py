"""Numbers out of text and other numbers. Values that do not fit give null, and do so by a test:
a failing ``try_cast`` of a number raises and catches an exception per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A written number, as JSON and databases write it. The casts alone also take ``1f``, ``1.5d`` and ``0x1p3``.
WRITTEN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,3})?\s*$"
# Digits that any bigint can hold, also with zeros behind a point, and the parts of other written numbers.
PLAIN = r"^\s*[+-]?\d{1,18}(?:\.0*)?\s*$"
PARTS = r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,3}))?\s*$"
NOT_FINITE = r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$"

# The range of each whole-number type; the upper end is the first value beyond it.
WHOLE_RANGES = {"int": (-float(2**31), float(2**31)), "bigint": (-float(2**63), float(2**63))}


def whole_from_real(real: Column, data_type: str) -> Column:
    """A double without fraction, as a whole number."""
    low, beyond = WHOLE_RANGES[data_type]
    fits = (real >= low) & (real < beyond) & (real == F.floor(real))
    return F.when(fits, real.try_cast(data_type))


def whole_from_text(text: Column, data_type: str) -> Column:
    """A written whole number; ``65``, ``65.0`` and ``6.5e1`` are one. A fraction, however small, makes it none."""
    low, high = (-(2**31), 2**31 - 1) if data_type == "int" else (-(2**63), 2**63 - 1)
    # Most numbers are plain digits, which a bigint holds; one pattern tells them.
    plain = F.substring_index(text, ".", 1).try_cast("bigint")
    in_range = plain if data_type == "bigint" else F.when(plain.between(F.lit(low), F.lit(high)), plain).try_cast(data_type)
    number = F.when(text.rlike(WRITTEN) & _is_whole(text), text).try_cast("decimal(38,18)")
    fits = number.between(F.lit(low).cast("decimal(38,0)"), F.lit(high).cast("decimal(38,0)"))
    return F.when(text.rlike(PLAIN), in_range).otherwise(F.when(fits, number.try_cast(data_type)))


def _is_whole(text: Column) -> Column:
    """Whether a written number has no digit but 0 behind the point, once the exponent has moved it."""
    digits, fraction = F.regexp_extract(text, PARTS, 1), F.regexp_extract(text, PARTS, 2)
    exponent = F.coalesce(F.regexp_extract(text, PARTS, 3).try_cast("int"), F.lit(0))
    significant = F.rtrim(F.concat(digits, fraction), F.lit("0"))
    return (F.length(significant) == 0) | (F.length(significant) <= F.length(digits) + exponent)


def real_from_text(text: Column, data_type: str = "double") -> Column:
    """A written number, or one of the names of infinity and NaN."""
    return F.when(text.rlike(WRITTEN) | text.rlike(NOT_FINITE), text).try_cast(data_type)


def decimal(value: Column, data_type: str) -> Column:
    """Any number or written number as ``decimal(p,s)``, rounded half up to its scale. It goes through
    text, from which too large a number becomes null without an exception."""
    return value.cast("string").try_cast(data_type)
