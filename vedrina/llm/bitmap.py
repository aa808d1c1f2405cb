"""A set of hashes as a bitmap of fixed size, to filter rows without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^27 bits in pages of 2^15: at most 4,096 rows of 4 KB, so 16 MB, whatever the input's size.
BITS = 27
PAGE_BITS = 15
PAGE, PAGE_BYTES = "_page", "_page_bytes"


def _place(key: Column) -> Column:
    return F.pmod(key, F.lit(1 << BITS))


def bitmap_of(keys: DataFrame, key: Column) -> DataFrame:
    """The pages of the bitmap in which the bits of all ``key`` values (bigint hashes) are set."""
    place = _place(key)
    return keys.groupBy(F.shiftright(place, PAGE_BITS).alias(PAGE)).agg(
        F.bitmap_construct_agg(place.bitwiseAND((1 << PAGE_BITS) - 1)).alias(PAGE_BYTES)
    )


def with_membership(rows: DataFrame, key: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column: false if the key is not in the set for sure. Some keys that are
    not in it get true, more of them as the bitmap fills."""
    place = _place(key)
    bit = place.bitwiseAND((1 << PAGE_BITS) - 1)
    byte = F.substring(F.col(PAGE_BYTES), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    byte = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1
    joined = rows.join(F.broadcast(bitmap), F.shiftright(place, PAGE_BITS) == F.col(PAGE), "left")
    return joined.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(PAGE, PAGE_BYTES)
