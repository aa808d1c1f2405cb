"""Rows of megabytes: batches to Python and row groups of files stay small."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vedrina.shared import BATCH_LIMITS, LARGE_ROWS, small_batches, written


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])


def megabytes(spark, n):
    return spark.range(n, numPartitions=1).select(F.expr("cast(repeat('x', 1048576) as binary)").alias("raw"))


def test_batches(spark):
    with small_batches(spark):
        inside = [row.bytes for row in megabytes(spark, 20).mapInArrow(sizes, "bytes bigint").collect()]
    assert max(inside) < 6 << 20 and sum(inside) >= 20 << 20
    assert [row.bytes for row in megabytes(spark, 20).mapInArrow(sizes, "bytes bigint").collect()] == [pytest.approx(20 << 20, rel=0.01)]


def test_a_lower_setting_stays(spark):
    before = {name: spark.conf.get(name) for name in BATCH_LIMITS}
    lower = dict(zip(BATCH_LIMITS, ("64k", "4")))
    try:
        for name, value in lower.items():
            spark.conf.set(name, value)
        with small_batches(spark):
            assert {name: spark.conf.get(name) for name in BATCH_LIMITS} == lower
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert {name: spark.conf.get(name) for name in BATCH_LIMITS} == before


def test_row_groups(spark, path):
    digests = "transform(sequence(1, 16384), x -> sha2(cast(x + id * 16384 as string), 256))"
    random = spark.range(60, numPartitions=1).select(F.expr(f"cast(concat_ws('', {digests}) as binary)").alias("raw"))
    stored = written(random, path("rows"), **LARGE_ROWS)
    assert stored.count() == 60
    [file] = Path(path("rows")).glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert max(groups.row_group(k).total_byte_size for k in range(groups.num_row_groups)) < 24 << 20
