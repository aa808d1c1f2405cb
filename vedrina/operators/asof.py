"""As-of joins: every row meets the other side's last row at or before its own time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vedrina.operators.latest import latest_per_key
from vedrina.operators.rows import with_values
from vedrina.shared import new_path, written

# The functions that run in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def asof_join(
    rows: DataFrame,
    history: DataFrame,
    keys: list[str],
    time: str,
    columns: list[str],
    order: list[str] | None = None,
    history_time: str | None = None,
) -> DataFrame:
    """``rows`` with ``columns`` of the last row of ``history`` that has their keys and is not later than they are; nulls
    where there is none, and for rows without key or time.

    Of history rows with one key and time the last by ``order``, then by content, counts. Names in ``columns`` must not be
    columns of ``rows``.

    Both sides are put in order together, by range partitions of key and time, so a key with much of the rows lies over many
    tasks. A task carries the last history row of a key forward in its own partition. What it would have to know of earlier
    partitions is handed over per partition: at most one history row for each, and only for keys that a boundary cuts.
    """
    history_time = history_time or time
    past = with_values(history, [*keys, history_time]).select(*keys, F.col(history_time).alias("__time"), *(order or []), *[c for c in columns if c not in (order or [])])
    past = latest_per_key(past, [*keys, "__time"], order or [F.lit(0)], columns)
    names = [f"__k{n}" for n in range(len(keys))]
    complete = F.lit(True)
    for name in [*keys, time]:
        complete = complete & F.col(f"`{name}`").isNotNull()
    # Each side's columns travel as one, whatever their names are.
    row, found = F.struct(*[F.col(f"`{name}`") for name in rows.columns]), F.struct(*[F.col(name) for name in columns])
    left = rows.filter(complete).select(
        *[F.col(f"`{key}`").alias(name) for key, name in zip(keys, names)], F.col(f"`{time}`").alias("__time"), F.lit(1).alias("__side"), row.alias("row")
    )
    right = past.select(*[F.col(key).alias(name) for key, name in zip(keys, names)], "__time", F.lit(0).alias("__side"), found.alias("found"))
    both = left.unionByName(right, allowMissingColumns=True)
    # A history row comes before rows of its time.
    in_order = both.repartitionByRange(*names, "__time").sortWithinPartitions(*names, "__time", "__side")
    schema = T.StructType([T.StructField(name, both.schema[name].dataType) for name in [*names, "row", "found"]])
    schema = schema.add("part", T.IntegerType()).add("first", T.BooleanType()).add("last", T.BooleanType())
    carried = written(in_order.mapInArrow(_carried(names), schema), new_path(rows.sparkSession, "asof"))

    # The last history row of each key in a partition, for keys in more than one; a few rows a partition.
    ends = carried.filter("first or last").groupBy(*names, "part").agg(F.max_by("found", "last").alias("found"))
    cut = ends.groupBy(*names).agg(F.count("*").alias("parts")).filter("parts > 1").drop("parts")
    earlier = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.join(cut, names).select(*names, "part", F.last("found", ignorenulls=True).over(earlier).alias("before"))
    handed = written(handed.filter("before is not null"), new_path(rows.sparkSession, "asof-handed"))
    met = carried.filter("row is not null").join(handed, [*names, "part"], "left").select("row", F.coalesce("found", "before").alias("found"))
    kind = both.schema["found"].dataType
    alone = rows.filter(~complete).select(row.alias("row"), F.lit(None).cast(kind).alias("found"))
    return met.unionByName(alone).select(
        *[F.col("row").getField(name).alias(name) for name in rows.columns], *[F.col("found").getField(name).alias(name) for name in columns]
    )


def _carried(names: list[str]):
    """Rows of a partition, sorted, with the last ``found`` of their key so far, and marks on a key's first and last row."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        held: pa.Table | None = None
        before: pa.Table | None = None

        def filled(table: pa.Table, ended: bool) -> list[pa.RecordBatch]:
            """``before`` is the last row of the batch before, with its ``found`` filled in."""
            nonlocal before
            whole = table if before is None else pa.concat_tables([before, table]).combine_chunks()
            new = np.concatenate([[True], _differs(whole, names)])
            n = whole.num_rows
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(new, place, 0))
            known = np.maximum.accumulate(np.where(pc.is_valid(whole["found"]).to_numpy(), place, -1))
            known = np.where(known >= start, known, -1)
            found = whole["found"].take(pa.array(np.where(known < 0, 0, known), mask=known < 0))
            whole = whole.set_column(whole.schema.get_field_index("found"), "found", found)
            skip = 0 if before is None else 1
            if before is not None:
                new[0] = False
            last = np.concatenate([new[1:], [ended]])
            before = whole.slice(n - 1, 1)
            own = whole.slice(skip)
            result = own.select([*names, "row", "found"])
            result = result.append_column("part", pa.array(np.full(n - skip, part, np.int32)))
            result = result.append_column("first", pa.array(new[skip:])).append_column("last", pa.array(last[skip:]))
            return result.combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                # Whether the last row held ends its key is seen in the next batch.
                joined = pa.concat_tables([held.slice(held.num_rows - 1), table.slice(0, 1)])
                yield from filled(held, bool(_differs(joined, names)[0]))
            held = table
        if held is not None:
            yield from filled(held, True)

    return of_partition


def _differs(table: pa.Table, names: list[str]) -> np.ndarray:
    """For each row but the first whether its key is another than that of the row before."""
    different = np.zeros(max(0, table.num_rows - 1), bool)
    for name in names:
        column = table[name].combine_chunks()
        different |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return different
