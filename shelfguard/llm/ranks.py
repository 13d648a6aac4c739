"""Row numbers inside groups of any size.

Rows are dealt to ranges of (group, order) and sorted, so a group that holds a third of
all rows spreads over a third of the ranges. A stream over each range numbers its rows,
the rows of every (group, range) are counted, and running sums of these counts (one small row each) give
every range its offset: no task sees a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import stage


def numbered_in_groups(
    df: DataFrame, group: str, order: Sequence[str], name: str, deal: Sequence[str] | None = None, keep: Sequence[Column | str] = ("*",)
) -> DataFrame:
    """``df`` with ``idx`` (0, 1 ... by ``order`` inside ``group``, nulls first) and ``n`` (rows of the group).

    ``group`` is a column without nulls. ``deal`` are the columns that ranges are cut by (``order``
    unless given; they must not contradict it): rows equal in them stay in one range. ``keep`` are the
    columns to go on with, made once the rows are in order.
    """
    ranged = df.repartitionByRange(group, *(order if deal is None else deal)).sortWithinPartitions(group, *order).select(*keep)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group)
            fresh = np.empty(batch.num_rows, dtype=bool)
            fresh[0] = keys[0].as_py() != last
            if batch.num_rows > 1:
                fresh[1:] = pa.compute.not_equal(keys.slice(1), keys.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            at = np.arange(batch.num_rows)
            # Where each row's group starts in this batch; before it, for the one carried over.
            start = np.maximum.accumulate(np.where(fresh, at, -1))
            idx = np.where(start < 0, at + count, at - start)
            last, count = keys[-1].as_py(), int(idx[-1]) + 1
            where = pa.array(np.full(batch.num_rows, own, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(idx.astype(np.int64)), where], [*batch.schema.names, "idx", "_range"])

    schema = T.StructType([*ranged.schema.fields, T.StructField("idx", T.LongType()), T.StructField("_range", T.IntegerType())])
    ranged = stage(ranged.mapInArrow(number, schema), f"{name}-ranges")
    counts = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_range")
    counts = counts.select(
        group, "_range",
        (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    counts = stage(counts, f"{name}-offsets")
    return ranged.join(counts, [group, "_range"]).withColumn("idx", F.col("idx") + F.col("_before")).drop("_range", "_before")
