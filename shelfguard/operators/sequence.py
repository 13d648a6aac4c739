"""Row numbers in a global order without a single-task window.

The rows are range-partitioned and sorted by the order, written with the
number of their range, and counted per range. A range's rows are numbered on
their own; its offset is the sum of the counts before it (one small row per
range reaches the driver).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfguard.session import staged


def numbered(df: DataFrame, order: Sequence[str], out: str = "seq") -> DataFrame:
    """``df`` with ``out`` = 1..N in ``order`` (a total order gives a unique result)."""
    ranged = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["n"]) for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect())
    before = dict(zip([r for r, _ in sizes], accumulate([0, *[n for _, n in sizes]]), strict=False))
    if not before:
        return ranged.drop("_range").withColumn(out, F.lit(0).cast("long"))
    offset = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair])[F.col("_range").cast("long")]
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(out, offset + rank).drop("_range")


def dense_sequence(df: DataFrame, column: str, out: str = "seq") -> DataFrame:
    """Return ``(column, out)`` with ``out`` = rank of ``column`` among its distinct values."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(distinct, [column], out).withColumn(out, F.col(out).cast("int"))
