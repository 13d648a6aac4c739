"""Data layout by clustering columns for plain parquet: by ranges in their order, or by Z-order.

Range-partition on the clustering columns and sort inside each file, so each
file and row group covers a narrow min/max range and parquet statistics let
a filtered scan skip most of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clustered(
    df: DataFrame, cluster_by: Sequence[str], files: int | None = None, split_by: Sequence[str] = ()
) -> DataFrame:
    """Range-partition on ``cluster_by`` then ``split_by`` and sort within files.

    ``split_by`` (e.g. the rest of a unique key) only refines the range
    boundaries, so one clustering value holding a large share of the rows is
    still cut into many evenly sized files instead of one huge task.
    """
    keys = (*cluster_by, *split_by)
    # Without a fixed count AQE coalesces the range partitions to its target size.
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    files: int | None = None,
    mode: str = "overwrite",
    split_by: Sequence[str] = (),
) -> None:
    clustered(df, cluster_by, files, split_by).write.mode(mode).parquet(path)


# -- Z-order: a layout that filters on any of several columns can skip -----------------
#: Ranges per column: 2 ** ZORDER_BITS.
ZORDER_BITS = 6


def order_number(df: DataFrame, column: str) -> Column:
    """A number in the column's order (text: by its first seven bytes)."""
    kind, c = df.schema[column].dataType.simpleString(), F.col(column)
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.datediff(c, F.lit(date(1970, 1, 1))).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> dict[str, list[float]]:
    """Quantiles that cut each column into at most ``2 ** bits`` ranges of like size (one aggregation, a few numbers)."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(order_number(df, c), shares, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def range_number(number: Column, points: Sequence[float], bits: int) -> Column:
    """How many of the sorted ``points`` lie below ``number``, found by ``bits`` halvings; none below a null."""
    # Nothing exceeds the NaNs that fill the places up.
    places = F.array(*[F.lit(float(p)) for p in points], *[F.lit(float("nan"))] * (2**bits - 1 - len(points)))
    steps = F.array(*[F.lit(2**i) for i in reversed(range(bits))])
    halved = lambda x: F.aggregate(steps, F.lit(0), lambda r, step: r + F.when(x > F.element_at(places, r + step), step).otherwise(F.lit(0)))
    return F.element_at(F.transform(F.array(number), halved), 1)  # the transform names the number, else each halving made it anew


def zorder_key(df: DataFrame, cuts: dict[str, list[float]], bits: int = ZORDER_BITS) -> Column:
    """The bits of the columns' range numbers interleaved, highest first: near keys are near in every column.

    A range number is searched for and its bits, spread out, are looked up among constants: comparing with every
    cut point makes a generated method too long for the JVM to compile. Nulls belong to the first range.
    """
    key = F.lit(0).cast("long")
    for j, (c, points) in enumerate(cuts.items()):
        spread = [sum((n >> i & 1) << (i * len(cuts) + j) for i in range(bits)) for n in range(2**bits)]
        known = F.array(*[F.lit(x).cast("long") for x in spread])
        key = key.bitwiseOR(F.element_at(known, range_number(order_number(df, c), points, bits) + 1))
    return key


def zordered(
    df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), split_by: Sequence[str] = (), bits: int = ZORDER_BITS
) -> DataFrame:
    """``df`` dealt to ranges of the Z-order of ``columns`` (inside each value of ``within``) and sorted by it.

    ``split_by`` refines the ranges where many rows share a key.
    """
    if bits * len(columns) > 62:
        raise ValueError("the interleaved key has at most 62 bits")
    keyed = df.withColumn("_z", zorder_key(df, cut_points(df, columns, bits), bits))
    order = [*within, "_z", *split_by]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order, *columns).drop("_z")
