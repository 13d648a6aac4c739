"""Hourly detail arrays carried by the daily feed.

The split of a daily amount over the fixed hourly weights is written out as an array of 24 plain
expressions: unlike a lambda of ``transform``, which Spark interprets value by value, these are
generated code. The hourly stock-out mask is picked from an array of constants: 24 conditions a row would make the
generated method of a feed too long for the JVM to compile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from shelfguard import config as C

HOURS_SALE_TYPE = ArrayType(DoubleType())
HOURS_STOCK_TYPE = ArrayType(LongType())


def hourly_profile(daily_amount: Column, rare: bool = False) -> Column:
    """24 values: round(amount * weight / total weight, 4).

    ``rare``: for a branch that few rows take. It is interpreted there, and adds little to the code of the others.
    """
    total = F.lit(C.HOURLY_WEIGHT_TOTAL)
    if rare:
        return F.transform(F.array(*map(F.lit, C.HOURLY_WEIGHTS)), lambda w: F.round(daily_amount * w / total, 4))
    return F.array(*[F.round(daily_amount * F.lit(w) / total, 4) for w in C.HOURLY_WEIGHTS])


def hourly_stock_status(stockout_hours: Column) -> Column:
    """24 flags: 1 for hours 22-n .. 21, else 0."""
    last = C.STOCKOUT_LAST_HOUR
    masks = [F.array(*[F.lit(int(last - n < h <= last)).cast("long") for h in range(24)]) for n in range(last + 2)]
    known = F.greatest(F.lit(0), F.least(F.lit(last + 1), F.coalesce(stockout_hours, F.lit(0))))
    return F.element_at(F.array(*masks), (known + 1).cast("int"))


def _parsed(text: Column, kind: ArrayType) -> Column:
    """Spark interprets ``from_json`` and all that is written out below it: naming the text twice keeps its
    making a step of its own, in generated code."""
    return F.when(text.isNotNull(), F.from_json(text, kind))


def parse_hours_sale(text: Column) -> Column:
    return _parsed(text, HOURS_SALE_TYPE)


def parse_hours_stock(text: Column) -> Column:
    return _parsed(text, HOURS_STOCK_TYPE)


def explode_hours(df: DataFrame, keep: list[str], arrays: dict[str, Column]) -> DataFrame:
    """One row per hour: ``keep`` columns, ``hour`` (0-23) and one value per array."""
    zipped = F.arrays_zip(*[arr.alias(name) for name, arr in arrays.items()])
    exploded = df.select(*keep, F.posexplode(zipped).alias("hour", "_h"))
    return exploded.select(*keep, F.col("hour").cast("int").alias("hour"), *[F.col("_h")[name].alias(name) for name in arrays])
