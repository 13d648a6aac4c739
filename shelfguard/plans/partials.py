"""Daily partials of the mart: sums and counts that the dashboard's numbers are folded from.

One row per (date, region, category, tier). Every KPI, group and trend of the dashboard is a sum,
a count or a quotient of sums, so it is folded from these few rows instead of the
mart, under any selection of regions, categories, tiers and dates. A refresh recomputes the
rows of touched dates from the mart's partitions of these dates only.

The table is partitioned by month, so that a reader opens few files. A refresh writes the touched months anew: the
partials of their other dates are carried over as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("date_key", "region", "category", "priority_tier")
MONTH = "month"


def daily_partials(dataset: DataFrame) -> DataFrame:
    """``dataset`` is the mart's projection; combined map-side, so only the partials are shuffled."""
    summed = dataset.groupBy(*DIMENSIONS).agg(
        F.count("store_key").alias("rows"),
        F.sum("stockout_int").cast("long").alias("stockout_rows"),
        F.sum("critical_int").cast("long").alias("critical_rows"),
        F.sum("lost_sales_proxy").alias("lost_sales_proxy"),
        F.sum("estimated_revenue").alias("estimated_revenue"),
        F.sum("observed_units").alias("observed_units"),
    )
    return summed.withColumn(MONTH, F.trunc("date_key", "month"))


def replaced(old: DataFrame, new: DataFrame, dates: DataFrame) -> DataFrame:
    """``old`` partials with those of ``dates`` (date_key) replaced by ``new``."""
    return old.join(F.broadcast(dates), "date_key", "left_anti").unionByName(new)
