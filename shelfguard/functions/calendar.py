"""Date attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def week_start(d: Column) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", d).cast("date")


def is_weekend(d: Column) -> Column:
    # dayofweek: 1 = Sunday ... 7 = Saturday
    return F.dayofweek(d).isin(1, 7)


def planning_season(month: Column) -> Column:
    return (
        F.when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isin(9, 10, 11), "fall")
        .otherwise("winter")
    )


def date_attributes(d: Column) -> dict[str, Column]:
    month = F.month(d)
    return {
        "day_of_week": day_name(d),
        "week_start_date": week_start(d),
        "month": month,
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": is_weekend(d),
        "planning_season": planning_season(month),
    }
