"""Column expressions for the silver facts and the gold mart.

All are built-in, codegen-friendly expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfguard import config as C


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def observed_units(sale_amount: Column | str = "sale_amount") -> Column:
    return F.round(_c(sale_amount) * F.lit(10.0), 2)


def discount_rate(discount: Column | str = "discount") -> Column:
    return F.round(F.lit(1.0) - _c(discount), 4)


def estimated_revenue(units: Column, unit_price: Column | str, rate: Column) -> Column:
    return F.round(units * _c(unit_price) * (F.lit(1.0) - rate), 2)


def coverage_status(hours: Column) -> Column:
    return (
        F.when(hours == 0, "healthy")
        .when(hours <= C.WATCH_HOURS, "watch")
        .when(hours <= C.AT_RISK_HOURS, "at_risk")
        .otherwise("stockout")
    )


def promotion_flag(activity_flag: Column | str, rate: Column) -> Column:
    # NULL when the flag is NULL and there is no discount; the mart coalesces.
    return (_c(activity_flag) == 1) | (rate > 0)


def campaign_name(activity_flag: Column | str, rate: Column) -> Column:
    return (
        F.when(_c(activity_flag) == 1, F.lit(C.PROMO_CAMPAIGN))
        .when(rate > 0, F.lit(C.MARKDOWN_CAMPAIGN))
        .otherwise(F.lit(None).cast("string"))
    )


def demand_signal_bucket(is_holiday: Column, local_event: Column, weather_sensitive: Column) -> Column:
    return (
        F.when(is_holiday & local_event, "compound")
        .when(is_holiday, "holiday")
        .when(local_event, "event")
        .when(weather_sensitive, "weather_sensitive")
        .otherwise("normal")
    )


def weather_sensitive(precipitation: Column | str, wind_level: Column | str) -> Column:
    return (_c(precipitation) > C.PRECIPITATION_THRESHOLD) | (_c(wind_level) > C.WIND_THRESHOLD)


def stockout_share(hours: Column) -> Column:
    return hours / F.lit(C.SERVICE_WINDOW_HOURS)


def lost_sales_proxy(revenue: Column | str, hours: Column) -> Column:
    return F.round(_c(revenue) * stockout_share(hours), 2)


def stockout_risk_score(hours: Column, promo: Column, replenishment_class: Column | str) -> Column:
    return F.round(
        F.least(
            F.lit(1.0),
            stockout_share(hours)
            + F.when(promo, F.lit(C.PROMO_RISK_UPLIFT)).otherwise(F.lit(0.0))
            + F.when(_c(replenishment_class) == "seasonal", F.lit(C.SEASONAL_RISK_UPLIFT)).otherwise(F.lit(0.0)),
        ),
        4,
    )


def priority_tier(hours: Column, lost_sales: Column, promo: Column) -> Column:
    # Uses the rounded lost-sales value.
    return (
        F.when((hours >= C.CRITICAL_HOURS) | (lost_sales >= C.CRITICAL_LOST_SALES), "critical")
        .when((hours >= C.HIGH_HOURS) | promo, "high")
        .when(hours > 0, "medium")
        .otherwise("low")
    )
