"""Serving queries over the gold layer (the dashboard's datasets and widgets).

The row-level dataset and the offender table read the mart. Every other widget is
``daily partials -> optional filters -> groupBy().agg()`` and reads no mart file. Money sums are
rounded to cents, since a double sum depends on the order rows arrive in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OFFENDER_COLUMNS = (
    "store_key", "product_key", "date_key", "region", "category",
    "stockout_hours", "estimated_revenue", "lost_sales_proxy", "priority_tier",
)
# Deterministic order for equal lost sales.
OFFENDER_TIEBREAK = ("store_key", "product_key", "date_key")


@dataclass(frozen=True)
class MartFilters:
    """Multi-select filters; an empty selection means all values."""

    regions: Sequence[str] = ()
    categories: Sequence[str] = ()
    tiers: Sequence[str] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        for column, values in (("region", self.regions), ("category", self.categories), ("priority_tier", self.tiers)):
            if values:
                df = df.where(F.col(column).isin(list(values)))
        return df


def mart_projection(mart: DataFrame) -> DataFrame:
    """Row-level dataset: mart columns plus 0/1 stock-out and critical indicators."""
    return mart.select(
        "store_key", "product_key", "date_key", "region", "store_format",
        "category", "subcategory", "replenishment_class",
        "observed_units", "estimated_revenue", "stockout_hours",
        "stockout_flag", F.col("stockout_flag").cast("int").alias("stockout_int"),
        "promotion_flag", "discount_rate", "is_holiday", "demand_signal_bucket",
        "lost_sales_proxy", "stockout_risk_score", "priority_tier",
        F.when(F.col("priority_tier") == "critical", 1).otherwise(0).alias("critical_int"),
    )


def mart_filtered(mart: DataFrame, filters: MartFilters) -> DataFrame:
    return filters.apply(mart_projection(mart))


def _money(c: str):
    return F.round(F.sum(c), 2)


# -- widgets: folds of the daily partials, filtered or not ---------------------------
def kpi_lost_sales(partials: DataFrame) -> DataFrame:
    return partials.agg(_money("lost_sales_proxy").alias("sum_lost_sales_proxy"))


def kpi_stockout_rate(partials: DataFrame) -> DataFrame:
    return partials.agg((F.sum("stockout_rows") / F.sum("rows")).alias("avg_stockout_int"))


def kpi_critical_rows(partials: DataFrame) -> DataFrame:
    return partials.agg(F.sum("critical_rows").alias("sum_critical_int"))


def lost_sales_by(partials: DataFrame, dimension: str) -> DataFrame:
    return partials.groupBy(dimension).agg(_money("lost_sales_proxy").alias("sum_lost_sales_proxy"))


def lost_sales_trend(partials: DataFrame) -> DataFrame:
    day = F.date_trunc("DAY", F.col("date_key")).cast("date").alias("daily_date_key")
    return partials.groupBy(day).agg(_money("lost_sales_proxy").alias("sum_lost_sales_proxy"))


def priority_mix(partials: DataFrame) -> DataFrame:
    return partials.groupBy("priority_tier").agg(F.sum("rows").alias("count_rows"))


def filter_options(partials: DataFrame) -> DataFrame:
    """Distinct values offered by the three filter pickers, one row per (filter, value)."""
    named = [(name, column) for name, column in (("region", "region"), ("category", "category"), ("priority", "priority_tier"))]
    pairs = F.array(*[F.struct(F.lit(n).alias("filter_name"), F.col(c).alias("filter_value")) for n, c in named])
    return partials.select(F.inline(pairs)).distinct()


WIDGETS = {
    "kpi_lost_sales": (kpi_lost_sales, None),
    "kpi_stockout_rate": (kpi_stockout_rate, None),
    "kpi_critical_rows": (kpi_critical_rows, None),
    "lost_sales_by_region": (lambda p: lost_sales_by(p, "region"), "region"),
    "lost_sales_by_category": (lambda p: lost_sales_by(p, "category"), "category"),
    "lost_sales_trend": (lost_sales_trend, "daily_date_key"),
    "priority_mix": (priority_mix, "priority_tier"),
}


def dashboard(partials: DataFrame, filters: MartFilters) -> DataFrame:
    """Every widget under one selection, as (widget, item, value) rows; ``item`` is null for a KPI."""
    chosen, out = filters.apply(partials), None
    for name, (build, item) in WIDGETS.items():
        rows = build(chosen)
        value = next(c for c in rows.columns if c != item)
        label = F.col(item).cast("string") if item else F.lit(None).cast("string")
        part = rows.select(F.lit(name).alias("widget"), label.alias("item"), F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def top_offenders(mart: DataFrame, n: int = 50) -> DataFrame:
    """Top ``n`` critical/high rows by lost sales (a bounded TakeOrderedAndProject)."""
    return (
        mart.where(F.col("priority_tier").isin("critical", "high"))
        .select(*OFFENDER_COLUMNS)
        .orderBy(F.col("lost_sales_proxy").desc(), *OFFENDER_TIEBREAK)
        .limit(n)
    )
