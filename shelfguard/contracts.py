"""Table contracts: columns, types, required flags, primary key, quality checks.

Checks run as one aggregation pass per table plus one group-by on the key;
see :mod:`shelfguard.plans.contracts`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Contract:
    table: str
    primary_key: tuple[str, ...]
    columns: str  # DDL, as Spark parses it; NOT NULL marks a required column
    checks: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


def contract_of(spec: Mapping) -> Contract:
    """A contract from the form of a contract file: name, primary_key, columns (name, type, required), quality_checks."""
    columns = ", ".join(f"`{c['name']}` {c['type']}{' not null' if c.get('required') else ''}" for c in spec["columns"])
    return Contract(spec["name"], tuple(spec["primary_key"]), columns, tuple(str(x) for x in spec.get("quality_checks") or ()))


def load_contract(path: str | Path) -> Contract:
    """The contract in a YAML or JSON file. Free-text notes at its end aren't read."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return contract_of(json.loads(text))
    try:
        import yaml
    except ImportError as gone:
        raise RuntimeError("contract files in YAML need the yaml package; JSON ones don't") from gone
    return contract_of(yaml.safe_load(re.split(r"(?m)^notes:", text)[0]))


# ---------------------------------------------------------------------------
# FIXED VALUES — the published contracts.
# ---------------------------------------------------------------------------
RAW_DAILY = Contract(
    "bronze_daily_observations",
    ("city_id", "store_id", "product_id", "dt"),
    """
        city_id bigint not null,
        store_id bigint not null,
        management_group_id bigint not null,
        first_category_id bigint not null,
        second_category_id bigint not null,
        third_category_id bigint not null,
        product_id bigint not null,
        dt date not null,
        sale_amount double not null,
        hours_sale array<double>,
        stock_hour6_22_cnt int not null,
        hours_stock_status array<int>,
        discount double not null,
        holiday_flag int not null,
        activity_flag int not null,
        precpt double,
        avg_temperature double,
        avg_humidity double,
        avg_wind_level double,
        source_dataset string not null,
        source_split string not null,
        batch_id string not null,
        batch_seq bigint not null,
        ingested_at timestamp not null
    """,
    ("sale_amount >= 0", "stock_hour6_22_cnt between 0 and 17", "discount > 0 and discount <= 1",
     "holiday_flag in (0, 1)", "activity_flag in (0, 1)"),
)
STORE_MASTER = Contract(
    "bronze_store_master",
    ("northmart_store_id",),
    """
        northmart_store_id string not null,
        source_store_id bigint,
        store_name string not null,
        region string not null,
        state string not null,
        city string not null,
        store_format string not null,
        climate_zone string not null,
        opened_date date,
        batch_id string not null,
        ingested_at timestamp not null
    """,
    ("northmart_store_id is not null", "region in ('Rockies', 'Wasatch', 'Northern Plains', 'High Desert')",
     "store_format in ('flagship', 'standard', 'outlet')"),
)
PRODUCT_MASTER = Contract(
    "bronze_product_master",
    ("northmart_product_id",),
    """
        northmart_product_id string not null,
        source_product_id bigint,
        product_name string not null,
        category string not null,
        subcategory string not null,
        brand string not null,
        replenishment_class string not null,
        base_unit_price decimal(10,2) not null,
        seasonal_peak string,
        batch_id string not null,
        ingested_at timestamp not null
    """,
    ("northmart_product_id is not null", "base_unit_price > 0",
     "replenishment_class in ('fast', 'standard', 'slow', 'seasonal')"),
)
DIM_STORE = Contract(
    "dim_store",
    ("store_key",),
    """
        store_key string not null,
        source_store_id bigint,
        store_name string not null,
        region string not null,
        state string not null,
        city string not null,
        store_format string not null,
        climate_zone string not null,
        effective_start_date date not null,
        effective_end_date date,
        is_current boolean not null
    """,
    ("store_key is not null", "is_current in (true, false)"),
)
DIM_PRODUCT = Contract(
    "dim_product",
    ("product_key",),
    """
        product_key string not null,
        source_product_id bigint,
        product_name string not null,
        category string not null,
        subcategory string not null,
        brand string not null,
        replenishment_class string not null,
        base_unit_price decimal(10,2) not null,
        seasonal_peak string,
        is_active boolean not null
    """,
    ("product_key is not null", "base_unit_price > 0", "is_active in (true, false)"),
)
DIM_DATE = Contract(
    "dim_date",
    ("date_key",),
    """
        date_key date not null,
        day_of_week string not null,
        week_start_date date not null,
        month int not null,
        quarter int not null,
        year int not null,
        is_weekend boolean not null,
        is_holiday boolean not null,
        planning_season string not null
    """,
    ("date_key is not null", "month between 1 and 12", "quarter between 1 and 4"),
)
FACT_SALES = Contract(
    "fact_sales",
    ("store_key", "product_key", "date_key"),
    """
        store_key string not null,
        product_key string not null,
        date_key date not null,
        observed_units double not null,
        normalized_sales_amount double not null,
        estimated_revenue decimal(12,2) not null,
        source_dataset string not null,
        batch_id string not null,
        processed_at timestamp not null
    """,
    ("observed_units >= 0", "normalized_sales_amount >= 0", "estimated_revenue >= 0"),
)
FACT_INVENTORY_STATUS = Contract(
    "fact_inventory_status",
    ("store_key", "product_key", "date_key"),
    """
        store_key string not null,
        product_key string not null,
        date_key date not null,
        stockout_hours int not null,
        stockout_flag boolean not null,
        service_window_hours int not null,
        inventory_coverage_status string not null,
        batch_id string not null,
        processed_at timestamp not null
    """,
    ("stockout_hours >= 0", "stockout_hours <= service_window_hours", "service_window_hours > 0",
     "inventory_coverage_status in ('healthy', 'watch', 'at_risk', 'stockout')"),
)
FACT_PROMOTION = Contract(
    "fact_promotion",
    ("store_key", "product_key", "date_key"),
    """
        store_key string not null,
        product_key string not null,
        date_key date not null,
        promotion_flag boolean not null,
        discount_rate double not null,
        campaign_name string,
        batch_id string not null,
        processed_at timestamp not null
    """,
    ("discount_rate >= 0", "discount_rate < 1"),
)
FACT_EXTERNAL_SIGNAL = Contract(
    "fact_external_signal",
    ("store_key", "date_key"),
    """
        store_key string not null,
        date_key date not null,
        is_holiday boolean not null,
        local_event_flag boolean not null,
        precipitation double,
        avg_temperature double,
        avg_humidity double,
        avg_wind_level double,
        demand_signal_bucket string not null,
        batch_id string not null,
        processed_at timestamp not null
    """,
    ("demand_signal_bucket in ('normal', 'weather_sensitive', 'holiday', 'event', 'compound')",),
)
GOLD_STOCKOUT_DAILY = Contract(
    "gold_stockout_daily",
    ("store_key", "product_key", "date_key"),
    """
        store_key string not null,
        product_key string not null,
        date_key date not null,
        region string not null,
        store_format string not null,
        category string not null,
        subcategory string not null,
        replenishment_class string not null,
        observed_units double not null,
        estimated_revenue decimal(12,2) not null,
        stockout_hours int not null,
        stockout_flag boolean not null,
        promotion_flag boolean not null,
        discount_rate double not null,
        is_holiday boolean not null,
        demand_signal_bucket string not null,
        lost_sales_proxy decimal(12,2) not null,
        stockout_risk_score double,
        priority_tier string not null,
        refreshed_at timestamp not null
    """,
    ("observed_units >= 0", "estimated_revenue >= 0", "lost_sales_proxy >= 0", "stockout_hours >= 0",
     "discount_rate >= 0", "discount_rate < 1", "priority_tier in ('low', 'medium', 'high', 'critical')"),
)
# --------------------------------------------------------------------------- end

ALL = (
    RAW_DAILY, STORE_MASTER, PRODUCT_MASTER, DIM_STORE, DIM_PRODUCT, DIM_DATE,
    FACT_SALES, FACT_INVENTORY_STATUS, FACT_PROMOTION, FACT_EXTERNAL_SIGNAL, GOLD_STOCKOUT_DAILY,
)
BY_TABLE = {c.table: c for c in ALL}
