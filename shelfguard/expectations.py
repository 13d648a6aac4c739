"""Named data-quality rules per table (expect-or-drop).

A row is kept only when its rule is TRUE; a rule that evaluates to NULL drops
the row (so e.g. a NULL sale_amount is dropped).
"""

from __future__ import annotations

from shelfguard.operators.rules import Rule

# ---------------------------------------------------------------------------
# FIXED VALUES — rule names and predicates of every table.
# ---------------------------------------------------------------------------
BRONZE_RAW_DAILY = (
    Rule("valid_raw_business_key",
         "city_id IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL AND dt IS NOT NULL"),
    Rule("valid_sales_amount", "sale_amount >= 0"),
    Rule("valid_stockout_hours", "stock_hour6_22_cnt >= 0 AND stock_hour6_22_cnt <= 17"),
    Rule("valid_discount", "discount > 0 AND discount <= 1"),
)
BRONZE_STORE_MASTER = (
    Rule("valid_store_key", "northmart_store_id IS NOT NULL"),
    Rule("valid_store_format", "store_format IN ('flagship', 'standard', 'outlet')"),
)
BRONZE_PRODUCT_MASTER = (
    Rule("valid_product_key", "northmart_product_id IS NOT NULL"),
    Rule("valid_unit_price", "base_unit_price > 0"),
    Rule("valid_replenishment_class", "replenishment_class IN ('fast', 'standard', 'slow', 'seasonal')"),
)
DIM_STORE = (Rule("valid_store_key", "store_key IS NOT NULL"),)
DIM_PRODUCT = (
    Rule("valid_product_key", "product_key IS NOT NULL"),
    Rule("valid_base_unit_price", "base_unit_price > 0"),
)
DIM_DATE = (Rule("valid_date_key", "date_key IS NOT NULL"),)
FACT_SALES = (
    Rule("valid_sales_keys", "store_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"),
    Rule("valid_observed_units", "observed_units >= 0"),
    Rule("valid_estimated_revenue", "estimated_revenue >= 0"),
)
FACT_INVENTORY_STATUS = (
    Rule("valid_inventory_keys", "store_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"),
    Rule("valid_stockout_hours", "stockout_hours >= 0 AND stockout_hours <= service_window_hours"),
)
FACT_PROMOTION = (
    Rule("valid_promotion_keys", "store_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"),
    Rule("valid_discount_rate", "discount_rate >= 0 AND discount_rate < 1"),
)
FACT_EXTERNAL_SIGNAL = (
    Rule("valid_external_keys", "store_key IS NOT NULL AND date_key IS NOT NULL"),
    Rule("valid_demand_signal_bucket",
         "demand_signal_bucket IN ('normal', 'weather_sensitive', 'holiday', 'event', 'compound')"),
)
GOLD_STOCKOUT_DAILY = (
    Rule("valid_gold_keys", "store_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"),
    Rule("valid_gold_measures", "observed_units >= 0 AND estimated_revenue >= 0 AND lost_sales_proxy >= 0"),
    Rule("valid_priority_tier", "priority_tier IN ('low', 'medium', 'high', 'critical')"),
)
# --------------------------------------------------------------------------- end

BY_TABLE = {
    "bronze_raw_daily": BRONZE_RAW_DAILY,
    "bronze_store_master": BRONZE_STORE_MASTER,
    "bronze_product_master": BRONZE_PRODUCT_MASTER,
    "dim_store": DIM_STORE,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
    "fact_inventory_status": FACT_INVENTORY_STATUS,
    "fact_promotion": FACT_PROMOTION,
    "fact_external_signal": FACT_EXTERNAL_SIGNAL,
    "gold_stockout_daily": GOLD_STOCKOUT_DAILY,
}
