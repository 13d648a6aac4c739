"""The published contracts once more, as the oracle reads them: table, key, columns, checks."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — the published contracts ("!" marks a required column).
# ---------------------------------------------------------------------------
CONTRACTS = (
    ("bronze_daily_observations",
     ("city_id", "store_id", "product_id", "dt"),
     """
        city_id bigint !
        store_id bigint !
        management_group_id bigint !
        first_category_id bigint !
        second_category_id bigint !
        third_category_id bigint !
        product_id bigint !
        dt date !
        sale_amount double !
        hours_sale array<double>
        stock_hour6_22_cnt int !
        hours_stock_status array<int>
        discount double !
        holiday_flag int !
        activity_flag int !
        precpt double
        avg_temperature double
        avg_humidity double
        avg_wind_level double
        source_dataset string !
        source_split string !
        batch_id string !
        batch_seq bigint !
        ingested_at timestamp !""",
     (
         "sale_amount >= 0",
         "stock_hour6_22_cnt between 0 and 17",
         "discount > 0 and discount <= 1",
         "holiday_flag in (0, 1)",
         "activity_flag in (0, 1)",
     )),
    ("bronze_store_master",
     ("northmart_store_id",),
     """
        northmart_store_id string !
        source_store_id bigint
        store_name string !
        region string !
        state string !
        city string !
        store_format string !
        climate_zone string !
        opened_date date
        batch_id string !
        ingested_at timestamp !""",
     (
         "northmart_store_id is not null",
         "region in ('Rockies', 'Wasatch', 'Northern Plains', 'High Desert')",
         "store_format in ('flagship', 'standard', 'outlet')",
     )),
    ("bronze_product_master",
     ("northmart_product_id",),
     """
        northmart_product_id string !
        source_product_id bigint
        product_name string !
        category string !
        subcategory string !
        brand string !
        replenishment_class string !
        base_unit_price decimal(10,2) !
        seasonal_peak string
        batch_id string !
        ingested_at timestamp !""",
     (
         "northmart_product_id is not null",
         "base_unit_price > 0",
         "replenishment_class in ('fast', 'standard', 'slow', 'seasonal')",
     )),
    ("dim_store",
     ("store_key",),
     """
        store_key string !
        source_store_id bigint
        store_name string !
        region string !
        state string !
        city string !
        store_format string !
        climate_zone string !
        effective_start_date date !
        effective_end_date date
        is_current boolean !""",
     (
         "store_key is not null",
         "is_current in (true, false)",
     )),
    ("dim_product",
     ("product_key",),
     """
        product_key string !
        source_product_id bigint
        product_name string !
        category string !
        subcategory string !
        brand string !
        replenishment_class string !
        base_unit_price decimal(10,2) !
        seasonal_peak string
        is_active boolean !""",
     (
         "product_key is not null",
         "base_unit_price > 0",
         "is_active in (true, false)",
     )),
    ("dim_date",
     ("date_key",),
     """
        date_key date !
        day_of_week string !
        week_start_date date !
        month int !
        quarter int !
        year int !
        is_weekend boolean !
        is_holiday boolean !
        planning_season string !""",
     (
         "date_key is not null",
         "month between 1 and 12",
         "quarter between 1 and 4",
     )),
    ("fact_sales",
     ("store_key", "product_key", "date_key"),
     """
        store_key string !
        product_key string !
        date_key date !
        observed_units double !
        normalized_sales_amount double !
        estimated_revenue decimal(12,2) !
        source_dataset string !
        batch_id string !
        processed_at timestamp !""",
     (
         "observed_units >= 0",
         "normalized_sales_amount >= 0",
         "estimated_revenue >= 0",
     )),
    ("fact_inventory_status",
     ("store_key", "product_key", "date_key"),
     """
        store_key string !
        product_key string !
        date_key date !
        stockout_hours int !
        stockout_flag boolean !
        service_window_hours int !
        inventory_coverage_status string !
        batch_id string !
        processed_at timestamp !""",
     (
         "stockout_hours >= 0",
         "stockout_hours <= service_window_hours",
         "service_window_hours > 0",
         "inventory_coverage_status in ('healthy', 'watch', 'at_risk', 'stockout')",
     )),
    ("fact_promotion",
     ("store_key", "product_key", "date_key"),
     """
        store_key string !
        product_key string !
        date_key date !
        promotion_flag boolean !
        discount_rate double !
        campaign_name string
        batch_id string !
        processed_at timestamp !""",
     (
         "discount_rate >= 0",
         "discount_rate < 1",
     )),
    ("fact_external_signal",
     ("store_key", "date_key"),
     """
        store_key string !
        date_key date !
        is_holiday boolean !
        local_event_flag boolean !
        precipitation double
        avg_temperature double
        avg_humidity double
        avg_wind_level double
        demand_signal_bucket string !
        batch_id string !
        processed_at timestamp !""",
     (
         "demand_signal_bucket in ('normal', 'weather_sensitive', 'holiday', 'event', 'compound')",
     )),
    ("gold_stockout_daily",
     ("store_key", "product_key", "date_key"),
     """
        store_key string !
        product_key string !
        date_key date !
        region string !
        store_format string !
        category string !
        subcategory string !
        replenishment_class string !
        observed_units double !
        estimated_revenue decimal(12,2) !
        stockout_hours int !
        stockout_flag boolean !
        promotion_flag boolean !
        discount_rate double !
        is_holiday boolean !
        demand_signal_bucket string !
        lost_sales_proxy decimal(12,2) !
        stockout_risk_score double
        priority_tier string !
        refreshed_at timestamp !""",
     (
         "observed_units >= 0",
         "estimated_revenue >= 0",
         "lost_sales_proxy >= 0",
         "stockout_hours >= 0",
         "discount_rate >= 0",
         "discount_rate < 1",
         "priority_tier in ('low', 'medium', 'high', 'critical')",
     )),
)
# --------------------------------------------------------------------------- end
