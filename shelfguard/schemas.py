"""Explicit schemas of the three landed feeds (no inference on read)."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


L, D, S = LongType(), DoubleType(), StringType()

RAW_DAILY = _struct(
    ("city_id", L),
    ("store_id", L),
    ("management_group_id", L),
    ("first_category_id", L),
    ("second_category_id", L),
    ("third_category_id", L),
    ("product_id", L),
    ("dt", S),
    ("sale_amount", D),
    ("hours_sale", S),
    ("stock_hour6_22_cnt", L),
    ("hours_stock_status", S),
    ("discount", D),
    ("holiday_flag", L),
    ("activity_flag", L),
    ("precpt", D),
    ("avg_temperature", D),
    ("avg_humidity", D),
    ("avg_wind_level", D),
    ("source_dataset", S),
    ("source_split", S),
    ("batch_id", S),
    ("batch_seq", L),
    ("ingested_at", S),
)

STORE_MASTER = _struct(
    ("northmart_store_id", S),
    ("source_store_id", L),
    ("store_name", S),
    ("region", S),
    ("state", S),
    ("city", S),
    ("store_format", S),
    ("climate_zone", S),
    ("opened_date", S),
    ("batch_id", S),
    ("ingested_at", S),
)

PRODUCT_MASTER = _struct(
    ("northmart_product_id", S),
    ("source_product_id", L),
    ("product_name", S),
    ("category", S),
    ("subcategory", S),
    ("brand", S),
    ("replenishment_class", S),
    ("base_unit_price", D),
    ("seasonal_peak", S),
    ("batch_id", S),
    ("ingested_at", S),
)

# Feeds derived from the driver tables carry the source line as lineage; it
# is the deterministic tie-break between versions landed in the same batch.
LINEAGE = _struct(("line_orderkey", L), ("line_number", L))
LINEAGE_COLUMNS = tuple(f.name for f in LINEAGE.fields)
RAW_DAILY_WITH_LINEAGE = StructType(RAW_DAILY.fields + LINEAGE.fields)
