"""Small hand-written feeds in landed (text) form for operator tests."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard import schemas
from shelfguard.functions import hourly

RAW_DEFAULTS = {
    "city_id": 100,
    "store_id": 10000,
    "management_group_id": 1,
    "first_category_id": 10,
    "second_category_id": 100,
    "third_category_id": 1000,
    "product_id": 50000,
    "dt": "2024-03-01",
    "sale_amount": 2.0,
    "hours_sale": None,
    "stock_hour6_22_cnt": 0,
    "hours_stock_status": None,
    "discount": 1.0,
    "holiday_flag": 0,
    "activity_flag": 0,
    "precpt": 0.0,
    "avg_temperature": 50.0,
    "avg_humidity": 40.0,
    "avg_wind_level": 2.0,
    "source_dataset": "test",
    "source_split": "train",
    "batch_id": "b1",
    "batch_seq": 1,
    "ingested_at": "2024-06-01 00:00:00+00:00",
    "line_orderkey": 0,
    "line_number": 0,
}


def raw_rows(spark: SparkSession, rows: list[dict], loaded_at: datetime | None = None) -> DataFrame:
    full = [{**RAW_DEFAULTS, **r} for r in rows]
    df = spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.RAW_DAILY_WITH_LINEAGE.fields) for r in full],
        schema=schemas.RAW_DAILY_WITH_LINEAGE,
    )
    df = df.withColumns(
        {
            "hours_sale": F.coalesce(F.col("hours_sale"), F.to_json(hourly.hourly_profile(F.col("sale_amount")))),
            "hours_stock_status": F.coalesce(
                F.col("hours_stock_status"), F.to_json(hourly.hourly_stock_status(F.col("stock_hour6_22_cnt")))
            ),
        }
    )
    loaded = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return df.withColumns({"_source_file": F.lit("test"), "_loaded_at": loaded})


def store_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "northmart_store_id": "NM-STORE-001", "source_store_id": 10000, "store_name": "S1", "region": "Rockies",
        "state": "Colorado", "city": "Denver", "store_format": "flagship", "climate_zone": "mountain",
        "opened_date": "2016-01-01", "batch_id": "static-001", "ingested_at": "2024-06-01 00:00:00+00:00",
    }
    full = [{**base, **r} for r in rows]
    df = spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.STORE_MASTER.fields) for r in full], schema=schemas.STORE_MASTER
    )
    return df.withColumns({"_source_file": F.lit("test"), "_loaded_at": F.current_timestamp()})


def product_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "northmart_product_id": "NM-SKU-00001", "source_product_id": 50000, "product_name": "P1",
        "category": "Hiking", "subcategory": "Hiking Core", "brand": "SummitTrail", "replenishment_class": "fast",
        "base_unit_price": 15.74, "seasonal_peak": "spring", "batch_id": "static-001",
        "ingested_at": "2024-06-01 00:00:00+00:00",
    }
    full = [{**base, **r} for r in rows]
    df = spark.createDataFrame(
        [tuple(r[f.name] for f in schemas.PRODUCT_MASTER.fields) for r in full], schema=schemas.PRODUCT_MASTER
    )
    return df.withColumns({"_source_file": F.lit("test"), "_loaded_at": F.current_timestamp()})


def d(s: str) -> date:
    return date.fromisoformat(s)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for a block, then restore the previous values."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# No broadcast that Spark chooses by size: lookups and dimensions join by shuffle.
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
