"""Bronze: parse landed text into typed columns, then apply the table's rules.

Works the same on a streaming DataFrame (the incremental source) and on a
batch one. Parsing uses the ``try_`` forms so a malformed value becomes NULL
and the NOT NULL rule drops the row instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfguard import expectations as X
from shelfguard.functions import hourly
from shelfguard.operators.rules import keep_valid


def _to_date(c: str):
    return F.expr(f"try_to_date({c})")


def _to_timestamp(c: str):
    return F.expr(f"try_to_timestamp({c})")


def parse_daily_rows(landed: DataFrame) -> DataFrame:
    """All but the hourly arrays, which stay text: no rule reads them."""
    return landed.withColumns({"dt": _to_date("dt"), "ingested_at": _to_timestamp("ingested_at")})


def parse_hours(rows: DataFrame) -> DataFrame:
    """The hourly arrays of their text; arrays stay as they are."""
    parsers = {"hours_sale": hourly.parse_hours_sale, "hours_stock_status": hourly.parse_hours_stock}
    return rows.withColumns({c: parse(F.col(c)) for c, parse in parsers.items() if rows.schema[c].dataType == StringType()})


def parse_raw_daily(landed: DataFrame) -> DataFrame:
    return parse_hours(parse_daily_rows(landed))


def parse_store_master(landed: DataFrame) -> DataFrame:
    return landed.withColumns({"opened_date": _to_date("opened_date"), "ingested_at": _to_timestamp("ingested_at")})


def parse_product_master(landed: DataFrame) -> DataFrame:
    return landed.withColumn("ingested_at", _to_timestamp("ingested_at"))


def bronze_raw_daily(landed: DataFrame) -> DataFrame:
    return keep_valid(parse_raw_daily(landed), X.BRONZE_RAW_DAILY)


def bronze_store_master(landed: DataFrame) -> DataFrame:
    return keep_valid(parse_store_master(landed), X.BRONZE_STORE_MASTER)


def bronze_product_master(landed: DataFrame) -> DataFrame:
    return keep_valid(parse_product_master(landed), X.BRONZE_PRODUCT_MASTER)
