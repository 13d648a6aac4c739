"""Slice validation: row counts, required columns, uniqueness, ranges, cardinality.

Row checks of a table run in one aggregation pass; its uniqueness and
cardinalities come from one group-by on the grain. The report is a DataFrame
(check_name, expected, actual, passed, detail); columns that are missing are
named in ``detail``, and what needs them fails on every row.
:func:`validate_landing` checks landed CSV files and raises on the first failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfguard import schemas
from shelfguard.config import Expected
from shelfguard.layout import Layout
from shelfguard.plans import bronze
from shelfguard.sources import landing

# ---------------------------------------------------------------------------
# FIXED VALUES — columns that a landed slice must have.
# ---------------------------------------------------------------------------
RAW_REQUIRED = (
    "city_id", "store_id", "product_id", "dt", "sale_amount", "stock_hour6_22_cnt", "discount",
    "holiday_flag", "activity_flag", "batch_id", "batch_seq", "ingested_at",
)
STORE_REQUIRED = ("northmart_store_id", "source_store_id", "store_name", "region", "state", "batch_id", "ingested_at")
PRODUCT_REQUIRED = (
    "northmart_product_id", "source_product_id", "product_name", "category", "replenishment_class",
    "base_unit_price", "batch_id", "ingested_at",
)
# --------------------------------------------------------------------------- end
RAW_KEY = ("store_id", "product_id", "dt")


class ValidationError(Exception):
    """Raised when a landed slice fails validation."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _filled(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` with its missing required columns as NULL, so that every check can run."""
    return df.withColumns({c: F.lit(None) for c in missing_columns(df, required)})


def _breaks(rule: Column) -> Column:
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def _checks(df: DataFrame, checks: Sequence[tuple[str, int, Column]], detail: str = "") -> DataFrame:
    """(name, expected, actual-aggregate) -> one aggregation, unpivoted to rows."""
    wide = df.agg(*[actual.cast("long").alias(name) for name, _, actual in checks])
    expected = F.create_map(*[F.lit(x) for name, exp, _ in checks for x in (name, exp)])
    out = wide.unpivot([], wide.columns, "check_name", "actual").withColumn("expected", expected[F.col("check_name")].cast("long"))
    named = F.when(F.col("check_name").endswith("_missing_columns"), F.lit(detail)).otherwise("")
    return out.select("check_name", "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"), named.alias("detail"))


def _surplus(n: str = "_n") -> Column:
    return F.coalesce(F.sum(F.col(n) - 1), F.lit(0))


def _values(grains: DataFrame, column: str, name: str, expected: int) -> DataFrame:
    return _checks(grains.where(F.col(column).isNotNull()).select(column).distinct(), [(name, expected, F.count("*"))])


def slice_validation(raw: DataFrame, stores: DataFrame, products: DataFrame, cfg: Expected) -> DataFrame:
    gone = [missing_columns(df, req) for df, req in ((raw, RAW_REQUIRED), (stores, STORE_REQUIRED), (products, PRODUCT_REQUIRED))]
    raw, stores, products = _filled(raw, RAW_REQUIRED), _filled(stores, STORE_REQUIRED), _filled(products, PRODUCT_REQUIRED)
    col = F.col
    grains = raw.groupBy(*RAW_KEY).agg(F.count("*").alias("_n"))  # one exchange, reused by the four below
    parts = [
        _checks(
            raw,
            [
                ("raw_row_count", cfg.stores * cfg.products * cfg.days, F.count("*")),
                ("raw_missing_columns", 0, F.count("*") * 0 + len(gone[0])),
                ("raw_negative_sale_amount", 0, _breaks(col("sale_amount") >= 0)),
                ("raw_stockout_hours_out_of_range", 0, _breaks(col("stock_hour6_22_cnt").between(0, 17))),
                ("raw_discount_out_of_range", 0, _breaks((col("discount") > 0) & (col("discount") <= 1))),
                ("raw_holiday_flag_not_01", 0, _breaks(col("holiday_flag").isin(0, 1))),
                ("raw_activity_flag_not_01", 0, _breaks(col("activity_flag").isin(0, 1))),
            ],
            ",".join(gone[0]),
        ),
        _checks(grains, [("raw_duplicate_grain", 0, _surplus())]),
        _values(grains, "store_id", "raw_store_cardinality", cfg.stores),
        _values(grains, "product_id", "raw_product_cardinality", cfg.products),
        _values(grains, "dt", "raw_date_cardinality", cfg.days),
        _checks(
            stores,
            [("store_row_count", cfg.stores, F.count("*")), ("store_missing_columns", 0, F.count("*") * 0 + len(gone[1]))],
            ",".join(gone[1]),
        ),
        _checks(
            products,
            [
                ("product_row_count", cfg.products, F.count("*")),
                ("product_missing_columns", 0, F.count("*") * 0 + len(gone[2])),
                ("product_nonpositive_price", 0, _breaks(col("base_unit_price") > 0)),
            ],
            ",".join(gone[2]),
        ),
        _checks(stores.groupBy("northmart_store_id").agg(F.count("*").alias("_n")), [("store_duplicate_key", 0, _surplus())]),
        _checks(products.groupBy("northmart_product_id").agg(F.count("*").alias("_n")), [("product_duplicate_key", 0, _surplus())]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_on_failure(report: DataFrame) -> None:
    """Raise for the first failed check (reads only the failed rows, at most one)."""
    failed = report.where(~F.coalesce(F.col("passed"), F.lit(False))).orderBy("check_name").limit(1).collect()
    if failed:
        row = failed[0].asDict()
        detail = f" ({row['detail']})" if row.get("detail") else ""
        raise ValidationError(f"{row['check_name']}: expected {row['expected']}, got {row['actual']}{detail}")


def landing_report(spark: SparkSession, layout: Layout, cfg: Expected, raw_schema: StructType = schemas.RAW_DAILY) -> DataFrame:
    """The checks over the landed CSV files of the three feeds: FileNotFoundError when one is missing."""
    read = lambda name, schema: landing.require_path(spark, landing.dataset_path(layout.landing, name), schema)
    raw = bronze.parse_raw_daily(read(landing.RAW_DAILY, raw_schema))
    stores = bronze.parse_store_master(read(landing.STORE_MASTER, schemas.STORE_MASTER))
    products = bronze.parse_product_master(read(landing.PRODUCT_MASTER, schemas.PRODUCT_MASTER))
    return slice_validation(raw, stores, products, cfg)


def validate_landing(spark: SparkSession, layout: Layout, cfg: Expected) -> DataFrame:
    """``landing_report``, or ValidationError on its first failed check."""
    report = landing_report(spark, layout, cfg)
    raise_on_failure(report)
    return report
