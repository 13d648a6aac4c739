"""Adapter from the driver's TPC-H-like tables to the three landed feeds.

Each line item becomes one daily observation of store ``l_suppkey`` and
product ``l_partkey`` on the first day of its ship month; a share of the lines
lands a second time, restated, in a later batch, so grains repeat and
latest-wins has real work. Some rows break a rule on purpose. The feeds come out exactly as the CSV
reader would deliver them (dates, timestamps and arrays still text), plus the
source line as lineage, so the bronze parsing runs unchanged on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard import config as C
from shelfguard.functions import hourly
from shelfguard.functions.keys import cyclic

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """The rows of a table in at least as many tasks as the cluster has cores, and no fewer than its scan has splits.

    Dealt out before a feed is built of them: a source row takes a fraction of the bytes of its landed text.
    """
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, rows._jdf.rdd().getNumPartitions()))


def raw_daily_feed(spark: SparkSession, sf_dir: str, restated: bool = True, dealt: bool = False) -> DataFrame:
    """Landed raw daily feed: the 24 feed columns + ``line_orderkey``, ``line_number``.

    With ``restated`` every fifth line (by a sum of its keys) also lands as a
    second version, one unit more, in batch 5. ``dealt``: for landing, so that no delivery goes through one task.
    """
    li = table(spark, sf_dir, "lineitem")
    if dealt:
        li = dealt_out(li)
    versions = F.array(F.lit(0))
    if restated:
        again = (F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")) % 5 == 0
        versions = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(versions)
    li = li.withColumn("version", F.explode(versions))
    qty = F.col("l_quantity") + F.col("version")
    orderkey, linenumber = F.col("l_orderkey"), F.col("l_linenumber")
    product = F.col("l_partkey")
    category_seed = product % 8
    seq = F.when(F.col("version") == 1, F.lit(5)).otherwise(F.lit(1) + linenumber % 4).cast("long")
    hours = (
        F.when(orderkey % 97 == 0, F.lit(18))  # breaks the hours rule
        .when(linenumber >= 5, orderkey % 9)
        .otherwise(F.lit(0))
        .cast("long")
    )
    discount = (
        F.when(orderkey % 101 == 0, F.lit(0.0))  # breaks the discount rule
        .when(orderkey % 113 == 0, F.lit(0.00001))  # a rate that rounds to 1 breaks the promotion rule
        .when(F.col("l_discount") >= 0.08, F.round(F.lit(1) - F.col("l_discount"), 2))
        .otherwise(F.lit(1.0))
    )
    sale_amount = F.when(orderkey % 107 == 0, F.lit(-1.0)).otherwise(qty / F.lit(10.0))  # breaks the sales rule
    return li.select(
        F.when(orderkey % 103 == 0, F.lit(None)).otherwise(F.col("l_suppkey") % 5).alias("city_id"),  # breaks the key rule
        F.col("l_suppkey").alias("store_id"),
        (category_seed + 1).alias("management_group_id"),
        (category_seed + 10).alias("first_category_id"),
        (category_seed + 100).alias("second_category_id"),
        (category_seed + 1000).alias("third_category_id"),
        product.alias("product_id"),
        F.date_format(F.trunc(F.to_date("l_shipdate"), "MM"), "yyyy-MM-dd").alias("dt"),
        sale_amount.alias("sale_amount"),
        F.to_json(hourly.hourly_profile(sale_amount)).alias("hours_sale"),
        hours.alias("stock_hour6_22_cnt"),
        F.to_json(hourly.hourly_stock_status(hours)).alias("hours_stock_status"),
        discount.alias("discount"),
        (F.month("l_shipdate") == 12).cast("long").alias("holiday_flag"),
        ((F.col("l_returnflag") == "R") & (linenumber == 7)).cast("long").alias("activity_flag"),
        ((qty.cast("long") % 8) / F.lit(16.0)).alias("precpt"),
        (qty + F.lit(0.25)).alias("avg_temperature"),
        (qty + F.lit(0.5)).alias("avg_humidity"),
        (qty.cast("long") % 9).cast("double").alias("avg_wind_level"),
        F.lit(C.FIXTURE.source_dataset).alias("source_dataset"),
        F.lit(C.FIXTURE.source_split).alias("source_split"),
        F.concat(F.lit("batch-"), seq.cast("string")).alias("batch_id"),
        seq.alias("batch_seq"),
        F.lit(C.FIXTURE_INGESTED_AT).alias("ingested_at"),
        orderkey.alias("line_orderkey"),
        linenumber.cast("long").alias("line_number"),
    )


def store_master_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed store master: one row per supplier, region and state from its nation.

    Store 3 has no key and store 4 an unknown format: both break a rule.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    sid = F.col("s_suppkey")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name", "r_regionkey")
    return s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey).select(
        F.when(sid != 3, F.format_string(C.STORE_KEY_FORMAT, sid)).alias("northmart_store_id"),
        sid.alias("source_store_id"),
        F.col("s_name").alias("store_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.col("s_name").alias("city"),
        F.when(sid == 4, F.lit("kiosk")).otherwise(cyclic(C.STORE_FORMATS, sid + 1)).alias("store_format"),
        cyclic(C.FIXTURE_CLIMATE_ZONES, F.col("r_regionkey") + 1).alias("climate_zone"),
        F.date_format(
            F.make_date(F.lit(2015) + sid % 7, F.lit(1) + sid % 12, F.lit(1)), "yyyy-MM-dd"
        ).alias("opened_date"),
        F.lit(C.FIXTURE.batch_id).alias("batch_id"),
        F.lit(C.FIXTURE_INGESTED_AT).alias("ingested_at"),
    )


def product_master_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed product master: one row per part, class by size, price from retail price.

    Parts 10, 11 and 12 break a rule: no key, no price, an unknown class.
    """
    p = table(spark, sf_dir, "part")
    pid = F.col("p_partkey")
    return p.select(
        F.when(pid != 10, F.format_string(C.PRODUCT_KEY_FORMAT, pid)).alias("northmart_product_id"),
        pid.alias("source_product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(pid == 12, F.lit("unknown")).otherwise(cyclic(C.REPLENISHMENT_CLASSES, F.col("p_size") % 4 + 1)).alias("replenishment_class"),
        F.when(pid == 11, F.lit(0.0)).otherwise(F.round(F.col("p_retailprice") / F.lit(100), 2)).alias("base_unit_price"),
        cyclic(C.SEASONAL_PEAKS, pid % 5 + 1).alias("seasonal_peak"),
        F.lit(C.FIXTURE.batch_id).alias("batch_id"),
        F.lit(C.FIXTURE_INGESTED_AT).alias("ingested_at"),
    )


def with_batch_provenance(df: DataFrame, source: str) -> DataFrame:
    """Provenance columns for feeds read as a batch rather than streamed."""
    return df.withColumns({"_source_file": F.lit(source), "_loaded_at": F.current_timestamp()})
