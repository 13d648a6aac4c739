"""Business keys for the stores and products seen in a feed.

Ids are numbered 1..N in ascending order by a distributed dense sequence and
the key text carries the number. Attributes come from the landed masters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfguard.functions.keys import product_key, store_key
from shelfguard.operators.sequence import dense_sequence


def assign_store_keys(raw: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    return dense_sequence(raw, "store_id").select(
        store_key(F.col("seq")).alias("northmart_store_id"),
        F.col("store_id").alias("source_store_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def assign_product_keys(raw: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    return dense_sequence(raw, "product_id").select(
        product_key(F.col("seq")).alias("northmart_product_id"),
        F.col("product_id").alias("source_product_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(ingested_at).alias("ingested_at"),
    )
