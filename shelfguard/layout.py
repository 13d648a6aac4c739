"""Where each layer's tables live: ``<base>/<layer>/<table>`` parquet folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfguard.session import list_folder

BRONZE_TABLES = (
    "bronze_daily_observations",
    "bronze_store_master",
    "bronze_product_master",
)
SILVER_TABLES = (
    "dim_store",
    "dim_product",
    "dim_date",
    "fact_sales",
    "fact_inventory_status",
    "fact_promotion",
    "fact_external_signal",
)
GOLD_TABLES = ("gold_stockout_daily",)
# Sums and counts per day that serving folds; derived from the mart.
PARTIALS_TABLE = "gold_daily_partials"
# Clustering columns per table (data layout for min/max pruning).
CLUSTER_BY = {
    "bronze_daily_observations": ("dt", "store_id"),
    "bronze_store_master": ("region", "state"),
    "bronze_product_master": ("category", "replenishment_class"),
    "dim_store": ("region", "state"),
    "dim_product": ("category", "replenishment_class"),
    "dim_date": ("year", "month"),
    "fact_sales": ("date_key", "store_key"),
    "fact_inventory_status": ("date_key", "store_key"),
    "fact_promotion": ("date_key", "store_key"),
    "fact_external_signal": ("date_key", "store_key"),
    "gold_stockout_daily": ("date_key", "region", "category"),
}


# Partition column of the bronze folders: the streaming run that wrote them.
RUN_COLUMN = "_run"
# Bronze tables whose runs are partitioned further, so that reads of some dates prune the log.
PARTITION_BY = {"bronze_daily_observations": "dt"}


@dataclass(frozen=True)
class Layout:
    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/landing"

    @property
    def checkpoints(self) -> str:
        return f"{self.base}/_checkpoints"

    def layer_of(self, table: str) -> str:
        if table in BRONZE_TABLES:
            return "bronze"
        if table in (*GOLD_TABLES, PARTIALS_TABLE):
            return "gold"
        return "silver"

    def path(self, table: str) -> str:
        return f"{self.base}/{self.layer_of(table)}/{table}"

    def quarantine(self, table: str) -> str:
        """Rows of a bronze table's feed that failed a rule, by run."""
        return f"{self.base}/quarantine/{table}"

    def rule_counts(self, table: str) -> str:
        """Rows seen, kept and failing each rule, by run."""
        return f"{self.base}/rule_counts/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.checkpoints}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table)).drop(RUN_COLUMN)


def runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs that a bronze table holds (folder names only), ascending."""
    names = list_folder(spark._jvm, path)
    return sorted(int(n.removeprefix(f"{RUN_COLUMN}=")) for n in names if n.startswith(f"{RUN_COLUMN}="))


def newest_run(spark: SparkSession, layout: Layout, table: str) -> int | None:
    return max(runs(spark, layout.path(table)), default=None)
