"""Every registered query, run on feeds derived from the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over whole tables. Silver and
gold tables are written once per session and scale factor, in the order that a
refresh writes them, and every query reads what it needs of them. Volatile
audit columns (load and refresh times, source file) and the JSON-array text
columns are left out of returned frames; arrays are checked exploded.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard import config as C
from shelfguard import contracts as K
from shelfguard import expectations as X
from shelfguard import schemas
from shelfguard.functions import hourly
from shelfguard.layout import CLUSTER_BY, PARTIALS_TABLE, RUN_COLUMN, Layout, runs
from shelfguard.operators.layout import write_clustered, zordered
from shelfguard.operators.rules import rule_failures
from shelfguard.operators.sampling import sample_first_keys
from shelfguard.plans import bronze, gold, masters, partials, refresh, replay, reports, serving, silver, validation
from shelfguard.plans.compaction import compact
from shelfguard.plans.contracts import contract_report
from shelfguard.session import prepare, scratch_path, staged
from shelfguard.sources import fixture as fx
from shelfguard.streaming.ingest import feeds, ingest_all, land, landed_rule_counts, quarantined, write_run

VOLATILE = ("_source_file", "_loaded_at", "processed_at", "refreshed_at")
LINEAGE = schemas.LINEAGE_COLUMNS

# Parameters of the registered serving and sampling queries.
FILTERED = serving.MartFilters(regions=("AMERICA", "ASIA"), categories=("STANDARD", "PROMO", "ECONOMY"), tiers=("critical", "high"))
CLUSTERED_RANGE = (date(1998, 1, 1), date(1999, 1, 1))
ZORDERED_REGIONS, ZORDERED_CATEGORIES = ("ASIA", "EUROPE"), ("PROMO",)
SAMPLE_WINDOW = (date(1996, 1, 1), date(1997, 12, 31))
SAMPLE_STORES = 20
SAMPLE_PRODUCTS = 400
SAMPLE_TARGET = 500


def compared(df: DataFrame) -> DataFrame:
    return df.drop(*VOLATILE, *silver.ARRAYS)


class Medallion:
    """Silver and gold over one bronze log; each table is written when first asked for.

    The latest observations are read whole by what follows, never by date, so they are written as the window
    leaves them, without an exchange that only deals rows to dates. A refresh, which reads
    touched dates, keeps them by date (``plans.refresh``).
    """

    def __init__(self, name: str, bronze_daily: DataFrame, store_master: DataFrame, product_master: DataFrame):
        self.bronze_daily, self.store_master, self.product_master = bronze_daily, store_master, product_master
        self.spark = bronze_daily.sparkSession
        self.layout = Layout(scratch_path(self.spark, name))

    def _by_date(self, table: str, rows: DataFrame, date_col: str = "date_key", aligned: bool = False) -> DataFrame:
        sort_by = CLUSTER_BY[table][1:] if table in CLUSTER_BY else ("store_key", "product_key")
        refresh.write_by_date(rows, self.layout.path(table), date_col, sort_by, aligned=aligned)
        return self.layout.read(self.spark, table)

    def _small(self, table: str, rows: DataFrame) -> DataFrame:
        refresh.write_small(rows, self.layout.path(table), CLUSTER_BY[table])
        return self.layout.read(self.spark, table)

    @cached_property
    def latest(self) -> DataFrame:
        """All columns of the latest observations but the hourly arrays."""
        return staged(silver.latest_observations(self.bronze_daily.drop(*silver.ARRAYS)), "latest")

    @cached_property
    def latest_inputs(self) -> DataFrame:
        """The columns of the latest observations that facts and dates read."""
        rows = silver.fact_inputs(self.bronze_daily, (*C.VERSION_ORDER, *LINEAGE))
        return staged(silver.fact_inputs(silver.latest_observations(rows)), "latest-inputs")

    @cached_property
    def observations(self) -> DataFrame:
        """All columns of the keyed observations."""
        return silver.keyed_observations(self.latest, self.store_master, self.product_master)

    @cached_property
    def keyed(self) -> DataFrame:
        keyed = silver.keyed_observations(self.latest_inputs, self.store_master, self.product_master)
        return self._by_date(refresh.KEYED_STAGE, keyed, "dt")

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._small("dim_store", silver.dim_store(self.store_master))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._small("dim_product", silver.dim_product(self.product_master))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._small("dim_date", silver.dim_date(self.latest_inputs))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._by_date("fact_sales", silver.fact_sales(self.keyed), aligned=True)

    @cached_property
    def fact_inventory_status(self) -> DataFrame:
        return self._by_date("fact_inventory_status", silver.fact_inventory_status(self.keyed), aligned=True)

    @cached_property
    def fact_promotion(self) -> DataFrame:
        return self._by_date("fact_promotion", silver.fact_promotion(self.keyed), aligned=True)

    @cached_property
    def fact_external_signal(self) -> DataFrame:
        return self._by_date("fact_external_signal", silver.fact_external_signal(self.keyed))

    @property
    def mart_inputs(self) -> tuple[DataFrame, ...]:
        return (
            self.fact_sales, self.fact_inventory_status, self.fact_promotion, self.fact_external_signal,
            self.dim_store, self.dim_product,
        )

    @cached_property
    def mart(self) -> DataFrame:
        return self._by_date(refresh.GOLD_TABLE, gold.stockout_mart(*self.mart_inputs))

    @cached_property
    def dataset(self) -> DataFrame:
        return serving.mart_projection(self.mart)

    @cached_property
    def partials(self) -> DataFrame:
        path = self.layout.path(PARTIALS_TABLE)
        refresh.write_by_date(partials.daily_partials(self.dataset), path, partials.MONTH, partials.DIMENSIONS)
        return self.layout.read(self.spark, PARTIALS_TABLE)


class FixtureTables:
    """The feeds of one scale factor, and the medallions over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def feed(self, restated: bool = True, dealt: bool = False) -> DataFrame:
        return fx.raw_daily_feed(self.spark, self.sf_dir, restated, dealt)

    @cached_property
    def landed_raw(self) -> DataFrame:
        return fx.with_batch_provenance(self.feed(), "fixture:lineitem")

    @cached_property
    def landed_stores(self) -> DataFrame:
        return fx.with_batch_provenance(fx.store_master_feed(self.spark, self.sf_dir), "fixture:supplier")

    @cached_property
    def landed_products(self) -> DataFrame:
        return fx.with_batch_provenance(fx.product_master_feed(self.spark, self.sf_dir), "fixture:part")

    @cached_property
    def parsed_raw(self) -> DataFrame:
        return bronze.parse_raw_daily(self.landed_raw)

    @cached_property
    def store_master(self) -> DataFrame:
        return bronze.bronze_store_master(self.landed_stores)

    @cached_property
    def product_master(self) -> DataFrame:
        return bronze.bronze_product_master(self.landed_products)

    @cached_property
    def main(self) -> Medallion:
        return Medallion("medallion", bronze.bronze_raw_daily(self.landed_raw), self.store_master, self.product_master)

    @cached_property
    def landed(self) -> Layout:
        """All three feeds as CSV files, the observations as one delivery."""
        layout = Layout(scratch_path(self.spark, "landed"))
        _land_masters(self, layout)
        _land_daily(self, layout, self.feed(dealt=True), "delivery-001")
        return layout

    @cached_property
    def replay_landed(self) -> DataFrame:
        return self.replay_batches()

    def replay_batches(self) -> DataFrame:
        return replay.replay_batches(
            self.feed(restated=False), C.FIXTURE_REPLAY, C.FIXTURE.days, C.FIXTURE.source_dataset, C.FIXTURE.source_split
        )

    def delivered(self, delivery: C.Delivery) -> DataFrame:
        """One delivery of the replay, for landing."""
        rows = self.feed(restated=False, dealt=True)
        found = replay.delivered(rows, delivery, C.FIXTURE_REPLAY, C.FIXTURE.days, C.FIXTURE.source_dataset, C.FIXTURE.source_split)
        return found.drop("is_corrected", "is_late")

    @cached_property
    def replayed(self) -> Medallion:
        landed = fx.with_batch_provenance(self.replay_landed.drop("is_corrected", "is_late"), "fixture:replay")
        return Medallion("replayed", bronze.bronze_raw_daily(landed), self.store_master, self.product_master)


_TABLES: dict[tuple[str, str], FixtureTables] = {}


def _tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    """The tables of this session and scale factor: written once, read by every query."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    found = _TABLES.get(key)
    if found is None or found.spark._jsparkSession != spark._jsparkSession:
        found = _TABLES[key] = FixtureTables(spark, sf_dir)
    return found


def _main(spark: SparkSession, sf_dir: str) -> Medallion:
    return _tables(spark, sf_dir).main


# -- bronze ---------------------------------------------------------------------
def q_bronze_daily(spark, sf_dir):
    return compared(_main(spark, sf_dir).bronze_daily)


def q_bronze_store_master(spark, sf_dir):
    return compared(_tables(spark, sf_dir).store_master)


def q_bronze_product_master(spark, sf_dir):
    return compared(_tables(spark, sf_dir).product_master)


def q_bronze_hourly_arrays(spark, sf_dir):
    return hourly.explode_hours(
        _main(spark, sf_dir).bronze_daily, ["store_id", "product_id", "dt", *LINEAGE, "batch_seq"],
        {"hours_sale": F.col("hours_sale"), "hours_stock_status": F.col("hours_stock_status")},
    )


def q_dq_rule_counts(spark, sf_dir):
    """Rows seen, kept and failing each rule, for every table that has rules."""
    t, m = _tables(spark, sf_dir), _main(spark, sf_dir)
    before = {
        "bronze_raw_daily": t.parsed_raw,
        "bronze_store_master": bronze.parse_store_master(t.landed_stores),
        "bronze_product_master": bronze.parse_product_master(t.landed_products),
        "dim_store": silver.dim_store_rows(m.store_master),
        "dim_product": silver.dim_product_rows(m.product_master),
        "dim_date": silver.dim_date_rows(m.latest_inputs),
        "fact_sales": silver.fact_sales_rows(m.keyed),
        "fact_inventory_status": silver.fact_inventory_status_rows(m.keyed),
        "fact_promotion": silver.fact_promotion_rows(m.keyed),
        "fact_external_signal": silver.fact_external_signal_rows(m.keyed),
        "gold_stockout_daily": gold.stockout_mart_rows(*m.mart_inputs),
    }
    out = None
    for table, rows in before.items():
        part = rule_failures(rows, X.BY_TABLE[table], table)
        out = part if out is None else out.unionByName(part)
    return out


# -- streaming ------------------------------------------------------------------
def _land_masters(t: FixtureTables, layout: Layout) -> None:
    land(fx.store_master_feed(t.spark, t.sf_dir), layout, "store_master", "master-001", schemas.STORE_MASTER)
    land(fx.product_master_feed(t.spark, t.sf_dir), layout, "product_master", "master-001", schemas.PRODUCT_MASTER)


def _land_daily(t: FixtureTables, layout: Layout, rows: DataFrame, delivery: str) -> None:
    land(rows, layout, "daily_observations", delivery, schemas.RAW_DAILY_WITH_LINEAGE)


def q_incremental_ingest(spark, sf_dir):
    """Land the feed as five deliveries, run the stream after each and once more."""
    t = _tables(spark, sf_dir)
    layout = Layout(scratch_path(t.spark, "incremental-ingest"))
    _land_masters(t, layout)
    for seq in range(1, 6):
        _land_daily(t, layout, t.feed(dealt=True).where(F.col("batch_seq") == seq), f"delivery-{seq:03d}")
        ingest_all(t.spark, layout, schemas.RAW_DAILY_WITH_LINEAGE)
    rerun = ingest_all(t.spark, layout, schemas.RAW_DAILY_WITH_LINEAGE)
    if any(r.rows_read for r in rerun):
        raise RuntimeError("a re-run of the incremental source read files twice")
    return compared(layout.read(t.spark, refresh.RAW_TABLE))


# -- silver ---------------------------------------------------------------------
def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: compared(getattr(_main(spark, sf_dir), name))


# -- gold and serving -------------------------------------------------------------
def q_mart_filtered(spark, sf_dir):
    return serving.mart_filtered(_main(spark, sf_dir).mart, FILTERED)


def _widget(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A widget over the daily partials: no mart file is read."""
    return lambda spark, sf_dir: build(_main(spark, sf_dir).partials)


def q_daily_partials(spark, sf_dir):
    found = _main(spark, sf_dir).partials.drop(partials.MONTH)
    money = ("lost_sales_proxy", "estimated_revenue", "observed_units")
    return found.select(*[F.round(c, 2).alias(c) if c in money else c for c in found.columns])


def q_dashboard_filtered(spark, sf_dir):
    """Every widget under the three pickers' selection."""
    return serving.dashboard(_main(spark, sf_dir).partials, FILTERED)


def q_stockout_mart(spark, sf_dir):
    return compared(_main(spark, sf_dir).mart)


def q_top_offenders(spark, sf_dir):
    return serving.top_offenders(_main(spark, sf_dir).mart, 50)


def q_clustered_scan(spark, sf_dir):
    """Write the mart with its clustering layout, then scan one year of it."""
    m = _main(spark, sf_dir)
    path = scratch_path(m.spark, "clustered-mart")
    write_clustered(compared(m.mart), path, CLUSTER_BY[refresh.GOLD_TABLE], split_by=("store_key", "product_key"))
    lo, hi = CLUSTERED_RANGE
    return m.spark.read.parquet(path).where((F.col("date_key") >= F.lit(lo)) & (F.col("date_key") < F.lit(hi)))


def q_zordered_scan(spark, sf_dir):
    """Write the mart in the Z-order of its clustering columns, then scan it by the last two of them."""
    m = _main(spark, sf_dir)
    path = scratch_path(m.spark, "zordered-mart")
    zordered(compared(m.mart), CLUSTER_BY[refresh.GOLD_TABLE], split_by=("store_key", "product_key")).write.parquet(path)
    return m.spark.read.parquet(path).where(F.col("region").isin(*ZORDERED_REGIONS) & F.col("category").isin(*ZORDERED_CATEGORIES))


def q_compacted_bronze(spark, sf_dir):
    """Bronze as five stream runs, compacted to one run beside the newest."""
    m = _main(spark, sf_dir)
    layout = Layout(scratch_path(m.spark, "compacted"))
    table = layout.path(refresh.RAW_TABLE)
    for run in range(5):
        write_run(m.bronze_daily.where(F.col("batch_seq") == run + 1), refresh.RAW_TABLE, f"{table}/{RUN_COLUMN}={run}")
    compact(m.spark, layout, refresh.RAW_TABLE)
    if runs(m.spark, table) != [3, 4]:
        raise RuntimeError("four runs should have become one")
    return compared(layout.read(m.spark, refresh.RAW_TABLE))


# -- replay and reports -------------------------------------------------------------
def q_replay_batches(spark, sf_dir):
    return compared(_tables(spark, sf_dir).replay_landed)


def q_replay_corrections(spark, sf_dir):
    corrected = replay.replay_corrections(_tables(spark, sf_dir).feed(restated=False), C.FIXTURE_REPLAY)
    # Batch stamps are assigned when the corrections land (replay_batches).
    return compared(corrected).drop("batch_id", "batch_seq", "ingested_at")


def q_replay_manifest(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return replay.replay_manifest(t.replay_landed, t.feed(restated=False))


def q_batch_provenance(spark, sf_dir):
    return reports.batch_provenance(_tables(spark, sf_dir).replayed.bronze_daily)


def q_late_arrivals_check(spark, sf_dir):
    cfg = C.FIXTURE_REPLAY
    return reports.late_arrivals_check(
        _tables(spark, sf_dir).replayed.mart, C.STORE_KEY_FORMAT % cfg.late_store, cfg.day(cfg.late_days)
    )


def q_restatement_check(spark, sf_dir):
    cfg = C.FIXTURE_REPLAY
    return reports.restatement_check(
        _tables(spark, sf_dir).replayed.mart, C.STORE_KEY_FORMAT % cfg.corrected_store,
        C.PRODUCT_KEY_FORMAT % cfg.corrected_products[0], [cfg.day(d) for d in cfg.corrected_days],
    )


def q_progress_counts(spark, sf_dir):
    """Four-stage replay through the streaming bronze and incremental refreshes."""
    t = _tables(spark, sf_dir)
    layout = Layout(scratch_path(t.spark, "replay"))
    progress_path = f"{layout.base}/_progress"
    _land_masters(t, layout)
    for stage, delivery in enumerate(C.FIXTURE_REPLAY.deliveries, start=1):
        _land_daily(t, layout, t.delivered(delivery), delivery.batch_id)
        # First run is a full refresh; later stages recompute only touched dates.
        refresh.refresh_incremental(t.spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, LINEAGE)
        counts = reports.progress_counts(*[layout.read(t.spark, x) for x in (refresh.RAW_TABLE, "fact_sales", refresh.GOLD_TABLE)])
        counts.select(F.lit(stage).alias("stage"), "k", "v").write.mode("append").parquet(progress_path)
    return t.spark.read.parquet(progress_path)


def q_grain_integrity(spark, sf_dir):
    m = _main(spark, sf_dir)
    return reports.grain_integrity(m.bronze_daily, C.RAW_GRAIN, "bronze_raw_daily").unionByName(
        reports.grain_integrity(m.fact_sales, C.FACT_GRAIN, "fact_sales")
    )


# -- validation and contracts ---------------------------------------------------------
def q_slice_validation(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return validation.slice_validation(t.parsed_raw, t.store_master, t.product_master, C.FIXTURE)


def q_landed_validation(spark, sf_dir):
    """The slice checks over the landed CSV files, read in batch."""
    t = _tables(spark, sf_dir)
    return validation.landing_report(t.spark, t.landed, C.FIXTURE, schemas.RAW_DAILY_WITH_LINEAGE)


def q_quarantine_counts(spark, sf_dir):
    """Rows seen, kept and failing each rule, by feed: the seen and kept from the runs' counts, the others from the quarantine itself."""
    t, out = _tables(spark, sf_dir), None
    ingest_all(t.spark, t.landed, schemas.RAW_DAILY_WITH_LINEAGE)
    for feed, name in zip(feeds(schemas.RAW_DAILY_WITH_LINEAGE), ("bronze_raw_daily", "bronze_store_master", "bronze_product_master"), strict=True):
        counted = landed_rule_counts(t.spark, t.landed, feed.table)
        aside = quarantined(t.spark, t.landed, feed.table)
        if aside is not None:
            failing = aside.select(F.explode("failed_rules").alias("rule_name")).groupBy("rule_name").agg(F.count("*").alias("_n"))
            counted = counted.join(failing, "rule_name", "left")
            own = F.startswith("rule_name", F.lit("_"))
            counted = counted.select("rule_name", F.when(own, F.col("failed_rows")).otherwise(F.coalesce("_n", F.lit(0))).alias("failed_rows"))
        part = counted.select(F.lit(name).alias("table_name"), "rule_name", "failed_rows")
        out = part if out is None else out.unionByName(part)
    return out


CONTRACT_TABLES = (
    ("bronze_daily_observations", "bronze_daily"),
    ("bronze_store_master", "store_master"),
    ("bronze_product_master", "product_master"),
    ("dim_store", "dim_store"),
    ("dim_product", "dim_product"),
    ("dim_date", "dim_date"),
    ("fact_sales", "fact_sales"),
    ("fact_inventory_status", "fact_inventory_status"),
    ("fact_promotion", "fact_promotion"),
    ("fact_external_signal", "fact_external_signal"),
    ("gold_stockout_daily", "mart"),
)


def q_contract_report(spark, sf_dir):
    m = _main(spark, sf_dir)
    out = None
    for table, attr in CONTRACT_TABLES:
        part = contract_report(getattr(m, attr), K.BY_TABLE[table])
        out = part if out is None else out.unionByName(part)
    return out


# -- preparation ----------------------------------------------------------------------
def q_assign_store_keys(spark, sf_dir):
    return masters.assign_store_keys(_tables(spark, sf_dir).parsed_raw, C.FIXTURE.batch_id, C.FIXTURE_INGESTED_AT)


def q_assign_product_keys(spark, sf_dir):
    return masters.assign_product_keys(_tables(spark, sf_dir).parsed_raw, C.FIXTURE.batch_id, C.FIXTURE_INGESTED_AT)


def q_sample_first_keys(spark, sf_dir):
    t = _tables(spark, sf_dir)
    lo, hi = SAMPLE_WINDOW
    # Without the hourly arrays: they aren't returned, and would be built for every row before one is picked.
    rows = compared(bronze.parse_raw_daily(t.feed(restated=False)))
    return compared(
        sample_first_keys(
            rows, store_col="store_id", product_col="product_id", date_col="dt",
            position=LINEAGE, start=lo, end=hi, n_stores=SAMPLE_STORES, n_products=SAMPLE_PRODUCTS, target=SAMPLE_TARGET,
        )
    ).drop("source_dataset", "source_split", "batch_id", "batch_seq", "ingested_at")


def _hourly(name: str, build, column: str) -> Callable[[SparkSession, str], DataFrame]:
    keys = ["store_id", "product_id", "dt", *LINEAGE, "batch_seq"]
    return lambda spark, sf_dir: hourly.explode_hours(_tables(spark, sf_dir).parsed_raw, keys, {name: build(F.col(column))})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "incremental_ingest": q_incremental_ingest,
    "bronze_daily": q_bronze_daily,
    "slice_validation": q_slice_validation,
    "landed_validation": q_landed_validation,
    "quarantine_counts": q_quarantine_counts,
    "fact_sales": _table("fact_sales"),
    "stockout_mart": q_stockout_mart,
    "clustered_scan": q_clustered_scan,
    "zordered_scan": q_zordered_scan,
    "compacted_bronze": q_compacted_bronze,
    "replay_batches": q_replay_batches,
    "bronze_store_master": q_bronze_store_master,
    "bronze_hourly_arrays": q_bronze_hourly_arrays,
    "bronze_product_master": q_bronze_product_master,
    "keyed_observations": _table("observations"),
    "sample_first_keys": q_sample_first_keys,
    "fact_external_signal": _table("fact_external_signal"),
    "dim_store": _table("dim_store"),
    "dim_product": _table("dim_product"),
    "dim_date": _table("dim_date"),
    "kpi_lost_sales": _widget(serving.kpi_lost_sales),
    "kpi_stockout_rate": _widget(serving.kpi_stockout_rate),
    "kpi_critical_rows": _widget(serving.kpi_critical_rows),
    "lost_sales_by_region": _widget(lambda d: serving.lost_sales_by(d, "region")),
    "lost_sales_by_category": _widget(lambda d: serving.lost_sales_by(d, "category")),
    "lost_sales_trend": _widget(serving.lost_sales_trend),
    "priority_mix": _widget(serving.priority_mix),
    "filter_options": _widget(serving.filter_options),
    "progress_counts": q_progress_counts,
    "batch_provenance": q_batch_provenance,
    "late_arrivals_check": q_late_arrivals_check,
    "replay_manifest": q_replay_manifest,
    "grain_integrity": q_grain_integrity,
    "latest_version": _table("latest"),
    "assign_store_keys": q_assign_store_keys,
    "assign_product_keys": q_assign_product_keys,
    "top_offenders": q_top_offenders,
    "restatement_check": q_restatement_check,
    "fact_promotion": _table("fact_promotion"),
    "fact_inventory_status": _table("fact_inventory_status"),
    "mart_projection": lambda spark, sf_dir: _main(spark, sf_dir).dataset,
    "daily_partials": q_daily_partials,
    "dashboard_filtered": q_dashboard_filtered,
    "hourly_profile": _hourly("hours_sale", hourly.hourly_profile, "sale_amount"),
    "hourly_stock_status": _hourly("hours_stock_status", hourly.hourly_stock_status, "stock_hour6_22_cnt"),
    "mart_filtered": q_mart_filtered,
    "replay_corrections": q_replay_corrections,
    "dq_rule_counts": q_dq_rule_counts,
    "contract_report": q_contract_report,
}
