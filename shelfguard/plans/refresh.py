"""Refresh of every layer: bronze streams, then silver and gold recomputed.

Full refresh: silver and gold are recomputed from the whole append-only
bronze log. Incremental refresh: latest-wins, every fact and the mart only
combine rows of the same date, so only touched dates are recomputed: those of rows landed since
the last complete refresh, and those that hold an id or key whose master row changed
(``plans.deltas``). The result equals a full recompute.

What is read: bronze runs, the staged observations, silver facts and gold are all
partitioned by date, and the touched dates are joined with their own first and last
date as a predicate, so Spark prunes partitions at run time (dynamic partition pruning).

What is written: the partitions of a write are swapped by the commit of the write itself
(dynamic partition overwrite). A job that dies leaves every old date whole; a date that has no rows
any more is deleted after the commit. The state table holds, for each bronze table, the newest
load time and run that gold reflects. It is written last: a run that dies part-way is redone by the next.

Writes are rebalanced on the date: a date goes to one task until it is larger
than the advisory partition size, and is then split at run time. Observations
are keyed once into a table by date, so the three facts of the grain are
written without an exchange of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from shelfguard import schemas
from shelfguard.layout import BRONZE_TABLES, CLUSTER_BY, GOLD_TABLES, PARTIALS_TABLE, RUN_COLUMN, SILVER_TABLES, Layout, newest_run
from shelfguard.plans import deltas, gold, partials, serving, silver
from shelfguard.session import delete_folder, list_folder, observed, staged
from shelfguard.streaming.ingest import IngestResult, ingest_all

LATEST_STAGE = "_latest_observations"
KEYED_STAGE = "_keyed_observations"
RAW_TABLE, *MASTER_TABLES = BRONZE_TABLES
GOLD_TABLE = GOLD_TABLES[0]
STATE_TABLE = "_refresh_state"


@dataclass(frozen=True)
class Touched:
    """Dates to recompute: one row per calendar day at most, with their first and last."""

    dates: DataFrame
    count: int
    first: date | None
    last: date | None

    @classmethod
    def of(cls, dates: DataFrame) -> Touched:
        kept = staged(dates.toDF("dt").distinct(), "touched")
        n, first, last = kept.agg(F.count("dt"), F.min("dt"), F.max("dt")).first()
        return cls(kept, n, first, last)

    def rows_of(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of these dates; partitions of other dates aren't read.

        The range is what makes the dates a selective side for Spark: it then filters partitions
        of ``df`` by the broadcast dates, besides the range itself.
        """
        dates = self.dates.toDF(column).where(F.col(column).between(F.lit(self.first), F.lit(self.last)))
        return df.join(F.broadcast(dates), column, "left_semi").select(*df.columns)


def _partitions(spark: SparkSession, path: str, column: str) -> set[date]:
    """Dates that a table has a folder for (names only)."""
    names = list_folder(spark._jvm, path)
    return {date.fromisoformat(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=") and not n.endswith("__")}


def write_by_date(df: DataFrame, path: str, date_col: str, sort_by: Sequence[str], touched: Touched | None = None, aligned: bool = False) -> None:
    """Write partitioned by date; with ``touched`` only these dates are replaced.

    Dates that ``df`` holds are swapped when the write commits; those it no longer holds are
    deleted afterwards. ``aligned``: the rows are a map over a table partitioned by date, so
    each task holds few dates and no exchange is needed.
    """
    spark, written = df.sparkSession, Observation()
    seen = df.observe(written, F.collect_set(date_col).alias("dates"))
    dealt = seen if aligned else seen.hint("rebalance", date_col)
    ordered = dealt.sortWithinPartitions(date_col, *sort_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    ordered.partitionBy(date_col).option("compression", "zstd").parquet(path)
    old = _partitions(spark, path, date_col)
    if touched is not None:
        old &= {r[0] for r in touched.dates.collect()}
    for gone in old - set((observed(written) or {"dates": []})["dates"]):
        delete_folder(spark._jvm, f"{path}/{date_col}={gone.isoformat()}")


def write_small(df: DataFrame, path: str, sort_by: Sequence[str]) -> None:
    df.sortWithinPartitions(*sort_by).write.mode("overwrite").option("compression", "zstd").parquet(path)


def _of_dates(df: DataFrame, column: str, touched: Touched | None) -> DataFrame:
    return df if touched is None else touched.rows_of(df, column)


def _together(*jobs: Callable[[], None]) -> None:
    """Run writes that don't read each other at once, so that one's last tasks leave no cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def refresh_silver(spark: SparkSession, layout: Layout, tiebreak: Sequence[str] = (), touched: Touched | None = None, masters: bool = True) -> None:
    """Silver anew, or of the touched dates; without ``masters`` (none has changed) the two dimensions stay."""
    stores, products = (layout.read(spark, t) for t in MASTER_TABLES)

    def write_latest() -> None:
        observed_rows = _of_dates(layout.read(spark, RAW_TABLE), "dt", touched)
        present = [c for c in tiebreak if c in observed_rows.columns]
        # Hourly arrays stay in bronze: no silver or gold table reads them.
        latest = silver.latest_observations(observed_rows.drop(*silver.ARRAYS), present)
        write_by_date(latest, layout.path(LATEST_STAGE), "dt", ("store_id", "product_id"), touched)

    dims = [
        lambda: write_small(silver.dim_store(stores), layout.path("dim_store"), CLUSTER_BY["dim_store"]),
        lambda: write_small(silver.dim_product(products), layout.path("dim_product"), CLUSTER_BY["dim_product"]),
    ]
    _together(write_latest, *(dims if masters else ()))
    latest = _of_dates(layout.read(spark, LATEST_STAGE), "dt", touched)

    def write_dates() -> None:
        dates = silver.dim_date(latest)
        if touched is not None:  # the other dates' rows stay as they are
            others = layout.read(spark, "dim_date").join(F.broadcast(touched.dates.toDF("date_key")), "date_key", "left_anti")
            dates = staged(others.unionByName(dates), "dim-date")
        write_small(dates, layout.path("dim_date"), CLUSTER_BY["dim_date"])

    def write_keyed() -> None:
        # Keyed once, by date: the three facts of the grain are maps over this table.
        keyed = silver.keyed_observations(silver.fact_inputs(latest), stores, products)
        write_by_date(keyed, layout.path(KEYED_STAGE), "dt", ("store_key", "product_key"), touched)

    _together(write_keyed, write_dates)
    keyed = _of_dates(layout.read(spark, KEYED_STAGE), "dt", touched)
    facts = (
        ("fact_sales", silver.fact_sales, True),
        ("fact_inventory_status", silver.fact_inventory_status, True),
        ("fact_promotion", silver.fact_promotion, True),
        ("fact_external_signal", silver.fact_external_signal, False),
    )
    write = lambda name, build, aligned: write_by_date(build(keyed), layout.path(name), "date_key", CLUSTER_BY[name][1:], touched, aligned)
    _together(*[partial(write, *fact) for fact in facts])


def refresh_gold(spark: SparkSession, layout: Layout, touched: Touched | None = None) -> None:
    facts = [_of_dates(layout.read(spark, t), "date_key", touched) for t in SILVER_TABLES if t.startswith("fact_")]
    mart = gold.stockout_mart(*facts, layout.read(spark, "dim_store"), layout.read(spark, "dim_product"))
    write_by_date(mart, layout.path(GOLD_TABLE), "date_key", CLUSTER_BY[GOLD_TABLE][1:], touched)
    refresh_partials(spark, layout, touched)


def refresh_partials(spark: SparkSession, layout: Layout, touched: Touched | None = None) -> None:
    """The daily partials of gold; with ``touched`` only of these dates, in their months' partitions."""
    path, sort_by = layout.path(PARTIALS_TABLE), partials.DIMENSIONS
    mart = _of_dates(layout.read(spark, GOLD_TABLE), "date_key", touched)
    new = partials.daily_partials(serving.mart_projection(mart))
    if touched is None:
        write_by_date(new, path, partials.MONTH, sort_by)
        return
    months = Touched.of(touched.dates.select(F.trunc("dt", "month")))
    old = months.rows_of(layout.read(spark, PARTIALS_TABLE), partials.MONTH)
    rows = staged(partials.replaced(old, new, touched.dates.toDF("date_key")), "partials")
    write_by_date(rows, path, partials.MONTH, sort_by, months)


def _loaded_after(spark: SparkSession, layout: Layout, table: str, watermark: str | None, run: int | None = None) -> DataFrame:
    """Rows loaded after ``watermark``; folders of runs up to ``run`` aren't listed among the files to read."""
    rows = spark.read.parquet(layout.path(table))
    if RUN_COLUMN in rows.columns:
        rows = (rows if run is None else rows.where(F.col(RUN_COLUMN) > run)).drop(RUN_COLUMN)
    # Bronze is append-only: row-group min/max statistics skip older files.
    return rows if watermark is None else rows.where(F.col("_loaded_at") > F.to_timestamp(F.lit(watermark)))


def newest_load(spark: SparkSession, layout: Layout, table: str, since: str | None = None, run: int | None = None) -> str | None:
    """Newest load time of a bronze table, as text in the session clock (a scalar).

    Only rows loaded after ``since`` are read; with none the answer is ``since``.
    """
    newest = F.date_format(F.max("_loaded_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return _loaded_after(spark, layout, table, since, run).agg(newest).first()[0] or since


@dataclass(frozen=True)
class Reflected:
    """The newest load time and run of a bronze table that gold reflects."""

    watermark: str | None = None
    run: int | None = None


def load_state(spark: SparkSession, layout: Layout) -> dict[str, Reflected]:
    """What gold reflects of each bronze table; empty before the first refresh."""
    try:
        return {r["table"]: Reflected(r["watermark"], r["run"]) for r in layout.read(spark, STATE_TABLE).collect()}
    except AnalysisException:
        return {}


def _newest_loads(spark: SparkSession, layout: Layout, state: dict[str, Reflected]) -> dict[str, Reflected]:
    found = {}
    for t in BRONZE_TABLES:
        old = state.get(t, Reflected())
        if old.run is not None and newest_run(spark, layout, t) == old.run:
            found[t] = old  # no run since
            continue
        # Runs are listed first: rows of a later one are left to the next refresh's watermark.
        found[t] = Reflected(newest_load(spark, layout, t, old.watermark, old.run), newest_run(spark, layout, t))
    return found


def _save_state(spark: SparkSession, layout: Layout, state: dict[str, Reflected], masters: bool = True) -> None:
    if masters:
        deltas.save_reflected(spark, layout)
    rows = spark.createDataFrame([(t, r.watermark, r.run) for t, r in sorted(state.items())], "table string, watermark string, run long")
    rows.coalesce(1).write.mode("overwrite").parquet(layout.path(STATE_TABLE))


def _recompute(
    spark: SparkSession, layout: Layout, tiebreak: Sequence[str], reflected: dict, touched: Touched | None = None, masters: bool = True
) -> None:
    refresh_silver(spark, layout, tiebreak, touched, masters)
    refresh_gold(spark, layout, touched)
    _save_state(spark, layout, reflected, masters)


def refresh_all(
    spark: SparkSession, layout: Layout, raw_schema: StructType = schemas.RAW_DAILY, tiebreak: Sequence[str] = ()
) -> list[IngestResult]:
    """Ingest new files, then recompute silver and gold from all of bronze."""
    results = ingest_all(spark, layout, raw_schema)
    _recompute(spark, layout, tiebreak, _newest_loads(spark, layout, load_state(spark, layout)))
    return results


def full_refresh(
    spark: SparkSession, layout: Layout, raw_schema: StructType = schemas.RAW_DAILY, tiebreak: Sequence[str] = ()
) -> list[IngestResult]:
    """Start over: drop every table with its stream's checkpoint and read all landed files again."""
    delete_folder(spark._jvm, layout.path(STATE_TABLE))  # first: a run that dies here is not taken as complete
    for table in (*GOLD_TABLES, PARTIALS_TABLE, *SILVER_TABLES, LATEST_STAGE, KEYED_STAGE, deltas.REFLECTED_MASTERS):
        delete_folder(spark._jvm, layout.path(table))
    for table in BRONZE_TABLES:
        delete_folder(spark._jvm, layout.checkpoint(table))
        delete_folder(spark._jvm, layout.path(table))
        delete_folder(spark._jvm, layout.quarantine(table))
        delete_folder(spark._jvm, layout.rule_counts(table))
    return refresh_all(spark, layout, raw_schema, tiebreak)


def mark_refreshed(spark: SparkSession, layout: Layout) -> None:
    """Record that gold reflects every bronze row loaded so far.

    For callers that run ``ingest_all``, ``refresh_silver`` and
    ``refresh_gold`` (all dates) themselves, with no ingest in between.
    """
    _save_state(spark, layout, _newest_loads(spark, layout, load_state(spark, layout)))


def refresh_incremental(
    spark: SparkSession, layout: Layout, raw_schema: StructType = schemas.RAW_DAILY, tiebreak: Sequence[str] = ()
) -> dict:
    """Ingest new files, then recompute only the dates they touched.

    Returns {"mode": "full" | "incremental" | "none", "dates": n, "ingest": [...]}.
    """
    state = load_state(spark, layout)
    results = ingest_all(spark, layout, raw_schema)
    reflected = _newest_loads(spark, layout, state)
    if not state:
        _recompute(spark, layout, tiebreak, reflected)
        return {"mode": "full", "dates": None, "ingest": results}
    old = state.get(RAW_TABLE, Reflected())
    dates = _loaded_after(spark, layout, RAW_TABLE, old.watermark, old.run).select("dt")
    masters = any(reflected[t].watermark != state.get(t, Reflected()).watermark for t in MASTER_TABLES)
    if masters:
        dates = dates.unionByName(deltas.dates_of_changed_masters(spark, layout, LATEST_STAGE, KEYED_STAGE))
    touched = Touched.of(dates)
    if touched.count or masters:
        _recompute(spark, layout, tiebreak, reflected, touched, masters)
    return {"mode": "incremental" if touched.count or masters else "none", "dates": touched.count, "ingest": results}
