"""Bronze streaming tables: landed CSV -> parse -> rules -> append-only parquet.

Each run is ``trigger(availableNow=True)``: it drains every file landed since
the last run and stops. The file source's checkpoint makes the append
exactly-once across runs and executor loss; a re-copied file name is not read
again. Observations are written by date under their run, sorted by the clustering
columns, so a read of some dates opens their files only. ``plans.refresh.full_refresh``
drops table and checkpoint together and reads everything again.

Rows that fail a rule aren't lost: each run writes them, with the names of the rules
they fail, to a folder of its own in the quarantine, and its counts (rows seen, rows kept, rows failing each
rule) beside. A run that is repeated after a failure overwrites all three, so kept and
quarantined rows always add up to what landed. The landed text is read once for either write and no parsed
row is kept in between; the hourly arrays, which no rule reads, are made of the rows to be written only, behind
the exchange by date, since their text is smaller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfguard import expectations as X
from shelfguard import schemas
from shelfguard.layout import CLUSTER_BY, PARTITION_BY, RUN_COLUMN, Layout, runs
from shelfguard.operators.rules import Rule, all_hold, failed_rules, failure_columns, keep_valid
from shelfguard.plans import bronze, compaction
from shelfguard.session import delete_folder, observed, released_shuffles
from shelfguard.sources import landing


@dataclass(frozen=True)
class BronzeFeed:
    dataset: str
    table: str
    schema: StructType
    parse: Callable[[DataFrame], DataFrame]
    rules: Sequence[Rule]
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows  # what is left to parse of the rows that are written


def feeds(raw_schema: StructType = schemas.RAW_DAILY) -> tuple[BronzeFeed, ...]:
    return (
        BronzeFeed(landing.RAW_DAILY, "bronze_daily_observations", raw_schema, bronze.parse_daily_rows,
                   X.BRONZE_RAW_DAILY, bronze.parse_hours),
        BronzeFeed(landing.STORE_MASTER, "bronze_store_master", schemas.STORE_MASTER,
                   bronze.parse_store_master, X.BRONZE_STORE_MASTER),
        BronzeFeed(landing.PRODUCT_MASTER, "bronze_product_master", schemas.PRODUCT_MASTER,
                   bronze.parse_product_master, X.BRONZE_PRODUCT_MASTER),
    )


@dataclass
class IngestResult:
    table: str
    rows_read: int = 0
    rule_failures: dict[str, int] = field(default_factory=dict)


def write_run(rows: DataFrame, table: str, path: str, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """One run's rows, sorted by the clustering columns; by date where the table asks for it.

    ``finish`` is applied to the rows in their places, column by column.
    """
    by = PARTITION_BY.get(table)
    if by is None:
        finish(rows.sortWithinPartitions(*CLUSTER_BY[table])).write.mode("overwrite").parquet(path)
        return
    # Dealt by date, so a run writes few files per date; a large date is split at run time.
    placed = finish(rows.hint("rebalance", by).sortWithinPartitions(*CLUSTER_BY[table]))
    with released_shuffles(rows.sparkSession):
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy(by).parquet(path)


def _split_run(rows: DataFrame, feed: BronzeFeed, layout: Layout, run: int) -> dict[str, int]:
    """Write a run's kept rows, its quarantine and its counts; returns the counts."""
    folder = f"{RUN_COLUMN}={run}"
    spark, table = rows.sparkSession, feed.table
    counted, path = Observation(), f"{layout.path(table)}/{folder}"
    measures = [F.count(F.lit(1)).alias("_rows_seen"), F.count_if(all_hold(feed.rules)).alias("_rows_kept"), *failure_columns(feed.rules)]
    write_run(keep_valid(rows.observe(counted, *measures), feed.rules), table, path, feed.finish)
    counts = observed(counted) or rows.agg(*measures).first().asDict()
    if not counts["_rows_kept"] and table in PARTITION_BY:
        # A folder by date without dates has no file that tells its columns.
        by = PARTITION_BY[table]
        feed.finish(rows.where(F.lit(False))).drop(by).write.mode("overwrite").parquet(f"{path}/{by}=__HIVE_DEFAULT_PARTITION__")
    aside = f"{layout.quarantine(table)}/{folder}"
    if counts["_rows_kept"] < counts["_rows_seen"]:
        failing = feed.finish(rows.where(~all_hold(feed.rules)))
        failing.withColumn("failed_rules", failed_rules(feed.rules)).write.mode("overwrite").parquet(aside)
    else:
        delete_folder(spark._jvm, aside)
    long = spark.createDataFrame(list(counts.items()), "rule_name string, failed_rows long")
    long.coalesce(1).write.mode("overwrite").parquet(f"{layout.rule_counts(table)}/{folder}")
    return counts


def ingest(spark: SparkSession, layout: Layout, feed: BronzeFeed) -> IngestResult:
    """One availableNow run of a bronze streaming table; returns its counters."""
    compaction.finish(spark, layout, feed.table)
    stream = landing.read_csv_stream(spark, landing.dataset_path(layout.landing, feed.dataset), feed.schema)
    result = IngestResult(feed.table)

    def write(rows: DataFrame, run: int) -> None:
        counts = _split_run(feed.parse(rows), feed, layout, run)
        result.rows_read += counts["_rows_seen"]
        for rule in feed.rules:
            result.rule_failures[rule.name] = result.rule_failures.get(rule.name, 0) + counts[rule.name]

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", layout.checkpoint(feed.table))
        .trigger(availableNow=True)
        .queryName(f"ingest_{feed.table}_{abs(hash(layout.base)) % 10**8}")
        .start()
    )
    query.awaitTermination()
    return result


def quarantined(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """All quarantined rows of a bronze table's feed with their run and failed rules; None if there are none."""
    path = layout.quarantine(table)
    return spark.read.parquet(path) if runs(spark, path) else None


def landed_rule_counts(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """(rule_name, failed_rows) over all runs, from what the runs have counted."""
    counts = spark.read.parquet(layout.rule_counts(table))
    return counts.groupBy("rule_name").agg(F.sum("failed_rows").alias("failed_rows"))


def ingest_all(spark: SparkSession, layout: Layout, raw_schema: StructType = schemas.RAW_DAILY) -> list[IngestResult]:
    return [ingest(spark, layout, feed) for feed in feeds(raw_schema)]


def land(
    df: DataFrame, layout: Layout, dataset: str, delivery: str, schema: StructType | None = None, files: int | None = None
) -> str:
    """Write one delivery of a feed as CSV files into its landing folder (never overwrites).

    Each task writes a file; ``files`` deals the rows out to that many tasks first.
    """
    path = f"{landing.dataset_path(layout.landing, dataset)}/{delivery}"
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    with released_shuffles(df.sparkSession):
        landing.write_csv(df, path, files=files)
    return path
