"""Physical-plan shape: the properties the scale design relies on."""

from __future__ import annotations

import re
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from helpers import NO_BROADCAST, product_rows, raw_rows, session_conf, store_rows
from shelfguard.plans import bronze, gold, silver
from shelfguard.session import prepare, scratch_path, staged


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_limits_before_the_shuffle(spark):
    raw = bronze.bronze_raw_daily(raw_rows(spark, [{"batch_seq": s} for s in (1, 2, 3)]))
    plan = df_plan = physical(silver.latest_observations(raw))
    # Partial WindowGroupLimit below the exchange, final one above it.
    assert plan.count("WindowGroupLimit") >= 2, df_plan
    first_exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[first_exchange:], plan


def _masters(spark, n_stores, n_products):
    stores = bronze.bronze_store_master(
        store_rows(spark, [{"source_store_id": 10000 + i, "northmart_store_id": f"NM-STORE-{i:03d}"} for i in range(n_stores)])
    )
    products = bronze.bronze_product_master(
        product_rows(
            spark, [{"source_product_id": 50000 + i, "northmart_product_id": f"NM-SKU-{i:05d}"} for i in range(n_products)]
        )
    )
    return stores, products


def _mart(spark, rows=({},), n_stores=1, n_products=1, tag="plan"):
    """The mart over silver tables written and read back, as a refresh runs it."""
    prepare(spark)
    raw = bronze.bronze_raw_daily(raw_rows(spark, list(rows)))
    stores, products = _masters(spark, n_stores, n_products)
    path = scratch_path(spark, f"{tag}-latest")
    silver.latest_observations(raw).drop("hours_sale", "hours_stock_status").write.parquet(path)
    keyed = silver.keyed_observations(spark.read.parquet(path), stores, products)
    facts = {}
    for name, build in (
        ("sales", silver.fact_sales),
        ("inventory", silver.fact_inventory_status),
        ("promotion", silver.fact_promotion),
        ("external", silver.fact_external_signal),
    ):
        fact_path = scratch_path(spark, f"{tag}-{name}")
        build(keyed).write.parquet(fact_path)
        facts[name] = spark.read.parquet(fact_path)
    return gold.stockout_mart(
        facts["sales"], facts["inventory"], facts["promotion"], facts["external"],
        staged(silver.dim_store(stores), f"{tag}-stores"), staged(silver.dim_product(products), f"{tag}-products"),
    )


def _static_plan(spark, df) -> str:
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # inspect the static plan
    try:
        # A copy: the executed plan is fixed per DataFrame once computed.
        return physical(df.select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)


def _exchanges(plan):
    store_date = re.findall(r"hashpartitioning\(store_key#\d+, (?:date_key|dt)#\d+, \d+\)", plan)
    grain = re.findall(r"hashpartitioning\(store_key#\d+, product_key#\d+, date_key#\d+", plan)
    return store_date, grain


def test_mart_shuffles_facts_on_the_full_grain(spark):
    with session_conf(spark, NO_BROADCAST):
        plan = _static_plan(spark, _mart(spark))
    store_date, grain = _exchanges(plan)
    # sales, inventory, promotion hash on (store, product, date) once each; the
    # signal meets the joined rows in one (store, date) join.
    assert len(grain) == 3, plan
    assert len(store_date) == 2, plan


def test_small_sides_are_broadcast_by_their_size(spark):
    final = _mart(spark, tag="plan-small")
    final.collect()
    assert physical(final).count("BroadcastHashJoin") >= 3


def test_facts_of_the_grain_are_never_broadcast(spark):
    """However small their files are: their rows are as many as the mart's."""
    plan = _static_plan(spark, _mart(spark, tag="plan-grain"))
    assert len(_exchanges(plan)[1]) == 3, plan
    assert len(re.findall(r"SortMergeJoin \[store_key#\d+, product_key#\d+, date_key#\d+\]", plan)) == 2, plan
    assert plan.count("BroadcastHashJoin") == 3, plan


def test_mart_splits_a_hot_store_date_when_nothing_is_broadcast(spark):
    # One store-date holds most rows (3000 products); seven others are thin.
    hot = [
        {"product_id": 50000 + p, "line_number": p, "sale_amount": (p * 37 % 1000) / 7.0, "stock_hour6_22_cnt": p % 17}
        for p in range(3000)
    ]
    cold = [
        {"store_id": 10001 + s, "dt": f"2024-03-{day:02d}", "line_number": 100000 + s * 100 + day}
        for s in range(7)
        for day in range(1, 29)
    ]
    settings = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session_conf(spark, settings):
        mart = _mart(spark, hot + cold, n_stores=8, n_products=3000, tag="plan-skew")
        static = _static_plan(spark, mart)
        assert mart.count() == 3000 + 7 * 28
        mart.collect()
        final = physical(mart)
    store_date, grain = _exchanges(static)
    # Facts on the grain; then the joined rows and the signal's table scan
    # meet in one (store, date) shuffle join, the last join of the plan.
    assert len(grain) == 3, static
    assert len(store_date) == 2, static
    assert "SortMergeJoin(skew=true) [store_key" in final, final


def test_filters_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "plan-scan")
    spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"), F.lit("x").alias("s")).write.parquet(path)
    plan = physical(spark.read.parquet(path).where(F.col("k") == 3).select("id"))
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan
    assert "ReadSchema: struct<id:bigint,k:bigint>" in plan


def test_keyed_join_splits_a_hot_product_when_lookups_are_not_broadcast(spark):
    # One product holds most rows (3000 store-dates); 196 other products are thin.
    hot = [
        {"store_id": 10000 + s % 8, "dt": (date(2024, 1, 1) + timedelta(days=s // 8)).isoformat(), "line_number": s}
        for s in range(3000)
    ]
    cold = [{"product_id": 50001 + p, "line_number": 100000 + p} for p in range(196)]
    settings = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session_conf(spark, settings):
        prepare(spark)
        raw = bronze.bronze_raw_daily(raw_rows(spark, hot + cold))
        stores, products = _masters(spark, 8, 197)
        path = scratch_path(spark, "plan-hot-product")
        silver.latest_observations(raw).drop("hours_sale", "hours_stock_status").write.parquet(path)
        keyed = silver.keyed_observations(spark.read.parquet(path), stores, products)
        assert keyed.count() == 3000 + 196
        keyed.collect()
        final = physical(keyed)
    assert "BroadcastHashJoin" not in final, final
    assert "SortMergeJoin(skew=true) [product_id" in final, final


def test_watermark_reads_prune_older_bronze_files(spark):
    from shelfguard.layout import Layout
    from shelfguard.plans import refresh

    layout = Layout(scratch_path(spark, "plan-watermark"))
    for day in (1, 2, 3):  # three appends, one file each, increasing load times
        spark.range(5).select(
            F.col("id"), F.to_timestamp(F.lit(f"2024-06-0{day} 12:00:00")).alias("_loaded_at")
        ).coalesce(1).write.mode("append").parquet(layout.path(refresh.RAW_TABLE))
    newer = refresh._loaded_after(spark, layout, refresh.RAW_TABLE, "2024-06-02 00:00:00.000000")
    assert "GreaterThan(_loaded_at," in physical(newer)
    assert newer.count() == 10
    assert refresh.newest_load(spark, layout, refresh.RAW_TABLE, "2024-06-02 00:00:00.000000") == "2024-06-03 12:00:00.000000"
    # Nothing newer: the watermark stays where it was.
    assert refresh.newest_load(spark, layout, refresh.RAW_TABLE, "2024-06-04 00:00:00.000000") == "2024-06-04 00:00:00.000000"


def test_building_a_serving_query_runs_no_job_beyond_the_written_tables(spark):
    """Once the tables stand, a query is a plan over them: no measuring jobs."""
    from shelfguard.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    QUERIES["contract_report"](spark, sf), QUERIES["daily_partials"](spark, sf)  # write every table
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for name in ("kpi_lost_sales", "filter_options", "top_offenders", "contract_report", "grain_integrity", "slice_validation"):
            QUERIES[name](spark, sf)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert physical(QUERIES["filter_options"](spark, sf)).count("FileScan") == 1


def _files_read(df) -> int:
    """Files that the scans of a plan without adaptive execution have opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString()]
    return sum(s.metrics().apply("numFiles").value() for s in scans)


def test_incremental_reads_open_only_the_files_of_touched_dates(spark):
    """Bronze, the staged tables, facts and gold: partitions are filtered at run time by the touched dates."""
    from shelfguard import schemas
    from shelfguard.layout import Layout
    from shelfguard.plans import refresh
    from shelfguard.streaming.ingest import land

    layout = Layout(scratch_path(spark, "plan-dates"))
    land(store_rows(spark, [{}]), layout, "store_master", "m", schemas.STORE_MASTER)
    land(product_rows(spark, [{}]), layout, "product_master", "m", schemas.PRODUCT_MASTER)
    rows = raw_rows(spark, [{"dt": (date(2024, 1, 1) + timedelta(days=i % 30)).isoformat(), "line_number": i} for i in range(60)])
    land(rows.drop("_source_file", "_loaded_at"), layout, "daily_observations", "one", schemas.RAW_DAILY_WITH_LINEAGE, 1)
    refresh.refresh_incremental(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    days = spark.createDataFrame([(date(2024, 1, 3),), (date(2024, 1, 20),)], "dt date")
    touched = refresh.Touched.of(days)
    assert (touched.count, touched.first, touched.last) == (2, date(2024, 1, 3), date(2024, 1, 20))
    tables = {refresh.RAW_TABLE: "dt", refresh.LATEST_STAGE: "dt", refresh.KEYED_STAGE: "dt", "fact_sales": "date_key", refresh.GOLD_TABLE: "date_key"}
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        for table, column in tables.items():
            found = touched.rows_of(layout.read(spark, table), column)
            plan = physical(found)
            assert "SubqueryBroadcast dynamicpruning" in plan, plan
            # Two files of the table, and those of the dates themselves.
            own = _files_read(touched.dates)
            assert _files_read(found) <= 2 + own < _files_read(layout.read(spark, table))
            assert found.count() == (4 if table == refresh.RAW_TABLE else 2)


def test_newer_runs_are_read_by_their_folders(spark):
    from shelfguard.layout import Layout, newest_run
    from shelfguard.plans import refresh

    layout = Layout(scratch_path(spark, "plan-runs"))
    for run in range(4):
        rows = spark.range(5).select(F.to_timestamp(F.lit(f"2024-06-0{run + 1} 12:00:00")).alias("_loaded_at"), F.lit(date(2024, 1, 1 + run)).alias("dt"))
        rows.coalesce(1).write.partitionBy("dt").parquet(f"{layout.path(refresh.RAW_TABLE)}/_run={run}")
    assert newest_run(spark, layout, refresh.RAW_TABLE) == 3
    newer = refresh._loaded_after(spark, layout, refresh.RAW_TABLE, "2024-06-03 00:00:00.000000", 1)
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        again = newer.select("*")
        assert _files_read(again) == 2
    assert newer.count() == 10


def test_a_date_filter_opens_only_its_files(spark):
    """Rows landed in any order are written by date: a filter on dt prunes folders."""
    from shelfguard import schemas
    from shelfguard.layout import Layout
    from shelfguard.plans import refresh
    from shelfguard.streaming.ingest import feeds, ingest, land

    layout = Layout(scratch_path(spark, "plan-date-folders"))
    rows = raw_rows(spark, [{"dt": (date(2024, 1, 1) + timedelta(days=i * 37 % 20)).isoformat(), "line_number": i} for i in range(80)])
    feed = feeds(schemas.RAW_DAILY_WITH_LINEAGE)[0]
    land(rows.drop("_source_file", "_loaded_at"), layout, "daily_observations", "one", schemas.RAW_DAILY_WITH_LINEAGE, 1)
    ingest(spark, layout, feed)
    files = [f.parent.name for f in Path(layout.path(refresh.RAW_TABLE).removeprefix("file:")).rglob("*.parquet")]
    assert len(files) == len(set(files)) == 20  # one file per date and run
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        found = layout.read(spark, refresh.RAW_TABLE).where(F.col("dt") == F.lit(date(2024, 1, 9)))
        assert _files_read(found) == 1 and found.count() == 4


def test_widgets_fold_the_partials_and_read_no_mart_file(spark):
    from shelfguard.catalog import QUERIES, _main
    from shelfguard.plans import serving

    sf = "/root/testdata/sf0.001"
    m = _main(spark, sf)
    m.partials.count()
    for name in ("kpi_lost_sales", "kpi_stockout_rate", "kpi_critical_rows", "lost_sales_by_region", "lost_sales_by_category", "lost_sales_trend", "priority_mix", "filter_options"):
        paths = re.findall(r"Location: InMemoryFileIndex[^\[]*\[([^\]]*)", QUERIES[name](spark, sf)._jdf.queryExecution().explainString(_formatted(spark)))
        assert paths and all("gold_daily_partials" in p for p in paths), (name, paths)
    every = {r.filter_name: [] for r in QUERIES["filter_options"](spark, sf).collect()}
    for r in sorted(QUERIES["filter_options"](spark, sf).collect()):
        every[r.filter_name].append(r.filter_value)
    choices = [((), (), ()), (every["region"][:2], (), ()), ((), every["category"][1:3], ("critical", "high")), (every["region"][-1:], every["category"][:4], ("low",)), (("nowhere",), (), ())]
    for regions, categories, tiers in choices:
        filters = serving.MartFilters(tuple(regions), tuple(categories), tuple(tiers))
        rows = filters.apply(m.dataset)
        got = {(r.widget, r.item): r.value for r in serving.dashboard(m.partials, filters).collect()}
        sums = rows.agg(F.round(F.sum("lost_sales_proxy"), 2), F.avg("stockout_int"), F.sum("critical_int")).first()
        assert [got[k, None] for k in ("kpi_lost_sales", "kpi_stockout_rate", "kpi_critical_rows")] == list(sums)
        for widget, column in (("lost_sales_by_region", "region"), ("lost_sales_by_category", "category"), ("lost_sales_trend", "date_key")):
            wanted = rows.groupBy(F.col(column).cast("string")).agg(F.round(F.sum("lost_sales_proxy"), 2)).collect()
            assert {i: v for (w, i), v in got.items() if w == widget} == dict(map(tuple, wanted))
        assert {i: v for (w, i), v in got.items() if w == "priority_mix"} == dict(map(tuple, rows.groupBy("priority_tier").count().collect()))


def _formatted(spark):
    return spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
