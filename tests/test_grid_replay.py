"""The 8 x 80 x 90 grid through replay, streaming bronze and full refreshes.

Reproduces the published structural counts: rows per batch, cumulative
bronze and gold rows and gold max date per stage, late and corrected rows,
zero duplicate grains, and the corrected golden key.
"""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfguard import config as C
from shelfguard import schemas
from shelfguard.functions import hourly
from shelfguard.layout import Layout
from shelfguard.plans import bronze, masters, refresh, replay, reports
from shelfguard.plans.refresh import refresh_all, refresh_incremental
from shelfguard.session import scratch_path
from shelfguard.streaming.ingest import _split_run, feeds, ingest, ingest_all, land, landed_rule_counts, quarantined

from helpers import NO_BROADCAST, product_rows, raw_rows, session_conf, store_rows

CFG = C.GRID_REPLAY
STAMP = ("static-001", "2024-06-01 00:00:00+00:00")


def grid_feed(spark):
    i = F.col("id")
    product_idx = F.floor(i / 90) % 80
    sale = F.round(F.lit(2.6065) + product_idx * F.lit(0.5), 4)
    hours = F.when(i % 11 == 0, F.lit(3)).otherwise(F.lit(0)).cast("long")
    return spark.range(57600).select(
        (F.lit(100) + F.floor(i / 7200) % 5).cast("long").alias("city_id"),
        (F.lit(10000) + F.floor(i / 7200)).cast("long").alias("store_id"),
        (product_idx % 8 + 1).cast("long").alias("management_group_id"),
        (product_idx % 8 + 10).cast("long").alias("first_category_id"),
        (product_idx % 8 + 100).cast("long").alias("second_category_id"),
        (product_idx % 8 + 1000).cast("long").alias("third_category_id"),
        (F.lit(50000) + product_idx).cast("long").alias("product_id"),
        F.date_format(F.date_add(F.lit(date(2024, 3, 1)), (i % 90).cast("int")), "yyyy-MM-dd").alias("dt"),
        sale.alias("sale_amount"),
        F.to_json(hourly.hourly_profile(sale)).alias("hours_sale"),
        hours.alias("stock_hour6_22_cnt"),
        F.to_json(hourly.hourly_stock_status(hours)).alias("hours_stock_status"),
        F.lit(1.0).alias("discount"),
        F.lit(0).cast("long").alias("holiday_flag"),
        F.lit(0).cast("long").alias("activity_flag"),
        ((i % 8) / F.lit(16.0)).alias("precpt"),
        F.lit(50.25).alias("avg_temperature"),
        F.lit(40.5).alias("avg_humidity"),
        (i % 9).cast("double").alias("avg_wind_level"),
        F.lit("retail-daily-source").alias("source_dataset"),
        F.lit("train").alias("source_split"),
        F.lit("static-001").alias("batch_id"),
        F.lit(1).cast("long").alias("batch_seq"),
        F.lit("2024-06-01 00:00:00+00:00").alias("ingested_at"),
        i.alias("line_orderkey"),
        F.lit(1).cast("long").alias("line_number"),
    )


@pytest.fixture(scope="module")
def landed(spark):
    base = grid_feed(spark)
    return base, replay.replay_batches(base, CFG, C.GRID.days, "retail-daily-source", "train")


def test_manifest_counts(spark, landed):
    base, batches = landed
    got = {r.metric: r.value for r in replay.replay_manifest(batches, base).collect()}
    assert got == {
        "rows:replay-001-seed": 37200,
        "rows:replay-002-inc": 9600,
        "rows:replay-003-inc": 9600,
        "rows:replay-004-restatement": 1215,
        "raw_rows_landed_total": 57615,
        "corrected_rows": 15,
        "late_arriving_rows": 1200,
        "silver_fact_rows_after_full_replay": 57600,
    }


def test_master_keys(spark, landed):
    base, _ = landed
    stores = masters.assign_store_keys(base, *STAMP)
    products = masters.assign_product_keys(base, *STAMP)
    assert stores.count() == 8 and products.count() == 80
    assert products.where("source_product_id = 50000").first().northmart_product_id == "NM-SKU-00001"
    assert stores.where("source_store_id = 10007").first().northmart_store_id == "NM-STORE-008"


def land_masters(spark, layout, delivery="master", **store):
    """The grid's masters: eight stores, eighty products of one price."""
    stores = [{"northmart_store_id": f"NM-STORE-{i + 1:03d}", "source_store_id": 10000 + i, **store} for i in range(8)]
    products = [{"northmart_product_id": f"NM-SKU-{i + 1:05d}", "source_product_id": 50000 + i} for i in range(80)]
    land(store_rows(spark, stores), layout, "store_master", delivery, schemas.STORE_MASTER)
    if delivery == "master":
        land(product_rows(spark, products), layout, "product_master", delivery, schemas.PRODUCT_MASTER)


@pytest.fixture(scope="module")
def full_gold_rows(spark, landed):
    return {}


@pytest.mark.parametrize("mode", ["full", "incremental", "incremental-no-broadcast"])
def test_four_stage_replay(spark, landed, mode, full_gold_rows):
    # The last mode joins lookups, dimensions and signal by shuffle.
    with session_conf(spark, NO_BROADCAST if mode.endswith("no-broadcast") else {}):
        _four_stage_replay(spark, landed, mode, full_gold_rows)


def _four_stage_replay(spark, landed, mode, full_gold_rows):
    base, batches = landed
    layout = Layout(scratch_path(spark, f"grid-replay-{mode}"))
    land_masters(spark, layout)
    expected = [
        (37200, 37200, "2024-04-29"),
        (46800, 46800, "2024-05-14"),
        (56400, 56400, "2024-05-29"),
        (57615, 57600, "2024-05-29"),
    ]
    landed_batches = batches.drop("is_corrected", "is_late")
    for batch_id, (bronze_rows, gold_rows, max_date) in zip([d.batch_id for d in CFG.deliveries], expected, strict=True):
        land(landed_batches.where(F.col("batch_id") == batch_id), layout, "daily_observations", batch_id,
             schemas.RAW_DAILY_WITH_LINEAGE)
        if mode == "full":
            refresh_all(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
        else:
            if batch_id == CFG.restatement.batch_id:
                # A run that dies after ingesting, before silver and gold: the
                # next run must still carry those rows through.
                ingest_all(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE)
            run = refresh_incremental(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
            expected_mode = "full" if batch_id == CFG.deliveries[0].batch_id else "incremental"
            assert run["mode"] == expected_mode
        bronze = layout.read(spark, "bronze_daily_observations")
        gold = layout.read(spark, "gold_stockout_daily")
        progress = {r.k: r.v for r in reports.progress_counts(bronze, layout.read(spark, "fact_sales"), gold).collect()}
        assert progress == {
            "bronze_landed": str(bronze_rows),
            "silver_fact_sales": str(gold_rows),
            "gold_rows": str(gold_rows),
            "gold_max_date": max_date,
        }

    bronze = layout.read(spark, "bronze_daily_observations")
    gold = layout.read(spark, "gold_stockout_daily")
    sales = layout.read(spark, "fact_sales")
    assert {r.batch_id: r.rows for r in reports.batch_provenance(bronze).collect()} == {
        "replay-001-seed": 37200, "replay-002-inc": 9600, "replay-003-inc": 9600, "replay-004-restatement": 1215,
    }
    late = reports.late_arrivals_check(gold, "NM-STORE-008", date(2024, 3, 16)).first()
    assert late.late_store_early_rows == 1200
    assert reports.grain_integrity(sales, C.FACT_GRAIN, "fact_sales").first().duplicate_rows == 0
    assert layout.read(spark, "fact_external_signal").count() == 720
    assert layout.read(spark, "dim_date").count() == 90
    rows = reports.restatement_check(
        gold, "NM-STORE-001", "NM-SKU-00001", [date(2024, 3, 6), date(2024, 3, 7), date(2024, 3, 8)]
    ).collect()
    assert [(r.stockout_hours, r.priority_tier) for r in rows] == [(8, "critical")] * 3
    assert (rows[0].rev, rows[0].lost) == (697.45, 328.21)
    # Incremental partition replacement must equal the full recompute.
    snapshot = sorted(tuple(r) for r in gold.select(*sorted(gold.columns)).drop("refreshed_at").collect())
    full_gold_rows[mode] = snapshot
    if mode != "full" and "full" in full_gold_rows:
        assert full_gold_rows["full"] == snapshot


# -- what an incremental refresh must not miss -----------------------------------------
TABLES = ("dim_store", "dim_product", "dim_date", "fact_sales", "fact_inventory_status", "fact_promotion", "fact_external_signal", "gold_stockout_daily", "gold_daily_partials")


def _contents(spark, layout):
    out = {}
    for name in TABLES:
        rows = layout.read(spark, name).drop("processed_at", "refreshed_at")
        if name == "gold_daily_partials":  # sums of doubles depend on the order of rows
            rows = rows.select(*[F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else f.name for f in rows.schema.fields])
        out[name] = sorted(str(tuple(r)) for r in rows.select(*sorted(rows.columns)).collect())
    return out


def _land(spark, layout, delivery, rows):
    land(raw_rows(spark, rows).drop("_source_file", "_loaded_at"), layout, "daily_observations", delivery, schemas.RAW_DAILY_WITH_LINEAGE)


def _incremental(spark, layout):
    return refresh_incremental(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)


@pytest.fixture
def small(spark):
    layout = Layout(scratch_path(spark, "small-refresh"))
    land_masters(spark, layout)
    _land(spark, layout, "one", [{"dt": f"2024-03-{d:02d}", "store_id": 10000 + d % 3, "line_number": d, "discount": 0.85} for d in range(1, 8)])
    assert _incremental(spark, layout)["mode"] == "full"
    return layout


def test_a_master_landed_before_a_failed_run_reaches_gold(spark, small, monkeypatch):
    land_masters(spark, small, "moved", region="Elsewhere", ingested_at="2024-07-01 00:00:00+00:00")
    with monkeypatch.context() as m:
        m.setattr(refresh, "refresh_silver", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            _incremental(spark, small)
    run = _incremental(spark, small)
    assert (run["mode"], run["dates"]) == ("incremental", 7)  # every date holds a moved store
    assert {r.region for r in small.read(spark, "gold_stockout_daily").collect()} == {"Elsewhere"}
    got = _contents(spark, small)
    refresh_all(spark, small, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    assert _contents(spark, small) == got
    assert _incremental(spark, small)["mode"] == "none"


def test_a_date_whose_rows_all_fail_a_rule_leaves_nothing(spark, small):
    # The rate rounds to 1: the promotion rule drops the only row of the date.
    _land(spark, small, "two", [{"dt": "2024-03-02", "store_id": 10002, "line_number": 2, "batch_seq": 2, "discount": 0.00001}])
    run = _incremental(spark, small)
    assert (run["mode"], run["dates"]) == ("incremental", 1)
    got = _contents(spark, small)
    assert len(got["fact_promotion"]) == 6 and len(got["gold_stockout_daily"]) == 7
    refresh_all(spark, small, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    assert _contents(spark, small) == got


def test_full_refresh_drops_tables_and_checkpoints_and_reads_again(spark, small):
    before = _contents(spark, small)
    spark.range(3).write.mode("overwrite").parquet(small.path("fact_sales"))  # damage
    results = refresh.full_refresh(spark, small, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    assert {r.table: r.rows_read for r in results}["bronze_daily_observations"] == 7
    assert _contents(spark, small) == before


# -- master changes as deltas ------------------------------------------------------------
def _files(layout, table):
    """Data files by date folder."""
    found = Path(layout.path(table).removeprefix("file:")).rglob("*.parquet")
    return {f.parent.name: f.name for f in found}


def test_a_changed_product_rewrites_only_its_dates(spark):
    layout = Layout(scratch_path(spark, "delta-refresh"))
    land_masters(spark, layout)
    _land(spark, layout, "one", [{"dt": f"2024-03-{d:02d}", "product_id": 50000 + d % 3, "line_number": d} for d in range(1, 10)])
    _land(spark, layout, "unknown", [{"dt": "2024-03-20", "product_id": 59999, "line_number": 99}])
    assert _incremental(spark, layout)["mode"] == "full"
    before = {t: _files(layout, t) for t in ("fact_sales", "gold_stockout_daily")}
    # One product costs more; another is listed for the first time.
    moved = [
        {"northmart_product_id": "NM-SKU-00002", "source_product_id": 50001, "base_unit_price": 99.0, "ingested_at": "2024-07-01 00:00:00+00:00"},
        {"northmart_product_id": "NM-SKU-09999", "source_product_id": 59999, "ingested_at": "2024-07-01 00:00:00+00:00"},
    ]
    land(product_rows(spark, moved), layout, "product_master", "moved", schemas.PRODUCT_MASTER)
    run = _incremental(spark, layout)
    assert (run["mode"], run["dates"]) == ("incremental", 4)
    touched = {"date_key=2024-03-01", "date_key=2024-03-04", "date_key=2024-03-07", "date_key=2024-03-20"}
    for table, old in before.items():
        new = _files(layout, table)
        assert {d for d in new if new[d] != old.get(d)} == touched
    got = _contents(spark, layout)
    refresh_all(spark, layout, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    assert _contents(spark, layout) == got
    # The same master landed again changes nothing: no date is touched.
    again = [{**m, "ingested_at": "2024-08-01 00:00:00+00:00"} for m in moved]
    land(product_rows(spark, again), layout, "product_master", "again", schemas.PRODUCT_MASTER)
    run = _incremental(spark, layout)
    assert (run["mode"], run["dates"]) == ("incremental", 0) and _contents(spark, layout) == got


# -- a write that dies -------------------------------------------------------------------
def test_a_refresh_killed_during_a_write_leaves_every_old_date_whole(spark, small, monkeypatch):
    before = _contents(spark, small)["gold_stockout_daily"]
    _land(spark, small, "two", [{"dt": f"2024-03-{d:02d}", "store_id": 10000 + d % 3, "line_number": d, "batch_seq": 2, "sale_amount": 9.0} for d in (2, 3, 4)])
    build = refresh.gold.stockout_mart

    def dies(*inputs):
        broken = F.when(F.col("date_key") == F.lit(date(2024, 3, 4)), F.raise_error(F.lit("executor lost"))).otherwise(F.col("observed_units"))
        return build(*inputs).withColumn("observed_units", broken.cast("double"))

    with monkeypatch.context() as m:
        m.setattr(refresh.gold, "stockout_mart", dies)
        with pytest.raises(Exception, match="executor lost"):
            _incremental(spark, small)
    assert _contents(spark, small)["gold_stockout_daily"] == before
    assert _incremental(spark, small)["dates"] == 3
    got = _contents(spark, small)
    assert got["gold_stockout_daily"] != before
    refresh_all(spark, small, schemas.RAW_DAILY_WITH_LINEAGE, schemas.LINEAGE_COLUMNS)
    assert _contents(spark, small) == got


# -- quarantine ---------------------------------------------------------------------------
def test_kept_and_quarantined_rows_are_what_landed(spark):
    layout = Layout(scratch_path(spark, "quarantine"))
    feed = feeds(schemas.RAW_DAILY_WITH_LINEAGE)[0]
    good = [{"dt": f"2024-03-{d:02d}", "line_number": d} for d in range(1, 6)]
    deliveries = [good, [*good, {"dt": "not a date"}, {"dt": "2024-03-09", "sale_amount": -1.0, "store_id": None}], [{"dt": "nor this"}]]
    for n, rows in enumerate(deliveries):
        _land(spark, layout, f"d{n}", rows)
        result = ingest(spark, layout, feed)
        assert result.rows_read == len(rows)
    kept = spark.read.parquet(layout.path(feed.table)).groupBy("_run").count()
    aside = quarantined(spark, layout, feed.table)
    assert {r["_run"]: r["count"] for r in kept.collect()} == {0: 5, 1: 5}
    assert {r["_run"]: r["count"] for r in aside.groupBy("_run").count().collect()} == {1: 2, 2: 1}
    names = {tuple(r.failed_rules) for r in aside.collect()}
    assert all(names) and any(len(n) > 1 for n in names)
    counts = {r.rule_name: r.failed_rows for r in landed_rule_counts(spark, layout, feed.table).collect()}
    assert counts["_rows_seen"] == 13 and counts["_rows_kept"] == 10
    exploded = aside.select(F.explode("failed_rules").alias("rule")).groupBy("rule").count().collect()
    assert {r.rule: r["count"] for r in exploded} == {k: v for k, v in counts.items() if v and not k.startswith("_")}
    # A run repeated after a failure overwrites its folders; one without failures clears its quarantine.
    rows = raw_rows(spark, good)
    _split_run(bronze.parse_raw_daily(rows), feed, layout, 1)
    assert spark.read.parquet(layout.path(feed.table)).count() == 10
    assert {r["_run"] for r in quarantined(spark, layout, feed.table).select("_run").distinct().collect()} == {2}


def test_a_feed_of_failing_rows_only_is_an_empty_table(spark):
    layout = Layout(scratch_path(spark, "quarantine-all"))
    feed = feeds(schemas.RAW_DAILY_WITH_LINEAGE)[0]
    _land(spark, layout, "bad", [{"dt": "x"}, {"dt": "y"}])
    ingest(spark, layout, feed)
    assert layout.read(spark, feed.table).count() == 0 and "store_id" in layout.read(spark, feed.table).columns
    assert quarantined(spark, layout, feed.table).count() == 2


# -- replay loses nothing ---------------------------------------------------------------
def test_replay_keeps_rows_without_a_date_and_refuses_days_outside(spark):
    plan = lambda rows: replay.replay_batches(raw_rows(spark, rows), CFG, C.GRID.days, "d", "train")
    got = sorted((r.dt, r.batch_id) for r in plan([{"dt": "not a date"}, {"dt": "2024-03-01"}, {"dt": "2024-05-29"}]).collect())
    assert got == [("2024-03-01", "replay-001-seed"), ("2024-05-29", "replay-003-inc"), ("not a date", "replay-001-seed")]
    for day in ("2024-02-29", "2024-05-30"):
        with pytest.raises(Exception, match="no delivery takes the rows of " + day):
            plan([{"dt": day}]).collect()


@pytest.mark.parametrize("days", [89, 91])
def test_replay_must_cover_the_history(spark, days):
    with pytest.raises(C.ReplayError, match="90 days"):
        replay.replay_batches(raw_rows(spark, [{}]), CFG, days, "d", "train")
