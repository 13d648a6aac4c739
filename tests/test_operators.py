"""Generic operators against brute force on small inputs."""

from __future__ import annotations

import json
import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import product_rows, raw_rows, session_conf, store_rows
from shelfguard import contracts as K
from shelfguard import expectations as X
from shelfguard import schemas, session
from shelfguard.config import Expected
from shelfguard.layout import Layout, runs
from shelfguard.operators import layout as layout_ops
from shelfguard.operators.rules import rule_failures
from shelfguard.operators.sampling import enough_rows, sample_first_keys
from shelfguard.operators.sequence import dense_sequence
from shelfguard.plans import bronze, compaction, refresh, validation
from shelfguard.plans.contracts import contract_report, schema_report
from shelfguard.session import scratch_path
from shelfguard.streaming.ingest import land, write_run


def test_dense_sequence_matches_sorted_rank(spark):
    rng = random.Random(7)
    ids = [rng.randrange(-10_000, 10_000_000) for _ in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids + ids[:500]], "id long")
    got = {r.id: r.seq for r in dense_sequence(df, "id").collect()}
    expect = {v: n for n, v in enumerate(sorted(set(ids)), start=1)}
    assert got == expect


def brute_sample(rows, n_stores, n_products, start, end, target):
    stores, products, out = [], [], []
    for r in rows:  # rows already in arrival order
        if not (start <= r["dt"] <= end):
            continue
        if r["store_id"] not in stores and len(stores) < n_stores:
            stores.append(r["store_id"])
        if r["product_id"] not in products and len(products) < n_products:
            products.append(r["product_id"])
        if r["store_id"] in stores and r["product_id"] in products:
            out.append(r["pos"])
        if len(out) >= target:
            break
    return out


@pytest.mark.parametrize("target", [10, 75, 10_000])
def test_sample_first_keys_matches_streaming_loop(spark, target):
    rng = random.Random(target)
    start = date(2024, 1, 1)
    rows = [
        {"pos": p, "store_id": rng.randrange(20), "product_id": rng.randrange(50),
         "dt": start + timedelta(days=rng.randrange(120))}
        for p in range(2000)
    ]
    df = spark.createDataFrame([(r["pos"], r["store_id"], r["product_id"], r["dt"]) for r in rows],
                               "pos long, store_id long, product_id long, dt date")
    lo, hi = date(2024, 2, 1), date(2024, 3, 31)
    got = sample_first_keys(
        df, store_col="store_id", product_col="product_id", date_col="dt", position=["pos"],
        start=lo, end=hi, n_stores=5, n_products=12, target=target,
    )
    wanted = sorted(brute_sample(rows, 5, 12, lo, hi, target))
    assert sorted(r.pos for r in got.collect()) == wanted
    for first_range, origin in ((7, 0), (150, -40), (50, 1900)):  # several rounds, or one
        got = sample_first_keys(
            df, store_col="store_id", product_col="product_id", date_col="dt", position=["pos"],
            start=lo, end=hi, n_stores=5, n_products=12, target=target, first_range=first_range, origin=origin,
        )
        assert sorted(r.pos for r in got.collect()) == wanted


def test_a_sample_stops_before_later_files(spark):
    path = session.scratch_path(spark, "sample-scan")
    rows = spark.range(40_000).select(F.col("id").alias("pos"), (F.col("id") % 30).alias("store_id"), (F.col("id") % 70).alias("product_id"), F.lit(date(2024, 1, 1)).alias("dt"))
    rows.repartitionByRange(40, "pos").sortWithinPartitions("pos").write.parquet(path)
    df = spark.read.parquet(path)
    some = enough_rows(df, "store_id", "product_id", ["pos"], 5, 12, 40, 0, 100)
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        read = some.select("*")
        n = read.count()
        leaves = read.groupBy().count()
        leaves.collect()
        scan = leaves._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert "LessThanOrEqual(pos" in scan.toString() and scan.metrics().apply("numOutputRows").value() <= 4000
    assert 100 <= n <= 2000
    got = sample_first_keys(
        df, store_col="store_id", product_col="product_id", date_col="dt", position=["pos"], start=date(2024, 1, 1), end=date(2024, 1, 1),
        n_stores=5, n_products=12, target=40, first_range=100,
    )
    assert sorted(r.pos for r in got.collect()) == [p for p in range(40_000) if p % 30 < 5 and p % 70 < 12][:40]


def test_rule_failures_counts_nulls_as_failures(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, date(2024, 1, 1), None, 0, 1.0), (1, 1, 1, date(2024, 1, 1), 2.0, 18, 0.0)],
        "city_id long, store_id long, product_id long, dt date, sale_amount double, stock_hour6_22_cnt long, discount double",
    )
    got = {r.rule_name: r.failed_rows for r in rule_failures(df, X.BRONZE_RAW_DAILY).collect()}
    assert got == {"_rows_seen": 2, "_rows_kept": 0, "valid_raw_business_key": 0, "valid_sales_amount": 1,
                   "valid_stockout_hours": 1, "valid_discount": 1}


def test_contract_report_and_schema(spark):
    df = spark.createDataFrame(
        [("s1", "p1", date(2024, 1, 1), 1.0), ("s1", "p1", date(2024, 1, 1), -1.0), (None, "p2", None, 2.0)],
        "store_key string, product_key string, date_key date, observed_units double",
    )
    rows = {r.check_name: r.failures for r in contract_report(df, K.FACT_SALES).collect()}
    assert rows["required:store_key"] == 1
    assert rows["required:date_key"] == 1
    assert rows["check_1:observed_units >= 0"] == 1
    assert rows["primary_key:store_key,product_key,date_key"] == 1
    assert rows["column:observed_units:double"] == 0
    # An absent required column fails its column check, and on every row.
    assert rows["column:estimated_revenue:decimal(12,2)"] == 1 and rows["required:estimated_revenue"] == 3
    assert dict(schema_report(df.withColumn("observed_units", F.lit("x")), K.FACT_SALES))["column:observed_units:double"] == 1


def test_contract_without_its_key_column_fails_on_every_row(spark):
    df = spark.createDataFrame([("a",), ("b",)], "region string")
    rows = {r.check_name: (r.failures, r.passed) for r in contract_report(df, K.DIM_STORE).collect()}
    assert rows["primary_key:store_key"] == (2, False) and rows["required:store_key"] == (2, False)
    assert rows["column:region:string"] == (0, True)


RULE_BREAKERS = {
    "bronze_raw_daily": ("city_id long, store_id long, product_id long, dt date, sale_amount double, stock_hour6_22_cnt long, discount double",
                         [(None, 1, 1, date(2024, 1, 1), -1.0, 18, 0.0)]),
    "bronze_store_master": ("northmart_store_id string, store_format string", [(None, "kiosk")]),
    "bronze_product_master": ("northmart_product_id string, base_unit_price double, replenishment_class string", [(None, 0.0, "x")]),
    "dim_store": ("store_key string", [(None,)]),
    "dim_product": ("product_key string, base_unit_price double", [(None, -1.0)]),
    "dim_date": ("date_key date", [(None,)]),
    "fact_sales": ("store_key string, product_key string, date_key date, observed_units double, estimated_revenue double", [(None, "p", None, -1.0, None)]),
    "fact_inventory_status": ("store_key string, product_key string, date_key date, stockout_hours int, service_window_hours int", [("s", None, None, 18, 17)]),
    "fact_promotion": ("store_key string, product_key string, date_key date, discount_rate double", [("s", "p", None, 1.0)]),
    "fact_external_signal": ("store_key string, date_key date, demand_signal_bucket string", [(None, None, "storm")]),
    "gold_stockout_daily": ("store_key string, product_key string, date_key date, observed_units double, estimated_revenue double, lost_sales_proxy double, priority_tier string",
                            [("s", "p", None, 1.0, 1.0, -1.0, "none")]),
}


def test_there_are_25_rules():
    assert sum(map(len, X.BY_TABLE.values())) == 25 and set(X.BY_TABLE) == set(RULE_BREAKERS)


@pytest.mark.parametrize("table", sorted(RULE_BREAKERS))
def test_every_rule_sees_a_row_that_breaks_it(spark, table):
    ddl, rows = RULE_BREAKERS[table]
    got = {r.rule_name: r.failed_rows for r in rule_failures(spark.createDataFrame(rows, ddl), X.BY_TABLE[table], table).collect()}
    assert got == {"_rows_seen": 1, "_rows_kept": 0, **{r.name: 1 for r in X.BY_TABLE[table]}}


def test_validation_names_missing_columns_and_goes_on(spark):
    raw, stores, products = raw_rows(spark, [{}]), store_rows(spark, [{}]), product_rows(spark, [{}])
    cfg = Expected(stores=1, products=1, days=1)
    parsed = bronze.parse_raw_daily(raw)
    assert all(r.passed for r in validation.slice_validation(parsed, stores, products, cfg).collect())
    report = {r.check_name: r for r in validation.slice_validation(parsed.drop("sale_amount", "dt"), stores.drop("region"), products, cfg).collect()}
    assert len(report) == 18
    assert report["raw_missing_columns"].detail == "dt,sale_amount" and report["raw_missing_columns"].actual == 2
    assert report["raw_negative_sale_amount"].actual == 1 and report["store_missing_columns"].detail == "region"
    with pytest.raises(validation.ValidationError, match=r"raw_missing_columns.*\(dt\)"):
        validation.raise_on_failure(validation.slice_validation(parsed.drop("dt"), stores, products, cfg).where("check_name = 'raw_missing_columns'"))


def test_landed_files_are_validated(spark):
    layout = Layout(scratch_path(spark, "validate"))
    with pytest.raises(FileNotFoundError, match="daily_observations"):
        validation.validate_landing(spark, layout, Expected(1, 1, 1))
    land(raw_rows(spark, [{}]), layout, "daily_observations", "a", schemas.RAW_DAILY)
    land(store_rows(spark, [{}]), layout, "store_master", "a", schemas.STORE_MASTER)
    land(product_rows(spark, [{}]), layout, "product_master", "a", schemas.PRODUCT_MASTER)
    assert all(r.passed for r in validation.validate_landing(spark, layout, Expected(1, 1, 1)).collect())
    with pytest.raises(validation.ValidationError, match="raw_date_cardinality: expected 2, got 1"):
        validation.validate_landing(spark, layout, Expected(1, 1, 2))


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(SimpleNamespace(sparkContext=context, conf={}))


def test_validation_raises_on_first_failure(spark):
    report = spark.createDataFrame(
        [("b_check", 1, 1, True), ("a_check", 1, 2, False)], "check_name string, expected long, actual long, passed boolean"
    )
    with pytest.raises(validation.ValidationError, match="a_check"):
        validation.raise_on_failure(report)


# -- Z-order and compaction -----------------------------------------------------------
def _row_groups(path, **wanted):
    """(row groups, those whose statistics admit each wanted value)."""
    import pyarrow.parquet as pq

    total, kept = 0, dict.fromkeys(wanted, 0)
    for file in Path(path.removeprefix("file:")).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            for c, value in wanted.items():
                kept[c] += columns[c].min <= value <= columns[c].max
    return total, kept


@pytest.fixture
def small_row_groups(spark):
    setting = "parquet.block.row.count.limit"
    spark._jsc.hadoopConfiguration().setInt(setting, 100)
    yield
    spark._jsc.hadoopConfiguration().unset(setting)


def test_zorder_key_interleaves_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int")
    cuts = {"x": [float(k) + 0.5 for k in range(7)], "y": [float(k) + 0.5 for k in range(7)]}
    for r in df.withColumn("z", layout_ops.zorder_key(df, cuts, 3)).collect():
        assert r.z == sum(((r.x >> i) & 1) << (2 * i) | ((r.y >> i) & 1) << (2 * i + 1) for i in range(3))


def test_zorder_takes_nulls_texts_dates_and_empty_tables(spark):
    rows = [(None, None, None, 1.5), ("", date(2024, 1, 1), 5, None), ("abcdefghij", date(1969, 5, 1), -3, -2.0), ("ä", date(2024, 1, 2), 9, 0.0)] * 30
    df = spark.createDataFrame(rows, "s string, d date, n long, f double")
    out = layout_ops.zordered(df, ["s", "d", "n", "f"])
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert layout_ops.zordered(df.where("false"), ["s", "n"]).count() == 0
    with pytest.raises(ValueError):
        layout_ops.zordered(df, ["s", "d", "n", "f"], bits=16)
    numbers = spark.createDataFrame([(x,) for x in ("", "a", "aa", "ab", "b", "ä")], "s string").select("s", layout_ops.order_number(df, "s").alias("n")).collect()
    assert [r.s for r in sorted(numbers, key=lambda r: r.n)] == ["", "a", "aa", "ab", "b", "ä"]


def test_compaction_skips_row_groups_by_date_store_and_product(spark, small_row_groups):
    layout = Layout(scratch_path(spark, "compaction"))
    table = refresh.RAW_TABLE
    path = layout.path(table)
    rows = spark.range(8000).select(
        (F.xxhash64("id") % 50 + 50).cast("long").alias("store_id"), (F.xxhash64("id", F.lit(1)) % 200 + 200).cast("long").alias("product_id"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 2).cast("int")).alias("dt"), F.timestamp_seconds(F.col("id")).alias("_loaded_at"),
        F.col("id").alias("line"),
    )
    for run in range(8):
        write_run(rows.where(F.floor(F.col("line") / 1000) == run), table, f"{path}/_run={run}")
    wanted = {"store_id": 40, "product_id": 150}
    everything = sorted(map(tuple, layout.read(spark, table).select("line", "store_id", "product_id", "dt", "_loaded_at").collect()))
    before = _row_groups(path, **wanted)
    assert compaction.compact(spark, layout, table) == 7 and runs(spark, path) == [6, 7]
    after = _row_groups(f"{path}/_run=6", **wanted)
    assert sorted(map(tuple, layout.read(spark, table).select("line", "store_id", "product_id", "dt", "_loaded_at").collect())) == everything
    # Runs are sorted by store inside a date: a product filter reads nearly all of them.
    assert before[1]["product_id"] > 0.9 * before[0] and after[0] >= 70
    assert all(kept <= 0.35 * after[0] for kept in after[1].values()), (before, after)
    one_day = spark.read.parquet(path).where(F.col("dt") == F.lit(date(2024, 1, 2)))
    assert all("dt=2024-01-02" in f for f in one_day.where("_run = 6").select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert compaction.compact(spark, layout, table) == 0  # one run beside the newest: nothing to do


def test_a_compaction_that_dies_is_completed_or_dropped(spark, monkeypatch):
    layout = Layout(scratch_path(spark, "compaction-dies"))
    table = refresh.RAW_TABLE
    path = layout.path(table)
    rows = spark.range(60).select(F.col("id").alias("store_id"), F.col("id").alias("product_id"), F.lit(date(2024, 1, 1)).alias("dt"), F.current_timestamp().alias("_loaded_at"))
    for run in range(3):
        write_run(rows, table, f"{path}/_run={run}")
    with monkeypatch.context() as m:
        m.setattr(compaction, "move_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):  # the old runs are gone already
            compaction.compact(spark, layout, table)
    assert runs(spark, path) == [2]
    compaction.finish(spark, layout, table)
    assert runs(spark, path) == [1, 2] and layout.read(spark, table).count() == 180
    write_run(rows, table, f"{path}/_run=3")
    with monkeypatch.context() as m:
        m.setattr(compaction, "_write_compacted", lambda df, t, p: (df.limit(5).write.parquet(p), (_ for _ in ()).throw(RuntimeError("lost")))[1].__next__())
        with pytest.raises(RuntimeError, match="lost"):  # not written whole
            compaction.compact(spark, layout, table)
    compaction.finish(spark, layout, table)
    assert runs(spark, path) == [1, 2, 3] and layout.read(spark, table).count() == 240


def test_contract_files_are_what_is_checked(spark, tmp_path):
    text = """name: daily_units
primary_key:
  - store_key
  - date_key
columns:
  - name: store_key
    type: string
    required: true
  - name: date_key
    type: date
    required: true
  - name: units
    type: decimal(12,2)
quality_checks:
  - units >= 0
notes:
  - `units` start with a mark that no YAML value may start with.
"""
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 1, 1), -1.0), (None, date(2024, 1, 2), None)], "store_key string, date_key date, units double")
    path = tmp_path / "daily_units.yml"
    pytest.importorskip("yaml")
    path.write_text(text)
    found = {r.check_name: (r.table_name, r.failures) for r in contract_report(df, K.load_contract(path)).collect()}
    assert found == {
        "column:store_key:string": ("daily_units", 0), "column:date_key:date": ("daily_units", 0), "column:units:decimal(12,2)": ("daily_units", 0),
        "required:store_key": ("daily_units", 1), "required:date_key": ("daily_units", 0), "check_1:units >= 0": ("daily_units", 2), "primary_key:store_key,date_key": ("daily_units", 1),
    }
    path.write_text(text.replace("units >= 0", "units >= -1").replace("type: date", "type: timestamp"))
    changed = {r.check_name: r.failures for r in contract_report(df, K.load_contract(path)).collect()}
    assert changed["check_1:units >= -1"] == 1 and changed["column:date_key:timestamp"] == 1
    spec = {"name": "daily_units", "primary_key": ["store_key"], "columns": [{"name": "store_key", "type": "string", "required": True}]}
    (tmp_path / "c.json").write_text(json.dumps(spec))
    assert K.load_contract(tmp_path / "c.json") == K.Contract("daily_units", ("store_key",), "`store_key` string not null", ())
