"""Independent DuckDB SQL for every registered query (the correctness oracle).

Runs on the driver's tables registered as views. The feed adapter and every
constant are written again here, so a wrong value in the library shows as a
mismatch. Every rounding uses the exact decimal-text form Spark
applies to doubles (HALF_UP on the shortest decimal representation).
"""

from __future__ import annotations

from datetime import date, timedelta

from shelfguard.oracle_contracts import CONTRACTS

# ---------------------------------------------------------------------------
# FIXED VALUES — the source system's, and the fixture's parameters.
# ---------------------------------------------------------------------------
HOURLY_WEIGHTS = (
    0.02, 0.02, 0.02, 0.02, 0.02, 0.02, 0.04, 0.05, 0.08, 0.08, 0.06, 0.05,
    0.04, 0.04, 0.05, 0.07, 0.08, 0.08, 0.07, 0.05, 0.04, 0.03, 0.02, 0.02,
)
STORE_KEY, PRODUCT_KEY = "NM-STORE-%03d", "NM-SKU-%05d"
FIRST_DAY = date(1995, 1, 1)
BATCHES = (
    ("replay-001-seed", 1, 0, 1461, "2024-06-01 00:00:00+00:00"),
    ("replay-002-inc", 2, 1461, 2191, "2024-06-01 01:00:00+00:00"),
    ("replay-003-inc", 3, 2191, 2922, "2024-06-01 02:00:00+00:00"),
    ("replay-004-restatement", 4, None, None, "2024-06-01 03:00:00+00:00"),
)
LATE_STORE, LATE_DAYS = 7, 365
CORRECTED_STORE = 5
CORRECTED_PRODUCTS = (37, 1, 2, 3, 8, 15, 21, 23, 25, 32, 36, 39, 66, 89)
CORRECTED_DAYS = (59, 120, 151, 181, 334, 365, 700, 731, 762, 882, 943, 1247, 1369, 1400, 1734, 1826, 1917, 1947, 2070, 2343)
EXPECTED_STORES, EXPECTED_PRODUCTS, EXPECTED_DAYS = 100, 2000, 2922
SAMPLE_FROM, SAMPLE_TO, SAMPLE_STORES, SAMPLE_PRODUCTS, SAMPLE_TARGET = date(1996, 1, 1), date(1997, 12, 31), 20, 400, 500
CLUSTERED_FROM, CLUSTERED_TO = date(1998, 1, 1), date(1999, 1, 1)
FILTERED = {"region": ("AMERICA", "ASIA"), "category": ("STANDARD", "PROMO", "ECONOMY"), "priority_tier": ("critical", "high")}
# --------------------------------------------------------------------------- end


def R(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def D(v) -> str:
    return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else f"CAST({v} AS DOUBLE)"


def S(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


TS = "TIMESTAMP '2024-06-01 00:00:00'"

# Feed columns in bronze (parsed) form; JSON arrays are not carried in SQL.
# ``version`` 1 is a line's second, restated landing.
FEED = f"""
feed AS (
  SELECT
    CASE WHEN l_orderkey % 103 <> 0 THEN l_suppkey % 5 END AS city_id,
    l_suppkey AS store_id,
    l_partkey % 8 + 1 AS management_group_id,
    l_partkey % 8 + 10 AS first_category_id,
    l_partkey % 8 + 100 AS second_category_id,
    l_partkey % 8 + 1000 AS third_category_id,
    l_partkey AS product_id,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
    CASE WHEN l_orderkey % 107 = 0 THEN {D(-1.0)} ELSE (l_quantity + version) / {D(10.0)} END AS sale_amount,
    CAST(CASE WHEN l_orderkey % 97 = 0 THEN 18 WHEN l_linenumber >= 5 THEN l_orderkey % 9 ELSE 0 END AS BIGINT)
      AS stock_hour6_22_cnt,
    CASE WHEN l_orderkey % 101 = 0 THEN {D(0.0)}
         WHEN l_orderkey % 113 = 0 THEN {D(0.00001)}
         WHEN l_discount >= {D(0.08)} THEN {R('1 - l_discount', 2)}
         ELSE {D(1.0)} END AS discount,
    CAST(CASE WHEN month(l_shipdate) = 12 THEN 1 ELSE 0 END AS BIGINT) AS holiday_flag,
    CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 1 ELSE 0 END AS BIGINT) AS activity_flag,
    (CAST(l_quantity + version AS BIGINT) % 8) / {D(16.0)} AS precpt,
    l_quantity + version + {D(0.25)} AS avg_temperature,
    l_quantity + version + {D(0.5)} AS avg_humidity,
    CAST(CAST(l_quantity + version AS BIGINT) % 9 AS DOUBLE) AS avg_wind_level,
    'lineitem' AS source_dataset,
    'train' AS source_split,
    'batch-' || CAST(CASE WHEN version = 1 THEN 5 ELSE 1 + l_linenumber % 4 END AS VARCHAR) AS batch_id,
    CAST(CASE WHEN version = 1 THEN 5 ELSE 1 + l_linenumber % 4 END AS BIGINT) AS batch_seq,
    {TS} AS ingested_at,
    l_orderkey AS line_orderkey,
    CAST(l_linenumber AS BIGINT) AS line_number,
    version
  FROM lineitem, (VALUES (0), (1)) v(version)
  WHERE version = 0 OR (l_orderkey + l_linenumber + l_partkey) % 5 = 0
)"""
BASE = "base AS (SELECT * FROM feed WHERE version = 0)"

RAW_RULES = (
    "city_id IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL AND dt IS NOT NULL",
    "sale_amount >= 0",
    "stock_hour6_22_cnt >= 0 AND stock_hour6_22_cnt <= 17",
    "discount > 0 AND discount <= 1",
)
RAW_RULE_NAMES = ("valid_raw_business_key", "valid_sales_amount", "valid_stockout_hours", "valid_discount")


def passes(rules) -> str:
    return " AND ".join(f"COALESCE(({r}), FALSE)" for r in rules)


BRONZE = f"bronze AS (SELECT * EXCLUDE (version) FROM feed WHERE {passes(RAW_RULES)})"
LATEST_ORDER = "batch_seq DESC NULLS LAST, line_orderkey DESC, line_number DESC"


def latest_of(name: str, source: str, extra_partition: str = "") -> str:
    part = f"{extra_partition}, " if extra_partition else ""
    return (
        f"{name} AS (SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {part}store_id, product_id, dt ORDER BY {LATEST_ORDER}) = 1)"
    )


LATEST = latest_of("latest", "bronze")

STORES_LANDED = f"""
stores_landed AS (
  SELECT
    CASE WHEN s_suppkey <> 3 THEN printf('{STORE_KEY}', s_suppkey) END AS northmart_store_id,
    s_suppkey AS source_store_id,
    s_name AS store_name,
    r_name AS region,
    n_name AS state,
    s_name AS city,
    CASE WHEN s_suppkey = 4 THEN 'kiosk' ELSE (['flagship', 'standard', 'outlet'])[s_suppkey % 3 + 1] END AS store_format,
    (['coastal', 'continental', 'tropical', 'arid', 'temperate'])[r_regionkey % 5 + 1] AS climate_zone,
    make_date(CAST(2015 + s_suppkey % 7 AS BIGINT), CAST(1 + s_suppkey % 12 AS BIGINT), 1) AS opened_date,
    'static-001' AS batch_id,
    {TS} AS ingested_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
STORES = STORES_LANDED + """,
store_master AS (
  SELECT * FROM stores_landed
  WHERE northmart_store_id IS NOT NULL AND store_format IN ('flagship', 'standard', 'outlet')
)"""

PRODUCTS = f"""
product_master AS (
  SELECT
    CASE WHEN p_partkey <> 10 THEN printf('{PRODUCT_KEY}', p_partkey) END AS northmart_product_id,
    p_partkey AS source_product_id,
    p_name AS product_name,
    p_type AS category,
    p_brand AS subcategory,
    p_brand AS brand,
    CASE WHEN p_partkey = 12 THEN 'unknown' ELSE (['fast', 'standard', 'slow', 'seasonal'])[p_size % 4 + 1] END AS replenishment_class,
    CASE WHEN p_partkey = 11 THEN {D(0.0)} ELSE {R('p_retailprice / 100', 2)} END AS base_unit_price,
    (['spring', 'summer', 'fall', 'winter', 'year_round'])[p_partkey % 5 + 1] AS seasonal_peak,
    'static-001' AS batch_id,
    {TS} AS ingested_at
  FROM part
)"""
PRODUCTS_VALID = (
    "products AS (SELECT * FROM product_master WHERE northmart_product_id IS NOT NULL AND base_unit_price > 0 "
    "AND replenishment_class IN ('fast', 'standard', 'slow', 'seasonal'))"
)


def keyed_of(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT l.*, s.northmart_store_id AS store_key, p.northmart_product_id AS product_key, p.base_unit_price
  FROM {source} l
  JOIN store_master s ON l.store_id = s.source_store_id
  JOIN products p ON l.product_id = p.source_product_id
)"""


KEYED = keyed_of("keyed", "latest")

UNITS = R("sale_amount * " + D(10.0), 2)
RATE = R(D(1.0) + " - discount", 4)
REVENUE = R(f"{UNITS} * base_unit_price * ({D(1.0)} - {RATE})", 2)
KEYS_NOT_NULL = "store_key IS NOT NULL AND product_key IS NOT NULL AND date_key IS NOT NULL"


def facts_of(keyed: str, suffix: str = "") -> str:
    hours = "CAST(stock_hour6_22_cnt AS INTEGER)"
    return f"""
fact_sales{suffix} AS (
  SELECT * FROM (
    SELECT store_key, product_key, dt AS date_key, {UNITS} AS observed_units,
           sale_amount AS normalized_sales_amount, {REVENUE} AS estimated_revenue, source_dataset, batch_id
    FROM {keyed})
  WHERE {KEYS_NOT_NULL} AND COALESCE(observed_units >= 0, FALSE) AND COALESCE(estimated_revenue >= 0, FALSE)
),
fact_inventory_status{suffix} AS (
  SELECT * FROM (
    SELECT store_key, product_key, dt AS date_key, {hours} AS stockout_hours, {hours} > 0 AS stockout_flag,
           17 AS service_window_hours,
           CASE WHEN {hours} = 0 THEN 'healthy' WHEN {hours} <= 2 THEN 'watch'
                WHEN {hours} <= 6 THEN 'at_risk' ELSE 'stockout' END AS inventory_coverage_status,
           batch_id
    FROM {keyed})
  WHERE {KEYS_NOT_NULL} AND COALESCE(stockout_hours >= 0 AND stockout_hours <= service_window_hours, FALSE)
),
fact_promotion{suffix} AS (
  SELECT * FROM (
    SELECT store_key, product_key, dt AS date_key,
           (activity_flag = 1) OR ({RATE} > 0) AS promotion_flag,
           {RATE} AS discount_rate,
           CASE WHEN activity_flag = 1 THEN 'Seasonal Demand Push' WHEN {RATE} > 0 THEN 'Markdown Support'
                ELSE NULL END AS campaign_name,
           batch_id
    FROM {keyed})
  WHERE {KEYS_NOT_NULL} AND COALESCE(discount_rate >= 0 AND discount_rate < 1, FALSE)
),
ext_agg{suffix} AS (
  SELECT store_key, dt AS date_key, max(holiday_flag) AS holiday_flag, max(activity_flag) AS activity_flag,
         avg(precpt) AS precipitation, avg(avg_temperature) AS avg_temperature, avg(avg_humidity) AS avg_humidity,
         avg(avg_wind_level) AS avg_wind_level, max(batch_id) AS batch_id
  FROM {keyed} GROUP BY store_key, dt
),
fact_external_signal{suffix} AS (
  SELECT * FROM (
    SELECT store_key, date_key, holiday_flag = 1 AS is_holiday, activity_flag = 1 AS local_event_flag,
           {R('precipitation', 4)} AS precipitation, {R('avg_temperature', 2)} AS avg_temperature,
           {R('avg_humidity', 2)} AS avg_humidity, {R('avg_wind_level', 2)} AS avg_wind_level,
           CASE WHEN holiday_flag = 1 AND activity_flag = 1 THEN 'compound'
                WHEN holiday_flag = 1 THEN 'holiday'
                WHEN activity_flag = 1 THEN 'event'
                WHEN precipitation > {D(0.2)} OR avg_wind_level > 6
                  THEN 'weather_sensitive'
                ELSE 'normal' END AS demand_signal_bucket,
           batch_id
    FROM ext_agg{suffix})
  WHERE store_key IS NOT NULL AND date_key IS NOT NULL
    AND demand_signal_bucket IN ('normal', 'weather_sensitive', 'holiday', 'event', 'compound')
)"""


DIMS = f"""
dim_store AS (
  SELECT northmart_store_id AS store_key, source_store_id, store_name, region, state, city, store_format,
         climate_zone, COALESCE(opened_date, DATE '1900-01-01') AS effective_start_date,
         CAST(NULL AS DATE) AS effective_end_date, TRUE AS is_current
  FROM store_master WHERE northmart_store_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY northmart_store_id ORDER BY ingested_at DESC, source_store_id DESC) = 1
),
dim_product AS (
  SELECT northmart_product_id AS product_key, source_product_id, product_name, category, subcategory, brand,
         replenishment_class, base_unit_price, seasonal_peak, TRUE AS is_active
  FROM products WHERE northmart_product_id IS NOT NULL AND base_unit_price > 0
  QUALIFY row_number() OVER (PARTITION BY northmart_product_id ORDER BY ingested_at DESC, source_product_id DESC) = 1
),
dim_date AS (
  SELECT dt AS date_key, dayname(dt) AS day_of_week, CAST(date_trunc('week', dt) AS DATE) AS week_start_date,
         CAST(month(dt) AS INTEGER) AS month, CAST(quarter(dt) AS INTEGER) AS quarter,
         CAST(year(dt) AS INTEGER) AS year, dayofweek(dt) IN (0, 6) AS is_weekend,
         max(holiday_flag) = 1 AS is_holiday,
         CASE WHEN month(dt) IN (3, 4, 5) THEN 'spring' WHEN month(dt) IN (6, 7, 8) THEN 'summer'
              WHEN month(dt) IN (9, 10, 11) THEN 'fall' ELSE 'winter' END AS planning_season
  FROM latest WHERE dt IS NOT NULL GROUP BY dt
)"""


def mart_of(suffix: str = "", name: str = "mart") -> str:
    hours = "COALESCE(i.stockout_hours, 0)"
    promo = "COALESCE(p.promotion_flag, FALSE)"
    share = f"(CAST({hours} AS DOUBLE) / {D(17.0)})"
    lost = R(f"s.estimated_revenue * {share}", 2)
    risk = R(
        f"least({D(1.0)}, {share} + CASE WHEN {promo} THEN {D(0.15)} ELSE {D(0.0)} END"
        f" + CASE WHEN dp.replenishment_class = 'seasonal' THEN {D(0.1)} ELSE {D(0.0)} END)",
        4,
    )
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT s.store_key, s.product_key, s.date_key, ds.region, ds.store_format, dp.category, dp.subcategory,
           dp.replenishment_class, s.observed_units, s.estimated_revenue,
           {hours} AS stockout_hours, {hours} > 0 AS stockout_flag, {promo} AS promotion_flag,
           COALESCE(p.discount_rate, {D(0.0)}) AS discount_rate,
           COALESCE(e.is_holiday, FALSE) AS is_holiday,
           COALESCE(e.demand_signal_bucket, 'normal') AS demand_signal_bucket,
           {lost} AS lost_sales_proxy,
           {risk} AS stockout_risk_score,
           CASE WHEN {hours} >= 6 OR {lost} >= 100 THEN 'critical'
                WHEN {hours} >= 3 OR {promo} THEN 'high'
                WHEN {hours} > 0 THEN 'medium' ELSE 'low' END AS priority_tier
    FROM fact_sales{suffix} s
    JOIN dim_store ds ON s.store_key = ds.store_key
    JOIN dim_product dp ON s.product_key = dp.product_key
    LEFT JOIN fact_inventory_status{suffix} i
      ON s.store_key = i.store_key AND s.product_key = i.product_key AND s.date_key = i.date_key
    LEFT JOIN fact_promotion{suffix} p
      ON s.store_key = p.store_key AND s.product_key = p.product_key AND s.date_key = p.date_key
    LEFT JOIN fact_external_signal{suffix} e ON s.store_key = e.store_key AND s.date_key = e.date_key)
  WHERE {KEYS_NOT_NULL}
    AND COALESCE(observed_units >= 0 AND estimated_revenue >= 0 AND lost_sales_proxy >= 0, FALSE)
    AND priority_tier IN ('low', 'medium', 'high', 'critical')
)"""


DATASET = """
dataset AS (
  SELECT store_key, product_key, date_key, region, store_format, category, subcategory, replenishment_class,
         observed_units, estimated_revenue, stockout_hours, stockout_flag,
         CAST(stockout_flag AS INTEGER) AS stockout_int, promotion_flag, discount_rate, is_holiday,
         demand_signal_bucket, lost_sales_proxy, stockout_risk_score, priority_tier,
         CASE WHEN priority_tier = 'critical' THEN 1 ELSE 0 END AS critical_int
  FROM mart
)"""

CORE = [FEED, BRONZE, LATEST, STORES, PRODUCTS, PRODUCTS_VALID, KEYED]
FULL = CORE + [facts_of("keyed"), DIMS, mart_of(), DATASET]


def with_(ctes, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


FEED_OUT = (
    "city_id, store_id, management_group_id, first_category_id, second_category_id, third_category_id, "
    "product_id, dt, sale_amount, stock_hour6_22_cnt, discount, holiday_flag, activity_flag, precpt, "
    "avg_temperature, avg_humidity, avg_wind_level, source_dataset, source_split, batch_id, batch_seq, "
    "ingested_at, line_orderkey, line_number"
)
MART_OUT = (
    "store_key, product_key, date_key, region, store_format, category, subcategory, replenishment_class, "
    "observed_units, estimated_revenue, stockout_hours, stockout_flag, promotion_flag, discount_rate, "
    "is_holiday, demand_signal_bucket, lost_sales_proxy, stockout_risk_score, priority_tier"
)

# -- hourly arrays -------------------------------------------------------------
WEIGHTS = "hours_w AS (SELECT * FROM (VALUES " + ", ".join(
    f"({h}, {D(w)})" for h, w in enumerate(HOURLY_WEIGHTS)
) + ") t(hour, w))"
TOTAL = f"CAST('{sum(HOURLY_WEIGHTS)!r}' AS DOUBLE)"
HOUR_SALE = R(f"sale_amount * w / {TOTAL}", 4)
HOUR_STOCK = (
    f"CAST(CASE WHEN hour >= 22 - stock_hour6_22_cnt AND hour <= 21 "
    "THEN 1 ELSE 0 END AS BIGINT)"
)
HOUR_KEYS = "store_id, product_id, dt, line_orderkey, line_number, batch_seq, CAST(hour AS INTEGER) AS hour"

# -- replay ----------------------------------------------------------------------
OFF = f"datediff('day', DATE '{FIRST_DAY}', dt)"
LATE = f"(store_id = {LATE_STORE} AND {OFF} < {LATE_DAYS})"
CORR = f"(store_id = {CORRECTED_STORE} AND product_id IN {CORRECTED_PRODUCTS} AND {OFF} IN {CORRECTED_DAYS})"


def _replay_select(idx: int, where: str, corrected: bool) -> str:
    bid, seq, _, _, when = BATCHES[idx - 1]
    sale = R(f"sale_amount * {D(2.0)}", 4) if corrected else "sale_amount"
    hours = "CAST(8 AS BIGINT)" if corrected else "stock_hour6_22_cnt"
    activity = "CAST(1 AS BIGINT)" if corrected else "activity_flag"
    discount = D(0.85) if corrected else "discount"
    is_late = "FALSE" if corrected else LATE
    return f"""SELECT city_id, store_id, management_group_id, first_category_id, second_category_id,
      third_category_id, product_id, dt, {sale} AS sale_amount, {hours} AS stock_hour6_22_cnt,
      {discount} AS discount, holiday_flag, {activity} AS activity_flag, precpt, avg_temperature, avg_humidity,
      avg_wind_level, source_dataset, source_split, {S(bid)} AS batch_id, CAST({seq} AS BIGINT) AS batch_seq,
      {S(when)} AS ingested_at, line_orderkey, line_number, {str(corrected).upper()} AS is_corrected,
      {is_late} AS is_late, {idx} AS idx
    FROM base WHERE {where}"""


def _replay_cte() -> str:
    parts = []
    for idx, (_, _, first, end, _) in enumerate(BATCHES, start=1):
        if first is not None:
            parts.append(_replay_select(idx, f"{OFF} >= {first} AND {OFF} < {end} AND NOT {LATE}", False))
        else:
            parts += [_replay_select(idx, LATE, False), _replay_select(idx, CORR, True)]
    return BASE + ",\nreplay AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


REPLAY = _replay_cte()
REPLAY_OUT = FEED_OUT.replace("dt, ", "strftime(dt, '%Y-%m-%d') AS dt, ")
REPLAY_BRONZE = (
    "replay_bronze AS (SELECT * REPLACE (CAST(strptime(ingested_at, '%Y-%m-%d %H:%M:%S+00:00') AS TIMESTAMP) "
    f"AS ingested_at) FROM replay WHERE {passes(RAW_RULES)})"
)
REPLAY_GOLD = [
    REPLAY, REPLAY_BRONZE, latest_of("replay_latest", "replay_bronze"), STORES, PRODUCTS, PRODUCTS_VALID,
    keyed_of("replay_keyed", "replay_latest"), facts_of("replay_keyed", "_r"), "latest AS (SELECT * FROM replay_latest)",
    DIMS, mart_of("_r", "replay_mart"),
]


def _progress_sql() -> str:
    stages = "stages AS (SELECT * FROM (VALUES " + ", ".join(f"({i})" for i in range(1, len(BATCHES) + 1)) + ") t(stage))"
    staged = "staged AS (SELECT s.stage, b.* FROM stages s JOIN replay_bronze b ON b.idx <= s.stage)"
    latest = latest_of("staged_latest", "staged", "stage")
    keyed = f"""staged_keyed AS (
  SELECT l.*, st.northmart_store_id AS store_key, p.northmart_product_id AS product_key, p.base_unit_price
  FROM staged_latest l JOIN store_master st ON l.store_id = st.source_store_id
  JOIN products p ON l.product_id = p.source_product_id)"""
    sales = f"""staged_sales AS (
  SELECT stage, store_key, product_key, dt AS date_key FROM staged_keyed
  WHERE COALESCE({UNITS} >= 0, FALSE) AND COALESCE({REVENUE} >= 0, FALSE))"""
    body = """
SELECT stage, 'bronze_landed' AS k, CAST(count(*) AS VARCHAR) AS v FROM staged GROUP BY stage
UNION ALL SELECT stage, 'silver_fact_sales', CAST(count(*) AS VARCHAR) FROM staged_sales GROUP BY stage
UNION ALL SELECT stage, 'gold_rows', CAST(count(*) AS VARCHAR) FROM staged_sales GROUP BY stage
UNION ALL SELECT stage, 'gold_max_date', CAST(max(date_key) AS VARCHAR) FROM staged_sales GROUP BY stage"""
    ctes = [FEED, REPLAY, REPLAY_BRONZE, stages, staged, latest, STORES, PRODUCTS, PRODUCTS_VALID, keyed, sales]
    return with_(ctes, body)


# -- validation ----------------------------------------------------------------
def _slice_validation_sql(store_table: str = "store_master", product_table: str = "products") -> str:
    stores, products, days = EXPECTED_STORES, EXPECTED_PRODUCTS, EXPECTED_DAYS
    rows = [
        ("raw_row_count", stores * products * days, "count(*)", "feed"),
        ("raw_missing_columns", 0, "0", "(SELECT 1)"),
        ("raw_negative_sale_amount", 0, "count_if(NOT COALESCE(sale_amount >= 0, FALSE))", "feed"),
        ("raw_stockout_hours_out_of_range", 0, "count_if(NOT COALESCE(stock_hour6_22_cnt BETWEEN 0 AND 17, FALSE))", "feed"),
        ("raw_discount_out_of_range", 0, "count_if(NOT COALESCE(discount > 0 AND discount <= 1, FALSE))", "feed"),
        ("raw_holiday_flag_not_01", 0, "count_if(NOT COALESCE(holiday_flag IN (0, 1), FALSE))", "feed"),
        ("raw_activity_flag_not_01", 0, "count_if(NOT COALESCE(activity_flag IN (0, 1), FALSE))", "feed"),
        ("raw_store_cardinality", stores, "count(DISTINCT store_id)", "feed"),
        ("raw_product_cardinality", products, "count(DISTINCT product_id)", "feed"),
        ("raw_date_cardinality", days, "count(DISTINCT dt)", "feed"),
        ("store_row_count", stores, "count(*)", store_table),
        ("store_missing_columns", 0, "0", "(SELECT 1)"),
        ("product_row_count", products, "count(*)", product_table),
        ("product_missing_columns", 0, "0", "(SELECT 1)"),
        ("product_nonpositive_price", 0, "count_if(NOT COALESCE(base_unit_price > 0, FALSE))", product_table),
    ]
    for name, src, keys in (
        ("raw_duplicate_grain", "feed", "store_id, product_id, dt"),
        ("store_duplicate_key", store_table, "northmart_store_id"),
        ("product_duplicate_key", product_table, "northmart_product_id"),
    ):
        rows.append((name, 0, "COALESCE(sum(n - 1), 0)", f"(SELECT count(*) AS n FROM {src} GROUP BY {keys})"))
    selects = [
        f"SELECT '{name}' AS check_name, CAST({exp} AS BIGINT) AS expected, CAST({act} AS BIGINT) AS actual FROM {src}"
        for name, exp, act, src in rows
    ]
    body = "SELECT check_name, expected, actual, expected = actual AS passed, '' AS detail FROM (\n" + "\nUNION ALL\n".join(selects) + ")"
    return with_([FEED, STORES, PRODUCTS, PRODUCTS_VALID], body)


# SQL types that a contract type may have here.
_TYPES = {
    "bigint": ("BIGINT",), "int": ("INTEGER", "BIGINT"), "double": ("DOUBLE",), "string": ("VARCHAR",), "date": ("DATE",),
    "timestamp": ("TIMESTAMP",), "boolean": ("BOOLEAN",),
}


def _contract_sql() -> str:
    sources = {
        "bronze_daily_observations": "bronze",
        "bronze_store_master": "store_master",
        "bronze_product_master": "products",
        "gold_stockout_daily": "mart",
    }
    # Arrays and audit times are not carried in SQL: current times, never NULL.
    skip = {"hours_sale", "hours_stock_status", "processed_at", "refreshed_at"}
    selects = []
    add = lambda table, check, failures, src: selects.append(
        f"SELECT '{table}' AS table_name, {S(check)} AS check_name, {failures} AS failures FROM {src}"
    )
    for table, key, columns, checks in CONTRACTS:
        src = sources.get(table, table)
        for line in columns.strip().splitlines():
            name, kind, *required = line.split()
            types = ("DOUBLE",) if kind.startswith("decimal") else _TYPES.get(kind, ())
            known = "0" if name in skip else f"CASE WHEN typeof(any_value({name})) IN ({', '.join(map(S, types))}, '\"NULL\"') THEN 0 ELSE 1 END"
            add(table, f"column:{name}:{kind}", known, "(SELECT 1)" if name in skip else src)
            if required:
                add(table, f"required:{name}", "0" if name in skip else f"count_if({name} IS NULL)", "(SELECT 1)" if name in skip else src)
        for i, check in enumerate(checks, start=1):
            add(table, f"check_{i}:{check}", f"count_if(NOT COALESCE(({check}), FALSE))", src)
        add(table, "primary_key:" + ",".join(key), "COALESCE(sum(n - 1), 0)", f"(SELECT count(*) AS n FROM {src} GROUP BY {', '.join(key)})")
    body = (
        "SELECT table_name, check_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (\n"
        + "\nUNION ALL\n".join(selects) + ")"
    )
    return with_(FULL, body)


def _masters_sql(column: str, fmt: str, key: str, source: str) -> str:
    return with_(
        [FEED, f"ids AS (SELECT DISTINCT {column} FROM feed WHERE {column} IS NOT NULL)",
         f"num AS (SELECT {column}, CAST(row_number() OVER (ORDER BY {column}) AS INTEGER) AS seq FROM ids)"],
        f"SELECT printf('{fmt}', seq) AS {key}, {column} AS {source}, 'static-001' AS batch_id, "
        "'2024-06-01 00:00:00+00:00' AS ingested_at FROM num",
    )


def _sample_sql() -> str:
    pos = "line_orderkey * 8 + line_number"
    cols = (
        "city_id, store_id, management_group_id, first_category_id, second_category_id, third_category_id, "
        "product_id, dt, sale_amount, stock_hour6_22_cnt, discount, holiday_flag, activity_flag, precpt, "
        "avg_temperature, avg_humidity, avg_wind_level, line_orderkey, line_number"
    )
    return with_(
        [
            FEED, BASE,
            f"win AS (SELECT * FROM base WHERE dt BETWEEN DATE '{SAMPLE_FROM}' AND DATE '{SAMPLE_TO}')",
            f"fs AS (SELECT store_id FROM win GROUP BY store_id ORDER BY min({pos}), store_id LIMIT {SAMPLE_STORES})",
            f"fp AS (SELECT product_id FROM win GROUP BY product_id ORDER BY min({pos}), product_id LIMIT {SAMPLE_PRODUCTS})",
        ],
        f"""SELECT {cols} FROM win
WHERE store_id IN (SELECT store_id FROM fs) AND product_id IN (SELECT product_id FROM fp)
ORDER BY line_orderkey, line_number, store_id, product_id LIMIT {SAMPLE_TARGET}""",
    )


# -- rule counts -----------------------------------------------------------------
def _rule_sql() -> str:
    """Rows seen, kept and failing each rule; the tables before their rules are written out again."""
    dims = DIMS.replace(" WHERE northmart_store_id IS NOT NULL\n", "\n").replace(" WHERE northmart_product_id IS NOT NULL AND base_unit_price > 0\n", "\n")
    facts = facts_of("keyed")
    hours = "CAST(stock_hour6_22_cnt AS INTEGER)"
    before = [
        f"sales_rows AS (SELECT store_key, product_key, dt AS date_key, {UNITS} AS observed_units, {REVENUE} AS estimated_revenue FROM keyed)",
        f"inventory_rows AS (SELECT store_key, product_key, dt AS date_key, {hours} AS stockout_hours, 17 AS service_window_hours FROM keyed)",
        f"promotion_rows AS (SELECT store_key, product_key, dt AS date_key, {RATE} AS discount_rate FROM keyed)",
    ]
    keys = KEYS_NOT_NULL
    buckets = "demand_signal_bucket IN ('normal', 'weather_sensitive', 'holiday', 'event', 'compound')"
    rules = {
        "bronze_raw_daily": ("feed", list(zip(RAW_RULE_NAMES, RAW_RULES, strict=True))),
        "bronze_store_master": ("stores_landed", [
            ("valid_store_key", "northmart_store_id IS NOT NULL"), ("valid_store_format", "store_format IN ('flagship', 'standard', 'outlet')")]),
        "bronze_product_master": ("product_master", [
            ("valid_product_key", "northmart_product_id IS NOT NULL"), ("valid_unit_price", "base_unit_price > 0"),
            ("valid_replenishment_class", "replenishment_class IN ('fast', 'standard', 'slow', 'seasonal')")]),
        "dim_store": ("dim_store", [("valid_store_key", "store_key IS NOT NULL")]),
        "dim_product": ("dim_product", [("valid_product_key", "product_key IS NOT NULL"), ("valid_base_unit_price", "base_unit_price > 0")]),
        "dim_date": ("dim_date", [("valid_date_key", "date_key IS NOT NULL")]),
        "fact_sales": ("sales_rows", [
            ("valid_sales_keys", keys), ("valid_observed_units", "observed_units >= 0"), ("valid_estimated_revenue", "estimated_revenue >= 0")]),
        "fact_inventory_status": ("inventory_rows", [
            ("valid_inventory_keys", keys), ("valid_stockout_hours", "stockout_hours >= 0 AND stockout_hours <= service_window_hours")]),
        "fact_promotion": ("promotion_rows", [("valid_promotion_keys", keys), ("valid_discount_rate", "discount_rate >= 0 AND discount_rate < 1")]),
        "fact_external_signal": ("fact_external_signal", [
            ("valid_external_keys", "store_key IS NOT NULL AND date_key IS NOT NULL"), ("valid_demand_signal_bucket", buckets)]),
        "gold_stockout_daily": ("mart", [
            ("valid_gold_keys", keys), ("valid_gold_measures", "observed_units >= 0 AND estimated_revenue >= 0 AND lost_sales_proxy >= 0"),
            ("valid_priority_tier", "priority_tier IN ('low', 'medium', 'high', 'critical')")]),
    }
    selects = []
    for table, (src, own) in rules.items():
        counts = [("_rows_seen", "count(*)"), ("_rows_kept", f"count_if({passes([r for _, r in own])})")]
        counts += [(n, f"count_if(NOT COALESCE(({r}), FALSE))") for n, r in own]
        selects += [f"SELECT '{table}' AS table_name, '{n}' AS rule_name, {x} AS failed_rows FROM {src}" for n, x in counts]
    return with_([*CORE, facts, dims, mart_of(), *before], "\nUNION ALL ".join(selects))


def oracle_sql() -> dict[str, str]:
    lo, hi = CLUSTERED_FROM, CLUSTERED_TO
    late_before = FIRST_DAY + timedelta(days=LATE_DAYS)
    corr_dates = ", ".join(f"DATE '{FIRST_DAY + timedelta(days=d)}'" for d in CORRECTED_DAYS)
    q = {}
    q["bronze_daily"] = with_([FEED, BRONZE], f"SELECT {FEED_OUT} FROM bronze")
    q["incremental_ingest"] = q["bronze_daily"]
    q["bronze_store_master"] = with_([STORES], "SELECT * FROM store_master")
    q["bronze_product_master"] = with_([PRODUCTS, PRODUCTS_VALID], "SELECT * FROM products")
    q["bronze_hourly_arrays"] = with_(
        [FEED, BRONZE, WEIGHTS],
        f"SELECT {HOUR_KEYS}, {HOUR_SALE} AS hours_sale, {HOUR_STOCK} AS hours_stock_status FROM bronze, hours_w",
    )
    q["hourly_profile"] = with_([FEED, WEIGHTS], f"SELECT {HOUR_KEYS}, {HOUR_SALE} AS hours_sale FROM feed, hours_w")
    q["hourly_stock_status"] = with_(
        [FEED, WEIGHTS], f"SELECT {HOUR_KEYS}, {HOUR_STOCK} AS hours_stock_status FROM feed, hours_w"
    )
    q["dq_rule_counts"] = _rule_sql()
    q["latest_version"] = with_([FEED, BRONZE, LATEST], f"SELECT {FEED_OUT} FROM latest")
    q["keyed_observations"] = with_(CORE, f"SELECT {FEED_OUT}, store_key, product_key, base_unit_price FROM keyed")
    q["dim_store"] = with_(FULL, "SELECT * FROM dim_store")
    q["dim_product"] = with_(FULL, "SELECT * FROM dim_product")
    q["dim_date"] = with_(FULL, "SELECT * FROM dim_date")
    for t in ("fact_sales", "fact_inventory_status", "fact_promotion", "fact_external_signal"):
        q[t] = with_(FULL, f"SELECT * FROM {t}")
    q["stockout_mart"] = with_(FULL, f"SELECT {MART_OUT} FROM mart")
    q["mart_projection"] = with_(FULL, "SELECT * FROM dataset")
    q["mart_filtered"] = with_(
        FULL,
        "SELECT * FROM dataset WHERE " + " AND ".join(f"{c} IN ({', '.join(map(S, v))})" for c, v in FILTERED.items()),
    )
    money = R("sum(lost_sales_proxy)", 2)
    q["kpi_lost_sales"] = with_(FULL, f"SELECT {money} AS sum_lost_sales_proxy FROM dataset")
    q["kpi_stockout_rate"] = with_(FULL, "SELECT avg(stockout_int) AS avg_stockout_int FROM dataset")
    q["kpi_critical_rows"] = with_(FULL, "SELECT CAST(sum(critical_int) AS BIGINT) AS sum_critical_int FROM dataset")
    q["lost_sales_by_region"] = with_(FULL, f"SELECT region, {money} AS sum_lost_sales_proxy FROM dataset GROUP BY region")
    q["lost_sales_by_category"] = with_(
        FULL, f"SELECT category, {money} AS sum_lost_sales_proxy FROM dataset GROUP BY category"
    )
    q["lost_sales_trend"] = with_(
        FULL,
        f"SELECT CAST(date_trunc('day', date_key) AS DATE) AS daily_date_key, {money} AS sum_lost_sales_proxy "
        "FROM dataset GROUP BY 1",
    )
    q["priority_mix"] = with_(FULL, "SELECT priority_tier, count(store_key) AS count_rows FROM dataset GROUP BY priority_tier")
    q["filter_options"] = with_(
        FULL,
        "SELECT DISTINCT 'region' AS filter_name, region AS filter_value FROM dataset "
        "UNION ALL SELECT DISTINCT 'category', category FROM dataset "
        "UNION ALL SELECT DISTINCT 'priority', priority_tier FROM dataset",
    )
    q["daily_partials"] = with_(
        FULL,
        "SELECT date_key, region, category, priority_tier, count(store_key) AS rows, CAST(sum(stockout_int) AS BIGINT) AS stockout_rows, "
        f"CAST(sum(critical_int) AS BIGINT) AS critical_rows, {money} AS lost_sales_proxy, "
        f"{R('sum(estimated_revenue)', 2)} AS estimated_revenue, {R('sum(observed_units)', 2)} AS observed_units "
        "FROM dataset GROUP BY date_key, region, category, priority_tier",
    )
    chosen = " AND ".join(f"{c} IN ({', '.join(S(v) for v in values)})" for c, values in FILTERED.items())
    widgets = [("kpi_lost_sales", None, money), ("kpi_stockout_rate", None, "avg(stockout_int)"), ("kpi_critical_rows", None, "sum(critical_int)")]
    widgets += [(f"lost_sales_by_{c}", c, money) for c in ("region", "category")]
    widgets += [("lost_sales_trend", "date_key", money), ("priority_mix", "priority_tier", "count(store_key)")]
    q["dashboard_filtered"] = with_(
        FULL,
        " UNION ALL ".join(
            f"SELECT {S(name)} AS widget, CAST({item or 'NULL'} AS VARCHAR) AS item, CAST({value} AS DOUBLE) AS value "
            f"FROM dataset WHERE {chosen}{f' GROUP BY {item}' if item else ''}"
            for name, item, value in widgets
        ),
    )
    q["top_offenders"] = with_(
        FULL,
        "SELECT store_key, product_key, date_key, region, category, stockout_hours, estimated_revenue, "
        "lost_sales_proxy, priority_tier FROM mart WHERE priority_tier IN ('critical', 'high') "
        "ORDER BY lost_sales_proxy DESC, store_key, product_key, date_key LIMIT 50",
    )
    q["clustered_scan"] = with_(
        FULL, f"SELECT {MART_OUT} FROM mart WHERE date_key >= DATE '{lo}' AND date_key < DATE '{hi}'"
    )
    q["zordered_scan"] = with_(FULL, f"SELECT {MART_OUT} FROM mart WHERE region IN ('ASIA', 'EUROPE') AND category = 'PROMO'")
    q["compacted_bronze"] = q["bronze_daily"]
    q["grain_integrity"] = with_(
        FULL,
        "SELECT 'bronze_raw_daily' AS table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_grains, "
        "CAST(sum(n - 1) AS BIGINT) AS duplicate_rows "
        "FROM (SELECT count(*) AS n FROM bronze GROUP BY store_id, product_id, dt) "
        "UNION ALL SELECT 'fact_sales', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n - 1) AS BIGINT) "
        "FROM (SELECT count(*) AS n FROM fact_sales GROUP BY store_key, product_key, date_key)",
    )
    q["slice_validation"] = _slice_validation_sql()
    q["landed_validation"] = _slice_validation_sql("stores_landed", "product_master")
    q["quarantine_counts"] = f"SELECT * FROM ({q['dq_rule_counts']}) WHERE starts_with(table_name, 'bronze')"
    q["contract_report"] = _contract_sql()
    q["assign_store_keys"] = _masters_sql("store_id", STORE_KEY, "northmart_store_id", "source_store_id")
    q["assign_product_keys"] = _masters_sql("product_id", PRODUCT_KEY, "northmart_product_id", "source_product_id")
    q["sample_first_keys"] = _sample_sql()
    # Replay: landed rows are in landed (text) form.
    q["replay_batches"] = with_(
        [FEED, REPLAY],
        f"SELECT {REPLAY_OUT}, is_corrected, is_late FROM replay",
    )
    q["replay_corrections"] = with_(
        [FEED, REPLAY], f"SELECT {REPLAY_OUT.replace(', batch_id, batch_seq, ingested_at', '')} FROM replay WHERE is_corrected"
    )
    q["replay_manifest"] = with_(
        [FEED, REPLAY],
        "SELECT 'rows:' || batch_id AS metric, count(*) AS value FROM replay GROUP BY batch_id "
        "UNION ALL SELECT 'raw_rows_landed_total', count(*) FROM replay "
        "UNION ALL SELECT 'corrected_rows', count_if(is_corrected) FROM replay "
        "UNION ALL SELECT 'late_arriving_rows', count_if(is_late) FROM replay "
        "UNION ALL SELECT 'silver_fact_rows_after_full_replay', count(*) FROM "
        "(SELECT DISTINCT store_id, product_id, dt FROM base)",
    )
    q["batch_provenance"] = with_(
        [FEED, REPLAY, REPLAY_BRONZE],
        "SELECT batch_id, count(*) AS rows FROM replay_bronze GROUP BY batch_id",
    )
    q["late_arrivals_check"] = with_(
        [FEED] + REPLAY_GOLD,
        f"SELECT count(*) AS late_store_early_rows FROM replay_mart "
        f"WHERE store_key = {S(STORE_KEY % LATE_STORE)} AND date_key < DATE '{late_before}'",
    )
    q["restatement_check"] = with_(
        [FEED] + REPLAY_GOLD,
        f"SELECT store_key, product_key, date_key, stockout_hours, {R('estimated_revenue', 2)} AS rev, "
        f"{R('lost_sales_proxy', 2)} AS lost, priority_tier FROM replay_mart "
        f"WHERE store_key = {S(STORE_KEY % CORRECTED_STORE)} "
        f"AND product_key = {S(PRODUCT_KEY % CORRECTED_PRODUCTS[0])} "
        f"AND date_key IN ({corr_dates}) ORDER BY date_key",
    )
    q["progress_counts"] = _progress_sql()
    return q
