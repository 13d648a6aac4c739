"""Replay: split a landed history into time-ordered deliveries.

Each window of the history is one delivery, without one late store's first
days; the closing restatement holds the withheld rows plus corrected versions
of a few already-published keys. Built in one scan: each row gets the array of
deliveries it belongs to and is exploded over it. No row is lost: one without
a readable date goes with the first delivery (bronze's rule drops and counts
it), and one dated outside every window fails the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfguard import config as C
from shelfguard.config import Delivery, Replay
from shelfguard.functions import hourly


def day_offset(dt: str, cfg: Replay) -> Column:
    """Days since the replay's first day; NULL when the text is no date."""
    return F.datediff(F.expr(f"try_to_date({dt})"), F.lit(cfg.first_day))


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def late_mask(cfg: Replay, off: Column | None = None) -> Column:
    off = day_offset("dt", cfg) if off is None else off
    return _true((F.col("store_id") == cfg.late_store) & (off >= 0) & (off < cfg.late_days))


def correction_mask(cfg: Replay, off: Column | None = None) -> Column:
    off = day_offset("dt", cfg) if off is None else off
    keys = (F.col("store_id") == cfg.corrected_store) & F.col("product_id").isin(*cfg.corrected_products)
    return _true(keys & off.isin(*cfg.corrected_days))


def _memberships(cfg: Replay, off: Column) -> Column:
    """Array of (delivery number, corrected) for the deliveries a row lands in, and nulls for the others.

    The nulls are left to a filter behind the explode: taking them out of the array is a lambda, which Spark interprets.
    """
    late, last = late_mask(cfg, off), len(cfg.deliveries)
    entry = lambda n, corrected: F.struct(F.lit(n).alias("idx"), F.lit(corrected).alias("corrected"))
    placed = [(_true((off >= first) & (off < end)) & ~late, entry(n, False)) for n, (first, end, _) in enumerate(cfg.windows, 1)]
    placed += [(off.isNull(), entry(1, False)), (late, entry(last, False)), (correction_mask(cfg, off), entry(last, True))]
    refused = F.raise_error(F.concat(F.lit("no delivery takes the rows of "), F.col("dt").cast("string")))
    some = reduce(lambda a, b: a | b, [when for when, _ in placed])
    return F.when(some, F.array(*[F.when(when, e) for when, e in placed])).otherwise(refused)


def may_land_in(delivery: Delivery, cfg: Replay) -> Column:
    """False for rows of the history that this delivery can't hold; true for the others, those that no delivery takes among them.

    Few comparisons of the day: each is made of the source's date anew once Spark has moved them below the feed.
    """
    off = day_offset("dt", cfg)
    within = lambda first, end: _true((off >= first) & (off < end)) if first < end else F.lit(False)
    if delivery.days is None:
        return _true(F.col("store_id").isin(cfg.late_store, cfg.corrected_store)) | ~within(0, cfg.days)
    first, end = next((first, end) for first, end, d in cfg.windows if d == delivery)
    return ~within(0, first) & ~within(end, cfg.days)


def corrected_columns(corrected: Column) -> dict[str, Column]:
    """Corrected version: double sales, forced stock-out hours, promo and discount, rebuilt arrays."""
    sale = F.round(F.col("sale_amount") * F.lit(C.CORRECTION_SALES_FACTOR), 4)
    hours = F.lit(C.CORRECTION_STOCKOUT_HOURS).cast("long")
    return {
        "sale_amount": F.when(corrected, sale).otherwise(F.col("sale_amount")),
        "stock_hour6_22_cnt": F.when(corrected, hours).otherwise(F.col("stock_hour6_22_cnt")),
        "activity_flag": F.when(corrected, F.lit(1).cast("long")).otherwise(F.col("activity_flag")),
        "discount": F.when(corrected, F.lit(C.CORRECTION_DISCOUNT)).otherwise(F.col("discount")),
        "hours_sale": F.when(corrected, F.to_json(hourly.hourly_profile(sale, rare=True))).otherwise(F.col("hours_sale")),
        "hours_stock_status": F.when(corrected, F.to_json(hourly.hourly_stock_status(hours))).otherwise(
            F.col("hours_stock_status")
        ),
    }


def replay_batches(base: DataFrame, cfg: Replay, days: int, source_dataset: str, source_split: str) -> DataFrame:
    """All rows to land, stamped with batch_id, batch_seq and ingestion time.

    ``base`` is a landed-form feed (text ``dt``) of ``days`` days; its own batch stamps are replaced.
    """
    cfg.verify(days)
    landed = cfg.deliveries
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_m.idx"))
    corrected = F.col("_m.corrected")
    # The day is a column of its own: read from its text once, not by each of the conditions.
    dated = base.withColumn("_off", day_offset("dt", cfg))
    exploded = dated.select("*", F.explode(_memberships(cfg, F.col("_off"))).alias("_m")).where(F.col("_m").isNotNull())
    stamped = exploded.withColumns(corrected_columns(corrected)).withColumns(
        {
            "source_dataset": F.lit(source_dataset),
            "source_split": F.lit(source_split),
            "batch_id": pick(d.batch_id for d in landed),
            "batch_seq": pick(d.sequence for d in landed).cast("long"),
            "ingested_at": pick(d.loaded_text for d in landed),
            "is_corrected": corrected,
            "is_late": late_mask(cfg, F.col("_off")) & ~corrected,
        }
    )
    return stamped.select(*base.columns, "is_corrected", "is_late")


def delivered(base: DataFrame, delivery: Delivery, cfg: Replay, days: int, source_dataset: str, source_split: str) -> DataFrame:
    """One delivery of ``replay_batches``. The text of rows that it can't hold isn't built, nor are these dealt out."""
    rows = replay_batches(base.where(may_land_in(delivery, cfg)), cfg, days, source_dataset, source_split)
    return rows.where(F.col("batch_id") == delivery.batch_id)


def replay_corrections(base: DataFrame, cfg: Replay) -> DataFrame:
    """Only the corrected versions (the restatement's re-emitted keys)."""
    return base.where(correction_mask(cfg)).withColumns(corrected_columns(F.lit(True)))


def replay_manifest(batches: DataFrame, base: DataFrame) -> DataFrame:
    """Rows per batch and the replay totals, as (metric, value) rows."""
    per_batch = batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("value")).select(
        F.concat(F.lit("rows:"), F.col("batch_id")).alias("metric"), "value"
    )
    totals = batches.agg(
        F.count(F.lit(1)).alias("raw_rows_landed_total"),
        F.count_if(F.col("is_corrected")).alias("corrected_rows"),
        F.count_if(F.col("is_late")).alias("late_arriving_rows"),
    ).unpivot([], ["raw_rows_landed_total", "corrected_rows", "late_arriving_rows"], "metric", "value")
    grains = (
        base.select(*C.RAW_GRAIN).distinct().agg(F.count(F.lit(1)).alias("silver_fact_rows_after_full_replay"))
    ).unpivot([], ["silver_fact_rows_after_full_replay"], "metric", "value")
    return per_batch.unionByName(totals).unionByName(grains)
