"""First-N-keys sample of a feed in arrival order, bounded at a target size.

Semantics: scan rows in arrival order inside a date window; the first
``n_stores`` distinct stores and ``n_products`` distinct products seen are
selected; a row is kept when both its store and product are selected; stop
after ``target`` kept rows. A selected key's first row is never after the
current row, so this equals: rank keys by first arrival, keep the top N of
each, keep rows whose keys are both kept, take the first ``target``.

The scan stops early: it reads the rows up to a bound of the first position column, and as long as
a key set or the target isn't full and rows are left beyond it, one ``GROWTH`` times as far. The bound is a
pushed filter, so row groups and files of later positions aren't read, and what is read in all
rounds is a fixed multiple of what the last one needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfguard.operators.sequence import numbered
from shelfguard.session import staged


def first_keys(rows: DataFrame, key: str, position: Sequence[str], n: int) -> DataFrame:
    """The ``n`` keys that arrive first (ties broken by key); at most ``n`` rows."""
    return (
        rows.groupBy(key)
        .agg(F.min(F.struct(*position)).alias("_first_seen"))
        .orderBy("_first_seen", key)
        .limit(n)
        .select(key)
    )


#: Width of the first range of positions, and how much further each next one reaches.
FIRST_RANGE, GROWTH = 4096, 4


def _up_to(rows: DataFrame, leading: str, bound: int) -> DataFrame:
    # Rows without a position come first.
    return rows.where(F.col(leading).isNull() | (F.col(leading) <= F.lit(bound)))


def _settled(
    rows: DataFrame, store_col: str, product_col: str, position: Sequence[str], n_stores: int, n_products: int, target: int, origin: int, first_range: int
) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """The rows up to the first bound by which both key sets and the target are full, or all; and the key sets, if full.

    Rows beyond a bound come later than all up to it, so the sets are settled by the first bound that fills
    them: they are written once, and the rounds after that only count rows against them (no shuffle).
    A few numbers of each round reach the driver.
    """
    leading, width, keys = position[0], first_range, None
    while True:
        some = _up_to(rows, leading, origin + width)
        if keys is None:
            stores, products = some.agg(F.count_distinct(store_col), F.count_distinct(product_col)).first()
            if stores >= n_stores and products >= n_products:
                keys = tuple(staged(k, "first-keys") for k in _key_sets(some, store_col, product_col, position, n_stores, n_products))
        if keys is not None and _both_kept(some, store_col, product_col, keys).limit(target).count() >= target:
            return some, keys
        if rows.where(F.col(leading) > F.lit(origin + width)).limit(1).isEmpty():
            return rows, keys
        width *= GROWTH


def enough_rows(
    rows: DataFrame, store_col: str, product_col: str, position: Sequence[str], n_stores: int, n_products: int, target: int, origin: int, first_range: int
) -> DataFrame:
    """The rows up to the first bound by which both key sets and the target are full, or all."""
    return _settled(rows, store_col, product_col, position, n_stores, n_products, target, origin, first_range)[0]


def _key_sets(rows: DataFrame, store_col: str, product_col: str, position: Sequence[str], n_stores: int, n_products: int) -> tuple[DataFrame, DataFrame]:
    return first_keys(rows, store_col, position, n_stores), first_keys(rows, product_col, position, n_products)


def _both_kept(rows: DataFrame, store_col: str, product_col: str, keys: tuple[DataFrame, DataFrame]) -> DataFrame:
    # Both key sets hold at most n rows (config bounds), so broadcasting is safe.
    return rows.join(F.broadcast(keys[0]), store_col, "left_semi").join(F.broadcast(keys[1]), product_col, "left_semi")


def sample_first_keys(
    rows: DataFrame,
    *,
    store_col: str,
    product_col: str,
    date_col: str,
    position: Sequence[str],
    start: date,
    end: date,
    n_stores: int,
    n_products: int,
    target: int,
    origin: int = 0,
    first_range: int = FIRST_RANGE,
) -> DataFrame:
    """``position`` starts with a whole number that grows with arrival, from about ``origin`` on."""
    in_window = rows.where(F.col(date_col).between(F.lit(start), F.lit(end)))
    in_window, keys = _settled(in_window, store_col, product_col, position, n_stores, n_products, target, origin, first_range)
    if keys is None:  # fewer keys than asked for: all of them, in all rows
        keys = _key_sets(in_window, store_col, product_col, position, n_stores, n_products)
    kept = _both_kept(in_window, store_col, product_col, keys)
    # Numbered over ranges: no task gathers the ``target`` rows.
    return numbered(kept, [*position, store_col, product_col], "_nth").where(F.col("_nth") <= target).drop("_nth")
