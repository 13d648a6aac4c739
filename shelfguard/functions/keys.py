"""Zero-padded business key text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfguard import config as C


def store_key(seq: Column) -> Column:
    return F.format_string(C.STORE_KEY_FORMAT, seq)


def product_key(seq: Column) -> Column:
    return F.format_string(C.PRODUCT_KEY_FORMAT, seq)


def cyclic(values: tuple, seq: Column) -> Column:
    """values[(seq - 1) mod len(values)] for a 1-based sequence."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((seq - 1) % len(values) + 1).cast("int"))
