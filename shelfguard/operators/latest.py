"""Latest version per key (latest-wins).

Written as ``row_number() = 1`` over a window so Catalyst inserts a partial
``WindowGroupLimit`` before the shuffle: every map task forwards at most one
row per key, which also bounds the data a hot key can push into one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``newest_first`` (nulls lose).

    ``newest_first`` should make the winner unique; columns that are absent
    from ``df`` are skipped so one ordering serves batch and streamed tables.
    """
    present = set(df.columns)
    order = [F.col(c).desc_nulls_last() for c in newest_first if c in present]
    if not order:
        raise ValueError("latest_per_key needs at least one ordering column")
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_version_rank", F.row_number().over(window))
        .where(F.col("_version_rank") == 1)
        .drop("_version_rank")
    )
