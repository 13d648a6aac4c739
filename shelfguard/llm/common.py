"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import gc
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard.session import scratch_path

#: ``[\x20\x09-\x0D]``, the white space of the contracts.
SPACES = " \t\n\x0b\x0c\r"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is.

    ``lower`` is the fast path and equals it on pure ASCII text (as many bytes
    as characters); other texts go through ``translate``.
    """
    slow = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(slow)


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs only its running tasks, and later
    steps scan a table whose columns can be pruned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that travel to a Python worker at once: texts may be long, and a batch of them is held whole.
BATCH_ROWS = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends at most ``BATCH_ROWS`` rows to Python at once."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return df


def give_back() -> None:
    """Return what this worker has freed to the machine."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(over_batches):
    """For a function from an iterator of batches to one: workers serve task after task,
    so what one task has needed is given back before the next operator's begins."""

    @functools.wraps(over_batches)
    def run(batches):
        try:
            yield from over_batches(batches)
        finally:
            give_back()

    return run
