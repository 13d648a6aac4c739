"""Landed CSV feeds: incremental stream reader, batch reader and CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.utils import AnalysisException

RAW_DAILY = "daily_observations"
STORE_MASTER = "store_master"
PRODUCT_MASTER = "product_master"


def dataset_path(landing_root: str, dataset: str) -> str:
    """Per-dataset landing folder under one base path."""
    return f"{landing_root.rstrip('/')}/{dataset}"


def _with_provenance(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn(
        "_loaded_at", F.current_timestamp()
    )


def read_csv_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Incremental CSV source: each run reads only files it has not seen.

    The file source records consumed files in the query checkpoint; together
    with ``trigger(availableNow=True)`` a run drains what has landed and stops.
    Landing folders may hold one sub-folder per delivery.
    """
    reader = (
        spark.readStream.format("csv")
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .schema(schema)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _with_provenance(reader.load(path))


def read_csv_batch(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch read of a required CSV path; a missing path raises AnalysisException."""
    return _with_provenance(
        spark.read.option("header", "true").option("recursiveFileLookup", "true").schema(schema).csv(path)
    )


def require_path(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return read_csv_batch(spark, path, schema)
    except AnalysisException as exc:
        raise FileNotFoundError(f"missing landed file: {path}") from exc


def write_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists") -> None:
    """Export a feed as gzipped CSV with header; array columns travel as JSON text.

    A compressed file is read by one task: keep as many files as tasks shall read them.
    """
    out = df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    (out.repartition(files) if files else out).write.mode(mode).option("header", "true").option("compression", "gzip").csv(path)
