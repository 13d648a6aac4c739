"""Session construction and the shared scratch area.

On a cluster the scratch area is the shared folder named by
``spark.checkpoint.dir``. Only a local session without one gets a folder of
its own; a cluster session without one is refused, since every executor
would write to its own disk.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import Observation, SparkSession

# Settings every job relies on: UTC wall clock (the feeds carry +00:00), AQE
# for runtime coalescing and skew splitting, and no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Rows of the feeds and tables are some twenty times as large in memory as in their files: a sort or an
# aggregation before a shuffle holds a whole split, and spills all of it when splits are larger than this.
SPLIT_BYTES = 16 * 2**20

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders made by this process, removed when it ends.
_OWN_FOLDERS: list[str] = []


def build_session(
    app: str = "shelfguard",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session handed to us ready: the feeds' clock is UTC, scan splits are small enough to be sorted in memory."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if split_bytes(spark) > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    return spark


def split_bytes(spark: SparkSession) -> int:
    """The session's largest scan split."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


@contextlib.contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are removed when each write ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables."""
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shelfguard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared scratch root, removed when the process ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if not _OWN_FOLDERS:
        atexit.register(drop_scratch)
    _OWN_FOLDERS.append(path)
    return path


def delete_folder(jvm, path: str) -> None:
    """Remove a folder through the file system that holds it; a missing one is fine."""
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)


def list_folder(jvm, path: str) -> list[str]:
    """Names in a folder, through the file system that holds it; none for a missing one."""
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(jvm.org.apache.hadoop.conf.Configuration())
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def move_folder(jvm, path: str, to: str) -> None:
    """Rename a folder inside its file system."""
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    if not source.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def observed(metrics: Observation) -> dict | None:
    """What ``df.observe`` has gathered; None where Spark found nothing above it and dropped the metrics with the plan."""
    try:
        return metrics.get
    except Py4JJavaError:
        return None


def drop_scratch() -> None:
    """Remove the folders that ``scratch_path`` gave out. DataFrames over them can't be read any more."""
    jvm = SparkContext._jvm
    while _OWN_FOLDERS:
        path = _OWN_FOLDERS.pop()
        if jvm is not None:
            with contextlib.suppress(Exception):  # the JVM may have ended first
                delete_folder(jvm, path)


def staged(df, name: str):
    """Write once to a parquet table in the shared scratch folder and read it back.

    A declared lineage cut: the table is a plain scan for everything that
    reads it, so both sides of a join on it are shuffle stages that AQE can
    split, and a lost executor costs only running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
