"""Session settings, shared scratch space and size checks used across the package."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a side may be broadcast after it has been counted.
BROADCAST_ROWS = 2_000_000


def build_session(app_name: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, ANSI, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder; a cluster without it is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="caseloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, runs the upstream plan exactly once, and lets later
    passes prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file on local disk, HDFS or an object store."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application materialised, once no frame that reads it is needed any more."""
    store, path = open_store(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a count proves the side small; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def spread_narrow(df: DataFrame, key: str, sort: bool = False) -> DataFrame:
    """Repartition a frame that comes straight from files to the cluster's cores if it has fewer partitions.

    For compute-heavy passes over inputs with few row groups; large inputs keep their splits and are not shuffled.
    ``sort`` fixes the row order in the partitions, so that seeded algorithms see the same partitions every time.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    spread = df.repartition(cores, key)
    return spread.sortWithinPartitions(key) if sort else spread
