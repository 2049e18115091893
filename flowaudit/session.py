"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "flowaudit", master: str | None = None, **conf: object) -> SparkSession:
    """Create or get a session.

    Join sides are never hinted: Spark broadcasts a side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (file statistics, or the finished map stage under
    adaptive execution), and splits skewed shuffle partitions otherwise.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_settings(shuffled_bytes: int, cores: int) -> dict[str, object]:
    """Settings that keep a shuffle partition near 128 MB for the expected shuffle volume.

    Adaptive execution starts with this many partitions and merges those that stay small.
    """
    wanted = max(-(-shuffled_bytes // PARTITION_BYTES), cores)
    return {
        "spark.sql.shuffle.partitions": wanted,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_BYTES,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": PARTITION_BYTES,
    }


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: table time columns are instants reported in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and cut points.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the session runs
    in one local process does a temporary folder stand in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return os.path.join(tempfile.gettempdir(), "flowaudit-checkpoints")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write rows to a new folder below the shared folder and read them from there.

    For rows that are dear to compute and read several times. The files outlive any executor; the
    folder is the caller's to remove.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
