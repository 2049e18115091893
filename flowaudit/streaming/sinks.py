"""Running a stream over what has landed, into files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.session import fresh_path

# Time of the row that ends a bounded feed, later than any real one.
CLOSING_TIME = datetime(2200, 1, 1)

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> SparkSession:
    """Keep keyed state in RocksDB, off the heap, with changes only in each checkpoint."""
    prefix = "spark.sql.streaming.stateStore"
    spark.conf.set(f"{prefix}.providerClass", _ROCKSDB)
    spark.conf.set(f"{prefix}.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def make_folder(spark: SparkSession, path: str) -> str:
    """An empty folder, for a stream that starts before anything has landed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as they land in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drain_to_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all that has landed, append it to Parquet files and return them.

    The file sink commits each micro-batch once, so a restart from the checkpoint neither loses nor
    repeats rows.
    """
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drain_each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Process all that has landed, handing each micro-batch to a function."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def closing_row(spark: SparkSession, schema: T.StructType, ts: str) -> DataFrame:
    """One row of nulls at the closing time."""
    values = [CLOSING_TIME if f.name == ts else None for f in schema]
    return spark.createDataFrame([tuple(values)], schema)


def drain_polls(
    polls: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], ts: str, label: str
) -> DataFrame:
    """Land each poll's rows and drain them before the next, then the closing row.

    Every poll is one micro-batch or more of the same query, which goes on from its checkpoint.
    Polls must follow each other in time up to the delay that ``build`` sets.
    """
    feed, out, log = None, None, None
    for rows in polls:
        spark = rows.sparkSession
        if feed is None:
            feed = fresh_path(spark, f"{label}-feed")
            out, log = fresh_path(spark, f"{label}-out"), fresh_path(spark, f"{label}-log")
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
        rows.write.mode("append").parquet(feed)
        drain_to_files(build(read_landed(spark, feed, schema)), out, log)
    closing_row(spark, schema, ts).coalesce(1).write.mode("append").parquet(feed)
    return drain_to_files(build(read_landed(spark, feed, schema)), out, log)


def closable(stream: DataFrame, ts: str) -> tuple[DataFrame, Callable[[], None]]:
    """A feed with a place for its closing row, and what lands the row there.

    A late row moves the watermark past every real row. Without it the rows of the last watermark
    delay, and windows not yet over, stay in the state until more data lands. Land it when the feed
    is drained, as ``drain_closed`` does: rows read after it are too late. Results leave the row
    out by its time.
    """
    spark = stream.sparkSession
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema])
    path = make_folder(spark, fresh_path(spark, "closing"))

    def close() -> None:
        closing_row(spark, nullable, ts).coalesce(1).write.mode("append").parquet(path)

    return stream.unionByName(read_landed(spark, path, nullable)), close


def before_closing(df: DataFrame, ts: str) -> DataFrame:
    """The rows of a result without the closing row."""
    return df.where(F.col(ts) < F.lit(CLOSING_TIME))


def drain(df: DataFrame, label: str) -> DataFrame:
    """Drain into a new folder of the shared checkpoint folder."""
    spark = df.sparkSession
    return drain_to_files(df, fresh_path(spark, f"{label}-out"), fresh_path(spark, f"{label}-log"))


def drain_closed(df: DataFrame, close: Callable[[], None], label: str) -> DataFrame:
    """Drain a closable feed in as many triggers as it takes, then land its closing row.

    The second run goes on from the checkpoint of the first, so the closing row is read after every
    real row. The delay must cover how far rows of different triggers are out of order.
    """
    spark = df.sparkSession
    out, log = fresh_path(spark, f"{label}-out"), fresh_path(spark, f"{label}-log")
    drain_to_files(df, out, log)
    close()
    return drain_to_files(df, out, log)
