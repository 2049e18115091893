"""Windowed counting, replays and side-by-side counts on streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.operators.compare import TWO_SIDES, diff_counts, side_counts
from flowaudit.schemas import OP_KINDS, counter_name
from flowaudit.streaming.sinks import drain_each_batch, read_landed, use_keyed_state


def time_batches_stream(
    df: DataFrame, keys: Sequence[str], ts: str, every: str, delay: str
) -> DataFrame:
    """Row counts per key and interval; an interval comes out when the watermark has passed it."""
    use_keyed_state(df.sparkSession)
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    counts = timed.groupBy(*keys, F.window(ts, every)).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(*keys, F.col("window.start").alias("batch_ts"), "row_count")


def drop_replays(df: DataFrame, record_id: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival of each record; a replay within the delay is left out."""
    use_keyed_state(df.sparkSession)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(record_id))


def store_first_arrivals(
    path: str, record_id: Sequence[str], ts: str
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that stores the first arrival of each record of the micro-batch.

    Put before ``drop_replays`` where a record may be replayed very often: the copies are combined
    on the map side, so at most one per micro-batch reaches the keyed state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        others = [c for c in batch.columns if c not in record_id]
        first = batch.groupBy(*record_id).agg(
            F.min_by(F.struct(*others), F.struct(ts, *[c for c in others if c != ts])).alias("__row")
        )
        rows = first.select(
            *[c if c in record_id else F.col("__row")[c].alias(c) for c in batch.columns]
        )
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def first_arrivals(
    df: DataFrame, record_id: Sequence[str], ts: str, delay: str, path: str, checkpoint: str
) -> DataFrame:
    """``drop_replays`` in two steps, for a feed in which one record may hold a large part."""
    drain_each_batch(df, store_first_arrivals(path, record_id, ts), checkpoint)
    stored = read_landed(df.sparkSession, f"{path}/batch_id=*", df.schema)
    return drop_replays(stored, record_id, ts, delay)


def reconcile_stream(
    changes: DataFrame, keys: Sequence[str], ts: str, every: str, delay: str
) -> DataFrame:
    """Both sides' counts and their difference per key and run interval.

    One feed carries both sides with a ``side`` column, so one aggregation replaces the outer join
    of two streams, and it does not matter in which micro-batch a side arrives.
    """
    use_keyed_state(changes.sparkSession)
    timed = changes.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    windowed = timed.withColumn("run", F.window(ts, every))
    counted = side_counts(windowed, [*keys, "run"])
    paired = counted.withColumn("batch_ts", F.col("run.start")).drop("run")
    return diff_counts(paired)


def store_partial_counts(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that stores counts under its batch id; a retry overwrites its own."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        side_counts(batch, keys).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def reconcile_each_batch(
    changes: DataFrame, keys: Sequence[str], path: str, checkpoint: str
) -> DataFrame:
    """Count each micro-batch, then add up; right also when the sides arrive in different ones."""
    drain_each_batch(changes, store_partial_counts(path, keys), checkpoint)
    return partial_totals(changes.sparkSession, path, keys)


def partial_totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Totals and differences of the stored counts."""
    counters = [counter_name(s, k) for k in OP_KINDS for s in TWO_SIDES]
    stored = spark.read.parquet(path)
    totals = stored.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])
    return diff_counts(totals)
