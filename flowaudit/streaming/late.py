"""Late rows kept: a ledger beside each stream, and corrections from it.

Spark leaves rows out that are behind the watermark and only counts them. ``sieve`` parts a feed
before the keyed operators see it: rows in time go on, rows behind the watermark in effect land in
a ledger. An operator that reads the rows in time with the same delay never leaves one out, since its
own watermark cannot be ahead of the one that parted them. What it gives and the corrections from
the ledger add up to the batch result, however short the delay and however files land.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators.compare import TWO_SIDES, delta_by_row, diff_counts, side_counts
from flowaudit.operators.ordered import SPLIT_ROWS
from flowaudit.schemas import OP_KINDS, counter_name
from flowaudit.streaming.sinks import drain_each_batch, make_folder

LATE = "late"
_MARK = "seen_ms bigint"


def sieve(
    path: str, ts: str, delay: timedelta, ends: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that parts rows in time from late ones, below ``path``.

    A row is late if ``ends``, the time by which it has to be there (its own, or the end of its
    window), is not after the watermark that the micro-batches before have set. Rows without a
    time are in time. One pass over the micro-batch; a retry overwrites its own folder. The marks are
    one row per micro-batch, each the maximum of all so far.
    """
    last = F.col(ts) if ends is None else ends

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = None
        if batch_id > 0:
            seen = spark.read.schema(_MARK).parquet(f"{path}/marks/batch_id={batch_id - 1}").first()[0]
        behind = F.lit(False)
        if seen is not None:
            mark = F.lit(seen - delay // timedelta(milliseconds=1))
            behind = F.coalesce(F.unix_micros(last) <= mark * 1000, F.lit(False))
        newest = Observation()
        watched = batch.observe(newest, F.max(F.unix_millis(ts)).alias("seen_ms"))
        rows = watched.withColumn(LATE, behind)
        rows.write.mode("overwrite").partitionBy(LATE).parquet(f"{path}/rows/batch_id={batch_id}")
        times = [t for t in (seen, newest.get["seen_ms"]) if t is not None]
        mark_row = spark.createDataFrame([(max(times, default=None),)], _MARK)
        mark_row.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    return handle


def part_late(
    feed: DataFrame, path: str, checkpoint: str, ts: str, delay: timedelta, ends: Column | None = None
) -> None:
    """Sieve all that has landed; call again from the same checkpoint when more has."""
    make_folder(feed.sparkSession, f"{path}/rows")
    drain_each_batch(feed, sieve(path, ts, delay, ends), checkpoint)


def _stored_schema(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    return T.StructType([*fields, T.StructField("batch_id", T.LongType()), T.StructField(LATE, T.BooleanType())])


def in_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows in time, as a stream."""
    stored = spark.readStream.schema(_stored_schema(schema)).parquet(f"{path}/rows")
    return stored.where(~F.col(LATE)).drop("batch_id", LATE)


def ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The late rows so far."""
    stored = spark.read.schema(_stored_schema(schema)).parquet(f"{path}/rows")
    return stored.where(F.col(LATE)).drop("batch_id", LATE)


def corrected_time_batches(
    counts: DataFrame, late: DataFrame, keys: Sequence[str], ts: str, every: str
) -> DataFrame:
    """Counts of ``time_batches_stream`` with the late rows added."""
    windowed = late.where(F.col(ts).isNotNull()).groupBy(*keys, F.window(ts, every))
    more = windowed.agg(F.count(F.lit(1)).alias("row_count"))
    more = more.select(*keys, F.col("window.start").alias("batch_ts"), "row_count")
    both = counts.unionByName(more)
    return both.groupBy(*keys, "batch_ts").agg(F.sum("row_count").alias("row_count"))


def corrected_reconcile(
    paired: DataFrame, late: DataFrame, keys: Sequence[str], ts: str, every: str
) -> DataFrame:
    """Counts of ``reconcile_stream`` with the late changes added, and their differences anew."""
    counters = [counter_name(s, k) for k in OP_KINDS for s in TWO_SIDES]
    windowed = late.where(F.col(ts).isNotNull()).withColumn("run", F.window(ts, every))
    more = side_counts(windowed, [*keys, "run"]).withColumn("batch_ts", F.col("run.start"))
    columns = [*keys, "batch_ts", *counters]
    both = paired.select(*columns).unionByName(more.select(*columns))
    totals = both.groupBy(*keys, "batch_ts").agg(*[F.sum(c).alias(c) for c in counters])
    return diff_counts(totals)


def corrected_deltas(
    deltas: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str = "batch_ts",
    suffix: str = "_sli",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Changes of ``delta_by_row_stream`` with late rows put in their places.

    Only keys with late rows are worked out again, as a late row also changes the row after it.
    """
    timed = late.where(F.col(ts).isNotNull())
    hit = timed.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    changes = [f"{c}{suffix}" for c in cols]
    touched = deltas.join(hit, same, "left_semi").drop(*changes).unionByName(timed)
    anew = delta_by_row(touched, keys, cols, ts, suffix, split_rows)
    return deltas.join(hit, same, "left_anti").unionByName(anew)
