"""Run history: durations, the run before, the run after.

Windows here range over the run history only, one row per run and cluster. Ten years of runs a
minute apart are 5.3 million rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowaudit.functions.ratios import millis_between, seconds_between


def run_duration(
    df: DataFrame, start: str = "batch_ts", end: str = "runtime_end",
    name: str = "runtime_duration_ms",
) -> DataFrame:
    """Milliseconds from the start of a run to its end."""
    return df.withColumn(name, millis_between(F.col(start), F.col(end)))


def previous_run(
    df: DataFrame,
    default: datetime | Column | None = None,
    by: Sequence[str] = ("cluster_name",),
    start: str = "batch_ts",
    name: str = "lastrun",
) -> DataFrame:
    """Start of the run before, or the default start for the first run."""
    w = Window.partitionBy(*by).orderBy(start)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return df.withColumn(name, F.coalesce(F.lag(start).over(w), fallback.cast("timestamp")))


def next_run(
    df: DataFrame, repeat_s: int | Column, start: str = "batch_ts", name: str = "nextrun"
) -> DataFrame:
    """Planned start of the next run: start plus the repeat interval."""
    seconds = repeat_s if isinstance(repeat_s, Column) else F.lit(repeat_s)
    return df.withColumn(name, F.col(start) + F.make_dt_interval(secs=seconds))


def elapsed_seconds(
    runs: DataFrame,
    by: Sequence[str] = (),
    start: str = "batch_ts",
    name: str = "timesincelastbatch",
) -> DataFrame:
    """Seconds since the run before, null for the first run."""
    w = Window.partitionBy(*by).orderBy(start)
    return runs.withColumn(name, seconds_between(F.lag(start).over(w), F.col(start)))


def link_runs(runs: DataFrame, start: str = "batch_ts", by: Sequence[str] = ()) -> DataFrame:
    """Per run: the runs before and after it and the seconds since the one before.

    ``by`` names what keeps a run history of its own, such as the cluster; without it there is one
    history, of one row per run.
    """
    w = Window.partitionBy(*by).orderBy(start)
    return (
        runs.select(*by, start)
        .distinct()
        .select(
            *by,
            start,
            F.lag(start).over(w).alias("previous_ts"),
            F.lead(start).over(w).alias("following_ts"),
        )
        .withColumn(
            "timesincelastbatch", seconds_between(F.col("previous_ts"), F.col(start))
        )
    )
