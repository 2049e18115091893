"""End-to-end lag from the creation of a record to its delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.operators.joins import lookup
from flowaudit.operators.ordered import newest_per_key

PAIR = ("source_name", "target_name")


def record_lag(
    created: DataFrame,
    delivered: DataFrame,
    key: str = "record_id",
    unit: str = "MILLISECOND",
    name: str = "lag_ms",
) -> DataFrame:
    """Whole units of time from first creation to first delivery, per record, source and target.

    Replayed records collapse on the map side before the join, so a record repeated many times on
    either side sends few rows and never pairs up with itself.
    """
    first = created.groupBy(key, "source_name").agg(F.min("created_ts").alias("created_ts"))
    arrived = delivered.groupBy(key, "target_name").agg(
        F.min("delivered_ts").alias("delivered_ts")
    )
    return first.join(arrived, key).withColumn(
        name, F.timestamp_diff(unit, F.col("created_ts"), F.col("delivered_ts"))
    )


def lag_stats(
    df: DataFrame,
    pair: Sequence[str] = PAIR,
    lag: str = "lag_ms",
    sample: int | None = None,
    measured_at: str = "delivered_ts",
    record_id: str = "record_id",
) -> DataFrame:
    """Fastest, slowest and mean delivery per pair, over all records or the newest ``sample``."""
    if sample is not None:
        newest = [F.col(measured_at).desc(), F.col(record_id).desc()]
        df = newest_per_key(df, pair, newest, sample, by=measured_at)
    return df.groupBy(*pair).agg(
        F.min(lag).alias("min_lag"),
        F.max(lag).alias("max_lag"),
        F.avg(lag).alias("avg_lag"),
        F.count(lag).alias("sample_size"),
    )


def current_lag(
    df: DataFrame,
    pair: Sequence[str] = PAIR,
    lag: str = "lag_ms",
    measured_at: str = "delivered_ts",
    record_id: str = "record_id",
) -> DataFrame:
    """Lag of the record measured last, per pair; ties go to the higher record id."""
    newest = F.struct(measured_at, record_id)
    return df.groupBy(*pair).agg(
        F.max_by(lag, newest).alias("lag_end_to_end"),
        F.max(measured_at).alias("measured_at"),
    )


def unique_matches(catalog: DataFrame, name: str, owner: str) -> DataFrame:
    """Per name: its only owner, or null and the number of owners."""
    return (
        catalog.select(name, owner)
        .distinct()
        .groupBy(name)
        .agg(F.min(owner).alias("__owner"), F.count(owner).alias("candidates"))
        .withColumn("__owner", F.when(F.col("candidates") == 1, F.col("__owner")))
    )


def attribute(
    df: DataFrame,
    catalog: DataFrame,
    name: str,
    into: str = "app_name",
    candidates: str = "candidates",
    component: str = "component",
    owner: str = "app",
) -> DataFrame:
    """Find the app of a component name; null when no app or several apps have it."""
    matches = unique_matches(catalog, component, owner).select(
        F.col(component).alias("__name"),
        F.col("__owner").alias(into),
        F.col("candidates").alias(candidates),
    )
    return (
        lookup(df, matches, F.col(name), "__name")
        .withColumn(candidates, F.coalesce(candidates, F.lit(0).cast("bigint")))
    )


def latency_report(
    df: DataFrame,
    catalog: DataFrame,
    sample: int,
    pair: Sequence[str] = PAIR,
    lag: str = "lag_ms",
    measured_at: str = "delivered_ts",
    record_id: str = "record_id",
) -> DataFrame:
    """Current lag, statistics of the newest ``sample`` records and the apps on both ends.

    The newest record is part of the sample, so one pass gives both.
    """
    newest = [F.col(measured_at).desc(), F.col(record_id).desc()]
    sampled = newest_per_key(df, pair, newest, sample, place="__place", by=measured_at)
    report = sampled.groupBy(*pair).agg(
        F.max(F.when(F.col("__place") == 1, F.col(lag))).alias("lag_end_to_end"),
        F.max(measured_at).alias("measured_at"),
        F.min(lag).alias("min_lag"),
        F.max(lag).alias("max_lag"),
        F.avg(lag).alias("avg_lag"),
        F.count(lag).alias("sample_size"),
    )
    report = attribute(report, catalog, "source_name", "source_app", "source_candidates")
    return attribute(report, catalog, "target_name", "target_app", "target_candidates")
