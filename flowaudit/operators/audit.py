"""Checks of keys that no store enforces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None
) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``; a null key points nowhere."""
    parents = parent.select(F.col(parent_key or child_key).alias("__parent"))
    return child.join(parents, F.col(child_key) == F.col("__parent"), "left_anti")


def with_run(df: DataFrame, runs: DataFrame, on: str = "batch_ts") -> DataFrame:
    """Attach the run a snapshot row belongs to."""
    return df.join(runs, on, "inner")


def rows_per_run(df: DataFrame, runs: DataFrame, on: str = "batch_ts") -> DataFrame:
    """Rows stored per run; counted before the join, so a busy run sends one row per map task."""
    counts = df.groupBy(on).agg(F.count(F.lit(1)).alias("row_count"))
    return with_run(counts, runs, on)
