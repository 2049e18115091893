"""Run time, origin and row ids put on every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowaudit.operators.ordered import SPLIT_ROWS, with_row_number


def stamp_batch(df: DataFrame, batch_ts: datetime | Column, name: str = "batch_ts") -> DataFrame:
    """Give every row of a poll the time of its run."""
    value = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts)
    return df.withColumn(name, value.cast("timestamp"))


def bucket_start(ts: Column, every_s: int) -> Column:
    """Start of the interval of ``every_s`` seconds that holds ``ts``; null stays null."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(every_s * 1_000_000)))


def bucket_batches(df: DataFrame, ts: str, every_s: int, name: str = "batch_ts") -> DataFrame:
    """Give raw events the start of the run interval they fall into."""
    return df.withColumn(name, bucket_start(F.col(ts), every_s))


def stamp_origin(df: DataFrame, origin: Mapping[str, str]) -> DataFrame:
    """Add configured constants, such as the cluster and company name."""
    return df.withColumns({name: F.lit(value) for name, value in origin.items()})


def with_row_id(
    df: DataFrame, table: str, natural_key: Sequence[str], name: str = "row_id"
) -> DataFrame:
    """Add a surrogate id that is the same each time the row is computed; needs no shuffle.

    The id is a 64-bit hash: among a thousand million rows a clash has a chance of about 3 %, among
    many more clashes are certain. ``duplicate_keys`` finds them.
    """
    return df.withColumn(name, natural_key_hash(table, natural_key))


def natural_key_hash(table: str, natural_key: Sequence[str]) -> Column:
    """64-bit hash of a key. The hash function skips nulls, so each column's null mark is hashed too."""
    parts = [part for c in natural_key for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(table), *parts)


def with_row_id_in_batch(
    df: DataFrame,
    batch: Sequence[str],
    order: Sequence[str],
    name: str = "row_id",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Add consecutive ids within each run."""
    return with_row_number(df, batch, order, name, split_rows)
