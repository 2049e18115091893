"""Shares and differences of readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cpu_share(reading: Column, cores: Column) -> Column:
    """CPU reading on the 100-per-core scale as a share of the whole node."""
    return reading / F.nullif(cores * 100, F.lit(0))


def used_share(free: Column, total: Column) -> Column:
    """Share of the storage in use; null for an empty store."""
    return (total - free) / F.nullif(total, total * 0)


def side_difference(source: Column, target: Column) -> Column:
    """Source minus target; a missing side counts as zero, two missing sides as null."""
    zero = F.lit(0).cast("bigint")
    difference = F.try_subtract(F.coalesce(source, zero), F.coalesce(target, zero))
    return F.when(source.isNotNull() | target.isNotNull(), difference)


def millis_between(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end``, both instants."""
    return F.timestamp_diff("MILLISECOND", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, both instants."""
    return F.unix_seconds(end) - F.unix_seconds(start)
