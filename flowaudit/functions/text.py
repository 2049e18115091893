"""Readings that arrive as text, turned into numbers, times and names.

Unknown text, and a number too large for the result, become null and never raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units, as powers of 1024.
SIZE_UNITS = ("", "K", "M", "G", "T", "P")

_SIZE = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMGTP]?)I?(?:B|BYTES?)?\s*$"


def _lookup(values: dict[str, int], key: Column) -> Column:
    pairs = [F.lit(x) for name, value in values.items() for x in (name, value)]
    return F.try_element_at(F.create_map(*pairs), key).cast("bigint")


def parse_bytes(text: Column) -> Column:
    """``"1.5 GB"`` to bytes, rounded down."""
    upper = F.upper(text)
    number = F.regexp_extract(upper, _SIZE, 1).try_cast("decimal(38,6)")
    powers = {letter: 1024**power for power, letter in enumerate(SIZE_UNITS)}
    unit = _lookup(powers, F.regexp_extract(upper, _SIZE, 2))
    return F.floor(F.try_multiply(number, unit)).try_cast("bigint")


_UPTIME = (
    r"(?i)^\s*(?:(\d+)\s*d(?:ays?)?)?[\s,]*(?:(\d+)\s*h(?:ours?|rs?)?)?[\s,]*"
    r"(?:(\d+)\s*m(?:in(?:ute)?s?)?)?[\s,]*(?:(\d+)\s*s(?:ec(?:ond)?s?)?)?"
    r"(?:(\d+):(\d{2}):(\d{2}))?\s*$"
)


_UPTIME_SECONDS = (86400, 3600, 60, 1, 3600, 60, 1)


def parse_seconds(text: Column) -> Column:
    """``"3 days 04:05:06"`` or ``"2h 5m"`` to seconds.

    The text is matched once and rewritten to its numbers, absent ones as zero.
    """
    numbers = F.lit(",".join(f"0${g}" for g in range(1, len(_UPTIME_SECONDS) + 1)))
    parts = F.split(F.regexp_replace(text, F.lit(_UPTIME), numbers), ",")
    weights = F.array(*[F.lit(w).cast("bigint") for w in _UPTIME_SECONDS])
    seconds = F.zip_with(parts, weights, lambda n, w: F.try_multiply(n.try_cast("bigint"), w))
    total = F.aggregate(seconds, F.lit(0).cast("bigint"), F.try_add)
    return F.when(text.rlike(_UPTIME) & text.rlike(r"\d"), total)


# Seconds per interval unit.
INTERVAL_UNITS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}

_INTERVAL = r"^\s*([0-9]+)\s+(SECOND|MINUTE|HOUR|DAY)S?\s+INTERVAL\s*$"


def interval_seconds(text: Column) -> Column:
    """``"1 MINUTE INTERVAL"`` to seconds."""
    upper = F.upper(text)
    number = F.regexp_extract(upper, _INTERVAL, 1).try_cast("bigint")
    unit = F.regexp_extract(upper, _INTERVAL, 2)
    return F.try_multiply(number, _lookup(INTERVAL_UNITS, unit))


def server_address(text: Column) -> Column:
    """``S192_168_1_30`` to ``192.168.1.30``; other names stay as they are."""
    dotted = F.translate(F.substr(text, F.lit(2)), "_", ".")
    return F.when(text.rlike(r"^S\d+(_\d+){3}$"), dotted).otherwise(text)


def source_time(text: Column, pattern: str | None = None) -> Column:
    """Source time kept as text, read on demand."""
    if pattern is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(pattern))


def compose_type_name(app: Column, table: Column, separator: str = "_") -> Column:
    """Name under which the type of a table in an app is looked up."""
    return F.concat(F.upper(app), F.lit(separator), F.upper(table))
