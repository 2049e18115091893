"""Text readings against a plain reading of the same rules, on random texts."""

from __future__ import annotations

import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from flowaudit.functions import text as tx

UNITS = {"": 0, "K": 1, "M": 2, "G": 3, "T": 4, "P": 5}
INTERVALS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def noise(rng: random.Random) -> str:
    return "".join(rng.choice("0123456789 .,:-KMGB_Sdhms\t\u00e9") for _ in range(rng.randrange(9)))


def size_text(rng: random.Random) -> str:
    if rng.random() < 0.3:
        return noise(rng)
    number = str(rng.randrange(10**rng.randrange(1, 6)))
    if rng.random() < 0.5:
        number += f".{rng.randrange(1000)}"
    unit = rng.choice(["", "B", "kb", "KB", "MiB", "M", "gb", "TB", "PB", " bytes", "XB"])
    return f"{rng.choice(['', ' '])}{number}{rng.choice(['', ' '])}{unit}"


def size(text: str) -> int | None:
    match = re.fullmatch(r"[ \t]*(\d+(?:\.\d+)?)[ \t]*([KMGTP]?)I?(?:B|BYTES?)?[ \t]*", text.upper(), re.A)
    value = int(Decimal(match[1]) * 1024 ** UNITS[match[2]]) if match else 2**63
    return value if value < 2**63 else None


def interval_text(rng: random.Random) -> str:
    if rng.random() < 0.3:
        return noise(rng)
    unit = rng.choice([*INTERVALS, "minutes", "Hours", "day", "WEEK"])
    return f"{rng.randrange(10**6)} {unit} {rng.choice(['INTERVAL', 'interval', 'INTERVALS'])}"


def interval(text: str) -> int | None:
    match = re.fullmatch(r"\s*(\d+)\s+(SECOND|MINUTE|HOUR|DAY)S?\s+INTERVAL\s*", text.upper(), re.A)
    return int(match[1]) * INTERVALS[match[2]] if match else None


def uptime_text(rng: random.Random) -> tuple[str, int | None]:
    parts, total = [], 0
    for word, seconds in (("days", 86400), ("hours", 3600), ("min", 60), ("s", 1)):
        if rng.random() < 0.5:
            count = rng.randrange(500)
            parts.append(f"{count} {word}")
            total += count * seconds
    if not parts:
        return rng.choice(["", "up", "since noon"]), None
    return rng.choice([" ", ", "]).join(parts), total


def applied(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").repartition(3)
    return [r[0] for r in df.sort("i").select(column(F.col("x"))).collect()]


def test_sizes(spark):
    rng = random.Random(1)
    texts = [size_text(rng) for _ in range(800)]
    assert applied(spark, tx.parse_bytes, texts) == [size(t) for t in texts]


def test_intervals(spark):
    rng = random.Random(2)
    texts = [interval_text(rng) for _ in range(800)]
    assert applied(spark, tx.interval_seconds, texts) == [interval(t) for t in texts]


def test_uptimes(spark):
    rng = random.Random(3)
    pairs = [uptime_text(rng) for _ in range(800)]
    assert applied(spark, tx.parse_seconds, [t for t, _ in pairs]) == [s for _, s in pairs]


def test_noise_never_raises(spark):
    rng = random.Random(4)
    texts = [noise(rng) for _ in range(500)] + ["9" * 40, "9" * 40 + " PB", "9" * 30 + " days"]
    texts += ["9" * 18 + " days", "9" * 18 + " DAY INTERVAL", "9" * 18 + " days 9:59:59"]
    for column in (tx.parse_bytes, tx.parse_seconds, tx.interval_seconds, tx.server_address, tx.source_time):
        assert len(applied(spark, column, texts)) == len(texts)
