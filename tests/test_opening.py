"""Batches that open with their first event, against a plain pass over each key."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from flowaudit.operators.opening import open_batches

START = datetime(2024, 1, 1)
SCHEMA = "key string, other int, ts timestamp, n bigint, batch_no string"


def sample(seed, count=240):
    rng = random.Random(seed)
    made, at = [], START
    for n in range(count):
        at += timedelta(seconds=rng.choice([0, 0, 1, 2, 5, 40, 90]))
        key = rng.choice(["hot"] * 5 + ["a", None])
        made.append((key, rng.choice([1, 1, None]), None if n % 37 == 5 else at, n, "clash"))
    return made


def expected(made, most, seconds):
    groups = defaultdict(list)
    for key, other, ts, n, _ in made:
        groups[key, other].append((ts, n))
    out = []
    for group in groups.values():
        opened, held, number = None, 0, -1
        for ts, n in group:
            if ts is None:
                out.append((n, None, None))
                continue
            late = opened is not None and seconds is not None and ts >= opened + timedelta(seconds=seconds)
            if opened is None or late or most is not None and held == most:
                opened, held, number = ts, 0, number + 1
            held += 1
            out.append((n, opened, number))
    return sorted(out)


@pytest.mark.parametrize("split", [None, 1, 7, 40, 10**6])
@pytest.mark.parametrize(("most", "seconds"), [(None, 60), (4, None), (5, 100), (1, 3), (None, 100_000), (100, 1)])
def test_batches_equal_a_plain_pass(spark, rows, split, most, seconds):
    made = sample(most or 9)
    shuffled = random.Random(1).sample(made, len(made))
    df = spark.createDataFrame(shuffled, SCHEMA).drop("batch_no").repartition(3)
    out = open_batches(df, ["key", "other"], "ts", ["ts", "n"], most, seconds, split)
    assert out.columns == [*df.columns, "batch_start", "batch_no"]
    assert sorted(map(tuple, out.select("n", "batch_start", "batch_no").collect())) == expected(made, most, seconds)


def test_nothing_and_no_limit(spark):
    df = spark.createDataFrame([], SCHEMA).drop("batch_no")
    assert open_batches(df, ["key"], "ts", ["ts", "n"], 3).count() == 0
    with pytest.raises(ValueError):
        open_batches(df, ["key"], "ts", ["ts", "n"])
