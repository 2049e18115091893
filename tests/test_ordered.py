"""Ordered operators against brute force, with every key hot, some hot, and none hot."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from flowaudit.operators import ordered
from pyspark.sql import Window
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
SPLITS = [None, 1, 3, 40, 10**6]


def sample(seed: int, count: int = 160):
    """A hot key with half of the rows, small keys, a null key, null values, long gaps."""
    rng = random.Random(seed)
    made, at = [], START
    for n in range(count):
        at += timedelta(seconds=rng.choice([1, 5, 40, 1800, 20000]))
        key = rng.choice(["hot"] * 4 + ["a", "b", "c", None])
        made.append((key, at, n, rng.choice([None, *range(9)]), f"line {n}"))
    return made


def by_key(made):
    groups = defaultdict(list)
    for row in made:
        groups[row[0]].append(row)
    return groups


@pytest.fixture(params=[1, 2])
def data(request, spark):
    made = sample(request.param)
    shuffled = made[:]
    random.Random(7).shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "key string, ts timestamp, n bigint, v bigint, text string")
    return made, frame.repartition(3)


@pytest.mark.parametrize("split", SPLITS)
def test_previous(data, rows, split):
    made, df = data
    expected = []
    for group in by_key(made).values():
        before = (None, None)
        for _, _, n, v, _ in group:
            expected.append((n, *before))
            before = (v, n)
    out = ordered.with_previous(df, ["key"], ["ts", "n"], {"pv": "v", "pn": "n"}, split)
    assert out.columns == [*df.columns, "pv", "pn"]
    assert rows(out, "n", "pv", "pn") == sorted(expected, key=repr)


@pytest.mark.parametrize("split", SPLITS)
def test_running_sum(data, rows, split):
    made, df = data
    expected = []
    for group in by_key(made).values():
        total = None
        for _, _, n, v, _ in group:
            if v is not None:
                total = (total or 0) + v
            expected.append((n, v, total))
    out = ordered.with_running_sum(df, ["key"], ["ts", "n"], {"total": "v"}, split)
    assert rows(out, "n", "v", "total") == sorted(expected, key=repr)


@pytest.mark.parametrize("kind", ["int", "decimal(9,2)", "double"])
def test_running_sum_keeps_types(data, rows, kind):
    _, df = data
    typed = df.withColumn("v", F.col("v").cast(kind))
    plain = ordered.with_running_sum(typed, ["key"], ["ts", "n"], {"total": "v"})
    split = ordered.with_running_sum(typed, ["key"], ["ts", "n"], {"total": "v"}, 3)
    assert split.dtypes == plain.dtypes
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("split", SPLITS)
def test_row_number(data, rows, split):
    made, df = data
    expected = [
        (row[2], place)
        for group in by_key(made).values()
        for place, row in enumerate(group, start=1)
    ]
    out = ordered.with_row_number(df, ["key"], ["ts", "n"], "place", split)
    assert rows(out, "n", "place") == sorted(expected, key=repr)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("before,after", [(0, 0), (2, 0), (0, 3), (3, 2)])
def test_neighbour_text(data, rows, split, before, after):
    made, df = data
    expected = []
    for group in by_key(made).values():
        for place, row in enumerate(group):
            around = group[max(0, place - before): place + after + 1]
            expected.append((row[2], "|".join(r[4] for r in around)))
    out = ordered.with_neighbour_text(
        df, ["key"], ["ts", "n"], "text", "around", before, after, split, "|"
    )
    assert rows(out, "n", "around") == sorted(expected, key=repr)


def test_null_times_come_first(spark, rows):
    made = [("a", None, 1, 10), ("a", START, 2, 20), ("a", START + timedelta(hours=3), 3, 30)]
    df = spark.createDataFrame(made, "key string, ts timestamp, n bigint, v bigint")
    out = ordered.with_previous(df, ["key"], ["ts", "n"], {"pv": "v"}, 1)
    assert rows(out, "n", "pv") == [(1, None), (2, 10), (3, 20)]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "bigint"])
def test_other_orders_can_be_split(data, rows, kind):
    made, df = data
    place = F.unix_seconds("ts") if kind == "bigint" else F.col("ts").cast(kind)
    moved = df.withColumn("ts", place)
    plain = ordered.with_previous(moved, ["key"], ["ts", "n"], {"pv": "v"})
    split = ordered.with_previous(moved, ["key"], ["ts", "n"], {"pv": "v"}, 7)
    assert rows(plain) == rows(split)


def test_a_hot_key_is_cut_into_pieces(spark):
    """A third of the rows in one key: no piece much above the limit, cold keys stay whole."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("key"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
    )
    pieces = ordered._split(df, ["key"], ["ts"], 2_000).groupBy("key", ordered.CHUNK).count()
    assert pieces.agg(F.max("count")).first()[0] <= 2_200
    assert pieces.where("key = -1").count() == 10
    assert pieces.where("key >= 0").count() == 50


@pytest.mark.parametrize("split", [1_000, 5_000])
@pytest.mark.parametrize("shape", ["stray", "half null", "one instant", "burst"])
def test_no_piece_is_twice_the_limit(spark, split, shape):
    """Whatever the times of a hot key: one stray early time, half of them null, all equal, one burst."""
    at = F.timestamp_seconds(1_700_000_000 + F.col("id"))
    times = {
        "stray": F.when(F.col("id") == 7, F.timestamp_seconds(F.lit(0))).otherwise(at),
        "half null": F.when(F.col("id") % 2 == 0, at),
        "one instant": F.timestamp_seconds(F.lit(1_700_000_000)),
        "burst": F.when(F.col("id") % 10 == 0, at).otherwise(F.timestamp_seconds(F.lit(1_700_090_000))),
    }
    df = spark.range(200_000).select(F.lit("a").alias("key"), times[shape].alias("ts"), F.col("id").alias("n"))
    cut = ordered._split(df, ["key"], ["ts", "n"], split)
    pieces = cut.groupBy("key", ordered.CHUNK).agg(
        F.count("*").alias("rows"), F.min(F.struct("ts", "n")).alias("low"), F.max(F.struct("ts", "n")).alias("high")
    )
    found = pieces.orderBy(ordered.CHUNK).collect()
    assert sum(r["rows"] for r in found) == 200_000
    assert max(r["rows"] for r in found) <= 2 * split
    assert len(found) >= 200_000 / split * 0.7
    ahead = spark.createDataFrame(found).withColumn("next", F.lead("low").over(Window.orderBy(ordered.CHUNK)))
    assert ahead.where("next <= high").count() == 0


def test_without_a_hot_key_the_window_is_plain(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("key"), F.col("id").alias("n"))
    assert ordered._split(df, ["key"], ["n"], 50) is None
    plan = ordered.with_previous(df, ["key"], ["n"], {"pn": "n"}, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" not in plan


def test_rows_at_one_instant_stay_in_order(spark, rows):
    df = spark.range(50).select(F.lit("a").alias("key"), F.lit(START).alias("ts"), F.col("id").alias("n"))
    out = ordered.with_previous(df, ["key"], ["ts", "n"], {"pn": "n"}, 5)
    assert rows(out.where("n - 1 = pn")) and out.where("pn is null").count() == 1


@pytest.mark.parametrize("n,spread", [(1, 1), (3, 4), (5, 64)])
def test_newest_per_key(data, rows, n, spread):
    made, df = data
    expected = []
    for group in by_key(made).values():
        for place, row in enumerate(reversed(group[-n:]), start=1):
            expected.append((row[2], place))
    newest = [F.col("ts").desc(), F.col("n").desc()]
    out = ordered.newest_per_key(df, ["key"], newest, n, spread, place="place")
    assert rows(out, "n", "place") == sorted(expected, key=repr)


@pytest.mark.parametrize("shape", ["even", "ties", "burst", "nulls"])
def test_newest_beyond_the_map_limit(spark, rows, shape):
    """Levels leave out most rows of a hot key before the shuffle and none that is wanted."""
    at = {
        "even": F.col("id") * 7,
        "ties": F.floor(F.col("id") / 20_000),
        "burst": F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(F.lit(90_000)),
        "nulls": F.when(F.col("id") % 3 > 0, F.col("id")),
    }[shape]
    df = spark.range(0, 120_000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 1000 == 9, F.lit("cold")).alias("key"),
        F.timestamp_seconds(1_700_000_000 + at).alias("ts"), F.col("id").alias("n"),
    )
    n, newest = 2_000, [F.col("ts").desc(), F.col("n").desc()]
    plain = ordered.newest_per_key(df, ["key"], newest, n, place="place")
    assert rows(ordered.newest_per_key(df, ["key"], newest, n, place="place", by="ts")) == rows(plain)
    left = {r.key: r["count"] for r in ordered._reaching_newest(df, ["key"], "ts", n).groupBy("key").count().collect()}
    assert left["cold"] == 120
    if shape in ("even", "nulls"):
        assert n <= left["hot"] <= 4.5 * n and left[None] <= 4.5 * n
