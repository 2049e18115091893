"""Counting, pairing and differencing on hand-made counters."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowaudit.functions.ratios import side_difference
from flowaudit.operators import compare
from flowaudit.schemas import OP_KINDS, counter_columns, counter_name


def at(minute: int) -> datetime:
    return datetime(2024, 1, 1, 10, minute)


@pytest.fixture
def counters(spark):
    """Runs at 10:00 to 10:03; the key has no row at 10:02 and its counters start anew at 10:03."""
    made = [("a", "s", "t", at(0), 10, 8), ("a", "s", "t", at(1), 15, 15), ("a", "s", "t", at(3), 4, 1)]
    return spark.createDataFrame(
        made,
        "app_name string, source_name string, target_name string, batch_ts timestamp,"
        " src_num_of_inserts bigint, tgt_num_of_inserts bigint",
    )


@pytest.fixture
def run_history(spark):
    return spark.createDataFrame([(at(m),) for m in range(4)], "batch_ts timestamp")


KEYS = ["app_name", "source_name", "target_name"]
COLS = ["src_num_of_inserts", "tgt_num_of_inserts"]


@pytest.mark.parametrize("unit", [None, "minute", "hour"])
def test_delta_by_run_is_null_over_a_gap(counters, run_history, rows, unit):
    out = compare.delta_by_run(counters, run_history, KEYS, COLS, chunk_unit=unit)
    assert rows(out, "batch_ts", "timesincelastbatch", *[f"{c}_sli" for c in COLS]) == [
        (at(0), None, None, None),
        (at(1), 60, 5, 7),
        (at(3), 60, None, None),
    ]


def test_delta_by_row_spans_a_gap_and_keeps_a_reset(counters, rows):
    out = compare.delta_by_row(counters, KEYS, COLS)
    assert rows(out, "batch_ts", *[f"{c}_sli" for c in COLS]) == [
        (at(0), None, None), (at(1), 5, 7), (at(3), -11, -14),
    ]


def test_delta_by_row_split_equals_plain(counters, rows):
    plain = compare.delta_by_row(counters, KEYS, COLS)
    split = compare.delta_by_row(counters, KEYS, COLS, split_rows=1)
    assert rows(plain) == rows(split, *plain.columns)


def test_diff_delta_is_source_delta_minus_target_delta(spark, rows):
    made = [(at(m), *[m * 10 + n for n in range(10)]) for m in range(3)]
    cols = counter_columns(("src", "tgt"))
    df = spark.createDataFrame(made, ["batch_ts", *cols]).withColumn("app_name", F.lit("a"))
    runs = df.select("batch_ts")
    out = compare.delta_of_diff(compare.delta_by_run(df, runs, ["app_name"], cols))
    diff = compare.diff_counts(df)
    direct = compare.delta_by_run(
        diff, runs, ["app_name"], [counter_name("diff", k) for k in OP_KINDS]
    )
    names = [counter_name("diff", k, "_sli") for k in OP_KINDS]
    assert rows(out, "batch_ts", *names) == rows(direct, "batch_ts", *names)


def side(spark, prefix, name, made):
    kinds = ", ".join(f"{prefix}_num_of_{k} bigint" for k in OP_KINDS)
    return spark.createDataFrame(
        [(a, n, at(m), *[count] * 5) for a, n, m, count in made],
        f"app_name string, {name} string, batch_ts timestamp, {kinds}",
    )


def test_missing_sides(spark, rows):
    source = side(spark, "src", "source_name", [("a", "x", 0, 7)])
    target = side(spark, "tgt", "target_name", [("a", "y", 0, 3)])
    out = compare.diff_counts(compare.pair_sides(source, target))
    assert rows(
        out, "source_name", "target_name", "src_num_of_ddls", "tgt_num_of_ddls", "diff_num_of_ddls"
    ) == [("x", "x", 7, None, 7), ("y", "y", None, 3, -3)]


def test_pairs_by_mapping(spark, rows):
    source = side(spark, "src", "source_name", [("a", "x", 0, 7), ("a", "z", 0, 1)])
    target = side(spark, "tgt", "target_name", [("a", "X2", 0, 5), ("a", "z", 0, 1)])
    mapping = spark.createDataFrame(
        [("a", "x", "X2"), ("a", "gone", "gone2"), ("b", "z", "other")],
        "app_name string, source_name string, target_name string",
    )
    out = compare.diff_counts(compare.pair_sides(source, target, mapping))
    assert rows(out, "source_name", "target_name", "diff_num_of_inserts") == [
        ("x", "X2", 2), ("z", "z", 0),
    ]


def test_one_source_with_two_targets(spark, rows):
    source = side(spark, "src", "source_name", [("a", "x", 0, 7)])
    target = side(spark, "tgt", "target_name", [("a", "X1", 0, 7), ("a", "X2", 0, 5)])
    mapping = spark.createDataFrame(
        [("a", "x", "X1"), ("a", "x", "X2")],
        "app_name string, source_name string, target_name string",
    )
    out = compare.diff_counts(compare.pair_sides(source, target, mapping))
    assert rows(out, "target_name", "diff_num_of_inserts") == [("X1", 0), ("X2", 2)]


def test_source_against_itself_differs_nowhere(spark):
    source = side(spark, "src", "source_name", [("a", "x", 0, 7), ("a", "y", 1, 2)])
    renames = {f"src_num_of_{k}": f"tgt_num_of_{k}" for k in OP_KINDS}
    target = source.withColumnsRenamed({**renames, "source_name": "target_name"})
    out = compare.diff_counts(compare.pair_sides(source, target))
    assert out.where(" or ".join(f"diff_num_of_{k} <> 0" for k in OP_KINDS)).count() == 0
    assert out.count() == 2


def test_side_counts_equal_counting_each_side(spark, rows):
    made = [
        ("a", "src", "INSERT"), ("a", "src", "INSERT"), ("a", "tgt", "INSERT"),
        ("b", "tgt", "DDL"), ("c", "src", "DELETE"), ("c", "src", "strange"),
    ]
    changes = spark.createDataFrame(made, "t string, side string, op string")
    out = compare.side_counts(changes, ["t"])
    assert rows(
        out, "t", "src_num_of_inserts", "tgt_num_of_inserts", "src_num_of_deletes", "tgt_num_of_ddls"
    ) == [("a", 2, 1, 0, 0), ("b", None, 0, None, 1), ("c", 0, None, 1, None)]


def test_deltas_add_up_to_last_minus_first(spark, rows):
    made = [("k", at(m), m * m) for m in range(9)]
    df = spark.createDataFrame(made, "k string, batch_ts timestamp, c bigint")
    out = compare.delta_by_row(df, ["k"], ["c"])
    assert rows(out.agg(F.sum("c_sli"))) == [(64,)]


def test_running_totals_and_deltas_undo_each_other(spark, rows):
    made = [("k", at(m), m + 1) for m in range(6)]
    df = spark.createDataFrame(made, "k string, batch_ts timestamp, c bigint")
    totals = compare.running_totals(df, ["k"], ["c"])
    back = compare.delta_by_row(totals, ["k"], ["c"])
    assert rows(back, "batch_ts", "c", "c_sli")[1:] == [
        (at(m), sum(range(1, m + 2)), m + 1) for m in range(1, 6)
    ]


def test_overflow_is_null_not_an_error(spark, rows):
    df = spark.createDataFrame([(2**63 - 1, -5), (None, None)], "s bigint, t bigint")
    out = df.select(side_difference(F.col("s"), F.col("t")).alias("d"))
    assert rows(out) == [(None,), (None,)]


@pytest.mark.parametrize(
    "now,before,expected",
    [
        (0, None, [(at(0), None, None, None)]),
        (1, 0, [(at(1), 60, 5, 7)]),
        (2, 1, []),
        (3, 2, [(at(3), 60, None, None)]),
    ],
)
def test_delta_for_one_run(counters, rows, now, before, expected):
    previous = None if before is None else at(before)
    out = compare.delta_for_run(counters, at(now), previous, KEYS, COLS)
    assert rows(out, "batch_ts", "timesincelastbatch", *[f"{c}_sli" for c in COLS]) == expected


def test_delta_for_one_run_reads_two_days(spark, tmp_path):
    from flowaudit.sources.tables import append_files, read_files

    made = [("k", datetime(2024, 1, day), day * day) for day in range(1, 8)]
    df = spark.createDataFrame(made, "k string, batch_ts timestamp, c bigint")
    append_files(df, str(tmp_path / "t"))
    stored = read_files(spark, str(tmp_path / "t"))
    out = compare.delta_for_run(stored, datetime(2024, 1, 5), datetime(2024, 1, 4), ["k"], ["c"])
    assert [r.c_sli for r in out.collect()] == [9]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_date" in plan


def test_reset_flag(counters, rows):
    out = compare.with_reset_flag(compare.delta_by_row(counters, KEYS, COLS), COLS)
    assert rows(out, "batch_ts", "was_reset") == [(at(0), False), (at(1), False), (at(3), True)]
