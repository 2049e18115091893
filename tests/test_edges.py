"""Readings, keys and histories beyond ordinary input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from flowaudit.functions.text import parse_bytes
from flowaudit.operators.compare import delta_by_run
from flowaudit.operators.logs import parse_logs
from flowaudit.operators.stamping import with_row_id
from flowaudit.session import PARTITION_BYTES, shuffle_settings


def test_byte_counts_of_many_digits(spark):
    texts = ["99999999999999 bytes", "109951162777600 bytes", "123456789012345678", "100 TB", "9999 PB", "1" + "0" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_bytes(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [
        99999999999999, 109951162777600, 123456789012345678, 100 * 1024**4, None, None,
    ]


def test_keys_with_nulls_in_other_places_have_other_ids(spark):
    rows = [("a", None), (None, "a"), ("a", "a"), (None, None), ("a", None)]
    ids = [r.row_id for r in with_row_id(spark.createDataFrame(rows, "x string, y string"), "t", ["x", "y"]).collect()]
    assert len(set(ids)) == 4
    assert ids[0] == ids[4]


def test_a_log_line_may_hold_the_separator_byte(spark):
    line = "2024-01-02 03:04:05.000001 @s\x1f1 -ERROR app : hi \x1f there"
    row = parse_logs(spark.createDataFrame([(line,)], "value string")).first()
    assert (row.server, row.log_level, row.app_name, row.message) == ("s\x1f1", "ERROR", "app", "hi \x1f there")


def test_clusters_polled_in_turn_have_their_own_run_before(spark):
    rows = [(c, "t", datetime(2024, 1, 1, 2 * k + (c == "b")), 10 * k * k) for c in "ab" for k in range(3)]
    df = spark.createDataFrame(rows, "cluster string, name string, batch_ts timestamp, n bigint")
    got = delta_by_run(df, df, ["name"], ["n"], by=["cluster"]).orderBy("cluster", "batch_ts").collect()
    assert [r.n_sli for r in got] == [None, 10, 30] * 2
    assert [r.timesincelastbatch for r in got] == [None, 7200, 7200] * 2


def test_shuffle_partitions_grow_with_the_volume():
    assert shuffle_settings(100 * 10**12, 4)["spark.sql.shuffle.partitions"] == -(-100 * 10**12 // PARTITION_BYTES)
