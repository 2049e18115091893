"""Every named query against its SQL, and the shape of its plan."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from flowaudit.plans.catalog import EXPECTED_SQL as SQL
from flowaudit.plans.catalog import QUERIES

DATA = os.environ.get("FLOWAUDIT_TEST_DATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(plain(r[p]) for p in order) for r in result.fetchall())
    assert ours == theirs
    assert ours


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


BATCH = [n for n in QUERIES if not n.startswith("stream_")]
#: Where a batch ends depends on where it opened; the times of a chunk are gone through in Python.
IN_ORDER = ("open_batches_by_time", "open_batches_by_either")


@pytest.mark.parametrize("name", BATCH)
def test_plan_stays_in_the_engine(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in IN_ORDER:
        for unwanted in ("Python", "Pandas", "Arrow"):
            assert unwanted not in text


def test_all_deltas_share_windows(spark):
    text = plan(QUERIES["delta_by_run"](spark, DATA))
    # Run links, running totals and the delta itself.
    assert len(re.findall(r"\bWindow \[", text)) == 3
    assert text.count("FileScan") == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["reconcile_counts"](spark, DATA))
    assert "LessThan(value,150.0)" in text and "GreaterThanOrEqual(value,3.0)" in text
    counts = plan(QUERIES["op_counts"](spark, DATA))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in counts


def test_sample_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["lag_stats_sampled"](spark, DATA))
    assert text.count("WindowGroupLimit") == 4
    assert "Partial" in text


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(QUERIES["reconcile_one_feed"](spark, DATA))
    assert "partial_sum" in text
    assert text.count("Exchange") == 1


def test_no_join_is_hinted(spark):
    """With broadcast by size switched off, nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in BATCH:
            assert "Broadcast" not in plan(QUERIES[name](spark, DATA)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert entry_point.queries().keys() >= QUERIES.keys()
    assert entry_point.oracle_sql().keys() >= SQL.keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


def test_all_tables_are_stored_in_their_schema(spark, tmp_path):
    from flowaudit.plans import tables
    from flowaudit.schemas import TABLES as DECLARED

    spark.sql("DROP DATABASE IF EXISTS fa_all CASCADE")
    names = tables.store(spark, DATA, "fa_all", str(tmp_path / "store"))
    assert set(names) == set(DECLARED)
    for name, stored_as in names.items():
        stored = spark.table(stored_as)
        assert stored.columns == [*DECLARED[name].columns, "batch_date"]
        assert [f.dataType for f in stored.schema][:-1] == [f.dataType for f in DECLARED[name].schema]
        built = tables.BUILDERS[name](spark, DATA)
        assert stored.count() == built.count() > 0
        ids = stored.groupBy(DECLARED[name].row_id).count()
        if DECLARED[name].key_declared:
            assert ids.where("count > 1").count() == 0
    spark.sql("DROP DATABASE fa_all CASCADE")
