"""Training-data queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from flowaudit.llm.queries import EXPECTED_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


@pytest.mark.parametrize("name", list(EXPECTED_SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(EXPECTED_SQL[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    theirs = sorted(tuple(plain(r[p]) for p in order) for r in result.fetchall())
    assert ours == theirs
    assert ours


def test_every_query_is_registered():
    assert entry_point.queries().keys() >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", ["op5_license_index"])
def test_native_plans_run_no_python(spark, name):
    plan = re.sub(r"#\d+L?", "", QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString())
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert unwanted not in plan
