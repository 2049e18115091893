"""Text readings, snapshots, lag, payloads, batches and logs on hand-made rows."""

from __future__ import annotations

import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowaudit.functions import text as tx
from flowaudit.functions.payload import json_rows, json_text
from flowaudit.operators import audit, batches, lag, logs, payloads, runs, snapshots, stamping
from flowaudit.operators.joins import lookup

T0 = datetime(2024, 1, 1, 10)


def one(spark, column, values, kind="string"):
    """Apply a column function to a list of values, keeping their order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_interval_text(spark):
    given = ["1 MINUTE INTERVAL", "soon", " 2  hours interval ", "1 MINUTE", None, "3 DAY INTERVAL"]
    assert one(spark, tx.interval_seconds, given) == [60, None, 7200, None, None, 259200]


def test_sizes(spark):
    given = ["512", "1.5 GB", "12kb", "2 MiB", "3 bytes", "many", "", None, "1 XB"]
    assert one(spark, tx.parse_bytes, given) == [
        512, 1610612736, 12288, 2097152, 3, None, None, None, None,
    ]


def test_uptimes(spark):
    given = ["3 days 04:05:06", "2h 5m", "44 s", "1 day, 2 hours, 3 minutes", "", "long", None, "7"]
    assert one(spark, tx.parse_seconds, given) == [
        273906, 7500, 44, 93780, None, None, None, None,
    ]


def test_server_address(spark):
    given = ["S192_168_1_30", "node_7", "S1_2", None]
    assert one(spark, tx.server_address, given) == ["192.168.1.30", "node_7", "S1_2", None]


def test_source_time(spark):
    given = ["2024-01-01 10:00:00", "when", None]
    assert one(spark, tx.source_time, given) == [T0, None, None]


def test_json_text_and_back(spark):
    df = spark.createDataFrame([([{"a": 1}, {"a": 2}],)], "x array<struct<a:bigint>>")
    text = df.select(json_text(F.col("x")).alias("t"))
    assert text.first().t == '[{"a":1},{"a":2}]'
    back = text.select(json_rows(F.col("t"), "struct<a:bigint>").alias("x")).first().x
    assert [r.a for r in back] == [1, 2]


def test_status_filter(spark, rows):
    df = spark.createDataFrame([("CREATED",), ("DEPLOYED",), ("RUNNING",), (None,)], "app_status string")
    assert rows(snapshots.app_detail(df)) == [("RUNNING",), (None,)]
    assert rows(snapshots.app_detail(df, include_created=True)) == [
        ("CREATED",), ("RUNNING",), (None,),
    ]
    assert snapshots.app_detail(df, True, True).count() == 4


def test_server_count(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "numservers bigint")
    assert rows(snapshots.unexpected_servers(df)) == [(2,)]


def test_cpu_share(spark, rows):
    readings = spark.createDataFrame([("n", 400.0), ("m", 50.0)], "node string, cpurate double")
    cores = spark.createDataFrame([("n", 8)], "node string, cores int")
    assert rows(snapshots.cpu_share(readings, cores, "node"), "node", "cpu_share") == [
        ("m", None), ("n", 0.5),
    ]


def test_used_share(spark, rows):
    df = spark.createDataFrame([(25, 100), (0, 0), (None, 5)], "f bigint, t bigint")
    assert rows(snapshots.used_share(df, "f", "t"), "used_share") == [(0.75,), (None,), (None,)]


def test_optional_detail(spark, rows):
    apps = spark.createDataFrame([("a",), ("b",)], "app_name string")
    off = snapshots.with_detail(apps)
    assert dict(off.dtypes)["is_encryption_enabled"] == "boolean"
    assert rows(off) == [("a",) + (None,) * 6, ("b",) + (None,) * 6]
    status = spark.createDataFrame(
        [("a", "S10_0_0_1", "default")], "app_name string, deployment_on string, deployment_in string"
    )
    on = snapshots.with_detail(apps, status=status)
    assert rows(on, "app_name", "deployment_on") == [("a", "S10_0_0_1"), ("b", None)]


def test_deployment_nodes(spark, rows):
    df = spark.createDataFrame([("a", " S10_0_0_1, S10_0_0_2 ")], "app string, deployment_on string")
    assert rows(snapshots.deployment_nodes(df), "node") == [("10.0.0.1",), ("10.0.0.2",)]


def test_checkpoint_state(spark, rows):
    df = spark.createDataFrame(
        [(5, 10), (0, 10), (5, 400), (0, 4000), (None, 1)], "p bigint, idle bigint"
    )
    out = snapshots.checkpoint_state(df, snapshots.checkpoint_rules("p", "idle"))
    assert [r[0] for r in out.select("checkpoint_status").collect()] == [
        "PROGRESSING", "LAGGING", "LAGGING", "STALLED", "UNKNOWN",
    ]


def test_checkpoint_state_by_own_rules(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "p bigint")
    out = snapshots.checkpoint_state(df, [("BUSY", F.col("p") > 3), ("IDLE", F.col("p") <= 3)])
    assert rows(out, "checkpoint_status") == [("BUSY",), ("IDLE",), (None,)]


def test_runs(spark, rows):
    df = spark.createDataFrame(
        [("c", T0, T0 + timedelta(milliseconds=1500)), ("c", T0 + timedelta(minutes=2), None),
         ("d", T0 + timedelta(minutes=1), None)],
        "cluster_name string, batch_ts timestamp, runtime_end timestamp",
    )
    first = datetime(2020, 1, 1)
    out = runs.next_run(runs.previous_run(runs.run_duration(df), first), 60)
    assert rows(out, "cluster_name", "runtime_duration_ms", "lastrun", "nextrun") == [
        ("c", 1500, first, T0 + timedelta(minutes=1)),
        ("c", None, T0, T0 + timedelta(minutes=3)),
        ("d", None, first, T0 + timedelta(minutes=2)),
    ]


def test_row_ids(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, n bigint")
    ids = stamping.with_row_id(df, "t", ["k", "n"])
    again = stamping.with_row_id(df.orderBy(F.desc("n")).repartition(3), "t", ["k", "n"])
    assert rows(ids) == rows(again)
    assert ids.select("row_id").distinct().count() == 3
    other = stamping.with_row_id(df, "u", ["k", "n"])
    assert ids.join(other, "row_id").count() == 0


def test_batch_stamps(spark, rows):
    df = spark.createDataFrame([(T0 + timedelta(minutes=17, seconds=3),), (None,)], "ts timestamp")
    out = stamping.bucket_batches(df, "ts", 900)
    assert rows(out, "batch_ts") == sorted([(T0 + timedelta(minutes=15),), (None,)], key=repr)
    assert rows(stamping.stamp_batch(df, T0), "batch_ts") == [(T0,), (T0,)]


def test_audits(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (None, "x")], "k bigint, v string")
    assert rows(audit.duplicate_keys(df, ["k"])) == [(1, 2)]
    parent = spark.createDataFrame([(2,), (2,)], "k bigint")
    assert rows(audit.orphans(df, parent, "k")) == sorted(
        [(1, "x"), (1, "y"), (None, "x")], key=repr
    )


def test_lag_sample(spark, rows):
    made = [(1, 10, 0), (2, 20, 1), (3, 90, 2)]
    df = spark.createDataFrame(
        [(n, "s", "t", ms, T0 + timedelta(seconds=s)) for n, ms, s in made],
        "record_id bigint, source_name string, target_name string, lag_ms bigint, delivered_ts timestamp",
    )
    assert rows(lag.lag_stats(df, sample=2)) == [("s", "t", 20, 90, 55.0, 2)]
    assert rows(lag.lag_stats(df)) == [("s", "t", 10, 90, 40.0, 3)]
    assert rows(lag.current_lag(df), "lag_end_to_end") == [(90,)]


def test_replayed_records_have_one_lag(spark, rows):
    created = spark.createDataFrame(
        [(1, "s", T0)] * 50 + [(1, "s", T0 + timedelta(seconds=9))],
        "record_id bigint, source_name string, created_ts timestamp",
    )
    delivered = spark.createDataFrame(
        [(1, "t", T0 + timedelta(seconds=2 + n)) for n in range(50)]
        + [(1, "u", T0 + timedelta(seconds=5)), (2, "t", T0)],
        "record_id bigint, target_name string, delivered_ts timestamp",
    )
    out = lag.record_lag(created, delivered)
    assert rows(out, "record_id", "target_name", "lag_ms") == [(1, "t", 2000), (1, "u", 5000)]


def test_attribution(spark, rows):
    names = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "component_name string")
    catalog = spark.createDataFrame(
        [("x", "a"), ("x", "b"), ("z", "a"), ("z", "a")], "component string, app string"
    )
    out = lag.attribute(names, catalog, "component_name")
    assert rows(out) == sorted(
        [("x", None, 2), ("y", None, 0), ("z", "a", 1), (None, None, 0)], key=repr
    )


def test_lookup_keeps_every_row_of_a_hot_key(spark, rows):
    df = spark.range(0, 500, 1, 6).withColumn("k", F.lit("hot"))
    table = spark.createDataFrame([("hot", 1), ("cold", 2)], "name string, v int")
    out = lookup(df, table, F.col("k"), "name", spread=4)
    assert out.columns == ["id", "k", "v"]
    assert out.where("v = 1").count() == 500


def test_payload_rejects(spark, rows):
    df = spark.createDataFrame(
        [("mon", "APP", '{"a":1}'), ("mon", "APP", "{bad"), ("stop", "APP", "{}"),
         ("describe", "ROOM", "{}"), (None, "APP", "{}"), ("mon", "TYPE", None)],
        "command string, type string, jsondata string",
    )
    assert rows(payloads.capture(df)) == [("mon", "APP", '{"a":1}')]
    assert payloads.capture_rejects(df).count() == 5


def test_properties_keep_nested_text(spark, rows):
    df = spark.createDataFrame([(1, '{"a":1,"b":{"c":[2]},"d":null}')], "id int, jsondata string")
    assert rows(payloads.properties(df), "property", "value") == [
        ("a", "1"), ("b", '{"c":[2]}'), ("d", None),
    ]


@pytest.mark.parametrize("split", [None, 1])
def test_property_changes(spark, rows, split):
    made = [(None, 0), (None, 1), ("a", 2), ("a", 3), ("b", 30)]
    df = spark.createDataFrame(
        [("app", "c", "p", T0 + timedelta(hours=h), v) for v, h in made],
        "app_name string, component_name string, property string, batch_ts timestamp, value string",
    )
    out = payloads.property_changes(df, split_rows=split)
    assert rows(out, "previous_value", "value") == [("a", "b"), (None, "a")]


@pytest.mark.parametrize("split", [None, 1])
def test_emit_on_change(spark, rows, split):
    versions = [T0, T0, T0 + timedelta(days=1), T0]
    df = spark.createDataFrame(
        [("t", T0 + timedelta(hours=h), v) for h, v in enumerate(versions)],
        "type_name string, batch_ts timestamp, created_date timestamp",
    )
    once = payloads.emit_on_change(df, split_rows=split)
    assert [r.batch_ts.hour for r in once.orderBy("batch_ts").collect()] == [10, 12, 13]
    assert rows(payloads.emit_on_change(once)) == rows(once)


def test_match_type(spark, rows):
    tables = spark.createDataFrame(
        [("a", "t"), ("a", "t"), ("x_y", "z"), ("x", "y_z")], "app_name string, table_name string"
    )
    types = spark.createDataFrame([("A_T",), ("X_Y_Z",), ("Q",)], "type_name string")
    assert rows(payloads.match_type(types, tables)) == sorted(
        [("A_T", "a", "t", 1), ("X_Y_Z", None, None, 2), ("Q", None, None, 0)], key=repr
    )


def test_flatten_missing_fields_are_null(spark):
    text = json.dumps(
        {"total_batches_created": 4, "new_field": 1,
         "Last batch info": {"inserts": 3, "Integration Task Time": {"upload_time_ms": 9}}}
    )
    row = batches.flatten_target(spark.createDataFrame([(text,), ("{bad",)], "jsondata string")).collect()
    assert row[0].total_batches_created == 4
    assert row[0].last_batch_inserts == 3
    assert row[0].last_batch_upload_time_ms == 9
    assert row[0].last_batch_merge_time_ms is None
    assert row[0].jsondata == text
    assert row[1].total_batches_created is None


def test_phase_shares(spark, rows):
    wide = {f"last_batch_{p}": n for n, p in enumerate(batches.PHASES)}
    df = spark.createDataFrame(
        [("t", *wide.values(), 42), ("u", *wide.values(), 0)],
        ["target_name", *wide, "last_batch_total_integration_time_ms"],
    )
    out = batches.phase_breakdown(df)
    assert out.count() == 14
    assert rows(out.where("phase = 'upload_time_ms'"), "target_name", "phase_share") == [
        ("t", 2 / 42), ("u", None),
    ]


@pytest.mark.parametrize("split", [1, 10**6])
def test_batches_by_count_and_time(spark, rows, split):
    made = [("t", T0 + timedelta(minutes=m), m) for m in range(0, 150, 10)]
    df = spark.createDataFrame(made, "target_name string, ts timestamp, id bigint")
    counted = batches.form_batches(df, ["target_name"], "ts", ["ts"], max_events=4, split_rows=split)
    assert rows(counted.groupBy("batch_no").count()) == [(0, 4), (1, 4), (2, 4), (3, 3)]
    either = batches.form_batches(
        df, ["target_name"], "ts", ["ts"], max_events=4, every_s=3600, split_rows=split
    )
    assert rows(either.groupBy("batch_start", "batch_no").count(), "count") == [
        (2,), (2,), (3,), (4,), (4,),
    ]
    with pytest.raises(ValueError):
        batches.form_batches(df, ["target_name"], "ts", ["ts"])


def test_log_lines(spark, rows):
    lines = [
        "2024-01-01 10:00:00.000001 @s1 -ERROR app1 : it broke : badly",
        "2024-01-01 10:00:01.000000 @s1 -INFO app1 : fine",
        "garbage", "", None,
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = logs.parse_logs(df)
    assert rows(parsed, "server", "log_level", "app_name", "message") == [
        ("s1", "ERROR", "app1", "it broke : badly"), ("s1", "INFO", "app1", "fine"),
    ]
    assert parsed.where("log_level = 'ERROR'").first().log_date.microsecond == 1
    assert logs.log_rejects(df).count() == 3
    assert logs.errors_only(parsed).count() == 1


@pytest.mark.parametrize("split", [1, 10**6])
def test_context(spark, rows, split):
    df = spark.createDataFrame(
        [("s", T0 + timedelta(minutes=n), n, str(n)) for n in (1, 2, 3)],
        "server string, log_date timestamp, line_no bigint, value string",
    )
    out = logs.with_context(df, 1, 1, split_rows=split)
    assert rows(out, "line_no", "contextbuffertext") == [(1, "1\n2"), (2, "1\n2\n3"), (3, "2\n3")]


def _leaves(value, path=""):
    if isinstance(value, dict) and value:
        for key, inner in value.items():
            step = f".{key}" if re.fullmatch(r"\w+", key, re.ASCII) else f"['{key}']"
            yield from _leaves(inner, path + step)
    elif isinstance(value, list) and value:
        for at, inner in enumerate(value):
            yield from _leaves(inner, f"{path}[{at}]")
    else:
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
        text = None if value is None else value if kind == "string" else json.dumps(value)
        yield (path.lstrip("."), kind, text)


def test_payload_paths_reach_any_depth(spark):
    deep = 7
    for level in range(30):
        deep = {"a": deep} if level % 2 else [deep]
    values = [
        {"a": {"b": 1}, "x y": [True, None, {"c": []}]}, {}, [], [1, "two", [3]], "alone", 5, None,
        {"quo\"te": "{[\\\"", "e": {}}, deep, {"s": "1.5", "n": 1.5, "é": "ü"},
    ]
    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    rows = [(k, "clash", t) for k, t in enumerate([*texts, "{broken", None])]
    df = spark.createDataFrame(rows, "id int, key string, jsondata string")
    found = payloads.payload_paths(df)
    assert found.columns == ["id", "key", "path", "kind", "value"]
    wanted = [(k, "clash", *leaf) for k, v in enumerate(values) for leaf in _leaves(v)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert payloads.payload_paths(df.limit(0)).count() == 0


def test_payload_paths_of_long_strings_and_of_one_file(spark):
    """A string of many escapes is read to its end, wide arrays too, and rows of one task go to all cores."""
    long = "x\"{\\[" * 30_000
    texts = [json.dumps({"a": [long], "b": [{}] * 20_000}), json.dumps([[[]] * 3, {"c": [[1]]}])]
    df = spark.createDataFrame(enumerate(texts), "id int, jsondata string").coalesce(1)
    found = payloads.payload_paths(df)
    wanted = [(k, *leaf) for k, text in enumerate(texts) for leaf in _leaves(json.loads(text))]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    many = payloads.payload_paths(spark.range(400, numPartitions=1).select("id", F.lit('{"a": 1}').alias("jsondata")))
    parts = many.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4 and sum(r["count"] for r in parts) == 400


def test_every_payload_is_kept_or_rejected_with_a_reason(spark):
    good = ("mon", "APP", '{"a": 1}')
    rows = [good, ("stop", "APP", "{}"), (None, None, None), ("mon", "app", "{}"), ("describe", "TYPE", None),
            ("mon", "APP", "[1,2]"), ("mon", "APP", "3"), ("mon", "APP", "{bad"), ("mon", "APP", "")]
    df = spark.createDataFrame(rows, "command string, type string, jsondata string").withColumn("reason", F.lit("own"))
    assert [tuple(r)[:3] for r in payloads.capture(df).collect()] == [good]
    rejected = payloads.capture_rejects(df)
    assert rejected.columns == df.columns and rejected.count() == len(rows) - 1
    counts = {r.reason: r.row_count for r in payloads.reject_counts(df).collect()}
    assert counts == {"kept": 1, "command": 2, "type": 1, "missing": 1, "object": 2, "json": 2}
