"""Tables, conforming, landed files."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit import schemas, session
from flowaudit.sources import conform, landed, tables

T0 = datetime(2024, 1, 1, 10)


def test_recreate_and_append(spark, tmp_path, rows):
    spark.sql("DROP DATABASE IF EXISTS fa_t1 CASCADE")
    tables.recreate(spark, "fa_t1", location=str(tmp_path))
    names = [t.name for t in spark.catalog.listTables("fa_t1")]
    assert sorted(names) == sorted(schemas.TABLES)
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE fa_t1.run_history").collect()}
    assert described["batch_ts"]
    poll = spark.createDataFrame([("n", T0)], "cluster_name string, batch_ts timestamp")
    shaped = conform.shape(poll, schemas.RUN_HISTORY)
    tables.append_snapshot(shaped, "fa_t1.run_history")
    tables.append_snapshot(shaped.withColumn("batch_ts", F.lit(datetime(2024, 1, 2))), "fa_t1.run_history")
    stored = spark.table("fa_t1.run_history")
    assert rows(stored, "cluster_name", F.col("batch_date").cast("string")) == [
        ("n", "2024-01-01"), ("n", "2024-01-02"),
    ]
    pruned = stored.where("batch_date = date'2024-01-02'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan
    tables.recreate(spark, "fa_t1", [schemas.RUN_HISTORY], str(tmp_path))
    assert spark.table("fa_t1.run_history").count() == 0
    spark.sql("DROP DATABASE fa_t1 CASCADE")


def test_append_makes_the_table(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS fa_t2")
    spark.sql("DROP TABLE IF EXISTS fa_t2.snap")
    poll = spark.createDataFrame([(T0, 1)], "batch_ts timestamp, n int")
    tables.append_snapshot(poll, "fa_t2.snap")
    tables.append_snapshot(poll.select("n", "batch_ts"), "fa_t2.snap")
    assert rows(spark.table("fa_t2.snap"), "n", "batch_ts") == [(1, T0), (1, T0)]
    spark.sql("DROP DATABASE fa_t2 CASCADE")


def test_compaction_keeps_all_rows(spark, tmp_path, rows):
    path, packed = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(4):
        tables.append_files(
            spark.createDataFrame([(T0, n)], "batch_ts timestamp, n int"), path
        )
    tables.compact_days(spark, path, packed)
    assert rows(spark.read.parquet(packed), "n") == [(n,) for n in range(4)]
    assert len(list((tmp_path / "out" / "batch_date=2024-01-01").glob("*.parquet"))) == 1


@pytest.mark.parametrize("fails_at", range(1, 7))
def test_recreate_puts_the_old_tables_back_when_it_fails(spark, tmp_path, rows, monkeypatch, fails_at):
    spark.sql("DROP DATABASE IF EXISTS fa_t3 CASCADE")
    chosen = [schemas.RUN_HISTORY, schemas.APP_SNAPSHOT, schemas.NODE_SNAPSHOT]
    location = str(tmp_path) if fails_at % 2 else None
    tables.recreate(spark, "fa_t3", chosen, location)
    poll = spark.createDataFrame([("n", T0)], "cluster_name string, batch_ts timestamp")
    for table in chosen:
        tables.append_snapshot(conform.shape(poll, table), f"fa_t3.{table.name}")
    plain, calls = tables._rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == fails_at:
            raise RuntimeError("lost")
        plain(*args)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError):
        tables.recreate(spark, "fa_t3", chosen, location)
    monkeypatch.undo()
    assert sorted(t.name for t in spark.catalog.listTables("fa_t3")) == sorted(t.name for t in chosen)
    assert [spark.table(f"fa_t3.{t.name}").count() for t in chosen] == [1, 1, 1]
    tables.recreate(spark, "fa_t3", chosen, location)
    assert [spark.table(f"fa_t3.{t.name}").count() for t in chosen] == [0, 0, 0]
    if location:
        assert len(list(tmp_path.iterdir())) == 3
    told = tables.catalog_columns(spark, "fa_t3").where("table_name = 'run_history' and position < 2")
    assert rows(told, "column_name", "data_type") == sorted(
        (f.name, f.dataType.simpleString()) for f in schemas.RUN_HISTORY.schema.fields[:2]
    )
    spark.sql("DROP DATABASE fa_t3 CASCADE")


def test_a_failure_to_make_a_table_leaves_the_old_ones(spark, tmp_path, monkeypatch):
    spark.sql("DROP DATABASE IF EXISTS fa_t4 CASCADE")
    chosen = [schemas.RUN_HISTORY, schemas.APP_SNAPSHOT]
    tables.recreate(spark, "fa_t4", chosen[:1], str(tmp_path))
    plain = tables._create_empty

    def failing(spark, name, table, path):
        if table is chosen[1]:
            raise RuntimeError("lost")
        plain(spark, name, table, path)

    monkeypatch.setattr(tables, "_create_empty", failing)
    with pytest.raises(RuntimeError):
        tables.recreate(spark, "fa_t4", chosen, str(tmp_path))
    assert [t.name for t in spark.catalog.listTables("fa_t4")] == ["run_history"]
    spark.sql("DROP DATABASE fa_t4 CASCADE")


def polls(spark, values):
    made = [(datetime(2024, 1, day, hour), f"k{n}", value) for (day, hour), value in values.items() for n in range(2)]
    return spark.createDataFrame(made, "batch_ts timestamp, key string, v int")


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_repeated_append_replaces_its_run(spark, tmp_path, rows):
    path = str(tmp_path / "runs")
    times = [(1, 5), (1, 6), (2, 5), (3, 5)]
    right = {t: k for k, t in enumerate(times)}
    tables.append_runs(polls(spark, {t: -1 for t in times}), path)
    before = files_of(tmp_path / "runs")
    tables.append_runs(polls(spark, {t: right[t] for t in times[:2]}), path)
    after = files_of(tmp_path / "runs")
    assert {f for f in before if after.get(f) == before[f]} == {f for f in before if "batch_date=2024-01-01" not in f}
    for _ in range(2):
        tables.append_runs(polls(spark, right), path)
    tables.append_runs(polls(spark, {}), path)
    expected = rows(polls(spark, right))
    assert rows(tables.read_runs(spark, path), "batch_ts", "key", "v") == expected


def test_packing_days_leaves_other_days_and_lets_runs_be_stored_again(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "runs")
    times = [(1, 5), (1, 6), (2, 5), (2, 7), (3, 5)]
    tables.append_runs(polls(spark, {t: -1 for t in times}), path)
    before = files_of(tmp_path / "runs")
    plain = tables._remove
    monkeypatch.setattr(tables, "_remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.compact_runs(spark, path, datetime(2024, 1, 1).date(), datetime(2024, 1, 2).date())
    everything = rows(polls(spark, {t: -1 for t in times}))
    assert rows(tables.read_runs(spark, path), "batch_ts", "key", "v") == everything
    monkeypatch.setattr(tables, "_remove", plain)
    for _ in range(2):
        tables.compact_runs(spark, path, datetime(2024, 1, 1).date(), datetime(2024, 1, 2).date())
    after = files_of(tmp_path / "runs")
    assert {f: t for f, t in before.items() if "2024-01-03" in f} == {f: t for f, t in after.items() if "2024-01-03" in f}
    assert all("batch_run=packed" in f for f in after if "2024-01-03" not in f)
    tables.append_runs(polls(spark, {(1, 6): 9}), path)
    expected = rows(polls(spark, {t: 9 if t == (1, 6) else -1 for t in times}))
    assert rows(tables.read_runs(spark, path), "batch_ts", "key", "v") == expected
    tables.compact_runs(spark, path, datetime(2024, 1, 1).date(), datetime(2024, 1, 3).date())
    assert rows(tables.read_runs(spark, path), "batch_ts", "key", "v") == expected


SCHEMA = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("d", schemas.NUMERIC),
    T.StructField("flag", T.BooleanType()),
    T.StructField("missing", T.StringType()),
])


@pytest.fixture
def feed(spark):
    made = [("1", "2.5", "true", 0), ("x", "3", "no", 0), (None, None, None, 0)]
    return spark.createDataFrame(made, "n string, d string, flag string, other int")


def test_conform_nulls_bad_values(feed, rows):
    out = conform.conform(feed, SCHEMA)
    assert out.schema == SCHEMA
    assert rows(out) == sorted([
        (1, Decimal("2.5"), True, None), (None, Decimal(3), False, None), (None, None, None, None),
    ], key=repr)


def test_conform_can_drop_or_fail(feed):
    assert conform.conform(feed, SCHEMA, "drop").count() == 2
    assert [r.n for r in conform.conform_rejects(feed, SCHEMA).collect()] == ["x"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.conform(feed, SCHEMA, "fail").collect()
    with pytest.raises(ValueError):
        conform.conform(feed, SCHEMA, "ignore")


def test_shape_gives_the_declared_table(spark):
    poll = spark.createDataFrame([("a", T0, "7")], "appname string, batch_ts timestamp, rate string")
    out = conform.shape(poll, schemas.APP_SNAPSHOT)
    assert out.schema.fieldNames() == schemas.APP_SNAPSHOT.columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.APP_SNAPSHOT.schema]
    assert out.schema["rate"].metadata == schemas.APP_SNAPSHOT.schema["rate"].metadata
    assert out.first().monappid is not None


def test_landed_payloads(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{bad\n')
    (tmp_path / "b.json").write_text('{"a":\n 2}')
    lines = landed.read_payloads(spark, str(tmp_path / "a.json"))
    assert sorted((r.jsondata, r.is_json) for r in lines.collect()) == [
        ('{"a": 1}', True), ("{bad", False),
    ]
    whole = landed.read_payloads(spark, str(tmp_path / "b.json"), whole_files=True)
    assert whole.first().is_json and whole.first().file_path.endswith("b.json")


def test_landed_logs(spark, tmp_path):
    (tmp_path / "s.log").write_text("one\ntwo\n")
    assert [r.value for r in landed.read_logs(spark, str(tmp_path)).orderBy("value").collect()] == [
        "one", "two",
    ]


def test_checkpoint_root_is_read_from_the_session(spark):
    assert session.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_path(spark, "x").startswith(session.checkpoint_root(spark))


def test_shuffle_settings_follow_the_volume():
    small = session.shuffle_settings(10**6, cores=16)
    large = session.shuffle_settings(10**13, cores=16)
    assert small["spark.sql.shuffle.partitions"] == 16
    assert large["spark.sql.shuffle.partitions"] == -(-(10**13) // session.PARTITION_BYTES)


@pytest.mark.parametrize("split", [None, 7])
def test_lines_between_entries_are_part_of_the_context(spark, tmp_path, split):
    """Stack traces and garbled lines stay with the entry before; files are read in small pieces."""
    from flowaudit.operators import logs

    kept, texts = {}, []
    for name in ("a", "b"):
        written, blocks = ["~~ ahead of all"], []
        for n in range(40):
            level = "ERROR" if n % 5 == 0 else "INFO"
            block = [f"2024-01-01 00:00:{n:02d}.000000 @{name} -{level} app : m{n}"]
            block += [f"\tat frame{n}.{k}" for k in range(n % 4)]
            blocks.append("\n".join(block))
            written += block
        (tmp_path / f"{name}.log").write_text("\n".join(written) + "\n")
        for n in range(0, 40, 5):
            kept[name, f"m{n}"] = "\n".join(blocks[max(n - 1, 0) : n + 2])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = landed.read_logs(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        entries = logs.parse_whole_logs(lines, split_rows=split)
        order = ("log_date", "file_path", "block_start", "row_no")
        around = logs.errors_only(logs.with_context(entries, 1, 1, order=order, split_rows=split))
        assert {(r.server, r.message): r.contextbuffertext for r in around.collect()} == kept
        assert entries.count() == 80
        ahead = [r.value for r in logs.log_rejects(lines).where("value like '~~%'").collect()]
        assert ahead == ["~~ ahead of all"] * 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
