"""Streams over several micro-batches equal the batch operators, in and out of order."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowaudit.operators import compare, payloads
from flowaudit.operators.runs import link_runs
from flowaudit.plans import inputs as i
from flowaudit.plans import streams
from flowaudit.schemas import OP_KINDS, counter_columns
from flowaudit.streaming import logs, ordered, sinks, windows

START = datetime(2024, 1, 1)
KEYS = ["app_name", "table_name"]
COUNTERS = "app_name string, table_name string, batch_ts timestamp, ins bigint, del bigint"


def counters():
    """Three keys, sixteen runs an hour apart, skipped runs, resets and nulls."""
    rng = random.Random(3)
    made = []
    for key in ("a", "b", "c"):
        for run in range(16):
            if rng.random() < 0.25:
                continue
            value = None if rng.random() < 0.1 else rng.randrange(2**60)
            made.append(("app", key, START + timedelta(hours=run), value, run))
    return made


def land(spark, made, schema, folder, parts, ts_at, swapped):
    """Write rows as ``parts`` files, each an hour range; ``swapped`` exchanges neighbours."""
    made = sorted(made, key=lambda r: r[ts_at])
    size = -(-len(made) // parts)
    pieces = [made[n * size:(n + 1) * size] for n in range(parts)]
    if swapped:
        for n in range(0, parts - 1, 2):
            pieces[n], pieces[n + 1] = pieces[n + 1], pieces[n]
    frame = spark.createDataFrame(made, schema)
    for n, piece in enumerate(pieces):
        spark.createDataFrame(piece, schema).coalesce(1).write.parquet(f"{folder}/part={n}")
    return frame


def run_by_file(spark, schema, tmp_path, build, ts="batch_ts"):
    """One micro-batch per file, in the order they were written, then the closing row."""
    folder, target = str(tmp_path / "in"), str(tmp_path / "feed")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def drain():
        return sinks.drain_to_files(build(sinks.read_landed(spark, target, schema)), out, log)

    for n in range(len(list((tmp_path / "in").iterdir()))):
        spark.read.schema(schema).parquet(f"{folder}/part={n}").write.mode("append").parquet(target)
        drain()
    sinks.closing_row(spark, schema, ts).write.mode("append").parquet(target)
    return sinks.before_closing(drain(), "batch_ts")


@pytest.mark.parametrize("swapped", [False, True])
def test_delta_by_row(spark, tmp_path, rows, swapped):
    batch = land(spark, counters(), COUNTERS, str(tmp_path / "in"), 4, 2, swapped)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: ordered.delta_by_row_stream(s, KEYS, ["ins", "del"], delay="10 hours"),
    )
    expected = compare.delta_by_row(batch, KEYS, ["ins", "del"])
    assert rows(stream) == rows(expected, *stream.columns)


@pytest.mark.parametrize("swapped", [False, True])
def test_delta_by_run(spark, tmp_path, rows, swapped):
    made = counters()
    runs = spark.createDataFrame([(START + timedelta(hours=n),) for n in range(16)], "batch_ts timestamp")
    linked = {r.batch_ts: r.previous_ts for r in link_runs(runs).collect()}
    carrying = [(*row, linked[row[2]]) for row in made]
    schema = f"{COUNTERS}, previous_ts timestamp"
    batch = land(spark, carrying, schema, str(tmp_path / "in"), 4, 2, swapped)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: ordered.delta_by_run_stream(s, KEYS, ["ins", "del"], delay="10 hours"),
    )
    expected = compare.delta_by_run(batch.drop("previous_ts"), runs, KEYS, ["ins", "del"])
    cols = [*KEYS, "batch_ts", "ins_sli", "del_sli"]
    assert rows(stream, *cols) == rows(expected, *cols)


@pytest.mark.parametrize("swapped", [False, True])
def test_emit_on_change(spark, tmp_path, rows, swapped):
    rng = random.Random(5)
    made = [
        (key, START + timedelta(hours=run), rng.choice([START, START + timedelta(days=1), None]))
        for key in ("t", "u") for run in range(20)
    ]
    schema = "type_name string, batch_ts timestamp, version timestamp"
    batch = land(spark, made, schema, str(tmp_path / "in"), 5, 1, swapped)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: ordered.emit_on_change_stream(s, version="version", delay="12 hours"),
    )
    assert rows(stream) == rows(payloads.emit_on_change(batch, version="version"))


def changes():
    rng = random.Random(11)
    ops = list(compare.OP_CODES.values())
    return [
        ("app", rng.choice("xyz"), START + timedelta(minutes=37 * n), rng.choice(["src", "tgt"]),
         rng.choice(ops), n)
        for n in range(120)
    ]


CHANGES = "app_name string, table_name string, ts timestamp, side string, op string, id bigint"


@pytest.mark.parametrize("swapped", [False, True])
def test_time_batches(spark, tmp_path, rows, swapped):
    batch = land(spark, changes(), CHANGES, str(tmp_path / "in"), 4, 2, swapped)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: windows.time_batches_stream(s, KEYS, "ts", "2 hours", "3 days"),
        "ts",
    )
    expected = batch.groupBy(*KEYS, F.window("ts", "2 hours").alias("w")).count()
    assert rows(stream) == rows(expected, *KEYS, "w.start", "count")


@pytest.mark.parametrize("swapped", [False, True])
def test_reconcile(spark, tmp_path, rows, swapped):
    batch = land(spark, changes(), CHANGES, str(tmp_path / "in"), 4, 2, swapped)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: windows.reconcile_stream(s, KEYS, "ts", "1 day", "3 days"),
        "ts",
    )
    daily = batch.withColumn("batch_ts", F.date_trunc("day", "ts"))
    expected = compare.diff_counts(compare.side_counts(daily, [*KEYS, "batch_ts"]))
    cols = [*KEYS, "batch_ts", *counter_columns()]
    assert rows(stream, *cols) == rows(expected, *cols)


def test_reconcile_each_batch_adds_up_sides_of_different_files(spark, tmp_path, rows):
    made = changes()
    for n, side in enumerate(("src", "tgt")):
        piece = [r for r in made if r[3] == side]
        spark.createDataFrame(piece, CHANGES).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )
    batch = spark.createDataFrame(made, CHANGES)
    feed = sinks.read_landed(spark, str(tmp_path / "in"), batch.schema, files_per_trigger=1)
    totals = windows.reconcile_each_batch(feed, KEYS, str(tmp_path / "out"), str(tmp_path / "log"))
    expected = compare.diff_counts(compare.side_counts(batch, KEYS))
    cols = [*KEYS, *counter_columns()]
    assert rows(totals, *cols) == rows(expected, *cols)
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 2
    handle = windows.store_partial_counts(str(tmp_path / "out"), KEYS)
    handle(batch.where("side = 'src'"), 0)
    again = windows.partial_totals(spark, str(tmp_path / "out"), KEYS)
    sums = [F.sum(f"src_num_of_{k}") for k in OP_KINDS]
    assert again.agg(*sums).first() == expected.agg(*sums).first()


def test_replays_are_dropped(spark, tmp_path, rows):
    made = changes()
    land(spark, made, CHANGES, str(tmp_path / "in"), 3, 2, False)
    target = str(tmp_path / "feed")
    schema = spark.createDataFrame(made, CHANGES).schema
    for part in (0, 0, 1, 2, 2):
        spark.read.schema(schema).parquet(f"{tmp_path}/in/part={part}").write.mode("append").parquet(target)
        feed = sinks.read_landed(spark, target, schema)
        once = sinks.drain_to_files(
            windows.drop_replays(feed, ["id"], "ts", "30 days"),
            str(tmp_path / "out"), str(tmp_path / "log"),
        )
    assert rows(once, "id") == sorted([(n,) for n in range(len(made))], key=repr)


def test_hot_record_is_collapsed_before_the_state(spark, tmp_path, rows):
    """Half of all rows are copies of one record, over two micro-batches."""
    schema = "id bigint, ts timestamp, v string"
    at = [START + timedelta(seconds=n) for n in range(400)]
    for part in (0, 1):
        made = [(7, t, "hot") for t in at[part * 200:(part + 1) * 200]]
        made += [(100 + n, at[n], "cold") for n in range(part * 200, (part + 1) * 200)]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "feed")
        )
    feed = sinks.read_landed(
        spark, str(tmp_path / "feed"), spark.createDataFrame([], schema).schema, files_per_trigger=1
    )
    once = windows.first_arrivals(
        feed, ["id"], "ts", "1 day", str(tmp_path / "mid"), str(tmp_path / "mid-log")
    )
    out = sinks.drain_to_files(once, str(tmp_path / "out"), str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "mid"))
    assert stored.where("id = 7").count() == 2
    assert out.columns == ["id", "ts", "v"]
    assert rows(out, "id") == sorted([(7,)] + [(100 + n,) for n in range(400)], key=repr)


def test_rows_without_time_are_rejects_and_changes_keep_their_type(spark, tmp_path, rows):
    schema = ("app_name string, table_name string, batch_ts timestamp, n int, small smallint, part double,"
              " thin float, money decimal(12,2), wide decimal(38,10)")  # fmt: skip
    made = [
        ("app", key, START + timedelta(hours=run), 2**31 - 1 if run % 2 else -5, 30000 if run % 2 else -30000,
         run / 7, run / 4, Decimal(run * run) / 4, Decimal("1234567890123456789012345678.0123456785") * (run % 3 - 1))
        for key in "ab" for run in range(6)
    ]
    timeless = [("app", key, None, 1, 1, 1.0, 1.0, Decimal(1), Decimal(1)) for key in ("a", "a", "c")]
    for n, piece in enumerate((made[::2] + timeless[:2], made[1::2] + timeless[2:])):
        spark.createDataFrame(piece, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={n}")
    cols = ["n", "small", "part", "thin", "money", "wide"]
    batch = spark.createDataFrame(made, schema)
    stream = run_by_file(
        spark, batch.schema, tmp_path,
        lambda s: ordered.delta_by_row_stream(s, KEYS, cols, delay="10 hours"),
    )
    expected = compare.delta_by_row(batch, KEYS, cols)
    assert rows(stream) == rows(expected, *stream.columns)
    kinds = {f.name: f.dataType for f in expected.schema}
    assert {f.name: f.dataType for f in stream.schema} == kinds
    feed = sinks.read_landed(spark, str(tmp_path / "feed"), batch.schema, files_per_trigger=1)
    rejects = sinks.drain_to_files(
        ordered.time_rejects(feed), str(tmp_path / "rejects"), str(tmp_path / "rejects-log")
    )
    assert rows(rejects) == sorted(map(tuple, spark.createDataFrame(timeless, schema).collect()), key=repr)
    assert stream.count() + rejects.count() == len(made) + len(timeless)


def test_rows_beyond_the_delay_are_left_out(spark, tmp_path, rows):
    """A row later than the delay neither comes out nor disturbs the rows in order."""
    made = [("app", "a", START + timedelta(hours=n), n * n, 0) for n in range(6)]
    late = [("app", "a", START + timedelta(minutes=30), 1000, 0)]
    folder = tmp_path / "in"
    for n, piece in enumerate((made[:4], made[4:], late)):
        spark.createDataFrame(piece, COUNTERS).coalesce(1).write.parquet(f"{folder}/part={n}")
    schema = spark.createDataFrame(made, COUNTERS).schema
    out = run_by_file(
        spark, schema, tmp_path,
        lambda s: ordered.delta_by_row_stream(s, KEYS, ["ins"], delay="1 hour"),
    )
    assert rows(out, "ins", "ins_sli") == sorted(
        [(0, None), (1, 1), (4, 3), (9, 5), (16, 7), (25, 9)], key=repr
    )


CLOSED = ["stream_delta_by_row", "stream_delta_by_run", "stream_emit_on_change", "stream_time_batches", "stream_reconcile"]


@pytest.mark.parametrize("name", CLOSED)
def test_closed_queries_in_one_trigger_per_file(spark, tmp_path, monkeypatch, name):
    """Events in four files without order, every landed file in a trigger of its own."""
    import duckdb

    import __spark_entry__ as entry_point

    given = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    given.repartition(4, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    read = sinks.read_landed
    monkeypatch.setattr(sinks, "read_landed", lambda s, path, schema: read(s, path, schema, 1))
    land_one = streams.land

    def land_parts(df, label):
        return land_one(df.repartition(3), label)

    monkeypatch.setattr(streams, "land", land_parts)
    out = entry_point.queries()[name](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    result = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = sorted((tuple(map(repr, r)) for r in result.fetchall()))
    assert sorted(tuple(repr(r[c]) for c in names) for r in out.collect()) == theirs


@pytest.fixture
def log_folder(spark, tmp_path):
    raw = spark.createDataFrame(
        [(n, START + timedelta(seconds=n), n % 3, kind, 7.0, '{"k": 1}')
         for n, kind in enumerate(["error", "view", "click", "signup"] * 6)],
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    )
    lines = i.log_lines(i.from_events(raw)).orderBy("line_no").select("value")
    lines.repartitionByRange(3, "value").write.text(str(tmp_path / "logs"))
    return str(tmp_path / "logs"), lines


def test_watch_errors(spark, tmp_path, rows, log_folder):
    from flowaudit.operators.logs import errors_only, parse_logs
    from flowaudit.sources.landed import stream_logs

    folder, lines = log_folder
    feed = stream_logs(spark, folder, files_per_trigger=1)
    errors = sinks.drain_to_files(
        logs.watch_errors(feed), str(tmp_path / "out"), str(tmp_path / "log")
    )
    assert rows(errors) == rows(errors_only(parse_logs(lines)))
    assert errors.count() == 6


def test_errors_are_stored_with_context(spark, tmp_path, log_folder):
    from flowaudit.sources.landed import stream_logs

    folder, _ = log_folder
    handle = logs.store_with_context(str(tmp_path / "out"), 1, 1)
    sinks.drain_each_batch(stream_logs(spark, folder), handle, str(tmp_path / "log"))
    handle(spark.read.text(folder), 0)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 6
    assert stored.where("contextbuffertext not like '%ERROR%'").count() == 0
