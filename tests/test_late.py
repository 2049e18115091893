"""Late rows, stored history, expiry and context across micro-batches: stream plus corrections equal batch."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowaudit.operators import compare, logs
from flowaudit.streaming import context, late, ordered, sinks

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
COUNTERS = "key string, batch_ts timestamp, n bigint"
LINES = "server string, log_date timestamp, line_no bigint, log_level string, value string"


def made_rows(count, keys="abc", seed=1):
    rng = random.Random(seed)
    return [
        (rng.choice([*keys, None]), START + timedelta(minutes=20 * k), rng.choice([None, k * k])) for k in range(count)
    ]


def parted(spark, polls, schema, tmp_path, ts, delay, ends=None):
    feed, path, log = (str(tmp_path / part) for part in ("feed", "parted", "log"))
    for rows in polls:
        frame = spark.createDataFrame(rows, schema)
        frame.write.mode("append").parquet(feed)
        late.part_late(sinks.read_landed(spark, feed, frame.schema), path, log, ts, delay, ends)
    return path, spark.createDataFrame([], schema).schema


def drained(build, feed, ts):
    feed, close = sinks.closable(feed, ts)
    return sinks.before_closing(sinks.drain_closed(build(feed), close, "late-test"), "batch_ts")


def shuffled_polls(made, polls, seed=2):
    mixed = random.Random(seed).sample(made, len(made))
    size = -(-len(mixed) // polls)
    return [mixed[n : n + size] for n in range(0, len(mixed), size)]


def test_kept_rows_and_ledger_are_the_input(spark, tmp_path, rows):
    made = [*made_rows(60), ("a", None, 1)]
    polls = [*shuffled_polls(made, 4), [], made_rows(3)]
    path, schema = parted(spark, polls, COUNTERS, tmp_path, "batch_ts", HOUR)
    stored = spark.read.parquet(f"{path}/rows")
    assert rows(stored.select("key", "batch_ts", "n")) == rows(spark.createDataFrame(made + made_rows(3), COUNTERS))
    ledger = late.ledger(spark, path, schema)
    assert 3 < ledger.count() < 60 and ledger.where("batch_ts is null").count() == 0
    marks = [r[0] for r in spark.read.parquet(f"{path}/marks").orderBy("batch_id").collect()]
    assert marks == sorted(marks)


def test_a_retried_micro_batch_replaces_its_own(spark, tmp_path, rows):
    handle = late.sieve(str(tmp_path), "batch_ts", HOUR)
    frame = spark.createDataFrame(made_rows(20), COUNTERS)
    for _ in range(2):
        handle(frame, 0)
    assert rows(spark.read.parquet(f"{tmp_path}/rows").select(*frame.columns)) == rows(frame)


def test_time_batches_with_late_rows(spark, tmp_path, rows):
    from flowaudit.streaming import windows

    made = made_rows(80)
    path, schema = parted(
        spark, shuffled_polls(made, 4), COUNTERS, tmp_path, "batch_ts", HOUR, F.window("batch_ts", "2 hours")["end"]
    )
    renamed = late.in_time(spark, path, schema).withColumnRenamed("batch_ts", "ts")
    out = drained(lambda s: windows.time_batches_stream(s, ["key"], "ts", "2 hours", "1 hour"), renamed, "ts")
    ledger = late.ledger(spark, path, schema).withColumnRenamed("batch_ts", "ts")
    assert ledger.count() > 5 and out.agg(F.sum("row_count")).first()[0] + ledger.count() == 80
    whole = late.corrected_time_batches(out, ledger, ["key"], "ts", "2 hours")
    expected = spark.createDataFrame(made, COUNTERS).groupBy("key", F.window("batch_ts", "2 hours").alias("w")).count()
    assert rows(whole) == rows(expected, "key", "w.start", "count")


def test_deltas_with_late_rows(spark, tmp_path, rows):
    made = made_rows(80)
    path, schema = parted(spark, shuffled_polls(made, 4), COUNTERS, tmp_path, "batch_ts", HOUR)
    out = drained(
        lambda s: ordered.delta_by_row_stream(s, ["key"], ["n"], delay="1 hour"), late.in_time(spark, path, schema), "batch_ts"
    )
    whole = late.corrected_deltas(out, late.ledger(spark, path, schema), ["key"], ["n"])
    assert rows(whole) == rows(compare.delta_by_row(spark.createDataFrame(made, COUNTERS), ["key"], ["n"]))


def one_by_one(spark, polls, schema, build, ts):
    frames = [spark.createDataFrame(rows, schema) for rows in polls]
    return sinks.before_closing(sinks.drain_polls(frames, build, ts, "one-by-one"), ts)


@pytest.mark.parametrize("version", [False, True])
def test_a_stream_goes_on_from_history(spark, rows, version):
    made = made_rows(40)
    history = spark.createDataFrame(made[:20], COUNTERS)
    if version:
        made = [(k, t, (n or 0) % 3) for k, t, n in made]
        history = spark.createDataFrame(made[:20], COUNTERS)
        build = lambda s: ordered.emit_on_change_stream(s, ["key"], "n", delay="1 hour", history=history)
        w = Window.partitionBy("key").orderBy("batch_ts")
        whole = spark.createDataFrame(made, COUNTERS).withColumn("before", F.lag("n").over(w))
        expected = whole.where("not (n <=> before)").drop("before")
    else:
        build = lambda s: ordered.delta_by_row_stream(s, ["key"], ["n"], delay="1 hour", history=history)
        expected = compare.delta_by_row(spark.createDataFrame(made, COUNTERS), ["key"], ["n"])
    out = one_by_one(spark, [made[20:30], made[30:]], COUNTERS, build, "batch_ts")
    assert rows(out) == rows(expected.where(F.col("batch_ts") >= F.lit(made[20][1])))


def test_state_ends_after_expiry(spark, rows):
    """A key that pauses for longer starts anew; its state is gone before it comes back."""
    at = [START + timedelta(hours=h) for h in (0, 1, 2, 30, 31, 60)]
    made = [("a", at[0], 1), ("a", at[1], 5), ("b", at[2], 7), ("b", at[3], 9), ("a", at[4], 11), ("b", at[5], 20)]

    def build(stream):
        return ordered.delta_by_row_stream(stream, ["key"], ["n"], delay="1 hour", expire=timedelta(hours=29))

    out = one_by_one(spark, [made[:3], made[3:4], made[4:5], made[5:]], COUNTERS, build, "batch_ts")
    got = {(r.key, r.n): r.n_sli for r in out.collect()}
    assert got == {("a", 1): None, ("a", 5): 4, ("b", 7): None, ("b", 9): 2, ("a", 11): None, ("b", 20): None}


def test_state_store_holds_no_expired_key(spark, tmp_path):
    made = [(f"k{k}", START, k) for k in range(50)]
    feed, log = str(tmp_path / "feed"), str(tmp_path / "log")
    schema = spark.createDataFrame(made, COUNTERS).schema

    def state_rows(rows):
        spark.createDataFrame(rows, COUNTERS).write.mode("append").parquet(feed)
        stream = ordered.delta_by_row_stream(
            sinks.read_landed(spark, feed, schema), ["key"], ["n"], delay="1 hour", expire=timedelta(days=1)
        )
        sinks.drain_to_files(stream, str(tmp_path / "out"), log)
        stored = spark.read.format("statestore").option("path", log).option("stateVarName", "last").load()
        return stored.count()

    assert state_rows(made) == 0
    assert state_rows([("z", START + timedelta(hours=12), 0)]) == 50
    assert state_rows([("z", START + timedelta(days=3), 0)]) == 1


def test_keys_share_timers(spark, tmp_path, rows):
    """Calls to the state are made per group of keys, not per key."""
    made = [(f"k{k}", START + timedelta(hours=h), k * h) for k in range(3_000) for h in range(2)]
    feed, log = str(tmp_path / "feed"), str(tmp_path / "log")
    frame = spark.createDataFrame(made, COUNTERS)

    def drain(frame):
        frame.write.mode("append").parquet(feed)
        stream = ordered.delta_by_row_stream(sinks.read_landed(spark, feed, frame.schema), ["key"], ["n"], delay="1 day")
        return sinks.drain_to_files(stream, str(tmp_path / "out"), log)

    drain(frame)
    due = spark.read.format("statestore").option("path", log).option("stateVarName", "due").load()
    assert 0 < due.count() <= ordered.BUCKETS < 3_000
    out = sinks.before_closing(drain(sinks.closing_row(spark, frame.schema, "batch_ts")), "batch_ts")
    assert rows(out) == rows(compare.delta_by_row(frame, ["key"], ["n"]))


class HeldInMemory:
    """What the processors ask of a state handle, and how many held rows are out at once."""

    def __init__(self):
        self.maps, self.lists, self.values, self.out, self.most = {}, {}, {}, 0, 0

    def getMapState(self, name, key, value):
        return _Map(self, self.maps.setdefault(name, {}))

    def getListState(self, name, schema):
        return _List(self.lists.setdefault(name, []))

    def getValueState(self, name, schema):
        return _Value(self.values.setdefault(name, []))

    def registerTimer(self, at_ms):
        pass

    deleteTimer = registerTimer


class _Map:
    def __init__(self, owner, data):
        self.owner, self.data = owner, data

    def updateValue(self, key, value):
        self.data[key] = value

    def getValue(self, key):
        self.owner.out += len(ordered.unpacked(self.data[key][0]))
        self.owner.most = max(self.owner.most, self.owner.out)
        return self.data[key]

    def removeKey(self, key):
        del self.data[key]


class _List:
    def __init__(self, data):
        self.data = data
        self.get = lambda: iter(list(data))
        self.appendList, self.clear = data.extend, data.clear

    def put(self, rows):
        self.data[:] = rows


class _Value:
    def __init__(self, data):
        self.exists, self.get, self.clear = (lambda: bool(data)), (lambda: data[0]), data.clear
        self.update = lambda value: data.__setitem__(slice(None), [value])


def test_rows_of_a_hot_key_are_not_all_in_memory():
    """100,000 rows of one key land in mixed order; taken in order, few blocks are open at a time."""
    from pyspark.sql import Row
    from pyspark.sql import types as T

    schema = T.StructType().add("key", T.StringType()).add("n", T.LongType()).add(ordered.AT, T.LongType())
    held = HeldInMemory()
    processor = ordered.InTimeOrder(schema, ["key"], ["n"], ["key"])
    processor.init(held)
    made = Row("key", "n", ordered.AT)
    count = 100_000
    mixed = random.Random(6).sample(range(count), count)
    for part in (mixed[:60_000], mixed[60_000:]):
        list(processor.handleInputRows(None, (made("hot", None if n % 9 == 0 else n, n // 3 * 1000) for n in part), None))
    taken = []
    for final_us in (30_000_000, 31_000_000, count * 1000):
        for row in processor.take_ready(final_us):
            held.out -= 1
            taken.append(row)
        assert taken[-1][2] <= final_us
        held.out = 0
    assert [r[2] for r in taken] == [n // 3 * 1000 for n in range(count)]
    assert [r[1] for r in taken if r[1]] == [n for n in range(count) if n % 9]
    assert held.most <= 20 * ordered.BLOCK_ROWS < count
    assert not held.lists["blocks"] and not held.maps["held"]


def log_rows(count, seed=4):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        at = START + timedelta(minutes=rng.randrange(count) if n % 4 else n)
        level = rng.choice(["INFO", "INFO", "ERROR", "FATAL", None])
        rows.append((rng.choice("xy"), at, n, level, None if n % 17 == 0 else f"line {n}"))
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("before,after,polls", [(2, 3, 5), (4, 0, 2)])
def test_context_does_not_end_at_a_trigger(spark, rows, before, after, polls):
    made = log_rows(90)
    size = 90 // polls
    batch = logs.with_context(spark.createDataFrame(made, LINES), before, after)
    out = one_by_one(
        spark, [made[n : n + size] for n in range(0, 90, size)], LINES,
        lambda s: context.context_stream(
            s, before, after, sort_by=("line_no",), delay="10 minutes", patience=timedelta(days=36500)
        ),
        "log_date",
    )
    assert rows(out) == rows(logs.errors_only(batch))


@pytest.mark.parametrize("polls", [1, 4])
def test_patience_gives_the_same_whatever_the_triggers(spark, rows, polls):
    """Lines more than the patience after an error are not waited for."""
    made = [r for r in log_rows(120) if r[1].minute % 20 < 8]
    patience, after = timedelta(minutes=5), 3
    size = -(-len(made) // polls)
    out = one_by_one(
        spark, [made[n : n + size] for n in range(0, len(made), size)], LINES,
        lambda s: context.context_stream(s, 1, after, sort_by=("line_no",), delay="1 minute", patience=patience),
        "log_date",
    )
    expected = []
    for server in "xy":
        own = sorted((r for r in made if r[0] == server), key=lambda r: (r[1], r[2]))
        for k, r in enumerate(own):
            if r[3] in logs.ERROR_LEVELS:
                behind = [x for x in own[k + 1 : k + 1 + after] if x[1] <= r[1] + patience]
                shown = [*own[max(0, k - 1) : k + 1], *behind]
                expected.append((r[2], "\n".join(x[4] for x in shown if x[4] is not None)))
    assert rows(out, "line_no", "contextbuffertext") == sorted(expected, key=repr)


def test_raw_context_shows_lines_that_are_no_entries(spark, tmp_path):
    from flowaudit.sources.landed import read_logs

    entry = "2024-01-01 00:00:0{}.000000 @n -{} app : m{}"
    first = [entry.format(1, "INFO", 1), entry.format(2, "ERROR", 2), "  at f(x)", "  at g(y)"]
    second = ["  at h(z)", entry.format(3, "INFO", 3), *["dump"] * 500]
    for n, lines in enumerate((first, second)):
        folder = tmp_path / "logs" / "host=h1"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"server-{n}.log").write_text("\n".join(lines) + "\n")
    lines = read_logs(spark, str(tmp_path / "logs"))
    for split in (None, 50):
        found = logs.parse_with_raw_context(
            lines, 1, 4, keys=("host",), order=("file_path", "block_start", "row_no"), split_rows=split
        )
        texts = {r.message: r.contextbuffertext.split("\n") for r in found.collect()}
        assert texts["m2"] == [*first, *second[:2]] and texts["m3"] == ["  at h(z)", second[1], *["dump"] * 4]
        assert len(texts) == 3
