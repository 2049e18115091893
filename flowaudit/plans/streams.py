"""Streaming queries, and round trips through landed files.

Each drains a stream over what has landed (the tables, or files Spark derives from them) into a new
folder below ``spark.checkpoint.dir`` and returns the result, to be equal to the batch form.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators import compare as compare_ops
from flowaudit.operators import logs as log_ops
from flowaudit.operators import payloads as payload_ops
from flowaudit.operators.runs import link_runs
from flowaudit.plans import compare
from flowaudit.plans import logs as log_plans
from flowaudit.plans import inputs as i
from flowaudit.plans import payloads
from flowaudit.plans.registry import query
from flowaudit.schemas import OP_KINDS, TABLE_COUNTERS, counter_columns
from flowaudit.session import cut, fresh_path
from flowaudit.sources import landed, tables
from flowaudit.sources.conform import shape
from flowaudit.streaming import context, late, logs, ordered, sinks, windows

# Files of a bounded feed land in any order, each with rows of the whole time. A century covers any such time
# and still ends, counted back from the closing row, after all real rows.
ANY_ORDER = "36500 days"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = i.table(spark, sf_dir, "events").schema
    # The pattern lets one file or a folder of files stand for the table.
    raw = sinks.read_landed(spark, f"{sf_dir}/events.parque[t]", schema)
    return i.from_events(raw)


def land(df: DataFrame, label: str) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def landed_stream(df: DataFrame, label: str) -> DataFrame:
    """Write rows to files and read them back as a stream."""
    return sinks.read_landed(df.sparkSession, land(df, label), df.schema)


@query("stream_delta_by_row", compare.EXPECTED_DELTA_BY_ROW)
def stream_delta_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = compare.totals(i.events(spark, sf_dir))
    feed, close = sinks.closable(landed_stream(totals, "totals"), "batch_ts")
    delta = ordered.delta_by_row_stream(feed, compare.KEYS, compare.PAIR_COLS, delay=ANY_ORDER)
    out = sinks.before_closing(sinks.drain_closed(delta, close, "delta-by-row"), "batch_ts")
    return out.select(
        *compare.KEYS, i.ms("batch_ts").alias("batch_ms"),
        *[f"{c}_sli" for c in compare.PAIR_COLS],
    )


@query("stream_delta_by_run", compare.EXPECTED_SIDE_DELTAS)
def stream_delta_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir)
    linked = link_runs(i.day_runs(ev)).select("batch_ts", "previous_ts")
    counters = compare.totals(ev).join(linked, "batch_ts")
    feed, close = sinks.closable(landed_stream(counters, "linked-totals"), "batch_ts")
    delta = ordered.delta_by_run_stream(feed, compare.KEYS, compare.PAIR_COLS, delay=ANY_ORDER)
    out = sinks.before_closing(sinks.drain_closed(delta, close, "delta-by-run"), "batch_ts")
    return out.select(
        *compare.KEYS, i.ms("batch_ts").alias("batch_ms"),
        *counter_columns(("src", "tgt"), "_sli"),
    )


_POLLS_SQL = """polls AS (
  SELECT table_name AS type_name, hour_ts AS batch_ts, arg_max(k // 25, (ts, event_id)) AS band
  FROM ev GROUP BY 1, 2)"""


@query(
    "stream_emit_on_change",
    f"""WITH {i.EV}, {_POLLS_SQL}, v AS (SELECT *, lag(band) OVER (PARTITION BY type_name ORDER BY batch_ts) AS before
  FROM polls)
SELECT type_name, epoch_ms(batch_ts) AS batch_ms, band FROM v WHERE before IS DISTINCT FROM band""",
)
def stream_emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour polls each type once; the version is the band seen last in the hour."""
    polls = (
        i.events(spark, sf_dir)
        .groupBy(F.col("table_name").alias("type_name"), F.col("hour_ts").alias("batch_ts"))
        .agg(F.max_by("k", F.struct("ts", "event_id")).alias("k"))
        .select("type_name", "batch_ts", F.floor(F.col("k") / 25).cast("bigint").alias("band"))
    )
    feed, close = sinks.closable(landed_stream(polls, "polls"), "batch_ts")
    fresh = ordered.emit_on_change_stream(feed, ("type_name",), "band", delay=ANY_ORDER)
    out = sinks.before_closing(sinks.drain_closed(fresh, close, "changes"), "batch_ts")
    return out.select("type_name", i.ms("batch_ts").alias("batch_ms"), "band")


@query(
    "stream_time_batches",
    f"""WITH {i.EV} SELECT app_name, epoch_ms(hour_ts) AS batch_ms, count(*) AS row_count
FROM ev GROUP BY 1, 2""",
)
def stream_time_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, close = sinks.closable(event_stream(spark, sf_dir).select("app_name", "ts"), "ts")
    counts = windows.time_batches_stream(feed, ["app_name"], "ts", "1 hour", ANY_ORDER)
    out = sinks.before_closing(sinks.drain_closed(counts, close, "time-batches"), "batch_ts")
    return out.select("app_name", i.ms("batch_ts").alias("batch_ms"), "row_count")


@query("stream_drop_replays", "SELECT event_id, user_id, epoch_us(ts) AS ts_us FROM events")
def stream_drop_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of value 50 and more arrive twice."""
    twice = F.explode(F.when(F.col("value") >= 50, F.array(F.lit(1), F.lit(2)))
                      .otherwise(F.array(F.lit(1))))
    feed = event_stream(spark, sf_dir).select("event_id", "user_id", "ts", twice.alias("arrival"))
    once = windows.first_arrivals(
        feed.drop("arrival"), ["event_id"], "ts", "1 hour",
        fresh_path(spark, "arrivals"), fresh_path(spark, "arrivals-log"),
    )
    out = sinks.drain(once, "once")
    return out.select("event_id", "user_id", i.us("ts").alias("ts_us"))


@query("stream_reconcile", compare.EXPECTED_ONE_FEED)
def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = i.both_sides(event_stream(spark, sf_dir)).select(*compare.KEYS, "ts", "side", "op")
    feed, close = sinks.closable(changes, "ts")
    paired = windows.reconcile_stream(feed, compare.KEYS, "ts", "1 day", ANY_ORDER)
    out = sinks.before_closing(sinks.drain_closed(paired, close, "reconciled"), "batch_ts")
    return out.select(*compare.KEYS, i.ms("batch_ts").alias("batch_ms"), *counter_columns())


@query("stream_reconcile_each_batch", compare.EXPECTED_ONE_FEED)
def stream_reconcile_each_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = i.both_sides(event_stream(spark, sf_dir)).withColumnRenamed("day_ts", "batch_ts")
    totals = windows.reconcile_each_batch(
        changes, [*compare.KEYS, "batch_ts"],
        fresh_path(spark, "partial-counts"), fresh_path(spark, "partial-log"),
    )
    return totals.select(*compare.KEYS, i.ms("batch_ts").alias("batch_ms"), *counter_columns())


def _polls_any_order(df: DataFrame, key: str, parts: int = 4) -> list[DataFrame]:
    """The rows in polls that each reach over the whole time."""
    return [df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == n) for n in range(parts)]


def _parted(polls: list[DataFrame], ts: str, label: str, ends=None) -> tuple[str, T.StructType]:
    """Land the polls one by one and part each from its late rows at a delay of an hour."""
    spark = polls[0].sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in polls[0].schema])
    feed, path, log = (fresh_path(spark, f"{label}-{part}") for part in ("feed", "parted", "parted-log"))
    for rows in polls:
        rows.write.mode("append").parquet(feed)
        late.part_late(sinks.read_landed(spark, feed, schema), path, log, ts, timedelta(hours=1), ends)
    return path, schema


@query(
    "stream_time_batches_late",
    f"""WITH {i.EV} SELECT app_name, epoch_ms(hour_ts) AS batch_ms, count(*) AS row_count
FROM ev GROUP BY 1, 2""",
)
def stream_time_batches_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls in any order, a delay of an hour, and the late rows from their ledger."""
    rows = i.events(spark, sf_dir).select("app_name", "ts", "event_id")
    path, schema = _parted(
        _polls_any_order(rows, "event_id"), "ts", "time-batches", F.window("ts", "1 hour")["end"]
    )
    feed, close = sinks.closable(late.in_time(spark, path, schema), "ts")
    counts = windows.time_batches_stream(feed, ["app_name"], "ts", "1 hour", "1 hour")
    out = sinks.before_closing(sinks.drain_closed(counts, close, "time-batches-late"), "batch_ts")
    whole = late.corrected_time_batches(out, late.ledger(spark, path, schema), ["app_name"], "ts", "1 hour")
    return whole.select("app_name", i.ms("batch_ts").alias("batch_ms"), "row_count")


@query("stream_reconcile_late", compare.EXPECTED_ONE_FEED)
def stream_reconcile_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_reconcile`` with polls in any order and a delay of an hour."""
    changes = i.both_sides(i.events(spark, sf_dir)).select(*compare.KEYS, "ts", "side", "op")
    polls = _polls_any_order(changes, "ts")
    path, schema = _parted(polls, "ts", "reconcile", F.window("ts", "1 day")["end"])
    feed, close = sinks.closable(late.in_time(spark, path, schema), "ts")
    paired = windows.reconcile_stream(feed, compare.KEYS, "ts", "1 day", "1 hour")
    out = sinks.before_closing(sinks.drain_closed(paired, close, "reconciled-late"), "batch_ts")
    whole = late.corrected_reconcile(out, late.ledger(spark, path, schema), compare.KEYS, "ts", "1 day")
    return whole.select(*compare.KEYS, i.ms("batch_ts").alias("batch_ms"), *counter_columns())


@query("stream_delta_by_row_late", compare.EXPECTED_DELTA_BY_ROW)
def stream_delta_by_row_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_delta_by_row`` with polls in any order and a delay of an hour."""
    totals = cut(compare.totals(i.events(spark, sf_dir)), "totals")
    path, schema = _parted(_polls_any_order(totals, "batch_ts"), "batch_ts", "deltas")
    feed, close = sinks.closable(late.in_time(spark, path, schema), "batch_ts")
    delta = ordered.delta_by_row_stream(feed, compare.KEYS, compare.PAIR_COLS, delay="1 hour")
    out = sinks.before_closing(sinks.drain_closed(delta, close, "deltas-late"), "batch_ts")
    whole = late.corrected_deltas(
        out, late.ledger(spark, path, schema), compare.KEYS, compare.PAIR_COLS
    )
    return whole.select(
        *compare.KEYS, i.ms("batch_ts").alias("batch_ms"),
        *[f"{c}_sli" for c in compare.PAIR_COLS],
    )


@query("stream_delta_from_history", compare.EXPECTED_DELTA_BY_ROW)
def stream_delta_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the time as stored batch result, the second as a stream that goes on from it."""
    totals = cut(compare.totals(i.events(spark, sf_dir)), "totals")
    at = F.unix_micros("batch_ts")
    middle = totals.agg(F.expr("(min(unix_micros(batch_ts)) + max(unix_micros(batch_ts))) div 2")).first()[0]
    stored = totals.where(at <= middle)
    done = compare_ops.delta_by_row(stored, compare.KEYS, compare.PAIR_COLS)
    feed, close = sinks.closable(landed_stream(totals.where(at > middle), "totals-after"), "batch_ts")
    delta = ordered.delta_by_row_stream(feed, compare.KEYS, compare.PAIR_COLS, delay=ANY_ORDER, history=stored)
    after = sinks.before_closing(sinks.drain_closed(delta, close, "deltas-after"), "batch_ts")
    return done.unionByName(after.select(*done.columns)).select(
        *compare.KEYS, i.ms("batch_ts").alias("batch_ms"),
        *[f"{c}_sli" for c in compare.PAIR_COLS],
    )


def _landed_lines(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "server-logs")
    i.log_lines(i.events(spark, sf_dir)).select("value").write.text(path)
    return path


_ENTRIES_SQL = "SELECT epoch_us(ts) AS log_us, server, app_name, log_level, message FROM lines"


@query("stream_watch_errors", f"WITH {i.EV}, {i.LINES_SQL} {_ENTRIES_SQL} WHERE log_level = 'ERROR'")
def stream_watch_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landed.stream_logs(spark, _landed_lines(spark, sf_dir))
    errors = sinks.drain(logs.watch_errors(lines), "errors")
    return errors.select(
        i.us("log_date").alias("log_us"), "server", "app_name", "log_level", "message"
    )


@query("stream_log_context", log_plans.ERROR_CONTEXT_SQL)
def stream_log_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the same app around each error, the lines landing in four polls a long time apart."""
    lines = i.log_lines(i.events(spark, sf_dir))
    entries = cut(log_ops.parse_logs(lines), "log-entries")
    at = F.unix_micros("log_date")
    ends = entries.select(at.alias("at")).approxQuantile("at", [0.25, 0.5, 0.75], 0.01)
    poll = sum([(at > end).cast("int") for end in ends], F.lit(0))
    polls = [entries.where(poll == n) for n in range(len(ends) + 1)]
    around = sinks.drain_polls(
        polls,
        lambda feed: context.context_stream(
            feed, 3, 3, ("app_name",), sort_by=("line_no",), delay="1 hour", patience=timedelta(days=36500)
        ),
        "log_date",
        "log-context",
    )
    out = sinks.before_closing(around, "log_date")
    return out.select("line_no", "app_name", "contextbuffertext")


_RAW_CONTEXT_SQL = """, raw AS (
  SELECT event_id AS line_no, ts, app_name, event_type,
         CASE WHEN event_type = 'view' AND ev.value < 5 THEN '~~ ' || event_id ELSE l.line END AS line
  FROM ev LEFT JOIN (SELECT line_no AS event_id, value AS line FROM lines) l USING (event_id)),
c AS (SELECT *, string_agg(line, chr(10)) OVER (PARTITION BY app_name ORDER BY ts, line_no
  ROWS BETWEEN 2 PRECEDING AND 5 FOLLOWING) AS contextbuffertext FROM raw)
SELECT epoch_us(ts) AS log_us, app_name, contextbuffertext FROM c WHERE event_type = 'error'"""


@query("error_raw_context", f"WITH {i.EV}, {i.LINES_SQL}{_RAW_CONTEXT_SQL}")
def error_raw_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as they stand in each app's rotated files around each error, garbled ones included."""
    ev = i.events(spark, sf_dir)
    placed = i.log_lines(ev).join(ev.select(F.col("event_id").alias("line_no"), "ts", "app_name"), "line_no")
    path = fresh_path(spark, "app-logs")
    # Names of files rise with the partition, so an app's files follow each other in time.
    spread = placed.repartitionByRange("app_name", "ts", "line_no")
    in_order = spread.sortWithinPartitions("app_name", "ts", "line_no")
    in_order.select("app_name", "value").write.partitionBy("app_name").text(path)
    lines = landed.read_logs(spark, path).withColumnRenamed("app_name", "app")
    parsed = log_ops.parse_with_raw_context(
        lines, before=2, after=5, keys=("app",), order=("file_path", "block_start", "row_no")
    )
    return log_ops.errors_only(parsed).select(
        i.us("log_date").alias("log_us"), "app_name", "contextbuffertext"
    )


@query("read_logs", f"WITH {i.EV}, {i.LINES_SQL} {_ENTRIES_SQL}")
def read_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = log_ops.parse_logs(landed.read_logs(spark, _landed_lines(spark, sf_dir)))
    return entries.select(
        i.us("log_date").alias("log_us"), "server", "app_name", "log_level", "message"
    )


@query(
    "read_payloads",
    f"""WITH {i.EV} SELECT 'band' AS property, CAST(k // 25 AS VARCHAR) AS value, count(*) AS row_count
FROM ev WHERE event_type <> 'click' GROUP BY 2
UNION ALL SELECT 'kind', event_type, count(*) FROM ev WHERE event_type <> 'click' GROUP BY 2""",
)
def read_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "responses")
    payloads.captured(i.events(spark, sf_dir)).select("jsondata").write.text(path)
    good = landed.read_payloads(spark, path).where("is_json").select("jsondata")
    props = payload_ops.properties(good)
    return props.groupBy("property", "value").agg(F.count(F.lit(1)).alias("row_count"))


_COUNTER_SUMS = ", ".join(
    f"CAST(sum(coalesce(src_num_of_{k}, 0)) AS BIGINT) AS src_{k}" for k in OP_KINDS
)


@query(
    "append_snapshots",
    f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}
SELECT CAST(batch_ts AS DATE)::VARCHAR AS batch_date, count(*) AS row_count, {_COUNTER_SUMS}
FROM counters GROUP BY 1""",
)
def append_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append two polls to a table on storage, compact it, and report what it holds per day."""
    paired = compare_ops.diff_counts(compare.counters(i.events(spark, sf_dir))).withColumns({
        "source_name": F.col("table_name"), "target_name": F.col("table_name"),
    })
    snapshot = shape(paired, TABLE_COUNTERS)
    path, packed = fresh_path(spark, "table-counters"), fresh_path(spark, "table-counters-packed")
    behind = F.col("diff_num_of_inserts") > 0
    tables.append_files(snapshot.where(behind), path)
    tables.append_files(snapshot.where(~F.coalesce(behind, F.lit(False))), path)
    tables.compact_days(spark, path, packed)
    stored = tables.read_files(spark, packed, TABLE_COUNTERS)
    return stored.groupBy(F.col("batch_date").cast("string").alias("batch_date")).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.coalesce(F.sum(f"src_num_of_{k}"), F.lit(0)).alias(f"src_{k}") for k in OP_KINDS],
    )


@query(
    "append_runs",
    f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}
SELECT CAST(batch_ts AS DATE)::VARCHAR AS batch_date, epoch_ms(batch_ts) AS batch_ms, count(*) AS row_count, {_COUNTER_SUMS}
FROM counters GROUP BY 1, 2""",
)
def append_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls stored twice, first with wrong readings, one of them after its day was packed."""
    paired = compare_ops.diff_counts(compare.counters(i.events(spark, sf_dir))).withColumns({
        "source_name": F.col("table_name"), "target_name": F.col("table_name"),
    })
    snapshot = cut(shape(paired, TABLE_COUNTERS), "counter-runs")
    path = fresh_path(spark, "table-counter-runs")
    wrong = snapshot.withColumn("src_num_of_inserts", F.lit(-1).cast("bigint"))
    tables.append_runs(wrong, path)
    even = F.hour("batch_ts") % 2 == 0
    tables.append_runs(snapshot.where(even), path)
    days = snapshot.agg(F.min("batch_ts"), F.max("batch_ts")).first()
    if days[0] is not None:
        tables.compact_runs(spark, path, days[0].date(), days[0].date() + (days[1] - days[0]) / 2)
    tables.append_runs(snapshot.where(~even), path)
    stored = tables.read_runs(spark, path)
    return stored.groupBy(
        F.col("batch_date").cast("string").alias("batch_date"), i.ms("batch_ts").alias("batch_ms")
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.coalesce(F.sum(f"src_num_of_{k}"), F.lit(0)).alias(f"src_{k}") for k in OP_KINDS],
    )
