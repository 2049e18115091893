"""Monitoring inputs read from the tables at hand.

The tables are not monitoring data, so each input says what stands for what. Every event is a
change to table ``T<user>`` of app ``app<user mod 10>``; a run is a day (or an hour). A change with
a value of 150 or more is missing at the source and one below 3 is missing at the target, so that
both sides have gaps. The lag of a record is its value in thousandths.

Reads are plain Parquet scans; column pruning keeps only what a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.operators.compare import OP_CODES
from flowaudit.operators.stamping import bucket_start
from flowaudit.schemas import OP_KINDS

DAY_S = 86_400
HOUR_S = 3_600

# Event type -> operation code.
EVENT_OPS = {
    "signup": "INSERT",
    "purchase": "UPDATE",
    "click": "PKUPDATE",
    "error": "DELETE",
    "view": "DDL",
}
SOURCE_BELOW = 150.0
TARGET_FROM = 3.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(column: Column, values: dict[str, str]) -> Column:
    chosen: Column | None = None
    for key, value in values.items():
        chosen = (F.when if chosen is None else chosen.when)(column == key, F.lit(value))
    assert chosen is not None
    return chosen


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def from_events(raw: DataFrame) -> DataFrame:
    """Event rows (batch or stream) with the derived monitoring columns."""
    ts = F.col("ts").cast("timestamp")
    return raw.select(
        "event_id",
        ts.alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.concat(F.lit("app"), F.col("user_id") % 10).alias("app_name"),
        F.concat(F.lit("T"), F.col("user_id")).alias("table_name"),
        pick(F.col("event_type"), EVENT_OPS).alias("op"),
        F.round(F.col("value") * 1000).cast("bigint").alias("lag_ms"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        bucket_start(ts, DAY_S).alias("day_ts"),
        bucket_start(ts, HOUR_S).alias("hour_ts"),
    )


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         'app' || (user_id % 10) AS app_name, 'T' || user_id AS table_name,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE'
              WHEN 'click' THEN 'PKUPDATE' WHEN 'error' THEN 'DELETE' WHEN 'view' THEN 'DDL' END AS op,
         CAST(round(value * 1000) AS BIGINT) AS lag_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         date_trunc('day', ts) AS day_ts, date_trunc('hour', ts) AS hour_ts
  FROM events)"""


def both_sides(ev: DataFrame) -> DataFrame:
    """One row per side that saw the change; a single scan feeds both sides."""
    sides = F.filter(
        F.array(
            F.when(F.col("value") < SOURCE_BELOW, F.lit("src")),
            F.when(F.col("value") >= TARGET_FROM, F.lit("tgt")),
        ),
        lambda s: s.isNotNull(),
    )
    return ev.withColumn("side", F.explode(sides))


def source_changes(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("value") < SOURCE_BELOW)


def target_changes(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("value") >= TARGET_FROM)


SIDES_SQL = """sides AS (
  SELECT *, 'src' AS side FROM ev WHERE value < 150
  UNION ALL SELECT *, 'tgt' AS side FROM ev WHERE value >= 3)"""

COUNTERS_SQL = (
    "counters AS (\n  SELECT app_name, table_name, day_ts AS batch_ts,\n"
    + ",\n".join(
        f"    CAST(sum(CASE WHEN side = '{s}' THEN CASE WHEN op = '{OP_CODES[k]}' THEN 1 ELSE 0 END"
        f" END) AS BIGINT) AS {s}_num_of_{k}"
        for k in OP_KINDS
        for s in ("src", "tgt")
    )
    + "\n  FROM sides GROUP BY 1, 2, 3)"
)
TOTALS_SQL = (
    "totals AS (\n  SELECT app_name, table_name, batch_ts,\n"
    + ",\n".join(
        f"    CAST(sum({s}_num_of_{k}) OVER w AS BIGINT) AS {s}_num_of_{k}"
        for k in OP_KINDS
        for s in ("src", "tgt")
    )
    + "\n  FROM counters WINDOW w AS (PARTITION BY app_name, table_name ORDER BY batch_ts"
    + "\n    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
)


def day_runs(ev: DataFrame) -> DataFrame:
    """Run history with one run per day that saw an event."""
    return ev.groupBy(F.col("day_ts").alias("batch_ts")).agg(F.max("ts").alias("runtime_end"))


def hour_runs(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.col("hour_ts").alias("batch_ts")).agg(F.max("ts").alias("runtime_end"))


def ms(column: str | Column) -> Column:
    """Instant as epoch milliseconds, the form in which results are compared."""
    return F.unix_millis(F.col(column) if isinstance(column, str) else column)


def us(column: str | Column) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def log_lines(ev: DataFrame) -> DataFrame:
    """Server log text: cheap views are garbled, errors and deletes have the error level."""
    level = F.when(F.col("event_type") == "error", "ERROR").when(
        F.col("event_type") == "click", "WARN"
    ).otherwise("INFO")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit(" @"), F.col("table_name"), F.lit(" -"), level, F.lit(" "), F.col("app_name"),
        F.lit(" : took "), F.col("lag_ms"), F.lit(" ms"),
    )
    garbled = F.concat(F.lit("~~ "), F.col("event_id"))
    bad = (F.col("event_type") == "view") & (F.col("value") < 5)
    return ev.select(
        F.col("event_id").alias("line_no"), F.when(bad, garbled).otherwise(line).alias("value")
    )


LINES_SQL = """lines AS (
  SELECT event_id AS line_no, ts, table_name AS server, app_name,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END AS log_level,
         'took ' || lag_ms || ' ms' AS message,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || ' @' || table_name || ' -'
           || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END
           || ' ' || app_name || ' : took ' || lag_ms || ' ms' AS value
  FROM ev WHERE NOT (event_type = 'view' AND value < 5))"""


def load_batches(ev: DataFrame) -> DataFrame:
    """Every event is a finished load batch of its table's target."""
    state = (
        F.when((F.col("event_type") == "view") & (F.col("k") < 50), "pruned")
        .when(F.col("event_type") == "view", "merged")
        .when(F.col("event_type") == "signup", "created")
        .when(F.col("event_type") == "purchase", "queued")
        .when(F.col("event_type") == "click", "uploaded")
        .when(F.col("event_type") == "error", "ignored")
    )
    k = F.col("k")
    return ev.select(
        "app_name",
        F.col("table_name").alias("target_name"),
        F.col("event_id").alias("sequence_number"),
        F.col("ts").alias("done_ts"),
        state.alias("state"),
        k.alias("event_count"),
        F.col("lag_ms").alias("size_bytes"),
        k.alias("compaction_time_ms"),
        (k * 2).alias("stage_resources_mgmt_time_ms"),
        (k * 3).alias("upload_time_ms"),
        (k + 5).alias("merge_time_ms"),
        (k % 7).alias("in_mem_compaction_time_ms"),
        (k % 5).alias("pk_update_time_ms"),
        (k % 3).alias("ddl_execution_time_ms"),
        (k + 11).alias("waiting_time_in_queue_ms"),
        (F.col("lag_ms") + k * 7).alias("total_integration_time_ms"),
    )


BATCHES_SQL = """batches AS (
  SELECT app_name, table_name AS target_name, event_id AS sequence_number, ts AS done_ts,
         CASE WHEN event_type = 'view' AND k < 50 THEN 'pruned' WHEN event_type = 'view' THEN 'merged'
              WHEN event_type = 'signup' THEN 'created' WHEN event_type = 'purchase' THEN 'queued'
              WHEN event_type = 'click' THEN 'uploaded' WHEN event_type = 'error' THEN 'ignored' END AS state,
         k AS event_count, lag_ms AS size_bytes, k AS compaction_time_ms,
         k * 2 AS stage_resources_mgmt_time_ms, k * 3 AS upload_time_ms, k + 5 AS merge_time_ms,
         k % 7 AS in_mem_compaction_time_ms, k % 5 AS pk_update_time_ms, k % 3 AS ddl_execution_time_ms,
         k + 11 AS waiting_time_in_queue_ms, lag_ms + k * 7 AS total_integration_time_ms
  FROM ev)"""
