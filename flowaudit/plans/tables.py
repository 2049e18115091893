"""The twelve monitoring tables, filled from the inputs at hand.

Each query builds one whole table in its declared schema and reports it in a comparable form:
surrogate id left out, times as epoch milliseconds, decimals as doubles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit import schemas as s
from flowaudit.operators import batches as batch_ops
from flowaudit.operators import compare as compare_ops
from flowaudit.operators import lag as lag_ops
from flowaudit.operators import logs as log_ops
from flowaudit.operators import payloads as payload_ops
from flowaudit.operators import runs, snapshots, stamping
from flowaudit.plans import batches, compare, history, lag, logs, payloads
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import EXPECTED_SQL, query
from flowaudit.session import fresh_path
from flowaudit.sources.conform import shape
from flowaudit.sources.tables import append_snapshot, catalog_columns, recreate

FIRST_POLL_S = 1_704_067_200  # 2024-01-01
ORIGIN = {"cluster_name": "north", "company_name": "example"}


def comparable(df: DataFrame, table: s.Table) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = F.unix_millis(value)
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        return value.alias(field.name)

    return df.select(*[plain(f) for f in table.schema if f.name != table.row_id])


def _ms_sql(expression: str) -> str:
    return f"epoch_us({expression}) // 1000"


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = runs.run_duration(i.hour_runs(i.events(spark, sf_dir)))
    history_rows = stamping.stamp_origin(timed, ORIGIN)
    default = F.lit(history.FIRST_START.isoformat(sep=" "))
    planned = runs.next_run(runs.previous_run(history_rows, default), history.REPEAT_S)
    return shape(planned, s.RUN_HISTORY)


@query(
    "table_run_history",
    f"""WITH {i.EV}, r AS (SELECT hour_ts, max(ts) AS e FROM ev GROUP BY 1)
SELECT epoch_ms(hour_ts) AS batch_ts, {_ms_sql('e')} AS runtime_end,
  CAST((epoch_us(e) - epoch_us(hour_ts)) // 1000 AS DOUBLE) AS runtime_duration_ms,
  'north' AS cluster_name, 'example' AS company_name,
  epoch_ms(coalesce(lag(hour_ts) OVER (ORDER BY hour_ts), TIMESTAMP '2023-12-31')) AS lastrun,
  epoch_ms(hour_ts + INTERVAL {history.REPEAT_S} SECONDS) AS nextrun FROM r""",
)
def table_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(run_history(spark, sf_dir), s.RUN_HISTORY)


def app_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir)
    raw = (
        ev.groupBy(F.col("hour_ts").alias("batch_ts"), F.col("app_name").alias("appname"))
        .agg(
            F.count(F.lit(1)).alias("rate"),
            F.count_if(F.col("value") < i.SOURCE_BELOW).alias("sourcerate"),
            F.max("value").cast("string").alias("cpurate"),
            F.max(F.when(F.col("k") >= 50, 1).otherwise(0)).alias("numservers"),
            F.when(F.bool_or(F.col("event_type") == "error"), "HALTED")
            .otherwise("RUNNING").alias("status"),
            F.max("ts").alias("latest_activity"),
        )
        .withColumns({
            "command": F.concat(F.lit("mon "), "appname"), "montype": F.lit("app"),
        })
    )
    return snapshots.app_snapshot(raw)


@query(
    "table_app_snapshot",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ts, 'mon ' || app_name AS command, 'app' AS montype,
  app_name AS appname, CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'HALTED' ELSE 'RUNNING' END AS status,
  CAST(count(*) AS DOUBLE) AS rate, CAST(count(*) FILTER (value < 150) AS DOUBLE) AS sourcerate,
  max(value) AS cpurate, CAST(CASE WHEN max(k) >= 50 THEN 1 ELSE 0 END AS BIGINT) AS numservers,
  {_ms_sql('max(ts)')} AS latest_activity FROM ev GROUP BY hour_ts, app_name""",
)
def table_app_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(app_snapshot(spark, sf_dir), s.APP_SNAPSHOT)


def node_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        i.events(spark, sf_dir)
        .groupBy(F.col("hour_ts").alias("batch_ts"), F.col("table_name").alias("nodename"))
        .agg(F.max("k").alias("k"), F.max("value").alias("cpurate"))
        .withColumns({
            "command": F.lit("mon"), "montype": F.lit("node"), "product_version": F.lit("1.0"),
            "freemem": F.concat("k", F.lit(" MB")), "uptime": F.concat("k", F.lit(" days")),
        })
    )
    return snapshots.node_snapshot(raw)


@query(
    "table_node_snapshot",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ts, 'mon' AS command, 'node' AS montype,
  table_name AS nodename, '1.0' AS product_version, max(k) || ' MB' AS freemem, max(value) AS cpurate,
  max(k) || ' days' AS uptime FROM ev GROUP BY hour_ts, table_name""",
)
def table_node_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(node_snapshot(spark, sf_dir), s.NODE_SNAPSHOT)


def search_store_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = "elasticsearch_"
    raw = (
        i.events(spark, sf_dir)
        .groupBy(F.col("hour_ts").alias("batch_ts"))
        .agg(
            F.sum("lag_ms").alias(f"{prefix}receive_throughput"),
            F.sum("k").alias(f"{prefix}transmit_throughput"),
            F.min("lag_ms").alias(f"{prefix}cluster_storage_free"),
            F.max("lag_ms").alias(f"{prefix}cluster_storage_total"),
        )
        .withColumns({"command": F.lit("mon"), "montype": F.lit("store")})
    )
    return snapshots.search_store_snapshot(raw)


@query(
    "table_search_store_snapshot",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ts, 'mon' AS command, 'store' AS montype,
  CAST(sum(lag_ms) AS BIGINT) AS elasticsearch_receive_throughput,
  CAST(sum(k) AS BIGINT) AS elasticsearch_transmit_throughput,
  min(lag_ms) AS elasticsearch_cluster_storage_free, max(lag_ms) AS elasticsearch_cluster_storage_total
FROM ev GROUP BY hour_ts""",
)
def table_search_store_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(search_store_snapshot(spark, sf_dir), s.SEARCH_STORE_SNAPSHOT)


def app_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail per table and day; the describe detail is known for tables that are customers."""
    ev = i.events(spark, sf_dir)
    totals = ev.groupBy(
        F.col("table_name").alias("app_name"), F.col("day_ts").alias("batch_ts")
    ).agg(
        F.count_if(F.col("value") < i.SOURCE_BELOW).alias("total_input"),
        F.count_if(F.col("value") >= i.TARGET_FROM).alias("total_output"),
        F.max("ts").alias("latest_activity"),
        F.max(F.col("value") > 100).alias("is_backpressured"),
        F.min(F.col("k") < 50).alias("is_recovery_enabled"),
        F.max("k").alias("k"),
    )
    status = (
        F.when(F.col("k") < 20, "CREATED").when(F.col("k") < 40, "DEPLOYED").otherwise("RUNNING")
    )
    shown = snapshots.app_detail(totals.withColumn("app_status", status))
    idle = snapshots.idle_seconds(shown, F.col("batch_ts") + F.expr("INTERVAL 1 DAY"))
    rules = snapshots.checkpoint_rules("total_output", "idle_s", 14_400, 43_200)
    stated = snapshots.checkpoint_state(idle, rules)
    customer = i.table(spark, sf_dir, "customer").withColumn(
        "app_name", F.concat(F.lit("T"), "c_custkey")
    )
    describe = customer.select(
        "app_name",
        F.concat(F.col("c_nationkey") + 1, F.lit(" MINUTE INTERVAL")).alias("recovery_setting"),
        F.to_json(F.array(F.struct(F.col("c_custkey").alias("place")))).alias("checkpoint_detail"),
        (F.col("c_acctbal") > 0).alias("is_encryption_enabled"),
        F.lit("2023-06-01 00:00:00").alias("app_created_date"),
    )
    status_detail = customer.select(
        "app_name",
        F.concat(F.lit("S10_0_0_"), "c_nationkey").alias("deployment_on"),
        F.lower("c_mktsegment").alias("deployment_in"),
    )
    full = snapshots.with_detail(stated, describe, status_detail)
    return shape(full.withColumn("command", F.concat(F.lit("mon "), "app_name")), s.APP_DETAIL)


@query(
    "table_app_detail",
    f"""WITH {i.EV}, d AS (
  SELECT table_name, day_ts, count(*) FILTER (value < 150) AS total_input,
    count(*) FILTER (value >= 3) AS total_output, max(ts) AS latest, bool_or(value > 100) AS bp,
    bool_and(k < 50) AS rec, max(k) AS k, ANY_VALUE(user_id) AS user_id,
    CAST(epoch(day_ts + INTERVAL 1 DAY) - floor(epoch(max(ts))) AS BIGINT) AS idle_s
  FROM ev GROUP BY table_name, day_ts)
SELECT epoch_ms(day_ts) AS batch_ts, 'mon ' || table_name AS command, table_name AS app_name,
  'RUNNING' AS app_status, total_input, total_output, bp AS is_backpressured, rec AS is_recovery_enabled,
  (c_nationkey + 1) || ' MINUTE INTERVAL' AS recovery_setting,
  CASE WHEN total_output > 0 AND idle_s <= 14400 THEN 'PROGRESSING' WHEN idle_s > 43200 THEN 'STALLED'
    ELSE 'LAGGING' END AS checkpoint_status,
  '[{{"place":' || c_custkey || '}}]' AS checkpoint_detail, c_acctbal > 0 AS is_encryption_enabled,
  'S10_0_0_' || c_nationkey AS deployment_on, lower(c_mktsegment) AS deployment_in,
  CASE WHEN c_custkey IS NOT NULL THEN epoch_ms(TIMESTAMP '2023-06-01') END AS app_created_date,
  {_ms_sql('latest')} AS latest_activity
FROM d LEFT JOIN customer ON c_custkey = user_id WHERE k >= 40""",
)
def table_app_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(app_detail(spark, sf_dir), s.APP_DETAIL)


def _pair_names(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"source_name": F.col("table_name"), "target_name": F.col("table_name")}
    )


def table_counters_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = compare_ops.diff_counts(compare.totals(i.events(spark, sf_dir)))
    return shape(_pair_names(paired), s.TABLE_COUNTERS)


_NAMES_SQL = "app_name, table_name AS source_name, table_name AS target_name"


@query(
    "table_counters",
    f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}, {i.TOTALS_SQL}
SELECT epoch_ms(batch_ts) AS batch_ts, {_NAMES_SQL}, {', '.join(compare.PAIR_COLS)},
  {', '.join(f'''CASE WHEN src_num_of_{k} IS NOT NULL OR tgt_num_of_{k} IS NOT NULL
    THEN coalesce(src_num_of_{k}, 0) - coalesce(tgt_num_of_{k}, 0) END AS diff_num_of_{k}'''
             for k in s.OP_KINDS)}
FROM totals""",
)
def table_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(table_counters_rows(spark, sf_dir), s.TABLE_COUNTERS)


def table_counters_delta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = compare.deltas_by_run(i.events(spark, sf_dir))
    return shape(_pair_names(deltas), s.TABLE_COUNTERS_DELTA)


@query(
    "table_counters_delta",
    f"""SELECT batch_ms AS batch_ts, timesincelastbatch, {_NAMES_SQL},
  {', '.join(s.counter_columns(suffix='_sli'))} FROM ({compare.EXPECTED_DELTA_BY_RUN})""",
)
def table_counters_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(table_counters_delta_rows(spark, sf_dir), s.TABLE_COUNTERS_DELTA)


def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source table, target app and day: newest lag and a sample of twenty records."""
    ev = i.events(spark, sf_dir)
    key = ("batch_ts", *lag_ops.PAIR)
    made = ev.select(
        F.col("event_id").alias("record_id"), F.col("table_name").alias("source_name"),
        F.col("ts").alias("created_ts"), "day_ts",
    )
    lags = lag_ops.record_lag(made, lag.delivered(ev)).withColumn(
        "batch_ts", stamping.bucket_start(F.col("created_ts"), i.DAY_S)
    )
    joined = lag_ops.latency_report(lags, lag.app_catalog(spark, sf_dir), lag.SAMPLE, key)
    source_time = F.date_format("measured_at", "yyyy-MM-dd HH:mm:ss")
    return shape(
        joined.withColumns({
            "source_type": F.lit("SOURCE"), "target_type": F.lit("TARGET"),
            "source_time": source_time,
        }),
        s.LATENCY_REPORT,
    )


@query(
    "table_latency_report",
    f"""WITH {i.EV}, {lag.CATALOG_SQL}, l AS (
  SELECT event_id AS record_id, table_name AS source_name, app_name AS target_name, lag_ms, day_ts AS batch_ts,
    ts + lag_ms * INTERVAL 1 MILLISECOND AS delivered_ts FROM ev WHERE value >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY batch_ts, source_name, target_name
  ORDER BY delivered_ts DESC, record_id DESC) AS n FROM l),
g AS (SELECT batch_ts, source_name, target_name, max(delivered_ts) AS measured_at,
    max(lag_ms) FILTER (n = 1) AS lag_end_to_end,
    min(lag_ms) AS min_lag, max(lag_ms) AS max_lag, avg(lag_ms) AS avg_lag, count(*) AS sample_size
  FROM r WHERE n <= {lag.SAMPLE} GROUP BY 1, 2, 3)
SELECT epoch_ms(batch_ts) AS batch_ts, o.app AS source_app, source_name, 'SOURCE' AS source_type,
  p.app AS target_app, target_name, 'TARGET' AS target_type, CAST(lag_end_to_end AS DOUBLE) AS lag_end_to_end,
  {_ms_sql('measured_at')} AS measured_at, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS source_time,
  CAST(min_lag AS DOUBLE) AS min_lag, CAST(max_lag AS DOUBLE) AS max_lag,
  CAST(CAST(avg_lag AS DECIMAL(38,9)) AS DOUBLE) AS avg_lag, sample_size
FROM g LEFT JOIN owners o ON o.component = source_name LEFT JOIN owners p ON p.component = target_name""",
)
def table_latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(latency_report(spark, sf_dir), s.LATENCY_REPORT)


def component_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(
        payload_ops.capture(payloads.captured(i.events(spark, sf_dir))), s.COMPONENT_PAYLOAD
    )


@query(
    "table_component_payload",
    f"""WITH {i.EV} SELECT {_ms_sql('ts')} AS batch_ts, app_name, event_type AS component_name,
  CASE event_type WHEN 'signup' THEN 'mon' ELSE 'describe' END AS command,
  CASE event_type WHEN 'signup' THEN 'APP' WHEN 'purchase' THEN 'SOURCE' ELSE 'TARGET' END AS type,
  '{{"band": ' || (k // 25) || ', "kind": "' || event_type || '"}}' AS jsondata
FROM ev WHERE event_type NOT IN ('click', 'error')""",
)
def table_component_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(component_payload(spark, sf_dir), s.COMPONENT_PAYLOAD)


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part polls the type of its brand and kind; its size says which version it is.

    Parts count as polls one minute apart, in key order.
    """
    part = i.table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    columns = F.transform(
        words,
        lambda word, place: F.struct(
            word.alias("name"), F.lit("string").alias("type"), (place == 0).alias("is_pk")
        ),
    )
    polls = part.select(
        F.concat(F.upper("p_brand"), F.lit("_"), F.upper("p_type")).alias("type_name"),
        F.timestamp_seconds(F.lit(FIRST_POLL_S) + F.col("p_partkey") * 60).alias("batch_ts"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.floor(F.col("p_size") / 10) * i.DAY_S)
        .alias("created_date"),
        columns.alias("columns"),
    )
    fresh = payload_ops.emit_on_change(polls)
    tables = part.select(F.col("p_brand").alias("app_name"), F.col("p_type").alias("table_name"))
    matched = payload_ops.match_type(fresh, tables)
    return shape(payload_ops.columns_of(matched), s.COLUMN_CATALOG)


@query(
    "table_column_catalog",
    """WITH polls AS (
  SELECT p_partkey, p_brand, p_type, p_name, CAST(p_size // 10 AS BIGINT) AS version,
    lag(p_size // 10) OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS before FROM part)
SELECT epoch_ms(TIMESTAMP '2024-01-01') + p_partkey * 60000 AS batch_ts,
  upper(p_brand) || '_' || upper(p_type) AS type_name, p_brand AS app_name, p_type AS table_name,
  (1600000000 + version * 86400) * 1000 AS created_date, string_split(p_name, ' ')[n] AS column_name,
  'string' AS column_type, n = 1 AS is_pk
FROM polls, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS t(n)
WHERE before IS DISTINCT FROM version""",
)
def table_column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(column_catalog(spark, sf_dir), s.COLUMN_CATALOG)


def warehouse_target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a reading of a target's configuration and metrics."""
    readings = i.events(spark, sf_dir).select(
        F.col("ts").alias("batch_ts"), "app_name", F.col("table_name").alias("source_name"),
        F.concat(F.lit("W"), "user_id").alias("target_name"),
        F.col("k").alias("batch_event_count"), F.lit(60).cast("bigint").alias("batch_interval"),
        batches.describe_payload().alias("describe_json"),
        batches.metrics_payload().alias("metrics_json"),
    )
    configured = batch_ops.target_config(readings, "describe_json")
    return shape(batch_ops.flatten_target(configured, "metrics_json"), s.WAREHOUSE_TARGET_STATS)


@query(
    "table_warehouse_target_stats",
    f"""WITH {i.EV}, flat AS ({batches.flat_select('ev')})
SELECT {_ms_sql('ts')} AS batch_ts, app_name, table_name AS source_name, 'W' || user_id AS target_name,
  {batches.CONFIG_SQL}, k AS batch_event_count, CAST(60 AS BIGINT) AS batch_interval,
  {', '.join(f'flat.{name}' for name, _, _ in batches.FLAT)}
FROM ev JOIN flat USING (event_id)""",
)
def table_warehouse_target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(warehouse_target_stats(spark, sf_dir), s.WAREHOUSE_TARGET_STATS)


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = logs.stored_entries(spark, sf_dir)
    around = log_ops.errors_only(log_ops.with_context(entries, before=2, after=2))
    stamped = stamping.bucket_batches(around, "log_date", i.HOUR_S)
    return shape(stamped, s.LOG_EVENTS)


@query(
    "table_log_events",
    f"""WITH {i.EV}, {i.LINES_SQL}, c AS (SELECT *, string_agg(value, chr(10)) OVER (
    PARTITION BY server ORDER BY ts, line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS ctx FROM lines)
SELECT epoch_ms(date_trunc('hour', ts)) AS batch_ts, {_ms_sql('ts')} AS log_date, server, app_name,
  log_level, message, ctx AS contextbuffertext FROM c WHERE log_level = 'ERROR'""",
)
def table_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(log_events(spark, sf_dir), s.LOG_EVENTS)


# Table name -> builder of its rows.
BUILDERS = {
    "run_history": run_history,
    "app_snapshot": app_snapshot,
    "node_snapshot": node_snapshot,
    "search_store_snapshot": search_store_snapshot,
    "app_detail": app_detail,
    "table_counters": table_counters_rows,
    "table_counters_delta": table_counters_delta_rows,
    "latency_report": latency_report,
    "component_payload": component_payload,
    "column_catalog": column_catalog,
    "warehouse_target_stats": warehouse_target_stats,
    "log_events": log_events,
}


def store(
    spark: SparkSession, sf_dir: str, database: str, location: str | None = None
) -> dict[str, str]:
    """Recreate the twelve tables and fill them; returns their names in the catalog."""
    recreate(spark, database, location=location)
    names = {name: f"`{database}`.`{name}`" for name in BUILDERS}
    for name, build in BUILDERS.items():
        append_snapshot(build(spark, sf_dir), names[name])
    return names


_DECLARED = {
    "run_history": (8, 8), "app_snapshot": (11, 11), "node_snapshot": (9, 9), "search_store_snapshot": (8, 8),
    "app_detail": (17, 17), "table_counters": (20, 20), "table_counters_delta": (21, 21), "latency_report": (15, 15),
    "component_payload": (7, 7), "column_catalog": (9, 9), "warehouse_target_stats": (49, 11), "log_events": (8, 0),
}


@query(
    "catalog_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {columns} AS n_columns, {comments} AS n_comments, "
        f"(SELECT count(*) FROM ({EXPECTED_SQL['table_' + name.removeprefix('table_')]})) AS row_count"
        for name, (columns, comments) in _DECLARED.items()
    ),
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve tables recreated, filled and read back from the catalog, with what it says of their columns."""
    database = f"flowaudit_{uuid.uuid4().hex[:12]}"
    names = store(spark, sf_dir, database, fresh_path(spark, "catalog"))
    declared = catalog_columns(spark, database).where(F.col("column_name") != s.BATCH_DATE)
    columns = declared.groupBy("table_name").agg(
        F.count(F.lit(1)).cast("int").alias("n_columns"), F.count("comment").cast("int").alias("n_comments")
    )
    rows = None
    for name, stored in names.items():
        counted = spark.table(stored).agg(F.count(F.lit(1)).alias("row_count")).withColumn("of", F.lit(name))
        rows = counted if rows is None else rows.unionByName(counted)
    return columns.join(rows, F.col("table_name") == F.col("of")).drop("of")
