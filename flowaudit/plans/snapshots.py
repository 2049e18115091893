"""App, node and store snapshot queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.functions.text import interval_seconds, parse_bytes, parse_seconds
from flowaudit.operators import compare, snapshots
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query


@query(
    "app_snapshot",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ms, app_name AS appname, 'mon' AS command,
  count(*) / 3600.0::DOUBLE AS rate, CASE WHEN max(k) >= 50 THEN 1::BIGINT ELSE 0::BIGINT END AS numservers,
  CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'HALTED' ELSE 'RUNNING' END AS status,
  epoch_us(max(ts)) AS latest_us FROM ev GROUP BY hour_ts, app_name""",
)
def app_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly app readings; the rate is compared before rounding to the stored scale."""
    raw = (
        i.events(spark, sf_dir)
        .groupBy(F.col("hour_ts").alias("batch_ts"), F.col("app_name").alias("appname"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.max("ts").alias("latest_activity"),
            F.when(F.max("k") >= 50, "1").otherwise("0").alias("numservers"),
            F.when(F.count_if(F.col("event_type") == "error") > 0, "HALTED")
            .otherwise("RUNNING").alias("status"),
        )
        .withColumns({"command": F.lit("mon"), "rate": (F.col("events") / 3600).cast("string")})
    )
    snap = snapshots.app_snapshot(raw)
    events = F.round(F.col("rate").cast("double") * 3600)
    return snap.select(
        i.ms("batch_ts").alias("batch_ms"), "appname", "command", (events / 3600).alias("rate"),
        "numservers", "status", i.us("latest_activity").alias("latest_us"),
    )


@query(
    "node_snapshot",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ms, table_name AS nodename,
  max(k) * 1024 * 1024 AS freemem_bytes, max(k) * 86400 + 3723 AS uptime_s, max(value) AS cpurate
FROM ev GROUP BY hour_ts, table_name""",
)
def node_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        i.events(spark, sf_dir)
        .groupBy(F.col("hour_ts").alias("batch_ts"), F.col("table_name").alias("nodename"))
        .agg(F.max("k").alias("k"), F.max("value").cast("string").alias("cpurate"))
        .withColumns({
            "freemem": F.concat("k", F.lit(" MB")),
            "uptime": F.concat("k", F.lit(" days 01:02:03")),
        })
    )
    snap = snapshots.node_quantities(snapshots.node_snapshot(raw))
    return snap.select(
        i.ms("batch_ts").alias("batch_ms"), "nodename", "freemem_bytes", "uptime_s",
        F.col("cpurate").cast("double").alias("cpurate"),
    )


@query(
    "store_throughput",
    f"""WITH {i.EV}, r AS (
  SELECT hour_ts, CAST(sum(lag_ms) AS BIGINT) AS received, CAST(sum(k) AS BIGINT) AS sent
  FROM ev GROUP BY hour_ts)
SELECT epoch_ms(hour_ts) AS batch_ms, received, sent,
  received - lag(received) OVER w AS received_change, sent - lag(sent) OVER w AS sent_change
FROM r WINDOW w AS (ORDER BY hour_ts)""",
)
def store_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Throughput of the search store per run, and its change since the run before."""
    received, sent = "elasticsearch_receive_throughput", "elasticsearch_transmit_throughput"
    raw = i.events(spark, sf_dir).groupBy(F.col("hour_ts").alias("batch_ts")).agg(
        F.sum("lag_ms").alias(received), F.sum("k").alias(sent)
    )
    snap = snapshots.search_store_snapshot(raw.withColumn("montype", F.lit("store")))
    change = compare.delta_by_row(snap, ["montype"], [received, sent], suffix="_change")
    return change.select(
        i.ms("batch_ts").alias("batch_ms"), F.col(received).alias("received"),
        F.col(sent).alias("sent"), F.col(f"{received}_change").alias("received_change"),
        F.col(f"{sent}_change").alias("sent_change"),
    )


@query(
    "unexpected_server_count",
    """SELECT p_partkey, CAST(p_size AS BIGINT) AS numservers FROM part WHERE p_size NOT IN (0, 1)""",
)
def unexpected_server_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = i.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("numservers")
    )
    return snapshots.unexpected_servers(parts)


@query(
    "latest_activity",
    f"""WITH {i.EV} SELECT app_name, table_name, epoch_ms(day_ts) AS batch_ms,
  epoch_us(max(ts)) AS latest_us,
  CAST(epoch(day_ts + INTERVAL 1 DAY) - floor(epoch(max(ts))) AS BIGINT) AS idle_s
FROM ev GROUP BY app_name, table_name, day_ts""",
)
def latest_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last activity of a day and the idle time up to its end."""
    ev = i.events(spark, sf_dir)
    last = snapshots.latest_activity(ev, ["app_name", "table_name", "day_ts"])
    idle = snapshots.idle_seconds(last, F.col("day_ts") + F.expr("INTERVAL 1 DAY"))
    return idle.select(
        "app_name", "table_name", i.ms("day_ts").alias("batch_ms"),
        i.us("latest_activity").alias("latest_us"), "idle_s",
    )


@query(
    "cpu_share",
    f"""WITH {i.EV} SELECT event_id, value / ((2 + n_nationkey % 7) * 100) AS cpu_share
FROM ev LEFT JOIN nation ON n_nationkey = user_id % 40""",
)
def cpu_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty nodes, of which only those standing for a nation have a known core count."""
    readings = i.events(spark, sf_dir).select(
        "event_id", (F.col("user_id") % 40).alias("node"), F.col("value").alias("cpurate")
    )
    cores = i.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("node"),
        (F.col("n_nationkey") % 7 + 2).alias("cores"),
    )
    return snapshots.cpu_share(readings, cores, "node").select("event_id", "cpu_share")


@query(
    "size_text_to_bytes",
    f"""WITH {i.EV} SELECT event_id,
  CASE event_type WHEN 'view' THEN k WHEN 'click' THEN k * 1024 WHEN 'purchase' THEN k * 1048576
    WHEN 'signup' THEN k * 1073741824 + 536870912 END AS free_bytes,
  CASE event_type WHEN 'view' THEN k WHEN 'click' THEN k * 60 + 5 WHEN 'purchase' THEN k * 86400 + 7384
    WHEN 'signup' THEN k * 3600 END AS uptime_s FROM ev""",
)
def size_text_to_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("k"), F.col("event_type")
    told = i.events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "view", F.concat(k, F.lit(" bytes")))
        .when(kind == "click", F.concat(k, F.lit("KB")))
        .when(kind == "purchase", F.concat(k, F.lit(" MiB")))
        .when(kind == "signup", F.concat(k, F.lit(".5 gb")))
        .otherwise("plenty").alias("freemem"),
        F.when(kind == "view", F.concat(k, F.lit("s")))
        .when(kind == "click", F.concat(k, F.lit("m 5s")))
        .when(kind == "purchase", F.concat(k, F.lit(" days 02:03:04")))
        .when(kind == "signup", F.concat(k, F.lit(" hours")))
        .otherwise("long").alias("uptime"),
    )
    return told.select(
        "event_id", parse_bytes(F.col("freemem")).alias("free_bytes"),
        parse_seconds(F.col("uptime")).alias("uptime_s"),
    )


@query(
    "used_share",
    f"""WITH {i.EV} SELECT app_name, table_name, min(k) AS free, max(k) AS total,
  CASE WHEN max(k) <> 0 THEN (max(k) - min(k)) / max(k) END AS used_share
FROM ev GROUP BY app_name, table_name""",
)
def used_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = i.events(spark, sf_dir).groupBy("app_name", "table_name").agg(
        F.min("k").alias("free"), F.max("k").alias("total")
    )
    return snapshots.used_share(stores, "free", "total")


@query("active_status_only", "SELECT o_orderkey, 'RUNNING' AS app_status FROM orders WHERE o_orderstatus = 'O'")
def active_status_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = {"F": "CREATED", "P": "DEPLOYED", "O": "RUNNING"}
    apps = i.table(spark, sf_dir, "orders").select(
        "o_orderkey", i.pick(F.col("o_orderstatus"), states).alias("app_status")
    )
    return snapshots.app_detail(apps)


@query(
    "optional_detail",
    """SELECT c_custkey, s_nationkey || ' MINUTE INTERVAL' AS recovery_setting,
  CASE WHEN s_suppkey IS NOT NULL THEN '[]' END AS checkpoint_detail,
  s_acctbal > 0 AS is_encryption_enabled, epoch_ms(TIMESTAMP '2024-01-01') + 0 * s_suppkey AS created_ms,
  CAST(NULL AS VARCHAR) AS deployment_on, CAST(NULL AS VARCHAR) AS deployment_in
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""",
)
def optional_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Describe detail is known for the customers that are suppliers; status detail is off."""
    apps = i.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("ns."), "c_custkey").alias("app_name")
    )
    describe = i.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("ns."), "s_suppkey").alias("app_name"),
        F.concat("s_nationkey", F.lit(" MINUTE INTERVAL")).alias("recovery_setting"),
        F.lit("[]").alias("checkpoint_detail"),
        (F.col("s_acctbal") > 0).alias("is_encryption_enabled"),
        F.lit("2024-01-01 00:00:00").alias("app_created_date"),
    )
    return snapshots.with_detail(apps, describe).select(
        "c_custkey", "recovery_setting", "checkpoint_detail", "is_encryption_enabled",
        i.ms("app_created_date").alias("created_ms"), "deployment_on", "deployment_in",
    )


@query(
    "app_totals",
    f"""WITH {i.EV} SELECT app_name, count(*) FILTER (value < 150) AS total_input,
  count(*) FILTER (value >= 3) AS total_output FROM ev GROUP BY app_name""",
)
def app_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.app_totals(
        i.events(spark, sf_dir), ["app_name"],
        F.col("value") < i.SOURCE_BELOW, F.col("value") >= i.TARGET_FROM,
    )


@query(
    "interval_text_seconds",
    f"""WITH {i.EV} SELECT event_id, CASE event_type WHEN 'view' THEN k WHEN 'click' THEN k * 60
  WHEN 'purchase' THEN k * 3600 WHEN 'signup' THEN k * 86400 END AS recovery_s FROM ev""",
)
def interval_text_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = {
        "view": " SECOND INTERVAL", "click": " MINUTE INTERVAL", "purchase": " hours interval",
        "signup": " Day  Interval", "error": " MOON INTERVAL",
    }
    text = F.concat("k", i.pick(F.col("event_type"), units))
    return i.events(spark, sf_dir).select("event_id", interval_seconds(text).alias("recovery_s"))


@query(
    "checkpoint_state",
    f"""WITH {i.EV}, d AS (
  SELECT app_name, table_name, day_ts, count(*) FILTER (value >= 3) AS progress,
    CAST(epoch(day_ts + INTERVAL 1 DAY) - floor(epoch(max(ts))) AS BIGINT) AS idle_s
  FROM ev GROUP BY app_name, table_name, day_ts)
SELECT app_name, table_name, epoch_ms(day_ts) AS batch_ms,
  CASE WHEN progress > 0 AND idle_s <= 14400 THEN 'PROGRESSING' WHEN idle_s > 43200 THEN 'STALLED'
    ELSE 'LAGGING' END AS checkpoint_status FROM d""",
)
def checkpoint_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = i.events(spark, sf_dir).groupBy("app_name", "table_name", "day_ts").agg(
        F.count_if(F.col("value") >= i.TARGET_FROM).alias("progress"),
        F.max("ts").alias("latest_activity"),
    )
    idle = snapshots.idle_seconds(daily, F.col("day_ts") + F.expr("INTERVAL 1 DAY"))
    rules = snapshots.checkpoint_rules("progress", "idle_s", 14_400, 43_200)
    state = snapshots.checkpoint_state(idle, rules)
    return state.select(
        "app_name", "table_name", i.ms("day_ts").alias("batch_ms"), "checkpoint_status"
    )


@query(
    "checkpoint_items",
    f"""WITH {i.EV} SELECT event_id, 'read' AS stage, k AS place FROM ev WHERE event_type <> 'error'
UNION ALL SELECT event_id, 'write', k + 1 FROM ev WHERE event_type <> 'error'""",
)
def checkpoint_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested items to JSON text and back; the text of errors is cut off and yields nothing."""
    items = F.array(
        F.struct(F.lit("read").alias("stage"), F.col("k").alias("place")),
        F.struct(F.lit("write").alias("stage"), (F.col("k") + 1).alias("place")),
    )
    text = F.when(F.col("event_type") == "error", "[{").otherwise(F.to_json(items))
    detail = i.events(spark, sf_dir).select("event_id", text.alias("checkpoint_detail"))
    return snapshots.checkpoint_items(detail, "struct<stage:string,place:bigint>")


@query(
    "deployment_nodes",
    f"""WITH {i.EV} SELECT event_id, '10.0.' || (user_id % 10) || '.' || k AS node FROM ev
UNION ALL SELECT event_id, 'node_' || k FROM ev""",
)
def deployment_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat(
        F.lit("S10_0_"), F.col("user_id") % 10, F.lit("_"), F.col("k"), F.lit(", node_"), F.col("k")
    )
    apps = i.events(spark, sf_dir).select("event_id", listed.alias("deployment_on"))
    return snapshots.deployment_nodes(apps).select("event_id", "node")


@query(
    "flag_counts",
    f"""WITH {i.EV} SELECT epoch_ms(hour_ts) AS batch_ms,
  count(*) FILTER (value > 100) AS is_backpressured_count, count(*) FILTER (k < 50) AS is_recovery_enabled_count,
  count(*) FILTER (event_type = 'signup') AS is_encryption_enabled_count, count(*) AS app_count
FROM ev GROUP BY hour_ts""",
)
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {
        "is_backpressured": F.col("value") > 100,
        "is_recovery_enabled": F.col("k") < 50,
        "is_encryption_enabled": F.col("event_type") == "signup",
    }
    apps = i.events(spark, sf_dir).withColumns(flags)
    counts = snapshots.flag_counts(apps, ["hour_ts"], list(flags))
    return counts.withColumn("batch_ms", i.ms("hour_ts")).drop("hour_ts")


@query(
    "label_flag_counts",
    """SELECT CAST(quality AS BIGINT) AS quality, count(*) FILTER (toxic = 1) AS toxic_count,
  count(*) AS app_count FROM labels GROUP BY 1""",
)
def label_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = i.table(spark, sf_dir, "labels").select(
        F.col("quality").cast("bigint").alias("quality"), (F.col("toxic") == 1).alias("toxic")
    )
    return snapshots.flag_counts(labels, ["quality"], ["toxic"])
