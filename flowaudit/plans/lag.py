"""End-to-end lag queries. Source is the event type, target is the app."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.functions.text import source_time as read_source_time
from flowaudit.operators import lag
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query

SAMPLE = 20


def created(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("record_id"), F.col("event_type").alias("source_name"),
        F.col("ts").alias("created_ts"),
    )


def delivered(ev: DataFrame) -> DataFrame:
    """Records that reached the target, each delivered twice when its value is 50 or more."""
    delay = F.make_dt_interval(secs=F.col("lag_ms") / F.lit(1000).cast("decimal(18,6)"))
    arrival = F.col("ts") + delay
    again = F.array(arrival, arrival + F.expr("INTERVAL 1 MINUTE"))
    times = F.when(F.col("value") >= 50, again).otherwise(F.array(arrival))
    return i.target_changes(ev).select(
        F.col("event_id").alias("record_id"), F.col("app_name").alias("target_name"),
        F.explode(times).alias("delivered_ts"),
    )


def lags(ev: DataFrame) -> DataFrame:
    return lag.record_lag(created(ev), delivered(ev))


LAGS_SQL = """lags AS (
  SELECT event_id AS record_id, event_type AS source_name, app_name AS target_name, lag_ms,
         ts + lag_ms * INTERVAL 1 MILLISECOND AS delivered_ts
  FROM ev WHERE value >= 3)"""
PAIR = "source_name, target_name"


@query(
    "record_lag",
    f"""WITH {i.EV}, {LAGS_SQL}
SELECT record_id, {PAIR}, lag_ms, epoch_us(delivered_ts) AS delivered_us FROM lags""",
)
def record_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags(i.events(spark, sf_dir)).select(
        "record_id", *lag.PAIR, "lag_ms", i.us("delivered_ts").alias("delivered_us")
    )


@query(
    "lag_stats",
    f"""WITH {i.EV}, {LAGS_SQL}
SELECT {PAIR}, min(lag_ms) AS min_lag, max(lag_ms) AS max_lag, avg(lag_ms) AS avg_lag,
  count(lag_ms) AS sample_size FROM lags GROUP BY {PAIR}""",
)
def lag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag.lag_stats(lags(i.events(spark, sf_dir)))


SAMPLED_SQL = f"""sampled AS (
  SELECT {PAIR}, min(lag_ms) AS min_lag, max(lag_ms) AS max_lag, avg(lag_ms) AS avg_lag,
    count(lag_ms) AS sample_size
  FROM (SELECT *, row_number() OVER (PARTITION BY {PAIR} ORDER BY delivered_ts DESC, record_id DESC) AS n
        FROM lags) WHERE n <= {SAMPLE} GROUP BY {PAIR})"""


@query("lag_stats_sampled", f"WITH {i.EV}, {LAGS_SQL}, {SAMPLED_SQL} SELECT * FROM sampled")
def lag_stats_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag.lag_stats(lags(i.events(spark, sf_dir)), sample=SAMPLE)


CURRENT_SQL = f"""current AS (
  SELECT {PAIR}, arg_max(lag_ms, (delivered_ts, record_id)) AS lag_end_to_end,
    max(delivered_ts) AS measured_at FROM lags GROUP BY {PAIR})"""


@query(
    "current_lag",
    f"""WITH {i.EV}, {LAGS_SQL}, {CURRENT_SQL}
SELECT {PAIR}, lag_end_to_end, epoch_us(measured_at) AS measured_us FROM current""",
)
def current_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag.current_lag(lags(i.events(spark, sf_dir))).select(
        *lag.PAIR, "lag_end_to_end", i.us("measured_at").alias("measured_us")
    )


def app_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers own one component each; nations own some of the same names."""
    suppliers = i.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("T"), "s_suppkey").alias("component"),
        F.concat(F.lit("app"), "s_nationkey").alias("app"),
    )
    nations = i.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("T"), "n_nationkey").alias("component"),
        F.concat(F.lit("region"), "n_regionkey").alias("app"),
    )
    return suppliers.unionByName(nations)


CATALOG_SQL = """catalog AS (
  SELECT 'T' || s_suppkey AS component, 'app' || s_nationkey AS app FROM supplier
  UNION ALL SELECT 'T' || n_nationkey, 'region' || n_regionkey FROM nation),
owners AS (
  SELECT component, count(DISTINCT app) AS candidates,
    CASE WHEN count(DISTINCT app) = 1 THEN min(app) END AS app FROM catalog GROUP BY component)"""


@query(
    "attribute_app",
    f"""WITH {CATALOG_SQL}, named AS (
  SELECT o_orderkey, 'T' || (o_custkey // 3) AS component FROM orders)
SELECT o_orderkey, n.component, app AS app_name, coalesce(candidates, 0) AS candidates
FROM named n LEFT JOIN owners o ON n.component = o.component""",
)
def attribute_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.floor(F.col("o_custkey") / 3).cast("bigint")
    named = i.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("T"), third).alias("component")
    )
    return lag.attribute(named, app_catalog(spark, sf_dir), "component")


@query(
    "source_time",
    f"""WITH {i.EV} SELECT event_id,
  CASE WHEN event_type <> 'error' THEN epoch_us(date_trunc('second', ts)) END AS source_us FROM ev""",
)
def source_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "unknown").otherwise(
        F.date_format("ts", "dd.MM.yyyy HH:mm:ss")
    )
    told = i.events(spark, sf_dir).select("event_id", text.alias("source_time"))
    read = read_source_time(F.col("source_time"), "dd.MM.yyyy HH:mm:ss")
    return told.select("event_id", i.us(read).alias("source_us"))
