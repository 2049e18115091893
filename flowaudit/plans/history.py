"""Run history, stamping and audit queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators import audit, runs, stamping
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query
from flowaudit.schemas import NUMERIC
from flowaudit.sources.conform import conform, lost_counts

FIRST_START = datetime(2023, 12, 31)
REPEAT_S = 300


@query(
    "conform_typed",
    f"""WITH {i.EV} SELECT event_id,
  CASE WHEN event_type <> 'error' THEN value END AS reading,
  CASE WHEN event_type <> 'view' THEN epoch_us(ts) END AS at_us,
  CASE WHEN event_type = 'click' THEN true WHEN event_type = 'signup' THEN false END AS flag,
  CAST(NULL AS VARCHAR) AS note FROM ev""",
)
def conform_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = conform(_untyped(spark, sf_dir), TYPED)
    return typed.select(
        "event_id", F.col("reading").cast("double").alias("reading"),
        i.us("at").alias("at_us"), "flag", "note",
    )


@query(
    "conform_lost",
    """SELECT column_name, count(*) AS lost_values FROM (
  SELECT CASE event_type WHEN 'error' THEN ['reading', 'flag'] WHEN 'view' THEN ['at', 'flag']
    WHEN 'click' THEN [] WHEN 'signup' THEN [] ELSE ['flag'] END AS lost FROM events), unnest(lost) AS t(column_name)
GROUP BY 1""",
)
def conform_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each column do not fit."""
    return lost_counts(_untyped(spark, sf_dir), TYPED)


TYPED = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("reading", NUMERIC),
    T.StructField("at", T.TimestampType()),
    T.StructField("flag", T.BooleanType()),
    T.StructField("note", T.StringType()),
])


def _untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return i.events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")).alias("reading"),
        F.when(kind == "view", "soon").otherwise(F.col("ts").cast("string")).alias("at"),
        F.when(kind == "click", "true").when(kind == "signup", "false").otherwise("?").alias("flag"),
        F.lit("dropped").alias("unknown"),
    )


@query(
    "batch_buckets",
    """SELECT epoch_ms(time_bucket(INTERVAL 15 MINUTES, ts)) AS batch_ms, count(*) AS row_count,
  min(event_id) AS first_event FROM events GROUP BY 1""",
)
def batch_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = stamping.bucket_batches(i.events(spark, sf_dir), "ts", 900)
    return stamped.groupBy("batch_ts").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event")
    ).select(i.ms("batch_ts").alias("batch_ms"), "row_count", "first_event")


@query(
    "stamp_origin",
    f"""WITH {i.EV} SELECT epoch_ms(day_ts) AS batch_ms, 'north' AS cluster_name,
  'example' AS company_name, count(*) AS row_count FROM ev GROUP BY 1""",
)
def stamp_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = stamping.stamp_batch(i.events(spark, sf_dir), F.col("day_ts"))
    counts = stamped.groupBy("batch_ts").agg(F.count(F.lit(1)).alias("row_count"))
    return stamping.stamp_origin(
        counts, {"cluster_name": "north", "company_name": "example"}
    ).select(i.ms("batch_ts").alias("batch_ms"), "cluster_name", "company_name", "row_count")


@query(
    "row_id_in_batch",
    f"""WITH {i.EV} SELECT event_id, epoch_ms(day_ts) AS batch_ms,
  row_number() OVER (PARTITION BY day_ts ORDER BY ts, event_id) AS row_id FROM ev""",
)
def row_id_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir).select("event_id", "ts", "day_ts", "hour_ts")
    numbered = stamping.with_row_id_in_batch(
        ev, ["day_ts"], ["ts", "event_id"]
    )
    return numbered.select("event_id", i.ms("day_ts").alias("batch_ms"), "row_id")


@query(
    "row_id_collisions",
    """SELECT count(*) AS row_count, count(DISTINCT (event_id, user_id)) AS id_count FROM events""",
)
def row_id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashed row id must be as distinct as the natural key it is made from."""
    keyed = stamping.with_row_id(i.events(spark, sf_dir), "events", ["event_id", "user_id"])
    return (
        keyed.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("id_count"))
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = i.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber")
    )
    return audit.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query(
    "orphan_rows",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
)
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order is unknown or only planned."""
    lines = i.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity"
    )
    placed = i.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return audit.orphans(lines, placed, "l_orderkey", "o_orderkey")


@query(
    "rows_per_run",
    f"""WITH {i.EV} SELECT epoch_ms(day_ts) AS batch_ms, count(*) AS row_count,
  epoch_us(max(ts)) AS end_us FROM ev GROUP BY 1""",
)
def rows_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir)
    child = ev.withColumnRenamed("day_ts", "batch_ts").select("batch_ts")
    return audit.rows_per_run(child, i.day_runs(ev)).select(
        i.ms("batch_ts").alias("batch_ms"), "row_count", i.us("runtime_end").alias("end_us")
    )


@query(
    "run_duration_ms",
    f"""WITH {i.EV} SELECT epoch_ms(day_ts) AS batch_ms,
  (epoch_us(max(ts)) - epoch_us(day_ts)) // 1000 AS runtime_duration_ms FROM ev GROUP BY day_ts""",
)
def run_duration_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = runs.run_duration(i.day_runs(i.events(spark, sf_dir)))
    return timed.select(i.ms("batch_ts").alias("batch_ms"), "runtime_duration_ms")


@query(
    "run_schedule",
    f"""WITH {i.EV}, r AS (SELECT DISTINCT hour_ts AS batch_ts FROM ev)
SELECT epoch_ms(batch_ts) AS batch_ms,
  epoch_ms(coalesce(lag(batch_ts) OVER (ORDER BY batch_ts), TIMESTAMP '2023-12-31')) AS lastrun_ms,
  epoch_ms(batch_ts + INTERVAL {REPEAT_S} SECONDS) AS nextrun_ms FROM r""",
)
def run_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = stamping.stamp_origin(
        i.hour_runs(i.events(spark, sf_dir)), {"cluster_name": "north"}
    )
    first = F.lit(FIRST_START.isoformat(sep=" "))
    planned = runs.next_run(runs.previous_run(history, first), REPEAT_S)
    return planned.select(
        i.ms("batch_ts").alias("batch_ms"), i.ms("lastrun").alias("lastrun_ms"),
        i.ms("nextrun").alias("nextrun_ms"),
    )


@query(
    "elapsed_seconds",
    f"""WITH {i.EV}, r AS (SELECT DISTINCT app_name, hour_ts FROM ev)
SELECT app_name, epoch_ms(hour_ts) AS batch_ms,
  CAST(epoch(hour_ts) - epoch(lag(hour_ts) OVER (PARTITION BY app_name ORDER BY hour_ts)) AS BIGINT)
    AS timesincelastbatch FROM r""",
)
def elapsed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each app stands for a cluster with its own runs."""
    history = i.events(spark, sf_dir).select(
        "app_name", F.col("hour_ts").alias("batch_ts")
    ).distinct()
    return runs.elapsed_seconds(history, ["app_name"]).select(
        "app_name", i.ms("batch_ts").alias("batch_ms"), "timesincelastbatch"
    )
