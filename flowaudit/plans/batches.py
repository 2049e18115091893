"""Load batch queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators import batches, opening
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query
from flowaudit.schemas import WAREHOUSE_TARGET_STATS

MAX_EVENTS = 100
TARGET = "target_name"


def metrics_value(kind: T.DataType, offset: int) -> Column:
    """Invented reading of a metrics field: ``k`` plus the place of the field."""
    if isinstance(kind, T.TimestampType):
        return F.col("ts")
    if isinstance(kind, T.DecimalType):
        return (F.col("k") + offset + F.lit(0.5)).cast(kind)
    return F.col("k") + offset


def _nested(schema: T.StructType, counter: list[int]) -> Column:
    fields = []
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            inner = _nested(field.dataType, counter)
            if field.name == batches.TASK_TIME:
                inner = F.when(F.col("event_type") != "view", inner)
            fields.append(inner.alias(field.name))
        else:
            fields.append(metrics_value(field.dataType, counter[0]).alias(field.name))
            counter[0] += 1
    return F.struct(*fields)


def metrics_payload() -> Column:
    """Metrics JSON text of an event; views lack the task times."""
    return F.to_json(_nested(batches.metrics_schema(), [0]))


def _flat_names(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType, bool]]:
    names = []
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            names += _flat_names(field.dataType, batches.LAST_PREFIX)
            continue
        name = f"{prefix}{field.name}"
        names.append((name, field.dataType, name in batches.TASK_COLUMNS))
    return names


FLAT = _flat_names(batches.metrics_schema())


def flat_select(source: str) -> str:
    cols = []
    for place, (name, kind, task) in enumerate(FLAT):
        value = f"k + {place}"
        if isinstance(kind, T.TimestampType):
            value = "epoch_us(ts) // 1000"
        elif isinstance(kind, T.DecimalType):
            value = f"CAST(k + {place} + 0.5 AS DOUBLE)"
        if task:
            value = f"CASE WHEN event_type <> 'view' THEN {value} END"
        cols.append(f"{value} AS {name}")
    return f"SELECT event_id, {', '.join(cols)} FROM {source}"


@query("flatten_nested", f"WITH {i.EV} {flat_select('ev')}")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = i.events(spark, sf_dir).select("event_id", metrics_payload().alias("jsondata"))
    flat = batches.flatten_target(captured)

    def plain(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.TimestampType):
            return i.ms(name).alias(name)
        if isinstance(kind, T.DecimalType):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return flat.select("event_id", *[plain(name, kind) for name, kind, _ in FLAT])


def describe_payload() -> Column:
    """Describe JSON text of a target; signups have an unreadable merge flag."""
    return F.to_json(
        F.struct(
            F.concat(F.lit("Writer"), F.col("k") % 3).alias("adapterName"),
            F.concat(F.lit("project"), F.col("user_id") % 4).alias("projectId"),
            F.when(F.col("k") < 50, "MERGE").otherwise("APPENDONLY").alias("Mode"),
            (F.col("value") < 20).cast("string").alias("streamingUpload"),
            F.when(F.col("event_type") == "view", "MaxRecords=10").alias("StreamingConfiguration"),
            F.when(F.col("event_type") == "signup", "maybe")
            .otherwise((F.col("k") > 30).cast("string")).alias("optimizedMerge"),
            F.lit("kept in the payload").alias("other"),
        )
    )


CONFIG_SQL = """'Writer' || (k % 3) AS target_adaptername,
  'project' || (user_id % 4) AS project_id, CASE WHEN k < 50 THEN 'MERGE' ELSE 'APPENDONLY' END AS mode,
  value < 20 AS streaming_upload, CASE WHEN event_type = 'view' THEN 'MaxRecords=10' END AS streaming_configuration,
  CASE WHEN event_type <> 'signup' THEN k > 30 END AS optimized_merge"""


@query("target_config", f"WITH {i.EV} SELECT event_id, {CONFIG_SQL} FROM ev")
def target_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = i.events(spark, sf_dir).select("event_id", describe_payload().alias("jsondata"))
    return batches.target_config(captured).drop("jsondata")


def _sized(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("app_name").alias(TARGET), "event_id", "ts", "hour_ts", F.col("lag_ms").alias("bytes")
    )


_NUMBERED_SQL = f"""numbered AS (
  SELECT app_name AS target_name, event_id, ts, lag_ms AS bytes, hour_ts AS batch_start,
    (row_number() OVER (PARTITION BY app_name ORDER BY ts, event_id) - 1) // {MAX_EVENTS} AS batch_no,
    (row_number() OVER (PARTITION BY app_name, day_ts ORDER BY ts, event_id) - 1) // 10 AS day_batch_no,
    day_ts FROM ev)"""


@query(
    "batches_by_count",
    f"""WITH {i.EV}, {_NUMBERED_SQL} SELECT target_name, batch_no, count(*) AS row_count,
  min(event_id) AS first_event, max(event_id) AS last_event FROM numbered GROUP BY 1, 2""",
)
def batches_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = batches.form_batches(
        _sized(i.events(spark, sf_dir)), [TARGET], "ts", ["ts", "event_id"],
        max_events=MAX_EVENTS,
    )
    return formed.groupBy(TARGET, "batch_no").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


@query(
    "batches_by_time",
    f"""WITH {i.EV}, {_NUMBERED_SQL} SELECT target_name, epoch_ms(batch_start) AS batch_ms,
  count(*) AS row_count, min(event_id) AS first_event, max(event_id) AS last_event
FROM numbered GROUP BY 1, 2""",
)
def batches_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = batches.form_batches(
        _sized(i.events(spark, sf_dir)), [TARGET], "ts", ["ts", "event_id"], every_s=i.HOUR_S
    )
    return formed.groupBy(TARGET, "batch_start").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    ).select(TARGET, i.ms("batch_start").alias("batch_ms"), "row_count", "first_event", "last_event")


@query(
    "batches_by_either",
    f"""WITH {i.EV}, {_NUMBERED_SQL} SELECT target_name, epoch_ms(day_ts) AS batch_ms,
  day_batch_no AS batch_no, count(*) AS row_count, min(event_id) AS first_event
FROM numbered GROUP BY 1, 2, 3""",
)
def batches_by_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of ten events at most, closed at the end of the day."""
    formed = batches.form_batches(
        _sized(i.events(spark, sf_dir)), [TARGET], "ts", ["ts", "event_id"],
        max_events=10, every_s=i.DAY_S,
    )
    return formed.groupBy(TARGET, "batch_start", "batch_no").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event")
    ).select(TARGET, i.ms("batch_start").alias("batch_ms"), "batch_no", "row_count", "first_event")


def _opened_sql(max_events: int | None, every_s: int | None) -> str:
    """From each event to the one that opens the next batch, and along those from the first."""
    ends = ["total + 1"]
    if max_events is not None:
        ends.append(f"p + {max_events}")
    if every_s is not None:
        ends.append(
            "1 + count(*) OVER (PARTITION BY target_name ORDER BY epoch_us(ts) "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {every_s * 1_000_000 - 1} FOLLOWING)"
        )
    return f"""WITH RECURSIVE {i.EV}, {_NUMBERED_SQL},
n AS (SELECT target_name, event_id, ts, row_number() OVER w AS p, count(*) OVER (PARTITION BY target_name) AS total
  FROM numbered WINDOW w AS (PARTITION BY target_name ORDER BY ts, event_id)),
nx AS (SELECT target_name, p, least({", ".join(ends)}) AS q FROM n),
o(target_name, p, batch_no) AS (SELECT DISTINCT target_name, 1::BIGINT, 0::BIGINT FROM n
  UNION ALL SELECT o.target_name, nx.q, o.batch_no + 1 FROM o JOIN nx ON o.target_name = nx.target_name AND o.p = nx.p
  JOIN n ON n.target_name = nx.target_name AND n.p = nx.q),
s AS (SELECT o.target_name AS t, o.p AS opening, batch_no, n.ts AS batch_start FROM o JOIN n USING (target_name, p))
SELECT target_name, batch_no, epoch_us(batch_start) // 1000 AS batch_ms, count(*) AS row_count, min(event_id) AS first_event,
  max(event_id) AS last_event FROM n ASOF JOIN s ON n.target_name = s.t AND n.p >= s.opening GROUP BY 1, 2, 3"""


def _opened(spark: SparkSession, sf_dir: str, max_events: int | None, every_s: int | None) -> DataFrame:
    events = _sized(i.events(spark, sf_dir))
    formed = opening.open_batches(events, [TARGET], "ts", ["ts", "event_id"], max_events, every_s)
    return formed.groupBy(TARGET, "batch_no", "batch_start").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    ).select(
        TARGET, "batch_no", i.ms("batch_start").alias("batch_ms"), "row_count", "first_event", "last_event"
    )


@query("open_batches_by_time", _opened_sql(None, i.HOUR_S))
def open_batches_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that close an hour after their first event."""
    return _opened(spark, sf_dir, None, i.HOUR_S)


@query("open_batches_by_either", _opened_sql(10, i.DAY_S))
def open_batches_by_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that close with their tenth event or a day after their first, whichever comes first."""
    return _opened(spark, sf_dir, 10, i.DAY_S)


@query(
    "batch_states",
    f"WITH {i.EV}, {i.BATCHES_SQL} SELECT target_name, "
    + ", ".join(f"count(*) FILTER (state = '{s}') AS {n}" for n, s in batches.BATCH_STATES.items())
    + " FROM batches GROUP BY 1",
)
def batch_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_states(i.load_batches(i.events(spark, sf_dir)))


_MEANS = [*batches.PHASES, "waiting_time_in_queue_ms"]


@query(
    "target_stats",
    f"""WITH {i.EV}, {i.BATCHES_SQL} SELECT target_name,
  min(total_integration_time_ms) AS min_integration_time_ms, max(total_integration_time_ms) AS max_integration_time_ms,
  avg(total_integration_time_ms) AS avg_integration_time_ms, {', '.join(f'avg({p}) AS avg_{p}' for p in _MEANS)}
FROM batches GROUP BY 1""",
)
def target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.target_stats(i.load_batches(i.events(spark, sf_dir)))


@query(
    "events_per_batch",
    f"""WITH {i.EV}, {_NUMBERED_SQL}, b AS (
  SELECT target_name, batch_start, count(*) AS n, sum(bytes) AS size FROM numbered GROUP BY 1, 2)
SELECT target_name, avg(n) AS avg_event_count_per_batch, avg(size) AS avg_batch_size_bytes,
  count(*) AS batch_count FROM b GROUP BY 1""",
)
def events_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = batches.form_batches(
        _sized(i.events(spark, sf_dir)), [TARGET], "ts", ["ts", "event_id"], every_s=i.HOUR_S
    )
    return batches.events_per_batch(formed)


@query(
    "last_success",
    f"""WITH {i.EV}, {i.BATCHES_SQL} SELECT target_name,
  epoch_us(max(done_ts) FILTER (state = 'merged')) AS merged_us FROM batches GROUP BY 1""",
)
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = batches.last_success(i.load_batches(i.events(spark, sf_dir)))
    return last.select(TARGET, i.us("last_successful_merge_time").alias("merged_us"))


_LAST = ["event_count", "size_bytes", *batches.PHASES, batches.TOTAL_TIME]
_LAST_SQL = f"""newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_name ORDER BY sequence_number DESC) AS n
    FROM batches) WHERE n = 1)"""


def _last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.last_batch(i.load_batches(i.events(spark, sf_dir)), _LAST)


@query(
    "last_batch",
    f"""WITH {i.EV}, {i.BATCHES_SQL}, {_LAST_SQL} SELECT target_name,
  {', '.join(f'{c} AS last_batch_{c}' for c in ['sequence_number', *_LAST])} FROM newest""",
)
def last_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last(spark, sf_dir)


@query(
    "phase_breakdown",
    f"WITH {i.EV}, {i.BATCHES_SQL}, {_LAST_SQL} "
    + " UNION ALL ".join(
        f"SELECT target_name, total_integration_time_ms AS total_ms, '{p}' AS phase, {p} AS phase_ms, "
        f"CASE WHEN total_integration_time_ms <> 0 THEN {p} / total_integration_time_ms END AS phase_share "
        "FROM newest"
        for p in batches.PHASES
    ),
)
def phase_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.phase_breakdown(_last(spark, sf_dir))
