"""Load batches of a warehouse target and the statistics of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators.ordered import SPLIT_ROWS, with_row_number
from flowaudit.operators.stamping import bucket_start
from flowaudit.schemas import WAREHOUSE_TARGET_STATS

# Nested objects of the metrics payload, and the phases of a batch.
LAST_BATCH = "Last batch info"
TASK_TIME = "Integration Task Time"
PHASES = (
    "compaction_time_ms",
    "stage_resources_mgmt_time_ms",
    "upload_time_ms",
    "merge_time_ms",
    "in_mem_compaction_time_ms",
    "pk_update_time_ms",
    "ddl_execution_time_ms",
)
TOTAL_TIME = "total_integration_time_ms"
BATCH_STATES = {
    "total_batches_created": "created",
    "total_batches_queued": "queued",
    "total_batches_uploaded": "uploaded",
    "total_batches_ignored": "ignored",
    "partition_pruned_batches": "pruned",
}
STATE_MERGED = "merged"

LAST_PREFIX = "last_batch_"
TASK_COLUMNS = [f"{LAST_PREFIX}{p}" for p in (*PHASES, TOTAL_TIME)]
LAST_COLUMNS = [
    c
    for c in WAREHOUSE_TARGET_STATS.columns
    if c.startswith(LAST_PREFIX) and c not in TASK_COLUMNS
]
TOP_COLUMNS = [
    c
    for c in WAREHOUSE_TARGET_STATS.columns[
        WAREHOUSE_TARGET_STATS.columns.index("total_batches_created"):
    ]
    if c not in TASK_COLUMNS and c not in LAST_COLUMNS
]


def metrics_schema() -> T.StructType:
    """Schema of the metrics payload; the nested objects name their fields without prefix."""
    declared = WAREHOUSE_TARGET_STATS.schema

    def inner(names: list[str]) -> list[T.StructField]:
        return [T.StructField(c[len(LAST_PREFIX):], declared[c].dataType) for c in names]

    task = T.StructType(inner(TASK_COLUMNS))
    last = T.StructType([*inner(LAST_COLUMNS), T.StructField(TASK_TIME, task)])
    top = [T.StructField(c, declared[c].dataType) for c in TOP_COLUMNS]
    return T.StructType([*top, T.StructField(LAST_BATCH, last)])


def flatten_target(df: DataFrame, payload: str = "jsondata") -> DataFrame:
    """Flatten a metrics payload with two nested levels into the statistics columns.

    Missing fields are null; the payload column stays, so fields not known here are not lost.
    """
    parsed = df.withColumn("__m", F.from_json(F.col(payload), metrics_schema()))
    last = F.col("__m")[LAST_BATCH]
    return parsed.select(
        *df.columns,
        *[F.col("__m")[c].alias(c) for c in TOP_COLUMNS],
        *[last[c[len(LAST_PREFIX):]].alias(c) for c in LAST_COLUMNS],
        *[last[TASK_TIME][c[len(LAST_PREFIX):]].alias(c) for c in TASK_COLUMNS],
    )


# Property name in the payload -> column and type.
TARGET_PROPERTIES = {
    "adapterName": ("target_adaptername", "string"),
    "projectId": ("project_id", "string"),
    "Mode": ("mode", "string"),
    "streamingUpload": ("streaming_upload", "boolean"),
    "StreamingConfiguration": ("streaming_configuration", "string"),
    "optimizedMerge": ("optimized_merge", "boolean"),
}


def target_config(df: DataFrame, payload: str = "jsondata") -> DataFrame:
    """Target properties from a describe payload; one parse, only the fields needed."""
    wanted = T.StructType([T.StructField(p, T.StringType()) for p in TARGET_PROPERTIES])
    parsed = df.withColumn("__p", F.from_json(F.col(payload), wanted))
    return parsed.select(
        *df.columns,
        *[
            F.col("__p")[prop].try_cast(kind).alias(name)
            for prop, (name, kind) in TARGET_PROPERTIES.items()
        ],
    )


def form_batches(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    max_events: int | None = None,
    every_s: int | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Assign events to batches closed by event count, by interval, or by whichever comes first.

    Adds ``batch_start`` (interval start) and ``batch_no`` (0-based, within the key and interval)
    as far as they apply.
    """
    if max_events is None and every_s is None:
        raise ValueError("give max_events, every_s or both")
    within = list(keys)
    if every_s is not None:
        events = events.withColumn("batch_start", bucket_start(F.col(ts), every_s))
        within.append("batch_start")
    if max_events is not None:
        numbered = with_row_number(events, within, order, "__place", split_rows)
        events = numbered.withColumn(
            "batch_no", F.floor((F.col("__place") - 1) / F.lit(max_events)).cast("bigint")
        ).drop("__place")
    return events


def batch_states(
    batches: DataFrame, keys: Sequence[str] = ("target_name",), state: str = "state"
) -> DataFrame:
    """Number of batches in each state per target."""
    return batches.groupBy(*keys).agg(
        *[F.count_if(F.col(state) == s).alias(name) for name, s in BATCH_STATES.items()]
    )


def target_stats(
    batches: DataFrame,
    keys: Sequence[str] = ("target_name",),
    total: str = TOTAL_TIME,
    phases: Sequence[str] = (*PHASES, "waiting_time_in_queue_ms"),
) -> DataFrame:
    """Integration time range and mean, and the mean of each phase, per target."""
    return batches.groupBy(*keys).agg(
        F.min(total).alias("min_integration_time_ms"),
        F.max(total).alias("max_integration_time_ms"),
        F.avg(total).alias("avg_integration_time_ms"),
        *[F.avg(p).alias(f"avg_{p}") for p in phases],
    )


def events_per_batch(
    events: DataFrame,
    keys: Sequence[str] = ("target_name",),
    batch: Sequence[str] = ("batch_start",),
    size: str = "bytes",
) -> DataFrame:
    """Mean number of events and mean size of the batches of a target."""
    per_batch = events.groupBy(*keys, *batch).agg(
        F.count(F.lit(1)).alias("__events"), F.sum(size).alias("__bytes")
    )
    return per_batch.groupBy(*keys).agg(
        F.avg("__events").alias("avg_event_count_per_batch"),
        F.avg("__bytes").alias("avg_batch_size_bytes"),
        F.count(F.lit(1)).alias("batch_count"),
    )


def last_success(
    batches: DataFrame,
    keys: Sequence[str] = ("target_name",),
    state: str = "state",
    done: str = "done_ts",
) -> DataFrame:
    """Time of the last merged batch per target; null if there is none."""
    merged = F.when(F.col(state) == STATE_MERGED, F.col(done))
    return batches.groupBy(*keys).agg(F.max(merged).alias("last_successful_merge_time"))


def last_batch(
    batches: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("target_name",),
    seq: str = "sequence_number",
) -> DataFrame:
    """The batch with the highest sequence number per target, one row per map task shuffled.

    One ``max_by`` per column keeps number buffers in place, so the aggregation hashes and needs no
    sort; all of them follow the same sequence number.
    """
    return batches.groupBy(*keys).agg(
        *[F.max_by(c, seq).alias(f"{LAST_PREFIX}{c}") for c in dict.fromkeys([seq, *cols])]
    )


def phase_breakdown(
    df: DataFrame,
    keys: Sequence[str] = ("target_name",),
    phases: Sequence[str] = PHASES,
    total: str = TOTAL_TIME,
    prefix: str = LAST_PREFIX,
) -> DataFrame:
    """One row per phase of the last batch, with its share of the reported total."""
    cols = [F.col(f"{prefix}{p}").alias(p) for p in phases]
    wide = df.select(*keys, F.col(f"{prefix}{total}").alias("total_ms"), *cols)
    long = wide.unpivot([*keys, "total_ms"], list(phases), "phase", "phase_ms")
    return long.withColumn(
        "phase_share", F.col("phase_ms") / F.nullif(F.col("total_ms"), F.lit(0))
    )
