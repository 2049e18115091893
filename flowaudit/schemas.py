"""The twelve monitoring tables as Spark schemas.

Fixed values: table names, column names, order and types.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "numeric": NUMERIC,
    "boolean": T.BooleanType(),
}

# Partition column of the stored tables.
BATCH_DATE = "batch_date"
# Kinds of change counted per table, in column order.
OP_KINDS = ("deletes", "ddls", "pkupdates", "updates", "inserts")
SIDES = ("src", "tgt", "diff")


@dataclass(frozen=True)
class Table:
    """One table: its schema, its surrogate key and the grain that key stands for."""

    name: str
    schema: T.StructType
    row_id: str
    natural_key: tuple[str, ...]
    key_declared: bool

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _field(name: str, kind: str, comment: str | None = None) -> T.StructField:
    metadata = {"comment": comment} if comment else {}
    return T.StructField(name, _TYPES[kind], True, metadata)


def _table(
    name: str, natural_key: tuple[str, ...], fields: list[tuple], key_declared: bool = True
) -> Table:
    schema = T.StructType([_field(*f) for f in fields])
    return Table(name, schema, fields[0][0], natural_key, key_declared)


def _id(name: str) -> tuple:
    return (name, "bigint", "surrogate row id")


_BATCH = ("batch_ts", "timestamp", "run this row belongs to")
_COMMAND = ("command", "string", "console command that yields this reading")
_MONTYPE = ("montype", "string", "kind of monitoring command")

_SIDE_WORDS = {
    "src": "in the source table",
    "tgt": "in the target table",
    "diff": "source minus target",
}


def counter_name(side: str, kind: str, suffix: str = "") -> str:
    return f"{side}_num_of_{kind}{suffix}"


def counter_columns(sides: tuple[str, ...] = SIDES, suffix: str = "") -> list[str]:
    return [counter_name(s, k, suffix) for k in OP_KINDS for s in sides]


def _counters(suffix: str = "", tail: str = "") -> list[tuple]:
    return [
        (counter_name(s, k, suffix), "bigint", f"{k} {_SIDE_WORDS[s]}{tail}")
        for k in OP_KINDS
        for s in SIDES
    ]


RUN_HISTORY = _table(
    "run_history",
    ("cluster_name", "batch_ts"),
    [
        _id("runid"),
        ("batch_ts", "timestamp", "start of the run; the other tables point here"),
        ("runtime_end", "timestamp", "when the run had finished its calls"),
        ("runtime_duration_ms", "numeric", "milliseconds from start to end"),
        ("cluster_name", "string", "configured cluster name"),
        ("company_name", "string", "configured company name"),
        ("lastrun", "timestamp", "start of the run before, or the default start"),
        ("nextrun", "timestamp", "planned start of the next run"),
    ],
)

APP_SNAPSHOT = _table(
    "app_snapshot",
    ("appname", "batch_ts"),
    [
        _id("monappid"),
        _BATCH,
        _COMMAND,
        _MONTYPE,
        ("appname", "string", "namespace and name of the app"),
        ("status", "string", "state of the app"),
        ("rate", "numeric", "event rate"),
        ("sourcerate", "numeric", "event rate at the sources"),
        ("cpurate", "numeric", "CPU reading"),
        ("numservers", "bigint", "servers running the app, normally 0 or 1"),
        ("latest_activity", "timestamp", "last activity of the app"),
    ],
)

NODE_SNAPSHOT = _table(
    "node_snapshot",
    ("nodename", "batch_ts"),
    [
        _id("monnodeclusterid"),
        _BATCH,
        _COMMAND,
        _MONTYPE,
        ("nodename", "string", "node name"),
        ("product_version", "string", "software version on the node"),
        ("freemem", "string", "free memory, as text with a unit"),
        ("cpurate", "numeric", "CPU reading, 100 per core"),
        ("uptime", "string", "time since start, as text"),
    ],
)

SEARCH_STORE_SNAPSHOT = _table(
    "search_store_snapshot",
    ("batch_ts",),
    [
        _id("monnodesid"),
        _BATCH,
        _COMMAND,
        _MONTYPE,
        ("elasticsearch_receive_throughput", "bigint", "receive throughput of the search store"),
        ("elasticsearch_transmit_throughput", "bigint", "transmit throughput of the search store"),
        ("elasticsearch_cluster_storage_free", "bigint", "free storage of the search store"),
        ("elasticsearch_cluster_storage_total", "bigint", "whole storage of the search store"),
    ],
)

APP_DETAIL = _table(
    "app_detail",
    ("app_name", "batch_ts"),
    [
        _id("monid"),
        _BATCH,
        _COMMAND,
        ("app_name", "string", "app name"),
        ("app_status", "string", "state; created and deployed apps are left out unless enabled"),
        ("total_input", "bigint", "events read by the app"),
        ("total_output", "bigint", "events written by the app"),
        ("is_backpressured", "boolean", "app is held back by a slow consumer"),
        ("is_recovery_enabled", "boolean", "recovery is switched on"),
        ("recovery_setting", "string", "recovery interval text; needs describe detail"),
        ("checkpoint_status", "string", "progressing, lagging and so on"),
        ("checkpoint_detail", "string", "nested JSON array as text; needs describe detail"),
        ("is_encryption_enabled", "boolean", "encryption is switched on; needs describe detail"),
        ("deployment_on", "string", "servers holding the app; needs status detail"),
        ("deployment_in", "string", "deployment group; needs status detail"),
        ("app_created_date", "timestamp", "when the app was made; needs describe detail"),
        ("latest_activity", "timestamp", "last activity of the app"),
    ],
)

_PAIR = [
    ("app_name", "string", "app owning the pair"),
    ("source_name", "string", "source table"),
    ("target_name", "string", "target table"),
]
_PAIR_KEY = ("app_name", "source_name", "target_name", "batch_ts")

TABLE_COUNTERS = _table(
    "table_counters", _PAIR_KEY, [_id("tblcompareid"), _BATCH, *_PAIR, *_counters()]
)

TABLE_COUNTERS_DELTA = _table(
    "table_counters_delta",
    _PAIR_KEY,
    [
        _id("tblcomparehistoryid"),
        _BATCH,
        ("timesincelastbatch", "bigint", "seconds since the run before"),
        *_PAIR,
        *_counters("_sli", ", since the run before"),
    ],
)

LATENCY_REPORT = _table(
    "latency_report",
    ("source_name", "target_name", "batch_ts"),
    [
        _id("monleeid"),
        _BATCH,
        ("source_app", "string", "app found by the source name, if one fits"),
        ("source_name", "string", "source as reported"),
        ("source_type", "string", "source type as reported"),
        ("target_app", "string", "app found by the target name, if one fits"),
        ("target_name", "string", "target as reported"),
        ("target_type", "string", "target type as reported"),
        ("lag_end_to_end", "numeric", "lag measured last"),
        ("measured_at", "timestamp", "when the lag was measured"),
        ("source_time", "string", "source time as text"),
        ("min_lag", "numeric", "fastest delivery of the sample"),
        ("max_lag", "numeric", "slowest delivery of the sample"),
        ("avg_lag", "numeric", "mean delivery time of the sample"),
        ("sample_size", "bigint", "records in the sample"),
    ],
    key_declared=False,
)

COMPONENT_PAYLOAD = _table(
    "component_payload",
    ("app_name", "component_name", "command", "type", "batch_ts"),
    [
        _id("moncomoutid"),
        _BATCH,
        ("app_name", "string", "app of the component"),
        ("component_name", "string", "component"),
        ("command", "string", "mon or describe"),
        ("type", "string", "kind of component"),
        ("jsondata", "string", "raw JSON response"),
    ],
    key_declared=False,
)

COLUMN_CATALOG = _table(
    "column_catalog",
    ("type_name", "column_name", "batch_ts"),
    [
        _id("montblcoldtlid"),
        _BATCH,
        ("type_name", "string", "type made for a table"),
        ("app_name", "string", "app matched to the type"),
        ("table_name", "string", "table matched to the type"),
        ("created_date", "timestamp", "when this version of the type was made"),
        ("column_name", "string", "column of the table"),
        ("column_type", "string", "type of the column"),
        ("is_pk", "boolean", "column belongs to the primary key"),
    ],
    key_declared=False,
)

WAREHOUSE_TARGET_STATS = _table(
    "warehouse_target_stats",
    _PAIR_KEY,
    [
        _id("dwdid"),
        _BATCH,
        *_PAIR,
        ("target_adaptername", "string", "adapter writing to the target"),
        ("project_id", "string", "project of the target"),
        ("mode", "string", "APPENDONLY or MERGE"),
        ("streaming_upload", "boolean", "streaming upload is switched on"),
        ("streaming_configuration", "string", "streaming settings text"),
        ("optimized_merge", "boolean", "optimised merge is switched on"),
        ("batch_event_count", "bigint"),
        ("batch_interval", "bigint"),
        ("total_batches_created", "bigint"),
        ("partition_pruned_batches", "bigint"),
        ("last_successful_merge_time", "timestamp"),
        ("total_batches_ignored", "bigint"),
        ("max_integration_time_ms", "bigint"),
        ("avg_in_mem_compaction_time_ms", "numeric"),
        ("avg_batch_size_bytes", "bigint"),
        ("avg_event_count_per_batch", "numeric"),
        ("min_integration_time_ms", "bigint"),
        ("total_batches_queued", "bigint"),
        ("avg_compaction_time_ms", "numeric"),
        ("avg_waiting_time_in_queue_ms", "numeric"),
        ("avg_integration_time_ms", "numeric"),
        ("total_batches_uploaded", "bigint"),
        ("avg_merge_time_ms", "numeric"),
        ("avg_stage_resources_mgmt_time_ms", "numeric"),
        ("avg_upload_time_ms", "numeric"),
        ("last_batch_updates", "bigint"),
        ("last_batch_event_count", "bigint"),
        ("last_batch_inserts", "bigint"),
        ("last_batch_max_record_size_bytes", "bigint"),
        ("last_batch_total_events_merged", "bigint"),
        ("last_batch_ddls", "bigint"),
        ("last_batch_sequence_number", "bigint"),
        ("last_batch_size_bytes", "bigint"),
        ("last_batch_deletes", "bigint"),
        ("last_batch_pk_updates", "bigint"),
        ("last_batch_accumulation_time_ms", "bigint"),
        ("last_batch_compaction_time_ms", "bigint"),
        ("last_batch_stage_resources_mgmt_time_ms", "bigint"),
        ("last_batch_upload_time_ms", "bigint"),
        ("last_batch_merge_time_ms", "bigint"),
        ("last_batch_in_mem_compaction_time_ms", "bigint"),
        ("last_batch_pk_update_time_ms", "bigint"),
        ("last_batch_ddl_execution_time_ms", "bigint"),
        ("last_batch_total_integration_time_ms", "bigint"),
    ],
    key_declared=False,
)

LOG_EVENTS = _table(
    "log_events",
    ("server", "log_date", "log_level", "app_name", "message"),
    [
        ("errorid", "bigint"),
        ("batch_ts", "timestamp"),
        ("log_date", "timestamp"),
        ("server", "string"),
        ("app_name", "string"),
        ("log_level", "string"),
        ("message", "string"),
        ("contextbuffertext", "string"),
    ],
    key_declared=False,
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        RUN_HISTORY,
        APP_SNAPSHOT,
        NODE_SNAPSHOT,
        SEARCH_STORE_SNAPSHOT,
        APP_DETAIL,
        TABLE_COUNTERS,
        TABLE_COUNTERS_DELTA,
        LATENCY_REPORT,
        COMPONENT_PAYLOAD,
        COLUMN_CATALOG,
        WAREHOUSE_TARGET_STATS,
        LOG_EVENTS,
    )
}
