"""App, node and search-store snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowaudit.functions import text as tx
from flowaudit.functions.payload import json_rows
from flowaudit.functions.ratios import cpu_share as share_of_cores
from flowaudit.functions.ratios import seconds_between
from flowaudit.functions.ratios import used_share as share_in_use
from flowaudit.schemas import APP_SNAPSHOT, NODE_SNAPSHOT, SEARCH_STORE_SNAPSHOT
from flowaudit.sources.conform import shape

NORMAL_SERVER_COUNTS = (0, 1)
# States left out of the app detail unless enabled.
STATUS_CREATED = "CREATED"
STATUS_DEPLOYED = "DEPLOYED"


def app_snapshot(raw: DataFrame) -> DataFrame:
    """App readings in the shape of the app snapshot table."""
    return shape(raw, APP_SNAPSHOT)


def node_snapshot(raw: DataFrame) -> DataFrame:
    """Node readings in the shape of the node snapshot table."""
    return shape(raw, NODE_SNAPSHOT)


def search_store_snapshot(raw: DataFrame) -> DataFrame:
    """Store readings in the shape of the search-store snapshot table."""
    return shape(raw, SEARCH_STORE_SNAPSHOT)


def unexpected_servers(df: DataFrame, col: str = "numservers") -> DataFrame:
    """Apps on an unusual number of servers; an unknown number is not reported."""
    return df.where(~F.col(col).isin(*NORMAL_SERVER_COUNTS))


def latest_activity(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "latest_activity"
) -> DataFrame:
    """Last activity per key."""
    return df.groupBy(*keys).agg(F.max(ts).alias(name))


def idle_seconds(
    df: DataFrame, at: Column, activity: str = "latest_activity", name: str = "idle_s"
) -> DataFrame:
    """Seconds without activity up to the run."""
    return df.withColumn(name, seconds_between(F.col(activity), at))


def cpu_share(
    df: DataFrame, cores: DataFrame, on: str, reading: str = "cpurate", name: str = "cpu_share"
) -> DataFrame:
    """CPU reading as a share of all cores; ``cores`` holds one row per node."""
    return (
        df.join(cores.select(on, "cores"), on, "left")
        .withColumn(name, share_of_cores(F.col(reading), F.col("cores")))
        .drop("cores")
    )


def node_quantities(df: DataFrame, freemem: str = "freemem", uptime: str = "uptime") -> DataFrame:
    """Free memory and uptime as numbers."""
    return df.withColumns(
        {
            "freemem_bytes": tx.parse_bytes(F.col(freemem)),
            "uptime_s": tx.parse_seconds(F.col(uptime)),
        }
    )


def used_share(df: DataFrame, free: str, total: str, name: str = "used_share") -> DataFrame:
    """Share of the storage in use."""
    return df.withColumn(name, share_in_use(F.col(free), F.col(total)))


def app_detail(
    df: DataFrame,
    include_created: bool = False,
    include_deployed: bool = False,
    status: str = "app_status",
) -> DataFrame:
    """App details without the CREATED and DEPLOYED apps, unless they are enabled.

    An app of unknown state is kept.
    """
    hidden = []
    if not include_created:
        hidden.append(STATUS_CREATED)
    if not include_deployed:
        hidden.append(STATUS_DEPLOYED)
    if not hidden:
        return df
    return df.where(F.col(status).isNull() | ~F.col(status).isin(*hidden))


# Columns filled only with the describe or the status detail.
DESCRIBE_COLUMNS = {
    "recovery_setting": "string",
    "checkpoint_detail": "string",
    "is_encryption_enabled": "boolean",
    "app_created_date": "timestamp",
}
STATUS_COLUMNS = {"deployment_on": "string", "deployment_in": "string"}


def with_detail(
    df: DataFrame,
    describe: DataFrame | None = None,
    status: DataFrame | None = None,
    on: Sequence[str] = ("app_name",),
) -> DataFrame:
    """Fill the optional columns from the detail frames given; the others become typed nulls.

    Each detail frame holds one row per key.
    """
    for detail, columns in ((describe, DESCRIBE_COLUMNS), (status, STATUS_COLUMNS)):
        if detail is None:
            df = df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
        else:
            typed = detail.select(*on, *[F.col(c).cast(t).alias(c) for c, t in columns.items()])
            df = df.join(typed, list(on), "left")
    return df


def app_totals(
    events: DataFrame, keys: Sequence[str], is_input: Column, is_output: Column
) -> DataFrame:
    """Events read and written per app."""
    return events.groupBy(*keys).agg(
        F.count_if(is_input).alias("total_input"), F.count_if(is_output).alias("total_output")
    )


def checkpoint_rules(
    progress: str, idle: str, lag_after_s: int = 300, stall_after_s: int = 3600
) -> list[tuple[str, Column]]:
    """Default rules, from the progress since the run before and the idle time."""
    return [
        ("UNKNOWN", F.col(progress).isNull() | F.col(idle).isNull()),
        ("PROGRESSING", (F.col(progress) > 0) & (F.col(idle) <= lag_after_s)),
        ("STALLED", F.col(idle) > stall_after_s),
        ("LAGGING", F.lit(True)),
    ]


def checkpoint_state(
    df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "checkpoint_status"
) -> DataFrame:
    """State of the checkpoint: the first rule that holds names it, null if none does."""
    state = F.coalesce(*[F.when(holds, F.lit(value)) for value, holds in rules])
    return df.withColumn(name, state)


def checkpoint_items(
    df: DataFrame, element: str, detail: str = "checkpoint_detail"
) -> DataFrame:
    """One row per item of the checkpoint detail array; bad or empty detail gives no row."""
    kept = [c for c in df.columns if c != detail]
    return (
        df.select(*kept, F.explode(json_rows(F.col(detail), element)).alias("__item"))
        .select(*kept, "__item.*")
    )


def deployment_nodes(
    df: DataFrame, servers: str = "deployment_on", separator: str = r"\s*,\s*"
) -> DataFrame:
    """One row per server the app is deployed on, as an address."""
    return df.withColumn("node", F.explode(F.split(F.trim(F.col(servers)), separator))).withColumn(
        "node", tx.server_address(F.col("node"))
    )


def flag_counts(df: DataFrame, by: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """How many apps have each flag set, and how many there are."""
    return df.groupBy(*by).agg(
        *[F.count_if(F.col(f)).alias(f"{f}_count") for f in flags],
        F.count(F.lit(1)).alias("app_count"),
    )
