"""Counting, reconciling and differencing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.operators import compare
from flowaudit.operators.ordered import SPLIT_ROWS, with_previous
from flowaudit.operators.runs import link_runs
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query
from flowaudit.schemas import OP_KINDS, counter_columns, counter_name
from flowaudit.session import fresh_path
from flowaudit.sources.tables import append_files, read_files

PAIR_COLS = counter_columns(("src", "tgt"))
KEYS = ["app_name", "table_name"]


def _csv(items) -> str:
    return ",\n  ".join(items)


def _diff_sql(k: str, prefix: str = "") -> str:
    s, t = f"{prefix}src_num_of_{k}", f"{prefix}tgt_num_of_{k}"
    return f"coalesce({s}, 0) - coalesce({t}, 0)"


def counters(ev: DataFrame) -> DataFrame:
    """Counts of both sides per table and day, in one scan and one shuffle."""
    keyed = i.both_sides(ev).withColumnRenamed("day_ts", "batch_ts")
    return compare.side_counts(keyed, [*KEYS, "batch_ts"])


def totals(ev: DataFrame) -> DataFrame:
    return compare.running_totals(counters(ev), KEYS, PAIR_COLS)


@query(
    "op_counts",
    f"WITH {i.EV} SELECT app_name, table_name, "
    + _csv(f"count(*) FILTER (op = '{compare.OP_CODES[k]}') AS num_of_{k}" for k in OP_KINDS)
    + " FROM ev GROUP BY 1, 2",
)
def op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.op_counts(i.events(spark, sf_dir), KEYS)


def _one_side(ev: DataFrame, side: str, name: str, letter: str) -> DataFrame:
    named = ev.select(
        "app_name",
        F.concat(F.lit(letter), F.col("user_id")).alias(name),
        F.col("day_ts").alias("batch_ts"),
        "op",
    )
    return compare.op_counts(named, ["app_name", name, "batch_ts"], prefix=f"{side}_num_of_")


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer names the pair of a source table and its target table."""
    key = F.col("c_custkey")
    return i.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("app"), key % 10).alias("app_name"),
        F.concat(F.lit("T"), key).alias("source_name"),
        F.concat(F.lit("W"), key).alias("target_name"),
    )


def _half_sql(side: str, letter: str, name: str, where: str) -> str:
    return (
        f"SELECT app_name, '{letter}' || user_id AS {name}, user_id, day_ts AS batch_ts, "
        + _csv(
            f"count(*) FILTER (op = '{compare.OP_CODES[k]}') AS {side}_num_of_{k}"
            for k in OP_KINDS
        )
        + f" FROM ev WHERE {where} GROUP BY 1, 2, 3, 4"
    )


@query(
    "reconcile_counts",
    f"""WITH {i.EV}, s AS ({_half_sql('src', 'T', 'source_name', 'value < 150')}),
t AS ({_half_sql('tgt', 'W', 'target_name', 'value >= 3')})
SELECT coalesce(s.app_name, t.app_name) AS app_name, epoch_ms(coalesce(s.batch_ts, t.batch_ts)) AS batch_ms,
  'T' || coalesce(s.user_id, t.user_id) AS source_name, 'W' || coalesce(s.user_id, t.user_id) AS target_name,
  {_csv(PAIR_COLS)},
  {_csv(f"{_diff_sql(k)} AS diff_num_of_{k}" for k in OP_KINDS)}
FROM s FULL OUTER JOIN t ON s.app_name = t.app_name AND s.user_id = t.user_id AND s.batch_ts = t.batch_ts""",
)
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir)
    source = _one_side(i.source_changes(ev), "src", "source_name", "T")
    target = _one_side(i.target_changes(ev), "tgt", "target_name", "W")
    paired = compare.pair_sides(source, target, _mapping(spark, sf_dir))
    return compare.diff_counts(paired).select(
        "app_name", i.ms("batch_ts").alias("batch_ms"), "source_name", "target_name",
        *counter_columns(),
    )


EXPECTED_ONE_FEED = f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}
SELECT app_name, table_name, epoch_ms(batch_ts) AS batch_ms, {_csv(PAIR_COLS)},
  {_csv(f"{_diff_sql(k)} AS diff_num_of_{k}" for k in OP_KINDS)} FROM counters"""


@query("reconcile_one_feed", EXPECTED_ONE_FEED)
def reconcile_one_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = compare.diff_counts(counters(i.events(spark, sf_dir)))
    return paired.select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), *counter_columns()
    )


@query(
    "running_totals",
    f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}, {i.TOTALS_SQL}
SELECT app_name, table_name, epoch_ms(batch_ts) AS batch_ms, {_csv(PAIR_COLS)} FROM totals""",
)
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(i.events(spark, sf_dir)).select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), *PAIR_COLS
    )


_RUNS_SQL = """runs AS (SELECT batch_ts, lag(batch_ts) OVER (ORDER BY batch_ts) AS previous_ts
  FROM (SELECT DISTINCT day_ts AS batch_ts FROM ev))"""


def _delta_sql(k: str, side: str) -> str:
    c = f"{side}_num_of_{k}"
    return f"c.{c} - p.{c}"


def _by_run_sql(columns: list[str]) -> str:
    return f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}, {i.TOTALS_SQL}, {_RUNS_SQL}
SELECT c.app_name, c.table_name, epoch_ms(c.batch_ts) AS batch_ms,
  {_csv(columns)}
FROM totals c JOIN runs r ON c.batch_ts = r.batch_ts
LEFT JOIN totals p ON p.app_name = c.app_name AND p.table_name = c.table_name AND p.batch_ts = r.previous_ts"""


_ALL_DELTAS = [
    f"{_delta_sql(k, s)} AS {s}_num_of_{k}_sli" for k in OP_KINDS for s in ("src", "tgt")
]
_DIFF_DELTAS = [
    f"({_delta_sql(k, 'src')}) - ({_delta_sql(k, 'tgt')}) AS diff_num_of_{k}_sli"
    for k in OP_KINDS
]


def deltas_by_run(ev: DataFrame) -> DataFrame:
    """All fifteen changes since the run before."""
    delta = compare.delta_by_run(totals(ev), i.day_runs(ev), KEYS, PAIR_COLS)
    return compare.delta_of_diff(delta)


EXPECTED_DELTA_BY_RUN = _by_run_sql(
    [
        "CAST(epoch(c.batch_ts) - epoch(r.previous_ts) AS BIGINT) AS timesincelastbatch",
        *_ALL_DELTAS,
        *_DIFF_DELTAS,
    ]
)


@query("delta_by_run", EXPECTED_DELTA_BY_RUN)
def delta_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas_by_run(i.events(spark, sf_dir)).select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), "timesincelastbatch",
        *counter_columns(suffix="_sli"),
    )


EXPECTED_SIDE_DELTAS = _by_run_sql(_ALL_DELTAS)


@query("delta_by_run_chunked", EXPECTED_SIDE_DELTAS)
def delta_by_run_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = i.events(spark, sf_dir)
    delta = compare.delta_by_run(
        totals(ev), i.day_runs(ev), KEYS, PAIR_COLS, chunk_unit="week"
    )
    return delta.select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), *counter_columns(("src", "tgt"), "_sli")
    )


@query(
    "delta_for_last_run",
    f"""SELECT * FROM ({EXPECTED_DELTA_BY_RUN}) d
WHERE batch_ms = (SELECT epoch_ms(date_trunc('day', max(ts))) FROM events)""",
)
def delta_for_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters stored per day, then the changes of the last run from the two days it needs."""
    ev = i.events(spark, sf_dir)
    path = fresh_path(spark, "counters-by-day")
    append_files(totals(ev), path)
    last = link_runs(i.day_runs(ev)).orderBy(F.desc("batch_ts")).first()
    delta = compare.delta_for_run(
        read_files(spark, path), last.batch_ts, last.previous_ts, KEYS, PAIR_COLS
    )
    return compare.delta_of_diff(delta).select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), "timesincelastbatch",
        *counter_columns(suffix="_sli"),
    )


@query("delta_of_diff", _by_run_sql(_DIFF_DELTAS))
def delta_of_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas_by_run(i.events(spark, sf_dir)).select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"),
        *[counter_name("diff", k, "_sli") for k in OP_KINDS],
    )


EXPECTED_DELTA_BY_ROW = f"""WITH {i.EV}, {i.SIDES_SQL}, {i.COUNTERS_SQL}, {i.TOTALS_SQL}
SELECT app_name, table_name, epoch_ms(batch_ts) AS batch_ms,
  {_csv(f"{c} - lag({c}) OVER w AS {c}_sli" for c in PAIR_COLS)}
FROM totals WINDOW w AS (PARTITION BY app_name, table_name ORDER BY batch_ts)"""


@query("delta_by_row", EXPECTED_DELTA_BY_ROW)
def delta_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = compare.delta_by_row(totals(i.events(spark, sf_dir)), KEYS, PAIR_COLS)
    return delta.select(
        *KEYS, i.ms("batch_ts").alias("batch_ms"), *[f"{c}_sli" for c in PAIR_COLS]
    )


@query(
    "delta_by_row_events",
    f"""WITH {i.EV}
SELECT event_id, app_name, k - lag(k) OVER w AS k_sli, lag_ms - lag(lag_ms) OVER w AS lag_ms_sli
FROM ev WINDOW w AS (PARTITION BY app_name ORDER BY ts, event_id)""",
)
def delta_by_row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-to-row change on raw readings, where an app may hold a large part of the rows."""
    before = with_previous(
        i.events(spark, sf_dir).select("event_id", "ts", "app_name", "k", "lag_ms"),
        ["app_name"], ["ts", "event_id"], {"k0": "k", "lag0": "lag_ms"}, SPLIT_ROWS,
    )
    return before.select(
        "event_id", "app_name",
        F.try_subtract("k", "k0").alias("k_sli"),
        F.try_subtract("lag_ms", "lag0").alias("lag_ms_sli"),
    )


@query(
    "delta_by_run_clusters",
    f"""WITH {i.EV}, n AS (
  SELECT 'c' || (hour(hour_ts) % 2) AS cluster, app_name, hour_ts, count(*) AS n_events FROM ev GROUP BY 1, 2, 3),
r AS (SELECT DISTINCT cluster, hour_ts FROM n),
l AS (SELECT *, lag(hour_ts) OVER (PARTITION BY cluster ORDER BY hour_ts) AS before FROM r)
SELECT n.cluster, n.app_name, epoch_ms(n.hour_ts) AS batch_ms, n.n_events, n.n_events - p.n_events AS n_events_sli,
  (epoch_ms(n.hour_ts) - epoch_ms(l.before)) // 1000 AS timesincelastbatch
FROM n JOIN l ON n.cluster = l.cluster AND n.hour_ts = l.hour_ts
LEFT JOIN n p ON p.cluster = n.cluster AND p.app_name = n.app_name AND p.hour_ts = l.before""",
)
def delta_by_run_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clusters polled in turn: each has its own run before."""
    ev = i.events(spark, sf_dir)
    cluster = F.concat(F.lit("c"), F.hour("hour_ts") % 2).alias("cluster")
    counts = ev.groupBy(cluster, "app_name", F.col("hour_ts").alias("batch_ts")).agg(F.count(F.lit(1)).alias("n_events"))
    deltas = compare.delta_by_run(counts, counts, ["app_name"], ["n_events"], by=["cluster"])
    return deltas.select(
        "cluster", "app_name", i.ms("batch_ts").alias("batch_ms"), "n_events", "n_events_sli", "timesincelastbatch"
    )
