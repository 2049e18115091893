"""Log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.operators import logs
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query
from flowaudit.session import cut


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_logs(i.log_lines(i.events(spark, sf_dir)))


def stored_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries parsed once and kept, for operators that read them more than once."""
    return cut(entries(spark, sf_dir), "log-entries")


@query(
    "parse_logs",
    f"""WITH {i.EV}, {i.LINES_SQL}
SELECT line_no, epoch_us(ts) AS log_us, server, app_name, log_level, message FROM lines""",
)
def parse_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "line_no", i.us("log_date").alias("log_us"), "server", "app_name", "log_level", "message"
    )


@query(
    "log_rejects",
    """SELECT event_id AS line_no, '~~ ' || event_id AS value FROM events
WHERE event_type = 'view' AND value < 5""",
)
def log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.log_rejects(i.log_lines(i.events(spark, sf_dir)))


@query(
    "log_level_counts",
    f"""WITH {i.EV}, {i.LINES_SQL} SELECT log_level, count(*) AS entries FROM lines
WHERE log_level IN ('ERROR', 'FATAL', 'WARN') GROUP BY 1""",
)
def log_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = logs.errors_only(entries(spark, sf_dir), (*logs.ERROR_LEVELS, "WARN"))
    return logs.level_counts(kept)


@query(
    "log_context",
    f"""WITH {i.EV}, {i.LINES_SQL}
SELECT line_no, server, string_agg(value, chr(10)) OVER (PARTITION BY server ORDER BY ts, line_no
  ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS contextbuffertext FROM lines""",
)
def log_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = logs.with_context(stored_entries(spark, sf_dir), before=2, after=1)
    return around.select("line_no", "server", "contextbuffertext")


ERROR_CONTEXT_SQL = f"""WITH {i.EV}, {i.LINES_SQL}, c AS (
SELECT line_no, log_level, app_name, string_agg(value, chr(10)) OVER (PARTITION BY app_name ORDER BY ts, line_no
  ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS contextbuffertext FROM lines)
SELECT line_no, app_name, contextbuffertext FROM c WHERE log_level = 'ERROR'"""


@query("error_context", ERROR_CONTEXT_SQL)
def error_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the same app around each error."""
    parsed = stored_entries(spark, sf_dir)
    around = logs.with_context(parsed, before=3, after=3, keys=("app_name",))
    return logs.errors_only(around).select("line_no", "app_name", "contextbuffertext")
