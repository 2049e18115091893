"""Log watching: parse lines as they land and keep the error levels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.operators.logs import ERROR_LEVELS, errors_only, parse_logs, with_context
from flowaudit.schemas import BATCH_DATE


def watch_errors(lines: DataFrame, levels: Sequence[str] = ERROR_LEVELS) -> DataFrame:
    """Typed error entries of a stream of lines; keeps no state."""
    return errors_only(parse_logs(lines), levels)


def store_with_context(
    path: str, before: int, after: int, levels: Sequence[str] = ERROR_LEVELS
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that stores error entries with the lines around them.

    Row frames are refused on streams, so the context reaches as far as the files of one trigger.
    Each micro-batch has its own folder, which a retry overwrites.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        entries = parse_logs(batch)
        around = with_context(entries, before, after, order=("log_date", "value"))
        dated = errors_only(around, levels).withColumn(BATCH_DATE, F.to_date("log_date"))
        rows = dated.hint("rebalance", F.col(BATCH_DATE))
        rows.write.mode("overwrite").partitionBy(BATCH_DATE).parquet(f"{path}/batch_id={batch_id}")

    return handle
