"""Log lines to typed entries, by level, with the lines around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.operators.ordered import SPLIT_ROWS, with_neighbour_text, with_running_sum

# Default line layout: <date> <time> @<server> -<LEVEL> <app> : <message>
LINE_PATTERN = r"^(\d\S* \S+) @(\S+) -(\S+) (\S+) : (.*)$"
LINE_FIELDS = ("log_date", "server", "log_level", "app_name", "message")
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ERROR_LEVELS = ("ERROR", "FATAL")

_SEP = "\x1f"


def parse_logs(
    lines: DataFrame,
    pattern: str = LINE_PATTERN,
    fields: Sequence[str] = LINE_FIELDS,
    line: str = "value",
    time_field: str = "log_date",
    time_pattern: str = TIME_PATTERN,
) -> DataFrame:
    """Typed entries of the lines that match; the line itself is kept.

    A line that matches is rewritten to its groups with a separator before each, then split once;
    a line that holds the separator itself has its groups taken one by one.
    """
    groups = F.lit("".join(f"{_SEP}${g}" for g in range(1, len(fields) + 1)))
    rewritten = F.regexp_replace(F.col(line), F.lit(pattern), groups)
    apart = F.array(*[F.regexp_extract(F.col(line), pattern, g) for g in range(len(fields) + 1)])
    parts = F.when(F.col(line).contains(_SEP), apart).otherwise(F.split(rewritten, _SEP, len(fields) + 1))
    split = lines.where(F.col(line).rlike(pattern)).withColumn("__parts", parts)
    parsed = split.select(
        *lines.columns, *[F.col("__parts")[i + 1].alias(f) for i, f in enumerate(fields)]
    )
    return parsed.withColumn(
        time_field, F.try_to_timestamp(F.col(time_field), F.lit(time_pattern))
    )


def parse_whole_logs(
    lines: DataFrame,
    pattern: str = LINE_PATTERN,
    keys: Sequence[str] = ("file_path",),
    order: Sequence[str] = ("block_start", "row_no"),
    line: str = "value",
    split_rows: int | None = SPLIT_ROWS,
    **options: object,
) -> DataFrame:
    """Typed entries whose line is followed by the lines up to the next entry of the same file.

    Lines that do not match (stack traces, garbled lines) belong to the entry before, so that
    ``with_context`` shows them. Those ahead of the first entry of a file belong to none; they are
    in ``log_rejects``, with all other lines that do not match. ``lines`` must carry ``keys`` and
    ``order``, as ``read_logs`` gives them; further options are those of ``parse_logs``. ``lines``
    is read up to three times.
    """
    matches = F.coalesce(F.col(line).rlike(pattern), F.lit(False))
    flagged = lines.withColumn("__starts", matches.cast("bigint"))
    numbered = with_running_sum(flagged, keys, order, {"__entry": "__starts"}, split_rows)
    others = [c for c in lines.columns if c not in keys and c not in order and c != line]
    place = F.struct(*order)
    after = F.sort_array(F.collect_list(F.when(F.col("__starts") == 0, F.struct(*order, line))))
    whole = (
        numbered.where("__entry > 0")
        .groupBy(*keys, "__entry")
        .agg(F.min_by(F.struct(*order, line, *others), place).alias("__first"), after.alias("__after"))
    )
    texts = F.concat(F.array(F.col("__first")[line]), F.transform("__after", lambda a: a[line]))
    heads = whole.select(
        *[c if c in keys else F.col("__first")[c].alias(c) for c in lines.columns],
        F.array_join(texts, "\n").alias("__text"),
    )
    parsed = parse_logs(heads, pattern, line=line, **options)
    return parsed.withColumn(line, F.col("__text")).drop("__text")


def parse_with_raw_context(
    lines: DataFrame,
    before: int,
    after: int,
    keys: Sequence[str] = ("file_path",),
    order: Sequence[str] = ("block_start", "row_no"),
    line: str = "value",
    name: str = "contextbuffertext",
    split_rows: int | None = SPLIT_ROWS,
    **options: object,
) -> DataFrame:
    """Typed entries with the lines around each as they stand in the file, entries or not.

    Stack traces and garbled lines count as lines and are shown. Only ``before + 1 + after`` lines
    are gathered per entry, so a dump of any length between two entries stays in rows of its own.
    ``lines`` must carry ``keys`` and ``order``, as ``read_logs`` gives them; for rotated files of
    one server, take the server as key and ``file_path`` as first of ``order``. Further options are
    those of ``parse_logs``. ``lines`` is read up to three times.
    """
    around = with_neighbour_text(lines, keys, order, line, name, before, after, split_rows)
    return parse_logs(around, line=line, **options)


def log_rejects(lines: DataFrame, pattern: str = LINE_PATTERN, line: str = "value") -> DataFrame:
    """The lines that do not match."""
    return lines.where(~F.coalesce(F.col(line).rlike(pattern), F.lit(False)))


def errors_only(
    df: DataFrame, levels: Sequence[str] = ERROR_LEVELS, level: str = "log_level"
) -> DataFrame:
    """Entries of the error levels."""
    return df.where(F.col(level).isin(*levels))


def level_counts(df: DataFrame, level: str = "log_level") -> DataFrame:
    """Entries per level."""
    return df.groupBy(level).agg(F.count(F.lit(1)).alias("entries"))


def with_context(
    df: DataFrame,
    before: int,
    after: int,
    keys: Sequence[str] = ("server",),
    order: Sequence[str] = ("log_date", "line_no"),
    text: str = "value",
    name: str = "contextbuffertext",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Attach the lines around each entry of the same server, the entry included."""
    return with_neighbour_text(df, keys, order, text, name, before, after, split_rows)
