"""Files landed by the pollers: JSON responses and server logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.functions.payload import is_json


def read_payloads(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """JSON responses, one per line or one per file, with a flag for text that parses."""
    lines = spark.read.text(path, wholetext=whole_files)
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("jsondata"),
        is_json(F.col("value")).alias("is_json"),
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with the file they come from and their place in it.

    ``block_start`` is where the piece of the file begins that a task reads, ``row_no`` rises from
    line to line within the piece; in this order the lines stand in the file. Folders such as
    ``server=a`` add a column.
    """
    lines = spark.read.text(path)
    return lines.select(
        *lines.columns,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def stream_logs(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Log lines of files as they land in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("value")
