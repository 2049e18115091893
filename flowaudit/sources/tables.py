"""Monitoring tables in the session catalog and on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.schemas import BATCH_DATE, TABLES, Table
from flowaudit.session import cut


def recreate(
    spark: SparkSession,
    database: str,
    tables: Iterable[Table] = tuple(TABLES.values()),
    location: str | None = None,
) -> None:
    """Drop and create the given tables, empty, with their column comments: all of them or none.

    The new tables are made under names of their own first and then take the places of the old ones;
    a failure on the way puts the old ones back, and what they held is removed only when all new ones
    are in place. Tables are partitioned by the date of the run, so reads of recent runs prune the rest.
    With ``location`` they are kept below that folder, each in a new one.
    """
    tables = list(tables)
    version = uuid.uuid4().hex[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    staged = {t.name: f"{t.name}__new_{version}" for t in tables}
    before = {t.name: f"{t.name}__old_{version}" for t in tables if _exists(spark, database, t.name)}
    moved: list[tuple[str, str]] = []
    try:
        for table in tables:
            path = f"{location}/{table.name}-{version}" if location else None
            _create_empty(spark, f"`{database}`.`{staged[table.name]}`", table, path)
        for table in tables:
            for old, new in ((table.name, before.get(table.name)), (staged[table.name], table.name)):
                if new is not None:
                    _rename(spark, database, old, new)
                    moved.append((old, new))
    except Exception:
        for old, new in reversed(moved):
            _rename(spark, database, new, old)
        for name in staged.values():
            _drop(spark, database, name)
        raise
    for name in before.values():
        _drop(spark, database, name)


def _create_empty(spark: SparkSession, name: str, table: Table, path: str | None) -> None:
    schema = T.StructType([*table.schema.fields, T.StructField(BATCH_DATE, T.DateType())])
    empty = spark.createDataFrame([], schema)
    writer = empty.write.mode("errorifexists").format("parquet").partitionBy(BATCH_DATE)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _exists(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`{name}`")


def _rename(spark: SparkSession, database: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE `{database}`.`{old}` RENAME TO `{database}`.`{new}`")


def _drop(spark: SparkSession, database: str, name: str) -> None:
    """Drop a table with its files, wherever they lie."""
    if not _exists(spark, database, name):
        return
    told = spark.sql(f"DESCRIBE FORMATTED `{database}`.`{name}`").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE `{database}`.`{name}`")
    if told is not None:
        _remove(spark, told["data_type"])


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the store's own file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """Name, type, place and comment of every column of a database's tables, as the catalog has them."""
    found = [
        (table.name, place, c.name, c.dataType, c.description)
        for table in spark.catalog.listTables(database)
        for place, c in enumerate(spark.catalog.listColumns(f"`{database}`.`{table.name}`"))
    ]
    kinds = "table_name string, position int, column_name string, data_type string, comment string"
    return spark.createDataFrame(found, kinds)


def _dated(df: DataFrame, batch_ts: str) -> DataFrame:
    return df.withColumn(BATCH_DATE, F.to_date(batch_ts))


def append_snapshot(df: DataFrame, table: str, batch_ts: str = "batch_ts") -> None:
    """Append the rows of a poll to a table of the catalog.

    The rebalance step packs small polls into few files and cuts a busy day into several.
    """
    rows = _dated(df, batch_ts).hint("rebalance", F.col(BATCH_DATE))
    exists = df.sparkSession.catalog.tableExists(table)
    if exists:
        names = df.sparkSession.table(table).columns
        rows.select(*names).write.mode("append").insertInto(table)
    else:
        rows.write.mode("append").format("parquet").partitionBy(BATCH_DATE).saveAsTable(table)


def append_files(df: DataFrame, path: str, batch_ts: str = "batch_ts") -> None:
    """Append the rows of a poll to Parquet files partitioned by date."""
    rows = _dated(df, batch_ts).hint("rebalance", F.col(BATCH_DATE))
    rows.write.mode("append").partitionBy(BATCH_DATE).parquet(path)


def read_files(spark: SparkSession, path: str, table: Table | None = None) -> DataFrame:
    """Read appended snapshots; with a table its schema is used and none inferred."""
    reader = spark.read
    if table is not None:
        schema = T.StructType([*table.schema.fields, T.StructField(BATCH_DATE, T.DateType())])
        reader = reader.schema(schema)
    return reader.parquet(path)


def compact_days(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite appended snapshots into a new folder, with files of the advised size."""
    rows = spark.read.parquet(source).hint("rebalance", F.col(BATCH_DATE))
    rows.write.mode("errorifexists").partitionBy(BATCH_DATE).parquet(target)


#: Partition column of repeatable appends, and its value for runs packed together by day.
BATCH_RUN = "batch_run"
PACKED = "packed"


def _run_name(batch_ts: str) -> Column:
    return F.concat(F.lit("run-"), F.coalesce(F.unix_micros(F.col(batch_ts).cast("timestamp")).cast("string"), F.lit("")))


def append_runs(df: DataFrame, path: str, batch_ts: str = "batch_ts") -> None:
    """Store the rows of polls, each run in a partition of its own, so that storing a run again replaces it.

    A run given again must be given whole; a run without rows changes nothing. Only the partitions of
    the runs given are written. One writer at a time; an append that broke off is repeated.
    """
    rows = _dated(df, batch_ts).withColumn(BATCH_RUN, _run_name(batch_ts))
    _overwrite_partitions(rows, path)


def _overwrite_partitions(rows: DataFrame, path: str) -> None:
    packed = rows.hint("rebalance", F.col(BATCH_DATE), F.col(BATCH_RUN))
    writer = packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH_DATE, BATCH_RUN).parquet(path)


def read_runs(spark: SparkSession, path: str, batch_ts: str = "batch_ts") -> DataFrame:
    """Read what ``append_runs`` stored and ``compact_runs`` packed; a run's own partition wins over a packed one."""
    return _resolved(spark.read.parquet(path), batch_ts).drop(BATCH_RUN)


def _resolved(stored: DataFrame, batch_ts: str) -> DataFrame:
    own = stored.where(F.col(BATCH_RUN) != PACKED)
    runs = own.select(F.col(BATCH_DATE).alias("__day"), F.col(BATCH_RUN).alias("__run")).distinct()
    replaced = F.col(BATCH_DATE).eqNullSafe(F.col("__day")) & (_run_name(batch_ts) == F.col("__run"))
    packed = stored.where(F.col(BATCH_RUN) == PACKED).join(runs, replaced, "left_anti")
    return own.unionByName(packed)


def compact_runs(spark: SparkSession, path: str, first: date, last: date, batch_ts: str = "batch_ts") -> None:
    """Pack the runs of the days from ``first`` to ``last`` by day; files of other days are not touched.

    The packed rows are written beside the runs' own partitions, which go only then. Until they are
    gone they win over the packed rows, so readers see every row once, also after a failure half-way.
    """
    days = spark.read.parquet(path).where(F.col(BATCH_DATE).between(F.lit(first), F.lit(last)))
    rows = cut(_resolved(days, batch_ts), "packed-runs")
    _overwrite_partitions(rows.withColumn(BATCH_RUN, F.lit(PACKED)), path)
    # One row per run of the days packed.
    gone = days.where(F.col(BATCH_RUN) != PACKED).select(BATCH_DATE, BATCH_RUN).distinct()
    for day, run in gone.collect():
        _remove(spark, f"{path}/{BATCH_DATE}={day}/{BATCH_RUN}={run}")
