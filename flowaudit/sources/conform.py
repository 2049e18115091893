"""Feeds brought to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.operators.stamping import natural_key_hash
from flowaudit.schemas import Table


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if field.name in df.columns:
        value = F.col(field.name).try_cast(field.dataType)
    else:
        value = F.lit(None).cast(field.dataType)
    return value.alias(field.name, metadata=field.metadata)


def _lost(df: DataFrame, schema: T.StructType) -> Column:
    lost = F.lit(False)
    for field in schema:
        if field.name in df.columns:
            source = F.col(field.name)
            lost = lost | (source.isNotNull() & source.try_cast(field.dataType).isNull())
    return lost


def conform(df: DataFrame, schema: T.StructType, on_bad: str = "null") -> DataFrame:
    """Cast a feed to a schema: declared order, missing columns null, other columns dropped.

    Values that do not fit become null (``on_bad="null"``), their rows are left out
    (``"drop"``, see ``conform_rejects``), or the job fails (``"fail"``).
    """
    if on_bad not in ("null", "drop", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    if on_bad == "drop":
        df = df.where(~_lost(df, schema))
    if on_bad == "fail":
        return df.select(
            *[
                (
                    F.col(f.name).cast(f.dataType)
                    if f.name in df.columns
                    else F.lit(None).cast(f.dataType)
                ).alias(f.name, metadata=f.metadata)
                for f in schema
            ]
        )
    return df.select(*[_typed(df, f) for f in schema])


def conform_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the feed with at least one value that does not fit."""
    return df.where(_lost(df, schema))


def lost_columns(df: DataFrame, schema: T.StructType, name: str = "lost") -> DataFrame:
    """Add the names of the columns whose value does not fit, an empty list where all do."""
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema
        if f.name in df.columns
    ]
    return df.withColumn(name, F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>"))


def lost_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """How many values of each column do not fit, one row per column that has any."""
    lost = lost_columns(df, schema, "__lost").select(F.explode("__lost").alias("column_name"))
    return lost.groupBy("column_name").agg(F.count(F.lit(1)).alias("lost_values"))


def shape(df: DataFrame, table: Table) -> DataFrame:
    """Bring rows to a monitoring table's schema and give them their surrogate id.

    The id is a hash of the table name and the natural key, so it needs no shuffle and stays the
    same when the row is computed again.
    """
    typed = conform(df.drop(table.row_id), table.schema)
    key = natural_key_hash(table.name, table.natural_key)
    comment = table.schema[table.row_id].metadata
    return typed.withColumn(table.row_id, key.alias(table.row_id, metadata=comment))
