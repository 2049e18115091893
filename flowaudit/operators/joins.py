"""Joins to lookups that were aggregated just before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 8


def lookup(df: DataFrame, table: DataFrame, key: Column, name: str, spread: int = SPREAD) -> DataFrame:
    """Left join to ``table``, which has one row per ``name``; drops ``name`` from the result.

    A small lookup is broadcast by its measured size. A large one is shuffled, and then a hot key
    of ``df`` must not end in one task: its rows are dealt over ``spread`` parts and the lookup
    repeated for each. The dealing also puts an exchange between the lookup's aggregation and the
    join, without which adaptive execution would not split a skewed partition any further.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__part")
    dealt = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(spread)))
    found = table.select("*", parts).withColumnRenamed("__part", "__of_part")
    same = (key == F.col(name)) & (F.col("__part") == F.col("__of_part"))
    return dealt.join(found, same, "left").drop("__part", "__of_part", name)
