"""Connected components of an edge table, with the smallest member as label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.llm.scratch import Scratch, apart


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Label every node of ``edges`` (a, b: bigint) with the smallest node it is connected to.

    Returns (node, label), one row per node that has an edge. In each round a node takes the
    smallest label among its neighbours and its label's own label; labels only fall and the rounds
    end when none does. Every round is two joins and one combined aggregation over tables in the
    shared folder, so a hub is split by adaptive execution and nothing is gathered on the driver
    but the sum of the labels.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null")
    both = scratch.keep(pairs.union(pairs.select("b", "a")).where("a <> b").distinct())
    first = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")
    )
    labels = scratch.keep(first)
    total = _total(labels)
    while True:
        near = both.join(labels, apart(F.col("b")) == apart(F.col("node"))).select(
            F.col("a").alias("node"), "label"
        )
        up = labels.alias("up")
        jump = (
            labels.alias("low")
            .join(up, apart(F.col("low.label")) == apart(F.col("up.node")))
            .select(F.col("low.node").alias("node"), F.col("up.label").alias("label"))
        )
        following = scratch.keep(near.union(jump).groupBy("node").agg(F.min("label").alias("label")))
        scratch.drop(labels)
        labels, before, total = following, total, _total(following)
        if total == before:
            scratch.drop(both)
            return labels


def _total(labels: DataFrame):
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
