"""Mixing sources to target weights by repeating and thinning documents.

Sizes are added up per source, each source gets a target, and its rate is target / size. A document
is emitted floor(rate) times, and once more with a probability equal to the rest of the rate, drawn
from a hash of its id and a seed, so reruns and retried tasks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = r"\x20\x09-\x0D"
_DRAWS = 16**13


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source: (source, source_size, target) from rows of (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share the total size; a
    target stops at ``most`` times its source's size and the excess is shared again by weight until
    no target is above. Shares in the end are one level times the weight, so the capped sources are
    those with the smallest limit per weight: one ordered pass over one row per source finds them.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    weighed = per_source.withColumn("weight", weight.cast("bigint"))
    limit = F.col("source_size") * most
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    level = left / F.sum("weight").over(rest)
    # The first source, in order of limits, that stays under its limit sets the level.
    levels = weighed.withColumn("__level", level).withColumn(
        "__fits", F.when(F.col("__level") * F.col("weight") <= limit, F.col("__level"))
    )
    final = F.first("__fits", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.least(F.coalesce(final * F.col("weight"), limit.cast("double")), limit.cast("double"))
    return levels.select("source", "source_size", share.alias("target"))


def draw(key: Column, seed: str) -> Column:
    """A number from 0 up to, not including, 1 that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(_DRAWS))


def mix_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Add size, source_size, target, rate and copies to the rows of ``df``.

    The table of sources is joined under Spark's own size limit for broadcasts, and by a split
    shuffle join beyond it; a source holding most rows is only counted, in combined aggregations.

    Defined results: a null text has size 0, a null source is a source of its own, a source of
    size 0 has target and rate 0; rows of one id and source draw alike. Columns of ``df`` named
    like the new ones are replaced.
    """
    new = ("size", "source_size", "target", "rate", "copies")
    rows = df.drop(*new).withColumn("size", word_count(F.col(text_col)))
    found = targets(
        df.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), weights, most
    ).withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    chance = F.col("rate") - whole
    return (
        rows.join(found, F.col(source_col).eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("rate", rate)
        .withColumn("copies", whole + (draw(F.col(id_col), seed) < chance).cast("bigint"))
    )


def mixed(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``df``, in its own columns, as often as the mix takes it."""
    taken = mix_copies(df, **options).where("copies > 0")
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*df.columns)
