"""Ordered per-key calculations that survive a hot key.

A plain window puts all rows of a key into one task. Here a count per key (one pass over the key
columns, combined on the map side) finds the hot keys, those with more than ``split_rows`` rows; where
there is none the plain window does. Hot keys are cut by rank into chunks of about ``split_rows``
rows and the window runs per (keys, chunk); a cold key is one chunk. What a chunk must know of the
rows before it comes from a small frame of chunk summaries, which is folded along the key and added
to each chunk as extra rows, marked and dropped at the end. The large side is shuffled once, on
(keys, chunk), so a key holding a third of all rows is spread over as many tasks as it has chunks,
and data without hot keys pays for the count only. The input is read up to four times; give rows
that are dear to compute through ``session.cut``.

Where to cut is read from a sample of the hot keys' order columns, taken by a hash of the row: about
``POINTS`` rows stand for a chunk, and up to ``EXACT_ROWS`` rows a chunk all of them do. A cut is a value of
all order columns together, so rows of one time, or without a time, are parted by the columns that
follow; only rows equal in all of them stay together. Counts and cuts are small stored tables, read
when the plan is made, and joined without a hint: Spark broadcasts them below its threshold, and
beyond it splits the hot partitions of the join.

The input must give the same rows each time it is read. Without ``split_rows`` the window is plain,
right for inputs of bounded length per key, such as one row per key and run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowaudit.session import cut

CHUNK = "__chunk"
EXTRA = "__extra"
SPLIT_ROWS = 1_000_000
#: Rows of the sample that stand for a chunk, and the largest chunk that is cut by all its rows.
POINTS = 256
EXACT_ROWS = 2048
_HASHES = 1 << 30
#: Rows per key up to which Spark keeps the first ones of each map task, and how finely levels are told apart.
MAP_LIMIT = 1000
_LEVELS = 24
_FINE = 10_000


def _same_keys(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__hot_{k}"))
    return same


def _hot_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], split_rows: int) -> DataFrame | None:
    """The hot keys (as ``__hot_`` columns) with their cuts in groups of ``__wide``; None without hot keys.

    Of N rows at most N / split_rows keys are hot, and there are about as many cuts in all.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > split_rows)
    hot = cut(counts.select(*[F.col(k).alias(f"__hot_{k}") for k in keys]), "hot-keys")
    if hot.isEmpty():
        return None
    points = split_rows if split_rows <= EXACT_ROWS else POINTS
    drawn = F.pmod(F.xxhash64(*keys, *order), F.lit(_HASHES)) < int(_HASHES * points / split_rows)
    sample = df.select(*dict.fromkeys([*keys, *order])).where(drawn).join(hot, _same_keys(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cuts = (
        sample.withColumn("__place", place)
        .where(((F.col("__place") - 1) % points == 0) & (F.col("__place") > 1))
        .groupBy(*[F.col(k).alias(f"__hot_{k}") for k in keys])
        .agg(F.array_sort(F.collect_set(F.struct(*order))).alias("__cuts"))
        .withColumn("__wide", F.ceil(F.sqrt(F.size("__cuts"))).cast("int"))
    )
    starts = F.sequence(F.lit(1), F.size("__cuts"), F.col("__wide"))
    grouped = F.transform(starts, lambda start: F.slice("__cuts", start, F.col("__wide")))
    return cut(cuts.withColumn("__cuts", grouped), "hot-cuts")


def _cut_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    """Add the chunk of each row: null for cold keys, rising with the order for hot ones.

    A row's chunk is the number of cuts up to the row, found by group of cuts and then within it.
    """
    at = F.struct(*order)
    group = F.size(F.filter("__cuts", lambda g: g[0] <= at))
    within = F.size(F.filter(F.col("__cuts")[group - 1], lambda c: c <= at))
    chunk = F.when(group == 0, F.lit(0)).otherwise((group - 1) * F.col("__wide") + within)
    return (
        df.join(cuts, _same_keys(keys), "left")
        .withColumn(CHUNK, F.when(F.col("__wide").isNotNull(), chunk.cast("bigint")))
        .withColumn(EXTRA, F.lit(False))
        .drop("__cuts", "__wide", *[f"__hot_{k}" for k in keys])
    )


def _split(df: DataFrame, keys: Sequence[str], order: Sequence[str], split_rows: int | None) -> DataFrame | None:
    """Rows with their chunks, or None where no key is hot or none is to be split."""
    cuts = None if split_rows is None else _hot_cuts(df, keys, order, split_rows)
    return None if cuts is None else _cut_rows(df, keys, order, cuts)


def _hot(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CHUNK).isNotNull()).drop(EXTRA)


def _by_chunk(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def _finish(df: DataFrame) -> DataFrame:
    return df.where(~F.col(EXTRA)).drop(EXTRA, CHUNK)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: dict[str, str],
    split_rows: int | None = None,
) -> DataFrame:
    """Add the previous row's value of each column: ``cols`` maps new name to column.

    ``order`` must be unique within the keys.
    """
    rows = _split(df, keys, order, split_rows)
    if rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(c).over(w) for new, c in cols.items()})

    carried = list(dict.fromkeys([*order, *cols.values()]))
    last = (
        _hot(rows)
        .groupBy(*keys, CHUNK)
        .agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("__last"))
    )
    following = F.lead(CHUNK).over(Window.partitionBy(*keys).orderBy(CHUNK))
    extra = (
        last.withColumn(CHUNK, following)
        .where(F.col(CHUNK).isNotNull())
        .select(
            *keys, CHUNK, F.lit(True).alias(EXTRA),
            *[F.col("__last")[c].alias(c) for c in carried if c not in keys],
        )
    )
    both = rows.unionByName(extra, allowMissingColumns=True)
    w = _by_chunk(keys, order)
    return _finish(both.withColumns({new: F.lag(c).over(w) for new, c in cols.items()}))


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: dict[str, str],
    split_rows: int | None = None,
) -> DataFrame:
    """Add running sums over the rows up to and with the current one; nulls count as nothing.

    ``cols`` maps new name to column. ``order`` must be unique within the keys.
    """
    frame = (Window.unboundedPreceding, Window.currentRow)
    rows = _split(df, keys, order, split_rows)
    if rows is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumns({new: F.sum(c).over(w) for new, c in cols.items()})

    totals = _hot(rows).groupBy(*keys, CHUNK).agg(
        *[F.sum(c).alias(new) for new, c in cols.items()]
    )
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    extra = (
        totals.withColumn("__first", F.row_number().over(by_key) == 1)
        .withColumns({new: F.sum(new).over(before) for new in cols})
        .where(~F.col("__first"))
        .select(
            *keys, CHUNK, F.lit(True).alias(EXTRA),
            *[F.col(new).alias(f"__sum_{new}") for new in cols],
        )
    )
    both = rows.unionByName(extra, allowMissingColumns=True)
    w = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(F.col(EXTRA).desc(), *order)
        .rowsBetween(*frame)
    )
    sums = {
        new: F.sum(F.coalesce(F.col(f"__sum_{new}"), F.col(c))).over(w).cast(totals.schema[new].dataType)
        for new, c in cols.items()
    }
    return _finish(both.withColumns(sums)).drop(*[f"__sum_{new}" for new in cols])


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    split_rows: int | None = None,
) -> DataFrame:
    """Add the 1-based place of each row within its keys."""
    if split_rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    ones = df.withColumn("__one", F.lit(1).cast("bigint"))
    return with_running_sum(ones, keys, order, {name: "__one"}, split_rows).drop("__one")


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: int = 64,
    place: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows per key in the given order.

    Each map task keeps ``n`` rows per key before the shuffle, ``spread`` tasks share a key in the
    first round, and the second round sees at most ``spread * n`` rows per key. ``place`` names a
    column for the 1-based place of the row.

    Spark has that limit on the map side for ``n`` up to ``MAP_LIMIT``. Beyond it, name by ``by`` the
    number or time that ``order`` starts with, descending: rows below a level that at least ``n`` rows
    of the key reach are left out before the shuffle. ``df`` is then read three times.
    """
    if by is not None and n > MAP_LIMIT:
        df = _reaching_newest(df, keys, by, n)
    shared = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(spread)))
    first = Window.partitionBy(*keys, "__part").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    name = place or "__place"
    kept = (
        shared.withColumn(name, F.row_number().over(first))
        .where(F.col(name) <= n)
        .withColumn(name, F.row_number().over(second))
        .where(F.col(name) <= n)
        .drop("__part")
    )
    return kept if place else kept.drop(name)


def _reaching_newest(df: DataFrame, keys: Sequence[str], by: str, n: int) -> DataFrame:
    """``df`` without rows that cannot be among the ``n`` of their key with the highest ``by``.

    One aggregation, combined on the map side, gives each key's levels that a half, a quarter, an
    eighth and so on of its rows reach. The highest one is taken that ``n`` rows reach even if the
    level is off by its bound, and it counts only if ``n`` rows are found there.
    """
    levels = F.percentile_approx(by, [1 - 2.0**-k for k in range(1, _LEVELS + 1)], _FINE)
    rows = F.col("__rows")
    step = F.least(F.floor(F.log2(rows / (n + rows / _FINE))), F.lit(_LEVELS)).cast("int")
    names = [f"__hot_{k}" for k in keys]
    levelled = df.groupBy(*keys).agg(F.count(by).alias("__rows"), levels.alias("__levels")).where(rows > 2 * n)
    lows = cut(
        levelled.withColumn("__step", step)
        .where("__step >= 1")
        .select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.element_at("__levels", F.col("__step")).alias("__low")),
        "newest-levels",
    )
    if lows.isEmpty():
        return df
    reached = df.select(*dict.fromkeys([*keys, by])).join(lows, _same_keys(keys)).where(F.col(by) >= F.col("__low"))
    sure = cut(reached.groupBy(*names, "__low").count().where(F.col("count") >= n).drop("count"), "newest-sure")
    near = df.join(sure, _same_keys(keys), "left").where(F.col("__low").isNull() | (F.col(by) >= F.col("__low")))
    return near.drop("__low", *names)


def with_neighbour_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    name: str,
    before: int,
    after: int,
    split_rows: int | None = None,
    separator: str = "\n",
) -> DataFrame:
    """Add the texts of the rows around each row, joined in order.

    Every chunk receives copies of the ``before`` rows that precede it and the ``after`` rows that
    follow it, however many chunks back or ahead they lie.
    """
    frame = (-before, after)
    if not before and not after:
        return df.withColumn(name, F.coalesce(F.col(text), F.lit("")))
    rows = _split(df, keys, order, split_rows)
    if rows is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumn(name, F.array_join(F.collect_list(text).over(w), separator))
    both = rows.unionByName(
        _border_rows(_hot(rows), keys, order, text, before, after), allowMissingColumns=True
    )
    w = _by_chunk(keys, order).rowsBetween(*frame)
    around = F.array_join(F.collect_list(text).over(w), separator)
    return _finish(both.withColumn(name, around))


def _border_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, before: int, after: int
) -> DataFrame:
    """Up to ``before`` rows just before and ``after`` rows just after each chunk.

    One pass finds the first and the last rows of each chunk; a limit on the map side keeps the
    shuffle to those. Folding the lists along the key reaches over chunks with fewer rows.
    """
    carried = [c for c in dict.fromkeys([*order, text]) if c not in keys]
    at_end = F.col("__end")
    ends = F.explode(F.array(F.lit(False), F.lit(True))).alias("__end")
    place = F.row_number().over(
        Window.partitionBy(*keys, CHUNK, "__end").orderBy(
            *[F.when(~at_end, F.col(c)).asc() for c in order],
            *[F.when(at_end, F.col(c)).desc() for c in order],
        )
    )
    edges = (
        rows.select(*keys, CHUNK, *carried, ends)
        .withColumn("__place", place)
        .where(F.col("__place") <= max(before, after))
        .where(F.col("__place") <= F.when(at_end, before).otherwise(after))
        .groupBy(*keys, CHUNK)
        .agg(
            *[
                F.sort_array(
                    F.collect_list(F.when(side, F.struct(*carried)))
                ).alias(column)
                for column, side in (("__head", ~at_end), ("__tail", at_end))
            ]
        )
    )
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    lists = edges
    near = []
    if before:
        reach = F.flatten(F.collect_list("__tail").over(by_key.rowsBetween(-before, -1)))
        lists = lists.withColumn("__tails", reach)
        start = F.greatest(F.size("__tails") - (before - 1), F.lit(1))
        near.append(F.slice("__tails", start, F.lit(before)))
    if after:
        reach = F.flatten(F.collect_list("__head").over(by_key.rowsBetween(1, after)))
        lists = lists.withColumn("__heads", reach)
        near.append(F.slice("__heads", F.lit(1), F.lit(after)))
    return lists.withColumn("__near", F.explode(F.concat(*near))).select(
        *keys, CHUNK, F.lit(True).alias(EXTRA), *[F.col("__near")[c].alias(c) for c in carried]
    )
