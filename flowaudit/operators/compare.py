"""Source and target counts: by kind of change, side by side, and since the run before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowaudit.functions.ratios import side_difference
from flowaudit.operators.ordered import with_previous, with_running_sum
from flowaudit.operators.runs import link_runs
from flowaudit.schemas import BATCH_DATE, OP_KINDS, counter_name

# Operation code of each counted kind.
OP_CODES = {
    "deletes": "DELETE",
    "ddls": "DDL",
    "pkupdates": "PKUPDATE",
    "updates": "UPDATE",
    "inserts": "INSERT",
}

TWO_SIDES = ("src", "tgt")


def op_counts(
    changes: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    prefix: str = "num_of_",
    codes: Mapping[str, str] = OP_CODES,
) -> DataFrame:
    """Count the five kinds of change per key."""
    return changes.groupBy(*keys).agg(
        *[F.count_if(F.col(op) == codes[k]).alias(f"{prefix}{k}") for k in OP_KINDS]
    )


def side_counts(
    changes: DataFrame,
    keys: Sequence[str],
    side: str = "side",
    op: str = "op",
    codes: Mapping[str, str] = OP_CODES,
) -> DataFrame:
    """Both sides' counts in one aggregation, for a feed that carries both sides.

    A side without any row for a key gets null counts, as in an outer join of the two sides.
    """
    one = F.lit(1).cast("bigint")
    counts = [
        F.sum(F.when(F.col(side) == s, F.when(F.col(op) == codes[k], one).otherwise(0)))
        .alias(counter_name(s, k))
        for k in OP_KINDS
        for s in TWO_SIDES
    ]
    return changes.groupBy(*keys).agg(*counts)


def pair_sides(
    source: DataFrame,
    target: DataFrame,
    mapping: DataFrame | None = None,
    on: Sequence[str] = ("app_name", "batch_ts"),
) -> DataFrame:
    """Put counts of source tables beside those of their target tables, one row per pair.

    ``source`` has ``source_name`` and ``target`` has ``target_name``, both with one row per key.
    ``mapping`` names per app the pairs that belong together; without it, and for names it does
    not hold, a table pairs with the one of the same name.
    """
    if mapping is None:
        left = source
        right = target.withColumnRenamed("target_name", "source_name")
        paired = left.join(right, [*on, "source_name"], "full_outer")
        return paired.withColumn("target_name", F.col("source_name"))
    links = mapping.select("app_name", "source_name", "target_name").distinct()
    left = source.join(links, ["app_name", "source_name"], "left").withColumn(
        "target_name", F.coalesce("target_name", "source_name")
    )
    right = target.join(links, ["app_name", "target_name"], "left").withColumn(
        "source_name", F.coalesce("source_name", "target_name")
    )
    return left.join(right, [*on, "source_name", "target_name"], "full_outer")


def diff_counts(paired: DataFrame) -> DataFrame:
    """Add source minus target per kind of change; a missing side counts as zero."""
    return paired.withColumns(
        {
            counter_name("diff", k): side_difference(
                F.col(counter_name("src", k)), F.col(counter_name("tgt", k))
            )
            for k in OP_KINDS
        }
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: str = "batch_ts",
    split_rows: int | None = None,
) -> DataFrame:
    """Turn per-run counts into counters that grow from run to run."""
    renamed = df.withColumnsRenamed({c: f"__{c}" for c in cols})
    totals = with_running_sum(renamed, keys, [order], {c: f"__{c}" for c in cols}, split_rows)
    return totals.drop(*[f"__{c}" for c in cols])


def _deltas(cols: Sequence[str], suffix: str, usable: Column) -> dict[str, Column]:
    return {
        f"{c}{suffix}": F.when(usable, F.try_subtract(F.col(c), F.col(f"__prev_{c}")))
        for c in cols
    }


def delta_by_row(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: str = "batch_ts",
    suffix: str = "_sli",
    split_rows: int | None = None,
) -> DataFrame:
    """Change of each counter since the key's row before, across any skipped runs."""
    wanted = {f"__prev_{c}": c for c in cols}
    before = with_previous(df, keys, [order], wanted, split_rows)
    deltas = _deltas(cols, suffix, F.lit(True))
    return before.withColumns(deltas).drop(*[f"__prev_{c}" for c in cols])


def delta_by_run(
    df: DataFrame,
    runs: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: str = "batch_ts",
    suffix: str = "_sli",
    chunk_unit: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Change of each counter since the run before; null where the key has no row in that run.

    ``by`` names the columns, of both inputs, that keep a run history of their own (the cluster);
    they are part of the key.

    A key's row of the run before can only be the row just before it in time, so one window does
    the work of a self-join: one scan, one shuffle and one sort. Keys hold one row per run. Where
    even that is long, ``chunk_unit`` (``"day"``, ``"month"``) cuts the window: a row whose next
    run falls into another chunk is copied there, which the run history tells without a look at
    the data.
    """
    linked = df.join(link_runs(runs, order, by), [*by, order], "left")
    part: list[str] = [*dict.fromkeys([*by, *keys])]
    own = F.lit(True)
    if chunk_unit is not None:
        here = F.date_trunc(chunk_unit, F.col(order))
        there = F.date_trunc(chunk_unit, F.col("following_ts"))
        homes = F.when(here != there, F.array(here, there)).otherwise(F.array(here))
        linked = linked.withColumn("__chunk", F.explode(homes))
        part.append("__chunk")
        own = F.col("__chunk") == here
    w = Window.partitionBy(*part).orderBy(order)
    before = linked.withColumns(
        {
            "__prev_ts": F.lag(order).over(w),
            **{f"__prev_{c}": F.lag(c).over(w) for c in cols},
        }
    ).where(own)
    usable = F.col("__prev_ts") == F.col("previous_ts")
    return before.withColumns(_deltas(cols, suffix, usable)).drop(
        "__chunk", "__prev_ts", "previous_ts", "following_ts", *[f"__prev_{c}" for c in cols]
    )


def delta_for_run(
    df: DataFrame,
    batch_ts: datetime,
    previous_ts: datetime | None,
    keys: Sequence[str],
    cols: Sequence[str],
    order: str = "batch_ts",
    suffix: str = "_sli",
) -> DataFrame:
    """``delta_by_run`` for a single run, as a poller needs it: reads that run and the one before.

    On a stored table the filters prune to the days of the two runs. The two rows of a key meet in
    one aggregation, combined on the map side.
    """
    runs = [F.lit(t).cast("timestamp") for t in (previous_ts, batch_ts) if t is not None]
    rows = df.where(F.col(order).isin(*runs))
    if BATCH_DATE in df.columns:
        rows = rows.where(F.col(BATCH_DATE).isin(*[F.to_date(t) for t in runs]))
    now = F.col(order) == F.lit(batch_ts).cast("timestamp")
    paired = rows.groupBy(*keys).agg(
        F.max(now).alias("__now"),
        F.max(~now).alias("__before"),
        *[F.max(F.when(now, F.col(c))).alias(c) for c in cols],
        *[F.max(F.when(~now, F.col(c))).alias(f"__prev_{c}") for c in cols],
    ).where("__now")
    elapsed = None if previous_ts is None else int((batch_ts - previous_ts).total_seconds())
    return (
        paired.withColumns(
            {
                order: F.lit(batch_ts).cast("timestamp"),
                "timesincelastbatch": F.lit(elapsed).cast("bigint"),
                **_deltas(cols, suffix, F.col("__before")),
            }
        )
        .drop("__now", "__before", *[f"__prev_{c}" for c in cols])
    )


def with_reset_flag(
    df: DataFrame, cols: Sequence[str], suffix: str = "_sli", name: str = "was_reset"
) -> DataFrame:
    """Tell whether any counter went down since the run before; changes are never clamped."""
    fell = [F.coalesce(F.col(f"{c}{suffix}") < 0, F.lit(False)) for c in cols]
    return df.withColumn(name, reduce(or_, fell))


def delta_of_diff(df: DataFrame, suffix: str = "_sli") -> DataFrame:
    """Add source delta minus target delta per kind; null if either is null."""
    return df.withColumns(
        {
            counter_name("diff", k, suffix): F.try_subtract(
                F.col(counter_name("src", k, suffix)), F.col(counter_name("tgt", k, suffix))
            )
            for k in OP_KINDS
        }
    )
