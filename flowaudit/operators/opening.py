"""Load batches that open with their first event.

A batch opens with the first event after the one before it closed, and closes when it holds
``max_events`` events or ``every_s`` seconds after it opened, whichever comes first. Where a batch ends
depends on where it opened, so a plain pass over a key would go from batch to batch in one task. Hot
keys are instead cut into chunks (``operators.ordered``), and what a chunk does is composed:

1. Whatever came before, the first batch that opens in a chunk opens within one batch of the chunk's
   start. For each of those places a chunk computes, all at once and on its own, the batch that is open
   at its end and how many opened.
2. These short tables are folded along the key, which tells every chunk what is open at its start.
3. Each chunk goes through its batches from there.

Steps 1 and 3 run per chunk, step 2 on at most one batch of rows per chunk. Python runs inside tasks on
the times of a chunk only; all other columns stay in the engine.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowaudit.operators.ordered import CHUNK, SPLIT_ROWS, _split

_NEVER = np.iinfo(np.int64).max


def open_batches(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    max_events: int | None = None,
    every_s: int | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Assign events to batches that open with their first event.

    Adds ``batch_start`` (time of the event that opened the batch) and ``batch_no`` (0-based, per key).
    ``order`` starts with ``ts`` and must be unique within the keys. An event exactly ``every_s`` seconds
    after the opening belongs to the next batch. Events without a time belong to no batch and get nulls.
    """
    if max_events is None and every_s is None:
        raise ValueError("give max_events, every_s or both")
    most = _NEVER if max_events is None else max_events
    micros = _NEVER if every_s is None else every_s * 1_000_000
    timed = events.where(F.col(ts).isNotNull())
    split = _split(timed, keys, order, split_rows)
    if split is None:
        split = timed.withColumn(CHUNK, F.lit(None).cast("bigint"))
    within = [*keys, CHUNK]
    rows = split.select(
        *events.columns,
        F.coalesce(CHUNK, F.lit(0)).cast("bigint").alias(CHUNK),
        F.row_number().over(Window.partitionBy(*within).orderBy(*order)).cast("bigint").alias("__at"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("__us"),
    )
    times = rows.select(*within, "__at", "__us")
    of_key = [times.schema[k] for k in keys]

    def schema(*more: str) -> str:
        return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in of_key], f"`{CHUNK}` bigint", *more])

    steps = times.groupBy(*within).applyInArrow(
        _chunk_steps(within, most, micros),
        schema("entry bigint", "us bigint", "last_us bigint", "seen bigint", "opened bigint", "rows bigint"),
    )
    carried = steps.groupBy(*keys).applyInArrow(
        _fold(within, most, micros), schema("open_us bigint", "seen bigint", "opened bigint")
    )
    opened = (
        times.groupBy(*within)
        .cogroup(carried.groupBy(*within))
        .applyInArrow(_openings(within, most, micros), schema("__at bigint", "__start bigint", "__no bigint"))
    )
    both = rows.withColumn("__opening", F.lit(False)).unionByName(
        opened.withColumn("__opening", F.lit(True)), allowMissingColumns=True
    )
    latest = Window.partitionBy(*within).orderBy("__at", F.desc("__opening"))
    start = F.last("__start", ignorenulls=True).over(latest)
    number = F.last("__no", ignorenulls=True).over(latest)
    kind = events.schema[ts].dataType
    assigned = both.select(
        *events.columns, "__opening", F.timestamp_micros(start).cast(kind).alias("batch_start"), number.alias("batch_no")
    )
    without = events.where(F.col(ts).isNull()).select(
        "*", F.lit(None).cast(kind).alias("batch_start"), F.lit(None).cast("bigint").alias("batch_no")
    )
    return assigned.where(~F.col("__opening")).drop("__opening").unionByName(without)


def _after(us: np.ndarray, at: int, opened_us: int, seen: int, most: int, micros: int) -> int:
    """Place of the first event from ``at`` on that is not in a batch opened at ``opened_us`` with ``seen`` events."""
    by_time = len(us) if micros == _NEVER else int(np.searchsorted(us, opened_us + micros, side="left"))
    return min(max(by_time, at), at + most - seen if most != _NEVER else len(us), len(us))


def _tagged(rows: pa.Table, within: Sequence[str], columns: dict[str, np.ndarray]) -> pa.Table:
    """Columns beside the key of the first row."""
    n = len(next(iter(columns.values())))
    first = rows.select(within).slice(0, 1).take(pa.array(np.zeros(n, dtype=np.int64)))
    for name, values in columns.items():
        first = first.append_column(name, pa.array(values, pa.int64()))
    return first


def _chunk_steps(within: Sequence[str], most: int, micros: int):
    """For each place where the first batch of a chunk may open, the batch open at its end."""

    def run(rows: pa.Table) -> pa.Table:
        us = np.sort(rows["__us"].to_numpy())
        n = len(us)
        at = np.arange(n)
        following = np.full(n, n) if micros == _NEVER else np.searchsorted(us, us + micros, side="left")
        if most != _NEVER:
            following = np.minimum(following, at + most)
        # From the end, the last batch reached from each place and the number that open on the way.
        last, opened = at.copy(), np.ones(n, dtype=np.int64)
        nexts = following.tolist()
        lasts, counts = last.tolist(), opened.tolist()
        for i in range(n - 1, -1, -1):
            j = nexts[i]
            if j < n:
                lasts[i] = lasts[j]
                counts[i] += counts[j]
        reach = n if micros == _NEVER else int(np.searchsorted(us, us[0] + micros, side="left")) + 1
        reach = min(reach, n, most + 1 if most != _NEVER else n)
        last = np.array(lasts[:reach])
        return _tagged(
            rows,
            within,
            {
                "entry": np.arange(reach),
                "us": us[:reach],
                "last_us": us[last],
                "seen": n - last,
                "opened": np.array(counts[:reach]),
                "rows": np.full(reach, n),
            },
        )

    return run


def _fold(within: Sequence[str], most: int, micros: int):
    """What is open at the start of each chunk: time of its opening, events in it, batches opened so far."""

    def run(steps: pa.Table) -> pa.Table:
        steps = steps.sort_by([(CHUNK, "ascending"), ("entry", "ascending")])
        chunk = steps[CHUNK].to_numpy()
        us, last_us, seen, opened, rows = (steps[c].to_numpy() for c in ("us", "last_us", "seen", "opened", "rows"))
        firsts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
        open_us, open_seen, total = 0, -1, 0
        out = []
        for low, high in zip(firsts, [*firsts[1:], len(chunk)]):
            out.append((open_us, open_seen, total))
            entry = 0 if open_seen < 0 else _after(us[low:high], 0, open_us, open_seen, most, micros)
            if entry < high - low:
                at = low + entry
                open_us, open_seen, total = int(last_us[at]), int(seen[at]), total + int(opened[at])
            else:
                open_seen += int(rows[low])
        kept = steps.select(within).take(pa.array(firsts))
        for name, values in zip(("open_us", "seen", "opened"), zip(*out)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept

    return run


def _openings(within: Sequence[str], most: int, micros: int):
    """Every place of a chunk that a batch opens at, and its first place with the batch open there."""

    def run(rows: pa.Table, carried: pa.Table) -> pa.Table:
        us = np.sort(rows["__us"].to_numpy())
        open_us, seen, number = (carried[c][0].as_py() for c in ("open_us", "seen", "opened"))
        places, starts, numbers = [], [], []
        at = 0
        if seen >= 0:
            at = _after(us, 0, open_us, seen, most, micros)
            if at > 0:
                places.append(1)
                starts.append(open_us)
                numbers.append(number - 1)
        while at < len(us):
            places.append(at + 1)
            starts.append(int(us[at]))
            numbers.append(number)
            number += 1
            at = _after(us, at, int(us[at]), 0, most, micros)
        return _tagged(rows, within, {"__at": places, "__start": starts, "__no": numbers})

    return run
