"""Row-to-row operators on streams, right when rows arrive out of order.

Spark refuses ``lag`` on streams. A keyed state holds each row until the watermark has passed it,
then takes the rows of the key in time order, next to the last one taken. The inputs hold one row
per key and run, so a key's state is the rows of the delay and one more. The one more can come from
stored history when the stream starts, and goes again where a key's rows end.

Calls to the state cost far more than the rows they carry. Keys are therefore dealt to ``BUCKETS``
groups, each with one timer, and rows are held in packed blocks sorted by time. Final blocks are
merged as their time comes, so that Python holds a block or so per arrived buffer and not all rows.
"""

from __future__ import annotations

import heapq
import pickle
import sys
import zlib
from collections.abc import Iterator, Sequence
from datetime import timedelta
from decimal import ROUND_HALF_UP, Context, Decimal
from itertools import islice
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowaudit.streaming.sinks import use_keyed_state

# Workers get the processors with the job and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT = "__at_us"
BUCKET = "__bucket"
# Groups that keys are dealt to. A checkpoint holds its state under them, so the number is fixed.
BUCKETS = 1024
# Arrived rows that are sorted at once, and rows of a packed block.
BUFFER_ROWS = 10_000
BLOCK_ROWS = 250
_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def packed(rows: list) -> bytes:
    return zlib.compress(pickle.dumps(rows, 5), 1)


def unpacked(data: bytes) -> list:
    return pickle.loads(zlib.decompress(data))


class InTimeOrder(StatefulProcessor):
    """Hold rows until they are final and pass them on in order; subclasses say what comes out."""

    def __init__(self, row_schema: T.StructType, keys: Sequence[str], sort_by: Sequence[str], result: Sequence[str],
                 expire: timedelta | None = None):
        self.row_schema = row_schema
        self.names = row_schema.fieldNames()
        self.at = self.names.index(AT)
        self.key_at = [self.names.index(c) for c in keys]
        self.sort_at = [self.names.index(c) for c in sort_by]
        self.result = list(result)
        self.expire_us = None if expire is None else expire // timedelta(microseconds=1)

    def follow(self, before: tuple | None, row: tuple) -> tuple | None:
        """Output of ``row`` given the row before it, or None for no output."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "place bigint", "rows binary")
        self.blocks = handle.getListState("blocks", "low_us bigint, place bigint")
        self.last = handle.getMapState("last", "key string", self.row_schema)
        self.due = handle.getValueState("due", "at_ms bigint")

    def key_of(self, row: Sequence) -> str:
        """The key as text, as keys may hold nulls and lists; Spark takes -0.0 for 0.0."""
        values = [row[p] for p in self.key_at]
        return repr([v + 0.0 if isinstance(v, float) else v for v in values])

    def wait_for(self, at_us: int) -> None:
        at_ms = -(-at_us // 1000)
        if self.due.exists():
            current = self.due.get()[0]
            if current <= at_ms:
                return
            self.handle.deleteTimer(current)
        self.handle.registerTimer(at_ms)
        self.due.update((at_ms,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        values = tuple(initialState[c] for c in self.names)
        self.last.updateValue((self.key_of(values),), values)
        if self.expire_us is not None:
            self.wait_for(values[self.at] + self.expire_us)

    def _order(self, row: tuple) -> tuple:
        return (row[self.at], *[(row[p] is not None, row[p]) for p in self.sort_at])

    def _store(self, rows: list[tuple], place: int) -> list[tuple]:
        """Hold rows as blocks from ``place`` on; first time and place of each block."""
        rows.sort(key=self._order)
        stored = []
        for first in range(0, len(rows), BLOCK_ROWS):
            block = rows[first : first + BLOCK_ROWS]
            stored.append((block[0][self.at], place + len(stored)))
            self.held.updateValue((stored[-1][1],), (packed(block),))
        return stored

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = next(rows, None)
        if first is None:
            return iter(())
        pick = itemgetter(*[first.__fields__.index(c) for c in self.names])
        place = 1 + max((b[1] for b in self.blocks.get()), default=-1)
        fresh, buffer = [], [pick(first)]
        while buffer:
            buffer += map(pick, islice(rows, BUFFER_ROWS - len(buffer)))
            fresh += self._store(buffer, place + len(fresh))
            buffer = list(map(pick, islice(rows, 1)))
        self.blocks.appendList(fresh)
        self.wait_for(min(fresh)[0])
        return iter(())

    def take_ready(self, final_us: int) -> Iterator[tuple]:
        """The held rows that are final, in order; the others go on waiting."""
        waiting = sorted(tuple(b) for b in self.blocks.get())
        if not waiting:
            return
        opened, heads = 0, []
        while True:
            # A block is opened when the rows before its first have gone.
            while opened < len(waiting) and waiting[opened][0] <= min(final_us, heads[0][0][0] if heads else final_us):
                place = waiting[opened][1]
                rows = unpacked(self.held.getValue((place,))[0])
                self.held.removeKey((place,))
                heapq.heappush(heads, (self._order(rows[0]), opened, 0, rows))
                opened += 1
            if not heads or heads[0][0][0] > final_us:
                break
            _, n, k, rows = heads[0]
            yield rows[k]
            if k + 1 < len(rows):
                heapq.heapreplace(heads, (self._order(rows[k + 1]), n, k + 1, rows))
            else:
                heapq.heappop(heads)
        rest = [row for _, _, k, rows in heads for row in rows[k:]]
        waiting, places = waiting[opened:], max(place for _, place in waiting)
        waiting += self._store(rest, places + 1)
        self.blocks.clear()
        if waiting:
            self.blocks.put(waiting)
            self.wait_for(min(waiting)[0])

    def _ended(self, before: tuple | None, at_us: int) -> bool:
        return None not in (before, self.expire_us) and at_us - before[self.at] > self.expire_us

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        final_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        make = Row(*self.result)
        last = {k[0]: tuple(v) for k, v in self.last.iterator()}
        fresh = set()
        for row in self.take_ready(final_us):
            name = self.key_of(row)
            before = last.get(name)
            out = self.follow(None if self._ended(before, row[self.at]) else before, row)
            if out is not None:
                yield make(*out)
            last[name] = row
            fresh.add(name)
        for name in fresh:
            self.last.updateValue((name,), last[name])
        if self.expire_us is not None:
            self._end_keys(last, fresh, final_us)

    def _end_keys(self, last: dict[str, tuple], fresh: set[str], final_us: int) -> None:
        """Forget the keys whose last row is too long ago, and come back for the others."""
        ends = []
        for name, row in last.items():
            if name not in fresh and self._ended(row, final_us + 1):
                self.last.removeKey((name,))
            else:
                ends.append(max(row[self.at] + self.expire_us, final_us + 1))
        if ends:
            self.wait_for(min(ends))

    def close(self) -> None:
        pass


class RowDeltas(InTimeOrder):
    """Change of each counter since the key's row before."""

    def __init__(self, row_schema, keys, sort_by, result, changes: dict[str, T.StructField], expire=None):
        super().__init__(row_schema, keys, sort_by, result, expire)
        self.kept = [self.names.index(c) for c in self.result[: len(self.result) - len(changes)]]
        self.changes = [(self.names.index(c), field.dataType) for c, field in changes.items()]

    def follow(self, before, row):
        changes = [_change(before and before[p], row[p], kind) for p, kind in self.changes]
        return (*[row[p] for p in self.kept], *changes)


def _change(before, now, kind: T.DataType):
    """``now`` less ``before`` as the type Spark gives it, or None where that cannot hold it."""
    if before is None or now is None:
        return None
    if isinstance(kind, T.DecimalType):
        exact = Context(prec=100, rounding=ROUND_HALF_UP)
        change = exact.quantize(exact.subtract(now, before), Decimal(1).scaleb(-kind.scale))
        return change if len(change.as_tuple().digits) <= kind.precision else None
    change = now - before
    bits = _BITS.get(kind.simpleString())
    return None if bits and not -(1 << bits - 1) <= change < 1 << bits - 1 else change


class Changes(InTimeOrder):
    """Rows seen first for their key, or whose version differs from the row before."""

    def __init__(self, row_schema, keys, sort_by, result, version: str, expire=None):
        super().__init__(row_schema, keys, sort_by, result, expire)
        self.kept = [self.names.index(c) for c in self.result]
        self.version = self.names.index(version)

    def follow(self, before, row):
        if before is not None and before[self.version] == row[self.version]:
            return None
        return tuple(row[p] for p in self.kept)


def _stamps(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.TimestampType)]


def encoded(df: DataFrame, keys: Sequence[str], ts: str, delay: str | None) -> DataFrame:
    """Rows as they go to the processors, with instants as microseconds and the bucket of their key.

    Instants would take the time zone of the worker on their way through Python. The event time
    column stays beside its number, because Spark recognises late rows by it. A row without time
    has no place in the order of a stream, as the rows after it may be out already; such rows are
    those of ``time_rejects``.
    """
    use_keyed_state(df.sparkSession)
    if delay is not None:
        df = df.withWatermark(ts, delay)
    return _as_numbers(df, ts).withColumn(BUCKET, _bucket(keys))


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _as_numbers(df: DataFrame, ts: str) -> DataFrame:
    others = {c: F.unix_micros(c) for c in _stamps(df.schema) if c != ts}
    return df.where(F.col(ts).isNotNull()).withColumns({**others, AT: F.unix_micros(ts)})


def _newest(history: DataFrame | None, keys: Sequence[str], ts: str, sort_by: Sequence[str], held: T.StructType):
    """The last row of each key of a stored result, grouped as the state a stream starts from."""
    if history is None:
        return None
    rows = _as_numbers(history, ts)
    last = F.max_by(F.struct(*held.fieldNames()), F.struct(AT, *sort_by)).alias("__last")
    newest = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(last)
    fields = [F.col("__last")[f.name].cast(f.dataType).alias(f.name) for f in held]
    return newest.select(*fields).withColumn(BUCKET, _bucket(keys)).groupBy(BUCKET)


def held_schema(rows: DataFrame, ts: str) -> T.StructType:
    return T.StructType([f for f in rows.schema if f.name not in (ts, BUCKET)])


def result_schema(df: DataFrame, ts: str, added: Sequence[T.StructField] = ()) -> T.StructType:
    stamps = _stamps(df.schema)
    fields = [
        T.StructField(AT if f.name == ts else f.name, T.LongType() if f.name in stamps else f.dataType)
        for f in df.schema
    ]
    return T.StructType([*fields, *added])


def decoded(out: DataFrame, df: DataFrame, ts: str, added: Sequence[str] = ()) -> DataFrame:
    stamps = _stamps(df.schema)
    return out.withColumnRenamed(AT, ts).select(
        *[F.timestamp_micros(c).alias(c) if c in stamps else c for c in df.columns], *added
    )


def time_rejects(df: DataFrame, ts: str = "batch_ts") -> DataFrame:
    """The rows without a time, which ``delta_by_row_stream`` and ``emit_on_change_stream`` leave out.

    A stream of its own, kept without state: drain it beside the other, and no row is lost.
    """
    return df.where(F.col(ts).isNull())


def delta_by_row_stream(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str = "batch_ts",
    delay: str | None = None,
    sort_by: Sequence[str] = (),
    suffix: str = "_sli",
    history: DataFrame | None = None,
    expire: timedelta | None = None,
) -> DataFrame:
    """Streaming form of ``delta_by_row``; rows come out once the watermark has passed them.

    A change has the type it has in the batch form. Rows without a time are in ``time_rejects``.
    With ``history``, stored rows with the columns of ``df``, the first change of a key is that
    since its last stored row; it is read once, when the stream is started for the first time.
    With ``expire``, a row more than that long after its key's last counts as the key's first, and
    the state of a key goes once the watermark is so far.
    """
    rows = encoded(df, keys, ts, delay)
    kinds = df.select(*[F.try_subtract(c, c).alias(c) for c in cols]).schema
    changes = {f.name: T.StructField(f"{f.name}{suffix}", f.dataType) for f in kinds}
    result = result_schema(df, ts, list(changes.values()))
    held = held_schema(rows, ts)
    processor = RowDeltas(held, keys, sort_by, result.fieldNames(), changes, expire)
    start = _newest(history, keys, ts, sort_by, held)
    out = rows.groupBy(BUCKET).transformWithState(processor, result, "append", "eventTime", start)
    return decoded(out, df, ts, [c.name for c in changes.values()])


def emit_on_change_stream(
    df: DataFrame,
    keys: Sequence[str] = ("type_name",),
    version: str = "created_date",
    ts: str = "batch_ts",
    delay: str | None = None,
    sort_by: Sequence[str] = (),
    history: DataFrame | None = None,
    expire: timedelta | None = None,
) -> DataFrame:
    """Streaming form of ``emit_on_change``; rows without a time are in ``time_rejects``.

    ``history`` and ``expire`` are those of ``delta_by_row_stream``; a key that comes back after
    ``expire`` is emitted again.
    """
    rows = encoded(df, keys, ts, delay)
    result = result_schema(df, ts)
    held = held_schema(rows, ts)
    processor = Changes(held, keys, sort_by, result.fieldNames(), version, expire)
    start = _newest(history, keys, ts, sort_by, held)
    out = rows.groupBy(BUCKET).transformWithState(processor, result, "append", "eventTime", start)
    return decoded(out, df, ts)


def delta_by_run_stream(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    ts: str = "batch_ts",
    previous: str = "previous_ts",
    delay: str = "1 hour",
    suffix: str = "_sli",
) -> DataFrame:
    """Streaming form of ``delta_by_run`` for rows that carry the start of their run before.

    The stream joins itself on key and run, so arrival order does not matter and the rows of a
    busy key spread over its runs. ``delay`` must exceed the gap between two runs; a row without
    predecessor comes out when the watermark has passed the predecessor's time.
    """
    use_keyed_state(df.sparkSession)
    later = df.withWatermark(ts, delay)
    before = later.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col(ts).alias("__ts"),
        *[F.col(c).alias(f"__{c}") for c in cols],
    )
    # A null key would stay in the state; the epoch is behind every watermark.
    same = F.coalesce(F.col(previous), F.timestamp_seconds(F.lit(0))) == F.col("__ts")
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    joined = later.join(before, same, "left_outer")
    return joined.select(
        *df.columns,
        *[F.try_subtract(F.col(c), F.col(f"__{c}")).alias(f"{c}{suffix}") for c in cols],
    )
