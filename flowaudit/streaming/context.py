"""Error entries of a stream of log entries with the lines around them, across micro-batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from flowaudit.operators.logs import ERROR_LEVELS
from flowaudit.streaming import ordered
from flowaudit.streaming.ordered import InTimeOrder, packed, unpacked

# Workers get the processor with the job and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

class Context(InTimeOrder):
    """Entries of some levels, each with its neighbours in time order.

    Besides the rows of the delay the state holds each key's last lines, at most ``before + after``.
    An entry is open until ``after`` lines have followed it or the watermark is past its patience.
    """

    def __init__(self, row_schema, keys, sort_by, result, before: int, after: int, patience_us: int,
                 level: str, levels: Sequence[str], text: str):
        super().__init__(row_schema, keys, sort_by, result)
        self.before, self.after, self.patience_us = before, after, patience_us
        self.levels = frozenset(levels)
        self.level, self.text = self.names.index(level), self.names.index(text)
        self.kept = [self.names.index(c) for c in self.result[:-1]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.recent = handle.getMapState("recent", "key string", "lines binary")

    def _due_us(self, line: list) -> int:
        return line[self.at] + self.patience_us

    def _around(self, lines: list[list], place: int, final_us: int | None) -> str | None:
        """The text around a line, or None while lines that belong to it may still come."""
        due_us = self._due_us(lines[place])
        behind = [r for r in lines[place + 1 : place + 1 + self.after] if r[self.at] <= due_us]
        passed = (final_us is not None and final_us >= due_us) or lines[-1][self.at] > due_us
        if len(behind) < self.after and not passed:
            return None
        shown = [*lines[max(0, place - self.before) : place + 1], *behind]
        return "\n".join(r[self.text] for r in shown if r[self.text] is not None)

    def _closed(self, lines: list[list], final_us: int | None = None) -> Iterator[tuple]:
        """Output of the open lines that nothing more belongs to; lines no one needs go.

        The last value of a line says if it is open, and ``final_us`` that no line before it comes.
        """
        first_open = len(lines)
        for place, line in enumerate(lines):
            if not line[-1]:
                continue
            around = self._around(lines, place, final_us)
            if around is None:
                first_open = min(first_open, place)
                continue
            line[-1] = False
            yield (*[line[p] for p in self.kept], around)
        del lines[: max(0, first_open - self.before)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        final_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        make = Row(*self.result)
        recent = {k[0]: unpacked(v[0]) for k, v in self.recent.iterator()}
        waits = {k for k, lines in recent.items() if any(line[-1] for line in lines)}
        fresh = set(waits)
        for row in self.take_ready(final_us):
            name = self.key_of(row)
            lines = recent.setdefault(name, [])
            lines.append([*row, row[self.level] in self.levels])
            fresh.add(name)
            if lines[-1][-1]:
                waits.add(name)
            if name in waits:
                yield from (make(*out) for out in self._closed(lines))
                if not any(line[-1] for line in lines):
                    waits.discard(name)
            else:
                del lines[: max(0, len(lines) - self.before)]
        for name in waits:
            yield from (make(*out) for out in self._closed(recent[name], final_us))
        due = [self._due_us(line) for name in waits for line in recent[name] if line[-1]]
        if due:
            self.wait_for(min(due))
        for name in fresh:
            self.recent.updateValue((name,), (packed(recent[name]),))


def context_stream(
    entries: DataFrame,
    before: int,
    after: int,
    keys: Sequence[str] = ("server",),
    ts: str = "log_date",
    sort_by: Sequence[str] = ("value",),
    delay: str | None = None,
    patience: timedelta = timedelta(hours=1),
    levels: Sequence[str] = ERROR_LEVELS,
    level: str = "log_level",
    text: str = "value",
    name: str = "contextbuffertext",
) -> DataFrame:
    """Streaming form of ``with_context`` and ``errors_only``, whatever the micro-batches.

    Lines of a key count in order of ``ts`` and ``sort_by``. An entry comes out once ``after``
    lines have followed it, or without those that come more than ``patience`` after it, so the
    result does not depend on when files land. Entries without time are in ``ordered.time_rejects``;
    entries later than ``delay`` are left out by Spark. All lines of a key pass through one task.
    """
    rows = ordered.encoded(entries, keys, ts, delay)
    result = ordered.result_schema(entries, ts, [T.StructField(name, T.StringType())])
    held = ordered.held_schema(rows, ts)
    patience_us = patience // timedelta(microseconds=1)
    processor = Context(
        held, keys, sort_by, result.fieldNames(), before, after, patience_us, level, levels, text
    )
    out = rows.groupBy(ordered.BUCKET).transformWithState(processor, result, "append", "eventTime")
    return ordered.decoded(out, entries, ts, [name])
