"""Words and word hashes of many texts at once, on the bytes of an Arrow column.

Words are runs of bytes other than space and 0x09-0x0D. These bytes never occur inside a longer
UTF-8 sequence, so cutting bytes gives the same words as cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; the working arrays take about forty times as much.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False

_RADIX = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection, so equal only for equal values)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables() -> list[np.ndarray]:
    """Powers of the radix and of its inverse modulo 2^64, for every place in a slice."""
    if not _powers:
        for base in (_RADIX, pow(_RADIX, -1, 1 << 64)):
            steps = np.full(SLICE_BYTES + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 places where they start and end; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    places = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def slices(places: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most a slice of bytes; a longer text stands alone."""
    first, rows = 0, len(places) - 1
    while first < rows:
        last = int(np.searchsorted(places, places[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def parts_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of the columns are a few slices long; a longer row stands alone.

    Between batches, memory that Arrow holds but does not use goes back to the system: the worker
    shares an executor's memory with others.
    """
    for batch in batches:
        places = sum(text_bytes(batch.column(c))[1] for c in columns)
        low, n = 0, len(batch)
        while low < n:
            high = int(np.searchsorted(places, places[low] + 4 * SLICE_BYTES, side="right")) - 1
            high = min(max(high, low + 1), n)
            yield batch.slice(low, high - low)
            low = high
        pa.default_memory_pool().release_unused()


def _spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; ``cuts`` are places where a word may not go on."""
    inside = IN_WORD[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = cuts[(cuts > 0) & (cuts <= len(data))] - 1
    after[last] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def _range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges of one slice, from a running sum."""
    powers, inverse = _power_tables()
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and the n + 1 places of each text's words.

    ``data`` may be of any length: a text longer than a slice is read in pieces, and a word cut by
    a piece is put together again.
    """
    hashes, counts = [], []
    for first, last in slices(places):
        low, high = int(places[first]), int(places[last])
        if high - low <= SLICE_BYTES:
            part = LOWER[data[low:high]]
            cuts = places[first : last + 1] - low
            starts, ends = _spans(part, cuts)
            raw = _range_hashes(part, starts, ends)
            hashes.append(mix(raw ^ mix((ends - starts).astype(np.uint64))))
            counts.append(np.diff(np.searchsorted(starts, cuts)))
        else:
            found = _long_word_hashes(data[low:high])
            hashes.append(found)
            counts.append(np.array([len(found)]))
    total = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), ends


def _long_word_hashes(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length."""
    raws, lengths = [], []
    open_raw, open_length = 0, 0
    for low in range(0, len(data), SLICE_BYTES):
        part = LOWER[data[low : low + SLICE_BYTES]]
        starts, ends = _spans(part, np.zeros(0, np.int64))
        raw, length = _range_hashes(part, starts, ends), ends - starts
        goes_on = bool(IN_WORD[part[0]])
        if open_length and goes_on:
            # The carried part stands before the first word of this piece.
            scale = pow(_RADIX, open_length, 1 << 64)
            raw[0] = (open_raw + int(raw[0]) * scale) & _MASK
            length[0] += open_length
        elif open_length:
            raws.append(np.array([open_raw], np.uint64))
            lengths.append(np.array([open_length]))
        open_raw = open_length = 0
        if len(raw) and IN_WORD[part[-1]]:
            open_raw, open_length = int(raw[-1]), int(length[-1])
            raw, length = raw[:-1], length[:-1]
        raws.append(raw)
        lengths.append(length)
    if open_length:
        raws.append(np.array([open_raw], np.uint64))
        lengths.append(np.array([open_length]))
    return mix(np.concatenate(raws) ^ mix(np.concatenate(lengths).astype(np.uint64)))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words make one run, none makes none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n - size + 1])
    return np.unique(out)
