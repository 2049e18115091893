"""Ids of many texts from their distinct segments.

A segment is a stretch of text that neither the byte-level scheme of the tokenizers library nor a
merge-type piece model encodes across: texts are cut before a run of spaces or line ends that follows
a character surely not white space. Segments recur, so Arrow numbers the distinct ones of a block of
texts, the library encodes those only, many joined to one string, and a text's ids are its
segments' ids taken in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of segments that are joined to one string for the library; longer strings take it more time a byte.
_JOINED = 1 << 11
#: Segments kept for the blocks to come, and the bytes of the longest worth keeping.
REMEMBERED, _SHORT = 1_000_000, 64
_GAP = np.zeros(256, dtype=bool)
_GAP[[10, 32]] = True
_PRINTED = np.zeros(256, dtype=bool)
_PRINTED[33:127] = True
#: First bytes of two-byte characters none of which is white space.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[0xC3:0xE0] = True


class Segments(NamedTuple):
    """Distinct segments, the number of each one in text order, and the n + 1 places of each text's."""

    distinct: pa.LargeStringArray
    numbers: np.ndarray
    places: np.ndarray


def _solid(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely not white space."""
    last = data[ends - 1]
    two = np.zeros(len(ends), dtype=bool)
    at = np.flatnonzero((last >= 128) & (ends >= 2))
    two[at] = _LEAD[data[ends[at] - 2]]
    return _PRINTED[last] | two


def segments(data: np.ndarray, places: np.ndarray, at_lines: bool = True) -> Segments:
    """Cut texts, given as their bytes and the n + 1 places where they start and end."""
    gaps = np.flatnonzero(_GAP[data] if at_lines else data == 32)
    gaps = gaps[gaps > 0]
    cut = np.zeros(len(data), dtype=bool)
    cut[gaps[_solid(data, gaps)]] = True
    cut[places[:-1][np.diff(places) > 0]] = True
    cuts = np.flatnonzero(cut)
    offsets = np.append(cuts, len(data)).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    coded = found.dictionary_encode()
    return Segments(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(cuts, places))


def bytes_of(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array without nulls and the n + 1 places of its texts."""
    buffers = column.buffers()
    places = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def row_ranges(places: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes in order; a longer text stands alone."""
    low, n = 0, len(places) - 1
    while low < n:
        high = int(np.searchsorted(places, places[low] + most, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


class Vocabulary(NamedTuple):
    """An encoder of many strings, the bytes of each id, and the bytes it puts in front of a string."""

    encode: Callable[[Sequence[str]], Sequence[Sequence[int]]]
    entries: pa.LargeBinaryArray
    added: int

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(np.frombuffer(self.entries.buffers()[1], dtype=np.int64)[: len(self.entries) + 1])


def segment_ids(distinct: pa.LargeStringArray, vocabulary: Vocabulary) -> tuple[pa.LargeListArray, np.ndarray]:
    """Ids of each segment, and whether the bytes of its ids are the segment's own.

    Many segments are encoded as one string after a full stop, and the ids are dealt back by their
    bytes. Segments that end in what may be white space end a text and are encoded alone, as are
    those of a string whose bytes do not come back.
    """
    data, places = bytes_of(distinct)
    n = len(distinct)
    if not n:
        return pa.array([], pa.large_list(pa.int32())), np.zeros(0, bool)
    sizes = vocabulary.sizes
    opens = _GAP[data[places[:-1]]]
    joined = np.flatnonzero(opens & _solid(data, places[1:]))
    alone = [np.flatnonzero(~(opens & _solid(data, places[1:])))]
    parts: list[np.ndarray] = []
    order: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    if len(joined):
        text, ends = bytes_of(distinct.take(pa.array(joined)))
        firsts = np.unique(np.searchsorted(ends[:-1], np.arange(0, ends[-1], _JOINED)))
        firsts = np.append(firsts[firsts < len(joined)], len(joined))
        raw = text.tobytes()
        found = vocabulary.encode(["." + raw[a:b].decode() for a, b in zip(ends[firsts[:-1]], ends[firsts[1:]])])
        lead = 1 + vocabulary.added
        for k, ids in enumerate(found):
            low, high = firsts[k], firsts[k + 1]
            ids = np.asarray(ids, dtype=np.int32)
            stops = np.cumsum(sizes[ids])
            wanted = ends[low : high + 1] - ends[low] + lead
            at = np.searchsorted(stops, wanted)
            if len(stops) and stops[-1] == wanted[-1] and (stops[at] == wanted).all():
                parts.append(ids[at[0] + 1 :])
                counts.append(np.diff(at))
                order.append(joined[low:high])
            else:
                alone.append(joined[low:high])
    rest = np.concatenate(alone)
    prefixes = ["." if opens[i] else "" for i in rest]
    texts = distinct.take(pa.array(rest)).to_pylist()
    for prefix, ids in zip(prefixes, vocabulary.encode([p + t for p, t in zip(prefixes, texts)]) if texts else []):
        ids = np.asarray(ids, dtype=np.int32)
        if prefix:
            ids = ids[int(np.searchsorted(np.cumsum(sizes[ids]), 1 + vocabulary.added)) + 1 :]
        parts.append(ids)
        counts.append(np.array([len(ids)]))
    order.append(rest)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat))
    lists = lists.take(pa.array(np.argsort(np.concatenate(order), kind="stable")))
    return lists, _same_bytes(distinct, lists, vocabulary.entries)


class Remembered:
    """``segment_ids`` that keeps short segments of earlier blocks, at most ``REMEMBERED`` of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.lists = pa.array([], pa.large_list(pa.int32()))
        self.good = np.zeros(0, dtype=bool)

    def ids(self, distinct: pa.LargeStringArray) -> tuple[pa.LargeListArray, np.ndarray]:
        at = pc.index_in(distinct, value_set=self.known)
        missing = pc.is_null(at)
        new = distinct.filter(missing)
        new_lists, new_good = segment_ids(new, self.vocabulary)
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[missing.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        lists = pa.concat_arrays([self.lists, new_lists]).take(pa.array(places))
        good = np.concatenate([self.good, new_good])[places]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new, new_lists, new_good = distinct, lists, good
        short = pc.less_equal(pc.binary_length(new), _SHORT)
        self.known = pa.concat_arrays([self.known, new.filter(short)])
        self.lists = pa.concat_arrays([self.lists, new_lists.filter(short)])
        self.good = np.concatenate([self.good, new_good[short.to_numpy(zero_copy_only=False)]])
        return lists, good


def _same_bytes(distinct: pa.LargeStringArray, lists: pa.LargeListArray, entries: pa.LargeBinaryArray) -> np.ndarray:
    ours, theirs = _joined_bytes(lists, entries), bytes_of(distinct)
    same = np.diff(ours[1]) == np.diff(theirs[1])
    if same.all() and np.array_equal(ours[0], theirs[0]):
        return same
    for i in np.flatnonzero(same):
        mine = ours[0][ours[1][i] : ours[1][i + 1]]
        same[i] = np.array_equal(mine, theirs[0][theirs[1][i] : theirs[1][i + 1]])
    return same


def _joined_bytes(lists: pa.LargeListArray, entries: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    taken = entries.take(pc.list_flatten(lists))
    data, places = bytes_of(taken)
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    return data, places[offsets]


def taken(lists: pa.LargeListArray, numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of the numbered lists in order, and the n + 1 places of each text's values."""
    picked = lists.take(pa.array(numbers))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(picked).to_numpy())])
    return pc.list_flatten(picked).to_numpy(), ends[places]


def byte_level_entries(library) -> pa.LargeBinaryArray:
    """The bytes of every id of a byte-level vocabulary; added tokens stand for their own text."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char_of = {b: chr(b) for b in plain}
    char_of |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in char_of)}
    byte_of = {c: b for b, c in char_of.items()}
    added = library.get_added_tokens_decoder()
    entries = []
    for i in range(library.get_vocab_size()):
        text = library.id_to_token(i) or ""
        known = i not in added and all(c in byte_of for c in text)
        entries.append(bytes(byte_of[c] for c in text) if known else text.encode())
    return pa.array(entries, pa.large_binary())


def piece_entries(library) -> pa.LargeBinaryArray:
    """The bytes of every id of a piece model; space marks are spaces, byte pieces their byte."""
    entries = []
    for i in range(library.get_piece_size()):
        text = library.id_to_piece(i)
        entries.append(bytes([int(text[3:5], 16)]) if library.is_byte(i) else text.replace("▁", " ").encode())
    return pa.array(entries, pa.large_binary())
