"""SentencePiece merge-type encoding and decoding, exact, by backtracking.

A text is cut where no piece can reach across (before a run of spaces, around line ends), and each
segment is encoded so:

* an Aho-Corasick automaton over all pieces finds the longest piece at each place;
* a sequence of pieces is the encoding if and only if every two neighbours stay themselves when
  their joined text is merged again, so a piece is taken only if it fits the one before it;
* a piece that does not fit gives way to the next shorter one at its place; where none is left the
  place is marked in a bit field as a dead end, and the piece before is tried again.

Most segments are settled by the longest pieces alone. Segments recur, so a block of texts is encoded by
its distinct ones, and each worker keeps the latest ones in Arrow arrays, at most ``REMEMBERED``.
Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.llm.segments import bytes_of, row_ranges, segments, taken

SPACE = "▁"
#: Stretches and pairs of pieces kept per worker, and the bytes of the longest stretch worth keeping.
REMEMBERED, _SHORT = 800_000, 64
#: Bytes of text encoded together; a longer text stands alone.
BLOCK_BYTES = 8 << 20
_WINDOW = 4096


class PieceModel:
    """The pieces of a merge-type model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        self.texts = [library.id_to_piece(i) for i in ids]
        self.bytes_of = {i: bytes([int(self.texts[i][3:5], 16)]) for i in ids if library.is_byte(i)}
        self.control = {i for i in ids if library.is_control(i)}
        self.unknown = {i for i in ids if library.is_unknown(i)}
        plain = [i for i in ids if i not in self.bytes_of and i not in self.control and i not in self.unknown]
        self.ids = {self.texts[i]: i for i in plain}
        self.scores = {self.texts[i]: library.get_score(i) for i in plain}
        self.byte_ids = {b[0]: i for i, b in self.bytes_of.items()}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("pieces reach over the start of a word; this model needs whole-text merging")
        chars = {c for p in self.ids for c in p}
        self.known = re.compile("([^" + "".join(re.escape(c) for c in sorted(chars)) + "]+)")
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for text in self.ids.keys() | chars:
            self.automaton.add_word(text, text)
        self.automaton.make_automaton()
        self.shorter = {t: self._next_shorter(t, chars) for t in self.ids.keys() | chars}
        inner = "" if "\n" in chars else "\n"
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{inner}]*|[^{SPACE}{inner}]+" + (f"|{inner}+" if inner else ""))
        self.fitting: dict[tuple[str, str], bool] = {}
        self.standing: dict[str, bool] = {}
        self.at_lines = bool(inner)
        self.remembered = _Remembered(self)

    def _next_shorter(self, text: str, chars: set[str]) -> str | None:
        """The longest piece that the given one starts with, shorter than itself."""
        for n in range(len(text) - 1, 0, -1):
            if text[:n] in self.ids or n == 1 and text[0] in chars:
                return text[:n]
        return None

    def normalized(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """Merge characters as the model does: best score first, then leftmost."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                joined = parts[i] + parts[j]
                if joined in self.scores:
                    heapq.heappush(queue, (-self.scores[joined], i, j, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, joined = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def fits(self, left: str, right: str) -> bool:
        """Whether two neighbours stay as they are when merged again."""
        if len(self.fitting) >= REMEMBERED:
            self.fitting.clear()
        fit = self.fitting[left, right] = self.merged(left + right) == [left, right]
        return fit

    def stands(self, piece: str) -> bool:
        """Whether a piece alone is its own encoding."""
        fit = self.standing.get(piece)
        if fit is None:
            fit = self.standing[piece] = self.merged(piece) == [piece]
        return fit

    def segment_pieces(self, text: str) -> list[str]:
        """Pieces of a segment that holds only characters of the vocabulary."""
        greedy = [piece for _, piece in self.automaton.iter_long(text)]
        known, before = self.fitting, greedy[0]
        for piece in greedy[1:]:
            fit = known.get((before, piece))
            if not (self.fits(before, piece) if fit is None else fit):
                return self._backtracked(text)
            before = piece
        return greedy if len(greedy) > 1 or self.stands(before) else self._backtracked(text)

    def _backtracked(self, text: str) -> list[str]:
        longest_at = _Longest(self.automaton, text, self.longest).at
        if len(text) <= _WINDOW:
            longest_at = _longest_pieces(self.automaton, text).__getitem__
        shorter, known, size = self.shorter, self.fitting, len(text)
        dead = bytearray(len(text) // 8 + 1)
        taken: list[str] = []
        place, piece = 0, longest_at(0)
        while place < size:
            last = taken[-1] if taken else None
            while piece:
                end = place + len(piece)
                if not dead[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        fit = self.stands(piece)
                    else:
                        fit = known.get((last, piece))
                        if fit is None:
                            fit = self.fits(last, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece:
                taken.append(piece)
                place = end
                if place < size:
                    piece = longest_at(place)
            elif last is None:
                raise ValueError("the model has no encoding for this text")
            else:
                dead[place >> 3] |= 1 << (place & 7)
                place -= len(taken.pop())
                piece = shorter[last]
        return taken

    def segment_ids(self, segment: str) -> list[int]:
        ids: list[int] = []
        for k, run in enumerate(self.known.split(segment)):
            if k % 2:
                ids += [self.byte_ids[b] for b in run.encode()]
            elif run:
                for piece in self.segment_pieces(run):
                    found = self.ids.get(piece)
                    ids += [found] if found is not None else [self.byte_ids[b] for b in piece.encode()]
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for segment in self.cut.findall(self.normalized(text)):
            ids += self.segment_ids(segment)
        return ids

    def surface(self, ids: Sequence[int]) -> str:
        """Text of ids, spaces marked and the leading one still there."""
        out: list[str] = []
        raw = b""
        for i in ids:
            byte = self.bytes_of.get(i)
            if byte is not None:
                raw += byte
                continue
            if raw:
                out.append(_text_of_bytes(raw))
                raw = b""
            if i in self.unknown:
                out.append(f" ⁇ ")
            elif i not in self.control:
                out.append(self.texts[i])
        if raw:
            out.append(_text_of_bytes(raw))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        return unmarked(self.surface(ids))

    def of_stretch(self, text: str) -> tuple[list[int], str]:
        """Ids and surface of a part of a text that starts at its start or at a space."""
        ids: list[int] = []
        surfaces: list[str] = []
        for segment in self.cut.findall(text.replace(" ", SPACE)):
            found = self.segment_ids(segment)
            ids += found
            # Pieces of the vocabulary joined are the segment again.
            surfaces.append(segment if self.known.search(segment) is None else self.surface(found))
        return ids, "".join(surfaces)


class _Remembered:
    """Ids, decimals and surfaces of distinct stretches; the latest short ones are kept."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.held = self._made([])

    def _made(self, texts: Sequence[str]) -> list[pa.Array]:
        found = [self.model.of_stretch(t) for t in texts]
        flat = pa.array([i for ids, _ in found for i in ids], pa.int32())
        ends = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in found])]).astype(np.int64)
        decimals = pa.array([",".join(map(str, ids)) for ids, _ in found], pa.large_string())
        surfaces = pa.array([s for _, s in found], pa.large_string())
        return [pa.LargeListArray.from_arrays(pa.array(ends), flat), decimals, surfaces]

    def of(self, distinct: pa.LargeStringArray) -> list[pa.Array]:
        at = pc.index_in(distinct, value_set=self.known)
        missing = pc.is_null(at)
        new = distinct.filter(missing)
        made = self._made(new.to_pylist())
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[missing.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        found = [pa.concat_arrays([h, m]).take(pa.array(places)) for h, m in zip(self.held, made)]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new, made = distinct, found
        short = pc.less_equal(pc.binary_length(new), _SHORT)
        self.known = pa.concat_arrays([self.known, new.filter(short)])
        self.held = [pa.concat_arrays([h, m.filter(short)]) for h, m in zip(self.held, made)]
        return found


class _Longest:
    """The longest piece at each place, found window by window."""

    def __init__(self, automaton: ahocorasick.Automaton, text: str, reach: int):
        self.automaton, self.text, self.reach = automaton, text, reach
        self.low = self.high = 0
        self.found: list[str] = []

    def at(self, place: int) -> str:
        if not self.low <= place < self.high:
            self.low = place // _WINDOW * _WINDOW
            self.high = min(self.low + _WINDOW, len(self.text))
            self.found = _longest_pieces(self.automaton, self.text[self.low : self.high + self.reach])
        return self.found[place - self.low]


def _longest_pieces(automaton: ahocorasick.Automaton, text: str) -> list[str]:
    found = [""] * len(text)
    # Matches come by their ends, so the last one from a place is its longest.
    for end, piece in automaton.iter(text):
        found[end + 1 - len(piece)] = piece
    return found


def unmarked(surface: str) -> str:
    """Spaces for space marks, without the one that encoding put in front."""
    return surface.removeprefix(SPACE).replace(SPACE, " ")


def _text_of_bytes(raw: bytes) -> str:
    """Characters of bytes; each byte that is part of none becomes a replacement character."""
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """The model of a file, read once per worker."""
    return PieceModel(path)


_KINDS = {
    "ids": "array<int>", "decoded": "string", "n_tokens": "bigint",
    "ids_sha256": "string", "decoded_sha256": "string",
}


def encode_texts(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: Sequence[str] = ("ids", "decoded"),
) -> DataFrame:
    """Encode and decode every text; returns id_col and the chosen columns.

    Columns: ``ids``, ``decoded`` (the text that the ids decode to), ``n_tokens``, and the SHA-256
    digests ``ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256`` as
    lower-case hex. ``path`` names a model file that every worker can open.

    Work is per row, without a shuffle; a worker holds one block of texts and the remembered
    segments. Defined results: a null text counts as empty and has no ids; rows without id or with
    the same id are encoded each; columns besides id and text are left out.
    """
    unknown = set(columns) - set(_KINDS)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    wanted = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        model = load_model(path)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            for low, high in row_ranges(bytes_of(texts)[1], BLOCK_BYTES):
                found = _block_columns(model, texts.slice(low, high - low), wanted)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, high - low), *found], ["id", *wanted])
            pa.default_memory_pool().release_unused()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {id_type}", *[f"{c} {_KINDS[c]}" for c in wanted]])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _block_columns(model: PieceModel, texts: pa.LargeStringArray, wanted: Sequence[str]) -> list[pa.Array]:
    """The wanted columns of a block of texts."""
    front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    opened = pc.binary_join_element_wise(front, texts, pa.scalar("", pa.large_string()))
    cut = segments(*bytes_of(opened), at_lines=model.at_lines)
    ids, decimals, surfaces = model.remembered.of(cut.distinct)
    numbers = pa.array(cut.numbers)

    def joined(of: pa.LargeStringArray, separator: str) -> tuple[memoryview, np.ndarray]:
        lists = pa.LargeListArray.from_arrays(pa.array(cut.places.astype(np.int64)), of.take(numbers))
        data, places = bytes_of(pc.binary_join(lists, pa.scalar(separator, pa.large_string())))
        return memoryview(np.ascontiguousarray(data)), places

    def decoded() -> list[bytes]:
        plain, places = joined(pc.replace_substring(surfaces, SPACE, " "), "")
        # The first mark is the one that encoding put in front.
        return [bytes(plain[a + 1 : b]) for a, b in zip(places[:-1], places[1:])]

    out: list[pa.Array] = []
    for column in wanted:
        if column in ("ids", "n_tokens"):
            flat, places = taken(ids, cut.numbers, cut.places)
            counts = pa.array(np.diff(places))
            lists = pa.LargeListArray.from_arrays(pa.array(places.astype(np.int64)), pa.array(flat))
            out.append(counts if column == "n_tokens" else lists.cast(pa.list_(pa.int32())))
        elif column == "ids_sha256":
            spelt, places = joined(decimals, ",")
            out.append(pa.array([hashlib.sha256(spelt[a:b]).hexdigest() for a, b in zip(places[:-1], places[1:])], pa.string()))
        elif column == "decoded_sha256":
            out.append(pa.array([hashlib.sha256(t).hexdigest() for t in decoded()], pa.string()))
        else:
            out.append(pa.array([t.decode() for t in decoded()], pa.string()))
    return out
