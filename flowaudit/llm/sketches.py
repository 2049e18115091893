"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A paragraph is a line; a long one is cut after each word whose hash ends in ``CUT_BITS`` zero bits,
places that stay where they are when text before or after them changes. Each paragraph's digest
(with its number, for paragraphs that recur) goes to three cells, one in each third of the sketch,
and a cell holds a count, the exclusive or of its digests and that of their check values.

The difference of two sketches holds only the paragraphs that differ. Peeling recovers them: a cell
left with one digest gives it away, it is taken out of its other cells, and so on. If cells are left
over, both versions are sketched again with twice the cells, until peeling succeeds.

Likeness is 1 - differing paragraphs / paragraphs of both versions (Dice): 1 for equal paragraphs,
0 for none in common.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowaudit.llm.textops import SLICE_BYTES, _range_hashes, _spans, mix, slices, text_bytes

#: Cells of a stored fingerprint; comparisons start here and double on failure.
CELLS = 24
CUT_BITS = 2
#: Rows of 12 bytes, one per part, that are sent to all executors; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
_SEEDS = np.array([0x1F83D9AB, 0x5BE0CD19, 0xA54FF53A], dtype=np.uint64)
_CELL = struct.Struct("<iQI")


def paragraph_digests(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the paragraphs of all texts, and the n + 1 places of each text's digests."""
    found, counts = [], []
    for first, last in slices(places):
        low, high = int(places[first]), int(places[last])
        if high - low <= SLICE_BYTES:
            digests, starts = _digests(data[low:high], places[first : last + 1] - low)
            counts.append(np.diff(starts))
        else:
            digests = _long_digests(data[low:high])
            counts.append(np.array([len(digests)]))
        found.append(digests)
    totals = np.cumsum(np.concatenate(counts)) if counts else np.zeros(0)
    ends = np.concatenate([[0], totals]).astype(np.int64)
    digests = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return _numbered(digests, ends), ends


def _digests(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests within one slice, and where those of each text start."""
    starts, ends = _spans(data, cuts)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(cuts), np.int64)
    words = mix(_range_hashes(data, starts, ends))
    closes = words & np.uint64((1 << CUT_BITS) - 1) == 0
    lines = np.cumsum(data == 10)
    closes[:-1] |= lines[starts[1:]] != lines[starts[:-1]]
    of_text = np.searchsorted(cuts, starts, side="right")
    closes[:-1] |= of_text[1:] != of_text[:-1]
    closes[-1] = True
    last = np.flatnonzero(closes)
    first = np.concatenate([[0], last[:-1] + 1])
    digests = mix(_range_hashes(data, starts[first], ends[last]) ^ mix((ends[last] - starts[first]).astype(np.uint64)))
    return digests, np.searchsorted(of_text[first], np.arange(1, len(cuts) + 1), side="left")


def _long_digests(data: np.ndarray) -> np.ndarray:
    """Digests of one text longer than a slice, read in pieces that end with a paragraph.

    A single paragraph longer than a slice is cut at the slice, counted from its start.
    """
    parts, at = [], 0
    while at < len(data):
        piece = data[at : at + SLICE_BYTES]
        if at + len(piece) < len(data):
            line = np.flatnonzero(piece == 10)
            piece = piece[: int(line[-1]) + 1] if len(line) else piece
        parts.append(_digests(piece, np.array([0, len(piece)]))[0])
        at += len(piece)
    return np.concatenate(parts)


def _numbered(digests: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tell recurring paragraphs of a text apart by their number; never zero."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((digests, owner))
    sorted_digests, sorted_owner = digests[order], owner[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_digests[1:] != sorted_digests[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    number = np.empty(len(order), dtype=np.uint64)
    number[order] = (np.arange(len(order)) - start).astype(np.uint64)
    return np.maximum(mix(digests + mix(number)), np.uint64(1))


class Sketches:
    """Sketches of many texts, one row of cells each."""

    def __init__(self, rows: int, cells: int):
        self.cells = -(-cells // 3) * 3
        self.counts = np.zeros((rows, self.cells), dtype=np.int64)
        self.keys = np.zeros((rows, self.cells), dtype=np.uint64)
        self.checks = np.zeros((rows, self.cells), dtype=np.uint64)

    def _places(self, owner: np.ndarray, digests: np.ndarray) -> np.ndarray:
        third = self.cells // 3
        spots = [mix(digests + s + np.uint64(self.cells)) % np.uint64(third) + np.uint64(k * third) for k, s in enumerate(_SEEDS)]
        return owner * self.cells + np.stack(spots).astype(np.int64)

    def add(self, owner: np.ndarray, digests: np.ndarray, signs: np.ndarray) -> None:
        checks = _check(digests)
        for spots in self._places(owner, digests):
            np.add.at(self.counts.reshape(-1), spots, signs)
            np.bitwise_xor.at(self.keys.reshape(-1), spots, digests)
            np.bitwise_xor.at(self.checks.reshape(-1), spots, checks)

    def less(self, other: Sketches) -> Sketches:
        """The cells' difference: what remains are the paragraphs that differ."""
        out = Sketches(0, self.cells)
        out.counts = self.counts - other.counts
        out.keys = self.keys ^ other.keys
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recover digests: (owners, digests, signs) and which rows came out whole."""
        found = []
        for _ in range(self.counts.size + 1):
            pure = (np.abs(self.counts) == 1) & (self.checks == _check(self.keys))
            owner, cell = np.nonzero(pure)
            if not len(owner):
                break
            digests, signs = self.keys[owner, cell], self.counts[owner, cell]
            order = np.lexsort((digests, owner))
            once = np.ones(len(order), dtype=bool)
            once[1:] = (owner[order][1:] != owner[order][:-1]) | (digests[order][1:] != digests[order][:-1])
            at = order[once]
            found.append((owner[at], digests[at], signs[at]))
            self.add(owner[at], digests[at], -signs[at])
        whole = ~((self.counts != 0) | (self.keys != 0)).any(axis=1)
        empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        owners, digests, signs = (np.concatenate(c) for c in zip(*(found or [empty])))
        return owners, digests, signs, whole

    def text(self, row: int) -> str:
        """A row of cells as text: number of cells, then count, digests and checks of each."""
        cells = zip(self.counts[row].tolist(), self.keys[row].tolist(), self.checks[row].tolist())
        raw = b"".join([_CELL.pack(c, k, x) for c, k, x in cells])
        return f"{self.cells}:" + base64.b64encode(raw).decode()


def _check(digests: np.ndarray) -> np.ndarray:
    return np.where(digests == 0, np.uint64(0), mix(digests ^ np.uint64(0x7F4A7C15F39CC060)) >> np.uint64(32))


def sketch(digests: np.ndarray, ends: np.ndarray, rows: Sequence[int] | np.ndarray, cells: int) -> Sketches:
    """Sketches of the chosen texts."""
    rows = np.asarray(rows, dtype=np.int64)
    sizes = (ends[1:] - ends[:-1])[rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    at = np.arange(int(sizes.sum())) - np.repeat(total, sizes) + np.repeat(ends[:-1][rows], sizes)
    made = Sketches(len(rows), cells)
    made.add(owner, digests[at], np.ones(len(at), dtype=np.int64))
    return made


def compare(
    old: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray], cells: int = CELLS
) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Likeness, digests only in the old and only in the new version, and cells used, row by row."""
    n = len(old[1]) - 1
    sizes = np.diff(old[1]) + np.diff(new[1])
    only_old = [np.zeros(0, np.uint64)] * n
    only_new = [np.zeros(0, np.uint64)] * n
    used = np.zeros(n, dtype=np.int64)
    differing = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    while len(rows):
        # Few rows at a time where sketches are large.
        for low in range(0, len(rows), max(1, (1 << 19) // cells)):
            some = rows[low : low + max(1, (1 << 19) // cells)]
            left = sketch(*old, some, cells).less(sketch(*new, some, cells))
            owners, digests, signs, whole = left.peel()
            order = np.argsort(owners, kind="stable")
            owners, digests, signs = owners[order], digests[order], signs[order]
            bounds = np.searchsorted(owners, np.arange(len(some) + 1))
            for k in np.flatnonzero(whole):
                part = slice(bounds[k], bounds[k + 1])
                only_old[some[k]] = digests[part][signs[part] > 0]
                only_new[some[k]] = digests[part][signs[part] < 0]
                differing[some[k]] = bounds[k + 1] - bounds[k]
                used[some[k]] = left.cells
        rows = rows[used[rows] == 0]
        cells *= 2
    likeness = np.where(sizes == 0, 1.0, 1.0 - differing / np.maximum(sizes, 1))
    return likeness, only_old, only_new, used


def compare_versions(
    df: DataFrame, versions: Sequence[tuple[str, str, str]], fingerprints: dict[str, str], details: bool = False
) -> DataFrame:
    """Compare text columns row by row and add fingerprints.

    ``versions`` lists (old column, new column, name of the likeness column); ``fingerprints`` maps
    text columns to the columns for their fingerprints. The text columns named there are replaced
    by the results; with ``details`` also by arrays ``<name>_only_old`` and ``<name>_only_new`` of
    paragraph digests. Work is per row, without a shuffle.

    Defined results: a null text counts as empty; two texts without words have likeness 1.
    """
    texts = list(dict.fromkeys([c for a, b, _ in versions for c in (a, b)] + list(fingerprints)))
    kept = [c for c in df.columns if c not in texts]
    added: list[tuple[str, T.DataType]] = [(name, T.DoubleType()) for _, _, name in versions]
    added += [(name, T.StringType()) for name in fingerprints.values()]
    if details:
        added += [(f"{name}_only_{side}", T.ArrayType(T.LongType())) for _, _, name in versions for side in ("old", "new")]

    def some_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = {c: paragraph_digests(*text_bytes(batch.column(c))) for c in texts}
        out: dict[str, pa.Array] = {}
        for a, b, name in versions:
            likeness, only_old, only_new, _ = compare(found[a], found[b])
            out[name] = pa.array(likeness)
            if details:
                for side, digests in (("old", only_old), ("new", only_new)):
                    out[f"{name}_only_{side}"] = pa.array([d.view(np.int64) for d in digests], pa.list_(pa.int64()))
        for c, name in fingerprints.items():
            made = sketch(*found[c], np.arange(len(batch)), CELLS)
            out[name] = pa.array([made.text(k) for k in range(len(batch))], pa.string())
        arrays = [batch.column(c) for c in kept] + [out[name] for name, _ in added]
        return pa.RecordBatch.from_arrays(arrays, kept + [name for name, _ in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1024):
                yield some_rows(batch.slice(low, 1024))

    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in added:
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)


def with_next_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "next_text") -> DataFrame:
    """Add the text of the next row in ascending id order; after the last comes the first.

    Ids are cut at quantiles into parts of about equal size, four per shuffle partition, and each
    part is ordered by itself, together with a copy of the row that follows it, so whole texts are
    shuffled once. The driver holds one id per part.

    Defined results: rows of one id come by the hash of their texts; rows without id have no place
    in the order and an empty next text.
    """
    spark = df.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = F.col(id_col).cast("bigint")
    shares = [k / parts for k in range(1, parts)]
    bounds = df.select(F.percentile_approx(ids, shares, max(10_000, 10 * parts)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    firsts = df.where(ids.isNotNull()).groupBy(_part_of(ids, bounds).alias("part")).agg(F.min(ids).alias("first"))
    heads = sorted((r["part"], r["first"]) for r in firsts.collect())
    follows = [(heads[(k + 1) % len(heads)][1], part) for k, (part, _) in enumerate(heads)]
    heads_df = spark.createDataFrame(follows, "__head bigint, __part int")
    if len(follows) <= MOST_BROADCAST:
        heads_df = F.broadcast(heads_df)

    text = F.coalesce(F.col(text_col), F.lit(""))
    own = df.withColumn("__part", F.coalesce(_part_of(ids, bounds), F.lit(-1))).withColumn("__copy", F.lit(False))
    copies = df.join(heads_df, ids == F.col("__head")).drop("__head").withColumn("__copy", F.lit(True))
    order = Window.partitionBy("__part").orderBy("__copy", ids, F.xxhash64(text))
    # The bare column: an expression in the window would be shuffled as a second copy of the text.
    following = F.when(ids.isNotNull(), F.lead(text_col).over(order))
    return (
        own.unionByName(copies)
        .withColumn(name, F.coalesce(following, F.lit("")))
        .where(~F.col("__copy"))
        .drop("__part", "__copy")
    )


def _part_of(ids: Column, bounds: list[int]) -> Column:
    """Number of the part an id falls in: how many bounds are below it; null stays null."""

    @F.pandas_udf("int")
    def find(values):
        import pandas as pd

        parts = pd.Series(np.searchsorted(edges, values.fillna(0).to_numpy(dtype=np.int64)), dtype="Int32")
        return parts.mask(values.isna())

    edges = np.array(bounds, dtype=np.int64)
    return find(ids)
