"""Source divergence audit: which terms, and which other sources, set a source apart in its language.

Terms are counted per language and source with late string materialization:

1. A first pass over the texts counts documents by language and 64-bit digest of the term, combined
   per task. What is shuffled is digests; those that may be in enough documents are marked in a
   bitmap of fixed size.
2. A second pass counts by source the terms whose digest is marked, and stores digest and string side
   by side; as files hold columns apart, what follows reads strings only where it needs them. The
   smallest and the largest string of each digest are found. Where they differ the digest stands for
   several terms, and its rows are counted by string; all other rows travel as digests. Terms that
   the bitmap let through by chance, or with others of their digest, fall to their exact counts.
3. Shares are exact integers. The best terms of a source are cut by value first, ties included; their
   strings are joined to what is left and settle the ties.
4. Distances of all pairs of sources are summed over slices of terms: a task holds the shares of up
   to two blocks of sources for its terms and adds up absolute differences. Terms that no source of a
   pair of blocks has differ by the shares of a count of zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowaudit.llm.scratch import Scratch
from flowaudit.llm.segments import bytes_of, row_ranges

#: Bytes of text worked on together (a longer text stands alone), and counts held before they are given out.
SLICE_BYTES = 8 << 20
HELD = 2_000_000
#: Sources in one block, and counts in one slice of terms.
BLOCK = 512
SLICE_COUNTS = 200_000
#: Shares are counted in parts of this.
PARTS = 1_000_000_000
_CELLS = 1 << 20
#: Bits of the map of digests that may be kept: 2 MB, a power of two.
BITMAP_BITS = 1 << 24

#: Lower-cased letters and all bytes of characters beyond ASCII; a space for every other byte.
_TERM_BYTES = np.full(256, 32, dtype=np.uint8)
_TERM_BYTES[97:123] = np.arange(97, 123)
_TERM_BYTES[65:91] = np.arange(97, 123)
_TERM_BYTES[128:] = np.arange(128, 256)

_COUNTS = "digest bigint, term string, n bigint, docs bigint"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, places = bytes_of(batch.column("text").cast(pa.large_string()).fill_null(""))
    for low, high in row_ranges(places, SLICE_BYTES):
        yield batch.slice(low, high - low)


def _terms(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Distinct terms, and text and term number of every occurrence."""
    data, places = bytes_of(texts)
    data = _TERM_BYTES[data]
    inside = data != 32
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[places[:-1]] = True
    cuts = np.flatnonzero(opens | begins[:-1])
    # A stretch runs from a term to the next; at the start of a text it may hold no term.
    offsets = np.append(cuts, len(data)).astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    trimmed = pc.ascii_rtrim(coded.dictionary, characters=" ").dictionary_encode()
    numbers = trimmed.indices.to_numpy()[coded.indices.to_numpy()]
    text = np.searchsorted(places, cuts, side="right") - 1
    held = inside[cuts]
    return trimmed.dictionary, text[held], numbers[held]


def _counter(names: Sequence[str], digest_bits: int, bitmap: np.ndarray | None = None):
    """Texts to counts per group and term; with a bitmap only of terms whose digest may be in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        held = _Held(names, digest_bits, bitmap)
        for batch in batches:
            for part in _slices(batch):
                held.add(part)
                if held.rows > HELD:
                    yield held.take()
            pa.default_memory_pool().release_unused()
        yield held.take()

    return run


class _Held:
    """Counts of several slices, combined when they are taken."""

    def __init__(self, names: Sequence[str], digest_bits: int, bitmap: np.ndarray | None):
        self.names = names
        self.mask = np.uint64((1 << digest_bits) - 1)
        self.bitmap = bitmap
        self._clear()

    def _clear(self) -> None:
        self.rows = 0
        self.groups: dict[tuple[str, ...], int] = {}
        self.terms: list[pa.LargeStringArray] = []
        self.digests: list[np.ndarray] = []
        self.counts: list[tuple[np.ndarray, ...]] = []

    def _digests(self, terms: pa.LargeStringArray) -> np.ndarray:
        strings = np.array(terms.to_pylist(), dtype=object)
        found = pd.util.hash_array(strings, categorize=False) if len(strings) else np.zeros(0)
        return (found.astype(np.uint64) & self.mask).view(np.int64)

    def add(self, part: pa.RecordBatch) -> None:
        named = zip(*[part.column(c).to_pylist() for c in self.names])
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in named], dtype=np.int64)
        terms, text, numbers = _terms(part.column("text").cast(pa.large_string()).fill_null(""))
        digests = self._digests(terms)
        if self.bitmap is not None:
            wanted = _in_bitmap(digests, self.bitmap)
            kept = wanted[numbers]
            text, numbers = text[kept], (np.cumsum(wanted) - 1)[numbers[kept]]
            terms, digests = terms.filter(pa.array(wanted)), digests[wanted]
        known = max(len(terms), 1)
        in_text, n = np.unique(text * known + numbers, return_counts=True)
        key, n, docs = _summed(group[in_text // known] * known + in_text % known, n, np.ones(len(n)))
        self.counts.append((key // known, key % known + sum(map(len, self.terms)), n, docs))
        self.terms.append(terms)
        self.digests.append(digests)
        self.rows += len(key)

    def take(self) -> pa.RecordBatch:
        group, number, n, docs = [np.concatenate(c) for c in zip(*self.counts)] or [np.zeros(0, np.int64)] * 4
        coded = pa.chunked_array(self.terms, pa.large_string()).combine_chunks().dictionary_encode()
        numbers = coded.indices.to_numpy()
        digests = np.zeros(len(coded.dictionary), dtype=np.int64)
        if self.digests:
            digests[numbers] = np.concatenate(self.digests)
        known = max(len(digests), 1)
        key, n, docs = _summed(group * known + numbers[number], n, docs)
        at, term = pa.array(key // known), key % known
        names = list(zip(*self.groups)) or [[]] * len(self.names)
        columns = [pa.array(column, pa.string()).take(at) for column in names]
        terms = coded.dictionary.take(pa.array(term)).cast(pa.string())
        columns += [pa.array(digests[term]), terms, pa.array(n), pa.array(docs)]
        self._clear()
        return pa.RecordBatch.from_arrays(columns, [*self.names, "digest", "term", "n", "docs"])


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the values added up by key."""
    if not len(key):
        return key.astype(np.int64), *(v.astype(np.int64) for v in values)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], *(np.add.reduceat(v[order].astype(np.int64), first) for v in values)


def _bitmap(digests: DataFrame) -> np.ndarray:
    """A bitmap of ``BITMAP_BITS`` bits, whatever the number of digests, with the bit of each one set."""
    place = F.col("digest").bitwiseAND(BITMAP_BITS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(31).cast("int"))
    words = digests.select(F.shiftright(place, 5).alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS >> 5, dtype=np.uint32)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bitmap


def _in_bitmap(digests: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = digests & (BITMAP_BITS - 1)
    return (bitmap[place >> 5] >> (place & 31).astype(np.uint32) & 1).astype(bool)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (count + 5) / (total + 5 * kept)), exact; null where nothing is kept."""
    wide = "decimal(38,0)"
    above = (count + 5).cast("decimal(20,0)") * F.lit(PARTS).cast("decimal(10,0)")
    below = (total + 5 * kept).cast("decimal(20,0)")
    whole = F.call_function("div", above.cast(wide), F.when(kept > 0, below).cast(wide))
    return whole + 1


def divergence(
    df: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = 30,
    top: int = 50,
    digest_bits: int = 64,
    block_sources: int = BLOCK,
    slice_counts: int = SLICE_COUNTS,
) -> DataFrame:
    """Return lang, source, part, item, value and rank for every (lang, source) of ``df``.

    Part ``pair`` holds each other source of the language with the sum of absolute differences of
    shares over the language's terms; part ``term`` the ``top`` terms whose share is above the
    language's, with the difference. Terms are runs of letters (A-Z lower-cased) and characters beyond
    ASCII that are in ``least_docs`` rows of the language or more. Ranks go by falling value, then
    by item. ``digest_bits`` is there to try collisions; the last two bound the work of a task.

    Defined results: null texts, languages and sources count as empty strings, and an empty string is
    a language or source like any other. Groups without terms take part; where a language keeps no
    term all values of pairs are zero. Repeated rows count each. Other columns are left out.
    """
    scratch = Scratch(df.sparkSession, "divergence")
    rows = df.select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    groups = scratch.keep(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")))
    counts, vocabulary = _kept_counts(rows, least_docs, digest_bits, scratch)

    of_lang = counts.groupBy("lang").agg(
        F.count(F.when(F.col("first"), 1)).alias("kept"), F.sum("n").alias("lang_total")
    )
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("filled"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("bigint")
    groups = scratch.keep(
        groups.join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .fillna(0, ["total", "filled", "kept", "lang_total"])
        .withColumn("place", place)
        .withColumn("none", F.coalesce(share(zero, F.col("total"), F.col("kept")), zero))
        .select("lang", "source", "place", "total", "filled", "kept", "lang_total", "none")
    )
    of_source = groups.select("lang", "source", "place", "total", "kept", "lang_total")
    shares = (
        counts.join(of_source, ["lang", "source"])
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
        .select("lang", "source", "place", "digest", "split", "p", "q")
    )
    terms = _best_terms(shares, vocabulary, top)
    pairs = _distances(shares, groups, block_sources, slice_counts)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))


def _kept_counts(rows: DataFrame, least_docs: int, digest_bits: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms in groups, and the strings (digest, low) of their digests.

    Counts are (lang, source, digest, split, n, lang_n, first): ``split`` is the term where its digest
    stands for several terms, else null; ``lang_n`` counts the whole language, and one row of each
    term of a language is its first.
    """
    seen = rows.select("lang", "text").mapInArrow(_counter(["lang"], digest_bits), f"lang string, {_COUNTS}")
    maybe = seen.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    bitmap = _bitmap(maybe)
    kinds = f"lang string, source string, {_COUNTS}"
    counted = scratch.keep(rows.mapInArrow(_counter(["lang", "source"], digest_bits, bitmap), kinds))
    strings = counted.select("digest", "term").distinct()
    vocabulary = scratch.keep(strings.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")))
    several = vocabulary.where("low < high").select(F.col("digest").alias("of"))
    marked = counted.join(several, F.col("digest") == F.col("of"), "left").withColumn(
        "split", F.when(F.col("of").isNotNull(), F.col("term"))
    )
    summed = marked.groupBy("lang", "source", "digest", "split").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "digest", "split")
    whole = summed.select(
        "*", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"),
    )
    counts = whole.where(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs")
    return scratch.keep(counts), vocabulary.select("digest", "low")


def _best_terms(shares: DataFrame, vocabulary: DataFrame, top: int) -> DataFrame:
    above = shares.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    ties = above.withColumn("at", F.rank().over(by_value)).where(F.col("at") <= top)
    ties = ties.select("lang", "source", "digest", "split", "value")
    named = ties.join(vocabulary, "digest").withColumn("item", F.coalesce("split", "low"))
    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = named.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= top)
    return ranked.withColumn("part", F.lit("term"))


def _distances(shares: DataFrame, groups: DataFrame, block_sources: int, slice_counts: int) -> DataFrame:
    """Every ordered pair of sources of a language, ranked."""
    of_lang = groups.groupBy("lang").agg(
        (F.floor(F.max("place") / block_sources) + 1).alias("blocks"),
        F.greatest(F.ceil(F.sum("filled") / slice_counts), F.lit(1)).alias("slices"),
    )
    block = F.floor(F.col("place") / block_sources)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    term = F.concat_ws(":", F.col("digest").cast("string"), "split").alias("term")
    of_slice = F.pmod(F.xxhash64("digest"), F.col("slices")).alias("slice")
    filled = shares.join(of_lang, "lang").select(
        "lang", "place", "p", term, of_slice, block.alias("block"), other
    )
    filled = filled.select("lang", low, high, "slice", "place", "term", "p")
    every_slice = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice")
    heads = groups.join(of_lang, "lang").select("lang", "place", "none", "blocks", block.alias("block"), every_slice)
    heads = heads.select("lang", "place", "none", "slice", "block", other)
    heads = heads.select(
        "lang", low, high, "slice", "place", F.lit(None).cast("string").alias("term"), F.col("none").alias("p")
    )
    met = filled.unionByName(heads).groupBy("lang", "low", "high", "slice")
    parts = met.applyInArrow(_differences(block_sources), "lang string, one int, two int, value bigint, terms bigint")
    sums = parts.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))

    def side(of: str) -> DataFrame:
        return groups.select(
            F.col("lang").alias(f"{of}_lang"), F.col("place").alias(f"{of}_place"), F.col("source").alias(f"{of}_name"),
            F.col("none").alias(f"{of}_none"), F.col("kept").alias(f"{of}_kept"),
        )

    both = sums
    for of in ("one", "two"):
        both = both.join(side(of), (F.col("lang") == F.col(f"{of}_lang")) & (F.col(of) == F.col(f"{of}_place")))
    apart = (F.col("one_kept") - F.col("terms")) * F.abs(F.col("one_none") - F.col("two_none"))
    sides = F.explode(
        F.array(
            F.struct(F.col("one_name").alias("source"), F.col("two_name").alias("item")),
            F.struct(F.col("two_name").alias("source"), F.col("one_name").alias("item")),
        )
    )
    named = both.select("lang", (F.col("value") + apart).alias("value"), sides.alias("side")).select(
        "lang", "side.source", "side.item", "value"
    )
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", ranks).withColumn("part", F.lit("pair"))


def _differences(block: int):
    """Sums of absolute differences of shares of all pairs of sources of two blocks, over one slice."""

    def run(rows: pa.Table) -> pa.Table:
        lang, low, high = (rows[c][0].as_py() for c in ("lang", "low", "high"))
        heads = rows.filter(pc.is_null(rows["term"]))
        sources = np.sort(heads["place"].to_numpy())
        none = np.zeros(len(sources), dtype=np.int64)
        none[np.searchsorted(sources, heads["place"].to_numpy())] = heads["p"].to_numpy()
        filled = rows.filter(pc.is_valid(rows["term"]))
        coded = filled["term"].combine_chunks().dictionary_encode()
        number = coded.indices.to_numpy()
        order = np.argsort(number, kind="stable")
        number = number[order]
        column = np.searchsorted(sources, filled["place"].to_numpy())[order]
        p = filled["p"].to_numpy()[order]
        n_terms = len(coded.dictionary)
        first_of_two = int(np.searchsorted(sources // block, high)) if low != high else 0
        sums = np.zeros((len(sources), len(sources)), dtype=np.int64)
        step = max(1, _CELLS // max(len(sources), 1))
        for start in range(0, n_terms, step):
            a, b = np.searchsorted(number, [start, start + step])
            cells = np.tile(none[:, None], (1, min(step, n_terms - start)))
            cells[column[a:b], number[a:b] - start] = p[a:b]
            for i in range(first_of_two if low != high else len(sources)):
                after = max(i + 1, first_of_two)
                sums[i, after:] += np.abs(cells[after:] - cells[i]).sum(axis=1)
        one, two = np.triu_indices(len(sources), 1)
        if low != high:
            across = (one < first_of_two) & (two >= first_of_two)
            one, two = one[across], two[across]
        return pa.table(
            {
                "lang": pa.array([lang] * len(one), pa.string()),
                "one": pa.array(sources[one], pa.int32()),
                "two": pa.array(sources[two], pa.int32()),
                "value": pa.array(sums[one, two]),
                "terms": pa.array(np.full(len(one), n_terms, dtype=np.int64)),
            }
        )

    return run
