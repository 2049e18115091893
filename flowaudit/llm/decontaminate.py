"""Benchmark decontamination by winnowing.

A document is contaminated by an item where ``window`` words of the item stand in it one after the
other; an item of fewer words counts as a whole.

1. Texts become hashes of runs of ``gram`` words. Of every stretch of runs that makes up ``window``
   words the smallest hash is kept, the rightmost of equal ones. Two texts that share ``window``
   words share that stretch, so they keep the same hash at the same place in it: no shared span of that
   length is missed. Items shorter than a window have a stretch of their own length; documents are
   winnowed once for each such length that occurs.
2. Kept hashes of documents are joined to the distinct ones of items. Places where they meet, few,
   go back to their texts.
3. A place is extended to all windows of the right length around it, and each is compared with the
   items' windows by a 128-bit digest of its words. Windows that are found give the words hit, as a
   union of ranges, and the items.

Texts are known by a digest of theirs, so copies of a text share what was found for one. Items and
hits are hinted nowhere: Spark broadcasts them while their files are below its threshold, and else
shuffles. What stands in many documents, or in many items, meets once per text and distinct window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowaudit.llm.scratch import Scratch
from flowaudit.llm.textops import mix, text_bytes, word_hashes

WINDOW, GRAM = 10, 5

#: Digits, lower-cased letters and all bytes of characters beyond ASCII; a space for every other byte.
_WORD_BYTES = np.full(256, 32, dtype=np.uint8)
_WORD_BYTES[48:58] = np.arange(48, 58)
_WORD_BYTES[97:123] = np.arange(97, 123)
_WORD_BYTES[65:91] = np.arange(97, 123)
_WORD_BYTES[128:] = np.arange(128, 256)


def winnow(words: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes kept of every ``length`` words; none for fewer words.

    A place is the first word of a run of ``gram`` words (``length`` words if those are fewer). Hashes
    of different lengths are apart.
    """
    gram = min(gram, length)
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = np.full(len(words) - gram + 1, length, dtype=np.uint64)
    for k in range(gram):
        runs = mix(runs * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(runs)])
    least, at = runs[:n].copy(), np.arange(n)
    for k in range(1, length - gram + 1):
        later = runs[k : k + n]
        lower = later <= least
        least[lower] = later[lower]
        at[lower] = np.flatnonzero(lower) + k
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return at, runs[at]


def _words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES.tobytes()).split()


def _digests(words: Sequence[bytes], starts: Sequence[int], length: int) -> list[bytes]:
    return [hashlib.blake2b(b" ".join(words[s : s + length]), digest_size=16).digest() for s in starts]


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with signs blanked, places of texts, word hashes, and places of each text's words."""
    data, places = text_bytes(batch.column("text"))
    data = _WORD_BYTES[data]
    return data, places, *word_hashes(data, places)


def _item_reader(window: int, gram: int):
    """Items to their length class, kept hashes and window digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places, words, ends = _hashed(batch)
            lengths, hashes, digests = [], [], []
            for i in range(len(batch)):
                length = min(int(ends[i + 1] - ends[i]), window)
                own = _words(data[places[i] : places[i + 1]].tobytes())
                lengths.append(length)
                hashes.append(winnow(words[ends[i] : ends[i + 1]], length, gram)[1].view(np.int64) if length else [])
                digests.append(_digests(own, range(len(own) - length + 1), length) if length else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    pa.array(lengths, pa.int32()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(digests, pa.list_(pa.binary())),
                ],
                ["item", "length", "hashes", "windows"],
            )

    return run


def _fingerprinter(lengths: Sequence[int], gram: int):
    """Texts to places and kept hashes, for every length in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, words, ends = _hashed(batch)
            places, hashes = [], []
            for i in range(len(batch)):
                kept = [winnow(words[ends[i] : ends[i + 1]], length, gram) for length in lengths]
                places.append(np.concatenate([k[0] for k in kept]).astype(np.int32))
                hashes.append(np.concatenate([k[1] for k in kept]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["key", "places", "hashes"],
            )

    return run


def _extender(gram: int):
    """Texts and the places where hashes met to the windows around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places, _, ends = _hashed(batch)
            n_words = np.diff(ends)
            found: list[list[dict]] = []
            for i, hits in enumerate(batch.column("hits")):
                windows: list[dict] = []
                if hits.is_valid:
                    words = _words(data[places[i] : places[i + 1]].tobytes())
                    near: dict[int, set[int]] = {}
                    for hit in hits.as_py():
                        length, at = hit["length"], hit["place"]
                        first = max(at - (length - min(gram, length)), 0)
                        near.setdefault(length, set()).update(range(first, min(at, len(words) - length) + 1))
                    for length, starts in near.items():
                        ordered = sorted(starts)
                        for start, digest in zip(ordered, _digests(words, ordered, length)):
                            windows.append({"start": start, "length": length, "window": digest})
                found.append(windows)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("window", pa.binary())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(n_words, pa.int64()), pa.array(found, kind)],
                ["id", "key", "n_words", "found"],
            )

    return run


def _hit_words(spans: DataFrame) -> DataFrame:
    """Number of words under the ranges (key, start, length) of each text."""
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(end - F.greatest(F.col("start"), reached), F.lit(0))
    return spans.withColumn("fresh", fresh).groupBy("key").agg(F.sum("fresh").cast("bigint").alias("n_hit"))


def contamination(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Return id_col, n_words, n_hit, n_items, items_sha256 and contaminated, one row per row of ``df``.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. A word is hit that
    stands in any occurrence of a window of an item; ``n_items`` counts items with such windows, and
    ``items_sha256`` digests their ids as strings, sorted and joined by commas.

    Defined results: null, empty or wordless texts have no words and are never hit; such items have no
    window. Every row of ``df`` is judged by its own text, whatever its id. Items of one id are one
    item, and those without id are one with an empty id. Other columns are left out.
    """
    scratch = Scratch(df.sparkSession, "decontaminate")
    texts = items.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{item_text_col}`").alias("text")
    )
    read = scratch.keep(
        texts.mapInArrow(
            _item_reader(window, gram), "item string, length int, hashes array<bigint>, windows array<binary>"
        )
    )
    # At most ``window`` rows.
    lengths = sorted(r["length"] for r in read.where("length > 0").select("length").distinct().collect())
    wanted = scratch.keep(read.select("length", F.explode("hashes").alias("hash")).distinct())
    named = scratch.keep(read.select("item", F.explode("windows").alias("of")).distinct())

    key = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key")
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.select("id", "text", key)
    hits = scratch.keep(_met(docs.select("key", "text"), wanted, lengths, gram))
    hits = hits.groupBy(F.col("key").alias("of")).agg(F.collect_list(F.struct("length", "place")).alias("hits"))
    hits = scratch.keep(hits)
    both = docs.join(hits, F.col("key") == F.col("of"), "left").select("id", "key", "text", "hits")
    id_type = both.schema["id"].dataType.simpleString()
    found = "array<struct<start: int, length: int, window: binary>>"
    judged = scratch.keep(
        both.mapInArrow(_extender(gram), f"id {id_type}, key binary, n_words bigint, found {found}")
    )

    spans = judged.select("key", F.explode("found").alias("f")).select("key", "f.start", "f.length", "f.window").distinct()
    spans = scratch.keep(spans.join(named.select("of").distinct(), F.col("window") == F.col("of"), "left_semi"))
    of_item = spans.select("key", "window").distinct().join(named, F.col("window") == F.col("of"))
    of_item = of_item.select("key", "item").distinct().groupBy(F.col("key").alias("of"))
    listed = of_item.agg(F.sort_array(F.collect_list("item")).alias("items"))
    hit = scratch.keep(listed.join(_hit_words(spans), F.col("of") == F.col("key")).select("of", "items", "n_hit"))
    result = judged.join(hit, F.col("key") == F.col("of"), "left")
    n_hit: Column = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return result.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _met(texts: DataFrame, wanted: DataFrame, lengths: Sequence[int], gram: int) -> DataFrame:
    """Distinct (key, length, place) where a text keeps a hash that an item of that length keeps."""
    kept = texts.mapInArrow(_fingerprinter(lengths or [WINDOW], gram), "key binary, places array<int>, hashes array<bigint>")
    pairs = kept.select("key", F.explode(F.arrays_zip("places", "hashes")).alias("p"))
    pairs = pairs.select("key", F.col("p.places").alias("place"), F.col("p.hashes").alias("kept"))
    return pairs.join(wanted, F.col("kept") == F.col("hash")).select("key", "length", "place").distinct()
