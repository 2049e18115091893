"""Cross-tokenizer alignment: how the ids of two vocabularies cover the same text.

Where tokens of both vocabularies end at the same byte a text falls into groups; a token of one and
a token of the other are linked where their bytes overlap. Work is on Arrow arrays and tables, block
by block:

1. A block of texts is cut into its distinct segments, which neither vocabulary encodes across. The
   ids of all segments are flattened, and running sums of their byte lengths, segment after
   segment, give the place where each token ends; a place belongs to one segment only.
2. A hash join on these ends, full on both sides, gives every place where a token ends, with the
   tokens that end there. A place where both end closes a group. Between one place and the next lies
   exactly one token of each vocabulary, so the places, filled backwards, are the links.
3. Texts are lists of segments. Links of a text's distinct segments are flattened beside their parent
   indices, and ``Table.group_by`` counts the texts of the block that hold each pair.
4. Spark adds the counts up by pair, finds the highest of each first id, and sends both back to the
   pair numbers of each block, where segments and texts add them up.

Texts wait in the shared folder as numbers of their segments, so none is encoded twice and none is
shuffled. A block's pairs and segments are bounded by its bytes, and no task holds the pairs of the
whole corpus.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from flowaudit.llm.scratch import Scratch
from flowaudit.llm.segments import (
    Remembered,
    Vocabulary,
    byte_level_entries,
    bytes_of,
    piece_entries,
    row_ranges,
    segments,
    taken,
)

#: Bytes of text worked on together; a longer text stands alone.
BLOCK_BYTES = 8 << 20
#: Segments of texts whose links are counted together.
_COUNTED = 1 << 18
_TEXT, _PAIR, _LINKS = 0, 1, 2


class Vocabularies(NamedTuple):
    """Both encoders, the decimal form of every id of each, and the segments they have seen."""

    first: Vocabulary
    second: Vocabulary
    first_names: pa.LargeStringArray
    second_names: pa.LargeStringArray
    first_ids: Remembered
    second_ids: Remembered


@lru_cache(maxsize=2)
def load_vocabularies(byte_level_path: str, pieces_path: str) -> Vocabularies:
    """A byte-level vocabulary, its special tokens read as plain text, and a merge-type piece model.

    The model must leave texts as they are but for the space in front, and have no piece that
    reaches over the start of a word or holds a line end, so that segments are its own units.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_level_path)
    library.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=pieces_path)
    entries = piece_entries(pieces)
    for k, entry in enumerate(entries.to_pylist()):
        if not pieces.is_byte(k) and (b"\n" in entry or b" " in entry.lstrip(b" ")):
            raise ValueError("pieces reach over the start of a word or line; this model needs whole texts")

    def names(n: int) -> pa.LargeStringArray:
        return pa.array([str(i) for i in range(n)], pa.large_string())

    first = Vocabulary(
        lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)],
        byte_level_entries(library),
        0,
    )
    second = Vocabulary(lambda texts: pieces.encode(texts, num_threads=1), entries, 1)
    both = names(len(first.entries)), names(len(second.entries))
    return Vocabularies(first, second, *both, Remembered(first), Remembered(second))


class Aligned(NamedTuple):
    """Links and groups of many segments: flat link pairs and n + 1 places, texts and numbers of groups."""

    pairs: np.ndarray
    places: np.ndarray
    n_groups: np.ndarray
    groups: pa.LargeStringArray


def align(first: pa.LargeListArray, second: pa.LargeListArray, vocabularies: Vocabularies) -> Aligned:
    """Align two lists of ids per segment whose bytes are equal and not empty.

    A pair is the first id times 2^32 plus the second; ``groups`` reads ``a1,a2|b1;a3|b2,b3``.
    """
    a, b = pc.list_flatten(first), pc.list_flatten(second)
    a_ends = pa.array(np.cumsum(vocabularies.first.sizes[a.to_numpy()]))
    b_ends = pa.array(np.cumsum(vocabularies.second.sizes[b.to_numpy()]))
    met = pa.table({"end": a_ends, "a": a}).join(
        pa.table({"end": b_ends, "b": b}), "end", join_type="full outer", use_threads=False
    )
    met = met.take(pc.sort_indices(met, [("end", "ascending")])).combine_chunks()
    has_a, has_b = (pc.is_valid(met[c]).to_numpy(zero_copy_only=False) for c in "ab")
    shared = has_a & has_b
    ends = met["end"].to_numpy()
    pairs = pc.fill_null_backward(met["a"]).to_numpy().astype(np.int64) << 32
    pairs += pc.fill_null_backward(met["b"]).to_numpy()
    last = np.concatenate([[0], np.cumsum(pc.list_value_length(first).to_numpy())])
    stops = np.concatenate([[0], a_ends.to_numpy()])[last]
    places = np.searchsorted(ends, stops, side="right")
    group_places = np.searchsorted(ends[shared], stops, side="right")
    sides = [
        _joined(names.take(ids), np.concatenate([[0], np.cumsum(has)[shared]]), ",")
        for names, ids, has in ((vocabularies.first_names, a, has_a), (vocabularies.second_names, b, has_b))
    ]
    groups = _joined(pc.binary_join_element_wise(*sides, _text("|")), group_places, ";")
    return Aligned(pairs, places, np.diff(group_places), groups)


def _joined(texts: pa.LargeStringArray, places: np.ndarray, separator: str) -> pa.LargeStringArray:
    lists = pa.LargeListArray.from_arrays(pa.array(places.astype(np.int64)), texts)
    return pc.binary_join(lists, _text(separator))


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.LargeStringArray]]:
    """Ids and texts, a space in front of each, in blocks of bounded bytes; empty texts stay empty."""
    texts = batch.column("text").cast(pa.large_string()).fill_null("")
    front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    texts = pc.binary_join_element_wise(front, texts, _text(""))
    _, places = bytes_of(texts)
    for low, high in row_ranges(places, BLOCK_BYTES):
        yield batch.column("id").slice(low, high - low), texts.slice(low, high - low)


def _read_texts(make: Callable[[], Vocabularies], schema: pa.Schema):
    """Texts to rows of texts, of linked pairs, and of the links of a block's segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        vocabularies = make()
        for batch in batches:
            for ids, texts in _blocks(batch):
                for columns in _block_rows(ids, texts, vocabularies):
                    rows = len(columns["kind"])
                    yield pa.RecordBatch.from_arrays(
                        [_as(columns.get(f.name), f.type, rows) for f in schema], schema=schema
                    )

    return run


def _as(values, kind: pa.DataType, rows: int) -> pa.Array:
    if values is None:
        return pa.nulls(rows, kind)
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _block_rows(ids: pa.Array, texts: pa.LargeStringArray, vocabularies: Vocabularies) -> Iterator[dict]:
    block = uuid.uuid4().hex
    cut = segments(*bytes_of(texts))
    first, good_first = vocabularies.first_ids.ids(cut.distinct)
    second, good_second = vocabularies.second_ids.ids(cut.distinct)
    good = good_first & good_second
    # A text with a segment whose bytes do not come back has no tokens.
    spoilt = np.concatenate([[0], np.cumsum(~good[cut.numbers])])
    whole = np.diff(spoilt[cut.places]) == 0
    kept = np.repeat(whole, np.diff(cut.places))
    places = np.concatenate([[0], np.cumsum(np.where(whole, np.diff(cut.places), 0))])
    renumbered = np.cumsum(good) - 1
    numbers = renumbered[cut.numbers[kept]].astype(np.int32)
    at = pa.array(np.flatnonzero(good))
    first, second = first.take(at), second.take(at)

    aligned = align(first, second, vocabularies)
    coded = pa.array(aligned.pairs).dictionary_encode()
    pairs, links = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    counts = _texts_of_pairs(numbers, places, links, aligned.places, len(pairs))

    def summed(of_segment: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(of_segment[numbers])])[places])

    spelt = _joined(aligned.groups.take(pa.array(numbers)), places, ";")
    data, ends = bytes_of(spelt)
    held = memoryview(np.ascontiguousarray(data))
    digests = [hashlib.sha256(held[a:b]).hexdigest() if b > a else "" for a, b in zip(ends[:-1], ends[1:])]
    press = zstandard.ZstdCompressor(level=1)
    n = len(ids)
    yield {
        "kind": np.full(n, _TEXT),
        "block": [block] * n,
        "id": ids,
        "n_a": summed(pc.list_value_length(first).to_numpy()),
        "n_b": summed(pc.list_value_length(second).to_numpy()),
        "n_groups": summed(aligned.n_groups),
        "n_links": summed(np.diff(aligned.places)),
        "groups_sha256": digests,
        "packed": [press.compress(numbers[a:b].tobytes()) for a, b in zip(places[:-1], places[1:])],
    }
    found = np.flatnonzero(counts)
    yield {
        "kind": np.full(len(found), _PAIR),
        "block": [block] * len(found),
        "pair": found,
        "a": pairs[found] >> 32,
        "b": pairs[found] & 0xFFFFFFFF,
        "n": counts[found],
    }
    lengths = np.diff(aligned.places).astype(np.int32)
    yield {
        "kind": [_LINKS],
        "block": [block],
        "n_links": [len(lengths)],
        "packed": [press.compress(np.concatenate([lengths, links]).astype(np.int32).tobytes())],
    }


def _texts_of_pairs(
    numbers: np.ndarray, places: np.ndarray, links: np.ndarray, link_places: np.ndarray, n_pairs: int
) -> np.ndarray:
    """How many texts hold each pair, texts being lists of segments and segments lists of links."""
    counts = np.zeros(n_pairs, dtype=np.int64)
    of_segment = pa.LargeListArray.from_arrays(pa.array(link_places.astype(np.int64)), pa.array(links))
    for low, high in row_ranges(places, _COUNTED):
        text = np.repeat(np.arange(high - low), np.diff(places[low : high + 1]))
        held = np.sort(text * len(of_segment) + numbers[places[low] : places[high]])
        held = held[np.concatenate([[True], held[1:] != held[:-1]])] if len(held) else held
        if len(held):
            lists = of_segment.take(pa.array(held % len(of_segment)))
            parents = pc.list_parent_indices(lists)
            met = pa.table(
                {"text": pa.array(held // len(of_segment)).take(parents), "pair": pc.list_flatten(lists)}
            )
            once = met.group_by(["text", "pair"], use_threads=False).aggregate([])
            found = once.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            counts[found["pair"].to_numpy()] += found["count_all"].to_numpy()
    return counts


def _add_up(schema: pa.Schema):
    """Sums over a block's texts of what its pairs count in the whole corpus."""

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        kinds = rows["kind"].to_numpy()
        packed = rows["packed"]
        links_row = int(np.flatnonzero(kinds == _LINKS)[0])
        n_segments = rows["n_links"][links_row].as_py()
        raw = np.frombuffer(unpress.decompress(packed[links_row].as_py()), dtype=np.int32)
        link_places = np.concatenate([[0], np.cumsum(raw[:n_segments], dtype=np.int64)])
        links = raw[n_segments:]
        # Pairs of segments that only texts without tokens hold have no row and are never asked for.
        values = np.zeros((2, int(links.max()) + 1 if len(links) else 0), dtype=np.int64)
        at = pairs["pair"].to_numpy()
        values[0, at] = pairs["best"].to_numpy()
        values[1, at] = pairs["count"].to_numpy()
        sums = [np.diff(np.concatenate([[0], np.cumsum(v[links])])[link_places]) for v in values]
        texts = rows.filter(pa.array(kinds == _TEXT))
        n_best, count_sum = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for k, value in enumerate(texts["packed"]):
            numbers = np.frombuffer(unpress.decompress(value.as_py()), dtype=np.int32)
            n_best[k], count_sum[k] = sums[0][numbers].sum(), sums[1][numbers].sum()
        found = {"n_best": n_best, "count_sum": count_sum}
        columns = [pa.array(found[f.name]) if f.name in found else texts[f.name] for f in schema]
        return pa.table(columns, names=schema.names).cast(schema)

    return run


def align_vocabularies(
    df: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Return id_col, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, one row per row.

    A is the byte-level vocabulary on a space and the text, B the piece model on the text. A pair's
    count is the number of rows of ``df`` that hold it linked; ``n_best`` are links whose count is the
    highest of their A id, and ``count_sum`` adds up the counts of all links. Every worker must be able
    to open both paths.

    Defined results: texts that are null or empty, or whose A or B bytes are not the space and the
    text, have no tokens: zeros, an empty ``groups_sha256``, and no part in counts. Rows of one id, or
    without id, are texts of their own. Other columns are left out. A text longer than ``BLOCK_BYTES``
    is a block of its own.
    """
    scratch = Scratch(df.sparkSession, "alignment")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    of_text = f"id {rows.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
    stored = f"kind int, block string, {of_text}, groups_sha256 string, packed binary, pair int, a int, b int, n bigint"
    stored_arrow = _arrow_schema(stored)
    make = _maker(byte_level_path, pieces_path)
    read = scratch.keep(rows.mapInArrow(_read_texts(make, stored_arrow), stored))
    pairs = read.where(F.col("kind") == _PAIR).select("block", "pair", "a", "b", "n")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = scratch.keep(counts)
    highest = counts.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("most"))
    ranked = counts.join(highest, F.col("a") == F.col("of")).select(
        F.col("a").alias("a1"), F.col("b").alias("b1"), "count", (F.col("count") == F.col("most")).cast("int").alias("best")
    )
    known = pairs.join(ranked, (F.col("a") == F.col("a1")) & (F.col("b") == F.col("b1"))).select(
        F.col("block").alias("of_block"), "pair", "count", "best"
    )
    texts = read.where(F.col("kind") != _PAIR).select(
        "kind", "block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "packed"
    )
    result = f"{of_text}, n_best bigint, count_sum bigint, groups_sha256 string"
    both = texts.groupBy("block").cogroup(known.groupBy("of_block"))
    added = both.applyInArrow(_add_up(_arrow_schema(result)), result)
    return added.withColumnRenamed("id", id_col)


def _maker(byte_level_path: str, pieces_path: str) -> Callable[[], Vocabularies]:
    def make() -> Vocabularies:
        return load_vocabularies(byte_level_path, pieces_path)

    return make


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))
