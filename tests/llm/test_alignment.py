"""Segments and cross-tokenizer alignment against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from flowaudit.llm import alignment
from flowaudit.llm.segments import Vocabulary, bytes_of, byte_level_entries, segment_ids, segments, taken

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "a", "B", "é", "ñ", " ", "  ", "\n", "\t", "\r", " ", " ", "　", "日", "😀", ".", "'s", "\x1c",
    "\x85", "1", "<|endoftext|>", "▁", "<0x41>", "\x00", "the", "ing", "́", "ß", "​", "!", "</s>", "\x7f",
]
ODD = [None, "", " ", "a▁b", "<|endoftext|> x", "é\n\n x  ", "same same", "same same", "\n", "  two  spaces  "]


def random_texts(n, most=30, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.load_vocabularies(BYTE_LEVEL, PIECES)


def ids_by_segments(texts, vocabulary):
    cut = segments(*bytes_of(pa.array(texts, pa.large_string())))
    lists, good = segment_ids(cut.distinct, vocabulary)
    flat, places = taken(lists, cut.numbers, cut.places)
    spoilt = [not good[cut.numbers[a:b]].all() for a, b in zip(cut.places[:-1], cut.places[1:])]
    return [flat[a:b].tolist() for a, b in zip(places[:-1], places[1:])], spoilt


@pytest.mark.parametrize("special", [True, False])
def test_ids_of_segments_are_those_of_whole_texts(special):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_LEVEL)
    library.encode_special_tokens = not special
    vocabulary = Vocabulary(
        lambda xs: [e.ids for e in library.encode_batch_fast(xs, add_special_tokens=False)], byte_level_entries(library), 0
    )
    texts = [*random_texts(3000), "", "end ", "x" * 100_000]
    found, spoilt = ids_by_segments(texts, vocabulary)
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not any(spoilt)


def test_piece_ids_of_segments_and_texts_whose_bytes_do_not_come_back(vocabularies):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    entries = vocabularies.second.entries.to_pylist()
    texts = [t for t in random_texts(3000, seed=4) if t]
    found, spoilt = ids_by_segments([" " + t for t in texts], vocabularies.second)
    for text, ids, bad in zip(texts, found, spoilt):
        wanted = library.encode(text)
        assert bad == (b"".join(entries[i] for i in wanted) != (" " + text).encode())
        assert bad or ids == wanted


def test_remembered_segments_have_the_same_ids(monkeypatch, vocabularies):
    from flowaudit.llm import segments as module

    remembered = module.Remembered(vocabularies.second)
    for most in (1_000_000, 40):
        monkeypatch.setattr(module, "REMEMBERED", most)
        for seed in range(4):
            texts = [" " + t for t in random_texts(60, seed=seed % 2 + 10)] + [" " + "x" * 200]
            distinct = segments(*bytes_of(pa.array(texts, pa.large_string()))).distinct
            lists, good = remembered.ids(distinct)
            wanted, wanted_good = segment_ids(distinct, vocabularies.second)
            assert lists.to_pylist() == wanted.to_pylist() and (good == wanted_good).all()
            assert len(remembered.known) == len(remembered.lists) == len(remembered.good)


def test_segments_reach_the_library_in_short_strings(vocabularies):
    lengths = []

    def encode(texts):
        lengths.extend(map(len, texts))
        return vocabularies.first.encode(texts)

    distinct = pa.array([f" word{k}" for k in range(5000)], pa.large_string())
    lists, good = segment_ids(distinct, vocabularies.first._replace(encode=encode))
    assert good.all() and max(lengths) < 2200
    assert lists.to_pylist() == [list(ids) for ids in vocabularies.first.encode(distinct.to_pylist())]


def brute(texts, vocabularies):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(BYTE_LEVEL), SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    entries_a, entries_b = vocabularies.first.entries.to_pylist(), vocabularies.second.entries.to_pylist()

    def spans(ids, entries):
        ends = np.cumsum([len(entries[i]) for i in ids]).tolist()
        return list(zip([0, *ends], ends, ids))

    rows, links_of, counts = [], [], Counter()
    for text in texts:
        raw = f" {text}".encode()
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(entries_a[i] for i in a) != raw or b"".join(entries_b[i] for i in b) != raw:
            rows.append((0, 0, 0, 0, ""))
            links_of.append([])
            continue
        spans_a, spans_b = spans(a, entries_a), spans(b, entries_b)
        low, groups = 0, []
        for end in sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b}):
            sides = [",".join(str(i) for _, e, i in side if low < e <= end) for side in (spans_a, spans_b)]
            groups.append("|".join(sides))
            low = end
        links = [(i, j) for s, e, i in spans_a for t, f, j in spans_b if s < f and t < e]
        counts.update(set(links))
        links_of.append(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((len(a), len(b), len(groups), len(links), digest))
    best: dict = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (*row[:4], sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), row[4])
        for row, links in zip(rows, links_of)
    ]


def test_alignment_equals_brute_force(spark, vocabularies):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60)
    texts = [*ODD, *random_texts(150, seed=5), *[r.text[:1500] for r in documents.collect()]]
    df = spark.createDataFrame(
        [(k, t, "clash", 1) for k, t in enumerate(texts)], "doc_id bigint, text string, block string, n_a int"
    )
    found = alignment.align_vocabularies(df.repartition(3), BYTE_LEVEL, PIECES)
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, vocabularies)


def test_blocks_give_the_same_rows(monkeypatch, vocabularies):
    texts = [*ODD, *random_texts(80, seed=6)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])

    def rows():
        out, pairs = [], Counter()
        for ids, part in alignment._blocks(batch):
            found = list(alignment._block_rows(ids, part, vocabularies))
            out += list(zip(ids.to_pylist(), found[0]["n_links"].tolist(), found[0]["groups_sha256"]))
            for a, b, n in zip(found[1]["a"], found[1]["b"], found[1]["n"]):
                pairs[a, b] += n
        return out, pairs

    whole = rows()
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 40)
    monkeypatch.setattr(alignment, "_COUNTED", 3)
    assert rows() == whole


def test_alignment_of_repeated_rows_rows_without_id_and_nothing(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one"), (2, "")], "doc_id bigint, text string")
    found = alignment.align_vocabularies(df, BYTE_LEVEL, PIECES).collect()
    assert len(found) == 4
    twice = [r for r in found if r.doc_id == 1]
    assert twice[0] == twice[1] and twice[0].n_best == twice[0].n_links
    assert next(r for r in found if r.doc_id == 2)[1:] == (0, 0, 0, 0, 0, 0, "")
    assert next(r for r in found if r.doc_id is None).count_sum == 3
    assert alignment.align_vocabularies(df.limit(0), BYTE_LEVEL, PIECES).count() == 0
