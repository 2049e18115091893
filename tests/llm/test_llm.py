"""Training-data operators against brute force, libraries and edge cases."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowaudit.llm import bitplanes, caps, chat, licenses, minhash, mixing, pages, pieces, queries, rules, sketches
from flowaudit.llm.components import components
from flowaudit.llm.scratch import Scratch
from flowaudit.llm.textops import text_bytes, word_hashes
from flowaudit.llm.tokens import library_encoder

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [None, "", " ", "\n\t ", "One", "one", "a b c d e f g h i j", "a b c d e f g h i j", "é ü 日本 😀  x"]


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(k, t, "en", source, 0) for k, t in enumerate(texts)], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def words(text):
    lowered = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def runs(text, size):
    w = words(text)
    size = min(size, len(w))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()


def groups(sets):
    """Smallest id reachable over pairs of sets with similarity 0.8 or more."""
    label = {i: i for i in sets}
    ids = sorted(sets)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    low, high = sorted((root(a), root(b)))
                    label[high] = low
    return {i: root(i) for i in ids}


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def noise(rng, n):
    return " ".join(rng.choice(["ab", "cd", "efg", "h", "xyz", "w"]) + str(rng.randrange(40)) for _ in range(n))


# Helpers


def test_long_texts_have_the_word_hashes_of_their_words(monkeypatch):
    from flowaudit.llm import textops

    text = "Alpha beta " * 50 + "x" * 300 + " end\nof it"
    whole, _ = word_hashes(*text_bytes(pa.array([text])))
    monkeypatch.setattr(textops, "SLICE_BYTES", 64)
    pieces_of, ends = word_hashes(*text_bytes(pa.array(["", text, None])))
    assert ends.tolist() == [0, 0, len(whole), len(whole)]
    assert (pieces_of == whole).all()
    assert len(np.unique(whole)) == len({w.lower() for w in text.split()})


def test_components_of_chains_hubs_and_nothing(spark):
    chain = [(k + 1, k) for k in range(10, 40)]
    hub = [(100, k) for k in range(101, 160)]
    df = spark.createDataFrame([*chain, *hub, (7, 7), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.label for r in components(df, Scratch(spark, "test")).collect()}
    assert found == {**{k: 10 for k in range(10, 41)}, **{k: 100 for k in range(100, 160)}}
    assert components(df.limit(0), Scratch(spark, "test")).count() == 0


# 1 bit planes


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_planes_give_ids_back(unit):
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.uint32), np.zeros(9, np.uint32), rng.integers(0, 2**32, 1001, dtype=np.uint32)):
        assert (bitplanes.ids_of(bitplanes.planes_of(ids, unit), len(ids), unit) == ids).all()


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_shards_give_documents_and_ranges_back(spark, tmp_path, unit):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [*ODD_TEXTS, "a\x1cb  c\r\n d<|endoftext|>e", "word " * 900]
    df = docs(spark, texts)
    shards = bitplanes.write_shards(df, str(tmp_path / unit), library_encoder(path), block_ids=64, unit=unit)
    got = by_id(bitplanes.read_documents(shards))
    start, everything = 0, []
    for k, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        raw = np.array(ids, "<u4").tobytes()
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)
        everything += ids
    read = []
    for row in shards.orderBy("shard").collect():
        store, place = bitplanes.open_store(row.file)
        with store.open_input_file(place) as source:
            reader = bitplanes.ShardReader(source)
            read += reader.read_ids(0, row.n_ids).tolist()
            assert reader.read_ids(3, 70).tolist() == reader.read_ids(0, row.n_ids).tolist()[3:73]
    assert read == everything
    none = bitplanes.write_shards(df.limit(0), str(tmp_path / f"none-{unit}"), library_encoder(path))
    assert bitplanes.read_documents(none).count() == 0


# 2 minhash


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rng = random.Random(size)
    texts = list(ODD_TEXTS)
    for _ in range(12):
        base = noise(rng, rng.choice([3, 20, 120])).split()
        for _ in range(8):
            edited = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 9))):
                edited[rng.randrange(len(edited))] = rng.choice(["zz", "yy"]) + str(rng.randrange(1000))
            texts.append(" ".join(edited))
    sets = {k: runs(t, size) for k, t in enumerate(texts)}
    got = by_id(minhash.near_duplicates(docs(spark, texts).withColumn("node", F.lit("x")), shingle=size))
    expected = groups(sets)
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {
        k: (len(sets[k]), expected[k], expected[k] == k) for k in sets
    }


def test_folded_sketches_are_those_of_fewer_places():
    found = np.unique(np.random.default_rng(1).integers(0, 2**64, 40_000, dtype=np.uint64))
    long = minhash._odd_sketch(found)
    assert len(long) * 64 == 65_536
    for few in (10, 3000, 10_000):
        short = minhash._odd_sketch(found[:few])
        parity = np.bincount((found[:few] >> np.uint64(40)) & np.uint64(4095), minlength=4096) & 1
        folded = minhash._folded(short, 64)
        assert np.unpackbits(folded.view(np.uint8)).tolist() == parity.tolist()


@pytest.mark.parametrize("n", [500, 3_000, 12_000, 60_000])
def test_sketches_rule_out_unlike_sets_of_any_size_and_no_link(n):
    rng = np.random.default_rng(n)
    template = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)

    def sets_of(similarity):
        shared = int(2 * n * similarity / (1 + similarity))
        return [
            np.unique(np.concatenate([template[:shared], rng.integers(0, 2**64, k * n // 10 - shared, dtype=np.uint64)]))
            for k in (10, 10, 10, 11, 9, 10)
            if k * n // 10 >= shared
        ]

    def ruled_out(similarity):
        sets = sets_of(similarity)
        odd = pa.chunked_array([pa.array([minhash._odd_sketch(x) for x in sets], pa.list_(pa.int64()))])
        sketches = minhash._Sketches(odd, np.array([len(x) for x in sets]), 80)
        out = []
        for i in range(len(sets)):
            at = np.arange(i)
            for j, likeness in zip(at, sketches.likeness(i, at)):
                shared = len(np.intersect1d(sets[i], sets[j]))
                linked = 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared)
                assert not linked or likeness >= 0
                out.append((linked, likeness < 0))
        return out

    assert all(gone for _, gone in ruled_out(0.5))
    assert all(gone for _, gone in ruled_out(0.1))
    assert any(linked for linked, _ in ruled_out(0.85))


def test_one_of_each_group_keeps_null_ids_and_one_of_repeated_rows(spark):
    text = "the same words again and again in one line"
    rows = [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (2, text.upper(), "en", "s", 0), (None, text, "en", "s", 0),
            (None, text, "en", "s", 0), (3, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    assert sorted((r.doc_id for r in minhash.one_of_each_group(df).collect()), key=str) == [1, 3, None, None]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


# 3 sketches


def test_next_text_shuffles_each_text_once(spark):
    rows = sketches.with_next_text(docs(spark, ["a", None, "", "d"]).select("doc_id", "text"))
    assert [r["next_text"] for r in rows.orderBy("doc_id").collect()] == ["", "", "d", "a"]
    plan = rows._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Window":
        plan = plan.children().apply(0)
    shuffled = plan.children().apply(0).output()
    kinds = [shuffled.apply(k).dataType().simpleString() for k in range(shuffled.size())]
    assert kinds.count("string") == 1


def test_sketches_recover_what_differs_and_retry_larger(spark):
    lines = [f"line number {k} of this text" for k in range(400)]
    rows = [("\n".join(lines), "\n".join(lines)), ("\n".join(lines), "\n".join(lines[:200])), (None, ""), ("a b", "c d"),
            ("x\n" * 50, "x\n" * 49)]
    df = spark.createDataFrame(rows, "old string, new string").withColumn("extra", F.lit(1))
    got = sketches.compare_versions(df, [("old", "new", "near")], {"old": "f", "new": "g"}, details=True).collect()
    assert [got[0].near, got[2].near, got[3].near] == [1.0, 1.0, 0.0]
    assert got[0].f == got[0].g and got[0].f != got[1].g
    assert not got[1].near_only_new and got[1].near_only_old
    n = len(sketches.paragraph_digests(*text_bytes(pa.array(rows[1])))[0])
    assert got[1].near == pytest.approx(1 - len(got[1].near_only_old) / n)
    assert 0.9 < got[4].near < 1


def test_edited_texts_are_those_of_the_next_document(spark):
    table = small(spark, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = by_id(queries.op3_paragraph_sketch(spark, SMALL))
    for k, row in enumerate(table):
        own, following = row.text or "", table[(k + 1) % len(table)].text or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert got[row.doc_id].n_chars == len(own)
        assert got[row.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert np.mean([r.near_edited for r in got.values()]) > 0.3 > np.mean([r.near_next for r in got.values()])


# 4 caps


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors, labels = [], []
    for group in range(30):
        base = rng.standard_normal(24)
        for _ in range(12):
            vectors.append((base + rng.standard_normal(24) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist())
            labels.append(group % 3)
    vectors += [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, vectors[0], [1.0, 2.0], []]
    labels += [0, 0, 0, 0, None, 0, 0]
    rows = [(k, v, l) for k, (v, l) in enumerate(zip(vectors, labels))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("weight", F.lit(9))
    got = by_id(caps.near_vectors(df, most=5), "vec_id")
    links = {k: set() for k in range(len(rows))}
    for a in range(360):
        for b in range(a + 1, 360):
            x, y = np.array(vectors[a], float), np.array(vectors[b], float)
            if labels[a] == labels[b] and x @ y >= 0.93 * (np.linalg.norm(x) * np.linalg.norm(y)):
                links[a].add(b)
                links[b].add(a)
    assert {k: r.n_links for k, r in got.items()} == {k: len(v) for k, v in links.items()}
    reach = {}
    for k in sorted(links):
        stack = [k] if k not in reach else []
        while stack:
            at = stack.pop()
            if at not in reach:
                reach[at] = k
                stack += links[at]
    assert {k: r.component_id for k, r in got.items()} == reach
    assert caps.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_of_any_length_equal_brute_force(spark):
    """Pairs just above the wanted cosine, at lengths whose caps differ, wide ones included."""
    rng = np.random.default_rng(11)
    rows, links = [], {}
    for dims in (8, 32, 128, 384):
        for _ in range(60):
            x, y = rng.standard_normal((2, dims))
            y -= x * (x @ y) / (x @ x)
            y = 0.932 * x / np.linalg.norm(x) + math.sqrt(1 - 0.932**2) * y / np.linalg.norm(y)
            rows += [(len(rows), x.tolist(), 0), (len(rows) + 1, y.tolist(), 0)]
    for a, x, _ in rows:
        near = [b for b, y, _ in rows if b != a and len(x) == len(y)
                and np.dot(x, y) >= 0.93 * np.linalg.norm(x) * np.linalg.norm(y)]
        links[a] = len(near)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = by_id(caps.near_vectors(df, most=50), "vec_id")
    assert {k: r.n_links for k, r in got.items()} == links
    assert min(links.values()) >= 1


def test_near_vectors_keep_doubles_apart(spark):
    """Doubles that are equal as floats, or too large or small for a float."""
    big, tiny = 1e300, 1e-300
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 1e-12], 0), (2, [big, big], 0), (3, [2 * big, big], 0),
            (4, [tiny, -tiny], 0), (5, [-tiny, -tiny], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = by_id(caps.near_vectors(df, cosine=0.94), "vec_id")
    assert [got[k].n_links for k in range(6)] == [1, 1, 1, 1, 0, 0]
    got = by_id(caps.near_vectors(df, cosine=1.1), "vec_id")
    assert [got[k].n_links for k in range(6)] == [0] * 6


# 5 licences


def test_license_scan_equals_plain_search(spark):
    notice = licenses.TEMPLATES[2].text
    texts = [*ODD_TEXTS, "Released under the MIT License. mit-license MIT\nLICENSE", "apache  license general public license",
             "x " * 300 + notice, "This work is licensed under the GNU General Public License, version 3. ok", "mit licenses",
             "Licensed under CC BY-NC 4.0."]
    df = docs(spark, texts).withColumn("n_words", F.lit("clash"))
    got = by_id(licenses.scan_licenses(df))
    for k, t in enumerate(texts):
        w = [x for x in re.split(licenses.BETWEEN, (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        found = sorted(
            (i, label)
            for p, label in licenses.PHRASES.items()
            for i in range(len(w))
            if w[i : i + len(p.split())] == p.split()
        )
        assert got[k].n_words == len(w)
        assert [(s.start, s.label) for s in got[k].phrase_starts] == found
    labels = {k: {m.label for m in r.matches} for k, r in got.items()}
    n = len(ODD_TEXTS)
    assert "mit" in labels[n] and labels[n + 2] == {"mit-notice"} and "gpl-3.0" in labels[n + 3]
    assert "cc-by-nc-4.0" in labels[n + 5] and not any(labels[k] for k in range(n)) and not labels[n + 4]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def plain_matches(w, templates, index, agree, slack):
    """Every place tried as a start of every template."""
    found = set()
    for t in templates:
        postings = index[t.label]
        needed = licenses.needed_votes(len(postings), agree)
        length = len(t.words)
        for start in range(-length, len(w)):
            if not any(0 <= start + p < len(w) and w[start + p] == x for x, p in postings):
                continue
            votes = sum(x in w[max(0, start + p - slack) : max(0, start + p + slack + 1)] for x, p in postings)
            low = max(0, start - slack)
            span = f" {' '.join(w[low : low + length + 2 * slack])} "
            if votes >= needed and all(f" {p} " in span for p in t.phrases):
                found.add((t.label, start, votes / len(postings)))
    return sorted(found)


def license_words(t):
    return [x for x in re.split(licenses.BETWEEN, (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]


@pytest.mark.parametrize("block", [16, 1024])
def test_license_matches_equal_trying_every_place(spark, monkeypatch, block):
    """Whole, edited, cut, repeated and nested licence texts among other words, across block ends."""
    monkeypatch.setattr(licenses, "BLOCK", block)
    rng = random.Random(9)
    texts = list(ODD_TEXTS)
    for k in range(60):
        parts = []
        for t in rng.sample(licenses.TEMPLATES, rng.randrange(0, 4)):
            w = t.text.split()
            for _ in range(rng.choice([0, 0, 1, 4])):
                place = rng.randrange(len(w))
                w[place : place + rng.randrange(2)] = rng.choice([[], ["other"], ["MIT"], ["the", "software"]])
            parts += [*["filler"] * rng.randrange(0, 40), *w[: len(w) - rng.choice([0, 0, 3])]]
        texts.append(" ".join(parts))
    texts += [" ".join(licenses.TEMPLATES[12].text for _ in range(30)), "license " * 3000, texts[-1], texts[-1]]
    df = docs(spark, texts + ["plain words only"] * 200)
    texts += ["plain words only"] * 200
    got = by_id(licenses.scan_licenses(df))
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.words})
    sets = [set(license_words(t)) for t in texts]
    frequencies = {w: sum(w in s for s in sets) for w in vocabulary}
    assert licenses.word_frequencies(df, "text", vocabulary) == (len(texts), frequencies)
    index = licenses.rare_words(licenses.TEMPLATES, frequencies, len(texts), 5, 0.05)
    found = 0
    for k, text in enumerate(texts):
        expected = plain_matches(license_words(text), licenses.TEMPLATES, index, 0.75, 2)
        assert [tuple(m) for m in got[k].matches] == expected, text
        found += len(expected)
    assert found > 60


def test_license_rows_with_one_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "mit license", "en", "s", 0), (1, None, "en", "s", 0), (None, "x", "en", "s", 0)], DOCS)
    out = licenses.scan_licenses(df).collect()
    assert sorted((r.n_words, len(r.phrase_starts)) for r in out) == [(0, 0), (1, 0), (2, 1)]


# 6 mixing


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(2)
    rows = [(k, "w " * rng.randrange(0, 30), "en", rng.choice(["a", "b", "b", "b", "c", None]), 0) for k in range(3000)]
    rows.append((9000, None, "en", "empty", 0))
    df = spark.createDataFrame(rows, DOCS).withColumn("rate", F.lit("clash"))
    mix = mixing.mix_copies(df).collect()
    again = by_id(mixing.mix_copies(df.repartition(7)))
    total = sum(r.size for r in mix)
    sizes = {s: sum(r.size for r in mix if r.source == s) for s in ("a", "b", "c", "empty", None)}
    assert all(r.size == len(words(r.text)) and r.copies == again[r.doc_id].copies <= 3 for r in mix)
    target = {r.source: r.target for r in mix}
    assert sum(target.values()) == pytest.approx(total)
    for s, weight in zip(("a", "b", "c", "empty", None), (1, 2, 3, 1, 2)):
        taken = sum(r.size * r.copies for r in mix if r.source == s)
        assert target[s] <= 3 * sizes[s] + 1e-6 and taken == pytest.approx(target[s], rel=0.1, abs=1)
    free = {s: target[s] / w for s, w in zip(("a", "b", "c", None), (1, 2, 3, 2)) if target[s] < 3 * sizes[s] - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in mix)
    assert mixing.mixed(df.limit(0)).count() == 0


# 7 chat


def test_turns_come_back_as_they_were(spark):
    hard = [queries.HOSTILE, "<turn user>\n", "\\", "\\<", "</turn>\n<turn assistant>\nx", "<image 1>", "\\n", "a\\\\<b", "", None]
    rows = [(k, t, ["user", "assistant", "assi>\nst\\", None][t % 4], x, "clash") for k in (5, None) for t, x in enumerate(hard)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, place string")
    turns = chat.format_turns(df)
    for r in turns.collect():
        role, text = chat.parse_turn(r.formatted)
        assert (role, text) == (rows[r.place - 1][2] or "", rows[r.place - 1][3] or "")
    digest = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows[: len(hard)])
    learned = "".join(r[3] or "" for r in rows[: len(hard)] if r[2] == "assistant")
    for r in chat.read_back(turns).collect():
        assert r.turns_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_parts_become_ordered_placeholders(spark):
    part = lambda **k: {**dict.fromkeys(("type", "text", "ref", "width", "height", "seconds", "pages")), **k}
    rows = [
        (1, 0, "user", [part(type="text", text="see <image 1> "), part(type="image", ref="i.png", width=28, height=15), part(type="audio", ref="a.wav", seconds=1.5)]),
        (1, 1, "user", [part(type="document", ref="d.pdf", pages=2), part(type="video", ref="v"), part(type="image")]),
        (1, 2, "assistant", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, parts array<{chat.PART}>")
    got = sorted(chat.format_turns(df).collect(), key=lambda r: r.place)
    assert got[0].formatted == "<turn user>\nsee \\<image 1> <image 1><audio 2></turn>\n"
    assert [(a.placeholder, a.ref, a.tokens) for r in got for a in r.attachments] == [
        ("<image 1>", "i.png", 4), ("<audio 2>", "a.wav", 38), ("<document 3>", "d.pdf", 512), ("<part 4>", "v", 1), ("<image 5>", None, 1),
    ]
    assert [r.tokens for r in got] == [42, 514, 0]
    assert chat.parse_turn(got[0].formatted) == ("user", "see <image 1> ")


# 8 pieces


def test_pieces_equal_the_library(monkeypatch):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model = SentencePieceProcessor(model_file=path), pieces.load_model(path)
    rng = random.Random(4)
    alphabet = "ab cd\n\té日本語 ▁▁  the ing<s></s><unk><0x0A>\x00😀ffiﬁ12.,;K\xa0"
    parts = ["the", " ", "  ", "ing", "er", "ation", " un", "believ", "able", "\n", "x" * 25, " " * 37, "é", "日本"]
    texts = [*[t or "" for t in ODD_TEXTS], "ab" * 6000, " " * 5000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for t in texts:
        ids = library.encode(t)
        assert model.encode(t) == ids, t
        assert model.decode(ids) == library.decode(ids), t
        assert model.segment_pieces("ab") == model._backtracked("ab")
    columns = ["ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"]
    for most in (10, 800_000):
        monkeypatch.setattr(pieces, "REMEMBERED", most)
        for low in range(0, len(texts), 1500):
            part = texts[low : low + 1500]
            found = zip(*[c.to_pylist() for c in pieces._block_columns(model, pa.array(part, pa.large_string()), columns)])
            for t, row in zip(part, found):
                ids = library.encode(t)
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
                assert row == (ids, library.decode(ids), len(ids), *digests), t
    raw = [model.byte_ids[b] for b in b"\xe6\x97a\xff"]
    assert model.decode(raw) == library.decode(raw)


def test_encoding_a_table(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    df = docs(spark, ODD_TEXTS).withColumn("ids", F.lit("clash"))
    got = by_id(pieces.encode_texts(df, path, columns=("ids", "decoded", "n_tokens")))
    assert [got[k].decoded for k in range(len(ODD_TEXTS))] == [t or "" for t in ODD_TEXTS]
    assert all(len(r.ids) == r.n_tokens for r in got.values()) and got[0].ids == []
    assert pieces.encode_texts(df.limit(0), path).count() == 0


# 9 rules


def test_rules_are_read_from_printed_trees():
    printed = "\n".join([
        "DecisionTreeClassificationModel", "  If (feature 0 <= 1.5)", "   If (feature 1 <= 1.0E-4)", "    Predict: 0.0",
        "   Else (feature 1 > 1.0E-4)", "    Predict: 1.0", "  Else (feature 0 > 1.5)", "   Predict: 1.0",
    ])
    found = {r.tests for r in rules.rules_of([printed], ["a", "b"])}
    assert found == {
        (("a", False, 1.5),), (("a", True, 1.5),),
        (("a", False, 1.5), ("b", False, 0.0001)), (("a", False, 1.5), ("b", True, 0.0001)),
    }


def test_quality_is_learned_and_held_out_rows_are_right(spark):
    table, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = docs(spark, [None, "", "x"]).withColumn("doc_id", F.col("doc_id") - 10)
    got = by_id(rules.score_quality(table.unionByName(extra), labels))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([q == p for q, p in held]) > 0.93
    assert np.mean([p for q, p in held if q]) > 0.95


def test_quality_without_labels_is_constant(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {round(r.score, 6) for r in rules.score_quality(docs(spark, ODD_TEXTS), none).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id bigint, quality int")
    df = docs(spark, ODD_TEXTS).withColumn("__log_words", F.lit(0)).drop("__log_words")
    assert rules.keep_good(df, one).columns == df.columns
    assert rules.keep_good(df.limit(0), one).count() == 0


def plain_statistics(text):
    """The statistics of ``rules.STATISTICS``, byte by byte and word by word."""
    w, data = words(text), (text or "").encode()
    if not w:
        return [0.0] * len(rules.STATISTICS)
    counts = dict.fromkeys(("letter", "upper", "digit", "mark", "sign", "!"), 0)
    for c in data:
        ch = chr(c)
        if c >= 128 or "a" <= ch <= "z":
            counts["letter"] += 1
        elif "A" <= ch <= "Z":
            counts["upper"] += 1
        elif "0" <= ch <= "9":
            counts["digit"] += 1
        elif ch == "!":
            counts["!"] += 1
        elif ch in ".,;:?'\"()-":
            counts["mark"] += 1
        elif 33 <= c < 127:
            counts["sign"] += 1
    signs, n = sum(counts.values()), len(w)
    own = {x: w.count(x) for x in set(w)}
    lines = data.split(b"\n")
    ends = sum(c in b".?" and (k + 1 == len(data) or data[k + 1] <= 32) for k, c in enumerate(data))
    return [
        math.log1p(n), signs / n, counts["upper"] / max(1, counts["letter"] + counts["upper"]),
        *[counts[c] / max(1, signs) for c in ("digit", "mark", "sign", "!")],
        len(own) / n, sum(a == b for a, b in zip(w, w[1:])) / n, max(own.values()) / n,
        len(set(lines)) / len(lines), math.log1p(n / len(lines)), ends / n,
    ]


def test_compiled_rules_equal_a_walk_of_the_rules(spark):
    """Scores of the column expression against statistics, rules and weights walked in plain Python."""
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = [*ODD_TEXTS, "Really? Yes! (no)\n\nA-b: 12.5%", "x\ry\tz.\n", "wort " * 5000 + "END.", "\n\n\n"]
    extra = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd)], "doc_id bigint, text string")
    df = table.unionByName(extra)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model, stats = rules.learn_quality(df, labels)
    texts = {r.doc_id: r.text for r in df.collect()}
    assert model.weights
    scored = stats.select("*", model.score().alias("score")).collect()
    assert len(scored) == len(texts)
    for r in scored:
        plain = dict(zip(rules.STATISTICS, plain_statistics(texts[r.doc_id])))
        assert [r[f"__{s}"] for s in rules.STATISTICS] == pytest.approx(list(plain.values()), abs=1e-12), r.doc_id
        total = model.bias
        for rule, weight in model.weights:
            if all((plain[s] > limit) == above for s, above, limit in rule.tests):
                total += weight
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


# 10 pages


def test_main_text_of_given_pages(spark):
    got = by_id(queries.op10_block_rules(spark, SMALL), "page_id")
    for row in small(spark, "pages").collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        plain = html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", article).replace("<b>", "").replace("</b>", ""))
        assert got[row.page_id].text == " ".join(plain.split())
        assert got[row.page_id].n_chars == len(got[row.page_id].text)


LONG = "The cat of the house is in the garden and it was there with us for a while. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p", ""), ("<!-- x", ""), ("plain of the text", "plain of the text"),
        ("<article><p>a &amp; b&nbsp;c<br>d <b>e</b>f</p><script>if(a<b)'</p>'</script><li>g<li>h</article>", "a & b c d ef g h"),
        ("<body class='has-sidebar'><header><h1>Site</h1></header><main><p>It is so</p></main><aside>No</aside>", "It is so"),
        ("<article><header><h1>Head</h1><p>By me</p></header><p>Text of it</p><footer>End</footer></article>", "Head Text of it"),
        ("<article><p>In</p><section id='comments'><article class='comment'><p>Reader of it</p></article></section></article>", "In"),
        ("<div class='cookie-notice'>We use the cookies</div><article>Yes</article><div class='ad'>Buy</div>", "Yes"),
        ("<form><article><p>Inside the form</p></article><input></form>", "Inside the form"),
        (f"<div class=menu><a href=x>Home</a></div><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div>Copyright 2020</div>", f"{LONG.strip()} Short. {LONG.strip()}"),
        (f"<article><p>{LONG}</p><ul><li><a href=a>One link</a></li></ul></article>", LONG.strip()),
        ("<article><p>cut in the mid &am", "cut in the mid &am"),
    ],
)
def test_main_text(page, text):
    assert pages.main_text(page) == text


RUSSIAN = "Кошка сидит в саду около дома, потому что там тепло и никто её не трогает весь день. " * 3
CHINESE = "这只猫整天坐在房子旁边的花园里，因为那里很暖和，没有人打扰它，直到天黑以后它才慢慢地走回家去吃晚饭。"
MENU = "<nav><a href=a>Дом</a></nav><ul><li><a href=b>Ещё</a></li></ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Main text outside of a small article.
        (f"<div><p>{LONG}</p><article class='card'><p>A card of it</p></article><p>{LONG}</p></div>", f"{LONG.strip()} A card of it {LONG.strip()}"),
        (f"<article><a href=x>Only a link</a></article><div><p>{LONG}</p></div>", LONG.strip()),
        (f"<p>{RUSSIAN}</p><article class='card'><p>Да</p></article><p>{RUSSIAN}</p>", f"{RUSSIAN.strip()} Да {RUSSIAN.strip()}"),
        # A little text outside of a large one.
        (f"<article>{f'<p>{LONG}</p>' * 5}</article><p>{LONG}</p>", " ".join([LONG.strip()] * 5)),
        # Languages without a list of stop words.
        (f"{MENU}<p>{RUSSIAN}</p><p>Коротко.</p><p>{RUSSIAN}</p><div>Copyright 2020</div>", f"{RUSSIAN.strip()} Коротко. {RUSSIAN.strip()}"),
        (f"{MENU}<p>{CHINESE}</p><div>2020</div>", CHINESE),
        (f"{MENU}<p>{RUSSIAN[:86]}</p><p>{RUSSIAN[:86]}</p><div>2020</div>", f"{RUSSIAN[:86].strip()} {RUSSIAN[:86].strip()}"),
        (f"{MENU}<div class='ad'>{RUSSIAN}</div><p><a href=x>{RUSSIAN}</a></p>", ""),
    ],
)
def test_main_text_without_a_wrapper_or_a_stop_list(page, text):
    assert pages.main_text(page) == text


AD = "<div class='ad'>Buy</div>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Between two bad blocks of the article.
        (f"<article><p>{LONG}</p>{AD}<p>Advertisement</p>{AD}<p>{LONG}</p></article>", f"{LONG.strip()} {LONG.strip()}"),
        (f"<article><p>{LONG}</p><ul><li><a href=a>More</a><li>Share<li><a href=b>Less</a></ul></article>", LONG.strip()),
        # One bad neighbour, or bad ones outside of the article only.
        (f"<article><p>{LONG}</p><p>Share</p>{AD}</article>", f"{LONG.strip()} Share"),
        (f"{AD}<article><p>Share</p></article>{AD}", "Share"),
        # Headings and long blocks stay.
        (f"<article>{AD}<h2>Head</h2>{AD}<p>{RUSSIAN}</p>{AD}<p>{LONG * 3}</p></article>", f"Head {RUSSIAN.strip()} {(LONG * 3).strip()}"),
    ],
)
def test_neighbours_decide_inside_an_article(page, text):
    assert pages.main_text(page) == text


L = LONG.strip()
COMMENTS = f"<li>{LONG}</li><li>{LONG * 2}</li>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Names that only contain a word of boilerplate, and headings.
        (f"<article><h2 id='navigation'>Of ships</h2><p>{LONG}</p></article>", f"Of ships {L}"),
        (f"<article><p>{LONG}</p><section id='search-algorithms'><p>{LONG}</p></section></article>", f"{L} {L}"),
        (f"<article><p>{LONG}</p><section class='related-work'><p>{LONG}</p></section></article>", f"{L} {L}"),
        (f"<article><p>{LONG}</p><p class='share-price'>It fell by 3.</p></article>", f"{L} It fell by 3."),
        (f"<div class='search-help'>Type to find</div><p>{LONG}</p><p>{LONG}</p>", f"{L} {L}"),
        # Wrappers of the whole page.
        *[
            (f"<div class='{c}'><nav><a href=a>Home</a></nav><p>{LONG}</p><p>{LONG}</p></div>", f"{L} {L}")
            for c in (
                "content with-sidebar", "no-sidebar", "content two-column menu-left", "search-results-page", "modal",
                "page sidebar-right",
            )
        ],
        (f"<div class='sidebar'><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{L} {L}"),
        # A few short lines.
        ("<h1>Short</h1><p>MARK closed today.</p>", "Short MARK closed today."),
        ("<h1>Notice of closure</h1><p>Bridge closed 4 May.</p><p>Call 555.</p>", "Notice of closure Bridge closed 4 May. Call 555."),
        ("<nav><a href=a>Home</a></nav><p>Gone.</p><div>Copyright 2020</div><div class=ad>Buy now</div>", "Gone."),
        # Formulas.
        (f"<article><p>{LONG}so <math><mi>a</mi><mo>=</mo><mi>b</mi><annotation>a=b</annotation></math>.</p></article>", f"{LONG}so a=b."),
        # Readers.
        *[
            (f"<article><p>{LONG}</p></article><{e}>{COMMENTS}</{e.split()[0]}>", L)
            for e in (
                "ol class='commentlist'", "div class='usercomments'", "div id='disqus_thread'", "section class='user-comments'",
                "ul class='comments-area'",
            )
        ],
        (f"<article><p>{LONG}</p><section id='discussion'>{COMMENTS}</section></article>", L),
        (f"<div><p>{LONG}</p><div class='commentary'><p>{LONG}</p></div></div>", f"{L} {L}"),
    ],
)
def test_names_are_one_hint_among_others(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize("tag", ["<div>", "<div class=menu>", "<b>x</i>", "<li>x", "<p>x<td>y</td>", "<article>", "<a href=b>", "<x '"])
def test_time_grows_with_the_length_of_a_page(tag):
    start = time.process_time()
    pages.main_text(tag * 50_000 + f"<p>{LONG}</p>")
    assert time.process_time() - start < 4


def test_extraction_of_very_long_pages():
    page = f"<nav><a href=a>Home</a></nav><article>{f'<p>{LONG}</p>' * 20_000}</article>"
    assert pages.main_text(page) == " ".join([L] * 20_000)


def test_extraction_keeps_columns_and_replaces_text(spark):
    df = spark.createDataFrame([(1, "u", "<article>x</article>", "old"), (1, "u", None, "old")], "page_id int, url string, html string, text string")
    assert sorted(r.text for r in pages.extract_pages(df).collect()) == ["", "x"]
    assert pages.extract_pages(df.limit(0)).columns == ["page_id", "url", "html", "text"]


# Pipeline


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from sentencepiece import SentencePieceProcessor

    table = small(spark, "documents")
    good = corpus_pipeline.quality(spark, table, SMALL)
    assert good.columns == table.columns
    kept = {r.doc_id: r for r in good.collect()}
    labels = groups({k: runs(r.text, 5) for k, r in kept.items()})
    unique = corpus_pipeline.near_dedup(spark, good, SMALL)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(k for k in kept if labels[k] == k)
    mixed = corpus_pipeline.source_mix(spark, unique, SMALL)
    copies = {r.doc_id: r.copies for r in mixing.mix_copies(unique).collect()}
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert len(out) == mixed.count() == sum(copies.values())
    for r in out:
        assert r.ids == library.encode(kept[r.doc_id].text or "") and r.n_tokens == len(r.ids)
    assert math.isclose(sum(r.n_tokens for r in out), sum(copies[k] * len(library.encode(kept[k].text or "")) for k in copies))


def test_pipeline_on_empty_documents(spark):
    docs_in = small(spark, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_in = stage(spark, docs_in, SMALL)
    assert docs_in.count() == 0
