"""Decontamination by winnowing against brute force and edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from flowaudit.llm import decontaminate

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    lowered = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window):
    wanted: dict = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for s in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[s : s + n]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in wanted}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                known = wanted.get(tuple(w[s : s + n]))
                if known:
                    hit.update(range(s, s + n))
                    found |= known
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def judged(spark, docs, items, **options):
    found = decontaminate.contamination(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **options
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize(("window", "gram", "letters"), [(10, 5, 3), (10, 5, 12), (6, 2, 3), (4, 4, 2), (3, 1, 4)])
def test_hits_equal_brute_force(spark, window, gram, letters):
    rng = random.Random(window * 100 + letters)
    signs = ["a", "b", "C", "é", "1", "d-e", "f'g", "x", "y", "Z9", "ñ", "q"][:letters]
    docs = [
        (k % 90, None if k % 40 == 0 else " ".join(rng.choice(signs) for _ in range(rng.randrange(0, 60))))
        for k in range(120)
    ]
    items = [
        (k % 25 if k else None, None if k == 3 else "  ".join(rng.choice(signs) for _ in range(rng.randrange(0, 16))))
        for k in range(30)
    ]
    items += [(77, " ".join(words(docs[5][1])[4:30])), (78, " ".join(words(docs[7][1])[2:9]))]
    assert judged(spark, docs, items, window=window, gram=gram) == brute(docs, items, window)


def test_every_shared_span_keeps_a_shared_hash():
    rng = np.random.default_rng(1)
    for _ in range(300):
        shared = rng.integers(0, 3, 10).astype(np.uint64)
        one = np.concatenate([rng.integers(0, 3, rng.integers(0, 20)).astype(np.uint64), shared])
        two = np.concatenate([shared, rng.integers(0, 3, rng.integers(0, 20)).astype(np.uint64)])
        at_one, kept_one = decontaminate.winnow(one, 10, 5)
        at_two, kept_two = decontaminate.winnow(two, 10, 5)
        first = set(zip(at_one - (len(one) - 10), kept_one))
        assert any(0 <= place <= 5 and (place, kept) in first for place, kept in zip(at_two, kept_two))


def test_copies_very_long_texts_and_clashing_columns(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    long = " ".join(f"w{k}" for k in range(60_000)) + " " + passage.upper() + " tail"
    docs = [*[(k, f"so {passage} ends") for k in range(40)], (98, long), (99, "nothing of it")]
    items = [(1, f"what is {passage}"), (2, passage)]
    df = spark.createDataFrame([(d, t, b"k", 3) for d, t in docs], f"{DOCS}, key binary, n_words int")
    wide = spark.createDataFrame([(i, t, 1) for i, t in items], f"{ITEMS}, length int")
    found = sorted((tuple(r) for r in decontaminate.contamination(df, wide).collect()), key=repr)
    assert found == brute(docs, items, 10)
    assert next(r for r in found if r[0] == 98)[1:4] == (60_012, 11, 2)


def test_nothing_to_find(spark):
    docs = [(1, "a b c"), (2, None), (None, "")]
    for items in ([], [(1, None), (2, "... !")]):
        assert judged(spark, docs, items) == brute(docs, items, 10)
    assert judged(spark, [], [(1, "a b c")]) == []
