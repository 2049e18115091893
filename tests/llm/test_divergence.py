"""Source divergence against brute force, with digests that collide and sources in many blocks."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from flowaudit.llm import divergence

ROWS = "lang string, source string, text string"


def brute(rows, least_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = term.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
        groups[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(count):
            below = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // below for t in kept}

        whole: Counter = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            above = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(above)[:top])):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(found)]
    return sorted(out)


def audited(spark, rows, **options):
    found = divergence.divergence(spark.createDataFrame(rows, ROWS).repartition(3), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def invented(n, seed, sources=9):
    rng = random.Random(seed)
    stock = ["the", "The", "é", "ÉÀ", "naïve", "x1y", "日本", "a_b", "don't", *[f"{c}{d}" for c in "abcde" for d in "pqrst"]]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(stock) for _ in range(rng.randrange(0, 40)))
        rows.append((rng.choice(["en", "fr", None]), rng.choice([None, *[f"s{k}" for k in range(sources)]]), text))
    return [*rows, ("en", "empty", None), ("xx", "alone", "few words here"), ("xx", "other", "")]


@pytest.mark.parametrize(
    "options", [{}, {"digest_bits": 3}, {"digest_bits": 0}, {"digest_bits": 5, "block_sources": 3, "slice_counts": 20}]
)
def test_audit_equals_brute_force(spark, options):
    rows = invented(150, 1)
    assert audited(spark, rows, least_docs=5, top=4, **options) == brute(rows, 5, 4)


def test_ties_settled_by_bytes_of_the_item(spark):
    rows = [("en", s, f"{t} rest") for s in "ab" for t in ("zeta", "éta", "alpha", "beta") for _ in range(3)]
    rows += [("en", "c", "rest") for _ in range(30)]
    found = audited(spark, rows, least_docs=6, top=2)
    assert found == brute(rows, 6, 2)
    assert [r[3] for r in found if r[1] == "a" and r[2] == "term"] == ["alpha", "beta"]


def test_nothing_and_languages_that_keep_no_term(spark):
    assert audited(spark, []) == []
    rows = [("en", "a", "one two"), ("en", "b", None), ("fr", "a", "")]
    assert audited(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_clashing_columns_and_repeated_rows(spark):
    rows = invented(60, 2, sources=3) * 2
    wide = spark.createDataFrame([(*r, 1, "t", 5) for r in rows], f"{ROWS}, place int, term string, n int")
    found = sorted(tuple(r) for r in divergence.divergence(wide, least_docs=4).collect())
    assert found == brute(rows, 4, 50)


def test_counts_do_not_depend_on_slices(monkeypatch):
    rows = invented(80, 3)
    rows.append(("en", "long", "word Word wörd " * 40_000))
    names = ["lang", "source", "text"]
    filled = [[v or "" for v in column] for column in zip(*rows)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in filled], names)

    def summed():
        total: Counter = Counter()
        for part in divergence._counter(["lang", "source"], 64)(iter([batch])):
            for r in part.to_pylist():
                key = r["lang"], r["source"], r["digest"], r["term"]
                total[key, "n"] += r["n"]
                total[key, "docs"] += r["docs"]
        return total

    whole = summed()
    assert sorted(n for k, n in whole.items() if k[0][1] == "long" and k[1] == "n") == [40_000, 80_000]
    monkeypatch.setattr(divergence, "SLICE_BYTES", 100)
    monkeypatch.setattr(divergence, "HELD", 10)
    assert summed() == whole


def test_differences_of_blocks_add_up():
    rng = np.random.default_rng(2)
    shares = rng.integers(1, 100, (5, 30))
    held = rng.random((5, 30)) < 0.4
    none = [3, 1, 4, 1, 5]
    dense = np.where(held, shares, np.array(none)[:, None])
    wanted = {(i, j): int(np.abs(dense[i] - dense[j]).sum()) for i in range(5) for j in range(i + 1, 5)}

    def part(low, high):
        mine = [s for s in range(5) if s // 2 in (low, high)]
        rows = [(s, None, none[s]) for s in mine]
        rows += [(s, str(t), int(shares[s, t])) for s in mine for t in range(30) if held[s, t]]
        place, term, p = zip(*rows)
        n = len(rows)
        return pa.table(
            {"lang": ["en"] * n, "low": [low] * n, "high": [high] * n, "place": place, "term": pa.array(term, pa.string()), "p": p}
        )

    found: dict = {}
    for low in range(3):
        for high in range(low, 3):
            for r in divergence._differences(2)(part(low, high)).to_pylist():
                unseen = (30 - r["terms"]) * abs(none[r["one"]] - none[r["two"]])
                assert (r["one"], r["two"]) not in found
                found[r["one"], r["two"]] = r["value"] + unseen
    assert found == wanted
