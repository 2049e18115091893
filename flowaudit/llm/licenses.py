"""Licence scan with a positional index of rare template words, in DataFrame functions only.

1. The words of all templates are counted over all documents (document frequency, one combined
   aggregation; the result has one row per template word).
2. The index is a posting table: each template's ``rare`` words of highest inverse document
   frequency, with every place they have in the template.
3. Every document's words are cut into blocks, each with a margin as long as the longest template, and
   its indexed words are joined to the postings: a word at place i lets the template start at i
   minus its place there. A start counts on which enough postings of the template agree, within
   ``slack`` places, and if all mandatory phrases stand in its span.
4. What counted is gathered per document.

Phrases are a plainer kind of evidence: places where a phrase's words stand consecutively.

Texts never travel: each block is judged where it is read, only what counted is shuffled. The
postings are broadcast up to ``MOST_POSTINGS`` rows and joined by size beyond. Only the frequencies of
template words, at most as many as the templates have words, come to the driver.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of digits, letters a-z and all characters beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a block, and rows of postings up to which the table is broadcast.
BLOCK = 1024
MOST_POSTINGS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its wording and the phrases without which it does not count."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BETWEEN, self.text.lower()) if w]


# The usual notices of well-known licences.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files, to deal in the Software without restriction",
        ("permission is hereby granted", "free of charge"),
    ),
    Template(
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2.0",
        "This work is licensed under the GNU General Public License, version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the"
        " GNU General Public License as published by the Free Software Foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4",)),
    Template("mpl-2.0", "Licensed under the Mozilla Public License, version 2.0", ("mozilla public license",)),
    Template(
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\","
        " WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,"
        " TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
        " IN THE SOFTWARE.",
        ("permission is hereby granted", "the software is provided as is"),
    ),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE"
        " FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING"
        " OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ("with or without fee is hereby granted", "the author disclaims all warranties"),
    ),
    Template(
        "zlib-text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
        " be held liable for any damages arising from the use of this software. Permission is granted to anyone to"
        " use this software for any purpose, including commercial applications, and to alter it and redistribute it"
        " freely, subject to the following restrictions: The origin of this software must not be misrepresented;"
        " you must not claim that you wrote the original software. If you use this software in a product, an"
        " acknowledgment in the product documentation would be appreciated but is not required. Altered source"
        " versions must be plainly marked as such, and must not be misrepresented as being the original software."
        " This notice may not be removed or altered from any source distribution.",
        ("permission is granted to anyone", "must not be misrepresented"),
    ),
    Template(
        "bsd-3-clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. Neither the name of the copyright"
        " holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission.",
        ("redistribution and use in source and binary forms", "endorse or promote products"),
    ),
    Template(
        "unlicense-text",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means.",
        ("free and unencumbered software", "public domain"),
    ),
)

# Phrases and the labels they stand for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text: Column) -> Column:
    """All words of a text in order, A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def word_frequencies(df: DataFrame, text_col: str, words: Sequence[str]) -> tuple[int, dict[str, int]]:
    """The rows of ``df``, and in how many of them each given word occurs; the words bound the result."""
    wanted = F.array(*[F.lit(w) for w in words])
    # The empty string stands for the row itself.
    found = F.concat(F.array(F.lit("")), F.array_intersect(words_of(F.col(text_col)), wanted))
    rows = df.select(F.explode(found).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in rows}
    return counts.get("", 0), {w: counts.get(w, 0) for w in words}


def rare_words(
    templates: Sequence[Template], frequencies: Mapping[str, int], rows: int, rare: int, common: float
) -> dict[str, list[tuple[str, int]]]:
    """For each template its ``rare`` least frequent words, each with all its places.

    Words that stand in more than the share ``common`` of all rows say little and cost much; they
    are left out as long as one word remains.
    """
    index = {}
    for t in templates:
        places: dict[str, list[int]] = {}
        for place, word in enumerate(t.words):
            places.setdefault(word, []).append(place)
        ranked = sorted(places, key=lambda w: (frequencies.get(w, 0), places[w]))
        telling = [w for w in ranked[:rare] if frequencies.get(w, 0) <= common * rows] or ranked[:1]
        index[t.label] = [(w, place) for w in telling for place in places[w]]
    return index


def needed_votes(postings: int, agree: float) -> int:
    """Postings of a template that have to agree on a start."""
    return min(postings, max(2, math.ceil(agree * postings)))


_POSTINGS = (
    "array<struct<word:string,place:int,label:string,length:int,needed:int,"
    "rare:array<struct<word:string,place:int>>,phrases:array<string>>>"
)


def posting_table(
    spark: SparkSession, templates: Sequence[Template], index: Mapping[str, list[tuple[str, int]]], agree: float
) -> DataFrame:
    """One row per indexed word and place of a template, with what its starts are judged by."""
    rows = [
        {
            "word": word, "place": place, "label": t.label, "length": len(t.words),
            "needed": needed_votes(len(index[t.label]), agree),
            "rare": [{"word": w, "place": p} for w, p in index[t.label]], "phrases": list(t.phrases),
        }
        for t in templates
        for word, place in index[t.label]
    ]
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), _POSTINGS)))
    return F.broadcast(table) if len(rows) <= MOST_POSTINGS else table


def scan_licenses(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    rare: int = 5,
    common: float = 0.05,
    agree: float = 0.75,
    slack: int = 2,
) -> DataFrame:
    """Add what each document says about its licence.

    Returns id_col, n_words, phrase_starts (array of struct<label, start>, in order), matches
    (array of struct<label, start, support>) where support is the share of a template's rare words
    that stand in their places; ``agree`` is the least share, two words at least (or all, for
    templates with fewer).

    Defined results: a null or empty text has no words and nothing found; repeated rows are scanned
    each; columns besides id and text are left out.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    rows, frequencies = word_frequencies(df, text_col, vocabulary)
    index = rare_words(templates, frequencies, rows, rare, common)
    indexed = sorted({w for postings in index.values() for w, _ in postings})
    firsts = sorted({p.split()[0] for p in phrases})
    margin = max((len(t.words) for t in templates), default=0) + slack

    words = F.col("__words")
    # The rows of a table are numbered where they are read; equal ids stay apart.
    read = df.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col).alias("__id"),
        words_of(F.col(text_col)).alias("__words"),
    )
    places = F.col("__places")
    first_at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    starts = [_phrase_starts(words, places, p.split(), label) for p, label in phrases.items()]
    found = read.withColumn("__places", F.when(_any_of(words, firsts), first_at)).select(
        "__row",
        F.struct(
            F.col("__id").alias("id"),
            F.size(words).cast("bigint").alias("n_words"),
            _or_none(F.array_sort(F.concat(*starts)), places.isNotNull()).alias("phrase_starts"),
        ).alias("__base"),
        # The first block stands for the row itself.
        F.explode(F.concat(F.array(F.lit(None).cast(_BLOCKS)), _blocks(words, indexed, margin))).alias("__block"),
    )
    itself = F.col("__block").isNull()
    hits = _hits(F.col("__block"), indexed)
    own = found.withColumn("__base", F.when(itself, F.col("__base")))
    looked_up = own.withColumn("__hit", F.explode_outer(F.when(~itself, hits)))
    postings = posting_table(df.sparkSession, templates, index, agree)
    voted = looked_up.join(postings, F.col("__hit.word") == F.col("word"), "left")
    counted = voted.withColumn("__match", _match(F.col("__block"), F.col("__hit.place") - F.col("place"), slack))
    kept = counted.where(F.col("__base").isNotNull() | F.col("__match").isNotNull())
    whole = kept.groupBy("__row").agg(
        F.first("__base", ignorenulls=True).alias("__base"), F.collect_set("__match").alias("matches")
    )
    return whole.select(
        F.col("__base.id").alias(id_col),
        F.col("__base.n_words").alias("n_words"),
        F.col("__base.phrase_starts").alias("phrase_starts"),
        F.array_sort("matches").alias("matches"),
    )


_STARTS = "array<struct<start:int,label:string>>"
_BLOCKS = "struct<first:int,begin:int,words:array<string>>"


def _any_of(words: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in wanted]))


def _or_none(starts: Column, known: Column) -> Column:
    return F.when(known, starts).otherwise(F.array().cast(_STARTS)).cast(_STARTS)


def _blocks(words: Column, indexed: Sequence[str], margin: int) -> Column:
    """Blocks with an indexed word: their first place, and their words with those of the margins.

    ``begin`` is the place of the first word held.
    """

    def block(first: Column) -> Column:
        begin = F.greatest(first - margin, F.lit(0))
        held = F.slice(words, begin + 1, F.lit(BLOCK + 2 * margin))
        return F.struct(first.cast("int").alias("first"), begin.cast("int").alias("begin"), held.alias("words"))

    starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(BLOCK))
    telling = F.filter(starts, lambda first: _any_of(F.slice(words, first + 1, F.lit(BLOCK)), indexed))
    return F.when(_any_of(words, indexed), F.transform(telling, block)).otherwise(F.array().cast(f"array<{_BLOCKS}>"))


def _hits(block: Column, indexed: Sequence[str]) -> Column:
    """The indexed words of a block itself, margins aside, with their places among the words held."""
    offset = block["first"] - block["begin"]
    own = F.slice(block["words"], offset + 1, F.lit(BLOCK))
    at = F.transform(
        own, lambda w, i: F.when(w.isin(indexed), F.struct((i + offset).alias("place"), w.alias("word")))
    )
    return F.filter(at, lambda x: x.isNotNull())


def _stands_at(words: Column, start: Column, phrase: Sequence[str]) -> Column:
    same = F.lit(True)
    for k, w in enumerate(phrase):
        same = same & F.get(words, start + k).eqNullSafe(F.lit(w))
    return same


def _phrase_starts(words: Column, places: Column, phrase: Sequence[str], label: str) -> Column:
    here = F.filter(places, lambda i: _stands_at(words, i, phrase))
    return F.transform(here, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def _match(block: Column, at: Column, slack: int) -> Column:
    """The template start at a place of the words held, if its postings agree and its phrases stand; else null."""
    words, rare = block["words"], F.col("rare")

    def agrees(r: Column) -> Column:
        near = F.sequence(at + r["place"] - slack, at + r["place"] + slack)
        return F.coalesce(F.exists(near, lambda i: F.get(words, F.when(i >= 0, i)) == r["word"]), F.lit(False))

    votes = F.size(F.filter(rare, agrees))
    span = F.slice(words, F.greatest(at - slack, F.lit(0)) + 1, F.col("length") + 2 * slack)
    text = F.concat(F.lit(" "), F.array_join(span, " "), F.lit(" "))
    stand = F.forall("phrases", lambda p: text.contains(F.concat(F.lit(" "), p, F.lit(" "))))
    match = F.struct(
        F.col("label").alias("label"),
        (at + block["begin"]).alias("start"),
        (votes / F.size(rare)).alias("support"),
    )
    return F.when((votes >= F.col("needed")) & stand, match)
