"""Quality classifier: a sparse ensemble of rules over text statistics.

Every text becomes a row of statistics. Shallow trees are grown on labelled rows; every path from a
root is a rule, a conjunction of comparisons. A lasso logistic regression over the rules keeps few
of them, and those are compiled to one Spark column expression, which scores without Python.

Statistics, trees and weights see all labelled rows that the caller passes; nothing is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowaudit.llm.scratch import Scratch
from flowaudit.llm.textops import parts_of, text_bytes, word_hashes

STATISTICS = (
    "log_words", "mean_word", "upper_share", "digit_share", "mark_share", "symbol_share", "bang_share",
    "distinct_words", "repeated_next", "top_word", "distinct_lines", "mean_line", "sentence_ends",
)


def _class_table() -> np.ndarray:
    """Byte classes: 1 lower letter, 2 upper letter, 3 digit, 4 sentence mark, 5 other sign, 6 !, 7 line end."""
    table = np.zeros(256, dtype=np.uint8)
    table[33:127] = 5
    table[97:123], table[65:91], table[48:58] = 1, 2, 3
    for c in ".,;:?'\"()-":
        table[ord(c)] = 4
    table[ord("!")], table[10], table[128:] = 6, 7, 1
    return table


_CLASSES = _class_table()


def _named(statistic: str) -> str:
    return f"__{statistic}"


def text_statistics(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the statistics of the text, all doubles, all 0 for a text without words.

    Statistics are named with two leading underscores. Work is per row, without a shuffle.
    """
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, text_col):
            data, places = text_bytes(batch.column(text_col))
            words, ends = word_hashes(data, places)
            table = np.zeros((len(batch), len(STATISTICS)))
            for i in range(len(batch)):
                if ends[i + 1] > ends[i]:
                    table[i] = _statistics(data[places[i] : places[i + 1]], words[ends[i] : ends[i + 1]])
            columns = [pa.array(np.ascontiguousarray(c)) for c in table.T]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *columns], [*keep, *map(_named, STATISTICS)])

    rows = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])
    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    for s in STATISTICS:
        schema = schema.add(_named(s), "double")
    return rows.mapInArrow(run, schema)


def _statistics(text: np.ndarray, words: np.ndarray) -> list[float]:
    n, chars = len(words), len(text)
    kinds = np.zeros(8, dtype=np.int64)
    sentence_ends = 0
    for low in range(0, chars, 1 << 20):
        part = text[low : low + (1 << 20)]
        kinds += np.bincount(_CLASSES[part], minlength=8)
        stop = (part == 46) | (part == 63)
        sentence_ends += int(stop[:-1][part[1:] <= 32].sum()) + int(stop[-1])
    letters = max(int(kinds[1] + kinds[2]), 1)
    _, counts = np.unique(words, return_counts=True)
    signs = int(kinds[1:7].sum())
    lines = _line_hashes(text)
    return [
        float(np.log1p(n)),
        signs / n,
        kinds[2] / letters,
        kinds[3] / max(signs, 1),
        kinds[4] / max(signs, 1),
        kinds[5] / max(signs, 1),
        kinds[6] / max(signs, 1),
        len(counts) / n,
        float((words[1:] == words[:-1]).sum()) / n,
        float(counts.max()) / n,
        len(np.unique(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sentence_ends / n,
    ]


def _line_hashes(text: np.ndarray) -> list[int]:
    return [hash(line) for line in text.tobytes().split(b"\n")]


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, whether above, threshold) for each comparison."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        met = F.lit(True)
        for name, above, threshold in self.tests:
            met = met & (F.col(_named(name)) > threshold if above else F.col(_named(name)) <= threshold)
        return met


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; the score is the logistic function of the bias and the rules that hold."""

    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


_TEST = re.compile(r"\(feature (\d+) (<=|>) (-?[\d.]+(?:E-?\d+)?)\)")


def rules_of(trees: Sequence[str], names: Sequence[str]) -> list[Rule]:
    """All distinct paths of printed trees, from the root to any inner node or leaf."""
    found: dict[Rule, None] = {}
    for printed in trees:
        path: list[tuple[str, bool, float]] = []
        depths: list[int] = []
        for line in printed.splitlines():
            test = _TEST.search(line)
            if not test:
                continue
            depth = len(line) - len(line.lstrip())
            while depths and depths[-1] >= depth:
                depths.pop()
                path.pop()
            depths.append(depth)
            path.append((names[int(test[1])], test[2] == ">", float(test[3])))
            found[Rule(tuple(sorted(set(path))))] = None
    return list(found)


def fit_rules(
    labelled: DataFrame, label_col: str = "label", trees: int = 12, depth: int = 3, penalty: float = 0.0005, seed: int = 11
) -> RuleModel:
    """Fit the ensemble on rows of statistics with a 0/1 label.

    Defined results: rows with a null label are left out; with one label only the score is that
    label's share, and one half without any labelled row.
    """
    rows = labelled.where(F.col(label_col).isin(0, 1)).withColumn("__label", F.col(label_col).cast("double"))
    count, mean = rows.agg(F.count(F.lit(1)), F.avg("__label")).first()
    if not count or mean in (0.0, 1.0):
        share = min(max(mean if count else 0.5, 1e-6), 1 - 1e-6)
        return RuleModel(float(np.log(share / (1 - share))), ())
    stats = VectorAssembler(inputCols=[*map(_named, STATISTICS)], outputCol="__stats").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="__stats", labelCol="__label", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", bootstrap=False, seed=seed,
    ).fit(stats)
    rules = rules_of([t.toDebugString for t in forest.trees], STATISTICS)
    names = [f"__rule{k}" for k in range(len(rules))]
    held = rows.select("__label", *[r.column().cast("double").alias(n) for r, n in zip(rules, names)])
    held = VectorAssembler(inputCols=names, outputCol="__rules").transform(held)
    lasso = LogisticRegression(
        featuresCol="__rules", labelCol="__label", elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False
    ).fit(held.select("__rules", "__label"))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w]
    return RuleModel(float(lasso.intercept), tuple(kept))


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether the checksum of the id as text leaves no rest by ``folds``; false for null."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    scratch: Scratch | None = None,
    **options,
) -> tuple[RuleModel, DataFrame]:
    """Learn from the labelled rows of ``df`` that are not held out.

    Returns the model and the statistics of all rows, kept in the shared folder.
    """
    scratch = scratch or Scratch(df.sparkSession, "rules")
    stats = scratch.keep(text_statistics(df, text_col, [id_col]))
    known = labels.select(F.col(id_col).alias("__of"), F.col(label_col).alias("__quality"))
    learned = stats.join(known, F.col(id_col) == F.col("__of")).where(~held_out(F.col(id_col)))
    learned = scratch.keep(learned.select(*map(_named, STATISTICS), "__quality"))
    return fit_rules(learned, "__quality", **options), stats


def score_quality(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options
) -> DataFrame:
    """Score every row of ``df`` by a model learned from ``labels`` (id_col, quality 0/1).

    Returns id_col, held_out, score (likelihood of label 1) and predicted (1 from ``threshold`` on),
    one row per row of ``df``. Statistics of texts are the only inputs of a score.

    Defined results: a null text counts as empty; every text has a score; rows without id are scored
    but never learned from; an id labelled twice is learned twice; other columns are left out.
    """
    model, stats = learn_quality(df, labels, id_col, text_col, **options)
    return stats.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        model.score().alias("score"),
        (model.score() >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options
) -> DataFrame:
    """The rows of ``df`` with a score of ``threshold`` or more, in their own columns.

    Each row is scored on its own text in place, so no text is shuffled.
    """
    model, _ = learn_quality(df, labels, id_col, text_col, **options)
    scored = text_statistics(df, text_col, df.columns)
    return scored.where(model.score() >= threshold).select(*[F.col(f"`{c}`") for c in df.columns])
