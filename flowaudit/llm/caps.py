"""Near-duplicate vectors by spherical-cap filters.

A filter is a random direction; a vector passes those with which its inner product (at length 1)
is ``least`` or more, the cap around the direction. Directions are structured as product codes: a
random rotation cuts the space into ``blocks`` blocks with ``words`` random code words each, and
every combination of words is a direction. A vector is list-decoded: block by block only the partial
sums that can still reach ``least`` are extended, so the work follows the number of caps found, not
the number of directions. ``codes`` independent codes make the odds even across vectors.

Vectors that share a cap are compared exactly. Inner products with a direction shrink as vectors get
longer, so ``least`` is found for each vector length and cosine: a sample of pairs at just that
cosine gives the highest ``least`` at which each pair still shares a cap, and ``least`` is set as far
below their mean as leaves about 5 of 100,000 pairs without a shared cap; closer pairs share one more
surely. With 5 codes of 2 x 64 words that is 0.33 for 64 dimensions at cosine 0.93. Where caps would
not save comparisons (short vectors, low cosines), all vectors of a length are put in one cap, which
compares them exactly block by block.

Equal vectors are one node with a weight. Buckets larger than ``most`` are cut into blocks and every
pair of blocks is a task of its own. A pair that shares several caps is counted in the lowest one.
Blocks give back counts and a spanning forest, never their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.llm.components import components
from flowaudit.llm.scratch import Scratch, apart


# Vectors shorter than SHORT have a heavy tail of pairs that share no cap, and those
# shorter than LONG one that is a little heavier than for all longer ones; how many standard
# deviations below the mean ``least`` lies, for both kinds.
SHORT, LONG = 24, 64
BELOW, BELOW_SHORT = 3.0, 3.6
SAMPLE = 2000


class CapCode:
    """Filter directions for vectors of one length; ``least`` is None where all are compared."""

    def __init__(
        self, dims: int, codes: int, blocks: int, words: int, least: float | None, seed: int, cosine: float
    ):
        self.blocks, self.words, self.least = min(blocks, dims), words, least
        if least is None and dims < SHORT:
            return
        self.edges = np.linspace(0, dims, self.blocks + 1).astype(int)
        self.books = []
        for c in range(codes):
            rng = np.random.default_rng([seed, dims, c])
            turn, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
            book = []
            for low, high in zip(self.edges[:-1], self.edges[1:]):
                directions = rng.standard_normal((words, high - low))
                directions /= np.linalg.norm(directions, axis=1, keepdims=True) * np.sqrt(self.blocks)
                book.append(directions @ turn[:, low:high].T)
            self.books.append(book)
        if least is None:
            self.least = self._least(dims, cosine, seed)

    def _least(self, dims: int, cosine: float, seed: int) -> float | None:
        """The bound that nearly all pairs at ``cosine`` reach in a cap they share."""
        rng = np.random.default_rng([seed, dims])
        cosine = min(max(cosine, -1.0), 1.0)
        step = max(1, 2**20 // self.words**self.blocks)
        tops, seen = [], []
        for low in range(0, SAMPLE, step):
            x, y = rng.standard_normal((2, min(step, SAMPLE - low), dims))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            y -= (x * y).sum(axis=1, keepdims=True) * x
            y /= np.linalg.norm(y, axis=1, keepdims=True)
            y = cosine * x + np.sqrt(1 - cosine**2) * y
            both = [np.minimum(_sums(x, book), _sums(y, book)).max(axis=1) for book in self.books]
            tops.append(np.max(both, axis=0))
            seen.append(x[:50])
        tops = np.concatenate(tops)
        self.least = tops.mean() - (BELOW if dims >= LONG else BELOW_SHORT) * tops.std()
        caps = np.mean([len(found) for found in self.decode(np.concatenate(seen)[:200])])
        # Members of a cap are compared pairwise: so many caps meet as often as all pairs would.
        return float(self.least) if caps**2 < len(self.books) * self.words**self.blocks else None

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted numbers of all directions whose cap it lies in."""
        if self.least is None:
            return [np.zeros(1, np.int64) for _ in units]
        size = self.words**self.blocks
        found: list[list[np.ndarray]] = [[] for _ in units]
        for c, book in enumerate(self.books):
            scores = [units @ words.T for words in book]
            # What the blocks after each one can add at most.
            rest = np.zeros((len(units), self.blocks + 1))
            for b in range(self.blocks - 1, 0, -1):
                rest[:, b] = rest[:, b + 1] + scores[b].max(axis=1)
            for i in range(len(units)):
                sums, numbers = np.zeros(1), np.zeros(1, dtype=np.int64)
                for b in range(self.blocks):
                    grown = sums[:, None] + scores[b][i][None, :]
                    at = np.nonzero(grown >= self.least - rest[i, b + 1])
                    sums, numbers = grown[at], numbers[at[0]] * self.words + at[1]
                found[i].append(np.sort(numbers) + c * size)
        return [np.concatenate(parts) for parts in found]


def _sums(units: np.ndarray, book: list[np.ndarray]) -> np.ndarray:
    """Inner products with all directions of a code."""
    sums = np.zeros((len(units), 1))
    for words in book:
        sums = (sums[:, :, None] + (units @ words.T)[:, None, :]).reshape(len(units), -1)
    return sums


@lru_cache(maxsize=32)
def cap_code(
    dims: int, codes: int, blocks: int, words: int, least: float | None, seed: int, cosine: float
) -> CapCode:
    """The code for a vector length, made once per worker; the seed fixes it."""
    return CapCode(dims, codes, blocks, words, least, seed, cosine)


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = 0.93,
    codes: int = 5,
    blocks: int = 2,
    words: int = 64,
    least: float | None = None,
    most: int = 512,
    seed: int = 7,
) -> DataFrame:
    """Return id_col, n_links, component_id and kept, one row per row of ``df``.

    Vectors are compared in double precision within a label, and linked from ``cosine`` on. A given
    ``least`` holds for vectors of every length; without, it is found for each length.

    Defined results: a null label, a null, empty or zero vector, and one with null or non-finite
    parts are linked with nothing, and so are vectors of different lengths. Repeated rows are linked
    with each other. Rows without id are linked with nothing and have no component. Columns besides
    id, vector and label are left out.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "caps")
    # Floats are kept as they are; every other type is read as double.
    given = df.schema[vector_col].dataType.simpleString()
    vectors = given if given == "array<float>" else "array<double>"
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast(vectors).alias("vector"),
        F.col(label_col).alias("label"),
    )
    sound = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    valid = rows.where(sound)
    nodes = valid.groupBy("label", "vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))
    options = (codes, blocks, words, least, seed, cosine)
    label_type = rows.schema["label"].dataType.simpleString()
    kind = f"label {label_type}, vector {vectors}, node bigint, weight bigint, caps array<bigint>"
    nodes = scratch.keep(nodes.mapInArrow(_decoder(options), kind))

    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Vectors of different lengths never meet, as if their labels differed.
    place = F.xxhash64("label", F.size("vector"))
    keys = nodes.select(F.explode("caps").alias("cap"), place.alias("place"), "node")
    counts = keys.groupBy("place", "cap").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    counts = counts.select(F.col("place").alias("p"), F.col("cap").alias("c"), F.ceil(F.col("members") / most).cast("int").alias("parts"))
    same = (apart(F.col("place")) == apart(F.col("p"))) & (F.col("cap") == F.col("c"))
    shared = keys.join(counts, same).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # Part k meets parts 0 to k as the higher one and the rest as the lower one.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(k, "part").alias("low"), F.greatest(k, "part").alias("high")),
    )
    dealt = shared.select("place", "cap", "node", "part", F.explode(pairs).alias("pair"))
    dealt = dealt.select("place", "cap", "node", "part", "pair.low", "pair.high")
    whole = nodes.select(F.col("node").alias("of"), place.alias("at"), "vector", "weight", "caps")
    met = dealt.join(whole, (F.col("node") == F.col("of")) & (F.col("place") == F.col("at"))).drop("of", "at")
    bucket = ["place", "cap", "low", "high"]
    met = met.repartition(wide, *bucket).sortWithinPartitions(*bucket)
    found = scratch.keep(met.mapInArrow(_comparer(cosine), "node bigint, links bigint, root bigint"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b"))
    labels = components(edges, scratch)
    named = (
        nodes.select("label", "vector", "node", "weight")
        .join(links.withColumnRenamed("node", "n1"), F.col("node") == F.col("n1"), "left")
        .join(labels.select(F.col("node").alias("n2"), F.col("label").alias("component")), F.col("node") == F.col("n2"), "left")
        .select(
            F.col("label").alias("its_label"),
            F.col("vector").alias("its_vector"),
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    same = (F.col("label") == F.col("its_label")) & (F.col("vector") == F.col("its_vector")) & F.col("sound")
    out = rows.withColumn("sound", sound).join(named, same, "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return _in_range(np.stack([np.asarray(v, dtype=np.float64) for v in column.to_numpy(zero_copy_only=False)]))


def _in_range(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -power)


def _decoder(options: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = batch.column("vector").to_numpy(zero_copy_only=False)
            caps: list[np.ndarray] = [np.zeros(0, np.int64)] * len(vectors)
            lengths = np.array([len(v) for v in vectors])
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                for low in range(0, len(at), 1024):
                    some = at[low : low + 1024]
                    units = _in_range(np.stack([np.asarray(vectors[i], dtype=np.float64) for i in some]))
                    units /= np.linalg.norm(units, axis=1, keepdims=True)
                    for i, numbers in zip(some, cap_code(int(dims), *options).decode(units)):
                        caps[i] = numbers
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(caps, pa.list_(pa.int64()))], [*batch.schema.names, "caps"]
            )

    return run


def _comparer(cosine: float):
    """Compares the members of each bucket block by block; rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("place", "cap", "low", "high")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            done = []
            for low, high in zip([0, *cuts], [*cuts, len(batch)]):
                key = tuple(keys[:, low])
                if key != current and held:
                    done += _compared(pa.Table.from_batches(held), cosine)
                    held = []
                current = key
                held.append(batch.slice(low, high - low))
            if done:
                yield _found(done)
        if held and (done := _compared(pa.Table.from_batches(held), cosine)):
            yield _found(done)

    return run


def _found(done: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*done)]
    roots = pa.array(columns[2], pa.int64(), mask=columns[2] == columns[0])
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), roots], ["node", "links", "root"])


def _compared(members: pa.Table, cosine: float) -> list[tuple]:
    """(nodes, weights of newly found neighbours, roots) of one bucket, or nothing."""
    if len(members) < 2:
        return []
    first = members.slice(0, 1)
    cap, low, high = (first.column(c)[0].as_py() for c in ("cap", "low", "high"))
    vectors = _matrix(members.column("vector").combine_chunks())
    norms = np.linalg.norm(vectors, axis=1)
    linked = vectors @ vectors.T >= cosine * np.outer(norms, norms)
    np.fill_diagonal(linked, False)
    if low != high:
        part = members.column("part").to_numpy()
        linked &= part[:, None] != part[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return []
    linked = linked[np.ix_(some, some)]
    caps = members.column("caps").combine_chunks().to_numpy(zero_copy_only=False)
    linked &= ~_share_lower([caps[i] for i in some], cap)
    some_linked = linked.any(axis=1)
    some, linked = some[some_linked], linked[np.ix_(some_linked, some_linked)]
    if not len(some):
        return []
    nodes = members.column("node").to_numpy()[some]
    weights = members.column("weight").to_numpy()[some]
    return [(nodes, linked.astype(np.int64) @ weights, _roots(nodes, linked))]


def _share_lower(caps: list[np.ndarray], cap: int) -> np.ndarray:
    """Which members share a cap with a lower number, and so were compared there."""
    lower = [c[c < cap] for c in caps]
    numbers, counts = np.unique(np.concatenate(lower), return_counts=True)
    numbers = numbers[counts > 1]
    inside = np.zeros((len(caps), len(numbers)), dtype=np.float32)
    for i, own in enumerate(lower):
        at = np.searchsorted(numbers, own)
        at = at[at < len(numbers)]
        inside[i, at[numbers[at] == own[: len(at)]]] = 1
    return inside @ inside.T > 0


def _roots(nodes: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest node each member reaches inside the block."""
    roots = nodes.copy()
    while True:
        near = np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1)
        lower = np.minimum(roots, near)
        if (lower == roots).all():
            return roots
        roots = lower
