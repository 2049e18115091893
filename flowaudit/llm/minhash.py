"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct runs of ``shingle`` words (lower-cased A-Z; fewer words make one
run). Documents are linked where 100 * intersection >= ``percent`` * union, and every link that
counts is confirmed on the full sets.

1. One pass turns each text into a digest of its set, packed low bits of its minima, one key per
   band of minima, and an odd sketch (the parity of how many runs fall on each of ``SKETCH_BITS``
   places, or of more for a larger set). Equal sets become one node, so exact copies never meet each other again.
2. Nodes that share a band key are candidates. In a first round every member of a bucket is
   compared with the bucket's smallest member only: a group of n near copies gives n candidates,
   not n^2. The packed bits estimate the similarity, corrected for chance collisions, and only
   the most similar candidate of each node goes on to the exact test.
3. Components of these links are formed. In buckets that still hold several components, members are
   compared block by block inside tasks by their odd sketches, and each block gives out the most
   similar pairs that would join its components, fewer than it has components, for the exact test.
   When these links are in, every pair across components that the sketches do not rule out is
   tested, each in the first band it shares, so no link between two components is missed.

A pair at the threshold shares a band with probability 1 - (1 - s^rows)^bands: with 0.8, 6 rows
and 48 bands all but 5 in 10 million. The packed bits' estimate may lie ``slack`` below the threshold,
about five of its standard deviations. The odd sketch rules out no link: two sketches differ on at
most as many places as the sets have runs not in common.

Defined results: null, empty or wordless texts have an empty set and are linked with nothing. Rows
of one id count as one document. Rows without id are linked with nothing and get no component.
Columns besides id and text are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowaudit.llm.components import components
from flowaudit.llm.scratch import Scratch, apart
from flowaudit.llm.textops import mix, parts_of, shingle_hashes, text_bytes, word_hashes

BITS = 4
_LANES = 64 // BITS
_FEATURES = (
    "id bigint, n_shingles bigint, digest binary, packed array<bigint>, bands array<bigint>, odd array<bigint>"
)
SKETCH_BITS = 4096
#: Members of a bucket that are compared in one block, fewer where their sketches are long.
BLOCK = 4096
_CHUNK = 2048


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = 48,
    rows: int = 6,
    slack: float = 0.12,
) -> DataFrame:
    """Return id_col, n_shingles, component_id and kept, one row per row of ``df``.

    ``component_id`` is the smallest id reachable over links; ``kept`` marks the row that bears it.
    """
    scratch = Scratch(df.sparkSession, "minhash")
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    seen = scratch.keep(texts.mapInArrow(_featurizer(shingle, bands, rows), _FEATURES))
    nodes = scratch.keep(
        seen.where("n_shingles > 0 and id is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("node"), *[F.first(c).alias(c) for c in ("n_shingles", "packed", "bands", "odd")])
    )
    members = scratch.keep(_shared_buckets(nodes))
    met = members.select("node").distinct()
    texts = scratch.keep(texts.join(met, F.col("id") == F.col("node"), "left_semi"))

    stars = members.select("node", F.col("first").alias("other")).where("node <> other").distinct()
    best = _best(_similar(stars, nodes, bands * rows, percent / 100 - slack))
    links = _confirmed(scratch.keep(best), texts, shingle, percent)
    labels = components(links, scratch)
    open_rows = scratch.keep(_open_buckets(members, labels, nodes))
    best = scratch.keep(_crossing(open_rows, percent, all_pairs=False).select("node", "other").distinct())
    labels = components(_joined(labels, _confirmed(best, texts, shingle, percent)), scratch)
    open_rows = scratch.keep(_open_buckets(members, labels, nodes))
    rest = scratch.keep(_crossing(open_rows, percent, all_pairs=True).select("node", "other").distinct())
    if not rest.isEmpty():
        labels = components(_joined(labels, _confirmed(rest, texts, shingle, percent)), scratch)

    named = nodes.select("digest", "node").join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    named = named.select(F.col("digest").alias("of"), F.coalesce("label", "node").alias("component"))
    out = seen.select("id", "n_shingles", "digest").join(named, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near duplicates, in their own columns.

    Of each component the document with the smallest id stays, and of repeated rows of that id one.
    Rows without id all stay.
    """
    marked = near_duplicates(df, id_col, text_col, **options)
    gone = marked.where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    left = df.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    repeated = df.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
    if repeated.isEmpty():
        return left
    named = left.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return named.unionByName(left.where(F.col(id_col).isNull()))


def _featurizer(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = _Minima(bands * rows)
        for batch in parts_of(batches, "text"):
            data, places = text_bytes(batch.column("text"))
            words, ends = word_hashes(data, places)
            n = len(batch)
            counts = np.zeros(n, dtype=np.int64)
            digests: list[bytes | None] = [None] * n
            packed: list[np.ndarray | None] = [None] * n
            keys: list[np.ndarray | None] = [None] * n
            odd: list[np.ndarray | None] = [None] * n
            for i in range(n):
                found = shingle_hashes(words[ends[i] : ends[i + 1]], shingle)
                counts[i] = len(found)
                if len(found):
                    least = minima.of(found)
                    digests[i] = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    packed[i] = _pack(least)
                    keys[i] = _band_keys(least, bands, rows)
                    odd[i] = _odd_sketch(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts),
                    pa.array(digests, pa.binary()),
                    pa.array(packed, pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "digest", "packed", "bands", "odd"],
            )

    return run


class _Minima:
    """Minima of one set under many hash functions (odd multiplier and offset modulo 2^64)."""

    def __init__(self, count: int):
        seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
        self.factors = seeds[:count] | np.uint64(1)
        self.offsets = seeds[count:]

    def of(self, found: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for low in range(0, len(found), _CHUNK):
            part = found[low : low + _CHUNK]
            for i in range(0, len(self.factors), 16):
                hashed = part[None, :] * self.factors[i : i + 16, None]
                hashed += self.offsets[i : i + 16, None]
                np.minimum(least[i : i + 16], hashed.min(axis=1), out=least[i : i + 16])
        return least


def _pack(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of every minimum, packed into 64-bit words."""
    low = np.zeros(-(-len(least) // _LANES) * _LANES, dtype=np.uint64)
    low[: len(least)] = least & np.uint64((1 << BITS) - 1)
    lanes = low.reshape(-1, _LANES) << (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(lanes, axis=1).view(np.int64)


def _band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of whole minima."""
    parts = least.reshape(bands, rows)
    key = mix(np.arange(bands, dtype=np.uint64) + np.uint64(0x51ED270B))
    for r in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, r])
    return key.view(np.int64)


def _odd_sketch(found: np.ndarray) -> np.ndarray:
    """Parity of the number of runs on each place; the number of places doubles until 4/3 fit each run.

    The first half of a sketch, combined with the second, is the sketch of half as many places.
    """
    bits = min(max(SKETCH_BITS, 1 << int(len(found) * 4 // 3).bit_length()), 1 << 24)
    parity = np.bincount((found >> np.uint64(40)) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, first, weight) of every bucket with several nodes; first is its smallest node.

    A node weighs as many smallest sketches as its own is long.
    """
    weight = F.size("odd") * 64 / SKETCH_BITS
    keys = nodes.select(F.explode("bands").alias("key"), "node", weight.alias("weight"))
    firsts = (
        keys.groupBy("key")
        .agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where("first < last")
        .select(F.col("key").alias("of"), "first")
    )
    return keys.join(firsts, apart(F.col("key")) == apart(F.col("of"))).select("key", "node", "first", "weight")


def _similar(pairs: DataFrame, nodes: DataFrame, minima: int, least: float) -> DataFrame:
    """Pairs (node, other) whose packed bits suggest a similarity of ``least`` or more."""
    packed = nodes.groupBy("node").agg(F.first("packed").alias("packed"))
    mine = packed.select(F.col("node").alias("n1"), F.col("packed").alias("p1"))
    theirs = packed.select(F.col("node").alias("n2"), F.col("packed").alias("p2"))
    return (
        pairs.join(mine, apart(F.col("node")) == apart(F.col("n1")))
        .join(theirs, apart(F.col("other")) == apart(F.col("n2")))
        .withColumn("likeness", _estimate(F.col("p1"), F.col("p2"), minima))
        .where(F.col("likeness") >= least)
        .select("node", "other", "likeness")
    )


def _estimate(p1: Column, p2: Column, minima: int) -> Column:
    """Similarity from equal low bits, less what chance makes equal."""
    ones = sum(1 << (BITS * k) for k in range(_LANES))
    lane = F.lit(ones if ones < 1 << 63 else ones - (1 << 64)).cast("bigint")

    def differing(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        return F.bit_count(x.bitwiseAND(lane))

    apart_lanes = F.aggregate(F.zip_with(p1, p2, differing), F.lit(0), lambda s, x: s + x)
    equal = 1 - apart_lanes / F.lit(float(minima))
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def _best(pairs: DataFrame) -> DataFrame:
    """Of each node its most similar partner."""
    likest = F.max_by("other", F.struct("likeness", F.bitwise_not("other"))).alias("other")
    return pairs.groupBy("node").agg(likest)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(links)


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, F.col("node") == F.col("a")).join(right, F.col("other") == F.col("b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_tester(shingle, percent), "a bigint, b bigint")


def _tester(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text_a", "text_b"):
            words_a, ends_a = word_hashes(*text_bytes(batch.column("text_a")))
            words_b, ends_b = word_hashes(*text_bytes(batch.column("text_b")))
            linked = []
            for i in range(len(batch)):
                a = shingle_hashes(words_a[ends_a[i] : ends_a[i + 1]], shingle)
                b = shingle_hashes(words_b[ends_b[i] : ends_b[i + 1]], shingle)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _open_buckets(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, dealt to pairs of blocks.

    Returns (key, low, high, part, node, label, n_shingles, odd, bands); a bucket of k blocks makes
    every pair of blocks meet once.
    """
    labelled = members.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    labelled = labelled.select("key", "node", "weight", F.coalesce("label", "node").alias("label"))
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"), F.sum("weight").alias("weight"))
        .where("least < most")
        .select(F.col("key").alias("of"), F.ceil(F.col("weight") / BLOCK).cast("int").alias("parts"))
    )
    shared = labelled.join(mixed, apart(F.col("key")) == apart(F.col("of")))
    shared = shared.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(k, "part").alias("low"), F.greatest(k, "part").alias("high")),
    )
    dealt = shared.select("key", "node", "label", "part", F.explode(blocks).alias("block"))
    sketches = nodes.select(F.col("node").alias("of"), "n_shingles", "odd", "bands")
    return dealt.join(sketches, F.col("node") == F.col("of")).select(
        "key", "block.low", "block.high", "part", "node", "label", "n_shingles", "odd", "bands"
    )


def _crossing(open_rows: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """(node, other, likeness) of pairs across components that the odd sketches do not rule out.

    Either all pairs, or of each block the most similar ones that would join its components.
    """
    wide = int(open_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = open_rows.repartition(wide, "key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("key", "low", "high")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(batch)]):
                key = tuple(keys[:, low])
                if key != current and held:
                    yield _block_pairs(pa.Table.from_batches(held), percent, all_pairs)
                    held = []
                current = key
                held.append(batch.slice(low, high - low))
        if held:
            yield _block_pairs(pa.Table.from_batches(held), percent, all_pairs)

    return met.mapInArrow(run, "node bigint, other bigint, likeness double")


def _block_pairs(members: pa.Table, percent: int, all_pairs: bool) -> pa.RecordBatch:
    node, label, part, size = (members.column(c).to_numpy() for c in ("node", "label", "part", "n_shingles"))
    bands = np.stack(members.column("bands").combine_chunks().to_numpy(zero_copy_only=False))
    sketches = _Sketches(members.column("odd"), size, percent)
    earlier = bands[:, : int(np.flatnonzero(bands[0] == members.column("key")[0].as_py())[0])]
    between = members.column("low")[0].as_py() != members.column("high")[0].as_py()
    likeness_to = sketches.likeness

    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if all_pairs:
        for i in range(len(node)):
            across = label < label[i]
            if between:
                across &= part != part[i]
            at = np.flatnonzero(across)
            likeness = likeness_to(i, at)
            at, likeness = at[likeness >= 0], likeness[likeness >= 0]
            new = ~(earlier[at] == earlier[i]).any(axis=1)
            found.append((np.full(int(new.sum()), node[i]), node[at][new], likeness[new]))
    else:
        found.append(_spanning_pairs(node, label, part if between else None, likeness_to))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    columns = [np.concatenate(c) for c in zip(*(found or [empty]))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "other", "likeness"])


def _spanning_pairs(
    node: np.ndarray, label: np.ndarray, part: np.ndarray | None, likeness_to: Callable
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most similar pairs that would join the components of a block: fewer pairs than components.

    A tree grows by the member most similar to any member in it; those of its own components come
    for free. Where none is similar enough, a new tree starts.
    """
    n = len(node)
    best, via = np.full(n, -1.0), np.zeros(n, dtype=np.int64)
    pairs: list[tuple[int, int, float]] = []
    for _ in range(n):
        i = int(np.argmax(best))
        j = int(via[i])
        if best[i] >= 0 and label[i] != label[j]:
            pairs.append((max(node[i], node[j]), min(node[i], node[j]), best[i]))
        best[i] = -np.inf
        left = best > -np.inf
        own = left & (label == label[i])
        other = left & ~own
        if part is not None:
            other &= part != part[i]
        at = np.flatnonzero(other)
        likeness = likeness_to(i, at)
        closer = likeness > best[at]
        best[at[closer]], via[at[closer]] = likeness[closer], i
        # Already linked, so nearer than any pair across components.
        best[own], via[own] = 2.0, i
    columns = list(zip(*pairs)) or [(), (), ()]
    return np.array(columns[0], np.int64), np.array(columns[1], np.int64), np.array(columns[2], np.float64)


class _Sketches:
    """Odd sketches of sets, kept by their number of places."""

    def __init__(self, odd: pa.ChunkedArray, sizes: np.ndarray, percent: int):
        self.sizes, self.percent = sizes, percent
        rows = odd.combine_chunks()
        self.long = rows.value_lengths().to_numpy()
        self.row = np.zeros(len(sizes), dtype=np.int64)
        self.of: dict[int, np.ndarray] = {}
        for n in np.unique(self.long):
            at = np.flatnonzero(self.long == n)
            self.row[at] = np.arange(len(at))
            flat = rows.take(pa.array(at)).flatten().to_numpy().view(np.uint64)
            self.of[int(n)] = flat.reshape(len(at), int(n))

    def likeness(self, i: int, at: np.ndarray) -> np.ndarray:
        """Similarity of a set to others by their sketches, the longer one folded; -1 where no link is possible."""
        own = int(self.long[i])
        mine = self.of[own][self.row[i]]
        out = np.full(len(at), -1.0)
        for n, held in self.of.items():
            those = np.flatnonzero(self.long[at] == n)
            if len(those):
                differing = _folded(held[self.row[at[those]]], own) ^ _folded(mine, n)
                out[those] = _odd_likeness(differing, self.sizes[at[those]], self.sizes[i], self.percent)
        return out


def _odd_likeness(differing: np.ndarray, sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Similarity from the number of places whose parity differs; -1 where no link is possible."""
    bits = 64 * differing.shape[1]
    ones = np.bitwise_count(differing).sum(axis=1).astype(np.int64)
    both = sizes + size
    free = np.maximum(1 - 2 * ones / bits, 1e-9)
    apart_by = np.minimum(-bits / 2 * np.log(free), both)
    # Each run not in common changes one parity, so at least ``ones`` runs are not in common.
    possible = ones * (100 + percent) <= both * (100 - percent)
    possible &= 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)
    return np.where(possible, (both - apart_by) / (both + apart_by), -1.0)
