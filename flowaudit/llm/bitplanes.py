"""Token ids of documents as bit-plane files.

A shard file holds the ids of consecutive documents:

    magic, then one record per block of ``block_ids`` ids (the last may be shorter):
        the planes of the ids, plane k holding bit k (or byte k) of every id, zstandard frames;
        one frame with the documents that start in the block: ids, lengths, null marks;
    the chunk index: one fixed-size entry per block (offset, ids, documents, bytes of the document
    frame, number of planes, bytes of each plane); its length; magic.

The index alone finds the block of any id, so a range of ids is read without the rest
(``read_ids``). Planes above the highest bit in use are not stored.

Writing sorts documents by id over range partitions, one shard per partition; a task holds one
block and one batch of texts. Shards get fresh names and only those of successful tasks reach the
manifest, so retried and repeated tasks do no harm. Ids before a shard are added up from the
manifest, which has one row per shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowaudit.llm.segments import row_ranges
from flowaudit.llm.textops import text_bytes

MAGIC = b"BPLANES1"
_ENTRY = struct.Struct("<QIIIB")
#: Bytes of text encoded together; a longer text stands alone.
ENCODED_BYTES = 8 << 20
Encoder = Callable[[pa.Array], list[bytes]]


def planes_of(ids: np.ndarray, unit: str = "bit") -> list[bytes]:
    """Transpose unsigned 32-bit ids into bit or byte planes, lowest first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if unit == "byte":
        columns = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
        return [columns[:, k].tobytes() for k in range(-(-top // 8))]
    return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1).tobytes() for k in range(top)]


def ids_of(planes: Sequence[bytes], count: int, unit: str = "bit") -> np.ndarray:
    """Ids from their planes."""
    ids = np.zeros(count, dtype=np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, dtype=np.uint8)
        if unit == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * k)
        else:
            ids |= np.unpackbits(raw, count=count).astype(np.uint32) << np.uint32(k)
    return ids


class ShardWriter:
    """Writes one shard file, block by block."""

    def __init__(self, out, block_ids: int, unit: str, level: int):
        self.out, self.block_ids, self.unit = out, block_ids, unit
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.ids: list[bytes] = []
        self.held = 0
        self.documents: list[tuple[int | None, int]] = []
        self.index: list[bytes] = []
        self.n_ids = self.n_documents = 0
        head = MAGIC + unit.encode().ljust(4)
        out.write(head)
        self.offset = len(head)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append a document given as little-endian unsigned 32-bit ids."""
        self.documents.append((doc_id, len(ids) // 4))
        self.n_documents += 1
        self.ids.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.block_ids:
            held = b"".join(self.ids)
            size = 4 * self.block_ids
            whole = len(held) // size * size
            for low in range(0, whole, size):
                self._block(held[low : low + size])
            self.ids = [held[whole:]]
            self.held = (len(held) - whole) // 4

    def _block(self, raw: bytes) -> None:
        ids = np.frombuffer(raw, dtype="<u4")
        planes = [self.pack(p) for p in planes_of(ids, self.unit)]
        names = np.array([d or 0 for d, _ in self.documents], dtype="<i8")
        lengths = np.array([n for _, n in self.documents], dtype="<u4")
        missing = np.array([d is None for d, _ in self.documents], dtype=np.uint8)
        head = self.pack(names.tobytes() + lengths.tobytes() + missing.tobytes())
        entry = _ENTRY.pack(self.offset, len(ids), len(names), len(head), len(planes))
        self.index.append(entry + struct.pack(f"<{len(planes)}I", *map(len, planes)))
        for part in (*planes, head):
            self.out.write(part)
            self.offset += len(part)
        self.n_ids += len(ids)
        self.documents = []

    def close(self) -> None:
        if self.held or self.documents:
            self._block(b"".join(self.ids))
        index = b"".join(self.index)
        self.out.write(index + struct.pack("<QQ", len(self.index), len(index)) + MAGIC)


class ShardReader:
    """Reads a shard file by its chunk index."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = self._at(size - 24, 24)
        blocks, length = struct.unpack("<QQ", tail[:16])
        if tail[16:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a bit-plane file, or cut short")
        self.unit = self._at(8, 4).decode().strip()
        raw, at = self._at(size - 24 - length, length), 0
        self.blocks = []
        for _ in range(blocks):
            offset, n_ids, n_docs, head, planes = _ENTRY.unpack_from(raw, at)
            at += _ENTRY.size
            sizes = struct.unpack_from(f"<{planes}I", raw, at)
            at += 4 * planes
            self.blocks.append((offset, n_ids, n_docs, head, sizes))
        self.firsts = np.concatenate([[0], np.cumsum([b[1] for b in self.blocks], dtype=np.int64)])

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def block_ids(self, number: int) -> np.ndarray:
        offset, n_ids, _, _, sizes = self.blocks[number]
        raw = self._at(offset, sum(sizes))
        unpack, planes, at = zstandard.ZstdDecompressor().decompress, [], 0
        for size in sizes:
            planes.append(unpack(raw[at : at + size]))
            at += size
        return ids_of(planes, n_ids, self.unit)

    def block_documents(self, number: int) -> list[tuple[int | None, int]]:
        offset, _, n, head, sizes = self.blocks[number]
        raw = zstandard.ZstdDecompressor().decompress(self._at(offset + sum(sizes), head))
        names = np.frombuffer(raw, dtype="<i8", count=n)
        lengths = np.frombuffer(raw, dtype="<u4", count=n, offset=8 * n)
        missing = np.frombuffer(raw, dtype=np.uint8, count=n, offset=12 * n)
        return [(None if m else int(d), int(k)) for d, k, m in zip(names, lengths, missing)]

    def read_ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` on, opening only the blocks that hold them."""
        end = min(start + count, int(self.firsts[-1]))
        if start >= end:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self.firsts, start, side="right")) - 1
        last = int(np.searchsorted(self.firsts, end, side="left"))
        ids = np.concatenate([self.block_ids(b) for b in range(first, last)])
        return ids[start - self.firsts[first] : end - self.firsts[first]]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc id, number of ids, CRC-32 of the ids) of every document, one block held at a time."""
        crc, doc, missing = 0, None, 0
        for number in range(len(self.blocks)):
            raw = self.block_ids(number).astype("<u4").tobytes()
            waiting = iter(self.block_documents(number))
            at = 0
            while True:
                if not missing:
                    if doc is not None:
                        yield doc[0], doc[1], crc
                    doc = next(waiting, None)
                    if doc is None:
                        break
                    crc, missing = 0, doc[1]
                    if not missing:
                        continue
                if at == len(raw):
                    break
                step = min(4 * missing, len(raw) - at)
                crc = zlib.crc32(raw[at : at + step], crc)
                at += step
                missing -= step // 4
        if doc is not None:
            yield doc[0], doc[1], crc


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that the workers can reach."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_shards(
    df: DataFrame,
    path: str,
    encoder: Callable[[], Encoder],
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = 1 << 16,
    unit: str = "bit",
    level: int = 1,
) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in ascending id order and a manifest.

    ``encoder`` is called once per task and gives a function from an Arrow array of texts to
    the little-endian id bytes of each.
    Returns the manifest: shard (in order), file, n_ids, n_documents, first (ids before it).

    Defined results: a null text counts as empty and has the end id only; rows without id come
    first; rows of one id come by the hash of their texts; an empty input gives an empty manifest;
    columns besides id and text are left out.
    """
    spark = df.sparkSession
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        encode, writer, shard, name = None, None, None, f"shard-{uuid.uuid4().hex}.bpl"
        for batch in batches:
            if writer is None and len(batch):
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}")
                writer, encode = ShardWriter(out, block_ids, unit, level), encoder()
                shard = batch.column("shard")[0].as_py()
            names, texts = batch.column("id"), batch.column("text")
            for low, high in row_ranges(text_bytes(texts)[1], ENCODED_BYTES):
                found = encode(texts.slice(low, high - low))
                for doc, ids in zip(names.slice(low, high - low).to_pylist(), found):
                    writer.add(doc, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "file": [f"{path.rstrip('/')}/{name}"], "n_ids": [writer.n_ids], "n_documents": [writer.n_documents]}
            )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("__tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "id", "__tie").sortWithinPartitions("id", "__tie")
    rows = rows.select("id", "text", F.spark_partition_id().cast("bigint").alias("shard"))
    made = rows.mapInArrow(run, "shard bigint, file string, n_ids bigint, n_documents bigint")
    made.write.parquet(f"{path.rstrip('/')}/_manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a folder, in order, with the number of ids before each."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    made = spark.read.schema("shard bigint, file string, n_ids bigint, n_documents bigint").parquet(f"{path.rstrip('/')}/_manifest")
    return made.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shard files."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, place = open_store(row["file"])
                with store.open_input_file(place) as source:
                    start = row["first"]
                    held: list[tuple] = []
                    for doc, n, crc in ShardReader(source).documents():
                        held.append((doc, start, n, crc))
                        start += n
                        if len(held) == 4096:
                            yield _rows(held)
                            held = []
                    if held:
                        yield _rows(held)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("shard", "file", "first").repartition(parts, "shard")
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*held)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
