"""Token ids as wavelet-matrix shards: rank, select, access and bulk decoding from one file.

A shard holds the ids of consecutive documents in ascending doc_id order. Its ids are stored as
bit planes, highest bit first: plane k holds bit k of every id in the order that a stable
partition by the planes above leaves. Planes are cut into blocks of 65,536 bits; a directory has
every block's place and the ones before it, so ``access``, ``rank`` and ``select`` decompress
one block per plane and step. A shard file is

    magic "WVMX0001" | header length u32 | header (JSON, zlib) | document table | blocks

Defined cases: a null text is empty; an empty document has just the end id; null doc_ids come
first; equal doc_ids are ordered by a hash of the text and may share or span shards; an empty
table writes no shard and decodes to no rows; other columns are ignored. A document longer than
a shard makes its shard longer, it is never cut.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerloom.llm.common import (
    materialize, open_file, scratch_path, task_count, text_column, texts_of, write_bytes,
)
from tickerloom.llm.tokens import encoder

MAGIC = b"WVMX0001"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 20

MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"
DECODED = "doc_id long, start long, n_tokens long, ids binary"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


# --- the succinct structure -------------------------------------------------------------------


def build_planes(ids: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[int]]:
    """Packed bit planes, highest first, and the number of zeros in each."""
    planes, zeros, rest = [], [], ids
    for shift in range(bits - 1, -1, -1):
        ones = (rest >> rest.dtype.type(shift)) & rest.dtype.type(1) != 0
        planes.append(np.packbits(ones))
        low = rest[~ones]
        zeros.append(len(low))
        rest = np.concatenate([low, rest[ones]])
    return planes, zeros


def undo_planes(planes: list[np.ndarray], zeros: list[int], n: int, dtype) -> np.ndarray:
    """All ids in order: undo the stable partitions from the lowest plane up."""
    ids = np.zeros(n, dtype)
    for level in range(len(planes) - 1, -1, -1):
        ones = np.unpackbits(planes[level], count=n).view(bool)
        whole = np.empty(n, dtype)
        whole[~ones] = ids[: zeros[level]]
        whole[ones] = ids[zeros[level] :] | dtype.type(1 << (len(planes) - 1 - level))
        ids = whole
    return ids


def pack_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> list[bytes]:
    """The bytes of a shard file."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    planes, zeros = build_planes(ids, bits)
    codec, blocks, sizes, ones = pa.Codec("zstd", 1), [], [], []
    step = BLOCK_BITS // 8
    for plane in planes:
        seen = 0
        for at in range(0, len(plane), step):
            raw = plane[at : at + step]
            blocks.append(codec.compress(raw.tobytes(), asbytes=True))
            sizes.append(len(blocks[-1]))
            ones.append(seen)
            seen += int(np.bitwise_count(raw).sum())
    known = [d if d is not None else 0 for d in doc_ids]
    table = np.array([known, counts], "<i8").reshape(2, -1).tobytes()
    table = codec.compress(table, asbytes=True)
    header = zlib.compress(json.dumps({
        "n": len(ids), "width": ids.dtype.itemsize, "bits": bits, "zeros": zeros,
        "docs": len(doc_ids), "nulls": [i for i, d in enumerate(doc_ids) if d is None],
        "table": len(table), "sizes": sizes, "ones": ones,
    }).encode())
    return [MAGIC, struct.pack("<I", len(header)), header, table, *blocks]


class Shard:
    """A shard file opened for queries; only the blocks asked for are read."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        head = source.read_at(12, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (length,) = struct.unpack("<I", head[8:])
        self.meta = json.loads(zlib.decompress(source.read_at(length, 12)))
        self.n, self.bits, self.zeros = (self.meta[k] for k in ("n", "bits", "zeros"))
        self.per_plane = -(-(-(-self.n // 8)) // (BLOCK_BITS // 8))
        self.codec = pa.Codec("zstd", 1)
        docs, at = self.meta["docs"], 12 + length
        table = self.codec.decompress(
            source.read_at(self.meta["table"], at), 16 * docs, asbytes=True
        )
        both = np.frombuffer(table, "<i8").reshape(2, docs)
        self.counts = both[1]
        self.doc_ids: list[int | None] = both[0].tolist()
        for i in self.meta["nulls"]:
            self.doc_ids[i] = None
        edges = np.cumsum([at + self.meta["table"], *self.meta["sizes"]])
        self.places = edges[:-1]
        self.ones = np.array(self.meta["ones"], np.int64)
        self.held: dict[int, np.ndarray] = {}

    def _raw(self, number: int) -> np.ndarray:
        block = number % self.per_plane
        size = min(BLOCK_BITS // 8, -(-self.n // 8) - block * (BLOCK_BITS // 8))
        data = self.source.read_at(self.meta["sizes"][number], int(self.places[number]))
        return np.frombuffer(self.codec.decompress(data, size, asbytes=True), np.uint8)

    def _block(self, level: int, block: int) -> np.ndarray:
        number = level * self.per_plane + block
        if number not in self.held:
            if len(self.held) >= 256:
                self.held.clear()
            self.held[number] = np.unpackbits(self._raw(number))
        return self.held[number]

    def _ones_before(self, level: int, at: int) -> int:
        if at >= self.n:
            return self.n - self.zeros[level]
        block, within = divmod(at, BLOCK_BITS)
        before = int(self.ones[level * self.per_plane + block])
        return before + int(self._block(level, block)[:within].sum())

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.bits):
            bit = int(self._block(level, at // BLOCK_BITS)[at % BLOCK_BITS])
            ones = self._ones_before(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value * 2 + bit
        return value

    def _descend(self, token: int, at: int) -> int:
        for level in range(self.bits):
            ones = self._ones_before(level, at)
            bit = token >> (self.bits - 1 - level) & 1
            at = self.zeros[level] + ones if bit else at - ones
        return at

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of an id in positions low..high-1 (rank difference)."""
        high = self.n if high is None else min(high, self.n)
        if token >> self.bits or token < 0 or low >= high:
            return 0
        return self._descend(token, high) - self._descend(token, low)

    def select(self, token: int, k: int) -> int:
        """The position of the k-th occurrence of an id, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._descend(token, 0) + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._place(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _place(self, level: int, bit: int, k: int) -> int:
        """The position of the k-th such bit of a plane: directory, then one block."""
        first = level * self.per_plane
        ones = self.ones[first : first + self.per_plane]
        before = ones if bit else np.arange(self.per_plane) * BLOCK_BITS - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = self._block(level, block)[: self.n - block * BLOCK_BITS]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """Every id, in order."""
        planes = []
        for level in range(self.bits):
            first = level * self.per_plane
            parts = [self._raw(first + b) for b in range(self.per_plane)]
            planes.append(np.concatenate(parts) if parts else np.empty(0, np.uint8))
        return undo_planes(planes, self.zeros, self.n, np.dtype(f"<u{self.meta['width']}"))


# --- the Spark operator -----------------------------------------------------------------------


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS,
    folder: str | None = None,
) -> DataFrame:
    """Encode every text, append ``end_id`` and write shards; returns the committed manifest.

    The texts are dealt by ranges of doc_id; a task encodes its range in order and holds one
    shard at a time. (part, seq) orders the shards of the whole table by doc_id.
    """
    folder = folder or scratch_path(docs.sparkSession, "wavelet")
    order = (F.col("doc_id"), F.xxhash64("text"))
    ranged = (
        docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        doc_ids, counts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            uri = write_bytes(folder, f"{part:06d}-{seq:06d}", pack_shard(doc_ids, counts, ids))
            row = [[part], [seq], [uri], [len(doc_ids)], [size]]
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)],
                ["part", "seq", "path", "n_docs", "n_tokens"],
            )

        for batch in batches:
            encoded = encode.stream(texts_of(batch), end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                if doc_ids and size + len(ids) > shard_tokens:
                    yield flush()
                    held, doc_ids, counts, size, seq = [], [], [], 0, seq + 1
                held.append(ids)
                doc_ids.append(doc_id)
                counts.append(len(ids))
                size += len(ids)
        if doc_ids:
            yield flush()

    return materialize(ranged.mapInArrow(shards, MANIFEST), "wavelet-manifest")


def _placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``before``: the ids in all shards before each. One row per task at most
    meets in one place; the rows of a task are added up among themselves."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_lead"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    lead = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return manifest.join(parts, "part").select("path", (F.col("_lead") + lead).alias("before"))


def _each_shard(manifest: DataFrame, per_shard, schema: str) -> DataFrame:
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as source:
                    yield from per_shard(Shard(source), row["before"])

    return _placed(manifest).repartition(task_count(spark), "path").mapInArrow(run, schema)


def _edges(shard: Shard) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(shard.counts)])


def _doc_columns(shard: Shard, before: int) -> list[pa.Array]:
    return [
        pa.array(shard.doc_ids, pa.int64()),
        pa.array(before + _edges(shard)[:-1], pa.int64()),
        pa.array(shard.counts, pa.int64()),
    ]


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the shard files; ids as little-endian bytes."""

    def rows(shard: Shard, before: int) -> Iterator[pa.RecordBatch]:
        ids, edges = shard.decode(), _edges(shard)
        raw = [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [*_doc_columns(shard, before), pa.array(raw, pa.binary())],
            ["doc_id", "start", "n_tokens", "ids"],
        )

    return _each_shard(manifest, rows, DECODED)


def digest_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the decoded files, digested where decoded."""

    def rows(shard: Shard, before: int) -> Iterator[pa.RecordBatch]:
        wide, edges = shard.decode().astype("<u4"), _edges(shard)
        sums = [zlib.crc32(wide[a:b]) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [*_doc_columns(shard, before), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return _each_shard(manifest, rows, DIGEST)


def token_occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """(position) of every occurrence of an id, by rank and select on each shard."""

    def rows(shard: Shard, before: int) -> Iterator[pa.RecordBatch]:
        found = pa.array([before + at for at in shard.occurrences(token)], pa.int64())
        yield pa.RecordBatch.from_arrays([found], ["position"])

    return _each_shard(manifest, rows, "position long")
