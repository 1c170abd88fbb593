"""Removal of repeated passages with sharded Aho-Corasick automata.

A window is ``size`` consecutive words of one document; a word goes if a window over it also
starts in a document with a smaller doc_id. Windows are judged on the input.

1. Documents are packed into chunks of about ``chunk_chars`` characters, a compressed row each.
2. Confirm: a chunk sends each of its distinct windows once, as a 64-bit hash with the smallest
   doc_id in the chunk, dealt by hash into buckets of about ``bucket_windows``. Hashes are sent
   sorted and as compressed byte planes. A bucket tells each chunk, by one bit per window, which
   of its windows start in a smaller document elsewhere. A window that a third of all documents
   share is one entry per chunk.
3. Compile and stream: the recurring passages of a shard of documents are cut into phrases of
   seven words (of half a window in general), so laid that every recurring window holds a whole
   phrase. The phrases become one pyahocorasick automaton over words (a word is a few characters
   of a private alphabet). All the shard's documents stream through it, which locates every
   occurrence; the windows around a hit are confirmed by their hashes and cover their words.

The smallest ids meet in the bucket, so nothing is compared pair by pair. Chunks and buckets have
a size, not a share: both their numbers grow with the corpus. For much larger corpora raise
``chunk_chars`` and ``bucket_windows`` together, so that what a chunk sends to a bucket stays a
few kilobytes.

Defined cases: a null text has no words; a document under ``size`` words loses none; documents
with one doc_id do not shorten each other; a null doc_id neither loses words nor takes any;
an empty table gives no rows; other columns are ignored by ``find_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, task_count, text_column, texts_of
from tickerloom.llm.hashing import pack_integers, unpack_integers, window_hashes, word_hashes

WINDOW = 13
CHUNK_CHARS = 1 << 23
SHARD_CHARS = 1 << 20
BUCKET_WINDOWS = 1 << 22

CHUNKS = "chunk long, n_words long, raw_bytes long, doc_ids array<long>, texts binary, ends binary"
PRINTS = "bucket long, chunk long, n int, hashes binary, owners binary"
MARKS = "chunk long, bucket long, marks binary"
REPEATS = (
    "doc_id long, n_words long, removed array<struct<start:long,end:long>>, text string"
)

_NEVER = np.iinfo(np.int64).max  # owner of windows of documents without an id
_CHUNK_BITS = 32
#: A word is a number of digits to this base: a trie node looks its children up one by one.
_BASE_BITS = 8


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time: a row is a whole chunk."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


# --- 1. chunks --------------------------------------------------------------------------------


def pack_chunks(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Documents as rows of about ``chunk_chars`` bytes, compressed; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, seq = _codec(), TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            words = sum(len(t.split()) for t in texts)
            packed = codec.compress(b"".join(texts), asbytes=True)
            number = (part << _CHUNK_BITS) + seq
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([words], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([packed]), pa.array([ends.tobytes()])],
                [f.split()[0] for f in CHUNKS.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                raw = text.encode()
                if ids and size + len(raw) > chunk_chars:
                    yield row()
                    ids, texts, size, seq = [], [], 0, seq + 1
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return materialize(rows.mapInArrow(run, CHUNKS), "chunks")


class _Chunk:
    """The documents of a chunk row."""

    def __init__(self, row: dict):
        self.ids: list[int | None] = row["doc_ids"]
        raw = _codec().decompress(row["texts"], row["raw_bytes"], asbytes=True)
        ends = np.frombuffer(row["ends"], np.int64)
        edges = [0, *ends.tolist()]
        self.texts = [raw[a:b] for a, b in zip(edges, edges[1:])]
        self.words = [word_hashes(t) for t in self.texts]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(distinct window hashes, ascending; smallest doc_id of each; for each document the
        places of its windows among them)."""
        each = [window_hashes(w, size) for w in self.words]
        owners = np.repeat(
            np.array([_NEVER if i is None else i for i in self.ids], np.int64),
            [len(w) for w in each],
        )
        hashes = np.concatenate(each)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        places = np.empty(len(order), np.int64)
        places[order] = np.cumsum(fresh) - 1
        cuts = np.cumsum([len(w) for w in each])[:-1]
        first = np.flatnonzero(fresh)
        if len(first):
            owners = np.minimum.reduceat(owners[order], first)
        return ranked[first], owners, np.split(places, cuts)


def _edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's stretch of ascending hashes begins."""
    borders = [((b << 64) + buckets - 1) // buckets for b in range(1, buckets)]
    cuts = np.searchsorted(hashes, np.array(borders, np.uint64))
    return np.concatenate([[0], cuts, [len(hashes)]]).astype(np.int64)


# --- 2. recurring windows -----------------------------------------------------------------------


def _fingerprints(chunks: DataFrame, size: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec()
        for batch in batches:
            for chunk in _rows(batch):
                hashes, owners, _ = _Chunk(chunk).windows(size)
                edges, rows = _edges(hashes, buckets), []
                for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
                    if a < b:
                        steps = np.diff(hashes[a:b], prepend=np.uint64(0))
                        rows.append((
                            bucket, chunk["chunk"], b - a, pack_integers(steps, codec),
                            pack_integers(owners[a:b].view(np.uint64), codec),
                        ))
                columns = list(zip(*rows)) if rows else [()] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    [f.split()[0] for f in PRINTS.split(", ")],
                )

    return chunks.mapInArrow(run, PRINTS)


def _mark(group: pa.Table) -> pa.Table:
    """For each chunk of a bucket: which of its windows start in a smaller document elsewhere."""
    codec, sizes = _codec(), group.column("n").to_pylist()
    hashes = np.concatenate([
        np.cumsum(unpack_integers(data.as_py(), n, codec), dtype=np.uint64)
        for data, n in zip(group.column("hashes"), sizes)
    ])
    owners = np.concatenate([
        unpack_integers(data.as_py(), n, codec).view(np.int64)
        for data, n in zip(group.column("owners"), sizes)
    ])
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]))
    smallest = np.minimum.reduceat(owners[order], first)
    later = np.empty(len(order), bool)
    later[order] = np.repeat(smallest, np.diff(first, append=len(order))) < owners[order]
    later &= owners != _NEVER
    edges = np.cumsum([0, *sizes])
    rows = [
        (chunk, bucket, np.packbits(later[a:b]).tobytes())
        for chunk, bucket, a, b in zip(
            group.column("chunk").to_pylist(), group.column("bucket").to_pylist(),
            edges, edges[1:],
        )
        if later[a:b].any()
    ]
    columns = list(zip(*rows)) if rows else [()] * 3
    types = (pa.int64(), pa.int64(), pa.binary())
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["chunk", "bucket", "marks"]
    )


# --- 3. automata --------------------------------------------------------------------------------


def _alphabet(words: np.ndarray) -> tuple[np.ndarray, int]:
    """Distinct word hashes of the patterns, and digits per word."""
    distinct = np.unique(words)
    return distinct, max(1, -(-int(len(distinct)).bit_length() // _BASE_BITS))


def _spell(words: np.ndarray, alphabet: np.ndarray, width: int) -> str:
    """Words as ``width`` characters each; a word of no pattern has a character of its own."""
    other = (1 << _BASE_BITS) + 1
    if not len(alphabet):
        return chr(other) * (len(words) * width)
    at = np.minimum(np.searchsorted(alphabet, words), len(alphabet) - 1)
    shifts = _BASE_BITS * np.arange(width - 1, -1, -1)
    digits = ((at[:, None] >> shifts) & ((1 << _BASE_BITS) - 1)) + 1
    digits[alphabet[at] != words] = other
    return digits.astype("<u2").tobytes().decode("utf-16-le")


def _phrase(size: int) -> tuple[int, int]:
    """(words of a phrase, distance of phrases in a passage): any window has a whole one."""
    words = (size + 1) // 2
    return words, size - words + 1


def _phrase_starts(need: np.ndarray, step: int) -> np.ndarray:
    """Where phrases start so that each needed window holds one: every ``step`` words of a run."""
    turns = np.flatnonzero(np.diff(need, prepend=False, append=False))
    first, end = turns[::2], turns[1::2]
    counts = (end - 1 - first + step - 1) // step + 1
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + step * within


class _Shard:
    """The automaton of a shard of documents."""

    def __init__(self, size: int, words: list[np.ndarray], need: list[np.ndarray]):
        """``need``: which windows of each document it must be able to locate."""
        import ahocorasick

        self.size = size
        self.phrase, step = _phrase(size)
        starts = [_phrase_starts(n, step) for n in need]
        inside = [
            w[np.unique((s[:, None] + np.arange(self.phrase)).ravel())] if len(s) else w[:0]
            for w, s in zip(words, starts)
        ]
        self.alphabet, self.width = _alphabet(np.concatenate(inside))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        span = self.phrase * self.width
        for w, s in zip(words, starts):
            if len(s):
                spelled = _spell(w, self.alphabet, self.width)
                for at in (s * self.width).tolist():
                    self.automaton.add_word(spelled[at : at + span])
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def located(self, words: np.ndarray) -> np.ndarray:
        """Per window: whether it holds a phrase that the automaton finds."""
        windows = max(0, len(words) - self.size + 1)
        if not (self.any and windows):
            return np.zeros(windows, bool)
        spelled = _spell(words, self.alphabet, self.width)
        ends = np.array([end for end, _ in self.automaton.iter(spelled)], np.int64) + 1
        ends = ends[ends % self.width == 0] // self.width
        low = np.clip(ends - self.size, 0, windows)
        high = np.clip(ends - self.phrase + 1, 0, windows)
        steps = np.bincount(low, minlength=windows + 1) - np.bincount(high, minlength=windows + 1)
        return np.cumsum(steps[:windows]) > 0


def _covered(removed: np.ndarray, size: int) -> np.ndarray:
    """Per word: whether a removed window covers it."""
    steps = np.zeros(len(removed) + size, np.int32)
    steps[: len(removed)] += removed
    steps[size:] -= removed
    return np.cumsum(steps)[:-1] > 0


def _shards(texts: list[bytes], shard_chars: int) -> Iterator[range]:
    low, size = 0, 0
    for at, text in enumerate(texts):
        if at > low and size + len(text) > shard_chars:
            yield range(low, at)
            low, size = at, 0
        size += len(text)
    yield range(low, len(texts))


def _remove(row: dict, size: int, buckets: int, shard_chars: int) -> Iterator[tuple]:
    chunk = _Chunk(row)
    hashes, owners, places = chunk.windows(size)
    edges = _edges(hashes, buckets)
    elsewhere = np.zeros(len(hashes), bool)
    for mark in row["marked"] or []:
        a, b = edges[mark["bucket"]], edges[mark["bucket"] + 1]
        elsewhere[a:b] = np.unpackbits(np.frombuffer(mark["marks"], np.uint8), count=b - a)
    # A smaller document elsewhere is smaller than every document of the chunk that has the
    # window; else the chunk's own smallest document is the first.
    first = np.where(elsewhere, np.iinfo(np.int64).min, owners)
    for shard in _shards(chunk.texts, shard_chars):
        words = [chunk.words[i] for i in shard]
        recurring, need, taken = [], [], np.zeros(len(hashes), bool)
        for i in shard:
            at, own = places[i], chunk.ids[i]
            recurs = first[at] < own if own is not None else np.zeros(len(at), bool)
            recurring.append(recurs)
            need.append(recurs & ~taken[at])
            taken[at[recurs]] = True
        automaton = _Shard(size, words, need)
        for i, w, recurs in zip(shard, words, recurring):
            own, text = chunk.ids[i], chunk.texts[i].split()
            removed = automaton.located(w)
            removed &= recurs
            gone = _covered(removed, size) if len(removed) else np.zeros(len(w), bool)
            turns = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            spans = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
            kept = b" ".join(compress(text, ~gone) if spans else text)
            yield own, len(text), spans, kept.decode()


def find_repeats(
    docs: DataFrame, size: int = WINDOW, chunk_chars: int = CHUNK_CHARS,
    shard_chars: int = SHARD_CHARS, bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, removed, text): the word ranges that go and the kept words, joined by
    one space. One row per document."""
    chunks = pack_chunks(docs, chunk_chars)
    total = chunks.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // bucket_windows))
    tasks = task_count(docs.sparkSession)
    prints = _fingerprints(chunks, size, buckets)
    marks = (
        prints.repartition(max(buckets, tasks), "bucket").groupBy("bucket")
        .applyInArrow(_mark, MARKS)
    )
    marked = marks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "marks")).alias("marked"))
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = (pa.int64(), pa.int64(), pa.list_(struct), pa.string())
    names = ["doc_id", "n_words", "removed", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                done = list(zip(*_remove(row, size, buckets, shard_chars)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(done, types)], names
                )

    return chunks.join(marked, "chunk", "left").mapInArrow(run, REPEATS)


def repeat_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    lengths = F.transform("removed", lambda r: r["end"] - r["start"])
    gone = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)
    return found.select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )
