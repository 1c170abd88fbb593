"""Removal of byte strings that occur more than once, by suffix sorting in shards.

Texts are UTF-8. A window is ``length`` consecutive bytes of one document; every byte goes that a
window covers whose bytes also start anywhere else, in the same document or another one.

1. Documents are packed into chunks, a compressed row each (``repeats.pack_chunks``).
2. Deal: each window takes the least hash of its grams of half its length as its code, so equal
   windows have equal codes. Neighbouring windows of one code form a segment. A chunk sends its
   distinct codes; windows whose code occurs once in the corpus are unique and go no further.
   Where a code has more than ``hot_segments`` segments (the edge of a passage that very many
   documents share in different surroundings), each window is a segment of its own and its own
   hash is its code; again those that occur once go no further.
3. Sort: the segments meet by code, one per content and chunk. A task takes some codes at a time
   (``shard_bytes``, or one code), joins the contents to one text and sorts the suffixes at their
   windows in two stages: those smaller than their successors directly, the others by scanning
   the buckets of first bytes in order. The suffixes of a content that occurs several times stand
   in that order twice. Adjacent common prefixes of ``length`` or more name the windows that recur.
4. Each chunk gets, per segment, one bit per window, and cuts its documents.

Hashes only lead equal windows to one task and leave out codes and windows that occur once; the
sorted suffixes decide. What is shuffled are codes, then the text of segments with a recurring
code once per chunk. Nothing is compared pair by pair.

Defined cases: a null text is empty; a text under ``length`` bytes loses nothing; equal rows take
each other's text as other documents do; null doc_ids are documents like others; an empty table
gives no rows; other columns are ignored by ``find_long_repeats``. What is kept may begin or end
inside a character, so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerloom.llm.common import materialize, release_memory, task_count
from tickerloom.llm.hashing import mixed, prefix_sums, stretch_hashes
from tickerloom.llm.repeats import pack_chunks

LENGTH = 200
SHARD_BYTES = 1 << 20
HOT_SEGMENTS = 1 << 13
#: Window starts that are hashed at a time; also the longest segment.
STRIDE = 1 << 16

CODES = "code long, chunk long, n long"
SEGMENTS = "code long, id long, chunk long, copies int, windows int, text binary"
MARKS = "chunk long, id long, marks binary"
REMOVED = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"

_SEPARATOR = b"\xff"  # no byte of UTF-8
_COMPARED = 1 << 14  # neighbours that are compared at a time


# --- two-stage suffix sorting of one text ---------------------------------------------------------


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Per suffix: whether it is smaller than the one that starts a byte later; the last is not."""
    turns = np.flatnonzero(text[1:] != text[:-1])
    lengths = np.diff(turns, prepend=-1)
    rising = np.repeat(text[turns] < text[turns + 1], lengths)
    return np.concatenate([rising, np.zeros(len(text) - len(rising), bool)])


def sort_suffixes(raw: bytes, firsts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that start in the stretches [first, end), in the order of their first
    ``depth`` bytes. After each stretch there must come a suffix smaller than its successor."""
    text = np.frombuffer(raw, np.uint8)
    small = smaller_than_next(text)
    wanted = _inside(len(text), firsts, ends)
    smalls = np.flatnonzero(small)
    # A larger suffix follows from its successor, so stretches go on to the next smaller one.
    needed = wanted | _inside(len(text), ends, smalls[np.searchsorted(smalls, ends - 1)] + 1)
    direct = np.flatnonzero(needed & small)
    keys = [raw[at : at + depth] for at in direct.tolist()]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    keys.clear()
    induced = needed & ~small
    borders = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        bucket = waiting[byte]
        layer = np.concatenate(bucket) if bucket else direct[:0]
        bucket = [layer]
        while len(layer):  # larger suffixes that begin with the same byte again
            before = layer - 1
            layer = before[induced[before] & (text[before] == byte)]
            bucket.append(layer)
        bucket.append(direct[borders[byte] : borders[byte + 1]])
        scanned = np.concatenate(bucket)
        waiting[byte].clear()
        order.append(scanned)
        before = scanned - 1  # -1 is the last byte, which is never needed
        before = before[induced[before] & (text[before] > byte)]
        if len(before):
            into = text[before]
            before = before[np.argsort(into, kind="stable")]
            names, starts = np.unique(text[before], return_index=True)
            for name, part in zip(names.tolist(), np.split(before, starts[1:])):
                waiting[name].append(part)
    ordered = np.concatenate(order)
    return ordered[wanted[ordered]]


def _inside(n: int, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, firsts, 1)
    np.add.at(steps, np.maximum(firsts, ends), -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


def common_prefixes(raw: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, at most ``depth``."""
    lanes = -(-depth // 8)
    padded = raw + bytes(8 * lanes)
    words = np.ndarray((len(raw), lanes), "<u8", padded, strides=(1, 8))
    shared = np.zeros(len(order), np.int64)
    for low in range(1, len(order), _COMPARED):
        part = words[order[low - 1 : low + _COMPARED]]
        differ = part[1:] ^ part[:-1]
        first = (differ != 0).argmax(1)
        value = differ[np.arange(len(first)), first]
        lowest = value & (~value + np.uint64(1))
        found = 8 * first + np.log2(np.maximum(lowest, 1)).astype(np.int64) // 8
        shared[low : low + _COMPARED] = np.where(value == 0, depth, found)
    return np.minimum(shared, depth)


# --- segments of one chunk -------------------------------------------------------------------------


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        hashes = np.minimum(hashes[span:], hashes[:-span])
        span *= 2
    rest = width - span
    return np.minimum(hashes[rest:], hashes[: len(hashes) - rest]) if rest else hashes


class _Segments:
    """Codes, content ids, first windows and numbers of windows of a chunk's segments."""

    def __init__(self, row: dict, length: int):
        codec = pa.Codec("zstd", 1)
        self.length, self.ids = length, row["doc_ids"]
        self.raw = codec.decompress(row["texts"], row["raw_bytes"], asbytes=True)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.text = np.frombuffer(self.raw, np.uint8)

    def _pieces(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first byte, prefix sums, code of each window, whether its first gram has that code,
        whether it lies in one document)."""
        gram = max(1, self.length // 2)
        whole = _inside(len(self.text), self.starts, self.ends - self.length + 1)
        for at in range(0, len(self.text) - self.length + 1, STRIDE):
            part = self.text[at : at + STRIDE + self.length - 1]
            sums = prefix_sums(part)
            grams = np.arange(len(part) - gram + 1)
            hashes = stretch_hashes(sums, grams, grams + gram)
            codes = _least(hashes, self.length - gram + 1)
            yield at, sums, codes, hashes[: len(codes)] == codes, whole[at : at + len(codes)]

    def _named(self, sums, first, count) -> np.ndarray:
        return mixed(stretch_hashes(sums, first, first + count + self.length - 1))

    def runs(self, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(code, content id, first window, windows, whether its code is that of two grams) of
        every segment. Windows with a code in ``hot`` are segments of their own, with their own
        hash as their code."""
        found = []
        for at, sums, codes, leads, whole in self._pieces():
            first = np.ones(len(codes), bool)
            first[1:] = (codes[1:] != codes[:-1]) | (whole[1:] != whole[:-1])
            single = np.isin(codes, hot) if hot is not None and len(hot) else None
            if single is not None:
                first |= single
                first[1:] |= single[:-1]
            # A window that goes on after losing its least gram has another one like it.
            leads[:-1] &= ~first[1:]
            leads[-1] = False
            first = np.flatnonzero(first)
            twice = np.logical_or.reduceat(leads, first)
            count = np.diff(first, append=len(codes))
            kept = whole[first]
            first, count, twice = first[kept], count[kept], twice[kept]
            names = self._named(sums, first, count)
            code = codes[first]
            if single is not None:
                code = np.where(single[first], mixed(names), code)
            found.append((code, names, first + at, count, twice))
        if not found:
            types = (np.uint64, np.uint64, np.int64, np.int64, bool)
            return tuple(np.empty(0, t) for t in types)
        return tuple(np.concatenate(column) for column in zip(*found))

    def windows_of(self, hot: np.ndarray) -> np.ndarray:
        """The codes that windows with a code in ``hot`` have as segments of their own."""
        found = [np.empty(0, np.uint64)]
        for _, sums, codes, _, whole in self._pieces():
            at = np.flatnonzero(whole & np.isin(codes, hot))
            found.append(mixed(self._named(sums, at, np.ones(len(at), np.int64))))
        return np.concatenate(found)


    def marked(self, row: dict) -> np.ndarray:
        """The windows that the chunk's marks name."""
        marks = {m["id"]: m["marks"] for m in row["marked"]}
        _, name, first, count, _ = self.runs(_unsigned(row["hot"]))
        some = np.isin(_signed(name), np.fromiter(marks, np.int64, len(marks)))
        names, first, count = _signed(name[some]).tolist(), first[some], count[some]
        bits = np.unpackbits(np.frombuffer(b"".join(map(marks.get, names)), np.uint8))
        skipped = np.cumsum((count + 7) // 8 * 8) - (count + 7) // 8 * 8
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        recurs = bits[np.repeat(skipped, count) + within].astype(bool)
        return (np.repeat(first, count) + within)[recurs]


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]
    release_memory()


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
        [name for name, _ in fields],
    )


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _unsigned(values: list[int] | None) -> np.ndarray:
    return np.sort(np.array(values or [], np.int64).view(np.uint64))


# --- 2. codes that recur ---------------------------------------------------------------------------


def _chunk_codes(chunks: DataFrame, length: int) -> DataFrame:
    """(code, chunk, n): n segments of different content, and one more if a content recurs in
    the chunk or the code in a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            code, name, _, _, twice = _Segments(row, length).runs()
            order = np.lexsort((name, code))
            code, name, twice = code[order], name[order], twice[order]
            first = np.flatnonzero(np.diff(code, prepend=~code[:1]))
            fresh = np.ones(len(code), np.int64)
            fresh[1:] = (name[1:] != name[:-1]) | (code[1:] != code[:-1])
            n = fresh
            if len(first):
                n = np.add.reduceat(fresh, first)
                again = n < np.diff(first, append=len(code))
                n += again | np.logical_or.reduceat(twice, first)
            yield _batch(CODES, [_signed(code[first]), np.full(len(first), row["chunk"]), n])

    return chunks.mapInArrow(run, CODES)


def _window_codes(hot: DataFrame, length: int) -> DataFrame:
    """(code, chunk, n) of the windows with hot codes; n is 2 if one recurs in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            codes = _Segments(row, length).windows_of(_unsigned(row["hot"]))
            code, n = np.unique(codes, return_counts=True)
            columns = [_signed(code), np.full(len(code), row["chunk"]), np.minimum(n, 2)]
            yield _batch(CODES, columns)

    return hot.mapInArrow(run, CODES)


def _recurring(codes: DataFrame) -> DataFrame:
    """(code, chunk, total) of codes that occur more than once: one shuffle of codes. A code has
    at most one row per chunk, however often it occurs."""
    alike = Window.partitionBy("code")
    return codes.select("code", "chunk", F.sum("n").over(alike).alias("total")).filter("total > 1")


# --- 3. shards -------------------------------------------------------------------------------------


def _chunk_segments(flagged: DataFrame, length: int) -> DataFrame:
    """The text of segments with a recurring code, once per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            segments = _Segments(row, length)
            code, name, first, count, _ = segments.runs(_unsigned(row["hot"]))
            some = np.flatnonzero(np.isin(code, _unsigned(row["codes"])))
            _, at, copies = np.unique(name[some], return_index=True, return_counts=True)
            some = some[at]
            for low in range(0, len(some), 4096):
                part = some[low : low + 4096]
                texts = [
                    segments.raw[a : a + n + length - 1]
                    for a, n in zip(first[part].tolist(), count[part].tolist())
                ]
                yield _batch(SEGMENTS, [
                    _signed(code[part]), _signed(name[part]), np.full(len(part), row["chunk"]),
                    np.minimum(copies[low : low + 4096], 2), count[part], texts,
                ])

    return flagged.mapInArrow(run, SEGMENTS)


class _Shard:
    """Segments of some codes, one text per content, and the chunks that hold it."""

    def __init__(self, length: int):
        self.length = length
        self.clear()

    def clear(self) -> None:
        self.texts: list[bytes] = []
        self.windows: list[int] = []
        self.copies: list[int] = []
        self.owners: list[tuple[int, int]] = []  # (chunk, place of the content)
        self.names: list[int] = []
        self.size = 0

    def add(self, fresh: bool, name: int, chunk: int, copies: int, windows: int, text) -> None:
        if fresh:
            self.texts.append(text.as_py())
            self.size += len(self.texts[-1])
            self.windows.append(windows)
            self.copies.append(0)
            self.names.append(name)
        self.copies[-1] += copies
        self.owners.append((chunk, len(self.texts) - 1))

    def marks(self) -> pa.RecordBatch:
        """(chunk, id, one bit per window) for contents with a window that recurs."""
        raw = _SEPARATOR.join([*self.texts, b""])
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts)) + 1
        firsts = np.cumsum(sizes) - sizes
        order = sort_suffixes(raw, firsts, firsts + self.windows, self.length)
        if max(self.copies) > 1:
            copies = np.minimum(self.copies, 2)
            order = np.repeat(order, copies[np.searchsorted(firsts, order, "right") - 1])
        same = common_prefixes(raw, order, self.length) >= self.length
        again = same.copy()
        again[:-1] |= same[1:]
        recurs = np.zeros(len(raw), bool)
        recurs[order[again]] = True
        bits = [
            np.packbits(recurs[a : a + n]).tobytes() if recurs[a : a + n].any() else None
            for a, n in zip(firsts.tolist(), self.windows)
        ]
        found = [(chunk, self.names[i], bits[i]) for chunk, i in self.owners if bits[i]]
        return _batch(MARKS, list(zip(*found)) if found else [()] * 3)


def _sorted_shards(segments: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = _Shard(length), (None, None)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for code, name, chunk, copies, windows, text in zip(*columns, batch.column(5)):
                if code != last[0] and shard.size >= shard_bytes:
                    yield shard.marks()
                    shard.clear()
                shard.add((code, name) != last, name, chunk, copies, windows, text)
                last = code, name
        if shard.texts:
            yield shard.marks()
        shard.clear()
        release_memory()

    tasks = task_count(segments.sparkSession)
    dealt = segments.repartition(tasks, "code").sortWithinPartitions("code", "id")
    return dealt.mapInArrow(run, MARKS)


# --- 4. documents ----------------------------------------------------------------------------------


def _cut(row: dict, length: int) -> Iterator[tuple]:
    segments = _Segments(row, length)
    recurs = np.zeros(len(segments.raw), np.int32)
    if row["marked"]:
        recurs[segments.marked(row)] = 1
    # A byte goes if one of the last ``length`` windows up to it recurs.
    gone = np.cumsum(recurs, dtype=np.int32)
    gone[length:] -= gone[:-length].copy()
    gone = gone > 0
    for doc_id, low, high in zip(segments.ids, segments.starts.tolist(), segments.ends.tolist()):
        cut = gone[low:high]
        turns = np.flatnonzero(np.diff(cut, prepend=False, append=False)).tolist()
        spans = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
        kept = segments.text[low:high][~cut].tobytes() if spans else segments.raw[low:high]
        yield doc_id, high - low, spans, kept


def find_long_repeats(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
    hot_segments: int = HOT_SEGMENTS,
) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the byte ranges that go, maximal and ascending, and the
    bytes that stay. One row per document."""
    chunks = pack_chunks(docs)
    total = F.col("total")
    codes = materialize(_recurring(_chunk_codes(chunks, length)), "codes")
    per_chunk = codes.groupBy("chunk").agg(
        F.collect_list(F.when(total <= hot_segments, F.col("code"))).alias("codes"),
        F.collect_list(F.when(total > hot_segments, F.col("code"))).alias("hot"),
    )
    if codes.filter(total > hot_segments).limit(1).count():
        per_chunk = materialize(per_chunk, "codes")
        hot = chunks.join(per_chunk.filter("size(hot) > 0"), "chunk")
        single = _recurring(_window_codes(hot, length)).groupBy("chunk").agg(
            F.collect_list("code").alias("single")
        )
        none = F.array().cast("array<long>")
        per_chunk = per_chunk.join(single, "chunk", "left").select(
            "chunk", F.concat("codes", F.coalesce("single", none)).alias("codes"), "hot"
        )
    flags = materialize(per_chunk, "codes")
    segments = _chunk_segments(chunks.join(flags, "chunk"), length)
    marks = materialize(_sorted_shards(segments, length, shard_bytes), "marks")
    marked = marks.groupBy("chunk").agg(F.collect_list(F.struct("id", "marks")).alias("marked"))
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = (pa.int64(), pa.int64(), pa.list_(struct), pa.binary())
    names = [f.split()[0] for f in REMOVED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            done = list(zip(*_cut(row, length)))
            arrays = [pa.array(c, t) for c, t in zip(done, types)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    whole = chunks.join(marked, "chunk", "left").join(flags.select("chunk", "hot"), "chunk", "left")
    return whole.mapInArrow(run, REMOVED)


def long_repeat_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    lengths = F.transform("removed", lambda r: r["end"] - r["start"])
    gone = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
