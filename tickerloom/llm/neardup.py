"""Near-duplicate documents: a Jaccard join on word n-grams by MinHash banding.

1. Every text becomes its set of ``size``-word shingles (64-bit hashes) and a MinHash signature,
   cut into bands. Documents with one set form a class; only one text per class goes on.
2. Bands are shuffled as (band hash, class). The numbers of bands and rows follow from the
   threshold and the recall wanted there (``band_plan``).
3. Of buckets with equal members the one of the first band stays. Classes that share a bucket get
   their full shingle sets, once. A bucket goes to one task, or, if it holds more than ``part``
   classes or ``PART_SHINGLES`` shingles, in parts of that size, each of which is packed (shingles
   as numbers of the part's dictionary, compressed) and meets every other part in a task of their
   own. A task checks each pair exactly, unless the pair shares an earlier band and is checked
   there. It returns, per class, how many documents it links with and the smallest class of its
   linked neighbourhood, never the pairs.
4. Link counts add up per class; the neighbourhoods give groups by connected components.

Defined cases: a text of fewer than ``size`` words is one shingle of all its words; documents
without words, or without a doc_id, link with nothing; rows with one doc_id and text count as
separate documents of one class; an empty table gives no rows; other columns are ignored by
``link_counts`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, release_memory, task_count, text_column, texts_of
from tickerloom.llm.components import components
from tickerloom.llm.hashing import mixed, window_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 4
#: Classes and shingles of a part; a task holds two parts.
PART = 1024
PART_SHINGLES = 1 << 19

SIGNED = "doc_id long, key binary, n_shingles int, bands array<long>"
GRAMS = "class long, key binary, n_docs long, bands array<long>, grams binary"
FOUND = "class long, links long, root long"
PACKED = f"{FOUND}, bucket long, band int, part int, parts int, packed binary"

_SEED = 0x5EED


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` hashes that find a pair at the threshold with the recall wanted."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


# --- one text ---------------------------------------------------------------------------------


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    words = word_hashes(text.encode())
    if 0 < len(words) < size:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words, size))


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(_SEED))
    return tuple(draw.integers(0, 1 << 64, (2, n), np.uint64, endpoint=False))


def band_hashes(grams: np.ndarray, bands: int, rows: int, family) -> np.ndarray:
    """One hash per band, which also names the band."""
    if not len(grams):
        return np.empty(0, np.uint64)
    salts, odds = family
    least = np.empty(bands * rows, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(bands * rows):
            turned = (grams ^ salts[k]) * (odds[k] | np.uint64(1))
            least[k] = (turned ^ (turned >> np.uint64(32))).min()
        code = np.arange(1, bands + 1, dtype=np.uint64)
        for row in least.reshape(bands, rows).T:
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) ^ row)
    return code


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        parts = [mixed(grams ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (_SEED, ~_SEED & 0xFFFF)]
    return np.array(parts, "<u8").tobytes() + len(grams).to_bytes(4, "little")


# --- signatures ---------------------------------------------------------------------------------


def sign(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, key, n_shingles, bands) of every document, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(bands * rows)
        for batch in batches:
            keys, counts, codes = [], [], []
            for text in texts_of(batch):
                grams = shingles(text, size)
                keys.append(set_key(grams))
                counts.append(len(grams))
                codes.append(band_hashes(grams, bands, rows, family).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()),
                 pa.array(counts, pa.int32()), pa.array(codes, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "bands"],
            )
        release_memory()

    rows_in = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return materialize(rows_in.mapInArrow(run, SIGNED), "signatures")


# --- buckets ------------------------------------------------------------------------------------


def _buckets(classes: DataFrame, part: int) -> DataFrame:
    """(bucket, band, class, part, parts): where each class is checked. Buckets with equal members
    are one bucket, of the first of their bands."""
    member = classes.select("class", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    mark = F.xxhash64("class")
    # 32 bits of a hash at a time: their sum is exact, so members in any order give one name.
    sums = [F.sum(F.shiftrightunsigned(mark, 32)), F.sum(mark.bitwiseAND((1 << 32) - 1))]
    sizes = member.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_grams"),
        F.min("band").alias("band"), *[c.alias(f"_sum{i}") for i, c in enumerate(sums)],
        F.bit_xor(mark).alias("_xor"),
    ).filter("_n > 1")
    first = sizes.groupBy("_n", "_grams", "_sum0", "_sum1", "_xor").agg(
        F.min(F.struct("band", "bucket")).alias("_first")
    )
    parts = F.greatest(F.ceil(F.col("_n") / part), F.ceil(F.col("_grams") / PART_SHINGLES))
    kept = first.select("_first.*", parts.cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("class", F.lit(_SEED)), F.col("parts")).cast("int")
    return member.drop("band").join(kept, "bucket").select(
        "bucket", "band", "class", own.alias("part"), "parts"
    )


def _shingled(classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(class, key, n_docs, bands, grams) of the given classes, from the text of one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingles(text, size) for text in texts_of(batch)]
            # Another row's text under the same doc_id has another key.
            own = pa.array([set_key(g) for g in grams], pa.binary())
            same = np.array([a == b for a, b in zip(own.to_pylist(), batch.column("key").to_pylist())], bool)
            raw = pa.array([g.tobytes() for g in grams], pa.binary())
            columns = [batch.column(c) for c in ("class", "key", "n_docs", "bands")]
            yield pa.RecordBatch.from_arrays(
                [*columns, raw], [f.split()[0] for f in GRAMS.split(", ")]
            ).filter(pa.array(same))
        release_memory()

    texts = docs.select(F.col("doc_id").cast("long").alias("class"), text_column().alias("text"))
    rows = classes.select("class", "key", "n_docs", "bands").join(texts, "class")
    return rows.mapInArrow(run, GRAMS)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of |A & B|.

    Shingles that most sets have are counted by the sets that lack them, so only differences
    between near copies cost anything; what occurs in a few sets is counted pair by pair, the
    rest by a dense product.
    """
    n = len(sets)
    sizes = [len(s) for s in sets]
    real = np.float32 if max(sizes) < 1 << 24 else np.float64
    member = np.repeat(np.arange(n), sizes)
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    spread = np.bincount(gram)
    most = spread > n // 2
    shared = np.zeros((n, n), real)
    if n > 2 and most.any():
        number = np.cumsum(most) - 1
        inside = most[gram]
        lacks = np.ones((n, int(most.sum())), bool)
        lacks[member[inside], number[gram[inside]]] = False
        missing = lacks.sum(1, dtype=real)
        shared += most.sum() - missing[:, None] - missing[None, :]
        who, which = np.nonzero(lacks)
        member = np.concatenate([member[~inside], who])
        gram = np.concatenate([gram[~inside], which + len(spread)])
    order = np.argsort(gram, kind="stable")
    member, gram = member[order], gram[order]
    first = np.flatnonzero(np.diff(gram, prepend=-1))
    spread = np.diff(first, append=len(gram))
    few = max(2, min(8, n // 8))
    for df in range(2, few):
        who = member[first[spread == df][:, None] + np.arange(df)]
        pairs = [who[:, i] * n + who[:, j] for i in range(df) for j in range(df) if i != j]
        shared += np.bincount(np.concatenate(pairs), minlength=n * n).reshape(n, n)
    often = np.flatnonzero(spread >= few)
    step = max(64, (1 << 22) // n)
    for low in range(0, len(often), step):
        some = often[low : low + step]
        lengths = spread[some]
        dense = np.zeros((n, len(some)), real)
        at = np.repeat(first[some], lengths) + (
            np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        )
        dense[member[at], np.repeat(np.arange(len(some)), lengths)] = 1
        shared += dense @ dense.T
    return shared


def _roots(links: np.ndarray, ids: np.ndarray) -> list[int]:
    """The smallest id in each node's component of a small graph."""
    root = np.array(ids)
    while True:
        reach = np.where(links, root[None, :], np.iinfo(np.int64).max).min(1)
        lower = np.minimum(root, reach)
        if (lower == root).all():
            return root.tolist()
        root = lower


class _Part:
    """Classes of a bucket with their shingle sets."""

    def __init__(self, classes, n_docs, bands, grams: list[np.ndarray]):
        self.classes = np.asarray(classes, np.int64)
        self.n_docs = np.asarray(n_docs, np.int64)
        self.bands = np.asarray(bands, np.int64).reshape(len(self.classes), -1)
        self.grams = grams

    @staticmethod
    def joined(parts: list[_Part]) -> _Part:
        return _Part(
            np.concatenate([p.classes for p in parts]), np.concatenate([p.n_docs for p in parts]),
            np.concatenate([p.bands for p in parts]), [g for p in parts for g in p.grams],
        )

    def pack(self) -> bytes:
        names, numbers = np.unique(np.concatenate(self.grams), return_inverse=True)
        sizes = np.array([len(g) for g in self.grams], np.int64)
        head = np.array([len(self.classes), self.bands.shape[1], len(names)], np.int64)
        raw = b"".join(a.tobytes() for a in (
            head, self.classes, self.n_docs, self.bands, sizes, names, numbers.astype(np.uint32),
        ))
        return len(raw).to_bytes(8, "little") + _codec().compress(raw, asbytes=True)

    @staticmethod
    def unpack(data: bytes) -> _Part:
        raw = _codec().decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
        values = np.frombuffer(raw[: len(raw) // 8 * 8], np.int64)
        n, bands, names = values[:3].tolist()
        ends = np.cumsum([3, n, n, n * bands, n, names])
        classes, docs, codes, sizes, dictionary = np.split(values[: ends[-1]], ends[:-1])[1:]
        numbers = np.frombuffer(raw, np.uint32, int(sizes.sum()), 8 * int(ends[-1]))
        grams = dictionary.view(np.uint64)[numbers]
        return _Part(classes, docs, codes, np.split(grams, np.cumsum(sizes)[:-1]))


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def _check(
    part: _Part, band: int, threshold: float, left: int | None = None
) -> list[tuple[int, int, int]]:
    """(class, documents linked with it here, smallest class of its neighbourhood). With
    ``left``, only pairs between the first ``left`` classes and the others."""
    n = len(part.classes)
    if n < 2:
        return []
    wanted = ~np.eye(n, dtype=bool)
    if left is not None:
        wanted[:left, :left] = wanted[left:, left:] = False
    for earlier in range(band):
        wanted &= part.bands[:, earlier, None] != part.bands[None, :, earlier]
    if not wanted.any():
        return []
    shared = shared_counts(part.grams)
    sizes = np.array([len(g) for g in part.grams], shared.dtype)
    total = sizes[:, None] + sizes[None, :]
    close = np.triu(wanted & (shared >= threshold * (total - shared) - 1e-6 * total), 1)
    # Counts are exact; the quotient at the threshold is decided in doubles.
    a, b = np.nonzero(close)
    common, total = shared[a, b].astype(float), sizes[a].astype(float) + sizes[b]
    sure = common >= threshold * (total - common) - 1e-9
    linked = np.zeros((n, n), bool)
    linked[a[sure], b[sure]] = linked[b[sure], a[sure]] = True
    if not linked.any():
        return []
    counts = linked.astype(np.float64) @ part.n_docs.astype(np.float64)
    roots = _roots(linked, part.classes)
    return [
        (node, int(count), root)
        for node, count, root in zip(part.classes.tolist(), counts, roots) if count
    ]


def _found_batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
        [name for name, _ in fields],
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Neighbouring rows with equal keys, one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        turns = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        for low, high in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
            spot = tuple(marks[:, low].tolist())
            if held and spot != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = spot
    if held:
        yield pa.Table.from_batches(held)


def _part_of(rows: pa.Table) -> _Part:
    # Rows that share a doc_id and the text are one class.
    keys = rows.column("key").to_pylist()
    if len(set(keys)) < len(keys):
        rows = rows.take(pa.array(sorted({key: i for i, key in enumerate(keys)}.values())))
    grams = [np.frombuffer(g.as_py(), np.uint64) for g in rows.column("grams")]
    bands = rows.column("bands").combine_chunks().flatten().to_numpy()
    return _Part(
        rows.column("class").to_numpy(), rows.column("n_docs").to_numpy(), bands, grams
    )


def _verify_parts(rows: DataFrame, threshold: float) -> DataFrame:
    """Links inside every part, and the parts of buckets that have more than one, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for group in _groups(batches, ["bucket", "part"]):
            part = _part_of(group)
            bucket, band, number, parts = (
                group.column(c)[0].as_py() for c in ("bucket", "band", "part", "parts")
            )
            nothing = (None,) * 5
            found += [(*row, *nothing) for row in _check(part, band, threshold)]
            if parts > 1:
                found.append((None, None, None, bucket, band, number, parts, part.pack()))
            if len(found) >= 1000 or parts > 1:
                yield _found_batch(PACKED, found)
                found = []
        yield _found_batch(PACKED, found)
        release_memory()

    place = ["bucket", "part"]
    tasks = task_count(rows.sparkSession)
    dealt = rows.repartition(tasks, *place).sortWithinPartitions(*place)
    return dealt.mapInArrow(run, PACKED)


def _verify_pairs(packs: DataFrame, threshold: float) -> DataFrame:
    """Links between every two parts of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "low", "high"]):
            if group.num_rows == 2:
                parts = [_Part.unpack(data.as_py()) for data in group.column("packed")]
                both = _Part.joined(parts)
                band = group.column("band")[0].as_py()
                yield _found_batch(FOUND, _check(both, band, threshold, len(parts[0].classes)))
        release_memory()

    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = packs.select("bucket", "band", "part", "packed", others).filter("part <> other")
    met = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    place = ["bucket", "low", "high"]
    tasks = task_count(packs.sparkSession)
    dealt = met.repartition(tasks, *place).sortWithinPartitions(*place, "part")
    return dealt.mapInArrow(run, FOUND)


# --- the join -----------------------------------------------------------------------------------


def link_counts(
    docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL,
    rows: int = ROWS, part: int = PART,
) -> DataFrame:
    """(doc_id, class_id, n_copies, n_links, group_id), one row per document.

    class_id: smallest doc_id with the same shingles; n_links: other documents at the threshold
    or above, copies included; group_id: smallest doc_id reachable over links.
    """
    bands = band_plan(threshold, recall, rows)
    signed = sign(docs, size, bands, rows)
    able = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = able.groupBy("key").agg(
        F.min("doc_id").alias("class"), F.count(F.lit(1)).alias("n_docs")
    )
    classes = materialize(classes, "classes")
    firsts = able.join(classes.withColumnRenamed("class", "doc_id"), ["key", "doc_id"])
    firsts = firsts.dropDuplicates(["key"]).withColumnRenamed("doc_id", "class")
    firsts = materialize(firsts.select("class", "key", "n_docs", "n_shingles", "bands"), "class-bands")
    buckets = materialize(_buckets(firsts, part), "buckets")
    shared = firsts.join(buckets.select("class").distinct(), "class", "left_semi")
    grams = materialize(_shingled(shared, docs, size), "grams")
    checked = _verify_parts(buckets.join(grams, "class"), threshold)
    checked = materialize(checked, "links")
    inside = checked.filter("class IS NOT NULL").select("class", "links", "root")
    packs = checked.filter("class IS NULL").select("bucket", "band", "part", "parts", "packed")
    between = materialize(_verify_pairs(packs, threshold), "links")
    found = inside.unionByName(between)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    known = (
        classes.join(links, "class", "left")
        .join(groups.withColumnRenamed("id", "class"), "class", "left")
    )
    joined = signed.select("doc_id", "key").join(known, "key", "left")
    alone = F.col("doc_id").isNull() | F.col("class").isNull()
    own = F.col("doc_id")
    copies = F.when(alone, F.lit(0)).otherwise(F.col("n_docs") - 1).cast("long")
    return joined.select(
        "doc_id", F.when(alone, own).otherwise(F.col("class")).alias("class_id"),
        copies.alias("n_copies"),
        (copies + F.when(alone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0))))
        .cast("long").alias("n_links"),
        F.when(alone, own).otherwise(F.coalesce("component", "class")).alias("group_id"),
    )


def drop_near_duplicates(docs: DataFrame, **rules) -> DataFrame:
    """The documents, all columns, with the smallest doc_id of each group; of rows that share
    that doc_id one stays. Rows without a doc_id all stay."""
    chosen = link_counts(docs, **rules).filter("doc_id = group_id").select("doc_id").distinct()
    kept = docs.join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id IS NULL"))
