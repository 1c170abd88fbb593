"""Resampling documents towards a target distribution by hashed n-gram features.

Features of a text are its runs of one to ``grams`` words; each falls into a bucket by its crc32.
The gain of a bucket is the log ratio of its smoothed shares in the target and in the corpus, and
a document's weight is the sum of its features' gains. Gumbel noise drawn by doc_id turns the
weights into scores whose highest are a sample without replacement.

1. Count: tasks take texts in groups of about ``GROUP`` bytes and intern the n-grams of a group in
   an open-addressed table (``ngram_table``), whose slots carry bucket and count. Bucket counts
   add up over tasks; their number is a parameter, so the gains reach every task.
2. Weigh: texts are interned again, and the slots of their n-grams gather the gains. This costs
   less than keeping the buckets of every occurrence between the passes.
3. Draw: narrow rows are dealt by score range, ranked inside their range and shifted by the
   number of rows before it, so no task sees all rows.

Words are runs of digits, letters a-z (A-Z are lower-cased) and anything beyond ASCII.

Defined cases: a null text has no features and weight 0; a text of fewer words than ``min_words``
is never drawn; a null doc_id counts as the empty string in the noise and is ranked after others
of its score; equal rows are drawn as separate rows; texts of any length are cut into overlapping
pieces, so every feature counts once; an empty corpus gives no rows, an empty target counts 0;
other columns are ignored by ``resample`` and kept by ``drawn_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerloom.llm.common import materialize, text_column, texts_of
from tickerloom.llm.ngram_table import NgramTable

GRAMS = 3
BUCKETS = 10_000
SCALE = 1000
MIN_WORDS = 20
PERCENT = 5
SEED = 42

#: Bytes of normalised text that are interned at a time.
GROUP = 1 << 20

WEIGHED = "doc_id long, n_words long, n_features long, weight long"

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_UPPER = {0x41 + k: 0x61 + k for k in range(26)}
_WORD_BYTE = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_NORMAL = bytes(_UPPER.get(b, b) if _UPPER.get(b, b) in _WORD_BYTE else 0x20 for b in range(256))


# --- features of texts ------------------------------------------------------------------------------


def normalised(text: str) -> bytes:
    """The words, lower-cased, joined by one space."""
    return b" ".join(text.encode().translate(_NORMAL).split())


def _lines(words: bytes, grams: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of about ``size`` bytes and whether there are more. A piece starts with the last
    ``grams`` - 1 words of the one before it."""
    at = 0
    while len(words) - at > size:
        cut = words.find(b" ", at + size)
        while cut >= 0:
            back = cut
            for _ in range(grams - 1):
                back = words.rfind(b" ", at, back)
                if back < 0:
                    break
            if back >= 0:
                break
            cut = words.find(b" ", cut + 1)  # very long words: the piece needs more of them
        if cut < 0:
            break
        yield words[at:cut], True
        at = back + 1
    yield words[at:], False


class _Group:
    """Lines of one or more documents, and the stretches of all their n-grams."""

    def __init__(self, lines: list[tuple[bytes, bool]], owners: list[int], grams: int):
        self.buffer = b"\n".join(line for line, _ in lines)
        raw = np.frombuffer(self.buffer, np.uint8)
        breaks = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
        starts = np.concatenate([[0], breaks + 1])
        ends = np.append(breaks, len(raw))
        line = np.concatenate([[0], np.cumsum(raw[breaks] == 0x0A)])
        last = np.append(np.flatnonzero(np.diff(line)), len(line) - 1)
        more = np.array([m for _, m in lines])
        # The last words of a piece that goes on begin features in the next piece.
        begins = np.arange(len(starts)) <= last[line] - np.where(more[line], grams - 1, 0)
        owner = np.array(owners)[line]
        self.words = owner[begins]
        first, end, of = [], [], []
        for n in range(grams):
            at = np.flatnonzero(begins[: len(starts) - n])
            at = at[line[at] == line[at + n]]
            first.append(starts[at])
            end.append(ends[at + n])
            of.append(owner[at])
        self.starts, self.ends = np.concatenate(first), np.concatenate(end)
        self.owners = np.concatenate(of)

    def table(self, buckets: int) -> NgramTable:
        return NgramTable(self.buffer, self.starts, self.ends, buckets)


def _groups(texts: Iterable[str], grams: int) -> Iterator[_Group]:
    """All texts in groups; owners are the texts' numbers."""
    lines: list[tuple[bytes, bool]] = []
    owners: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        words = normalised(text)
        for line in _lines(words, grams, GROUP) if words else ():
            lines.append(line)
            owners.append(number)
            size += len(line[0])
            if size >= GROUP:
                yield _Group(lines, owners, grams)
                lines, owners, size = [], [], 0
    if lines:
        yield _Group(lines, owners, grams)


# --- 1. counts and gains ------------------------------------------------------------------------------


def bucket_counts(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) for buckets with features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in _groups(texts_of(batch), grams):
                counts += group.table(buckets).bucket_counts(buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["bucket", "n"]
        )

    texts = docs.select(text_column().alias("text"))
    counted = texts.mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(docs: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """All bucket counts; at most ``buckets`` rows come to the driver."""
    found = np.zeros(buckets, np.int64)
    for row in bucket_counts(docs, grams, buckets).collect():
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * log of the ratio of smoothed shares) per bucket."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum() + buckets), float(target.sum() + buckets)
    ratios = [
        ((float(t) + 1) * all_corpus) / ((float(s) + 1) * all_target)
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array([math.floor(scale * math.log(ratio)) for ratio in ratios], np.int64)


# --- 2. weights ---------------------------------------------------------------------------------------


def weigh(docs: DataFrame, gains: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """(doc_id, n_words, n_features, weight), one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = np.zeros((3, batch.num_rows), np.int64)
            for group in _groups(texts_of(batch), grams):
                np.add.at(words, group.words, 1)
                np.add.at(features, group.owners, 1)
                np.add.at(weights, group.owners, group.table(len(gains)).gathered(gains))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in (words, features, weights))],
                [f.split()[0] for f in WEIGHED.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return rows.mapInArrow(run, WEIGHED)


def scored(weighed: DataFrame, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``weighed`` plus score: the weight with Gumbel noise drawn by doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


# --- 3. ranks -----------------------------------------------------------------------------------------


def ranked(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``rows`` plus rank: 1, 2, ... for the highest ``percent`` of them by score, else null."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialize(laid.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", _ROW_BITS)
    sizes = laid.groupBy(part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # These windows hold one row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    drawn = F.floor(F.sum("_rows").over(Window.partitionBy()) * percent / F.lit(100))
    sizes = sizes.select("_part", (before - F.col("_first") + 1).alias("_shift"), drawn.alias("_n"))
    rank = F.col("_at") + F.col("_shift")
    placed = laid.withColumn("_part", part).join(sizes, "_part")
    return placed.select(
        *rows.columns, F.when(rank <= F.col("_n"), rank).cast("long").alias("rank")
    )


def resample(
    docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per document of ``docs``; documents
    with a rank are the draw."""
    gains = bucket_gains(_counts(docs, grams, buckets), _counts(target, grams, buckets))
    rows = materialize(scored(weigh(docs, gains, grams), seed=seed), "scores")
    kept = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= min_words
    rest = rows.filter(~able).select(*kept, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.filter(able).select(*kept), percent).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, **rules) -> DataFrame:
    """The drawn documents, all columns; rows without a doc_id are never among them, and rows
    that share a drawn doc_id all are."""
    chosen = resample(docs, target, **rules).filter("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi").select(*docs.columns)
