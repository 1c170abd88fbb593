"""Edit-aware token counts: a segment tree of pre-token counts per document.

A document is cut into chunks at single spaces (``tokens.chunks_of``), where its tokenizer always
starts a new pre-token. The leaves of its tree have these chunks with their characters and token
counts; inner nodes hold the sums. ``count_trees`` keeps the leaves of every document as two
compressed integer lists, from which the sums are rebuilt in one pass.

An edit (start, end, replacement; code points of the text as it is then) finds its first and last
leaf by the character sums, takes one more leaf on either side as context, and widens that until
both borders are again single spaces between visible characters. Only this region is encoded
anew; its chunks take over the leaves of the region and the sums above them are updated. A leaf
can hold many chunks after an insertion; a tree with twice as many chunks as leaves is laid out
anew from its counts.

``apply_edits`` sends a document and its edits through one task in edit order, as a sorted stream:
memory holds one document, however many edits it has. Documents without edits are not moved: a
bitmap of the edited ids, of a fixed size, keeps nearly all of them out of the shuffle.

Defined cases: a null text is empty (no tokens); positions are cut to the text and a reversed
range is empty; a null replacement is empty, null positions are 0; edits of unknown documents are
ignored; equal (doc_id, seq) are applied in the order of their contents; of several rows with one
doc_id each is a document of its own and gets all its edits; a null doc_id has no edits; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, task_count, text_column, texts_of
from tickerloom.llm.hashing import pack_integers, unpack_integers
from tickerloom.llm.tokens import ChunkEncoder, encoder

TREES = (
    "doc_id long, text_hash long, n_tokens long, n_chars long, n_leaves int, chars binary, "
    "tokens binary"
)
COUNTS = (
    "doc_id long, n_edits long, tokens_before long, tokens_after long, chars_after long, "
    "encoded_chars long"
)


_BITS = 1 << 23


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def _starts_chunk(text: str) -> bool:
    """One space, then a visible character."""
    return len(text) > 1 and text[0] == " " and not text[1].isspace()


class CountTree:
    """The chunks of a document in leaves, with sums of characters and tokens above them.

    A leaf has a list of chunks and of their token counts: one chunk at first, several after an
    insertion, none after a deletion. Every chunk but the document's first begins with the space
    it stands after.
    """

    def __init__(self, chunks: list[str], counts: list[int], encode: ChunkEncoder):
        self.encode = encode
        self.encoded_chars = 0
        self._build(chunks, counts)

    @classmethod
    def of_text(cls, text: str, encode: ChunkEncoder) -> CountTree:
        return cls(*encode.counted(text), encode)

    def _build(self, chunks: list[str], counts: list[int]) -> None:
        self.n = 1 << max(0, len(chunks) - 1).bit_length()
        missing = self.n - len(chunks)
        self.held = [([c], [k]) for c, k in zip(chunks, counts)] + [([], [])] * missing
        self.n_chunks = len(chunks)
        self.chars = self._sums([len(c) for c in chunks] + [0] * missing)
        self.tokens = self._sums(counts + [0] * missing)

    @staticmethod
    def _sums(values: list[int]) -> list[int]:
        """Node k has the children 2k and 2k + 1; the leaves come last."""
        levels = [np.array(values, np.int64)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(1))
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def _leaf_text(self, leaf: int) -> str:
        return "".join(self.held[leaf][0])

    def text(self) -> str:
        return "".join(map(self._leaf_text, range(self.n)))

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds character ``at``."""
        node, before = 1, 0
        while node < self.n:
            node *= 2
            if at >= before + self.chars[node]:
                before += self.chars[node]
                node += 1
        return node - self.n, before

    def _next(self, leaf: int, step: int) -> int | None:
        """The nearest leaf with text in a direction."""
        leaf += step
        while 0 <= leaf < self.n and not self.held[leaf][0]:
            leaf += step
        return leaf if 0 <= leaf < self.n else None

    def _put(self, leaf: int, chunks: list[str], counts: list[int]) -> None:
        node = leaf + self.n
        more_chars = sum(map(len, chunks)) - self.chars[node]
        more_tokens = sum(counts) - self.tokens[node]
        self.n_chunks += len(chunks) - len(self.held[leaf][0])
        self.held[leaf] = chunks, counts
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters start..end-1; a text has nothing outside 0..n_chars."""
        size = self.n_chars
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        if not size:
            self._refill([0], replacement)
            return
        first, before = self._leaf_at(min(start, size - 1))
        last, _ = self._leaf_at(max(end - 1, min(start, size - 1)))
        region = [k for k in range(first, last + 1) if self.held[k][0]]
        old = "".join(map(self._leaf_text, region))
        text = old[: start - before] + replacement + old[end - before :]
        left, right = self._next(first, -1), self._next(last, 1)
        widen_left, widen_right = left is not None, right is not None  # one leaf of context
        while widen_left or widen_right:
            if widen_left:
                region.insert(0, left)
                text = self._leaf_text(left) + text
                left = self._next(left, -1)
            if widen_right:
                region.append(right)
                text += self._leaf_text(right)
                right = self._next(right, 1)
            widen_left = left is not None and not (
                _starts_chunk(text) and not self._leaf_text(left)[-1].isspace()
            )
            widen_right = right is not None and not (
                _starts_chunk(self._leaf_text(right)) and text and not text[-1].isspace()
            )
        self._refill(region, text)

    def _refill(self, region: list[int], text: str) -> None:
        """Encode a region anew and spread its chunks over its leaves."""
        self.encoded_chars += len(text)
        chunks, counts = self.encode.counted(text)
        share = max(1, -(-len(chunks) // len(region)))
        for number, leaf in enumerate(region):
            part = slice(number * share, (number + 1) * share)
            self._put(leaf, chunks[part], counts[part])
        if self.n_chunks > 2 * self.n + 8:
            self._build(
                [c for chunks, _ in self.held for c in chunks],
                [k for _, counts in self.held for k in counts],
            )


# --- the Spark operators --------------------------------------------------------------------------


def count_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text_hash, n_tokens, n_chars, n_leaves, chars, tokens): the leaves of every document's
    tree, written once and kept for later edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, codec = encoder(tokenizer), _codec()
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                sizes, counts = encode.measured(text)
                rows.append((
                    int(counts.sum()), len(text), len(sizes), pack_integers(sizes, codec),
                    pack_integers(counts, codec),
                ))
            total, length, n, chars, tokens = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(total, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(n, pa.int32()), pa.array(chars, pa.binary()),
                 pa.array(tokens, pa.binary())],
                [f.split()[0] for f in TREES.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    return materialize(
        rows.select("doc_id", "text_hash", "text").mapInArrow(run, TREES), "count-trees"
    )


def load_tree(text: str, n: int, chars: bytes, tokens: bytes, encode: ChunkEncoder) -> CountTree:
    """A kept tree with its text; nothing is encoded."""
    codec = _codec()
    ends = np.cumsum(unpack_integers(chars, n, codec)).astype(np.int64).tolist()
    chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
    return CountTree(chunks, unpack_integers(tokens, n, codec).astype(np.int64).tolist(), encode)


def _marked(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with ``_edited``: false only if their doc_id is surely not among the named ones.

    The bitmap has ``_BITS`` bits in words of 64, so the side that is broadcast has at most
    131,072 rows of two numbers however many ids there are.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_BITS))
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    word = F.floor(F.col("_place") / 64).cast("int")
    words = (
        named.select(place.alias("_place"))
        .groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    )
    marked = rows.withColumn("_place", place).withColumn("_word", word)
    edited = F.coalesce(F.col("_bits"), F.lit(0).cast("long")).bitwiseAND(bit) != 0
    return marked.join(F.broadcast(words), "_word", "left").select(
        *rows.columns, (edited & F.col("doc_id").isNotNull()).alias("_edited")
    )


def apply_edits(
    docs: DataFrame, trees: DataFrame, edits: DataFrame, tokenizer: str
) -> DataFrame:
    """(doc_id, n_edits, tokens_before, tokens_after, chars_after, encoded_chars) per document.

    ``edits``: doc_id, seq, start, end, replacement. ``encoded_chars`` is what the edits had to
    encode anew.
    """
    zero = F.lit(0).cast("long")
    changes = edits.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.col("seq").cast("long"),
        F.coalesce(F.col("start").cast("long"), zero).alias("start"),
        F.coalesce(F.col("end").cast("long"), zero).alias("end"),
        F.coalesce("replacement", F.lit("")).alias("replacement"),
    )
    changes = materialize(changes, "edits")
    named = changes.select("doc_id")
    texts = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    known = _marked(trees, named)
    touched, still = known.filter("_edited"), known.filter("NOT _edited")
    held = _marked(texts, named).filter("_edited")
    # Every version of a document (rows with one doc_id) gets the edits of its doc_id.
    versions = touched.select("doc_id", "text_hash").distinct()
    none, blank = F.lit(None).cast("binary"), F.lit("")
    event = {"seq": zero, "start": zero, "end": zero, "text": blank, "chars": none, "tokens": none}

    def as_events(rows: DataFrame, kind: int, **columns: Column) -> DataFrame:
        filled = event | columns
        return rows.select(
            "doc_id", "text_hash", F.lit(kind).alias("kind"),
            *[column.alias(name) for name, column in filled.items()],
        )

    named_columns = {c: F.col(c) for c in ("chars", "tokens")}
    stream = (
        as_events(touched, 0, end=F.col("n_leaves").cast("long"), **named_columns)
        .unionByName(as_events(held, 1, text=F.col("text")))
        .unionByName(as_events(
            changes.join(versions, "doc_id"), 2, seq=F.col("seq"), start=F.col("start"),
            end=F.col("end"), text=F.col("replacement"),
        ))
    )
    order = ["doc_id", "text_hash", "kind", "seq", "start", "end", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        at, kept, tree, before, n, copies = None, None, None, 0, 0, 0
        done: list[tuple] = []

        def close() -> None:
            if tree is not None:
                row = (at[0], n, before, tree.n_tokens, tree.n_chars, tree.encoded_chars)
                done.extend([row] * copies)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * 6
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                [f.split()[0] for f in COUNTS.split(", ")],
            )

        for batch in batches:
            for row in zip(*(batch.column(c) for c in (*order, "chars", "tokens"))):
                doc, mark, kind, _, start, end, text, chars, tokens = (v.as_py() for v in row)
                if at != (doc, mark):
                    close()
                    at, kept, tree, n, copies = (doc, mark), None, None, 0, 0
                if kind == 0:  # one row per document with this text
                    kept, copies = (end, chars, tokens), copies + 1
                elif kind == 1:
                    if tree is None:
                        tree = load_tree(text, *kept, encode)
                        before = tree.n_tokens
                else:
                    tree.edit(start, end, text)
                    n += 1
            yield flush()
        close()
        yield flush()

    tasks = task_count(docs.sparkSession)
    dealt = stream.repartition(tasks, "doc_id", "text_hash").sortWithinPartitions(*order)
    edited = dealt.mapInArrow(run, COUNTS)
    same = still.select(
        "doc_id", zero.alias("n_edits"), F.col("n_tokens").alias("tokens_before"),
        F.col("n_tokens").alias("tokens_after"), F.col("n_chars").alias("chars_after"),
        zero.alias("encoded_chars"),
    )
    return edited.unionByName(same)
