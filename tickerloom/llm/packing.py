"""Vector best-fit packing of token pieces into fixed-length sequences.

A piece demands tokens, one document and attention cost (length squared); a sequence has a
capacity for each. Pieces are placed longest first; among the open sequences that hold a piece
under every capacity, ``rule`` picks one: "norm" leaves the smallest weighted residual vector,
"dot" takes the largest weighted product of demand and residual. A capacity that no contents can
exceed has weight 0; the others weigh as much as the average piece takes of them.

Pieces are dealt at random into groups of about ``group_tokens`` tokens (and at most about
``group_pieces`` pieces), so a group is a fair sample of all lengths, is bounded however large
the table is, and wastes less than one sequence more than packing all pieces at once would.

Defined cases: a null text is empty; an empty document is one piece with just the end id; equal
rows are packed as separate pieces; null doc_ids are kept; an empty table packs to no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, release_memory, task_count, text_column, texts_of
from tickerloom.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PLACES = "sequence_id long, offset long"

LENGTH = 4096
GROUP_TOKENS = 1 << 24
GROUP_PIECES = 1 << 16
_ROWS = 1000  # pieces returned to Spark at a time
_LOCAL_BITS = 32  # sequence_id: group above, number in the group below


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, keep_ids: bool = True
) -> DataFrame:
    """Each document's ids with the end id, cut every ``length``; ids little-endian, or null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)

        def block(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

        for batch in batches:
            rows: list[tuple] = []
            encoded = encode.stream(texts_of(batch), end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                for number, at in enumerate(range(0, len(ids), length)):
                    part = ids[at : at + length]
                    rows.append((doc_id, number, at, len(part), zlib.crc32(part.astype("<u4")),
                                 part.tobytes() if keep_ids else None))
                if len(rows) >= _ROWS:
                    yield block(rows)
                    rows = []
            yield block(rows)
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(
    lengths: np.ndarray, length: int = LENGTH, max_documents: int | None = None,
    max_attention: int | None = None, rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece of one group."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    n = len(lengths)
    items = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], 1).astype(float)
    bound = np.array([length, length, float(length) ** 2])  # what tokens alone allow
    caps = np.array([
        length,
        length if max_documents is None else max_documents,
        bound[2] if max_attention is None else max_attention,
    ], float)
    if n and (items > caps).any():
        raise ValueError("a piece exceeds a capacity on its own")
    binding = caps < bound
    binding[0] = True
    mean = items.mean(0) / caps if n else np.zeros(3)
    weights = np.where(binding, mean, 0.0) / caps**2
    place, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rest, names = np.empty((256, 3)), np.empty(256, np.int64)
    used, opened = 0, 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if n else 0
    for i in order:
        item = items[i]
        fits = (rest[:used] >= item).all(1)
        if fits.any():
            if rule == "norm":
                score = -((rest[:used] - item) ** 2 @ weights)
            else:
                score = rest[:used] @ (item * weights)
            at = int(np.argmax(np.where(fits, score, -np.inf)))
        else:
            if used == len(rest):
                rest = np.concatenate([rest, np.empty_like(rest)])
                names = np.concatenate([names, np.empty_like(names)])
            at, used = used, used + 1
            rest[at], names[at] = caps, opened
            opened += 1
        place[i] = names[at]
        offset[i] = length - int(rest[at, 0])
        rest[at] -= item
        if rest[at, 0] < least or rest[at, 1] < 1:  # nothing fits there any more
            used -= 1
            rest[at], names[at] = rest[used], names[used]
    return place, offset


def pack(
    pieces: DataFrame, length: int = LENGTH, max_documents: int | None = None,
    max_attention: int | None = None, rule: str = "norm", group_tokens: int = GROUP_TOKENS,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``pieces`` plus sequence_id and offset, gapless from 0 in each sequence."""
    table = materialize(pieces, "pieces")
    total = table.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t")).first()
    groups = max(1, -(-(total["t"] or 0) // group_tokens), -(-total["n"] // group_pieces))
    # The row number of a written table spreads equal rows too.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)

    def place(key: tuple, group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        sequence, offset = best_fit(lengths, length, max_documents, max_attention, rule)
        sequence = sequence + (key[0].as_py() << _LOCAL_BITS)
        group = group.drop_columns(["_group"])
        return group.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64())
        )

    spread = table.withColumn("_group", dealt)
    spread = spread.repartition(max(groups, task_count(table.sparkSession)), "_group")
    return spread.groupBy("_group").applyInArrow(place, f"{fields}, {PLACES}")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences; one group is at most one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), whole.alias("ids")
    )
