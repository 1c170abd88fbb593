"""Mixing sources to target weights by systematic sampling.

Sources share ``share`` times the corpus by weight; a target stops at ``cap`` times its source,
and what is cut off is shared again by weight until none is above. That fixed point is
target = min(cap * size, level * weight) with one level for all sources, found in closed form.

Within a source every document expects target / size copies. Documents are ordered by size (then
by a seeded hash), their expected copies are summed along that order, one seeded offset per
source is added, and a document is emitted once for each whole number its step crosses. Ordering
by size keeps the taken words within one largest document of the target. Ranks come from range
partitions and a count per (partition, source), so a source may hold any share of the rows.

Defined cases: a null text has size 0; the null source is a source of its own, after the others;
a source without words has target 0 and emits nothing; equal rows are sampled as separate rows;
an empty table gives no rows; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerloom.llm.common import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
WORD = r"[^\x20\x09-\x0D]+"

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size, target), one row per source; the windows hold just these rows."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    limit = F.col("source_size") * F.lit(float(cap))
    named = totals.withColumn("_weight", F.element_at(cycle, place.cast("int")))
    named = named.withColumns({"_limit": limit, "_ratio": limit / F.col("_weight")})
    filling = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    spent = F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    level = (budget - spent) / F.sum("_weight").over(onward)
    # While sources are capped in order of their ratio the level rises; past them it falls.
    return (
        named.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size",
                F.least("_limit", F.col("_level") * F.col("_weight")).alias("target"))
    )


def systematic_copies(
    sized: DataFrame, targets: DataFrame, seed: int = 0
) -> DataFrame:
    """``sized`` (with doc_id, source and size) plus source_size, target and ``copies``.

    The ordered rows are written once: ranks then rest on one layout, whatever is recomputed.
    """
    carried = sized.columns
    tie = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("_tie"), F.col("doc_id")]
    laid = (
        sized.withColumn("_tie", tie)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    )
    laid = materialize(laid, "mix")
    part = F.shiftright("_at", _ROW_BITS)
    spans = laid.groupBy(part.alias("_part"), "source").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    # A multiple of 2**-20, so that adding it to a whole or half number of copies is exact.
    named = F.concat(
        F.lit(f"{seed}/"), F.coalesce("source", F.lit("")), F.lit("/"),
        F.when(F.col("source").isNull(), "none").otherwise("some"),
    )
    offset = F.conv(F.substring(F.md5(named), 1, 5), 16, 10).cast("long") / F.lit(1 << 20)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    drawn = targets.select(
        F.col("source").alias("_of"), "source_size", "target",
        F.coalesce(rate, F.lit(0.0)).alias("_rate"), offset.alias("_offset"),
    )
    # Rows before this partition's of the source, less the row number that its first one has.
    spans = spans.select(
        "_part", F.col("source").alias("_of"), (before - F.col("_first")).alias("_shift")
    )
    placed = laid.withColumn("_part", part).join(
        spans.withColumnRenamed("_part", "_span"),
        (F.col("_part") == F.col("_span")) & F.col("source").eqNullSafe(F.col("_of")),
    ).drop("_of", "_span")
    placed = placed.join(drawn, F.col("source").eqNullSafe(F.col("_of")))
    rank = F.col("_at") + F.col("_shift")
    crossed = F.floor((rank + 1) * F.col("_rate") + F.col("_offset")) - F.floor(
        rank * F.col("_rate") + F.col("_offset")
    )
    return placed.select(*carried, "source_size", "target", crossed.alias("copies"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source and size; all that sampling needs."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
    )


def _row_key(docs: DataFrame) -> Column:
    """A hash of the whole row; maps, which have no hash in Spark, are left out."""
    return F.xxhash64(*[f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    cap: float = CAP, seed: int = 0,
) -> DataFrame:
    """The mixed corpus: every emitted document as often as it is taken, in its own columns.

    Words are counted once and sampled as narrow rows; whole rows are shuffled once, to the
    copies of their key. Equal rows share their copies out among them.
    """
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), _row_key(docs).alias("_key"),
    )
    sized = materialize(sized, "mix-sizes")
    targets = source_targets(sized, weights, share, cap)
    taken = systematic_copies(sized, targets, seed)
    copies = taken.groupBy("_key").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = copies.filter("_copies > 0")
    # The merge leaves equal rows side by side, so numbering them costs no shuffle and no sort.
    whole = docs.withColumn("_key", _row_key(docs)).join(copies.hint("merge"), "_key")
    place = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    extra = (place <= F.col("_copies") % F.col("_rows")).cast("long")
    times = F.floor(F.col("_copies") / F.col("_rows")) + extra
    emitted = whole.withColumn("_times", times).filter("_times > 0")
    repeated = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return emitted.select(*docs.columns, repeated.alias("_copy")).drop("_copy")


def mix_report(docs: DataFrame, seed: int = 0, **rules) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) without moving any text."""
    sized = materialize(sized_documents(docs), "mix-sizes")
    taken = systematic_copies(sized, source_targets(sized, **rules), seed)
    return taken.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
