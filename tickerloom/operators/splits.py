"""Model rows and exact time-ordered cuts of them.

Rows are ordered by date, then by a digest of the ticker (ties inside a day need some fixed
order; a digest spreads evenly, ticker names do not). A cut is found by counting, not by
sorting the table: per-day counts locate the day a cut falls on, per-digest-prefix counts
locate the prefix inside that day, and only that prefix's rows -- 1/4096 of one day -- are
ranked. The table itself is never shuffled: each row is compared with the cut keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.params import Params

LABEL = "is_profitable"
TARGET = "forward_return"

# Digest characters per counting cell: 16 ** 3 cells a day.
_PREFIX = 3


def ml_rows(features: DataFrame, params: Params) -> DataFrame:
    """Key, predictors and label of the rows that have all predictors and a target."""
    missing = [c for c in (*params.predictors, TARGET) if c not in features.columns]
    if missing:
        raise ValueError(f"the feature table lacks {missing}")
    complete = features.select("ticker", "date", *params.predictors, TARGET).dropna()
    return complete.withColumn(LABEL, (F.col(TARGET) > 0).cast("int")).drop(TARGET)


def _digest() -> Column:
    """Never null, so that no null check on it is pushed to the scan."""
    return F.coalesce(F.md5("ticker"), F.lit(""))


def _cut_keys(rows: DataFrame, cut_ranks: Callable[[Column], Column], group: str) -> DataFrame:
    """Per group an array ``cuts`` of (date, digest, times): the row at each wanted rank.

    ``cut_ranks`` maps the group's row count to an array of 0-based ranks; ``times`` says how
    often a rank occurs in it.
    """
    total = Window.partitionBy(group)
    keyed = rows.select(group, "date", "ticker")

    days = Window.partitionBy(group).orderBy("date")
    daily = (
        keyed.groupBy(group, "date")
        .agg(F.count("*").alias("n"))
        .withColumn("below", F.sum("n").over(days) - F.col("n"))
        .withColumn("ranks", cut_ranks(F.sum("n").over(total)))
        .withColumn("rank", F.explode(F.array_distinct("ranks")))
        .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
        .select(
            group, "date", (F.col("rank") - F.col("below")).alias("left"),
            F.size(F.filter("ranks", lambda r: r == F.col("rank"))).alias("times"),
        )
    )
    # One row per cut and group from here on, so these broadcasts are a handful of rows, and
    # digests are only computed for the rows of a cut's day.
    on_day = (
        keyed.join(F.broadcast(daily), [group, "date"])
        .withColumn("digest", _digest())
        .withColumn("prefix", F.left("digest", F.lit(_PREFIX)))
    )
    cut = [group, "date", "left", "times"]
    prefixes = Window.partitionBy(*cut).orderBy("prefix")
    cells = (
        on_day.groupBy(*cut, "prefix")
        .agg(F.count("*").alias("n"))
        .withColumn("below", F.sum("n").over(prefixes) - F.col("n"))
        .filter((F.col("left") >= F.col("below")) & (F.col("left") < F.col("below") + F.col("n")))
        .select(*cut, "prefix", (F.col("left") - F.col("below")).alias("step"))
    )
    in_cell = Window.partitionBy(*cut).orderBy("digest")
    return (
        on_day.join(F.broadcast(cells), [*cut, "prefix"])
        .withColumn("position", F.row_number().over(in_cell) - 1)
        .filter(F.col("position") == F.col("step"))
        .groupBy(group)
        .agg(F.collect_list(F.struct("date", "digest", "times")).alias("cuts"))
    )


def _cuts_passed(cuts: Column) -> Column:
    """How many cut keys a row is at or past. The digest is only computed on a cut's day."""

    def passed(cut: Column) -> Column:
        same_day = F.col("date") == cut["date"]
        reached = F.when(same_day, _digest() >= cut["digest"]).otherwise(
            F.col("date") > cut["date"]
        )
        return F.when(reached, cut["times"]).otherwise(0)

    total = F.aggregate(cuts, F.lit(0), lambda seen, cut: seen + passed(cut))
    return F.coalesce(total, F.lit(0))


def walk_forward(rows: DataFrame, params: Params) -> DataFrame:
    """Add ``is_test``: 0 for the first floor(n x (1 - test share)) rows in time, else 1."""

    def ranks(n: Column) -> Column:
        return F.array(F.floor(n * F.lit(1.0 - params.test_share)))

    everyone = rows.select(F.lit(0).alias("_all"), "date", "ticker")
    cuts = _cut_keys(everyone, ranks, "_all").select("cuts").scalar()
    return rows.withColumn("_cuts", cuts).withColumn(
        "is_test", _cuts_passed(F.col("_cuts"))
    ).drop("_cuts")


def cut_parts(rows: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a written table, cut as by ``walk_forward``.

    The cut is fetched as one (date, digest) and compared as literals, so a bound on the date
    reaches the scan of either part. ``gap_days`` leaves out training rows that close to it.
    """

    def ranks(n: Column) -> Column:
        return F.array(F.floor(n * F.lit(1.0 - params.test_share)))

    everyone = rows.select(F.lit(0).alias("_all"), "date", "ticker")
    found = _cut_keys(everyone, ranks, "_all").select("cuts").first()
    if not found or not found.cuts:
        return rows, rows.limit(0)
    cut = found.cuts[0]
    day, date = F.lit(cut.date), F.col("date")
    past = (date == day) & (_digest() >= F.lit(cut.digest))
    train = rows.filter((date <= day) & ~past)
    if params.gap_days:
        train = train.filter(date < F.date_sub(day, params.gap_days))
    return train, rows.filter((date >= day) & ((date > day) | past))


def training_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("is_test") == 0).drop("is_test")


def testing_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("is_test") == 1).drop("is_test")


def cv_folds(rows: DataFrame, params: Params) -> DataFrame:
    """Add ``fold``: every class cut in time order into equal contiguous parts."""

    def ranks(n: Column) -> Column:
        return F.array(*[F.ceil(n * F.lit(f) / F.lit(params.folds)) for f in range(1, params.folds)])

    cuts = _cut_keys(rows, ranks, LABEL)
    return (
        rows.join(F.broadcast(cuts), LABEL, "left")
        .withColumn("fold", _cuts_passed(F.col("cuts")))
        .select(*rows.columns, "fold")
    )


def class_weights(rows: DataFrame) -> DataFrame:
    """label, rows, weight = all rows / (classes x rows of the class)."""
    counts = rows.groupBy(LABEL).agg(F.count("*").alias("rows"))
    every = Window.partitionBy(F.lit(0))
    weight = F.sum("rows").over(every) / (F.count("*").over(every) * F.col("rows"))
    return counts.withColumn("weight", weight)


def with_class_weights(rows: DataFrame) -> DataFrame:
    """Add ``weight`` per row; the broadcast side has one row per class."""
    weights = class_weights(rows).select(LABEL, "weight")
    return rows.join(F.broadcast(weights), LABEL).select(*rows.columns, "weight")
