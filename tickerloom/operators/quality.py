"""Data-quality reports. Each is one aggregate over the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.cleaning import KEY, cast_days, cast_numerics
from tickerloom.params import Params
from tickerloom.sources.storage import scratch_path
from tickerloom.sources.tables import read_bucketed, write_bucketed


def judged_bars(raw: DataFrame, params: Params, partitions: int | None = None) -> DataFrame:
    """One row per (ticker, date): the bar that cleaning keeps of it, how many raw rows it had
    (``rows_in``), how many of them had all required values (``rows_valid``), and whether its
    return makes it an ``outlier``.

    Raw rows fold to keys in the map tasks and are shuffled once; a second shuffle brings the
    keys to their tickers, into ``partitions`` partitions if given. A key without a valid row
    has no bar and does not stand between the bars beside it.
    """
    valid = F.col("ticker").isNotNull() & F.col("date").isNotNull() & F.col("close").isNotNull()
    rest = [c for c in raw.columns if c not in KEY]
    keyed = (
        cast_numerics(cast_days(raw, params))
        .groupBy(*KEY)
        .agg(
            F.count("*").alias("rows_in"),
            F.count_if(valid).alias("rows_valid"),
            F.min(F.when(valid, F.struct(*rest))).alias("_kept"),
        )
        .select(*KEY, "rows_in", "rows_valid", "_kept.*")
    )
    if partitions is not None:
        keyed = keyed.repartition(partitions, "ticker")
    earlier = (
        Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.last("close", ignorenulls=True).over(earlier)
    r = F.col("daily_return")
    change = F.try_divide(F.col("close") - F.col("_before"), "_before")
    outlier = r.isNotNull() & ~r.between(params.outlier_low, params.outlier_high)
    return (
        keyed.withColumn("_before", before)
        .withColumn("daily_return", change)
        .withColumn("outlier", (F.col("rows_valid") > 0) & outlier)
        .select(*raw.columns, "daily_return", "rows_in", "rows_valid", "outlier")
    )


def _removals() -> list[Column]:
    """How many rows each cleaning rule removes, of judged bars."""
    zero = F.lit(0).cast("bigint")
    sums = {
        "rows_in": F.coalesce(F.sum("rows_in"), zero),
        "null_rows": F.coalesce(F.sum(F.col("rows_in") - F.col("rows_valid")), zero),
        "duplicate_rows": F.coalesce(F.sum(F.greatest(F.col("rows_valid") - 1, zero)), zero),
        "outlier_rows": F.count_if("outlier"),
        "rows_out": F.count_if((F.col("rows_valid") > 0) & ~F.col("outlier")),
    }
    return [c.alias(name) for name, c in sums.items()]


def drop_report(raw: DataFrame, params: Params) -> DataFrame:
    """Rows each cleaning rule removes, in one pass over the raw bars."""
    return judged_bars(raw, params).agg(*_removals())


def clean_and_count(
    raw: DataFrame, params: Params, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """(the bars of ``clean_bars``, the row of ``drop_report``): one scan and one shuffle of the
    raw rows for both. The judged bars are written once, bucketed by ticker; what reads them
    shuffles nothing by ticker."""
    judged = judged_bars(raw, params, buckets)
    path = scratch_path(raw.sparkSession, "judged")
    write_bucketed(judged, path, buckets)
    written = read_bucketed(raw.sparkSession, path, judged.schema, buckets)
    clean = written.filter((F.col("rows_valid") > 0) & ~F.col("outlier"))
    return clean.select(*raw.columns, "daily_return"), written.agg(*_removals())


def audit(bars: DataFrame) -> DataFrame:
    """One row: size, key uniqueness, nulls, return statistics, impossible and idle bars.

    Bars fold to one row per key in the map tasks, keys to one per ticker, tickers to the row:
    no distinct count, so nothing is expanded. Returns are few hundredths, so their sum of
    squares gives the deviation to about 1e-12.
    """
    r = F.col("daily_return")
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    null_cells = sum((F.col(c).isNull().cast("bigint") for c in bars.columns), F.lit(0))
    sums = {
        "row_count": F.count("*"), "null_cells": F.sum(null_cells),
        "returns": F.count(r), "total": F.sum(r), "squares": F.sum(r * r),
        "bad_ohlc_rows": F.count_if((high < low) | (close > high) | (close < low)),
        "zero_volume_rows": F.count_if(F.col("volume") == 0),
    }
    keys = bars.groupBy(*KEY).agg(
        *[c.alias(n) for n, c in sums.items()],
        F.min(r).alias("return_min"), F.max(r).alias("return_max"),
    ).withColumn("keys", F.lit(1))

    def folded(names: list[str]) -> list[Column]:
        return [F.sum(n).alias(n) for n in names]

    names = [*sums, "keys"]
    ends = [F.min("return_min").alias("return_min"), F.max("return_max").alias("return_max")]
    tickers = keys.groupBy("ticker").agg(
        *folded(names), *ends, F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    n, total = F.col("returns"), F.col("total")
    spread = F.greatest(F.col("squares") - total * total / n, F.lit(0.0))
    return tickers.agg(
        *folded(names), *ends, F.count("ticker").alias("tickers"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    ).select(
        "row_count", "tickers", "first_date", "last_date", "null_cells",
        (F.col("row_count") - F.col("keys")).alias("duplicate_keys"),
        F.try_divide(total, n).alias("return_mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("return_std"),
        "return_min", "return_max", "bad_ohlc_rows", "zero_volume_rows",
    )


def audit_tickers(bars: DataFrame) -> DataFrame:
    """The audit's ticker list, as rows: it grows with the universe, so no array holds it."""
    return bars.groupBy("ticker").agg(
        F.count("*").alias("row_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def load_report(bars: DataFrame, params: Params) -> DataFrame:
    """One row: what dropping null returns and winsorising will do to these bars."""
    r = F.col("daily_return")
    kept = r.isNotNull()
    return bars.agg(
        F.count_if(~kept).alias("null_returns"),
        F.count_if((r < params.clip_low) | (r > params.clip_high)).alias("clipped_returns"),
        F.count_if(kept).alias("row_count"),
        F.count_distinct(F.when(kept, F.col("ticker"))).alias("tickers"),
        F.min(F.when(kept, F.col("date"))).alias("first_date"),
        F.max(F.when(kept, F.col("date"))).alias("last_date"),
    )
