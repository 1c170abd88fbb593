"""Raw bars to clean bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.scalars import as_day, as_price, as_volume, clamp
from tickerloom.functions.windows import ordered
from tickerloom.params import PRICE_COLUMNS, Params

KEY = ("ticker", "date")


def cast_numerics(raw: DataFrame) -> DataFrame:
    """Prices to double and volume to bigint; values that do not parse become null."""
    prices = {c: as_price(F.col(c)) for c in PRICE_COLUMNS}
    return raw.withColumns({**prices, "volume": as_volume(F.col("volume"))})


def cast_days(raw: DataFrame, params: Params) -> DataFrame:
    """``date`` as a DATE: every per-ticker window rests on one bar per calendar day."""
    return raw.withColumn("date", as_day(F.col("date"), params.date_formats))


def drop_nulls(raw: DataFrame) -> DataFrame:
    return raw.dropna(subset=[*KEY, "close"])


def dedupe_bars(raw: DataFrame) -> DataFrame:
    """One row per (ticker, date): the smallest by the remaining columns, nulls first.

    An aggregate rather than a ranking: copies of a hot key fold map-side, so one row per key
    and task is shuffled, and the survivor is the same on every run.
    """
    rest = [c for c in raw.columns if c not in KEY]
    kept = raw.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*KEY, "_kept.*").select(*raw.columns)


def in_universe(raw: DataFrame, universe: DataFrame | tuple[str, ...] | None) -> DataFrame:
    """Keep the tickers of a literal list or of a table with a ``ticker`` column."""
    if universe is None:
        return raw
    if isinstance(universe, DataFrame):
        return raw.join(universe.select("ticker"), "ticker", "left_semi").select(*raw.columns)
    return raw.filter(F.col("ticker").isin(*universe))


def in_date_range(raw: DataFrame, params: Params) -> DataFrame:
    """Keep start <= date <= end."""
    return raw.filter(F.col("date").between(F.lit(params.start), F.lit(params.end)))


def add_daily_return(bars: DataFrame) -> DataFrame:
    """Relative change of close; null on a ticker's first bar or after a zero close."""
    before = F.lag("close", 1).over(ordered())
    return (
        bars.withColumn("_before", before)
        .withColumn("daily_return", F.try_divide(F.col("close") - F.col("_before"), "_before"))
        .drop("_before")
    )


def drop_outliers(bars: DataFrame, params: Params) -> DataFrame:
    """Drop bars whose return lies outside the limits; returns are not recomputed after."""
    r = F.col("daily_return")
    return bars.filter(r.isNull() | r.between(params.outlier_low, params.outlier_high))


def drop_missing_returns(bars: DataFrame) -> DataFrame:
    return bars.dropna(subset=["daily_return"])


def winsorize_returns(bars: DataFrame, params: Params) -> DataFrame:
    """Limit returns to the clip range."""
    limited = clamp(F.col("daily_return"), params.clip_low, params.clip_high)
    return bars.withColumn("daily_return", limited)


def clean_bars(raw: DataFrame, params: Params) -> DataFrame:
    """Cast, drop nulls, dedupe, add the daily return, drop outliers."""
    return (
        raw.transform(cast_days, params)
        .transform(cast_numerics)
        .transform(drop_nulls)
        .transform(dedupe_bars)
        .transform(add_daily_return)
        .transform(drop_outliers, params)
    )


def arrange_by_ticker(bars: DataFrame) -> DataFrame:
    """Each ticker whole in one partition, in date order."""
    return bars.repartition("ticker").sortWithinPartitions(*KEY)


def preview(bars: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in (ticker, date) order."""
    return bars.orderBy(*KEY).limit(rows)
