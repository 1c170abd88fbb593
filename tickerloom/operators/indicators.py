"""Add indicator columns to clean bars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions import indicators as ind
from tickerloom.functions.indicators import Indicator
from tickerloom.operators.benchmark import with_benchmark
from tickerloom.params import Params

IndicatorMaker = Callable[[Params], Indicator]

# In dependency order: a later maker may read the columns an earlier one derives.
FEATURE_MAKERS: tuple[IndicatorMaker, ...] = (
    ind.moving_averages,
    ind.cross_signal,
    ind.mean_spread,
    ind.rsi,
    ind.rsi_state,
    ind.bands,
    ind.volatility,
    ind.sharpe,
    ind.beta,
    ind.momentum,
    ind.drawdown,
    ind.weekday,
    ind.volume,
    ind.lagged_returns,
    ind.forward_return,
)


def with_indicators(bars: DataFrame, params: Params, *makers: IndicatorMaker) -> DataFrame:
    """Add the indicators: one projection of window expressions, then plain arithmetic."""
    wanted = [make(params) for make in makers]
    windows = {name: column for one in wanted for name, column in one.windows.items()}
    out = bars.withColumns(windows) if windows else bars
    for one in wanted:
        if one.derived:
            out = out.withColumns(dict(one.derived))
    return out.drop(*[name for name in windows if name.startswith("_")])


def add_features(clean: DataFrame, params: Params) -> DataFrame:
    """The full feature table from clean bars with ``daily_return``.

    The benchmark join comes first: it is the only operator not keyed by ticker, and placed
    between windows it would cost a second Exchange. After it, every column is a frame over
    (ticker, date), the whole-history statistics included.
    """
    joined = with_benchmark(clean, params)
    return with_indicators(joined, params, *FEATURE_MAKERS).select(*params.feature_columns)
