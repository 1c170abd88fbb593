"""The lighter feature set on winsorised returns: MACD, plain volume ratio, lags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.functions import indicators as ind
from tickerloom.operators.cleaning import drop_missing_returns, winsorize_returns
from tickerloom.operators.ema import add_macd
from tickerloom.operators.indicators import with_indicators
from tickerloom.params import Params


def winsorized_bars(clean: DataFrame, params: Params) -> DataFrame:
    return clean.transform(drop_missing_returns).transform(winsorize_returns, params)


def add_side_features(clean: DataFrame, params: Params) -> DataFrame:
    """Drop null returns, clip the rest, add features, drop the warm-up bars."""
    bars = winsorized_bars(clean, params)
    featured = with_indicators(
        add_macd(bars, params), params, ind.plain_volume, ind.lagged_returns
    )
    return featured.dropna(subset=[*params.lag_columns, "macd"])
