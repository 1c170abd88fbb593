"""Technical indicators as expression bundles.

An ``Indicator`` separates what needs a window from what is arithmetic on window results.
``operators.indicators.with_indicators`` merges the window parts of any number of indicators
into one projection, so asking for one indicator or for all of them costs one Window pass.
Window names with a leading underscore are scratch and are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tickerloom.functions.scalars import safe_ratio, weekday_number
from tickerloom.functions.windows import ordered, trailing, whole_history
from tickerloom.params import Params


@dataclass(frozen=True)
class Indicator:
    windows: Mapping[str, Column] = field(default_factory=dict)
    derived: Mapping[str, Column] = field(default_factory=dict)


def _mean_close(p: Params) -> dict[str, Column]:
    return {
        p.short_ma: F.avg("close").over(trailing(p.short_window)),
        p.long_ma: F.avg("close").over(trailing(p.long_window)),
    }


def moving_averages(p: Params) -> Indicator:
    """Mean close over the short and long frame; partial frames count from the first bar."""
    return Indicator(_mean_close(p))


def cross_signal(p: Params) -> Indicator:
    """1.0 where the short mean is above the long mean, else -1.0 (ties included)."""
    above = F.col(p.short_ma) > F.col(p.long_ma)
    return Indicator(_mean_close(p), {"ma_cross_signal": F.when(above, 1.0).otherwise(-1.0)})


def mean_spread(p: Params) -> Indicator:
    gap = F.col(p.short_ma) - F.col(p.long_ma)
    return Indicator(_mean_close(p), {"ma_spread": safe_ratio(gap, F.col(p.long_ma))})


def full_window_averages(p: Params) -> Indicator:
    """Like ``moving_averages`` but null until the frame is full."""
    columns = {}
    for name, rows in ((p.short_ma, p.short_window), (p.long_ma, p.long_window)):
        frame = trailing(rows)
        full = F.count("close").over(frame) == rows
        columns[name] = F.when(full, F.avg("close").over(frame))
    return Indicator(columns)


def rsi(p: Params) -> Indicator:
    """Simple-mean relative strength; bars without a return count as no move."""
    frame = trailing(p.rsi_window)
    r = F.col("daily_return")
    up = F.when(r > 0, r).otherwise(0.0)
    down = F.when(r < 0, -r).otherwise(0.0)
    strength = safe_ratio(F.col("_mean_up"), F.col("_mean_down"))
    return Indicator(
        {"_mean_up": F.avg(up).over(frame), "_mean_down": F.avg(down).over(frame)},
        {"rsi": F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength)},
    )


def rsi_state(_: Params) -> Indicator:
    """0.0 oversold (< 30), 2.0 overbought (> 70), else 1.0. Needs ``rsi``."""
    value = F.col("rsi")
    return Indicator(
        derived={"rsi_binned": F.when(value < 30, 0.0).when(value > 70, 2.0).otherwise(1.0)}
    )


def bands(p: Params) -> Indicator:
    """Mean +/- width x sample deviation, and the close's position between the bands."""
    frame = trailing(p.band_window)
    middle = F.col("bb_mid")
    reach = F.col("_band_dev") * F.lit(float(p.band_width))
    return Indicator(
        {"bb_mid": F.avg("close").over(frame), "_band_dev": F.stddev_samp("close").over(frame)},
        {
            "bb_upper": middle + reach,
            "bb_lower": middle - reach,
            "bb_pct_b": safe_ratio(
                F.col("close") - (middle - reach), (middle + reach) - (middle - reach)
            ),
        },
    )


def volatility(p: Params) -> Indicator:
    deviation = F.stddev_samp("daily_return").over(trailing(p.long_window))
    return Indicator(
        {"_return_dev": deviation},
        {"volatility": F.col("_return_dev") * F.sqrt(F.lit(p.trading_days))},
    )


def momentum(p: Params) -> Indicator:
    before = F.col("_close_before")
    return Indicator(
        {"_close_before": F.lag("close", p.momentum_days).over(ordered())},
        {p.momentum: safe_ratio(F.col("close") - before, before)},
    )


def drawdown(p: Params) -> Indicator:
    peak = F.col("_peak")
    return Indicator(
        {"_peak": F.max("close").over(trailing(p.drawdown_window))},
        {p.drawdown: safe_ratio(F.col("close") - peak, peak)},
    )


def weekday(_: Params) -> Indicator:
    return Indicator(derived={"day_of_week": weekday_number(F.col("date"))})


def volume(p: Params) -> Indicator:
    mean = F.avg(F.col("volume").cast("double")).over(trailing(p.volume_window))
    return Indicator(
        {p.volume_ma: mean},
        {"volume_ratio": safe_ratio(F.col("volume").cast("double"), F.col(p.volume_ma))},
    )


def plain_volume(p: Params) -> Indicator:
    """Volume ratio without the epsilon: null where the mean volume is zero."""
    mean = F.avg(F.col("volume").cast("double")).over(trailing(p.volume_window))
    return Indicator(
        {p.volume_ma: mean},
        {"volume_ratio": F.try_divide(F.col("volume").cast("double"), F.col(p.volume_ma))},
    )


def lagged_returns(p: Params) -> Indicator:
    return Indicator(
        {
            name: F.lag("daily_return", k).over(ordered())
            for name, k in zip(p.lag_columns, p.lags, strict=True)
        }
    )


def forward_return(p: Params) -> Indicator:
    """Return over the next ``forward_days`` bars; null at the end of the series."""
    ahead = F.col("_close_ahead")
    return Indicator(
        {"_close_ahead": F.lead("close", p.forward_days).over(ordered())},
        {"forward_return": F.try_divide(ahead - F.col("close"), F.col("close"))},
    )


def _long_frame(p: Params) -> WindowSpec:
    return whole_history() if p.trailing_window is None else trailing(p.trailing_window)


def sharpe(p: Params) -> Indicator:
    """Annualised excess return per unit of annualised deviation, over the whole history
    unless ``trailing_window`` is set."""
    every = _long_frame(p)
    gain = F.col("_history_mean") * F.lit(p.trading_days) - F.lit(p.risk_free)
    risk = F.col("_history_dev") * F.sqrt(F.lit(p.trading_days))
    return Indicator(
        {
            "_history_mean": F.avg("daily_return").over(every),
            "_history_dev": F.stddev_samp("daily_return").over(every),
        },
        {"sharpe_ratio": safe_ratio(gain, risk)},
    )


def beta(p: Params) -> Indicator:
    """Covariance with the benchmark over the benchmark's variance. Needs ``bench_return``.

    The variance covers every bar that has a benchmark return, also those whose own return
    is null; the covariance needs both.
    """
    every = _long_frame(p)
    return Indicator(
        {
            "_bench_cov": F.covar_samp("daily_return", "bench_return").over(every),
            "_bench_var": F.var_samp("bench_return").over(every),
        },
        {"beta": safe_ratio(F.col("_bench_cov"), F.col("_bench_var"))},
    )
