"""The parameter surface: one immutable object handed to every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

BAR_COLUMNS = ("date", "ticker", "open", "high", "low", "close", "volume")
BAR_TYPES = dict(zip(BAR_COLUMNS, ("date", "string", *["double"] * 4, "bigint")))
PRICE_COLUMNS = ("open", "high", "low", "close")

# Must equal the established defaults for results to match.
DEFAULT_UNIVERSE = (
    "AAPL", "MSFT", "GOOGL", "AMD", "INTC",
    "JPM", "BAC", "GS", "BLK",
    "JNJ", "ABBV",
    "AMZN", "COST",
    "CVX",
)

# Cluster labels from least to most risk, and their display colours.
RISK_LABELS = (
    ("Conservative", "#3B82F6"),
    ("Balanced", "#10B981"),
    ("Growth", "#F59E0B"),
    ("Aggressive", "#EF4444"),
)

CLUSTER_FEATURES = ("annualised_return", "volatility", "sharpe_ratio", "beta")

# Model fits submitted at the same time: each is a chain of jobs too short to fill a cluster.
FIT_THREADS = 4


@dataclass(frozen=True)
class Params:
    """Windows, thresholds and model sizes. Defaults are the production values."""

    universe: tuple[str, ...] | None = DEFAULT_UNIVERSE
    benchmark: str = "MSFT"
    start: date = date(2020, 1, 1)
    end: date = date(2025, 1, 1)

    outlier_low: float = -0.5
    outlier_high: float = 0.5
    clip_low: float = -0.15
    clip_high: float = 0.15

    short_window: int = 7
    long_window: int = 30
    rsi_window: int = 14
    band_window: int = 20
    band_width: float = 2.0
    volume_window: int = 20
    momentum_days: int = 14
    drawdown_window: int = 30
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    lags: tuple[int, ...] = (1, 5, 10)
    forward_days: int = 10
    trading_days: float = 252.0
    risk_free: float = 0.04

    clusters: int = 4
    cluster_restarts: int = 20
    cluster_iterations: int = 500
    sweep: tuple[int, ...] = (2, 3, 4, 5, 6, 7)
    sweep_restarts: int = 10
    silhouette_metric: str = "euclidean"

    test_share: float = 0.2
    folds: int = 5
    forest_trees: int = 500
    forest_depth: int = 6
    forest_min_leaf: int = 5
    boost_rounds: int = 300
    boost_rate: float = 0.01
    boost_depth: int = 3
    boost_sample: float = 0.8
    seed: int = 42
    # Partitions of every model fit. Samples are drawn per partition, so the number is part of
    # the model; it follows neither the cores nor the size of the table.
    fit_partitions: int = 64

    # Date patterns to try on text that is not ISO, in order.
    date_formats: tuple[str, ...] = ()
    # Rows left out between the training and the test part, in calendar days before the cut.
    gap_days: int = 0
    # Bars in the frames of the risk ratio and the market sensitivity; None is all history.
    trailing_window: int | None = None
    # Predictors other than the standard ones.
    model_columns: tuple[str, ...] | None = None

    @property
    def short_ma(self) -> str:
        return f"ma{self.short_window}"

    @property
    def long_ma(self) -> str:
        return f"ma{self.long_window}"

    @property
    def volume_ma(self) -> str:
        return f"volume_ma{self.volume_window}"

    @property
    def momentum(self) -> str:
        return f"momentum_{self.momentum_days}d"

    @property
    def drawdown(self) -> str:
        return f"drawdown_{self.drawdown_window}d"

    @property
    def predictors(self) -> tuple[str, ...]:
        """Predictor names in model order; the order and the plain names are fixed values."""
        return self.model_columns or (
            "daily_return", self.short_ma, self.long_ma, "ma_cross_signal", "ma_spread",
            "rsi", "rsi_binned", "bb_pct_b", self.momentum,
            "volatility", "sharpe_ratio", "beta", self.drawdown,
            "day_of_week",
            self.volume_ma, "volume_ratio",
            *self.lag_columns,
        )

    @property
    def lag_columns(self) -> tuple[str, ...]:
        return tuple(f"return_lag_{k}" for k in self.lags)

    @property
    def feature_columns(self) -> tuple[str, ...]:
        """The feature table's columns, in output order."""
        return (
            "ticker", "date", *PRICE_COLUMNS, "volume", "daily_return",
            self.short_ma, self.long_ma, "ma_cross_signal",
            "rsi", "bb_mid", "bb_upper", "bb_lower", "bb_pct_b",
            "volatility", "sharpe_ratio", "bench_return", "beta",
            self.momentum, self.drawdown, "day_of_week",
            "ma_spread", "rsi_binned", self.volume_ma, "volume_ratio",
            *self.lag_columns, "forward_return",
        )
