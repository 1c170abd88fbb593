"""What-if rows for the direction classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.params import Params


def fixed_values(params: Params) -> dict[str, float]:
    """Predictors a scenario does not choose, whatever the row holds."""
    return {
        params.short_ma: 150.0, params.long_ma: 150.0, "rsi": 50.0,
        params.volume_ma: 1_000_000.0,
    }


def start_values(params: Params) -> dict[str, float]:
    """Where every chosen predictor starts if the row has no value for it.

    day_of_week follows the training encoding (2.0 = Monday).
    """
    return {
        "daily_return": 0.0, "volatility": 0.25, "beta": 1.0, "day_of_week": 2.0,
        params.momentum: 0.0, params.drawdown: 0.0, "ma_spread": 0.0,
        "volume_ratio": 1.0, "sharpe_ratio": 0.8,
        **dict.fromkeys(params.lag_columns, 0.0),
        "rsi_binned": 1.0, "bb_pct_b": 0.5,
    }


def latest_rows(features: DataFrame) -> DataFrame:
    """Each ticker's last bar: the last dates by a hash aggregate, then the bars of those dates.

    The side that is joined back has one row per ticker; its measured size decides the join.
    """
    last = features.groupBy("ticker").agg(F.max("date").alias("date"))
    return features.join(last, ["ticker", "date"], "left_semi").select(*features.columns)


def scenario_rows(
    base: DataFrame, choices: Mapping[str, Sequence[float]], params: Params
) -> DataFrame:
    """Every base row under every combination of the choices, ready for scoring.

    ``choices`` lists the values to try per chosen predictor; other chosen predictors keep the
    row's own value, or their start value. The combinations come from exploding literal
    arrays, so the rows multiply in place without a join.
    """
    starts = start_values(params)
    unknown = set(choices) - set(starts)
    if unknown:
        raise ValueError(f"not adjustable in a scenario: {sorted(unknown)}")
    keys = [c for c in ("ticker", "date") if c in base.columns]
    out = base
    for name, start in starts.items():
        if name in choices:
            values = F.array(*[F.lit(float(v)) for v in choices[name]])
            out = out.withColumn(name, F.explode(values))
        elif name in base.columns:
            out = out.withColumn(name, F.coalesce(F.col(name).cast("double"), F.lit(start)))
        else:
            out = out.withColumn(name, F.lit(start))
    out = out.withColumns({name: F.lit(value) for name, value in fixed_values(params).items()})
    signal = F.when(F.col("ma_spread") > 0, 1.0).otherwise(-1.0)
    return out.withColumn("ma_cross_signal", signal).select(*keys, *params.predictors)
