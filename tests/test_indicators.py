import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import day

from tickerloom.functions import indicators as ind
from tickerloom.operators.benchmark import require_benchmark, with_benchmark
from tickerloom.operators.cleaning import add_daily_return
from tickerloom.operators.ema import add_emas, add_macd
from tickerloom.operators.indicators import add_features, with_indicators
from tickerloom.operators.side_features import add_side_features
from tickerloom.params import Params


def walk(n, seed=0, start=100.0):
    rng = random.Random(seed)
    out = [start]
    for _ in range(n - 1):
        out.append(out[-1] * (1 + rng.uniform(-0.05, 0.05)))
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_moving_averages_allow_partial_frames(make_bars, column, params):
    bars = make_bars({"AAA": [float(i) for i in range(1, 41)]})
    out = with_indicators(bars, params, ind.moving_averages, ind.cross_signal)
    assert column(out, "ma7")[:3] == [1.0, 1.5, 2.0]
    assert column(out, "ma7")[39] == 37.0
    assert column(out, "ma30")[39] == 25.5
    assert column(out, "ma_cross_signal")[:8] == [-1.0] * 7 + [1.0]


def test_full_window_averages_wait_for_the_frame(make_bars, column, params):
    out = with_indicators(
        make_bars({"AAA": [2.0] * 31}), params, ind.full_window_averages
    )
    assert column(out, "ma7") == [None] * 6 + [2.0] * 25
    assert column(out, "ma30") == [None] * 29 + [2.0] * 2


@pytest.mark.parametrize(
    ("closes", "expected"),
    [([5.0] * 20, 0.0), ([1.1**i for i in range(20)], 100.0), ([0.9**i for i in range(20)], 0.0)],
)
def test_rsi_edges(make_bars, column, params, closes, expected):
    bars = add_daily_return(make_bars({"AAA": closes}))
    values = column(with_indicators(bars, params, ind.rsi, ind.rsi_state), "rsi")
    assert values[0] == 0.0
    assert abs(values[-1] - expected) < 1e-6


def test_rsi_matches_simple_means(make_bars, column, params):
    closes = walk(60)
    bars = add_daily_return(make_bars({"AAA": closes}))
    out = with_indicators(bars, params, ind.rsi, ind.rsi_state)
    r = pd.Series(closes).pct_change()
    up = r.clip(lower=0).fillna(0).rolling(14, min_periods=1).mean()
    down = (-r).clip(lower=0).fillna(0).rolling(14, min_periods=1).mean()
    expected = 100 - 100 / (1 + up / (down + 1e-10))
    assert np.allclose(column(out, "rsi"), expected)
    states = np.where(expected < 30, 0.0, np.where(expected > 70, 2.0, 1.0))
    assert column(out, "rsi_binned") == states.tolist()


def test_bands_first_bar_and_flat_price(make_bars, column, params):
    out = with_indicators(make_bars({"AAA": [4.0] * 25}), params, ind.bands)
    assert column(out, "bb_mid")[0] == 4.0
    assert column(out, "bb_upper")[0] is None and column(out, "bb_pct_b")[0] is None
    assert column(out, "bb_pct_b")[1:] == [0.0] * 24


def test_volatility_needs_two_returns(make_bars, column, params):
    closes = walk(40)
    out = with_indicators(add_daily_return(make_bars({"AAA": closes})), params, ind.volatility)
    values = column(out, "volatility")
    assert values[:2] == [None, None]
    r = pd.Series(closes).pct_change()
    expected = r.rolling(30, min_periods=2).std() * math.sqrt(252)
    assert np.allclose(values[2:], expected[2:])


def test_momentum_drawdown_lags_and_forward(make_bars, column, params):
    closes = walk(50, seed=3)
    bars = add_daily_return(make_bars({"AAA": closes}))
    out = with_indicators(
        bars, params, ind.momentum, ind.drawdown, ind.lagged_returns, ind.forward_return
    ).cache()
    s = pd.Series(closes)
    assert column(out, "momentum_14d")[:14] == [None] * 14
    assert np.allclose(column(out, "momentum_14d")[14:], (s / s.shift(14) - 1)[14:])
    assert np.allclose(column(out, "drawdown_30d"), s / s.rolling(30, min_periods=1).max() - 1)
    assert max(column(out, "drawdown_30d")) <= 0.0
    assert column(out, "return_lag_1")[:2] == [None, None]
    assert column(out, "return_lag_10")[:11] == [None] * 11
    assert column(out, "forward_return")[-10:] == [None] * 10
    assert np.allclose(column(out, "forward_return")[:40], (s.shift(-10) / s - 1)[:40])


def test_forward_return_after_zero_close_is_null(make_bars, column, params):
    out = with_indicators(make_bars({"AAA": [0.0] + [1.0] * 12}), params, ind.forward_return)
    assert column(out, "forward_return")[0] is None


def test_volume_ratio_with_and_without_epsilon(make_bars, column, params):
    bars = make_bars({"AAA": [1.0, 1.0, 1.0]}, {"AAA": [0, 0, 30]})
    soft = with_indicators(bars, params, ind.volume)
    plain = with_indicators(bars, params, ind.plain_volume)
    assert column(soft, "volume_ratio")[:2] == [0.0, 0.0]
    assert column(plain, "volume_ratio") == [None, None, 3.0]


def test_weekday_counts_from_sunday(make_bars, column, params):
    out = with_indicators(make_bars({"AAA": [1.0] * 7}), params, ind.weekday)
    assert column(out, "day_of_week") == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 1.0]


def test_sharpe_and_beta_against_numpy(make_bars, column, params):
    bench, other = walk(30, seed=5), walk(33, seed=6)
    clean = add_daily_return(make_bars({"AAA": bench, "BBB": other}))
    out = with_indicators(with_benchmark(clean, params), params, ind.sharpe, ind.beta).cache()
    rb, ro = pd.Series(bench).pct_change(), pd.Series(other).pct_change()
    sharpe = (ro.mean() * 252 - 0.04) / (ro.std() * math.sqrt(252) + 1e-10)
    assert np.allclose(column(out, "sharpe_ratio", "BBB"), [sharpe] * 33)
    both = pd.DataFrame({"b": rb, "o": ro})
    beta = both.dropna().cov().loc["o", "b"] / (rb.var() + 1e-10)
    assert np.allclose(column(out, "beta", "BBB"), [beta] * 33)
    assert abs(column(out, "beta")[0] - 1.0) < 1e-6
    assert column(out, "bench_return", "BBB")[-3:] == [None] * 3


def test_beta_variance_counts_days_without_own_return(spark, make_bars, column, params):
    bench = walk(12, seed=8)
    bars = make_bars({"AAA": bench, "BBB": walk(12, seed=9)})
    late = bars.filter((bars.ticker == "AAA") | (bars.date >= day(4)))
    clean = add_daily_return(late)
    out = with_indicators(with_benchmark(clean, params), params, ind.beta)
    rb = pd.Series(bench).pct_change()
    ro = pd.Series(walk(12, seed=9)[4:], index=range(4, 12)).pct_change()
    pair = pd.DataFrame({"b": rb, "o": ro}).dropna()
    expected = pair.cov().loc["o", "b"] / (rb[4:].var() + 1e-10)
    assert np.allclose(column(out, "beta", "BBB"), expected)


def test_missing_benchmark_is_an_error(make_bars):
    clean = add_daily_return(make_bars({"AAA": [1.0, 2.0]}))
    with pytest.raises(ValueError, match="ZZZ"):
        require_benchmark(clean, Params(benchmark="ZZZ"))


def test_features_schema_counts_and_bounds(make_bars, params):
    clean = add_daily_return(make_bars({"AAA": walk(80), "BBB": walk(60, 1), "CCC": walk(5, 2)}))
    out = add_features(clean, params)
    assert tuple(out.columns) == params.feature_columns and len(out.columns) == 31
    rows = out.collect()
    assert len(rows) == 145
    for r in rows:
        assert 0 <= r.rsi <= 100 and r.drawdown_30d <= 0
        if r.bb_lower is not None:
            assert r.bb_lower <= r.bb_mid <= r.bb_upper


def test_features_do_not_depend_on_layout(spark, make_bars, params):
    clean = add_daily_return(make_bars({"AAA": walk(50), "BBB": walk(50, 1), "CCC": walk(45, 2)}))
    results = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "4", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            shuffled = clean.repartition(int(partitions))
            results.add(tuple(sorted(map(str, add_features(shuffled, params).collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(results) == 1


def test_feature_plan_has_one_exchange_one_sort_and_no_python(make_bars, params, tmp_path, spark):
    path = str(tmp_path / "clean")
    add_daily_return(make_bars({"AAA": walk(40), "BBB": walk(40, 1)})).write.parquet(path)
    plan = plan_of(add_features(spark.read.parquet(path), params))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,AAA)" in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_macd_plan_has_one_exchange_and_a_sort_per_average(make_bars, params):
    plan = plan_of(add_macd(make_bars({"AAA": walk(40)}), params))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 4


@pytest.mark.parametrize("spans", [(12, 26, 9), (1, 2, 3), (2, 900), (5,), (1,), (200, 2000)])
def test_ema_equals_the_recursion(spark, make_bars, spans):
    closes = {"AAA": walk(3000, 1), "BBB": walk(700, 2), "CCC": [7.0]}
    named = {f"e{s}": s for s in spans}
    out = add_emas(make_bars(closes), "close", named).toPandas().sort_values(["ticker", "date"])
    assert not {c for c in out.columns if c.startswith("_")}
    for ticker, series in closes.items():
        mine = out[out.ticker == ticker]
        for name, span in named.items():
            expected = pd.Series(series).ewm(span=span, adjust=False).mean()
            assert np.allclose(mine[name], expected, rtol=1e-11, atol=1e-11)


def test_macd_equals_the_recursion(make_bars, params):
    closes = walk(2500, 4)
    out = add_macd(make_bars({"AAA": closes}), params).toPandas().sort_values("date")
    s = pd.Series(closes)
    line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    assert np.allclose(out.macd, line, atol=1e-9)
    assert np.allclose(out.macd_signal_line, signal, atol=1e-9)
    assert np.allclose(out.macd_histogram, line - signal, atol=1e-9)


def test_side_features_drop_the_warm_up(make_bars, column, params):
    bars = add_daily_return(make_bars({"AAA": walk(40, 7), "BBB": walk(11, 8)}))
    out = add_side_features(bars, params)
    assert out.filter("ticker = 'AAA'").count() == 29
    assert out.filter("ticker = 'BBB'").count() == 0
    assert not [r for r in out.collect() if None in tuple(r)]


def gapped(seed, n, share):
    rng = np.random.default_rng(seed)
    values = 100 + np.cumsum(rng.normal(size=n))
    values[rng.random(n) < share] = np.nan
    return values


@pytest.mark.parametrize("case", ["lead", "holes", "tail", "long gap", "none", "sparse"])
@pytest.mark.parametrize("spans", [(9, 12, 26), (2, 200), (1, 3)])
def test_ema_weighs_gaps_like_the_recursion(spark, case, spans):
    values = {
        "lead": np.concatenate([np.full(700, np.nan), gapped(1, 900, 0.0)]),
        "holes": gapped(2, 1500, 0.3),
        "tail": np.concatenate([gapped(3, 40, 0.1), np.full(1200, np.nan)]),
        "long gap": np.concatenate([gapped(4, 90, 0.1), np.full(2900, np.nan), gapped(5, 90, 0.0)]),
        "none": np.full(30, np.nan),
        "sparse": np.where(np.arange(2500) % 211 == 3, gapped(6, 2500, 0.0), np.nan),
    }[case]
    rows = [("A", day(k), None if np.isnan(v) else float(v)) for k, v in enumerate(values)]
    table = spark.createDataFrame(rows, "ticker string, date date, x double")
    out = add_emas(table, "x", {f"e{s}": s for s in spans}).toPandas().sort_values("date")
    for span in spans:
        expected = pd.Series(values).ewm(span=span, adjust=False).mean().to_numpy()
        found = out[f"e{span}"].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(expected), np.isnan(found))
        assert np.allclose(expected, found, rtol=1e-9, atol=1e-9, equal_nan=True)


def test_ema_of_the_documented_example(spark):
    values = [None, 10.0, 12.0, None, 11.0, 13.0]
    table = spark.createDataFrame(
        [("A", day(k), v) for k, v in enumerate(values)], "ticker string, date date, x double"
    )
    rows = add_emas(table, "x", {"e": 9}).orderBy("date").collect()
    assert [r.e and round(r.e, 2) for r in rows] == [None, 10.0, 10.4, 10.4, 10.54, 11.03]
