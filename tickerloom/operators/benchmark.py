"""Put the benchmark's return of the day next to every bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.params import Params


def benchmark_returns(clean: DataFrame, params: Params) -> DataFrame:
    """One row per date: (date, bench_return).

    The ticker filter reaches the scan (it only uses the window's partition key), so this
    branch reads the benchmark's bars and nothing else.
    """
    return clean.filter(F.col("ticker") == params.benchmark).select(
        "date", F.col("daily_return").alias("bench_return")
    )


def with_benchmark(clean: DataFrame, params: Params) -> DataFrame:
    """Left join on date; days without a benchmark bar get null.

    The broadcast side holds one row per calendar day (bars are unique per ticker and date),
    so its size does not grow with the universe or with the raw rows.
    """
    return clean.join(F.broadcast(benchmark_returns(clean, params)), "date", "left").select(
        *clean.columns, "bench_return"
    )


def require_benchmark(clean: DataFrame, params: Params) -> None:
    """Raise if the benchmark has no bars: beta, and with it every model row, would be null."""
    if clean.filter(F.col("ticker") == params.benchmark).isEmpty():
        raise ValueError(f"benchmark ticker {params.benchmark!r} has no bars")
