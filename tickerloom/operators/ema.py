"""Recursive exponential averages and MACD as window expressions.

With ``q = 1 - 2 / (span + 1)`` the first value seeds the average, and a value ``g`` bars after
the last one enters as ``y = a y_before + (1 - a) x`` with ``a = q^g / (q^g + 1 - q)``, which is
``q`` when no bar between lacks a value. Bars without a value keep the last average.

With ``D = -ln a`` summed up to ``C``, the closed form is ``y_t = sum_j c_j x_j exp(C_j - C_t)``
with ``c_0 = 1`` and ``c_j = 1 - a_j`` after. Over a whole history ``exp(C)`` would overflow, so a
ticker's bars are cut into blocks by ``C`` itself: block ``b`` holds ``C`` from ``b`` to ``b + 1``
times ``BLOCK``. Inside a block the sum is an ordinary running window of exponents below ``BLOCK``;
the block before enters through its sum; what is older weighs less than ``exp(-BLOCK)``, nothing.

Every window is over (ticker) or (ticker, block). One hash partitioning on ticker serves them all,
and each average costs one Sort, because a ticker's blocks are in date order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.windows import ordered
from tickerloom.params import Params

# exp(BLOCK) leaves room for values and sums below the largest double.
BLOCK = 500.0

_POS = "_ema_pos"


def _decay(span: int) -> float:
    """-ln q; infinite for span 1, where the average is the value itself."""
    keep = 1.0 - 2.0 / (span + 1.0)
    return math.inf if keep == 0.0 else -math.log(keep)


def _positions(bars: DataFrame) -> DataFrame:
    return bars.withColumn(_POS, F.row_number().over(ordered()))


def _average(
    numbered: DataFrame, values: dict[str, Column], spans: dict[str, int], order: list[str]
) -> tuple[DataFrame, list[str]]:
    """Add one average per name; ``values`` gives its input, ``spans`` its span.

    ``order``: columns that put a ticker's rows in date order, as they lie now; returned anew.
    """
    own = Window.partitionBy("ticker").orderBy(*order)
    running = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    inputs, since, damping, summed, result = {}, {}, {}, {}, {}
    for name, span in spans.items():
        here, rate, alpha = F.col(f"_{name}_x").isNotNull(), _decay(span), 2.0 / (span + 1.0)
        inputs[f"_{name}_x"] = values[name].cast("double")
        if rate == math.inf:
            result[name] = F.last(f"_{name}_x", ignorenulls=True).over(running)
            continue
        last = F.last(F.when(here, F.col(_POS)), ignorenulls=True).over(before)
        since[f"_{name}_from"] = last
        gap = (F.col(_POS) - F.col(f"_{name}_from")) * F.lit(rate)
        step = gap + F.log(F.lit(alpha) + F.exp(-gap))
        damping[f"_{name}_d"] = F.coalesce(F.when(here, step), F.lit(0.0))
        summed[f"_{name}_c"] = F.sum(f"_{name}_d").over(running)
    out = numbered
    for layer in (inputs, since, damping, summed, result):
        out = out.withColumns(layer) if layer else out

    for name in [n for n in spans if n not in result]:
        block, total = f"_{name}_block", F.col(f"_{name}_c")
        here = F.col(f"_{name}_x").isNotNull()
        first = here & F.col(f"_{name}_from").isNull()
        weight = F.when(first, 1.0).otherwise(-F.expm1(-F.col(f"_{name}_d")))
        base = F.col(block) * F.lit(BLOCK)
        out = out.withColumn(block, F.floor(total / F.lit(BLOCK)).cast("int")).withColumn(
            f"_{name}_term", F.when(here, F.col(f"_{name}_x") * weight * F.exp(total - base))
        )
        in_block = Window.partitionBy("ticker", block).orderBy("date")
        blocks = Window.partitionBy("ticker").orderBy(block)
        order = [block, "date"]
        by_date = Window.partitionBy("ticker").orderBy(*order)
        ahead = (Window.unboundedPreceding, Window.currentRow)
        inside = F.sum(f"_{name}_term").over(in_block.rowsBetween(*ahead))
        out = out.withColumn(f"_{name}_in", inside)
        # Reading the first sum here keeps this window above it, and so on the same Sort.
        term = F.when(F.col(f"_{name}_in").isNotNull(), F.col(f"_{name}_term"))
        carried = F.sum(term).over(blocks.rangeBetween(-1, -1))
        older = F.coalesce(carried * F.exp(base - F.lit(BLOCK) - total), F.lit(0.0))
        local = F.col(f"_{name}_in") * F.exp(base - total)
        out = out.withColumn(f"_{name}_y", F.when(here, local + older)).withColumn(
            name, F.last(f"_{name}_y", ignorenulls=True).over(by_date.rowsBetween(*ahead))
        )
    kept = {*numbered.columns, *spans, order[0]}
    return out.drop(*[c for c in out.columns if c not in kept]), order


def add_emas(bars: DataFrame, value: str, spans: dict[str, int]) -> DataFrame:
    """Add exponential averages of ``value`` per ticker in date order: name -> span."""
    values = dict.fromkeys(spans, F.col(value))
    out, order = _average(_positions(bars), values, spans, ["date"])
    return out.drop(_POS, *[c for c in order if c != "date"])


def add_macd(bars: DataFrame, params: Params) -> DataFrame:
    """Add ``macd`` (fast - slow average), its signal average, and their difference."""
    spans = {"_fast": params.macd_fast, "_slow": params.macd_slow}
    close = dict.fromkeys(spans, F.col("close"))
    lines, order = _average(_positions(bars), close, spans, ["date"])
    lines = lines.withColumn("macd", F.col("_fast") - F.col("_slow")).drop(*spans)
    signal = {"macd_signal_line": params.macd_signal}
    lines, last = _average(lines, {"macd_signal_line": F.col("macd")}, signal, order)
    lines = lines.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal_line"))
    return lines.drop(_POS, *[c for c in {*order, *last} if c != "date"])
