"""Quality rules: text statistics, and robust multivariate outliers by group.

Base rules reject documents with few words or much repetition. Of the others, the statistics are
turned into a vector of four (log mean word length; square roots of the symbol, repeated-line and
repeated-word rates) and judged against the minimum-covariance-determinant estimate of their
language and source: the mean and covariance of the ``support`` share of rows closest to it,
found by concentration steps from coordinate-wise medians. A row farther than the chi-square
quantile of ``tail`` is rejected.

The squares of ``FLOOR_SCALE``, differences that do not matter in any group, are added to the
variances. So rates that are zero in most rows, and groups of few rows, need no case of their
own, and a group does not turn strict by being large. Each step is one
scan of the small statistics table and one aggregate that adds up in the map tasks.

Defined cases: a null text is empty (no words, fails the base rules); null languages and sources
are groups of their own; equal rows count as often as they occur; an empty table gives no rows;
other columns are ignored by ``quality_report`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerloom.llm.common import materialize, release_memory, text_column

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SUPPORT = 0.75
TAIL = 5e-6
STEPS = 12
FLOOR_SCALE = (0.10, 0.05, 0.15, 0.15)

FEATURES = ("x1", "x2", "x3", "x4")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- statistics of one text -----------------------------------------------------------------


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    codes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            codes = (codes + marks[k : k + n]) * _MIX
            codes ^= codes >> np.uint64(29)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return int((np.cumsum(steps) > 0).sum())


def repeated_lines(lines: list[str]) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    found = 0
    for line in lines:
        if line in seen:
            found += bool(line.encode().split())
        else:
            seen.add(line)
    return found


def statistics(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    words, lines = text.encode().split(), text.split("\n")
    return (
        len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
        repeated_lines(lines), repeated_words(words), len(lines),
    )


_COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _counts(texts: Column) -> Column:
    """The statistics of each text as a struct; nothing but the texts goes to Python."""

    @F.arrow_udf(f"struct<{', '.join(f'{name}: bigint' for name in _COUNTED)}>")
    def counted(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(t.as_py() or "") for t in texts], np.int64).reshape(-1, 6)
        release_memory()
        return pa.StructArray.from_arrays([pa.array(column) for column in rows.T], names=_COUNTED)

    # Else the optimizer may count once for a filter and once more for what it keeps.
    return counted.asNondeterministic()(texts).alias("_counted")


def text_statistics(docs: DataFrame, *keys: str) -> DataFrame:
    """One row per document: the statistics, and ``keys`` of the document (text to group by)."""
    chosen = [F.col(k).cast("string").alias(k) for k in keys]
    rows = docs.select(F.col("doc_id").cast("long"), _counts(text_column()), *chosen)
    return rows.select("doc_id", "_counted.*", *keys)


def base_failed() -> Column:
    """The base rules, on the statistics columns."""
    few = F.col("n_words") < MIN_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


# --- the robust estimate --------------------------------------------------------------------


def chi2_tail(x: float, dof: int) -> float:
    """P(chi-square > x) for an even number of degrees of freedom."""
    half = x / 2
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile(tail: float, dof: int) -> float:
    low, high = 0.0, 1.0
    while chi2_tail(high, dof) > tail:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, dof) > tail else (low, middle)
    return high


def _vectors(rows: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return rows.withColumns({
        "x1": F.log(chars / words),
        "x2": F.sqrt(F.col("n_symbols") / chars),
        "x3": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x4": F.sqrt(F.col("n_repeat_words") / words),
    })


def _distance() -> Column:
    """Squared Mahalanobis distance from ``center`` by the flat inverse ``inverse``."""
    d = len(FEATURES)
    gaps = [F.col(x) - F.col("center")[i] for i, x in enumerate(FEATURES)]
    terms = [
        gaps[i] * gaps[j] * F.col("inverse")[i * d + j] for i in range(d) for j in range(d)
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.greatest(total, F.lit(0.0))


def _same_group(rows: DataFrame, fit: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows with their group's estimate; null keys match. Small estimates are broadcast by
    Spark's own size check, larger ones joined by shuffle with skewed groups split."""
    renamed = fit.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = match[0]
    for other in match[1:]:
        condition = condition & other
    return rows.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])


def _estimates(moments: DataFrame, keys: tuple[str, ...], support: float) -> DataFrame:
    """Center and inverse covariance from n, the sums and the sums of products of a group."""
    d = len(FEATURES)
    cut = chi2_quantile(1 - support, d) if support < 1 else math.inf
    # Makes the covariance of the closest share of normal rows that of all of them.
    consistent = support / (1 - chi2_tail(cut, d + 2)) if support < 1 else 1.0
    floor = np.diag(np.square(FLOOR_SCALE))
    schema = "center array<double>, inverse array<double>, logdet double"

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():  # one row per group
                n = row["n"]
                center = np.array([row[f"s{i}"] for i in range(d)]) / n
                spread = np.empty((d, d))
                for i in range(d):
                    for j in range(i, d):
                        spread[i, j] = spread[j, i] = row[f"s{i}{j}"] / n - center[i] * center[j]
                whole = consistent * spread + floor
                inverse = np.linalg.inv(whole)
                found.append((center.tolist(), inverse.ravel().tolist(),
                              float(np.linalg.slogdet(whole)[1])))
            columns = list(zip(*found)) if found else [()] * 3
            kinds = (pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), *map(pa.array, columns, kinds)],
                [*keys, "center", "inverse", "logdet"],
            )

    named = ", ".join(f"{k} string" for k in keys)
    return moments.mapInArrow(solve, f"{named}, {schema}")


def _sums() -> list[Column]:
    d = len(FEATURES)
    one = [F.sum(FEATURES[i]).alias(f"s{i}") for i in range(d)]
    two = [
        F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}")
        for i in range(d) for j in range(i, d)
    ]
    return [F.count(F.lit(1)).alias("n"), *one, *two]


def _start(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Coordinate-wise medians with the floor's scales."""
    median = F.percentile_approx
    scales = (1 / np.square(FLOOR_SCALE)).tolist()
    d = len(FEATURES)
    flat = [F.lit(scales[i] if i == j else 0.0) for i in range(d) for j in range(d)]
    centers = [median(x, 0.5, F.lit(1000)) for x in FEATURES]
    return rows.groupBy(*keys).agg(
        F.array(*centers).alias("center"), F.array(*flat).alias("inverse"),
        F.lit(math.inf).alias("logdet"),
    )


def fit_groups(
    rows: DataFrame, keys: tuple[str, ...], support: float = SUPPORT, steps: int = STEPS
) -> DataFrame:
    """(keys, center, inverse, logdet) by concentration steps until no determinant falls.

    A step bins the distances finely on a log scale with the moments of each bin, takes the
    fewest closest bins that hold ``support`` of the group, and estimates anew from their sums.
    """
    fit = materialize(_start(rows, keys), "mcd")
    for _ in range(steps):
        near = _same_group(rows, fit, keys).withColumn(
            "_bin", F.floor(F.log2(_distance() + F.lit(2.0**-20)) * 8)
        )
        bins = near.groupBy(*keys, "_bin").agg(*_sums())
        upward = Window.partitionBy(*keys).orderBy("_bin")
        closer = F.sum("n").over(upward) - F.col("n")
        everyone = F.sum("n").over(Window.partitionBy(*keys))
        chosen = bins.withColumns({"_closer": closer, "_of": everyone}).filter(
            F.col("_closer") < F.col("_of") * F.lit(support)
        )
        parts = [F.sum(c).alias(c) for c in bins.columns if c not in (*keys, "_bin")]
        new = _estimates(chosen.groupBy(*keys).agg(*parts), keys, support)
        new = materialize(new, "mcd")
        before = _same_group(
            new.select(*keys, F.col("logdet").alias("now")), fit.select(*keys, "logdet"), keys
        )
        falls = before.agg(F.max(F.col("logdet") - F.col("now")).alias("by")).first()["by"]
        fit = new
        if falls is None or falls < 1e-6:
            break
    return fit


KEYS = ("lang", "source")


def _prepared(docs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Statistics, base verdict and vector of every document, written once."""
    measured = text_statistics(docs, *keys).withColumn("base_failed", base_failed())
    return materialize(_vectors(measured), "quality")


def _fit(table: DataFrame, keys: tuple[str, ...], support: float, steps: int) -> DataFrame:
    return fit_groups(table.filter(~F.col("base_failed")), keys, support, steps).drop("logdet")


def judge(
    table: DataFrame, fit: DataFrame, keys: tuple[str, ...] = KEYS, tail: float = TAIL
) -> DataFrame:
    """``table`` (statistics, base_failed and vector) plus distance2 and kept."""
    judged = _same_group(table, fit, keys)
    distance = F.when(~F.col("base_failed"), _distance())
    limit = chi2_quantile(tail, len(FEATURES))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= F.lit(limit))
    return judged.withColumns({"distance2": distance, "kept": kept}).drop("center", "inverse")


def quality_report(
    docs: DataFrame, keys: tuple[str, ...] = KEYS, support: float = SUPPORT, tail: float = TAIL,
    steps: int = STEPS,
) -> DataFrame:
    """doc_id, the counts, base_failed, distance2 and kept, one row per document."""
    table = _prepared(docs, keys)
    judged = judge(table, _fit(table, keys, support, steps), keys, tail)
    return judged.select("doc_id", *COUNTS, "base_failed", "distance2", "kept")


def keep_good(
    docs: DataFrame, keys: tuple[str, ...] = KEYS, support: float = SUPPORT, tail: float = TAIL,
    steps: int = STEPS,
) -> DataFrame:
    """The documents that pass, all columns. The estimates come from a first scan; the second
    measures and judges each row where it is read, so no text is shuffled or matched by id."""
    fit = _fit(_prepared(docs, keys), keys, support, steps)
    chosen = [F.col(k).cast("string").alias(k) for k in keys]
    nested = docs.select(F.struct("*").alias("row"), *chosen, _counts(text_column()))
    measured = nested.select("row", *keys, "_counted.*").withColumn("base_failed", base_failed())
    return judge(_vectors(measured), fit, keys, tail).filter("kept").select("row.*")
