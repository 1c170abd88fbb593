"""Window specs over one instrument's bars.

Bars are unique per (ticker, date) once deduplicated and ``date`` is a DATE, so a ticker's
window partition holds at most one row per calendar day -- about 36,500 rows per century --
however many raw rows the ticker had. That bound, not an assumption about the data, is what
makes a per-ticker window safe for a hot ticker: the hot rows are folded by the partial
aggregation in ``dedupe_bars`` / ``bars_from_trades`` before any window sees them.

All specs share one partitioning and ordering, so Catalyst evaluates any number of frames in
one Window node behind one Exchange and one Sort.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql.window import WindowSpec


def ordered() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("date")


def trailing(rows: int) -> WindowSpec:
    """The current bar and the ``rows - 1`` bars before it (fewer at the start)."""
    return ordered().rowsBetween(1 - rows, Window.currentRow)


def whole_history() -> WindowSpec:
    """Every bar of the ticker; ordered, so that it shares the Sort of the other frames."""
    return ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
