import datetime as dt
import random

from conftest import BAR_SCHEMA, day
from pyspark.sql import functions as F

from tickerloom.operators import cleaning as cl
from tickerloom.operators import quality
from tickerloom.operators.side_features import winsorized_bars
from tickerloom.params import Params


def test_intraday_bars_fold_to_one_a_day(spark):
    rows = [("A", f"2024-01-0{1 + i // 2} {9 + i}:00:00", 1.0, 1.0, 1.0, float(i), 5) for i in range(4)]
    text = spark.createDataFrame(
        rows, "ticker string, date string, open double, high double, low double, close double, "
        "volume bigint",
    )
    stamped = text.withColumn("date", F.to_timestamp("date"))
    clean = cl.clean_bars(stamped, Params(universe=None, outlier_low=-9.0, outlier_high=9.0))
    assert dict(clean.dtypes)["date"] == "date"
    assert sorted((str(r.date), r.close) for r in clean.collect()) == [
        ("2024-01-01", 0.0), ("2024-01-02", 2.0)
    ]


def test_cast_numerics_turns_bad_text_into_null(spark):
    raw = spark.createDataFrame(
        [("1.5", " 2 ", "abc", "NaN", "12.7"), ("1e2", "", None, "3", "9007199254740993")],
        "open string, high string, low string, close string, volume string",
    )
    first, second = cl.cast_numerics(raw).collect()
    assert tuple(first) == (1.5, 2.0, None, None, 12)
    assert tuple(second) == (100.0, None, None, 3.0, 9007199254740993)


def test_drop_nulls_needs_key_and_close(spark):
    rows = [
        ("A", day(0), 1.0, 1.0, 1.0, 1.0, 1),
        (None, day(0), 1.0, 1.0, 1.0, 1.0, 1),
        ("A", None, 1.0, 1.0, 1.0, 1.0, 1),
        ("A", day(1), 1.0, 1.0, 1.0, None, 1),
        ("A", day(2), 1.0, 1.0, 1.0, float("nan"), 1),
        ("A", day(3), None, None, None, 1.0, None),
    ]
    kept = cl.drop_nulls(spark.createDataFrame(rows, BAR_SCHEMA)).collect()
    assert sorted(r.date for r in kept) == [day(0), day(3)]


def test_dedupe_survivor_does_not_depend_on_row_order(spark):
    rows = [("A", day(0), float(i % 7 + 1), 9.0, 1.0, float(i), i) for i in range(50)]
    rows += [("A", day(1), None, 9.0, 1.0, 5.0, 1), ("A", day(1), 2.0, 9.0, 1.0, 4.0, 1)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        raw = spark.createDataFrame(rows, BAR_SCHEMA).repartition(seed + 1)
        results.add(tuple(sorted(map(tuple, cl.dedupe_bars(raw).collect()))[:2]))
    assert len(results) == 1
    by_day = {r[1]: r for r in results.pop()}
    assert by_day[day(0)][2:] == (1.0, 9.0, 1.0, 0.0, 0)
    assert by_day[day(1)][2] is None


def test_dedupe_folds_a_hot_key_before_the_shuffle(spark):
    hot = spark.range(200_000).select(
        F.lit("A").alias("ticker"), F.lit(day(0)).alias("date"),
        *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("id").alias("volume"),
    )
    plan = cl.dedupe_bars(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert cl.dedupe_bars(hot).first().close == 0.0


def test_daily_return_first_bar_and_zero_close(make_bars, column):
    bars = cl.add_daily_return(make_bars({"AAA": [0.0, 10.0, 11.0], "BBB": [5.0]}))
    assert column(bars, "daily_return") == [None, None, (11.0 - 10.0) / 10.0]
    assert column(bars, "daily_return", "BBB") == [None]


def test_outliers_keep_limits_and_nulls(make_bars, column):
    bars = cl.add_daily_return(make_bars({"AAA": [10.0, 15.0, 7.5, 7.4, 20.0]}))
    kept = cl.drop_outliers(bars, Params())
    assert column(kept, "close") == [10.0, 15.0, 7.5, 7.4]


def test_winsorize_clips_and_drops_the_first_bar(make_bars, column):
    bars = cl.add_daily_return(make_bars({"AAA": [100.0, 140.0, 70.0, 71.0]}))
    returns = column(winsorized_bars(bars, Params()), "daily_return")
    assert returns == [0.15, -0.15, (71.0 - 70.0) / 70.0]


def test_universe_list_and_table_agree(spark, make_bars):
    bars = make_bars({"AAA": [1.0], "BBB": [2.0], "CCC": [3.0]})
    table = spark.createDataFrame([("AAA",), ("CCC",), ("AAA",)], "ticker string")
    by_list = cl.in_universe(bars, ("AAA", "CCC"))
    by_table = cl.in_universe(bars, table)
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_table.collect()))
    assert cl.in_universe(bars, None).count() == 3


def test_date_range_includes_both_ends(make_bars):
    bars = make_bars({"AAA": [1.0] * 10})
    kept = cl.in_date_range(bars, Params(start=day(2), end=day(5)))
    assert sorted(r.date for r in kept.collect()) == [day(2), day(3), day(4), day(5)]


def test_drop_report_equals_stepwise_counts(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(2000):
        ticker = rng.choice(["A", "B", "C", None])
        when = rng.choice([None, *[day(n) for n in range(60)]])
        close = rng.choice([None, 0.0, 10.0, 11.0, 14.0, 25.0])
        rows.append((ticker, when, 1.0, 1.0, 1.0, close, rng.randrange(9)))
    raw = spark.createDataFrame(rows, BAR_SCHEMA)
    params = Params()
    typed = cl.drop_nulls(cl.cast_numerics(raw))
    unique = cl.dedupe_bars(typed)
    clean = cl.drop_outliers(cl.add_daily_return(unique), params)
    counts = [raw.count(), typed.count(), unique.count(), clean.count()]
    report = quality.drop_report(raw, params).first()
    assert report.rows_in == counts[0]
    assert report.null_rows == counts[0] - counts[1]
    assert report.duplicate_rows == counts[1] - counts[2]
    assert report.outlier_rows == counts[2] - counts[3]
    assert report.rows_out == counts[3]


def test_audit_counts_faults(spark):
    schema = BAR_SCHEMA + ", daily_return double"
    rows = [
        ("A", day(0), 1.0, 2.0, 1.0, 1.5, 10, None),
        ("A", day(0), 1.0, 2.0, 1.0, 1.5, 0, 0.1),
        ("B", day(1), 1.0, 1.0, 2.0, 1.5, 10, 0.3),
        ("B", day(2), 1.0, 2.0, 1.0, 2.5, None, -0.1),
        ("B", day(3), 1.0, 2.0, 1.0, 0.5, 5, 0.1),
    ]
    row = quality.audit(spark.createDataFrame(rows, schema)).first()
    assert (row.row_count, row.tickers, row.null_cells) == (5, 2, 2)
    assert (row.first_date, row.last_date) == (day(0), day(3))
    assert (row.duplicate_keys, row.bad_ohlc_rows, row.zero_volume_rows) == (1, 3, 1)
    assert abs(row.return_mean - 0.1) < 1e-12 and row.return_min == -0.1
    listed = quality.audit_tickers(spark.createDataFrame(rows, schema)).collect()
    assert {r.ticker: r.row_count for r in listed} == {"A": 2, "B": 3}


def test_load_report(make_bars):
    bars = cl.add_daily_return(make_bars({"AAA": [100.0, 140.0, 141.0], "BBB": [5.0]}))
    row = quality.load_report(bars, Params()).first()
    assert (row.null_returns, row.clipped_returns, row.row_count, row.tickers) == (2, 1, 2, 1)
    assert isinstance(row.first_date, dt.date)


def test_preview_is_ordered(make_bars):
    rows = cl.preview(make_bars({"BBB": [1.0, 2.0], "AAA": [3.0, 4.0]}), 3).collect()
    assert [(r.ticker, r.date) for r in rows] == [("AAA", day(0)), ("AAA", day(1)), ("BBB", day(0))]
