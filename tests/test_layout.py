"""Bar tables whose layout Spark knows, and the one pass that cleans and counts."""

import random

import pytest
from conftest import BAR_SCHEMA, day

from tickerloom.operators.cleaning import clean_bars
from tickerloom.operators.indicators import add_features
from tickerloom.operators.quality import clean_and_count, drop_report, judged_bars
from tickerloom.params import Params
from tickerloom.plans import pipeline
from tickerloom.sources import tables

PARAMS = Params(universe=None, benchmark="T0", outlier_low=-0.05, outlier_high=0.05)


@pytest.fixture(scope="module")
def raw(spark):
    """Bars with nulls in every required column, repeated keys and outliers."""
    rng = random.Random(5)
    rows = []
    for t in range(9):
        for d in range(60):
            price = 100 + rng.gauss(0, 3)
            close = None if rng.random() < 0.1 else price
            row = (f"T{t}", day(d), price, price, price, close, 5)
            rows += [row] * rng.choice([1, 1, 1, 3])
    rows += [(None, day(1), 1.0, 1.0, 1.0, 1.0, 1), ("T1", None, 1.0, 1.0, 1.0, 1.0, 1)]
    return spark.createDataFrame(rows, BAR_SCHEMA).repartition(5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_features_of_a_bucketed_table_shuffle_nothing(spark, raw, tmp_path):
    clean = clean_bars(raw, PARAMS)
    tables.write_bucketed(clean, str(tmp_path / "clean"), 6)
    written = tables.read_bucketed(spark, str(tmp_path / "clean"), clean.schema, 6)
    assert rows_of(written) == rows_of(clean)
    features = add_features(written, PARAMS)
    shuffles = [line for line in plan(features).splitlines() if "Exchange" in line]
    assert shuffles and all("BroadcastExchange" in line for line in shuffles)
    assert rows_of(features) == rows_of(add_features(clean, PARAMS))
    files = list((tmp_path / "clean").glob("part-*"))
    assert len(files) <= 6  # a bucket is one file


def test_another_session_reads_the_layout_from_the_files(spark, raw, tmp_path):
    clean = clean_bars(raw, PARAMS)
    path = str(tmp_path / "it's bucketed")
    tables.write_bucketed(clean, path, 3)
    spark.catalog.dropTempView("none")
    spark.sql(f"DROP TABLE {tables._catalog_name(path, 3)}")  # external: the files stay
    written = tables.read_bucketed(spark, path, clean.schema, 3)
    assert rows_of(written) == rows_of(clean)
    assert "Bucketed: true" in plan(written.groupBy("ticker").count())


def test_a_bucketed_table_is_replaced(spark, raw, tmp_path):
    clean, path = clean_bars(raw, PARAMS), str(tmp_path / "clean")
    tables.write_bucketed(clean, path, 4)
    fewer = clean.filter("ticker > 'T4'")
    tables.write_bucketed(fewer, path, 4)
    assert rows_of(tables.read_bucketed(spark, path, clean.schema, 4)) == rows_of(fewer)


def test_one_pass_cleans_and_counts(spark, raw, tmp_path):
    judged = judged_bars(raw, PARAMS, 4)
    shuffles = [line for line in plan(judged).splitlines() if "Exchange hash" in line]
    assert len(shuffles) == 2  # raw rows to keys, keys to tickers
    clean, removed = clean_and_count(raw, PARAMS, 4)
    for df in (clean, removed):  # both read what was written, and shuffle no bars
        assert "judged" in plan(df) and "Exchange hash" not in plan(df)
    assert rows_of(removed) == rows_of(drop_report(raw, PARAMS))
    found = removed.first()
    assert found.rows_in == raw.count() and found.outlier_rows > 0
    assert rows_of(clean) == rows_of(clean_bars(raw, PARAMS))
    tables.write_bucketed(clean, str(tmp_path / "clean"), 4)
    assert rows_of(spark.read.parquet(str(tmp_path / "clean"))) == rows_of(clean)


@pytest.mark.parametrize("by_ticker", [False, True])
def test_the_stage_writes_bars_and_counts(spark, raw, tmp_path, by_ticker):
    folder = pipeline.Folder(str(tmp_path))
    written = pipeline.transform_stage(raw, folder, PARAMS, buckets=3, by_ticker=by_ticker)
    assert rows_of(written) == rows_of(clean_bars(raw, PARAMS))
    removed = pipeline.read_removed(spark, folder).first()
    assert removed == drop_report(raw, PARAMS).first()
    features = pipeline.feature_stage(written, folder, PARAMS, 3, by_ticker=by_ticker)
    assert rows_of(features) == rows_of(add_features(written, PARAMS))


def test_an_empty_table_is_cleaned_and_counted(spark, raw, tmp_path):
    folder = pipeline.Folder(str(tmp_path))
    written = pipeline.transform_stage(raw.limit(0), folder, PARAMS, buckets=2)
    assert written.count() == 0
    assert tuple(pipeline.read_removed(spark, folder).first()) == (0, 0, 0, 0, 0)


def test_blanks_around_a_text_survive_csv(spark, tmp_path):
    table = spark.createDataFrame([(" A ", 1.0), ("B", 2.0)], "ticker string, x double")
    tables.write_csv(table, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), table.schema)
    assert rows_of(back) == rows_of(table)
