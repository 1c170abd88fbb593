"""

Every query reads the given tables. Daily bars come from line items priced through their part
(ticker = brand); queries that read them in several branches write them to the shared folder
once. Doubles are rounded to 6 places and dates shown as ISO text, in both engines alike.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from dataclasses import replace
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from tickerloom.functions import indicators as ind
from tickerloom.operators import classify, clustering, metrics, profile, quality, scenarios, splits
from tickerloom.operators import cleaning as cl
from tickerloom.operators.benchmark import with_benchmark
from tickerloom.operators.ema import add_emas, add_macd
from tickerloom.operators.indicators import add_features, with_indicators
from tickerloom.operators.side_features import add_side_features, winsorized_bars
from tickerloom.operators.silhouette import silhouette_exact, silhouette_squared
from tickerloom.params import BAR_COLUMNS, Params
from tickerloom.plans import pipeline
from tickerloom.sources import raw as rawio
from tickerloom.sources import tables
from tickerloom.sources.storage import materialize, scratch_path
from tickerloom.sources.trades import bars_from_trades, read_trades

try:
    from tickerloom.llm import registry as text_registry
except ImportError:  # the only place that may do without the subpackage
    text_registry = None

# Query-sized models: the library's defaults are 500 trees, 300 rounds and 20 restarts.
PARAMS = Params(
    universe=None, benchmark="Brand#1",
    cluster_restarts=3, sweep_restarts=2, forest_trees=20, boost_rounds=10, boost_rate=0.1,
    fit_partitions=8, date_formats=("MM/dd/yyyy",),
)
TIGHT = replace(PARAMS, outlier_low=-0.12, outlier_high=0.12)
FIVE_YEARS = replace(
    PARAMS, start=date(1995, 1, 1), end=date(1999, 12, 31),
    universe=("BRAND#1", "BRAND#3", "BRAND#7", "BRAND#12", "BRAND#21"),
)
SCENARIO_CHOICES = {"momentum_14d": (-0.1, 0.0, 0.1), "rsi_binned": (0.0, 1.0, 2.0)}
# For models with a truth: labels follow a rule on two of three predictors (``_planted``).
PLANTED = replace(
    PARAMS, forest_trees=40, forest_min_leaf=1, boost_rounds=20, boost_rate=0.5,
    model_columns=("ma_cross_signal", "day_of_week", "return_lag_10"),
)
PLANTED_CHOICES = {"day_of_week": (2.0, 4.0, 6.0), "return_lag_10": (-0.05, 0.0, 0.05)}
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs ---------------------------------------------------------------------------------


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars_from_trades(read_trades(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    """Clean bars; the derivation already yields typed rows, unique per key, without nulls."""
    return _bars(spark, sf).transform(cl.add_daily_return).transform(cl.drop_outliers, PARAMS)


def _clean_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(_clean(spark, sf), "clean")


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return add_features(_clean_table(spark, sf), PARAMS)


def _trade_bars(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per trade, so a key repeats; close is null for every 97th order."""
    price = F.col("price")
    close = F.when(F.col("l_orderkey") % 97 != 0, price)
    return read_trades(spark, sf).select(
        "date", "ticker", price.alias("open"), price.alias("high"), price.alias("low"),
        close.alias("close"), F.col("quantity").cast("bigint").alias("volume"),
    )


def _text_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The same as text, with unparsable dates, prices and volumes."""
    key, price = F.col("l_orderkey"), F.col("price").cast("string")
    return read_trades(spark, sf).select(
        F.when(key % 103 == 0, "not a date").otherwise(F.col("date").cast("string")).alias("date"),
        F.concat(F.lit(" "), F.lower("ticker"), F.lit(" ")).alias("ticker"),
        F.when(key % 101 == 0, "abc").otherwise(price).alias("open"),
        price.alias("high"), price.alias("low"),
        F.when(key % 97 == 0, "").otherwise(price).alias("close"),
        F.when(key % 107 == 0, "n/a").otherwise(F.col("quantity").cast("string")).alias("volume"),
    )


def _dated_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The text bars with every third date month first, and some dates blank or unreadable."""
    key = F.col("l_orderkey")
    date = (
        F.when(key % 109 == 0, "  ").when(key % 103 == 0, "13/45/2021")
        .when(key % 3 == 0, F.date_format("date", "MM/dd/yyyy"))
        .otherwise(F.col("date").cast("string"))
    )
    price = F.col("price").cast("string")
    return read_trades(spark, sf).select(
        date.alias("date"), "ticker", price.alias("open"), price.alias("high"),
        price.alias("low"), price.alias("close"), F.col("quantity").cast("string").alias("volume"),
    )


def _audit_input(spark: SparkSession, sf: str) -> DataFrame:
    """Clean bars with planted faults: swapped highs, idle days, repeated days."""
    clean = _clean(spark, sf)
    day = F.dayofmonth("date")
    faulty = clean.withColumns({
        "high": F.when(day == 13, F.col("low")).otherwise(F.col("high")),
        "low": F.when(day == 13, F.col("high")).otherwise(F.col("low")),
        "volume": F.when(day == 29, 0).otherwise(F.col("volume")),
    })
    copies = F.when(F.dayofmonth("date") == 7, 2).otherwise(1)
    return faulty.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.ticker_profile(_features(spark, sf), PARAMS)


def _ruled_profile(spark: SparkSession, sf: str, clusters: int) -> DataFrame:
    """Profiles with a cluster id made by rule: the brand number modulo ``clusters``."""
    number = F.regexp_extract("ticker", r"(\d+)$", 1).cast("int")
    return _profile(spark, sf).withColumn("cluster_id", number % clusters)


def _ml_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(splits.ml_rows(_features(spark, sf), PARAMS), "ml-rows")


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.walk_forward(_ml_table(spark, sf), PARAMS)


def _split_table(spark: SparkSession, sf: str) -> DataFrame:
    """Written once, so that filters on ``is_test`` reach the scan, not the cut's subquery."""
    return materialize(_split(spark, sf), "split-rows")


def _ruled_scores(rows: DataFrame) -> DataFrame:
    """Predictions made by rule: up after a low RSI."""
    return rows.withColumn("prediction", (F.col("rsi") < 50).cast("int"))


def _train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return classify.split_rows(splits.ml_rows(_features(spark, sf), PARAMS), PARAMS)


# Planted truth: the given bars' features, with profiles in four groups by the brand number and
# a forward return whose sign follows a rule on two predictors. SQL states what models must find.


def _group(number: Column, *values: float) -> Column:
    """The value of the number's group, with a small step by the number."""
    step = (number % 7) / F.lit(1000.0)
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % 4 + 1).cast("int")) + step


def _profile_values(number: Column) -> dict[str, Column]:
    """Four groups, from least to most risk."""
    return {
        "annualised_return": _group(number, 0.1, 0.2, 0.3, 0.4),
        "volatility": _group(number, 0.1, 0.4, 0.9, 2.0),
        "sharpe_ratio": _group(number, 2.0, 1.0, 0.5, -1.0),
        "beta": _group(number, 0.2, 0.8, 1.5, 3.0),
    }


def _number() -> Column:
    return F.regexp_extract("ticker", r"(\d+)$", 1).cast("int")


def _planted(spark: SparkSession, sf: str) -> DataFrame:
    values = _profile_values(_number())
    rises = (F.col("ma_cross_signal") < 0) & (F.col("day_of_week") <= 4)
    change = F.when(F.col("forward_return").isNotNull(), F.when(rises, 0.01).otherwise(-0.01))
    daily = values.pop("annualised_return") / F.lit(PARAMS.trading_days)
    planted = {**values, "daily_return": daily, "forward_return": change}
    return materialize(_features(spark, sf).withColumns(planted), "planted")


def _planted_profile(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(profile.ticker_profile(_planted(spark, sf), PLANTED), "profile")


def _planted_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return classify.split_rows(splits.ml_rows(_planted(spark, sf), PLANTED), PLANTED)


def _planted_forest(spark: SparkSession, sf: str):
    train, test = _planted_split(spark, sf)
    return train, test, classify.fit_contender(train, classify.FOREST, PLANTED)


# --- output ---------------------------------------------------------------------------------


def _shown(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind == "double":
            column = F.round(column, 6)
        elif kind == "date":
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _bar_query(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A query over clean bars showing the key and some columns."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return step(_clean(spark, sf)).select("ticker", "date", *columns)

    return run


def _indicator(columns: tuple[str, ...], *makers) -> Query:
    return _bar_query(lambda clean: with_indicators(clean, PARAMS, *makers), *columns)


# --- queries: sources and sinks ---------------------------------------------------------------


def _normalize_columns(spark, sf):
    messy = read_trades(spark, sf).select(
        F.col("date").alias("Trade Date"), F.col("ticker").alias(" NAME"),
        F.col("l_orderkey").alias("Order Key "), F.col("quantity").alias("Volume"),
    )
    return rawio.normalize_columns(messy)


def _union_sources(spark, sf):
    bars = materialize(_bars(spark, sf), "bars")
    early = F.dayofmonth("date") < 15
    return rawio.union_sources([bars.filter(early), bars.filter(~early).drop("volume")])


def _csv_ingest(spark, sf):
    """Two CSV header styles in one folder, read back through the raw cache."""
    bars = materialize(_bars(spark, sf), "bars").select(*BAR_COLUMNS)
    early = F.dayofmonth("date") < 15
    folder, cache = scratch_path(spark, "csv"), scratch_path(spark, "cache")
    titled = bars.filter(early).toDF("Date", "Name", "Open", "HIGH", "low ", "Close", "Volume")
    tables.write_csv(titled, folder)
    bars.filter(~early).drop("volume").write.mode("append").option("header", True).csv(folder)
    wide = replace(PARAMS, start=date(1900, 1, 1), end=date(2100, 1, 1))
    return rawio.ingest(spark, folder, cache, wide)


def _cache_refresh(spark, sf):
    """A cache that follows its folder: half the bars, then the other half under another header."""
    bars = materialize(_bars(spark, sf), "bars").select(*BAR_COLUMNS)
    early = F.dayofmonth("date") < 15
    folder, cache = scratch_path(spark, "csv"), scratch_path(spark, "cache")
    wide = replace(PARAMS, start=date(1900, 1, 1), end=date(2100, 1, 1))
    tables.write_csv(bars.filter(early), folder)
    rawio.ingest(spark, folder, cache, wide)
    titled = bars.filter(~early).select(F.col("volume").alias("VOLUME "), *BAR_COLUMNS[:-1])
    titled.write.mode("append").option("header", True).csv(folder)
    return rawio.ingest(spark, folder, cache, wide)


def _skipped_files(spark, sf):
    """Rows of a table with one damaged file, and the list of such files."""
    clean, path = _clean(spark, sf), scratch_path(spark, "damaged")
    tables.write_by_ticker(clean, path)
    spark.range(1).selectExpr("'no parquet'").write.text(f"{path}/ticker=damaged")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the damage is wanted
        readable = tables.read_by_ticker(spark, path, clean.schema, skip_corrupt=True)
    skipped = tables.unreadable_files(spark, path)
    folder = F.regexp_extract("file", "/(ticker=[^/]*)/", 1)
    return readable.agg(F.count("*").alias("rows")).crossJoin(
        skipped.agg(F.count("*").alias("skipped"), F.min(folder).alias("first"))
    )


def _raw_roundtrip(spark, sf):
    path = scratch_path(spark, "raw")
    rawio.write_raw(_bars(spark, sf).select(*BAR_COLUMNS), path)
    return spark.read.parquet(path)


def _clean_roundtrip(spark, sf):
    folder = pipeline.Folder(scratch_path(spark, "run"))
    return pipeline.transform_stage(_trade_bars(spark, sf), folder, PARAMS)


def _bucketed_roundtrip(spark, sf):
    clean, path = _clean(spark, sf), scratch_path(spark, "bucketed")
    tables.write_by_ticker(clean, path, buckets=4)
    return tables.read_by_ticker(spark, path, clean.schema)


def _bucketed_features(spark, sf):
    """Features of a table bucketed by ticker: nothing is shuffled by ticker."""
    clean, path = _clean(spark, sf), scratch_path(spark, "bucketed")
    tables.write_bucketed(clean, path, BUCKETS)
    return add_features(tables.read_bucketed(spark, path, clean.schema, BUCKETS), PARAMS)


def _removed_rows(spark, sf):
    """The counts that the cleaning stage writes beside its bars."""
    folder = pipeline.Folder(scratch_path(spark, "run"))
    pipeline.transform_stage(_trade_bars(spark, sf), folder, TIGHT, BUCKETS)
    return pipeline.read_removed(spark, folder)


def _features_csv(spark, sf):
    features, path = _features(spark, sf), scratch_path(spark, "features-csv")
    tables.write_csv(features, path)
    return tables.read_csv(spark, path, features.schema)


def _model_roundtrip(spark, sf):
    """Rows scored by a model before and after saving, and how many of them differ."""
    train, test = _train_test(spark, sf)
    path = scratch_path(spark, "model")
    model = classify.fit_contender(train, classify.FOREST, PARAMS)
    pipeline.save_model(model, path)
    score = ["prediction", "probability_up"]
    live = classify.score_rows(test, model, PARAMS).select(
        "ticker", "date", F.struct(*score).alias("live")
    )
    saved = classify.score_rows(test, pipeline.load_model(path), PARAMS).select(
        "ticker", "date", F.struct(*score).alias("saved")
    )
    return live.join(saved, ["ticker", "date"], "full").agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("live").eqNullSafe(F.col("saved"))).alias("differing"),
    )


def _run_summary(spark, sf):
    """What the summary and the artefacts of a whole run say about the data."""
    root = scratch_path(spark, "run")
    pipeline.run_pipeline(_bars(spark, sf), root, PARAMS)
    folder = pipeline.Folder(root)
    removed = pipeline.read_removed(spark, folder)
    summary = pipeline.read_summary(spark, folder)
    sizes = F.aggregate(
        F.map_values("clustering.distribution"), F.lit(0).cast("bigint"), lambda a, b: a + b
    )
    facts = summary.select(
        "tickers_processed", F.col("clustering.n_clusters").alias("n_clusters"),
        F.col("clustering.silhouette_metric").alias("silhouette_metric"),
        sizes.alias("tickers_in_clusters"),
        F.col("return_prediction.forward_days").alias("forward_days"),
        F.col("return_prediction.accuracy").between(0, 1).alias("accuracy_in_range"),
    )
    counts = removed.select("rows_in", "null_rows", "duplicate_rows")
    swept = pipeline.read_sweep(spark, folder).agg(F.count_if("is_best").alias("best_k"))
    report = pipeline.read_report(spark, folder).filter("scope = 'macro avg'")
    return (
        facts.crossJoin(counts).crossJoin(swept)
        .crossJoin(report.select(F.col("support").alias("test_rows")))
    )


# --- queries: models ----------------------------------------------------------------------------


def _profile_table(spark, sf):
    return materialize(_profile(spark, sf), "profile")


def _kmeans_clusters(spark, sf):
    found = clustering.cluster_profiles(_planted_profile(spark, sf), PLANTED).profile
    return found.select("ticker", "cluster_label", "cluster_color")


def _predict_cluster(spark, sf):
    """The labels of new tickers, each with the profile of the next number's group."""
    known = _planted_profile(spark, sf)
    fitted = clustering.cluster_profiles(known, PLANTED)
    new = known.withColumns(_profile_values(_number() + 1)).withColumn(
        "ticker", F.concat(F.lit("new "), "ticker")
    )
    labelled = clustering.predict_clusters(new, fitted.model, fitted.ranking)
    return labelled.select("ticker", "cluster_label")


def _k_sweep(spark, sf):
    """Every swept k, the best, and the score of the planted number of groups."""
    found = clustering.sweep_clusters(_planted_profile(spark, sf), PLANTED)
    return found.select(
        "k", "metric", "is_best", F.when(F.col("k") == 4, F.col("silhouette")).alias("silhouette")
    )


def _clustering_stage(spark, sf):
    """The stage's tickers by label, its score and the best of its sweep."""
    found = pipeline.clustering_stage(_planted(spark, sf), PLANTED)
    best = found.sweep.filter("is_best").select(F.col("k").alias("best_k"))
    return profile.label_report(found.profile).select("cluster_label", "tickers").withColumns({
        "metric": F.lit(found.silhouette_metric),
        "silhouette": F.lit(round(found.silhouette, 4)),
        "best_k": best.scalar(),
    })


def _silhouette_points(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster"),
        F.col("embedding").alias("vector"),
    )


def _silhouette_fast(spark, sf):
    score = silhouette_squared(_silhouette_points(spark, sf))
    return spark.createDataFrame([(score,)], "silhouette_squared double")


def _fit(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, test = _planted_split(spark, sf)
        model = classify.fit_contender(train, name, PLANTED)
        return metrics.classification_report(model.transform(test))

    return run


def _tournament(spark, sf):
    """The contenders' scores, and the winner."""
    results = classify.tournament(*_planted_split(spark, sf), PLANTED)[0]
    winner = metrics.pick_winner(results).select(F.col("contender").alias("winner"))
    return results.withColumn("winner", winner.scalar())


def _cv_accuracy(spark, sf):
    """Mean and spread of the accuracy over the folds, beside the rows of the classes."""
    train, _ = _planted_split(spark, sf)
    mean, deviation = classify.cross_validate(train, classify.FOREST, PLANTED)
    return train.groupBy("is_profitable").agg(F.count("*").alias("rows")).withColumns({
        "mean_accuracy": F.lit(mean), "spread": F.lit(deviation),
    })


def _feature_importances(spark, sf):
    """The predictors and the places of the two that the labels follow."""
    train, _, model = _planted_forest(spark, sf)
    found = classify.feature_importances(model, train, PLANTED)
    first, second = [row.feature for row in found.limit(2).collect()]  # most important first
    place = F.when(F.col("feature") == first, 1).when(F.col("feature") == second, 2)
    return found.select("feature", place.alias("place"))


def _score_batch(spark, sf):
    """Predictions of the test rows, which lack a predictor that does not matter."""
    _, test, model = _planted_forest(spark, sf)
    partial = test.drop("return_lag_10")
    return classify.score_rows(partial, model, PLANTED).select("ticker", "date", "prediction")


def _scenario_grid(spark, sf):
    latest = scenarios.latest_rows(_features(spark, sf))
    return scenarios.scenario_rows(latest, SCENARIO_CHOICES, PARAMS)


def _scenario_scores(spark, sf):
    features = _planted(spark, sf)
    train, _ = classify.split_rows(splits.ml_rows(features, PLANTED), PLANTED)
    model = classify.fit_contender(train, classify.FOREST, PLANTED)
    grid = scenarios.scenario_rows(scenarios.latest_rows(features), PLANTED_CHOICES, PLANTED)
    scored = classify.score_rows(grid, model, PLANTED)
    return scored.select("ticker", "date", *PLANTED_CHOICES, "prediction")


def _prediction_stage(spark, sf):
    """The stage's metrics."""
    found = pipeline.prediction_stage(_planted(spark, sf), PLANTED)
    return pipeline.prediction_metrics(found, spark, PLANTED)


# --- queries: model rows and metrics --------------------------------------------------------------


def _train_only_scaling(spark, sf):
    split = _split_table(spark, sf)
    scaled = profile.standardize(split, PARAMS.predictors, splits.training_part(split))
    return scaled.drop(splits.LABEL)


def _tournament_rule(spark, sf):
    """The winner between two rule-made contenders, judged on the test rows."""
    test = _test_part(spark, sf)
    trend = test.withColumn("prediction", (F.col("ma_cross_signal") < 0).cast("int"))
    results = [
        metrics.scores(scored).withColumns({"contender": F.lit(name), "priority": F.lit(place)})
        for place, (name, scored) in enumerate(
            [("low_rsi", _ruled_scores(test)), ("down_trend", trend)]
        )
    ]
    return metrics.pick_winner(results[0].unionByName(results[1]))


def _split_counts(spark, sf):
    return _split(spark, sf).agg(
        F.count_if(F.col("is_test") == 0).alias("n_train"),
        F.count_if(F.col("is_test") == 1).alias("n_test"),
        F.count_distinct("ticker").alias("tickers"),
    )


def _cv_folds(spark, sf):
    train = splits.training_part(_split_table(spark, sf))
    return splits.cv_folds(train, PARAMS).select("ticker", "date", "is_profitable", "fold")


def _test_part(spark, sf):
    return splits.testing_part(_split_table(spark, sf))


def _ranked(spark, sf):
    return profile.rank_clusters(_ruled_profile(spark, sf, 4))


def _label_map(spark, sf):
    """Ids 0-3 carry labels; the fifth id was never ranked."""
    table = materialize(_ruled_profile(spark, sf, 5), "profile")
    ranking = profile.rank_clusters(table.filter("cluster_id < 4"))
    return profile.attach_labels(table, ranking).select(
        "ticker", "cluster_id", "cluster_label", "cluster_color"
    )


def _three_labels(spark, sf):
    table = materialize(_ruled_profile(spark, sf, 3), "profile")
    return profile.attach_labels(table, profile.rank_clusters(table))


_QUERIES: dict[str, Query] = {
    # sources and sinks
    "normalize_columns": _normalize_columns,
    "union_sources": _union_sources,
    "csv_ingest": _csv_ingest,
    "cache_refresh": _cache_refresh,
    "skipped_files": _skipped_files,
    "coerce_raw": lambda s, d: rawio.coerce_raw(_text_bars(s, d), missing_volume=0),
    "coerce_dates": lambda s, d: rawio.coerce_raw(
        _dated_bars(s, d), date_formats=PARAMS.date_formats
    ),
    "unparsed_dates": lambda s, d: _dated_bars(s, d).agg(
        F.count("*").alias("rows"),
        F.count_if(rawio.unparsed_date(PARAMS)).alias("unparsed"),
    ),
    "load_bars": lambda s, d: rawio.load_bars(_text_bars(s, d), FIVE_YEARS),
    "raw_roundtrip": _raw_roundtrip,
    "clean_roundtrip": _clean_roundtrip,
    "bucketed_roundtrip": _bucketed_roundtrip,
    "bucketed_features": _bucketed_features,
    "features_csv": _features_csv,
    "bars_from_trades": _bars,
    # cleaning
    "cast_numerics": lambda s, d: cl.cast_numerics(_text_bars(s, d)),
    "drop_nulls": lambda s, d: cl.drop_nulls(_trade_bars(s, d)),
    "dedupe_bars": lambda s, d: cl.dedupe_bars(_trade_bars(s, d)),
    "universe_filter": lambda s, d: cl.in_universe(
        _bars(s, d),
        s.read.parquet(f"{d}/part.parquet").filter("p_size = 50")
        .select(F.col("p_brand").alias("ticker")),
    ),
    "date_range": lambda s, d: cl.in_date_range(_bars(s, d), FIVE_YEARS),
    "daily_return": _bar_query(lambda clean: clean, "close", "daily_return"),
    "outlier_filter": lambda s, d: cl.drop_outliers(
        cl.add_daily_return(_bars(s, d)), TIGHT
    ).select("ticker", "date", "daily_return"),
    "winsorize": _bar_query(lambda clean: winsorized_bars(clean, PARAMS), "daily_return"),
    "clean_bars": lambda s, d: cl.clean_bars(_trade_bars(s, d), TIGHT),
    "sorted_layout": _bar_query(cl.arrange_by_ticker, "close"),
    "preview": lambda s, d: cl.preview(_clean(s, d)),
    # quality
    "removed_rows": _removed_rows,
    "drop_report": lambda s, d: quality.drop_report(_trade_bars(s, d), TIGHT),
    "audit": lambda s, d: quality.audit(_audit_input(s, d)),
    "audit_tickers": lambda s, d: quality.audit_tickers(_audit_input(s, d)),
    "load_report": lambda s, d: quality.load_report(_clean(s, d), PARAMS),
    # indicators
    "moving_averages": _indicator(("ma7", "ma30"), ind.moving_averages),
    "ma_cross": _indicator(("ma_cross_signal",), ind.cross_signal),
    "ma_spread": _indicator(("ma_spread",), ind.mean_spread),
    "full_window_ma": _indicator(("ma7", "ma30"), ind.full_window_averages),
    "rsi": _indicator(("rsi",), ind.rsi),
    "rsi_bins": _indicator(("rsi_binned",), ind.rsi, ind.rsi_state),
    "bollinger": _indicator(("bb_mid", "bb_upper", "bb_lower", "bb_pct_b"), ind.bands),
    "volatility": _indicator(("volatility",), ind.volatility),
    "momentum": _indicator(("momentum_14d",), ind.momentum),
    "drawdown": _indicator(("drawdown_30d",), ind.drawdown),
    "day_of_week": _indicator(("day_of_week",), ind.weekday),
    "volume_features": _indicator(("volume_ma20", "volume_ratio"), ind.volume),
    "lag_returns": _indicator(
        ("return_lag_1", "return_lag_5", "return_lag_10"), ind.lagged_returns
    ),
    "forward_return": _indicator(("forward_return",), ind.forward_return),
    "sharpe": _indicator(("sharpe_ratio",), ind.sharpe),
    "bench_join": lambda s, d: with_benchmark(_clean_table(s, d), PARAMS).select(
        "ticker", "date", "daily_return", "bench_return"
    ),
    "beta": lambda s, d: with_indicators(
        with_benchmark(_clean_table(s, d), PARAMS), PARAMS, ind.beta
    ).select("ticker", "date", "beta"),
    "features_all": _features,
    "ema": _bar_query(
        lambda clean: add_emas(clean, "close", {"ema9": 9, "ema12": 12, "ema26": 26}),
        "ema9", "ema12", "ema26",
    ),
    "ema_returns": _bar_query(
        lambda clean: add_emas(clean, "daily_return", {"ema9": 9, "ema26": 26}),
        "daily_return", "ema9", "ema26",
    ),
    "macd": _bar_query(
        lambda clean: add_macd(clean, PARAMS), "macd", "macd_signal_line", "macd_histogram"
    ),
    "side_features": lambda s, d: add_side_features(_clean(s, d), PARAMS),
    # profiles and reports
    "ticker_profile": _profile,
    "ticker_lookup": lambda s, d: profile.ticker_lookup(_profile(s, d), "Brand#7"),
    "standardize": lambda s, d: profile.standardize(_profile_table(s, d)),
    "cluster_rank": _ranked,
    "label_map": _label_map,
    "label_kpis": lambda s, d: profile.label_report(_three_labels(s, d)),
    "plot_sizes": lambda s, d: profile.plot_sizes(_three_labels(s, d)).select(
        "ticker", "cluster_label", "sharpe_ratio", "plot_size"
    ),
    # model rows and metrics
    "ml_dataset": lambda s, d: splits.ml_rows(_features(s, d), PARAMS),
    "walk_forward_split": lambda s, d: _split(s, d).select("ticker", "date", "is_test"),
    "split_counts": _split_counts,
    "cv_folds": _cv_folds,
    "class_weights": lambda s, d: splits.class_weights(splits.training_part(_split_table(s, d))),
    "baseline_accuracy": lambda s, d: metrics.baseline_accuracy(_test_part(s, d)),
    "classification_report": lambda s, d: metrics.classification_report(
        _ruled_scores(_test_part(s, d))
    ),
    "accuracy_scores": lambda s, d: metrics.scores(_ruled_scores(_test_part(s, d))),
    "tournament_rule": _tournament_rule,
    "train_only_scaling": _train_only_scaling,
    "scenario_grid": _scenario_grid,
    # models
    "silhouette_exact": lambda s, d: silhouette_exact(_silhouette_points(s, d)),
    "silhouette_fast": _silhouette_fast,
    "kmeans_clusters": _kmeans_clusters,
    "k_sweep": _k_sweep,
    "predict_cluster": _predict_cluster,
    "clustering_stage": _clustering_stage,
    "rf_fit": _fit(classify.FOREST),
    "gbt_fit": _fit(classify.BOOSTED),
    "tournament": _tournament,
    "cv_accuracy": _cv_accuracy,
    "feature_importances": _feature_importances,
    "score_batch": _score_batch,
    "scenario_scores": _scenario_scores,
    "prediction_stage": _prediction_stage,
    "model_roundtrip": _model_roundtrip,
    "run_summary": _run_summary,
}


def _displayed(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shown(query(spark, sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The full feature table on the smallest scale."""
    return queries()["features_all"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query: name -> (session, folder of tables) -> DataFrame."""
    own = {name: _displayed(query) for name, query in _QUERIES.items()}
    return own | (text_registry.QUERIES if text_registry else {})


def oracle_sql() -> dict[str, str]:
    """The same result in SQL, for every query that SQL can express."""
    return oracle_queries.build() | (text_registry.ORACLE_SQL if text_registry else {})
