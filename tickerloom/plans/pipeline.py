"""The stages end to end: ingest, clean, features, clusters, prediction, summary."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators.benchmark import require_benchmark
from tickerloom.operators.classify import (
    Prediction,
    order_importances,
    score_rows,
    train_predictor,
)
from tickerloom.operators.clustering import (
    Clustering,
    cluster_profiles,
    predict_clusters,
)
from tickerloom.operators.indicators import add_features
from tickerloom.operators.profile import label_table, ticker_profile
from tickerloom.operators.quality import clean_and_count
from tickerloom.operators.splits import ml_rows
from tickerloom.params import Params
from tickerloom.sources.storage import materialize, run_folder
from tickerloom.sources.tables import (
    read_bucketed,
    read_by_ticker,
    read_csv,
    read_json,
    write_bucketed,
    write_by_ticker,
    write_csv,
    write_json,
)

# The run summary's shape.
SUMMARY_SCHEMA = (
    "pipeline_duration_seconds double, tickers_processed bigint, "
    "clustering struct<n_clusters: int, silhouette_score: double, silhouette_metric: string, "
    "distribution: map<string, bigint>>, "
    "return_prediction struct<winning_model: string, accuracy: double, f1_score: double, "
    "cv_accuracy: double, forward_days: int>"
)


# The result tables' columns.
CLUSTER_SCHEMA = (
    "ticker string, annualised_return double, volatility double, sharpe_ratio double, "
    "beta double, avg_rsi double, avg_bb_pct_b double, trading_days bigint, cluster_id int, "
    "cluster_label string, cluster_color string"
)
IMPORTANCE_SCHEMA = "feature string, importance double"
REPORT_SCHEMA = (
    "scope string, precision double, recall double, f1_score double, support bigint, "
    "accuracy double"
)
SWEEP_SCHEMA = "k int, silhouette double, metric string, is_best boolean"
REMOVED_SCHEMA = (
    "rows_in bigint, null_rows bigint, duplicate_rows bigint, outlier_rows bigint, "
    "rows_out bigint"
)


@dataclass(frozen=True)
class Folder:
    """Where a run keeps its tables and models, below one root."""

    root: str

    @property
    def clean(self) -> str:
        return f"{self.root}/processed/clean"

    @property
    def features(self) -> str:
        return f"{self.root}/processed/features"

    @property
    def features_csv(self) -> str:
        return f"{self.root}/processed/features_csv"

    @property
    def summary(self) -> str:
        return f"{self.root}/processed/summary"

    @property
    def clusters(self) -> str:
        return f"{self.root}/models/clusters"

    @property
    def cluster_model(self) -> str:
        return f"{self.root}/models/cluster_model"

    @property
    def importances(self) -> str:
        return f"{self.root}/models/importances"

    @property
    def removed(self) -> str:
        return f"{self.root}/processed/removed_rows"

    @property
    def sweep(self) -> str:
        return f"{self.root}/models/silhouette_by_k"

    @property
    def report(self) -> str:
        return f"{self.root}/models/classification_report"

    @property
    def return_model(self) -> str:
        return f"{self.root}/models/return_model"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_clusters(spark: SparkSession, folder: Folder) -> DataFrame:
    return read_csv(spark, folder.clusters, CLUSTER_SCHEMA)


def read_importances(spark: SparkSession, folder: Folder, ascending: bool = False) -> DataFrame:
    return order_importances(read_csv(spark, folder.importances, IMPORTANCE_SCHEMA), ascending)


def read_report(spark: SparkSession, folder: Folder) -> DataFrame:
    """The winner's classification report."""
    return read_csv(spark, folder.report, REPORT_SCHEMA)


def read_sweep(spark: SparkSession, folder: Folder) -> DataFrame:
    """The silhouette of every swept number of clusters."""
    return read_csv(spark, folder.sweep, SWEEP_SCHEMA)


def read_removed(spark: SparkSession, folder: Folder) -> DataFrame:
    """How many raw rows each cleaning rule removed."""
    return read_csv(spark, folder.removed, REMOVED_SCHEMA)


def read_summary(spark: SparkSession, folder: Folder) -> DataFrame:
    return read_json(spark, folder.summary, SUMMARY_SCHEMA)


def label_profiles(profile: DataFrame, folder: Folder) -> DataFrame:
    """Cluster labels for profiles from a finished run's artefacts."""
    labels = read_clusters(profile.sparkSession, folder).select(
        "cluster_id", "cluster_label", "cluster_color"
    )
    return predict_clusters(profile, load_model(folder.cluster_model), labels.distinct())


def predict_direction(rows: DataFrame, folder: Folder, params: Params) -> DataFrame:
    """Predictions for feature rows from a finished run's model."""
    return score_rows(rows, load_model(folder.return_model), params)


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a run's bar tables: as many as a shuffle has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def transform_stage(
    raw: DataFrame, folder: Folder, params: Params, buckets: int | None = None,
    by_ticker: bool = False,
) -> DataFrame:
    """Clean bars and the rows removed by rule, written; the result reads the written bars.

    The raw bars are read and shuffled once for both. The bars are bucketed by ticker, so the
    feature stage shuffles nothing; ``by_ticker`` writes one folder per ticker instead.
    """
    spark = raw.sparkSession
    buckets = buckets or bucket_count(spark)
    clean, removed = clean_and_count(raw, params, buckets)
    if by_ticker:
        write_by_ticker(clean, folder.clean, clustered=True)
        written = read_by_ticker(spark, folder.clean, clean.schema)
    else:
        write_bucketed(clean, folder.clean, buckets)
        written = read_bucketed(spark, folder.clean, clean.schema, buckets)
    write_csv(removed, folder.removed)
    return written


def feature_stage(
    clean: DataFrame, folder: Folder, params: Params,
    buckets: int | None = None, export_csv: bool = True, by_ticker: bool = False,
) -> DataFrame:
    """Feature table, written as parquet (laid out like the clean bars) and, unless switched off,
    as CSV."""
    require_benchmark(clean, params)
    spark = clean.sparkSession
    features = add_features(clean, params)
    if by_ticker:
        write_by_ticker(features, folder.features, clustered=True)
        written = read_by_ticker(spark, folder.features, features.schema)
    else:
        buckets = buckets or bucket_count(spark)
        write_bucketed(features, folder.features, buckets)
        written = read_bucketed(spark, folder.features, features.schema, buckets)
    if export_csv:
        write_csv(written, folder.features_csv)
    return written


def clustering_stage(features: DataFrame, params: Params) -> Clustering:
    """Profiles, written once, clustered at the configured k and, beside it, for every swept k."""
    profile = materialize(ticker_profile(features, params), "profile")
    return cluster_profiles(profile, params, sweep=True)


def prediction_stage(features: DataFrame, params: Params) -> Prediction:
    return train_predictor(ml_rows(features, params), params)


def prediction_metrics(prediction: Prediction, spark: SparkSession, params: Params) -> DataFrame:
    """One row of the stage's metrics, ratios to 4 places."""
    row = (
        prediction.winner, round(prediction.accuracy, 4), round(prediction.f1_score, 4),
        round(prediction.cv_accuracy, 4), round(prediction.baseline, 4),
        prediction.n_train, prediction.n_test, params.forward_days,
    )
    return spark.createDataFrame(
        [row],
        "winning_model string, accuracy double, f1_score double, cv_accuracy double, "
        "baseline_accuracy double, n_train bigint, n_test bigint, forward_days int",
    )


def run_summary(
    clustering: Clustering, prediction: Prediction, seconds: float, params: Params
) -> DataFrame:
    """The run as one nested row. The distribution map has one entry per risk label."""
    spark = clustering.profile.sparkSession
    labels = label_table(spark).select("cluster_label")
    sizes = clustering.profile.join(F.broadcast(labels), "cluster_label", "left_semi")
    sizes = sizes.groupBy("cluster_label").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tickers"),
        F.map_from_entries(F.collect_list(F.struct("cluster_label", "n"))).alias("distribution"),
    ).select(
        F.lit(round(seconds, 1)).alias("pipeline_duration_seconds"),
        F.col("tickers").alias("tickers_processed"),
        F.struct(
            F.lit(params.clusters).alias("n_clusters"),
            F.lit(round(clustering.silhouette, 4)).alias("silhouette_score"),
            F.lit(clustering.silhouette_metric).alias("silhouette_metric"),
            F.col("distribution"),
        ).alias("clustering"),
        F.struct(
            F.lit(prediction.winner).alias("winning_model"),
            F.lit(round(prediction.accuracy, 4)).alias("accuracy"),
            F.lit(round(prediction.f1_score, 4)).alias("f1_score"),
            F.lit(round(prediction.cv_accuracy, 4)).alias("cv_accuracy"),
            F.lit(params.forward_days).alias("forward_days"),
        ).alias("return_prediction"),
    )


def run_pipeline(
    raw: DataFrame, root: str, params: Params,
    buckets: int | None = None, export_csv: bool = True, by_ticker: bool = False,
) -> DataFrame:
    """Every stage from raw bars, all artefacts written below ``root``; returns the summary as
    written. Intermediate tables are removed at the end."""
    started = time.monotonic()
    folder, spark = Folder(root.rstrip("/")), raw.sparkSession
    with run_folder(spark):
        clean = transform_stage(raw, folder, params, buckets, by_ticker)
        features = feature_stage(clean, folder, params, buckets, export_csv, by_ticker)
        clustering = clustering_stage(features, params)
        write_csv(clustering.profile, folder.clusters)
        write_csv(clustering.sweep, folder.sweep)
        save_model(clustering.model, folder.cluster_model)
        prediction = prediction_stage(features, params)
        write_csv(prediction.importances, folder.importances)
        write_csv(prediction.report, folder.report)
        save_model(prediction.model, folder.return_model)
        seconds = time.monotonic() - started
        write_json(run_summary(clustering, prediction, seconds, params), folder.summary)
    return read_summary(spark, folder)
