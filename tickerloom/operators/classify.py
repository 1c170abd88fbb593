"""Direction classifiers: two contenders, a tournament, cross validation and scoring."""

from __future__ import annotations

import statistics
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.metrics import (
    baseline_accuracy,
    classification_report,
    pick_winner,
    scores,
)
from tickerloom.operators.splits import (
    LABEL,
    cut_parts,
    cv_folds,
    with_class_weights,
)
from tickerloom.params import FIT_THREADS, Params
from tickerloom.sources.storage import fit_layout, materialize, shared_folder

# Contender names; the first wins a tie.
FOREST = "Random Forest Classifier"
BOOSTED = "Gradient Boosting Classifier"
CONTENDERS = (FOREST, BOOSTED)


@dataclass(frozen=True)
class Prediction:
    """A trained predictor and its scores."""

    winner: str
    model: PipelineModel
    results: DataFrame
    report: DataFrame
    importances: DataFrame
    accuracy: float
    f1_score: float
    cv_accuracy: float
    cv_std: float
    baseline: float
    n_train: int
    n_test: int


def scaler_stages(params: Params) -> list:
    assembler = VectorAssembler(inputCols=list(params.predictors), outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    return [assembler, scaler]


def classifier(name: str, params: Params) -> Estimator:
    """An unfitted contender. The forest weighs classes evenly, the boosted trees do not."""
    if name == FOREST:
        return RandomForestClassifier(
            labelCol=LABEL, weightCol="weight", seed=params.seed,
            numTrees=params.forest_trees, maxDepth=params.forest_depth,
            minInstancesPerNode=params.forest_min_leaf, featureSubsetStrategy="sqrt",
        )
    return GBTClassifier(
        labelCol=LABEL, seed=params.seed,
        maxIter=params.boost_rounds, stepSize=params.boost_rate, maxDepth=params.boost_depth,
        subsamplingRate=params.boost_sample, featureSubsetStrategy="sqrt",
    )


def split_rows(rows: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """(train, test) in time order; train carries class weights.

    The rows are written once: the counting passes of the cut and the metrics read that table,
    and the cut is a pair of literals, so its date reaches the scan. The weighted training part is
    written once more, for both contenders, the folds and the counts; it has a fixed layout,
    because fits sample per partition.
    """
    train, test = cut_parts(materialize(rows, "ml-rows"), params)
    # The weights are joined once, before the layout: the optimizer drops a sort below a join.
    train = materialize(with_class_weights(train), "train")
    train = fit_layout(train, params.fit_partitions, "ticker", "date")
    return train, test


def fit_contender(train: DataFrame, name: str, params: Params) -> PipelineModel:
    """Scaler (fitted on these rows only) and classifier as one pipeline model."""
    shared_folder(train.sparkSession)  # boosting cuts its lineage in the checkpoint folder
    return Pipeline(stages=[*scaler_stages(params), classifier(name, params)]).fit(train)


def evaluate(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """One row: accuracy, f1_score."""
    return scores(model.transform(rows))


def tournament(
    train: DataFrame, test: DataFrame, params: Params
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every contender; returns (contender, priority, accuracy, f1_score) and the models.

    The contenders share one scaled, persisted training table.
    """
    shared_folder(train.sparkSession)
    scaler = Pipeline(stages=scaler_stages(params)).fit(train)
    scaled = scaler.transform(train).select(LABEL, "weight", "features")
    kept = scaled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {
            name: PipelineModel([*scaler.stages, classifier(name, params).fit(kept)])
            for name in CONTENDERS
        }
    finally:
        kept.unpersist()
    rows = []
    for priority, name in enumerate(CONTENDERS):
        score = evaluate(models[name], test).first()
        rows.append((name, priority, score.accuracy, score.f1_score))
    results = train.sparkSession.createDataFrame(
        rows, "contender string, priority int, accuracy double, f1_score double"
    )
    return results, models


def cross_validate(train: DataFrame, name: str, params: Params) -> tuple[float, float]:
    """(mean, population deviation) of the accuracy over contiguous per-class folds.

    The folds share one scaled, persisted table and are fitted side by side; class weights are
    balanced anew on each fold's training rows. A fold without rows is an error.
    """
    shared_folder(train.sparkSession)
    folded = fit_layout(cv_folds(train, params), params.fit_partitions, "ticker", "date")
    scaled = Pipeline(stages=scaler_stages(params)).fit(train).transform(folded)
    kept = scaled.select(LABEL, "fold", "features").persist(StorageLevel.MEMORY_AND_DISK)

    def accuracy(fold: int) -> float:
        rest = with_class_weights(kept.filter(F.col("fold") != fold))
        model = classifier(name, params).fit(rest)
        found = scores(model.transform(kept.filter(F.col("fold") == fold))).first().accuracy
        if found is None:
            raise ValueError(f"fold {fold} of {params.folds} has no rows")
        return found

    try:
        with ThreadPool(min(FIT_THREADS, params.folds)) as pool:
            work = inheritable_thread_target(train.sparkSession)(accuracy)
            found = pool.map(work, range(params.folds))
    finally:
        kept.unpersist()
    return statistics.fmean(found), statistics.pstdev(found)


def feature_importances(model: PipelineModel, train: DataFrame, params: Params) -> DataFrame:
    """feature, importance: one row per predictor, most important first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(params.predictors, values, strict=True))
    table = train.sparkSession.createDataFrame(rows, "feature string, importance double")
    return order_importances(table)


def order_importances(table: DataFrame, ascending: bool = False) -> DataFrame:
    """Descending as saved, ascending for bar charts; ties by feature name."""
    return table.orderBy(F.col("importance") if ascending else F.desc("importance"), "feature")


def score_rows(rows: DataFrame, model: PipelineModel, params: Params) -> DataFrame:
    """Add ``prediction`` (1.0 up, 0.0 down) and ``probability_up``.

    A predictor that is null, or a column the rows lack, counts as 0.0.
    """
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
        for c in params.predictors
    }
    scored = model.transform(rows.withColumns(filled))
    return scored.select(
        *rows.columns, "prediction", vector_to_array("probability")[1].alias("probability_up")
    )


def train_predictor(rows: DataFrame, params: Params) -> Prediction:
    """Split, tournament, cross-validate the winner, importances."""
    train, test = split_rows(rows, params)
    results, models = tournament(train, test, params)
    best = pick_winner(results).first()
    cv_mean, cv_std = cross_validate(train, best.contender, params)
    baseline = baseline_accuracy(test).first()
    report = classification_report(models[best.contender].transform(test))
    return Prediction(
        winner=best.contender,
        model=models[best.contender],
        results=results,
        report=report,
        importances=feature_importances(models[best.contender], train, params),
        accuracy=best.accuracy,
        f1_score=best.f1_score,
        cv_accuracy=cv_mean,
        cv_std=cv_std,
        baseline=baseline.baseline_accuracy,
        n_train=train.count(),
        n_test=baseline.rows,
    )
