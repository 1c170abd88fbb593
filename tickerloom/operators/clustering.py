"""Risk clusters of ticker profiles: k-means with restarts side by side.

All center sets, every wanted k with every seed, run through one loop of Lloyd's iterations: a
round is one pass over the profiles, whose tasks return per center the number, sum and cost of
its profiles. The driver holds centers only (restarts x k x features numbers), so the number of
jobs is the number of rounds, not of fits. Sets that have settled leave the loop.

Starts are drawn by k-means++ on at most ``START_ROWS`` profiles, those with the smallest ticker
hashes; the iterations cover all profiles. A set's starts depend on its k and seed alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators.profile import attach_labels, check_cluster_count, rank_clusters
from tickerloom.operators.silhouette import silhouette_squared, silhouettes
from tickerloom.params import CLUSTER_FEATURES, Params
from tickerloom.sources.storage import fit_layout

#: Profiles that starts are drawn from.
START_ROWS = 4096
#: A set has settled once none of its centers moves by more.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Clustering:
    """A fitted clustering: the labelled profile, its ranking, the model and its scores."""

    profile: DataFrame
    ranking: DataFrame
    model: PipelineModel
    silhouette: float
    silhouette_metric: str
    sweep: DataFrame | None = None


@dataclass(frozen=True)
class Centers:
    """The centers of one k and seed, and the cost of the profiles to them."""

    k: int
    seed: int
    points: np.ndarray
    cost: float


def fit_scaler(profile: DataFrame) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(CLUSTER_FEATURES), outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler]).fit(profile)


# --- Lloyd's iterations for many center sets ----------------------------------------------------


def _starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each next start with a chance in proportion to its squared distance."""
    draw = np.random.default_rng([k, seed])
    chosen = [sample[draw.integers(len(sample))]]
    apart = np.full(len(sample), np.inf)
    while len(chosen) < k:
        apart = np.minimum(apart, ((sample - chosen[-1]) ** 2).sum(1))
        total = apart.sum()
        # Fewer different profiles than clusters: the rest of the starts repeat.
        weights = apart / total if total > 0 else None
        chosen.append(sample[draw.choice(len(sample), p=weights)])
    return np.array(chosen)


def _round(vectors: DataFrame, sets: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """One iteration of every set: new centers, and the cost of the old ones."""
    schema = "place int, center int, n bigint, total array<double>, cost double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c), np.int64) for c in sets]
        totals, costs = [np.zeros(c.shape) for c in sets], [np.zeros(len(c)) for c in sets]
        for batch in batches:
            column = batch.column("vector")
            points = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for s, centers in enumerate(sets):
                apart = ((points[:, None, :] - centers[None]) ** 2).sum(2)
                own = apart.argmin(1)
                n[s] += np.bincount(own, minlength=len(centers))
                np.add.at(totals[s], own, points)
                np.add.at(costs[s], own, apart[np.arange(len(own)), own])
        rows = [
            (s, i, int(n[s][i]), totals[s][i].tolist(), float(costs[s][i]))
            for s in range(len(sets)) for i in range(len(sets[s])) if n[s][i]
        ]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64())
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            [field.split()[0] for field in schema.split(", ")],
        )

    d = sets[0].shape[1]
    added = vectors.mapInArrow(partial, schema).groupBy("place", "center").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        F.array(*[F.sum(F.col("total")[i]) for i in range(d)]).alias("total"),
    )
    moved, cost = [c.copy() for c in sets], np.zeros(len(sets))
    for row in added.orderBy("place", "center").collect():  # one row per center
        moved[row.place][row.center] = np.array(row.total) / row.n
        cost[row.place] += row.cost
    return moved, cost


def fit_centers(
    vectors: DataFrame, wanted: list[tuple[int, int]], iterations: int
) -> list[Centers]:
    """Centers for every wanted (k, seed) of (ticker, vector array<double>)."""
    first = vectors.orderBy(F.xxhash64("ticker"), "ticker").limit(START_ROWS)
    sample = np.array([row.vector for row in first.select("vector").collect()], float)
    if not len(sample):
        raise ValueError("there are no profiles to cluster")
    only = vectors.select("vector")
    sets = [_starts(sample, k, seed) for k, seed in wanted]
    cost, active = np.zeros(len(sets)), list(range(len(sets)))
    for _ in range(iterations):
        if not active:
            break
        moved, _ = _round(only, [sets[i] for i in active])
        still = []
        for i, centers in zip(active, moved):
            if ((centers - sets[i]) ** 2).sum(1).max() > TOLERANCE**2:
                still.append(i)
            sets[i] = centers
        active = still
    _, cost = _round(only, sets)
    return [
        Centers(k, seed, points, float(total))
        for (k, seed), points, total in zip(wanted, sets, cost)
    ]


def _lowest(found: list[Centers], k: int) -> Centers:
    """The set of this k with the lowest cost; ties, up to rounding, go to the first seed."""
    own = [c for c in found if c.k == k]
    least = min(c.cost for c in own)
    return next(c for c in own if c.cost <= least * (1 + 1e-9))


def as_model(centers: np.ndarray, spark: SparkSession) -> KMeansModel:
    """Spark's k-means model with exactly these centers: a fit on them, a cluster each."""
    rows = spark.createDataFrame([(c,) for c in np.unique(centers, axis=0).tolist()],
                                 "point array<double>")
    points = rows.select(array_to_vector("point").alias("_scaled")).coalesce(1)
    kmeans = KMeans(featuresCol="_scaled", predictionCol="cluster_id", initMode="random",
                    k=max(2, points.count()), maxIter=1, seed=0)
    return kmeans.fit(points)


# --- the stage ------------------------------------------------------------------------------------


def _nearest(vector: Column, centers: np.ndarray) -> Column:
    """The place of the nearest center; ties go to the first."""
    apart = [
        sum(((vector[i] - F.lit(float(c))) ** 2 for i, c in enumerate(center)), F.lit(0.0))
        for center in centers
    ]
    distances = F.array(*apart)
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _scores(
    vectors: DataFrame, found: list[Centers], params: Params
) -> tuple[list[float], str]:
    """(score of every clustering, metric) under the metric the caller names: "euclidean", one
    pass that is quadratic in the number of profiles, or "squared_euclidean", linear and a
    different number."""
    metric = params.silhouette_metric
    places = [_nearest(F.col("vector"), c.points) for c in found]
    if metric == "squared_euclidean":
        return [
            silhouette_squared(vectors.select(place.alias("cluster"), "vector")) for place in places
        ], metric
    if metric != "euclidean":
        raise ValueError(f"unknown silhouette metric {metric!r}")
    points = vectors.select(F.col("ticker").alias("id"), F.array(*places).alias("clusters"), "vector")
    scored = silhouettes(points, [c.k for c in found])
    means = [F.avg(F.col("silhouettes")[i]) for i in range(len(found))]
    return list(scored.agg(*means).first()), metric


def _fitted(
    profile: DataFrame, params: Params, clusters: int | None, sweep: bool
) -> tuple[PipelineModel, list[Centers], list[float], str]:
    """(scaler, centers, scores, metric): the stage's clustering first if ``clusters``, then the
    swept ones. One loop fits them all, one pass over the distances scores them."""
    scaler = fit_scaler(fit_layout(profile, params.fit_partitions, "ticker"))
    scaled = scaler.transform(fit_layout(profile, params.fit_partitions, "ticker"))
    # In a fixed layout, so that sums are added in one order.
    vectors = scaled.select("ticker", vector_to_array("_scaled").alias("vector"))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = vectors.count()
        swept = [k for k in params.sweep if k < size] if sweep else []
        tried = range(params.seed, params.seed + params.sweep_restarts)
        wanted = {(k, seed) for k in swept for seed in tried}
        if clusters is not None:
            own = range(params.seed, params.seed + params.cluster_restarts)
            wanted |= {(clusters, seed) for seed in own}
        if not wanted:
            return scaler, [], [], params.silhouette_metric
        found = fit_centers(vectors, sorted(wanted), params.cluster_iterations)
        chosen = []
        if clusters is not None:
            chosen.append(_lowest([c for c in found if c.seed in own], clusters))
        chosen += [_lowest([c for c in found if c.seed in tried], k) for k in swept]
        scores, metric = _scores(vectors, chosen, params)
    finally:
        vectors.unpersist()
    return scaler, chosen, scores, metric


def _sweep_table(profile: DataFrame, found: list[tuple[int, float]], metric: str) -> DataFrame:
    """k, silhouette (4 places), metric and is_best."""
    rounded = [(k, round(score, 4)) for k, score in found]
    best = max(rounded, key=lambda row: (row[1], -row[0]))[0] if rounded else None
    rows = [(k, score, metric, k == best) for k, score in rounded]
    return profile.sparkSession.createDataFrame(
        rows, "k int, silhouette double, metric string, is_best boolean"
    )


def sweep_clusters(profile: DataFrame, params: Params) -> DataFrame:
    """k, silhouette (4 places), metric and is_best per swept k below the profile size."""
    _, found, scores, metric = _fitted(profile, params, None, True)
    return _sweep_table(profile, [(c.k, score) for c, score in zip(found, scores)], metric)


def cluster_profiles(profile: DataFrame, params: Params, sweep: bool = False) -> Clustering:
    """Scale, fit, label by risk and score; with ``sweep`` also every swept k, beside it."""
    check_cluster_count(params.clusters)
    scaler, found, scores, metric = _fitted(profile, params, params.clusters, sweep)
    model = PipelineModel(stages=[*scaler.stages, as_model(found[0].points, profile.sparkSession)])
    clustered = assign_clusters(profile, model)
    ranking = rank_clusters(clustered)
    swept = [(c.k, score) for c, score in zip(found[1:], scores[1:])]
    table = _sweep_table(profile, swept, metric) if sweep else None
    return Clustering(attach_labels(clustered, ranking), ranking, model, scores[0], metric, table)


def assign_clusters(profile: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``cluster_id`` of the nearest centre."""
    return model.transform(profile).select(*profile.columns, "cluster_id")


def predict_clusters(profile: DataFrame, model: PipelineModel, ranking: DataFrame) -> DataFrame:
    """Label profiles, also new ones, with a fitted model."""
    return attach_labels(assign_clusters(profile, model), ranking)
