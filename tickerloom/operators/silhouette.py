"""Silhouette scores of a clustering."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows and bytes of vectors per block: a task holds two blocks. Every point is sent once per
# block, so larger blocks move less; small inputs still get blocks enough to keep cores busy.
BLOCK_ROWS = 32_768
BLOCK_BYTES = 16 << 20
MIN_BLOCKS, MIN_BLOCK_ROWS = 16, 2048
# Partitions of block pairs.
MAX_PARTS = 10_000
# Distances are taken in tiles that stay in a core's cache.
TILE_ROWS, TILE_COLUMNS = 256, 512
# A squared distance below these shares of both squared lengths, about the common centre and about
# zero, has lost digits to cancellation; such distances are taken from the differences.
CLOSE, FAINT = 1e-3, 1e-12


def _distinct(points: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows, the members of equal ones added up, and each row's place among them."""
    width = points.itemsize * points.shape[1]
    if not width:
        return points, members, np.arange(len(points))
    keys = np.ascontiguousarray(points).view(np.dtype((np.void, width))).ravel()
    _, first, place = np.unique(keys, return_index=True, return_inverse=True)
    added = np.zeros((len(first), members.shape[1]))
    np.add.at(added, place, members)
    return points[first], added, place


def _centre(points: np.ndarray) -> np.ndarray:
    finite = points[np.isfinite(points).all(axis=1)]
    return finite.mean(axis=0) if len(finite) else np.zeros(points.shape[1])


class _Side:
    """Points with what their distances need: factors of a product, and where it fails."""

    def __init__(self, points: np.ndarray, centre: np.ndarray):
        self.points, centred = points, points - centre
        squares = (centred**2).sum(axis=1)
        ones = np.ones(len(points))
        # The product of a left and a right factor is the squared distance.
        self.left = np.column_stack([-2 * centred, squares, ones])
        self.right = np.column_stack([centred, ones, squares])
        self.slack = CLOSE * squares + FAINT * (points**2).sum(axis=1)


def _distances(a: _Side, b: _Side, rows: slice, columns: slice) -> np.ndarray:
    """Euclidean distances by one matrix product. Close pairs, overflow and what is not finite
    are taken again from the differences, so no digits are lost."""
    apart = a.left[rows] @ b.right[columns].T
    # For most tiles two bounds show that there is no such pair; nan passes neither.
    if apart.min() > a.slack[rows].max() + b.slack[columns].max() and apart.max() < np.inf:
        return np.sqrt(apart, out=apart)
    slack = a.slack[rows, None] + b.slack[columns]
    near = ~((apart > slack) & (apart < np.inf))
    apart[near] = 0
    np.sqrt(apart, out=apart)
    left, right = np.nonzero(near)
    step = max(1, (1 << 18) // max(1, a.points.shape[1]))
    for at in range(0, len(left), step):
        i, j = left[at : at + step], right[at : at + step]
        apart[i, j] = np.sqrt(((a.points[rows][i] - b.points[columns][j]) ** 2).sum(axis=1))
    return apart


def _block_totals(
    a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per point of ``a`` the sums of its distances to the clusters' points in ``b``, and the
    other way round."""
    with np.errstate(invalid="ignore", over="ignore"):
        a, of_a, place_a = _distinct(a, of_a)
        b, of_b, place_b = _distinct(b, of_b)
        centre = _centre(a)
        left, right = _Side(a, centre), _Side(b, centre)
        to_b, to_a = np.zeros(of_a.shape), np.zeros(of_b.shape)
        for low in range(0, len(a), TILE_ROWS):
            rows = slice(low, low + TILE_ROWS)
            for start in range(0, len(b), TILE_COLUMNS):
                columns = slice(start, start + TILE_COLUMNS)
                apart = _distances(left, right, rows, columns)
                to_b[rows] += apart @ of_b[columns]
                to_a[columns] += apart.T @ of_a[rows]
    return to_b[place_a], to_a[place_b]


def _block_count(rows: int, dimension: int, block_rows: int) -> int:
    largest = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, dimension))))
    return max(1, math.ceil(rows / largest), min(MIN_BLOCKS, math.ceil(rows / MIN_BLOCK_ROWS)))


def cluster_totals(points: DataFrame, widths: list[int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, clusters, totals): per point the sums of its distances to the points of every cluster
    of every clustering, one after the other.

    ``points`` are (id, clusters array<int>, vector): clustering c has the ids 0 to
    ``widths[c]`` - 1. Every distance is taken once, for both its points and all clusterings:
    points are hashed into blocks, and a task gets two blocks, the first not after the second.
    No pair of points is ever a row, and a task's memory is bounded by the block size. Distances
    are matrix products: their number is quadratic, their price a few floating point operations.
    """
    offsets = np.cumsum([0, *widths])

    def members(frame: pd.DataFrame) -> np.ndarray:
        """Points by clusters: 1 where a point belongs to a cluster."""
        found = np.zeros((len(frame), offsets[-1]))
        ids = np.stack(frame["clusters"].to_numpy()).reshape(len(frame), -1)
        for c, low in enumerate(offsets[:-1].tolist()):
            found[np.arange(len(frame)), low + ids[:, c]] = 1
        return found

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["id", "clusters", "totals"]
        if left.empty or right.empty:
            return pd.DataFrame({name: [] for name in names})
        same = left["row_block"].iloc[0] == left["column_block"].iloc[0]
        a = np.stack(left["vector"].to_numpy()).astype("float64")
        b = np.stack(right["vector"].to_numpy()).astype("float64")
        to_b, to_a = _block_totals(a, members(left), b, members(right))
        both = [(left, to_b)] if same else [(left, to_b), (right, to_a)]
        return pd.concat([
            pd.DataFrame({"id": f["id"], "clusters": f["clusters"], "totals": list(t)})[names]
            for f, t in both
        ])

    element = points.schema["vector"].dataType.simpleString()
    vector = F.col("vector") if element == "array<float>" else F.col("vector").cast("array<double>")
    typed = points.select(
        "id", F.col("clusters").cast("array<int>"), vector.alias("vector")
    )
    kind = typed.schema["id"].dataType.simpleString()
    rows, dimension = typed.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    blocks = _block_count(rows, dimension or 0, block_rows)
    home = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    typed = typed.withColumn("_home", home)
    here = F.col("_home")
    onward = F.explode(F.sequence(here, F.lit(blocks - 1)))
    backward = F.explode(F.sequence(F.lit(0), here))
    left = typed.select("*", here.alias("row_block"), onward.alias("column_block"))
    right = typed.select("*", here.alias("column_block"), backward.alias("row_block"))
    pair = ("row_block", "column_block")
    # By number, for the work is in the pairs, not in the bytes that decide elsewhere.
    parts = min(blocks * (blocks + 1) // 2, MAX_PARTS)
    left, right = (side.repartition(parts, *pair) for side in (left, right))
    partial = (
        left.groupBy(*pair).cogroup(right.groupBy(*pair))
        .applyInPandas(sums, f"id {kind}, clusters array<int>, totals array<double>")
    )
    added = [F.sum(F.col("totals")[i]) for i in range(int(offsets[-1]))]
    return partial.groupBy("id", "clusters").agg(F.array(*added).alias("totals"))


def silhouettes(
    points: DataFrame, widths: list[int], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, clusters, silhouettes): exact Euclidean silhouettes of every point under several
    clusterings, from one pass over the distances. Points and ``widths`` as in
    ``cluster_totals``."""
    offsets = np.cumsum([0, *widths]).tolist()
    member = [
        F.sum((F.col("clusters")[c] == i).cast("bigint"))
        for c, width in enumerate(widths) for i in range(width)
    ]
    sizes = points.agg(F.array(*member).alias("sizes"))
    totals = cluster_totals(points, widths, block_rows).withColumn("sizes", sizes.scalar())
    found = []
    for c, low in enumerate(offsets[:-1]):
        own = F.col("clusters")[c]
        total = F.slice("totals", low + 1, widths[c])
        size = F.slice("sizes", low + 1, widths[c])
        within = F.try_divide(F.get(total, own), F.get(size, own) - 1)
        means = F.transform(total, lambda t, i: F.when(i != own, F.try_divide(t, F.get(size, i))))
        nearest = F.array_min(means)  # of clusters without points there is no mean
        worth = F.try_divide(nearest - within, F.greatest(nearest, within))
        found.append(F.when(within.isNull(), 0.0).otherwise(F.coalesce(worth, F.lit(0.0))))
    return totals.select("id", "clusters", F.array(*found).alias("silhouettes"))


def silhouette_samples(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact Euclidean silhouette per point of (id of any type, cluster int, vector array)."""
    names = [row[0] for row in points.select("cluster").distinct().orderBy("cluster").collect()]
    place = F.array_position(F.lit(names), F.col("cluster").cast("int")) - 1
    dense = points.select("id", F.array(place).alias("clusters"), "vector")
    found = silhouettes(dense, [max(1, len(names))], block_rows)
    own = F.get(F.lit(names), F.col("clusters")[0]) if names else F.lit(None).cast("int")
    return found.select("id", own.alias("cluster"), F.col("silhouettes")[0].alias("silhouette"))


def silhouette_exact(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: the mean exact Euclidean silhouette."""
    return silhouette_samples(points, block_rows).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_squared(points: DataFrame) -> float:
    """Mean silhouette under squared Euclidean distance, linear in the number of points.

    This is a different number from the Euclidean one.
    """
    vectors = points.select(
        F.col("cluster").cast("double").alias("prediction"),
        array_to_vector(F.col("vector").cast("array<double>")).alias("features"),
    )
    return ClusteringEvaluator().evaluate(vectors)
