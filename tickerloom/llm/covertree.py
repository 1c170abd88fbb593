"""Exact embedding near-duplicates by dual traversal of cover trees.

Vectors are compared on the unit sphere: cosine >= threshold means a chord of at most
sqrt(2 - 2 * threshold).

1. Equal vectors form a class; one vector per class goes on.
2. The top level of the tree is a net of at most ``pivots`` vectors (a bounded, hashed choice).
   Every vector joins its nearest pivot's cell, and a cell's covering radius is the largest
   distance in it. Two cells are compared only if their centers are no farther apart than both
   radii and the chord. A vector length without a pivot is a cell of its own. Cells of more than ``cell_points`` vectors are split into parts, so a
   cell may hold any share of the rows.
3. A task gets two parts, grows a cover tree on each (levels with halving radii, every point
   within its node's radius), and walks pairs of nodes from the roots: a pair is pruned by the
   same bound, else its wider node is opened, and two leaves are compared point by point.
   A node that falls apart into nearly as many children as points has no structure to use and
   stays a leaf.
4. A task returns per class its number of linked vectors and the smallest id of its linked
   neighbourhood; counts add up, neighbourhoods become components.

Leaves are multiplied in single precision; what lies within its rounding of the threshold is
decided in double precision. Pruning is exact, so no pair is lost; on vectors without any
structure all pairs of parts remain, which is quadratic work in blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, as do vectors of another length and rows without an id; equal rows are separate vectors
of one class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize, task_count
from tickerloom.llm.components import components

THRESHOLD = 0.9
PIVOTS = 1024
CELL_POINTS = 4096
LEAF = 256
BLOCK = 1024

CHECKED = "vec_id long, key binary, vector binary"
CELLS = "class long, n_vecs long, vector binary, cell int, distance double"
FOUND = "class long, links long, root long"

_MARGIN = 1e-3  # on distances, far above the rounding of single precision


# --- vectors ------------------------------------------------------------------------------------


def _checked(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, vector): doubles as bytes, null where nothing can be compared."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raws = [], []
            for value in batch.column("vector"):
                found = value.as_py()
                usable = bool(found) and None not in found
                row = np.array(found if usable else [], "<f8")
                norm = math.sqrt(float(row @ row)) if usable else 0.0
                if not (usable and np.isfinite(row).all() and norm > 0):
                    keys.append(None)
                    raws.append(None)
                    continue
                if not math.isfinite(norm) or norm < 1e-150:  # out of the range of a square
                    row = row / np.abs(row).max()
                row = row + 0.0  # -0.0 is 0.0
                raws.append(row.tobytes())
                keys.append(hashlib.md5(raws[-1]).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())],
                ["vec_id", "key", "vector"],
            )

    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return materialize(rows.mapInArrow(run, CHECKED), "vectors")


def _units(raws: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(raws), "<f8").reshape(len(raws), -1)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _chords(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (points @ center), 0))


def net(points: np.ndarray, radius: float) -> np.ndarray:
    """Places of points that are farther than ``radius`` apart and within it of all others."""
    left, chosen = np.arange(len(points)), []
    while len(left):
        chosen.append(left[0])
        left = left[_chords(points[left], points[left[0]]) > radius]
    return np.array(chosen, np.int64)


# --- the local trees ----------------------------------------------------------------------------


@dataclass
class Node:
    points: np.ndarray  # places in the part
    center: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def grow(unit: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree over some points: a node's children lie within half its level's radius."""
    center = unit[points[0]]
    radius = float(_chords(unit[points], center).max())
    node = Node(points, center, radius)
    if len(points) <= leaf or radius < _MARGIN:
        return node
    half = 2.0 ** (math.ceil(math.log2(radius)) - 1)
    left, groups = points, []
    while len(left):
        near = _chords(unit[left], unit[left[0]]) <= half
        groups.append(left[near])
        left = left[~near]
        if len(groups) > 8 + len(points) // 16:
            return node
    if len(groups) > 1:
        node.children = [grow(unit, g, leaf) for g in groups]
    return node


def leaf_pairs(
    a: Node, b: Node, chord: float
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Leaves that may hold a pair within ``chord``; the flag marks a leaf against itself."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if a is b:
            if not a.children:
                yield a.points, a.points, True
                continue
            for i, child in enumerate(a.children):
                todo += [(child, other) for other in a.children[i:]]
            continue
        gap = math.sqrt(max(0.0, 2 - 2 * float(a.center @ b.center)))
        if gap > a.radius + b.radius + chord + _MARGIN:
            continue
        if not a.children and not b.children:
            yield a.points, b.points, False
        elif a.children and (not b.children or a.radius >= b.radius):
            todo += [(child, b) for child in a.children]
        else:
            todo += [(a, child) for child in b.children]


def _links(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y reach the threshold; doubles decide what singles cannot."""
    rough = x.astype(np.float32) @ y.astype(np.float32).T
    slack = 4e-7 * x.shape[1] + 1e-6
    linked = rough >= threshold
    close = np.abs(rough - threshold) <= slack
    if close.any():
        i, j = np.nonzero(close)
        linked[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
    return linked


class _Part:
    """Classes of one side of a tile: ids, copies, unit vectors, labels and link counts."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, unit: np.ndarray):
        self.ids, self.copies, self.unit = ids, copies, unit
        self.labels, self.links = ids.copy(), np.zeros(len(ids), np.int64)
        self.tree = grow(unit, np.arange(len(ids)))


def compare(a: _Part, b: _Part, threshold: float) -> None:
    """Add the links between two parts (or within one) and lower labels to the smallest id."""
    found = []
    for p, q, same in leaf_pairs(a.tree, b.tree, math.sqrt(2 - 2 * threshold)):
        for i in range(0, len(p), BLOCK):
            for j in range(i if same else 0, len(q), BLOCK):
                u, v = p[i : i + BLOCK], q[j : j + BLOCK]
                linked = _links(a.unit[u], b.unit[v], threshold)
                if same and i == j:
                    linked = np.triu(linked, 1)
                if linked.any():
                    some, other = linked.any(1), linked.any(0)
                    found.append((u[some], v[other], linked[some][:, other]))
    for u, v, linked in found:
        a.links[u] += linked @ b.copies[v]
        b.links[v] += linked.T @ a.copies[u]
    moved, most = True, np.iinfo(np.int64).max
    while moved:
        moved = False
        for u, v, linked in found:
            for own, mine, other, theirs, m in ((a, u, b, v, linked), (b, v, a, u, linked.T)):
                reach = np.where(m, other.labels[theirs][None, :], most).min(1)
                lower = reach < own.labels[mine]
                if lower.any():
                    own.labels[mine[lower]] = reach[lower]
                    moved = True


def _part(rows: pa.Table) -> _Part:
    return _Part(
        rows.column("class").to_numpy(), rows.column("n_vecs").to_numpy(),
        _units(rows.column("vector").to_pylist()),
    )


def _compare_tile(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        parts = [_part(group.filter(pa.array(side == s))) for s in (0, 1) if (side == s).any()]
        within = group.column("within")[0].as_py()
        if within:
            compare(parts[0], parts[0], threshold)
        elif len(parts) == 2:
            compare(parts[0], parts[1], threshold)
        columns = [np.concatenate([getattr(p, f) for p in parts]) for f in ("ids", "links", "labels")]
        linked = columns[1] > 0
        return pa.Table.from_arrays(
            [pa.array(c[linked], pa.int64()) for c in columns], ["class", "links", "root"]
        )

    return run


# --- the top level --------------------------------------------------------------------------------


def _choose_pivots(classes: DataFrame, pivots: int, spacing: float) -> dict[int, np.ndarray]:
    """By vector length: a net among at most ``pivots`` hashed vectors and the first vectors of
    ``pivots`` lengths. Further lengths have none."""
    size = F.length("vector")
    chosen = (
        classes.orderBy(F.xxhash64("key"), "key").limit(pivots).select("vector").collect()
    )
    firsts = classes.groupBy(size.alias("n")).agg(F.min("vector").alias("vector"))
    rows = [bytes(r["vector"]) for r in chosen]
    rows += [bytes(r["vector"]) for r in firsts.orderBy("n").limit(pivots).collect()]
    by_size: dict[int, list[bytes]] = {}
    for raw in rows:
        by_size.setdefault(len(raw), []).append(raw)
    nets = {}
    for length, raws in by_size.items():
        unit = _units(raws)
        nets[length] = unit[net(unit, spacing)]
    return nets


def _lone_cells(classes: DataFrame, nets: dict[int, np.ndarray]) -> dict[int, int]:
    """By vector length without a pivot: its one cell, numbered after the pivots."""
    total = sum(map(len, nets.values()))
    lengths = [r["n"] for r in classes.select(F.length("vector").alias("n")).distinct().collect()]
    return {n: total + i for i, n in enumerate(sorted(set(lengths) - set(nets)))}


def _cells(classes: DataFrame, nets: dict[int, np.ndarray], lone: dict[int, int]) -> DataFrame:
    """Every class with its nearest pivot (numbered over all lengths) and the distance, or the
    cell of its length."""
    offsets, total = {}, 0
    for length, pivots in nets.items():
        offsets[length] = total
        total += len(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("vector").to_pylist()
            cell = np.array([lone.get(len(r), -1) for r in raws], np.int32)
            distance = np.zeros(len(raws))
            lengths = np.array([len(r) for r in raws], np.int64)
            for length in set(lengths.tolist()) & set(nets):
                at = np.flatnonzero(lengths == length)
                for low in range(0, len(at), BLOCK):
                    some = at[low : low + BLOCK]
                    cosine = _units([raws[i] for i in some]) @ nets[length].T
                    nearest = cosine.argmax(1)
                    cell[some] = nearest + offsets[length]
                    best = cosine[np.arange(len(some)), nearest]
                    distance[some] = np.sqrt(np.maximum(2 - 2 * best, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("n_vecs"), batch.column("vector"),
                 pa.array(cell), pa.array(distance)],
                ["class", "n_vecs", "vector", "cell", "distance"],
            )

    rows = classes.select("class", "n_vecs", "vector")
    return materialize(rows.mapInArrow(run, CELLS), "cells")


def _near_cells(
    nets: dict[int, np.ndarray], radii: dict[int, float], chord: float
) -> list[tuple[int, int]]:
    """Pairs of cells (both ways, and each with itself) that the bound cannot separate; at most
    the square of the number of pivots."""
    found, total = [], 0
    for pivots in nets.values():
        gaps = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T), 0))
        radius = np.array([radii.get(total + i, -np.inf) for i in range(len(pivots))])
        near = gaps <= radius[:, None] + radius[None, :] + chord + _MARGIN
        found += [(int(i) + total, int(j) + total) for i, j in zip(*np.nonzero(near))]
        total += len(pivots)
    return found


def link_counts(
    vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS,
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    spark, chord = vectors.sparkSession, math.sqrt(2 - 2 * threshold)
    checked = _checked(vectors)
    able = checked.filter("vector IS NOT NULL AND vec_id IS NOT NULL")
    classes = able.groupBy("key", "vector").agg(
        F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("n_vecs")
    )
    classes = materialize(classes, "vector-classes")
    wanted = max(1, min(pivots, -(-classes.count() // cell_points)))
    nets = _choose_pivots(classes, wanted, chord / 2)
    lone = _lone_cells(classes, nets)
    cells = _cells(classes, nets, lone)
    sizes = cells.groupBy("cell").agg(
        F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")
    ).collect()  # at most one row per pivot and vector length
    near = _near_cells(nets, {r["cell"]: r["radius"] for r in sizes}, chord)
    near += [(cell, cell) for cell in lone.values()]
    parts = {r["cell"]: -(-r["n"] // cell_points) for r in sizes}
    plan = spark.createDataFrame(
        [(a, b, parts[a], parts[b]) for a, b in near], "cell int, _to int, _own int, _there int"
    )
    placed = cells.join(F.broadcast(plan), "cell")  # at most pivots squared rows of 16 bytes
    placed = placed.withColumns({
        "_part": F.pmod(F.xxhash64("class"), F.col("_own")).cast("int"),
        "_other": F.explode(F.sequence(F.lit(0), F.col("_there") - 1)),
    })
    here = F.struct(F.col("cell").alias("c"), F.col("_part").alias("p"))
    there = F.struct(F.col("_to").alias("c"), F.col("_other").alias("p"))
    tiles = placed.select(
        F.least(here, there).alias("low"), F.greatest(here, there).alias("high"),
        (here > there).cast("int").alias("side"), (here == there).alias("within"),
        "class", "n_vecs", "vector",
    )
    found = (
        tiles.repartition(task_count(spark), "low", "high").groupBy("low", "high")
        .applyInArrow(_compare_tile(threshold), FOUND)
    )
    found = materialize(found, "vector-links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("key", "class", "n_vecs").join(links, "class", "left")
        .join(groups.withColumnRenamed("id", "class"), "class", "left")
    )
    joined = checked.drop("vector").join(known, "key", "left")
    alone = F.col("class").isNull() | F.col("vec_id").isNull()
    count = F.coalesce("links", F.lit(0)) + F.col("n_vecs") - 1
    component = F.when(alone, F.col("vec_id")).otherwise(F.coalesce("component", "class"))
    return joined.select(
        "vec_id", F.when(alone, F.lit(0)).otherwise(count).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
