import math

import numpy as np
import pytest

from tickerloom.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int, key string, cell string, class string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", "c", "x") for i, v in rows], SCHEMA)


def usable(row):
    i, v = row
    return (
        i is not None and v and None not in v and all(map(math.isfinite, v))
        and any(x != 0 for x in v)
    )


def expected(rows, threshold=0.9):
    able = [r for r in rows if usable(r)]
    links = [set() for _ in able]
    for a, (_, x) in enumerate(able):
        for b in range(a):
            y = able[b][1]
            if len(x) == len(y):
                p, q = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                p, q = p / np.abs(p).max(), q / np.abs(q).max()
                if p @ q / math.sqrt((p @ p) * (q @ q)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    found = [(i, 0, i, True) for i, v in rows if not usable((i, v))]
    for a, (i, _) in enumerate(able):
        seen, todo = {a}, [a]
        while todo:
            more = links[todo.pop()] - seen
            seen |= more
            todo += more
        low = min(able[b][0] for b in seen)
        found.append((i, len(links[a]), low, low == i))
    return found


def vectors(kind, seed=0):
    draw = np.random.default_rng(seed)
    if kind == "clusters":
        centers = draw.normal(size=(12, 8))
        points = centers[draw.integers(0, 12, 400)] + draw.normal(size=(400, 8)) * 0.25
    elif kind == "line":
        angle = np.linspace(0, 3, 300)
        points = np.stack([np.cos(angle), np.sin(angle)], 1)
    elif kind == "hot":
        points = draw.normal(size=8) + draw.normal(size=(400, 8)) * 0.02
    else:
        points = draw.normal(size=(400, 24))
    order = draw.permutation(len(points))
    return [(int(i), [float(x) for x in points[k]]) for k, i in enumerate(order)]


@pytest.mark.parametrize("kind", ["clusters", "line", "hot", "random"])
@pytest.mark.parametrize("sizes", [{}, {"cell_points": 50, "pivots": 6}])
def test_all_pairs_are_found(spark, monkeypatch, kind, sizes):
    rows = vectors(kind)
    rows += [(1000 + k, rows[k][1]) for k in range(40)]
    found = covertree.link_counts(table(spark, rows).repartition(3), **sizes).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows))


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0]),
        (10, [-1.0, 0.0]), (11, [1.0, -0.0]), (12, [1e-38, 1e-38]), (13, [3e38, 3e38]),
        (14, [0.9, math.sqrt(1 - 0.81)]), (None, [1.0, 0.0]), (15, [5.0]),
    ]
    found = covertree.link_counts(table(spark, rows)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)
    assert covertree.link_counts(table(spark, [])).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"cell_points": 20, "pivots": 2}])
def test_every_length_is_compared(spark, sizes):
    """More lengths than pivots, each with near pairs."""
    draw = np.random.default_rng(6)
    rows = []
    for length in range(2, 9):
        centers = draw.normal(size=(4, length))
        points = centers[draw.integers(0, 4, 30)] + draw.normal(size=(30, length)) * 0.1
        rows += [(100 * length + i, [float(x) for x in p]) for i, p in enumerate(points)]
    found = covertree.link_counts(table(spark, rows).repartition(3), **sizes).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows))


def test_a_tree_covers_its_points():
    draw = np.random.default_rng(4)
    unit = draw.normal(size=(20, 6))[draw.integers(0, 20, 3000)] + draw.normal(size=(3000, 6)) * 0.1
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    root = covertree.grow(unit, np.arange(3000), leaf=16)
    assert root.children
    todo = [root]
    while todo:
        node = todo.pop()
        assert (covertree._chords(unit[node.points], node.center) <= node.radius + 1e-9).all()
        if node.children:
            joined = np.sort(np.concatenate([c.points for c in node.children]))
            assert (joined == np.sort(node.points)).all()
            half = 2.0 ** (math.ceil(math.log2(node.radius)) - 1)
            assert all(c.radius <= half + 1e-9 for c in node.children)
            todo += node.children
    reached = sum(
        len(a) * (len(a) - 1) // 2 if same else len(a) * len(b)
        for a, b, same in covertree.leaf_pairs(root, root, 0.2)
    )
    assert reached < 3000 * 2999 // 4  # most pairs are pruned


def test_a_net_is_spread_and_covers():
    draw = np.random.default_rng(5)
    unit = draw.normal(size=(500, 3))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    chosen = unit[covertree.net(unit, 0.5)]
    gaps = np.sqrt(np.maximum(2 - 2 * chosen @ chosen.T, 0)) + 9 * np.eye(len(chosen))
    assert gaps.min() > 0.5
    assert np.sqrt(np.maximum(2 - 2 * unit @ chosen.T, 0)).min(1).max() <= 0.5 + 1e-9
