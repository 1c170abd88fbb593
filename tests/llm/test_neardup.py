import random
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import AWKWARD, documents, sentence, words

from tickerloom.llm import components, neardup


def expected(rows, threshold=0.8, size=5):
    """doc_id, class, copies, links, group of each row, by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        w = words(text)
        grams = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
        sets.append(grams if doc_id is not None else set())
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both >= threshold * (len(a) + len(sets[j]) - both) - 1e-9:
                near[i].add(j)
                near[j].add(i)
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        same = [j for j in near[i] if sets[j] == sets[i]]
        yield (
            doc_id, min([doc_id, *(rows[j][0] for j in same)]) if same else doc_id, len(same),
            len(near[i]), min(rows[j][0] for j in seen) if doc_id is not None else None,
        )


def variants(seed, base, n):
    """Texts with one or a few words of a base text changed."""
    draw = random.Random(seed)
    for k in range(n):
        w = base.split()
        for _ in range(draw.randint(0, 4)):
            w[draw.randrange(len(w))] = f"v{seed}_{k}_{draw.random()}"
        yield " ".join(w)


def corpus():
    texts = [sentence(300 * k, 120) for k in range(20)]
    texts += [t for k in range(4) for t in variants(k, sentence(50_000 * (k + 1), 150), 40)]
    texts += [sentence(9_000_000, 80)] * 30
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("part", [8, 1024])
def test_links_and_groups_match_all_pairs(spark, part):
    rows = [*corpus(), *[(1000 + i if i else None, t) for i, t in AWKWARD]]
    found = neardup.link_counts(documents(spark, rows).repartition(4), part=part).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)


def test_one_document_of_each_group_stays(spark):
    rows = corpus() + [(7, dict(corpus())[7]), (None, "no id")]
    docs = documents(spark, rows)
    kept = neardup.drop_near_duplicates(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    groups = {r[4] for r in expected(corpus())}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [*groups, None]))


def test_empty_table(spark):
    docs = documents(spark, [])
    assert neardup.link_counts(docs).count() == 0
    assert neardup.drop_near_duplicates(docs).count() == 0


def test_the_band_plan_reaches_the_recall():
    for threshold, recall, rows in ((0.8, 0.9999, 4), (0.5, 0.99, 3), (0.9, 0.999, 8)):
        bands = neardup.band_plan(threshold, recall, rows)
        assert 1 - (1 - threshold**rows) ** bands >= recall
        assert bands == 1 or 1 - (1 - threshold**rows) ** (bands - 1) < recall


def test_signatures_find_pairs_at_the_threshold():
    """Measured recall of the banding alone, at a similarity of 0.8."""
    family, missed = neardup._family(18 * 4), 0
    for seed in range(300):
        draw = np.random.default_rng(seed)
        both = draw.integers(0, 2**63, 160, dtype=np.uint64)
        rest = draw.integers(0, 2**63, 40, dtype=np.uint64)
        a, b = (
            neardup.band_hashes(np.sort(np.concatenate([both, own])), 18, 4, family)
            for own in (rest[:20], rest[20:])
        )
        missed += not (a == b).any()
    assert missed <= 1


def test_shared_counts_of_frequent_and_rare_shingles():
    draw = np.random.default_rng(0)
    common = np.arange(50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common[draw.random(50) < 0.9],
                                      draw.integers(100, 160, 20, dtype=np.uint64)]))
            for _ in range(40)]
    shared = neardup.shared_counts(sets)
    for i in range(40):
        for j in range(40):
            assert i == j or shared[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_parts_travel_packed():
    draw = np.random.default_rng(2)
    grams = [np.unique(draw.integers(0, 90, n, dtype=np.uint64)) for n in (40, 1, 77)]
    part = neardup._Part([5, 2**40, 7], [1, 9, 2], draw.integers(-9, 9, (3, 4)), grams)
    again = neardup._Part.unpack(part.pack())
    assert again.classes.tolist() == [5, 2**40, 7] and again.n_docs.tolist() == [1, 9, 2]
    assert (again.bands == part.bands).all()
    assert [g.tolist() for g in again.grams] == [g.tolist() for g in grams]


def test_buckets_with_equal_members_are_checked_once(spark):
    """Twenty copies but for one word, alone in the table: they share whole bands."""
    rows = [(i, f"{sentence(0, 400)} end{i}") for i in range(20)]
    docs = documents(spark, rows)
    signed = neardup.sign(docs, 5, 18, 4)
    classes = signed.select(signed.doc_id.alias("class"), "n_shingles", "bands")
    buckets = neardup._buckets(classes, 1024)
    most = classes.count() * 18
    assert 20 <= buckets.count() < most / 2
    assert sorted(map(str, neardup.link_counts(docs).collect())) == sorted(
        map(str, neardup.link_counts(docs, part=3).collect())
    )


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(100, 101), (101, 102)],
    [(5, 5)], [(9, 3), (3, 9), (9, 7), (2, 1)],
])
def test_components(spark, edges):
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    label = {}
    for a, b in edges:
        if a != b:
            label.setdefault(a, a)
            label.setdefault(b, b)
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {r["id"]: r["component"] for r in found.collect()} == label
