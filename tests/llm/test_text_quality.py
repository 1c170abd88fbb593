import random
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import AWKWARD, SCHEMA, documents, words

from tickerloom.llm import quality

VOCABULARY = [f"{a}{b}{c}" for a in ("th", "an", "er", "st") for b in "aeiou" for c in ("n", "rd", "s")]


def prose(seed, n):
    draw = random.Random(seed)
    parts = [draw.choice(VOCABULARY) + draw.choice(["", "", "ing", "ed", "ly"]) for _ in range(n)]
    return "\n".join(" ".join(parts[i : i + 40]) + "." for i in range(0, n, 40))


def counts(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(words(line)) and line in seen
        seen.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, repeated, len(covered), failed


def corpus():
    rows = [(i, prose(i, 30 + 7 * i % 900)) for i in range(200)]
    rows += [(500 + i, prose(i, 300).replace(" ", "### ")) for i in range(8)]
    rows += [(600 + i, "\n".join(["the same line of words again and again"] * 30)) for i in range(4)]
    return rows + [(700 + i if i else None, t) for i, t in AWKWARD]


def test_counts_and_base_rules(spark):
    rows = corpus()
    found = quality.quality_report(documents(spark, rows).repartition(4)).collect()
    key = lambda r: str(tuple(r))
    shown = [(r["doc_id"], *(r[c] for c in quality.COUNTS), r["base_failed"]) for r in found]
    assert sorted(shown, key=key) == sorted(((i, *counts(t)) for i, t in rows), key=key)
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_outliers_go_and_clean_documents_stay(spark):
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(documents(spark, corpus())).collect()}
    assert all(kept[i] for i in range(200) if len(words(prose(i, 30 + 7 * i % 900))) >= 10)
    assert not any(kept[500 + i] for i in range(8))


def test_groups_are_judged_by_themselves(spark):
    """Texts that are odd in one source are usual in another."""
    rows = [(i, prose(i, 200), "plain") for i in range(80)]
    rows += [(100 + i, prose(i, 200).replace(" ", " #"), "marked") for i in range(80)]
    rows += [(200, prose(1, 200).replace(" ", " #"), "plain"), (201, prose(2, 200), None)]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(documents(spark, rows)).collect()}
    assert all(kept[i] for i in [*range(80), *range(100, 180), 201]) and not kept[200]


def test_estimates_match_a_plain_version(spark):
    """Concentration steps in NumPy, with the same bins and floor."""
    draw = np.random.default_rng(0)
    x = draw.normal([1.6, 0.1, 0.2, 0.3], [0.2, 0.05, 0.1, 0.1], (400, 4))
    x[:60] += 3
    rows = spark.createDataFrame(
        [("en", None, *map(float, r)) for r in x], "lang string, source string, x1 double, x2 double, x3 double, x4 double"
    )
    fit = quality.fit_groups(rows, quality.KEYS, steps=40).collect()
    assert len(fit) == 1
    floor = np.diag(np.square(quality.FLOOR_SCALE))
    inverse = np.linalg.inv(floor)
    center = np.sort(x, axis=0)[(len(x) - 1) // 2]  # a row's own value, as the operator starts
    cut = quality.chi2_quantile(1 - quality.SUPPORT, 4)
    scale = quality.SUPPORT / (1 - quality.chi2_tail(cut, 6))
    now = np.inf
    for _ in range(40):
        gap = x - center
        distance = np.einsum("ij,jk,ik->i", gap, inverse, gap)
        bins = np.floor(np.log2(distance + 2.0**-20) * 8)
        smaller = (bins[:, None] > bins[None, :]).sum(1)
        near = x[smaller < quality.SUPPORT * len(x)]
        center = near.mean(0)
        spread = np.cov(near.T, bias=True)
        inverse = np.linalg.inv(scale * spread + floor)
        before, now = now, np.linalg.slogdet(scale * spread + floor)[1]
        if before - now < 1e-6:  # bins are coarse, so a step may also not improve
            break
    assert fit[0]["center"] == pytest.approx(center.tolist(), abs=1e-2)
    assert np.array(fit[0]["inverse"]).reshape(4, 4) == pytest.approx(inverse, rel=0.1, abs=1.0)
    assert np.abs(np.array(fit[0]["center"]) - [1.6, 0.1, 0.2, 0.3]).max() < 0.1


def test_filter_keeps_whole_rows(spark):
    docs = documents(spark, corpus())
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    report = quality.quality_report(docs).filter("kept").select("doc_id").collect()
    key = lambda r: str(r["doc_id"])
    assert sorted(map(key, kept.collect())) == sorted(map(key, report))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.quality_report(empty).count() == 0 and quality.keep_good(empty).count() == 0
    only = documents(spark, [(1, None), (2, "too few words")])
    assert [r["kept"] for r in quality.quality_report(only).collect()] == [False, False]


def test_chi_square():
    assert quality.chi2_tail(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert quality.chi2_quantile(0.01, 4) == pytest.approx(13.276704, abs=1e-5)
