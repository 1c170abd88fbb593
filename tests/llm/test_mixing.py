from collections import Counter

import pytest

from llm_fixtures import AWKWARD, documents, sentence, words
from tickerloom.llm import mixing


def water_filling(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Share by weight, stop at the cap, share what is left among the rest, and so on."""
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    targets, free = {}, set(names)
    while free:
        left = share * sum(sizes.values()) - sum(targets.values())
        level = left / sum(weight[n] for n in free)
        over = {n for n in free if level * weight[n] > cap * sizes[n]}
        if not over:
            targets |= {n: level * weight[n] for n in free}
            break
        targets |= {n: cap * sizes[n] for n in over}
        free -= over
    return targets


def rows_of(report):
    return [r.asDict() for r in report.collect()]


def test_targets_follow_the_weights_and_stop_at_the_cap(spark):
    lengths = {"b": 40, "a": 2000, "é": 300, "Z": 10, None: 700, "empty": 0}
    docs = documents(spark, [(i, sentence(0, n), s) for i, (s, n) in enumerate(lengths.items())])
    sized = mixing.sized_documents(docs)
    found = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert found == pytest.approx(water_filling(lengths))


def test_every_source_comes_near_its_target(spark):
    rows = [
        (i, sentence(i, 3 + i * i % 97), None if i % 7 == 0 else "hot" if i % 3 else f"s{i % 5}")
        for i in range(900)
    ]
    found = rows_of(mixing.mix_report(documents(spark, rows).repartition(5)))
    assert sorted(r["doc_id"] for r in found) == list(range(900))
    sizes = Counter()
    for doc_id, text, source in rows:
        sizes[source] += len(words(text))
    targets = water_filling(sizes)
    taken = Counter()
    for r in found:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] += r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * 100  # the largest document, both edges
    again = rows_of(mixing.mix_report(documents(spark, rows).repartition(2)))
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_the_mix_repeats_whole_rows(spark):
    docs = documents(spark, [(i, sentence(i, 5 + i), f"s{i % 3}") for i in range(60)])
    report = {r["doc_id"]: r["copies"] for r in rows_of(mixing.mix_report(docs))}
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(
        {k: n for k, n in report.items() if n}
    )


def test_awkward_rows(spark):
    found = rows_of(mixing.mix_report(documents(spark, AWKWARD)))
    assert len(found) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[2]["size"] == by_id[3]["size"] == by_id[4]["size"] == 0
    assert by_id[9]["size"] == 6000
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in found)


def test_empty_tables_and_sources_without_words(spark):
    assert mixing.mix_report(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).count() == 0
    nothing = rows_of(mixing.mix_report(documents(spark, [(1, None), (2, "")])))
    assert [(r["target"], r["copies"]) for r in nothing] == [(0.0, 0), (0.0, 0)]
