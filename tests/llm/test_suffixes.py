import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import AWKWARD, documents
from tickerloom.llm import suffixes


def brute_force(rows, length):
    """Per row: (doc_id, n_bytes, n_removed, n_spans, sha256 of what stays)."""
    raws = [(text or "").encode() for _, text, *_ in rows]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    found = []
    for (doc_id, *_), raw in zip(rows, raws):
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not before for before, g in zip([False, *gone], gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        found.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def digest(spark, rows, parts=3, **rules):
    found = suffixes.find_long_repeats(documents(spark, rows).repartition(parts), **rules)
    return sorted(map(tuple, suffixes.long_repeat_digest(found).collect()), key=str)


def texts(seed, n, letters, passages=()):
    draw = random.Random(seed)
    for i in range(n):
        text = "".join(draw.choices(letters, k=draw.randrange(0, 160)))
        for passage in draw.sample(passages, draw.randrange(0, min(2, len(passages)) + 1)):
            at = draw.randrange(len(text) + 1)
            text = text[:at] + passage + text[at:]
        yield i, text


@pytest.mark.parametrize("letters", ["ab", "aab é", "abcdefghij \n漢"])
def test_suffixes_come_in_order(letters):
    draw = random.Random(len(letters))
    parts = ["".join(draw.choices(letters, k=draw.randrange(12, 60))).encode() for _ in range(40)]
    raw = b"\xff".join([*parts, b""])
    sizes = np.array([len(p) + 1 for p in parts])
    firsts = np.cumsum(sizes) - sizes
    ends = firsts + sizes - 1 - 9  # suffixes with ten bytes at least
    order = suffixes.sort_suffixes(raw, firsts, ends, 10)
    places = [i for a, b in zip(firsts, ends) for i in range(a, b)]
    assert sorted(order.tolist()) == places
    keys = [raw[i : i + 10] for i in order.tolist()]
    assert keys == sorted(keys)
    shared = suffixes.common_prefixes(raw, order, 10)
    for k in range(1, len(keys)):
        same = next((n for n in range(10) if keys[k][n] != keys[k - 1][n]), 10)
        assert shared[k] == same


def test_larger_suffixes_are_induced():
    """Only suffixes smaller than their successor are compared as strings."""
    text = np.frombuffer(b"banana\xff", np.uint8)
    assert suffixes.smaller_than_next(text).tolist() == [
        False, True, False, True, False, True, False
    ]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh é"])
@pytest.mark.parametrize("rules", [{}, {"hot_segments": 2}, {"shard_bytes": 1}])
def test_equals_brute_force(spark, letters, rules):
    draw = random.Random(3)
    passages = ["".join(draw.choices("klmnop ", k=n)) for n in (19, 20, 25, 60)]
    rows = list(texts(5, 60, letters, passages)) + [(60, passages[3] * 2), (61, passages[1])]
    assert digest(spark, rows, length=20, **rules) == brute_force(rows, 20)


def test_small_chunks_and_pieces_do_not_matter(spark, monkeypatch):
    rows = list(texts(9, 30, "abc", ["x" * 90, "pqrstuvw" * 8]))
    monkeypatch.setattr(suffixes, "STRIDE", 32)
    assert digest(spark, rows, parts=7, length=20) == brute_force(rows, 20)


def test_production_length_and_long_texts(spark):
    draw = random.Random(1)
    passage = "".join(draw.choices("abcdefghij klmno", k=450))
    long = "".join(draw.choices("abcdefghij klmnoé", k=120_000))
    rows = [
        (1, "q" * 199), (2, "q" * 199), (3, "z" * 3000), (4, f"one {passage} two"),
        (5, f"three {passage[:330]}"), (6, long), (7, long[:90_000] + passage), (8, passage[1:200]),
    ]
    assert digest(spark, rows) == brute_force(rows, 200)


def test_a_passage_that_most_documents_share(spark):
    draw = random.Random(4)
    passage = "".join(draw.choices("stuvwxyz", k=45))
    rows = [
        (i, "".join(draw.choices("abcdefgh", k=60)) + passage + "".join(draw.choices("ijkl", k=60)))
        for i in range(120)
    ]
    expected = brute_force(rows, 40)
    assert digest(spark, rows, length=40) == expected
    assert digest(spark, rows, length=40, hot_segments=3) == expected
    assert all(45 <= row[2] < 70 for row in expected)


def test_awkward_rows(spark):
    assert digest(spark, AWKWARD, length=10) == brute_force(AWKWARD, 10)
    assert digest(spark, AWKWARD) == brute_force(AWKWARD, 200)


def test_spans_and_kept_bytes(spark):
    rows = [(1, "0123456789abcdef"), (2, "xx0123456789yy")]
    found = suffixes.find_long_repeats(documents(spark, rows), length=8).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r["removed"]] for r in found] == [[(0, 10)], [(2, 12)]]
    assert [bytes(r["kept"]) for r in found] == [b"abcdef", b"xxyy"]


def test_empty_table(spark):
    assert digest(spark, []) == []
