import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_fixtures import AWKWARD, documents, sentence
from tickerloom.llm import importance
from tickerloom.llm.ngram_table import NgramTable, _lanes, crc_stretches, hash_stretches

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = WORD.findall(lowered)
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), grams


def brute_force(rows, target, buckets=10_000, percent=5):
    each = [features(text) for _, text, *_ in rows]
    crc = lambda gram: zlib.crc32(gram.encode()) % buckets
    s = Counter(crc(g) for _, grams in each for g in grams)
    t = Counter(crc(g) for _, text, *_ in target for g in features(text)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    found = []
    for (doc_id, *_), (n_words, grams) in zip(rows, each):
        weight = sum(gain(crc(g)) for g in grams)
        name = f"42:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        found.append([doc_id, len(grams), weight, weight + noise, n_words >= 20])
    able = sorted((r for r in found if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able, 1):
        row[4] = rank if rank <= len(able) * percent // 100 else None
    return sorted(((*r[:4], r[4] or None) for r in found), key=str)


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "γάμμα", "d-e", "x9", "naïve", "the", "of", "zeta.", "don't"]
    return [(i, " ".join(draw.choices(words, k=draw.randrange(0, 60)))) for i in range(n)]


def test_hashes_are_xxhash64():
    draw = random.Random(0)
    buffer = bytes(draw.randrange(256) for _ in range(3000))
    starts = np.array([draw.randrange(2900) for _ in range(900)])
    lengths = np.array([draw.randrange(0, 90) for _ in range(900)])
    found = hash_stretches(buffer, _lanes(buffer), starts, lengths)
    assert found.tolist() == [
        xxhash.xxh64_intdigest(buffer[a : a + n]) for a, n in zip(starts, lengths)
    ]


def test_checksums_are_crc32_in_few_calls(monkeypatch):
    """One call a length, not one a stretch."""
    draw = random.Random(0)
    buffer = bytes(draw.randrange(256) for _ in range(3000))
    starts = np.array([draw.randrange(2900) for _ in range(900)])
    lengths = np.array([draw.randrange(0, 90) if i % 9 == 0 else i % 32 for i in range(900)])
    expected = [zlib.crc32(buffer[a : a + n]) for a, n in zip(starts, lengths)]
    calls, once = [], zlib.crc32
    monkeypatch.setattr(zlib, "crc32", lambda data: calls.append(len(data)) or once(data))
    assert crc_stretches(buffer, _lanes(buffer), starts, lengths).tolist() == expected
    assert len(calls) == (lengths > 31).sum() and min(calls) > 31
    assert crc_stretches(b"", _lanes(b""), starts[:0], lengths[:0]).tolist() == []


@pytest.mark.parametrize("collide", [False, True])
def test_a_table_tells_stretches_apart_by_bytes(monkeypatch, collide):
    if collide:  # every key alike: only the bytes are left to tell them apart
        monkeypatch.setattr(
            "tickerloom.llm.ngram_table.hash_stretches",
            lambda buffer, lanes, starts, lengths: np.full(len(starts), 7, np.uint64),
        )
    draw = random.Random(1)
    buffer = "".join(draw.choices("ab ", k=400)).encode()
    starts = np.array([draw.randrange(340) for _ in range(500)])
    ends = starts + np.array([draw.randrange(1, 60) if i % 3 else 4 for i in range(500)])
    table = NgramTable(buffer, starts, ends, 10_000)
    texts = [buffer[a:b] for a, b in zip(starts, ends)]
    slot_of = {}
    for text, slot in zip(texts, table.slots.tolist()):
        assert slot_of.setdefault(text, slot) == slot
        assert table.bucket[slot] == zlib.crc32(text) % 10_000
        assert table.counts[slot] == texts.count(text)
    assert len(set(slot_of.values())) == len(slot_of)
    assert table.bucket_counts(10_000).sum() == 500


@pytest.mark.parametrize("group", [importance.GROUP, 40])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(importance, "GROUP", group)
    rows, target = corpus(3, 120), [(i, t) for i, t in enumerate(("alpha beta x9", None, "the of"))]
    found = importance.resample(documents(spark, rows).repartition(5), documents(spark, target))
    assert rows_of(found) == brute_force(rows, target)


def test_long_texts_are_cut_between_features():
    words = b" ".join(b"w%d" % i for i in range(500)) + b" " + b"y" * 300 + b" a b"
    lines = list(importance._lines(words, 3, 64))
    group = importance._Group(lines, [0] * len(lines), 3)
    spans = Counter(group.buffer[a:b] for a, b in zip(group.starts, group.ends))
    assert spans == Counter(g.encode() for g in features(words.decode())[1])
    assert len(lines) > 20 and len(group.words) == 503


def test_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame(
        [(i, 1, 0, 5) for i in range(40, 0, -1)], "doc_id long, n_features long, weight long, score long"
    ).repartition(6)
    drawn = importance.ranked(rows, 25).filter("rank IS NOT NULL").collect()
    assert sorted((r["rank"], r["doc_id"]) for r in drawn) == [(i, i) for i in range(1, 11)]


def test_the_draw_leans_to_the_target(spark):
    rows = [(i, sentence(0 if i % 10 == 0 else 100 + i % 7, 40)) for i in range(200)]
    target = documents(spark, [(0, sentence(0, 40))])
    drawn = importance.drawn_documents(documents(spark, rows), target)
    assert drawn.schema == documents(spark, rows).schema
    found = [r["doc_id"] for r in drawn.collect()]
    assert len(found) == 10 and all(i % 10 == 0 for i in found)


def test_awkward_rows_and_empty_tables(spark):
    docs, empty = documents(spark, AWKWARD), documents(spark, [])
    assert rows_of(importance.resample(docs, docs)) == brute_force(AWKWARD, AWKWARD)
    assert rows_of(importance.resample(docs, empty)) == brute_force(AWKWARD, [])
    assert rows_of(importance.resample(empty, docs)) == []
