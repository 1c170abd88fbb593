import random
import re
import zlib
from collections import Counter

import pytest

from llm_fixtures import AWKWARD, documents
from tickerloom.llm import spelling


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def counted(rows, one_in=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_force(counts):
    near = {w: [v for v in counts if distance_one(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(
        (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None)
        for w, n in counts.items()
    )


def rows_of(grouped):
    return sorted(tuple(r) for r in grouped.collect())


def as_words(spark, counts):
    return spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3)


def variants(seed, letters, roots, per_root):
    draw = random.Random(seed)
    found = {}
    for _ in range(roots):
        word = "".join(draw.choices(letters, k=draw.randrange(7, 14)))
        for _ in range(per_root):
            at = draw.randrange(len(word) + 1)
            kind = draw.randrange(4)
            if kind == 0 and len(word) > 7 and at < len(word):
                word = word[:at] + word[at + 1 :]
            elif kind == 1:
                word = word[:at] + draw.choice(letters) + word[at:]
            elif kind == 2 and at < len(word):
                word = word[:at] + draw.choice(letters) + word[at + 1 :]
            found[word] = draw.choice([2, 3, 20, 25, 250, 3000, 40_000])
    return found


@pytest.mark.parametrize("max_pairs", [0, 4, spelling.MAX_PAIRS])
@pytest.mark.parametrize("letters", ["ab", "abcdéÿ"])
def test_equals_brute_force(spark, letters, max_pairs):
    counts = variants(len(letters), letters, 12, 14)
    found = spelling.group_variants(as_words(spark, counts), max_pairs=max_pairs)
    assert rows_of(found) == brute_force(counts)


def test_every_near_pair_once(spark):
    counts = variants(8, "abc", 10, 20)
    for max_pairs in (0, 1 << 12):
        pairs = spelling.near_words(as_words(spark, counts), max_pairs=max_pairs).collect()
        found = Counter(frozenset((r["word"], r["other"])) for r in pairs)
        assert set(found.values()) == {1}
        names = sorted(counts)
        assert set(found) == {
            frozenset((a, b)) for i, a in enumerate(names) for b in names[i + 1 :] if distance_one(a, b)
        }


def test_one_shared_half_is_split(spark):
    """Words that share a half, in numbers: the keys shrink and no pair is lost."""
    draw = random.Random(2)
    counts = {"aaaaaa" + "".join(draw.choices("abcd", k=6)): 2 + k % 50 for k in range(400)}
    words = as_words(spark, counts)
    rows = spelling.chunk_rows(words, 7, 16)
    per_key = rows.groupBy("key", "low", "high").count().collect()
    assert all(r["count"] <= 16 or r["high"] - r["low"] == 1 for r in per_key)
    assert rows_of(spelling.group_variants(words, max_pairs=16)) == brute_force(counts)


def test_words_of_documents(spark):
    draw = random.Random(6)
    names = ["wonderful", "Straßenbahn", "ÉLÉPHANTS", "mountain", "mountains", "elsewhere", "naïveté"]
    rows = [(i, " ".join(draw.choices(names, k=30)) + "-x9wonderful,") for i in range(70)]
    rows += [(None, "wonderful wonderful"), (3, "wonderful"), (99, None), (98, "")]
    found = spelling.group_variants(spelling.count_words(documents(spark, rows), one_in=31))
    assert rows_of(found) == brute_force(counted(rows))
    plain = spelling.count_words(documents(spark, rows))
    assert dict(tuple(r) for r in plain.collect()) == counted(rows, one_in=0)


def test_forms_follow_to_the_last(spark):
    counts = {"wondrful": 2, "wonderful": 20, "wonderfull": 200, "wonderfulls": 2000, "xonderful": 20}
    rows = {r[0]: r for r in rows_of(spelling.group_variants(as_words(spark, counts)))}
    assert rows["wondrful"][1:3] == ("wonderful", "wonderfulls")
    assert rows["xonderful"][1:3] == (None, "xonderful")  # twice as many is no tenfold
    assert rows["wonderfulls"][1:3] == (None, "wonderfulls")


def test_awkward_rows_and_long_words(spark):
    rows = [*AWKWARD, (20, "y" * 5000), (21, "y" * 5000), (22, "y" * 5001), (23, "y" * 5001)]
    found = spelling.group_variants(spelling.count_words(documents(spark, rows)))
    assert rows_of(found) == brute_force(counted(rows, one_in=0))


def test_empty_table(spark):
    assert rows_of(spelling.group_variants(spelling.count_words(documents(spark, [])))) == []
