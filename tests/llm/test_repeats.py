import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import AWKWARD, documents, sentence, words

from tickerloom.llm import hashing, repeats


def expected(rows, size=13):
    """Per row: n_words, n_removed, digest of the kept words."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1) if doc_id is not None else ():
            key = tuple(w[i : i + size])
            first[key] = min(doc_id, first.get(key, doc_id))
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1) if doc_id is not None else ():
            if first[tuple(w[i : i + size])] < doc_id:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        yield doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()


def passages(n, seed=0):
    """Documents that share passages, copies and phrases just under and over the window."""
    draw = random.Random(seed)
    shared = [sentence(1000 * k, 40) for k in range(6)]
    rows = []
    for i in range(n):
        parts = [sentence(100_000 + 50 * i, draw.randint(0, 20))]
        for _ in range(draw.randint(0, 3)):
            w = draw.choice(shared).split()
            a = draw.randint(0, 30)
            parts += [" ".join(w[a : a + draw.randint(10, 25)]), sentence(500_000 + 60 * i, 3)]
        rows.append((i * 3 % n, "\n".join(parts)))
    rows += [(n + k, shared[0]) for k in range(n // 3)]
    return rows


@pytest.mark.parametrize("sizes", [
    {}, {"chunk_chars": 300, "bucket_windows": 50}, {"chunk_chars": 2000, "shard_chars": 200},
])
def test_removal_matches_the_definition(spark, sizes):
    rows = [*passages(80), *[(i + 1000 if i else None, t) for i, t in AWKWARD]]
    docs = documents(spark, rows).repartition(4)
    found = repeats.repeat_digest(repeats.find_repeats(docs, **sizes)).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)


def test_overlaps_ties_and_short_texts(spark):
    text = sentence(0, 30)
    rows = [
        (1, text), (1, text), (2, text), (3, sentence(0, 12)), (4, sentence(0, 13)),
        (5, " ".join(["same"] * 40)), (6, " ".join(["same"] * 13)), (7, " ".join(["same"] * 12)),
        (8, f"{sentence(900, 2)} {sentence(5, 14)} {sentence(950, 2)}"), (0, sentence(17, 13)),
        (None, text),
    ]
    found = repeats.repeat_digest(repeats.find_repeats(documents(spark, rows))).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)


def test_ranges_and_kept_text_belong_together(spark):
    rows = passages(40)
    texts = dict(rows[:40])
    found = repeats.find_repeats(documents(spark, rows), chunk_chars=500)
    for row in found.filter("doc_id < 40").collect():
        w = words(texts[row["doc_id"]])
        gone = {k for r in row["removed"] for k in range(r["start"], r["end"])}
        assert row["text"] == " ".join(x for k, x in enumerate(w) if k not in gone)


def test_words_of_several_digits(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BASE_BITS", 2)
    rows = passages(30)
    found = repeats.repeat_digest(repeats.find_repeats(documents(spark, rows))).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows))
    distinct = np.arange(40, dtype=np.uint64)
    alphabet, width = repeats._alphabet(distinct)
    assert width == 3
    spelled = repeats._spell(distinct, alphabet, width)
    words_of = {spelled[k : k + 3] for k in range(0, 120, 3)}
    assert len(words_of) == 40
    assert repeats._spell(np.array([99], np.uint64), alphabet, width) not in words_of


def test_an_empty_table_gives_no_rows(spark):
    assert repeats.find_repeats(documents(spark, [])).count() == 0


def test_word_hashes_do_not_depend_on_the_pieces(monkeypatch):
    text = " ".join(f"w{k % 50} {'y' * (k % 40)}" for k in range(500)).encode()
    whole = hashing.word_hashes(text)
    assert len(whole) == len(text.split())
    by_word = {w: h for w, h in zip(text.split(), whole.tolist())}
    assert len(set(by_word.values())) == len(by_word)
    monkeypatch.setattr(hashing, "PIECE", 16)
    assert (hashing.word_hashes(text) == whole).all()
    assert hashing.word_hashes(b"").size == 0 and hashing.word_hashes(b" \n").size == 0


def test_packed_integers_come_back():
    import pyarrow as pa

    codec = pa.Codec("zstd", 1)
    for values in ([], [0], [1, 2**64 - 1, 2**40], list(range(1000))):
        data = np.array(values, np.uint64)
        packed = hashing.pack_integers(data, codec)
        assert hashing.unpack_integers(packed, len(values), codec).tolist() == values
