import zlib
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import AWKWARD, documents, sentence
from tickerloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def contents(sequence, offset, lengths):
    """The places of each sequence in order, checked to be gapless."""
    found = {}
    rows = sorted(zip(sequence, offset, lengths))
    for number, group in groupby(rows, key=lambda r: r[0]):
        at = 0
        for _, place, length in group:
            assert place == at
            at += length
        found[number] = at
    return found


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.integers(1, 64), max_size=120), st.sampled_from(["norm", "dot"]),
    st.sampled_from([None, 1, 3]), st.sampled_from([None, 64 * 64, 5000]),
)
def test_no_capacity_is_exceeded(lengths, rule, documents, attention):
    lengths = np.array(lengths, np.int64)
    sequence, offset = packing.best_fit(lengths, 64, documents, attention, rule)
    assert all(total <= 64 for total in contents(sequence, offset, lengths).values())
    for number in set(sequence):
        inside = lengths[sequence == number]
        assert documents is None or len(inside) <= documents
        assert attention is None or (inside**2).sum() <= attention


def test_best_fit_is_tight():
    draw = np.random.default_rng(3)
    lengths = np.concatenate([draw.integers(1, 700, 3000), draw.integers(700, 4097, 900)])
    sequence, _ = packing.best_fit(lengths)
    bound = -(-lengths.sum() // 4096)
    assert sequence.max() + 1 <= bound * 1.005 + 1


def test_a_piece_over_a_capacity_is_an_error():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([10]), 64, max_attention=99)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([10]), 64, rule="first")


def expected(rows, length):
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for number, at in enumerate(range(0, len(ids), length)):
            part = np.array(ids[at : at + length], "<u4")
            yield doc_id, number, at, len(part), zlib.crc32(part), part.astype("<u2").tobytes()


@pytest.mark.parametrize("groups", [{}, {"group_tokens": 200}, {"group_pieces": 3}])
def test_pieces_and_places(spark, groups):
    rows = [*AWKWARD, *[(100 + i, sentence(i, 1 + i * 7 % 40)) for i in range(60)]]
    pieces = packing.token_pieces(documents(spark, rows).repartition(3), PATH, 1, 64)
    found = [tuple(r) for r in packing.pack(pieces, 64, **groups).collect()]
    key = lambda r: (str(r[0]), *r[1:])
    plain = sorted(((*r[:5], bytes(r[5])) for r in found), key=key)
    assert plain == sorted(expected(rows, 64), key=key)
    filled = contents([r[6] for r in found], [r[7] for r in found], [r[3] for r in found])
    assert all(total <= 64 for total in filled.values())


def test_sequences_join_their_pieces(spark):
    docs = documents(spark, [(i, sentence(i, 9)) for i in range(20)])
    packed = packing.pack(packing.token_pieces(docs, PATH, length=64), 64)
    packed = spark.createDataFrame(packed.collect(), packed.schema)
    for row in packing.sequences(packed).collect():
        parts = packed.filter(packed.sequence_id == row["sequence_id"]).orderBy("offset").collect()
        assert bytes(row["ids"]) == b"".join(bytes(p["ids"]) for p in parts)
        assert row["n_tokens"] * 2 == len(row["ids"])


def test_an_empty_table_packs_to_nothing(spark):
    assert packing.pack(packing.token_pieces(documents(spark, []), PATH)).count() == 0
